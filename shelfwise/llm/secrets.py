"""Secret scan: fixed patterns, and a guess-cost test of values in credential contexts.

The base patterns find assignments, access keys and long hex strings. The method adds values
that stand in a credential context (a credential word and an assignment mark, a bearer header,
or a user:password part of a URL) and would cost an attacker many guesses: the cheapest
segmentation of the value into known words, dates, repeats, keyboard walks and brute-force
spans, found by dynamic programming, costs 10**MIN_LOG_GUESSES guesses or more.

Sentences have 'password: word' and 'password is word' too, so unquoted plain words (letters only,
of one case but for the first) after ' is ' or a colon and a space are left out before that test.
All other values are judged by their cost alone.

The dictionary of known words is a short list of popular passwords followed by the words that are
commonest in the scanned texts themselves (``corpus_words``), ranked in that order.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, discard, materialize, tidy

KINDS = ("assign", "access", "hex", "guess")

# The three base patterns; ``assign`` ignores the case of ASCII letters only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# Runs are taken whole by leftmost matching, so a least length in the pattern drops the same matches.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST = 8

# Values have no upper length: each runs to its closing quote, '@', mark or white space, a linear scan.
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_-]?key|access[_-]?key|private[_-]?key|auth(?:orization)?)"""
    r"""["']?\x20*(?::=|=>|[:=]|(?<=\x20)is\x20)\x20*(?:bearer\x20)?(?:"([^"\n]{4,})"|'([^'\n]{4,})'|([^\s"'<>,;]{4,}))"""
    r"""|://[^\s:/@]*:([^\s/@]{4,})@""",
    re.I | re.A,
)
# Ends of contexts that sentences have too; quoted values and those after a bearer mark come later.
PROSE = re.compile(r"(?::|\x20is)\x20+\Z", re.I | re.A)
MIN_LOG_GUESSES = 10.0

# Words an attacker tries first, the commonest first.
WORDS = (
    "password passwd pass secret token admin root user login welcome letmein master hello monkey dragon "
    "shadow sunshine princess football baseball superman batman iloveyou trustno1 access private public "
    "default guest test testing demo sample example changeme change temp system server database service "
    "account access key api client company office home summer winter spring autumn january february march "
    "april may june july august september october november december monday friday love money"
).split()
#: Words of the dictionary that come from the scanned texts: the commonest, of so many letters.
CORPUS_WORDS, WORD_LETTERS = 20_000, (4, 24)
#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 200_000
LEET = str.maketrans("4@310$57", "aaeiosst")
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "0123456789")
NEXT = {(a, b) for row in WALKS for p in (row, row[::-1]) for a, b in zip(p, p[1:])}
DATE = re.compile(r"(?:19|20)\d\d([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
LOG_DAYS, LOG_YEARS = math.log10(365 * 100), math.log10(100)
#: Keys where a walk may start, and its directions.
LOG_KEYS = math.log10(47 * 4)
#: No word or date is longer, so what comes later can't start before it.
LOOK_BACK = 64
#: Each further segment costs the attacker at least a doubling of the arrangements to try.
LOG_SEGMENT = math.log10(2)


def _char_cost(c: str) -> float:
    if c.isdigit():
        return 1.0
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log10(26)
    return math.log10(33) if c < "\x80" else 2.0


def ranked(more: list[str] = ()) -> dict[str, float]:
    """log10 of the guesses up to each dictionary word: ``WORDS``, then ``more`` in its order."""
    out: dict[str, float] = {}
    for word in (*WORDS, *more):
        out.setdefault(word, math.log10(len(out) + 2))
    return out


RANK = ranked()


class _Starts:
    """Places where a walk or a repeat may have started; of two, the later is dropped once it can't win.

    The cost from a is best[a] + log10(end - a). A later start gains by its shorter way, ever less
    so as the end moves on, so what has lost once is never looked at again.
    """

    def __init__(self) -> None:
        self.places: list[int] = []

    def add(self, a: int) -> None:
        self.places.append(a)

    def least(self, best: list[float], end: int) -> tuple[float, int]:
        kept: list[int] = []
        for a in self.places:
            while kept and best[a] <= best[kept[-1]]:
                kept.pop()
            if not kept or best[a] + math.log10(end - a) < best[kept[-1]] + math.log10(end - kept[-1]):
                kept.append(a)
        self.places = kept
        return best[kept[-1]] + math.log10(end - kept[-1]), kept[-1]


def _repetitions(text: str) -> list[tuple[int, int, int]]:
    """(start, end, period) of every maximal repetition: two periods or more (three characters of period 1),
    by the least period, that no neighbour prolongs. Each square of a primitive unit lies in one of them."""
    n = len(text)
    least: dict[tuple[int, int], int] = {}
    if n < 2:
        return []
    # names[k][i]: equal numbers for equal stretches of 2**k characters from i
    names = [np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)[1].astype(np.int64)]
    same = np.flatnonzero(np.diff(np.concatenate([[0], (names[0][1:] == names[0][:-1]).view(np.int8), [0]])))
    least.update({(int(a), int(b) + 1): 1 for a, b in zip(same[::2], same[1::2]) if b - a >= 2})
    w = 1
    while 4 * w <= n:
        # Of periods 2w to 4w - 1, p equal neighbours hold a stretch of w from a multiple of w, equal to the one p on.
        name = names[-1]
        tail = np.concatenate([name[2 * w :], np.full(2 * w + len(name), -1)])
        blocks = name[::w]
        equal = np.lib.stride_tricks.sliding_window_view(tail, 2 * w)[:: w][: len(blocks)] == blocks[:, None]
        edge = np.zeros((1, 2 * w), bool)
        first = (equal & ~np.concatenate([edge, equal[:-1]])).T
        last = (equal & ~np.concatenate([equal[1:], edge])).T
        period, low = np.nonzero(first)
        period, low, high = period + 2 * w, low * w, (np.nonzero(last)[1] + 1) * w
        for k in range(len(names) - 2, -1, -1):
            step, short = 1 << k, names[k]
            more = low >= step
            more[more] = short[low[more] - step] == short[low[more] - step + period[more]]
            low = low - step * more
            more = high + period + step <= n
            more[more] = short[high[more]] == short[high[more] + period[more]]
            high = high + step * more
        whole = high - low >= period
        for a, b, p in zip(low[whole].tolist(), (high + period)[whole].tolist(), period[whole].tolist()):
            least[a, b] = min(p, least.get((a, b), p))
        names.append(np.unique(name[:-w] * (int(name.max()) + 1) + name[w:], return_inverse=True)[1])
        w *= 2
    return [(a, b, p) for (a, b), p in least.items()]


def log_guesses(value: str, enough: float = math.inf, ranks: Mapping[str, float] = RANK, units: dict[str, float] | None = None) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` costs; '' costs 0.

    Segments are words of ``ranks``, dates, keyboard walks of three keys or more, repeats (of one
    character three times or more, of a longer unit twice or more; the unit costs its own cheapest
    segmentation) and brute-force spans. Exact up to ``enough``, at any length: once every open
    segmentation costs that much, the search ends and the least of them, a lower bound, is returned.
    """
    n, low = len(value), value.lower()
    if len(low) != n:
        low = value
    plain = low.translate(LEET)
    units = {} if units is None else units
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)  # cheapest way that ends inside a brute-force span
    walk, walks = 1, _Starts()
    looked, ask = 0, LOOK_BACK  # how far repetitions are known; where the end of the search is tried next
    coming: list[tuple[int, int, int, int]] = []  # (first end, period, start, last end), the last first
    going: list[tuple[int, int, int]] = []  # (period, start, last end) of the repetitions around here
    repeats: dict[tuple[int, int], _Starts] = {}
    for end in range(1, n + 1):
        i = end - 1
        if end > looked:
            looked = min(n, max(LOOK_BACK, 2 * looked))
            found_all = [(a + max(2 * p, 3), p, a, b) for a, b, p in _repetitions(low[:looked])]
            coming = sorted((x for x in found_all if x[0] >= end), reverse=True)
            going = [x[1:] for x in found_all if x[0] < end <= x[3]]
        brute[end] = min(brute[i], best[i] + LOG_SEGMENT) + _char_cost(value[i])
        found = brute[end]
        for size in range(3, min(WORD_LETTERS[1], end) + 1):
            a = end - size
            rank = ranks.get(low[a:end])
            if rank is None and plain[a:end] in ranks:
                rank = ranks[plain[a:end]] + LOG_SEGMENT
            if rank is not None:
                cased = 0.0 if value[a:end] == low[a:end] else LOG_SEGMENT * (1 if value[a:end].isupper() or value[a + 1 : end] == low[a + 1 : end] else size)
                found = min(found, best[a] + LOG_SEGMENT + rank + cased)
        for size in (4, 8, 10):
            if size <= end and DATE.fullmatch(low, end - size, end):
                found = min(found, best[end - size] + LOG_SEGMENT + (LOG_YEARS if size == 4 else LOG_DAYS))
        if i and (low[i - 1], low[i]) in NEXT:
            walk += 1
        else:
            walk, walks = 1, _Starts()
        if walk >= 3:
            walks.add(end - 3)
            found = min(found, walks.least(best, end)[0] + LOG_SEGMENT + LOG_KEYS)
        if going:
            going = [x for x in going if x[2] >= end]
        while coming and coming[-1][0] == end:
            going.append(coming.pop()[1:])
        for p, start, _ in sorted(going):
            least = max(p, 2 if p == 1 else 0)
            if end - start - p < least + p:  # the first such end of this residue in the run
                repeats[p, end % p] = _Starts()
            places = repeats[p, end % p]
            places.add(end - p - least)
            cost, a = places.least(best, end)
            cost += LOG_SEGMENT - math.log10(p)
            # a unit costs what it adds to the way up to it at least
            if cost + best[a + p] - best[a] >= found:
                continue
            unit = value[a : a + p]
            if unit not in units:
                units[unit] = _char_cost(unit) if p == 1 else log_guesses(unit, enough, ranks, units)
            found = min(found, cost + units[unit])
        best[end] = found
        # a walk or repeat that goes on may have started, or its unit ended, before the places looked at
        if end >= ask and found >= enough and walk < LOOK_BACK:
            least = min(best[end - LOOK_BACK : end + 1])
            if least >= enough:
                if low.find(low[end - LOOK_BACK : end], 0, end - 1) < 0:
                    return least
                ask = end + end // 8
    return best[n]


def _prose(value: str) -> bool:
    """A plain word with at most a capital in front and marks behind, as in a sentence."""
    body = value.rstrip(".,;:!?)]}")
    return body.isalpha() and not (any(c.isupper() for c in body[1:]) and any(c.islower() for c in body))


def scan_text(text: str | None, ranks: Mapping[str, float] = RANK) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, value start, value end) of every span, by start, then kind.

    Offsets count code points. A null text has no span. Base spans are leftmost and don't overlap
    within a kind; a context value is left out only where one base value holds all of it, so a guess
    span may overlap base spans and go on beyond them.
    """
    if not text:
        return []
    found = [("assign", m.start(), m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    held = sorted(s[3:] for s in found)
    starts, reach = [a for a, _ in held], list(accumulate((b for _, b in held), max))
    for m in CONTEXT.finditer(text):
        a, b = m.span(m.lastindex)
        before = bisect_right(starts, a)
        if before and reach[before - 1] >= b:
            continue
        value = text[a:b]
        if PROSE.search(text, m.start(), a) and _prose(value):
            continue
        if log_guesses(value, MIN_LOG_GUESSES, ranks) >= MIN_LOG_GUESSES:
            found.append(("guess", a, b, a, b))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def corpus_words(docs: DataFrame, text_col: str = "text", most: int = CORPUS_WORDS) -> list[str]:
    """The commonest words (runs of ASCII letters, lower-cased) of all texts, at most ``most``, the
    commonest first, ties in letter order; where the last of them tie with others, none of these is
    taken. A top-k report: only how many words have each count, and the words kept, reach the driver. Values in credential contexts don't
    count, or a secret that many copies repeat would become a known word. Null texts have no words."""
    word = re.compile("(?<![a-z])[a-z]{%d,%d}(?![a-z])" % WORD_LETTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for value in batch.column(0):
                text = value.as_py() or ""
                counts.update(word.findall(text.lower()))
                for m in CONTEXT.finditer(text):
                    counts.subtract(word.findall(m[m.lastindex].lower()))
                if len(counts) >= COUNTED_WORDS:
                    yield flush()
        yield flush()

    bound_batches(docs.sparkSession)
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(tidy(run), "word string, n long")
    total = materialize(counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0"), "words")
    left, least = most, 0
    for r in sorted(total.groupBy("n").agg(F.count("*").alias("words")).collect(), reverse=True):
        left -= r["words"]
        if left < 0:
            least = r["n"] + 1
            break
    kept = sorted((-r["n"], r["word"]) for r in total.where(F.col("n") >= least).collect())
    discard(total)
    return [word for _, word in kept]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), *((c, pa.int64()) for c in ("start", "end", "value_start", "value_end"))]))


def secret_spans(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: list[str] | None = None) -> DataFrame:
    """One row for each input row: doc_id and spans array<struct<kind, start, end, value_start, value_end>>.

    ``words`` are the dictionary's words after the popular ones; without it ``corpus_words`` of the
    texts. Whole texts are read; null texts count as empty; null and repeated ids stay as they are;
    other columns are ignored; no rows in, none out.
    """
    ranks = ranked(corpus_words(docs, text_col) if words is None else words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "value_start", "value_end")
        for batch in batches:
            found = [[dict(zip(names, s)) for s in scan_text(t.as_py(), ranks)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], names=["doc_id", "spans"])

    bound_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, spans array<struct<kind: string, start: long, end: long, value_start: long, value_end: long>>")


def redact_text(text: str | None, mark: str = "[secret]", ranks: Mapping[str, float] = RANK) -> str | None:
    """The text with every secret value replaced by ``mark``; overlapping values share one mark.

    A null text stays null."""
    spans = scan_text(text, ranks)
    if not spans:
        return text
    out, at = [], 0
    for a, b in sorted((s[3], s[4]) for s in spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, words: list[str] | None = None) -> DataFrame:
    """``docs`` with secret values replaced in ``text`` and ``n_chars``, where there is one, brought up to date.

    Every row is kept with its own columns; null texts and ids stay null; ``words`` as in ``secret_spans``.
    """
    bound_batches(docs.sparkSession)
    names = docs.columns
    ranks = ranked(corpus_words(docs) if words is None else words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            texts = pa.array([redact_text(t.as_py(), ranks=ranks) for t in batch.column(at)], batch.column(at).type)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 :]], names=names)

    done = docs.mapInArrow(tidy(run), docs.schema)
    return done.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in names else done


def digest(spans: DataFrame) -> DataFrame:
    """Counts and digest columns of the ``op4`` contract from ``secret_spans`` rows, one for each."""

    def line(found) -> str:
        return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).to_pylist()
            count = {k: [sum(s["kind"] == k for s in found) for found in lists] for k in KINDS}
            sha = [hashlib.sha256(line([s for s in found if s["kind"] != "guess"]).encode()).hexdigest() for found in lists]
            values = [",".join(f"{s['kind']}:{s['value_start']}:{s['value_end']}" for s in found) for found in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(count[k], pa.int64()) for k in KINDS[:3]), pa.array(sha, pa.string()), pa.array([line(f) for f in lists], pa.string()), pa.array(count["guess"], pa.int64()), pa.array(values, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "value_spans"],
            )

    kind = dict(spans.dtypes)["doc_id"]
    return spans.select("doc_id", "spans").mapInArrow(tidy(run), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, value_spans string")
