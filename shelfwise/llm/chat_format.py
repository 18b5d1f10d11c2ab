"""Chat formatting with a compiled, sandboxed template language.

``compile_template`` parses a template into a syntax tree, folds constant parts and generates
Python closures. Templates reach only the variables given to them, mapping keys and the filters
below: no attributes, calls, imports or indexing by expression exist in the language.

Statements: ``{{ expr }}``, ``{% for x in expr %}..{% endfor %}``, ``{% if %}..{% elif %}..
{% else %}..{% endif %}`` and ``{% generation %}..{% endgeneration %}``, which marks what a model
should learn to write. Expressions: strings, integers, true/false/none, names, ``a.key``, ``+``,
``==``, ``!=``, ``not``, ``and``, ``or``, ``x if c else y``, parentheses and ``| filter``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, tidy

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"

DEFAULT_TEMPLATE = (
    "{% for m in messages %}"
    "<|im_start|>{{ m.role | escape }}<|im_sep|>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "<|im_end|>\n"
    "{% endfor %}"
)


def escape(text: str) -> str:
    """No ``<|`` is left: ``<``, any backslashes, ``|`` gets one more backslash."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": lambda x: escape(_text(x)),
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
    "length": len,
}


class TemplateError(ValueError):
    """The template can't be parsed, or asks for what the sandbox doesn't offer."""


def _text(x: Any) -> str:
    return "" if x is None else str(x)


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%-?\s*(.*?)\s*-?%\}", re.S)
_LEX = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[+|().]))""")


class _Expression:
    """Recursive descent over one expression; nodes are tuples, ('const', value) where known."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            m = _LEX.match(source, at)
            if not m:
                raise TemplateError(f"unexpected text in expression: {source[at:at + 20]!r}")
            self.tokens.append((("str", "int", "name", "op")[m.lastindex - 1], m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self) -> str:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "str" else ""

    def take(self, *wanted: str) -> bool:
        if self.peek() in wanted:
            self.at += 1
            return True
        return False

    def whole(self) -> tuple:
        node = self.choice()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def choice(self) -> tuple:
        node = self.either()
        if self.take("if"):
            test = self.either()
            other = self.choice() if self.take("else") else ("const", None)
            return ("choose", test, node, other)
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.summed()
        while (op := self.peek()) in ("==", "!="):
            self.at += 1
            node = (op, node, self.summed())
        return node

    def summed(self) -> tuple:
        node = self.piped()
        while self.take("+"):
            node = ("+", node, self.piped())
        return node

    def piped(self) -> tuple:
        node = self.atom()
        while self.take("|"):
            name = self.peek()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def atom(self) -> tuple:
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            node = ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1]))
        elif kind == "int":
            node = ("const", int(text))
        elif kind == "name":
            known = {"true": True, "false": False, "none": None}
            node = ("const", known[text]) if text in known else ("name", text)
        elif text == "(":
            node = self.choice()
            if not self.take(")"):
                raise TemplateError("a parenthesis isn't closed")
        else:
            raise TemplateError(f"unexpected {text!r}")
        while self.take("."):
            if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
                raise TemplateError("a key must follow the dot")
            node = ("key", node, self.tokens[self.at][1])
            self.at += 1
        return node


def parse(template: str) -> list[tuple]:
    """Syntax tree: a list of text, out, for, if and generation nodes."""
    root: list[tuple] = []
    stack: list[tuple[str, Any, list[tuple]]] = [("", None, root)]
    at = 0
    for m in _TAG.finditer(template):
        if m.start() > at:
            stack[-1][2].append(("text", template[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            stack[-1][2].append(("out", _Expression(m[1]).whole()))
            continue
        word, _, rest = m[2].partition(" ")
        if word == "for":
            loop = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
            if not loop:
                raise TemplateError(f"not a loop: {rest!r}")
            stack.append(("for", (loop[1], _Expression(loop[2]).whole()), []))
        elif word == "if":
            stack.append(("if", [(_Expression(rest).whole(), body := [])], body))
        elif word in ("elif", "else") and stack[-1][0] == "if":
            arms = stack[-1][1]
            arms.append((_Expression(rest).whole() if word == "elif" else ("const", True), body := []))
            stack[-1] = ("if", arms, body)
        elif word == "generation":
            stack.append(("generation", None, []))
        elif word in ("endfor", "endif", "endgeneration") and stack[-1][0] == word[3:]:
            kind, head, body = stack.pop()
            node = {"for": lambda: ("for", *head, body), "if": lambda: ("if", head), "generation": lambda: ("generation", body)}[kind]()
            stack[-1][2].append(node)
        else:
            raise TemplateError(f"unexpected tag {m[2]!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} isn't closed")
    if at < len(template):
        root.append(("text", template[at:]))
    return root


def fold_expression(node: tuple) -> tuple:
    kind = node[0]
    if kind in ("const", "name"):
        return node
    parts = [fold_expression(x) if isinstance(x, tuple) else x for x in node[1:]]
    if kind == "choose" and parts[0][0] == "const":
        return parts[1] if parts[0][1] else parts[2]
    if all(x[0] == "const" for x in parts if isinstance(x, tuple)):
        return ("const", _closure((kind, *parts))({}))
    return (kind, *parts)


def fold(nodes: list[tuple]) -> list[tuple]:
    """Constant output becomes text, decided arms replace their ``if``, neighbouring texts join."""
    out: list[tuple] = []
    for node in nodes:
        if node[0] == "out":
            e = fold_expression(node[1])
            found = [("text", _text(e[1]))] if e[0] == "const" else [("out", e)]
        elif node[0] == "for":
            found = [("for", node[1], fold_expression(node[2]), fold(node[3]))]
        elif node[0] == "generation":
            found = [("generation", fold(node[1]))]
        elif node[0] == "if":
            arms = []
            for test, body in node[1]:
                test = fold_expression(test)
                if test[0] == "const" and not test[1]:
                    continue
                arms.append((test, fold(body)))
                if test[0] == "const":
                    break
            found = arms[0][1] if arms and arms[0][0][0] == "const" else [("if", arms)] if arms else []
        else:
            found = [node]
        for x in found:
            if x[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + x[1])
            elif x != ("text", ""):
                out.append(x)
    return out


def _closure(node: tuple) -> Callable[[dict], Any]:
    kind = node[0]
    if kind == "const":
        return lambda scope, v=node[1]: v
    if kind == "name":
        return lambda scope, n=node[1]: scope.get(n)
    if kind == "key":
        of, key = _closure(node[1]), node[2]
        return lambda scope: x.get(key) if isinstance(x := of(scope), dict) else None
    if kind == "filter":
        f, of = FILTERS[node[1]], _closure(node[2])
        return lambda scope: f(of(scope))
    if kind == "not":
        of = _closure(node[1])
        return lambda scope: not of(scope)
    a, b = _closure(node[1]), _closure(node[2])
    if kind == "choose":
        c = _closure(node[3])
        return lambda scope: b(scope) if a(scope) else c(scope)
    return {
        "==": lambda scope: a(scope) == b(scope),
        "!=": lambda scope: a(scope) != b(scope),
        "and": lambda scope: a(scope) and b(scope),
        "or": lambda scope: a(scope) or b(scope),
        "+": lambda scope: _text(a(scope)) + _text(b(scope)),
    }[kind]


class _Output:
    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _generate(nodes: list[tuple]) -> Callable[[dict, _Output], None]:
    steps: list[Callable[[dict, _Output], None]] = []
    for node in nodes:
        if node[0] == "text":
            steps.append(lambda scope, out, t=node[1]: out.add(t))
        elif node[0] == "out":
            steps.append(lambda scope, out, e=_closure(node[1]): out.add(_text(e(scope))))
        elif node[0] == "for":

            def loop(scope, out, name=node[1], of=_closure(node[2]), body=_generate(node[3])):
                for item in of(scope) or ():
                    body({**scope, name: item}, out)

            steps.append(loop)
        elif node[0] == "if":

            def branch(scope, out, arms=[(_closure(t), _generate(b)) for t, b in node[1]]):
                for test, body in arms:
                    if test(scope):
                        return body(scope, out)

            steps.append(branch)
        else:

            def marked(scope, out, body=_generate(node[1])):
                start = out.length
                body(scope, out)
                out.spans.append((start, out.length))

            steps.append(marked)

    def run(scope: dict, out: _Output) -> None:
        for step in steps:
            step(scope, out)

    return run


def compile_template(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages (dicts) to the formatted text and its generation spans."""
    run = _generate(fold(parse(template)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        run({"messages": messages}, out)
        return "".join(out.parts), out.spans

    return render


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a text made by ``DEFAULT_TEMPLATE``."""
    turns = []
    for piece in formatted.split(START)[1:]:
        role, _, rest = piece.partition(SEP)
        turns.append((unescape(role), unescape(rest[: rest.rindex(END)])))
    return turns


_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_conversations(rows: DataFrame, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """One row for each conversation: conv_id, formatted, loss_spans (starts and ends, code points).

    Turns are ordered by (turn, role, text), nulls first; null roles and texts are empty; rows
    that repeat are turns of their own. Rows with a null conv_id form one conversation. Columns
    other than conv_id, turn, role and text are ignored; no rows in, none out.
    """
    grouped = rows.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
        ).alias("turns")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for batch in batches:
            done = [render([{"role": t["role"], "text": t["text"]} for t in turns]) for turns in batch.column(1).to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in done]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in done], pa.string()), pa.array(spans, _LOSS)], names=["conv_id", "formatted", "loss_spans"])

    bound_batches(rows.sparkSession)
    return grouped.mapInArrow(tidy(run), f"conv_id {dict(rows.dtypes)['conv_id']}, formatted string, loss_spans array<struct<start: long, end: long>>")


def digest(formatted: DataFrame) -> DataFrame:
    """Reads formatted conversations back into turns and loss text, and digests both, one row for each.

    Null ids stay null; a conversation without marked text has an empty loss text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read_back(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append((len(turns), _sha(said), len(loss), _sha(loss), len(text)))
            names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            made = [pa.array([r[i] for r in out], pa.string() if "sha" in n else pa.int64()) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["conv_id", *names])

    bound_batches(formatted.sparkSession)
    kind = dict(formatted.dtypes)["conv_id"]
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(tidy(run), f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
