"""Patterns written once with ASCII word boundaries, for Spark and for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_W = "[A-Za-z0-9_]"
_BOUNDARY = f"(?:(?<!{_W})(?={_W})|(?<={_W})(?!{_W}))"
_WORDLY = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")


def _split(body: str) -> list[str]:
    """Alternatives of a pattern at its top level."""
    out, depth, start, i = [], 0, 0, 0
    while i < len(body):
        c = body[i]
        if c == "\\":
            i += 1
        elif c == "[":
            i = body.index("]", i + 1)
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "|" and depth == 0:
            out.append(body[start:i])
            start = i + 1
        i += 1
    return [*out, body[start:]]


def _close(pattern: str, at: int) -> int:
    """Index of the parenthesis that closes the one at ``at``; the length of the pattern without one."""
    depth, i = 0, at
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif c == "[":
            i = pattern.index("]", i + 1)
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if depth == 0:
                return i
        i += 1
    return len(pattern)


def _open(pattern: str, end: int) -> int:
    """Index of the parenthesis that the one before ``end`` closes."""
    return next((i for i in range(end) if pattern[i] == "(" and (i == 0 or pattern[i - 1] != "\\") and _close(pattern, i) == end - 1), -1)


def _starts(pattern: str) -> bool:
    """Whether every match surely starts with a word character."""
    if pattern[:1] == "(":
        end = _close(pattern, 0)
        body = pattern[1:end].removeprefix("?:")
        return not body.startswith("?") and pattern[end + 1 : end + 2] not in ("?", "*", "{") and all(_starts(x) for x in _split(body))
    return (pattern[:1] in _WORDLY and pattern[:1] != "" and pattern[1:2] not in ("?", "*", "{")) or pattern.startswith(r"\d") and pattern[2:3] not in ("?", "*", "{")


def _ends(pattern: str) -> bool:
    """Whether every match surely ends with a word character."""
    if pattern[-1:] == "?" and pattern[-2:-1] in _WORDLY and pattern[-3:-2] != "\\":
        return _ends(pattern[:-2])
    if pattern[-1:] == ")" and pattern[-2:-1] != "\\":
        at = _open(pattern, len(pattern))
        body = pattern[at + 1 : -1].removeprefix("?:")
        return at >= 0 and not body.startswith("?") and all(_ends(x) for x in _split(body))
    return pattern[-1:] in _WORDLY and pattern[-1:] != "" and pattern[-2:-1] != "\\"


@lru_cache(maxsize=4096)
def java(pattern: str) -> str:
    r"""``pattern`` with boundaries that treat only ASCII letters, digits and _ as word characters.

    A ``\b`` between which and the next or previous part a word character is certain becomes one
    lookaround in place of four, which is tried at every character of a text.
    """
    parts, out = pattern.split(r"\b"), ""
    for n, part in enumerate(parts):
        out += part
        if n + 1 == len(parts):
            break
        after = parts[n + 1]
        if after and _starts(_split(after)[0]) and _close("(" + after, 0) > len(_split(after)[0]):
            out += f"(?<!{_W})"
        elif part and _ends(_split(part)[-1]) and part.count("(") == part.count(")"):
            out += f"(?!{_W})"
        else:
            out += _BOUNDARY
    return out


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def has(col: Column, pattern: str, ignore_case: bool = False) -> Column:
    return col.rlike(("(?i)" if ignore_case else "") + java(pattern))


def group(col: Column, pattern: str, number: int = 1) -> Column:
    """A group of the first match; null without a match or where the group took no part."""
    return F.nullif(F.regexp_extract(col, java(pattern), number), F.lit(""))


def swap(col: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(col, java(pattern), to)


def sql(pattern: str) -> str:
    """``pattern`` as a DuckDB string literal."""
    return "'" + pattern.replace("'", "''") + "'"
