"""Spans of texts as column expressions: pattern matches with their places, and texts rewritten at spans.

A walk that adds to an array at each step copies it each time.  Places are running sums
instead, made in one pass per power of two, so that everything here takes time in
proportion to the text, and to n log n for n spans.  Texts are cut into chunks before
pieces are taken from them, since every substring walks from the start.  Places are
code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points of a chunk.
CHUNK = 4096
#: Arrays hold fewer than two to this power entries.
POWERS = 31


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """array<int>: ``combine`` (sum or greatest) of each of the non-negative ints and all before it."""
    def double(acc: Column, k: Column) -> Column:
        earlier = F.concat(F.array_repeat(F.lit(0), k), F.slice(acc, 1, F.greatest(F.size(acc) - k, F.lit(0))))
        return F.when(k < F.size(acc), F.zip_with(acc, earlier, combine)).otherwise(acc)

    return F.aggregate(F.array(*[F.lit(1 << i) for i in range(POWERS)]), values, double)


def matches(text: Column, kind: int, pattern: str, around: int = 0) -> Column:
    """array<struct<start, end, kind, value>> of a pattern's matches, leftmost first and not overlapping.

    With ``around``, also up to so many characters ``before`` and ``after`` a match, not
    beyond the next match on either side.  The text between matches (split) and the
    matches are measured, which gives each match's end.
    """
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps, n = F.split(text, pattern, -1), F.size(found)
    ends = running(F.zip_with(F.slice(gaps, 1, n), found, lambda g, v: F.length(g) + F.length(v)), lambda a, b: a + b)

    def span(end: Column, value: Column) -> list[Column]:
        # named_struct, as aliases are lost inside nested lambdas.
        return [F.lit("start"), end - F.length(value), F.lit("end"), end, F.lit("kind"), F.lit(kind), F.lit("value"), value]

    spans, fields = F.zip_with(ends, found, lambda e, v: F.named_struct(*span(e, v))), "start:int,end:int,kind:int,value:string"
    if around:
        fields += ",before:string,after:string"
        sides = F.zip_with(F.slice(gaps, 1, n), F.slice(gaps, 2, n), lambda g, h: F.named_struct(
            F.lit("before"), F.right(g, F.lit(around)), F.lit("after"), F.left(h, F.lit(around))))
        spans = F.zip_with(spans, sides, lambda s, g: F.named_struct(*[
            x for c in ("start", "end", "kind", "value") for x in (F.lit(c), s[c])], F.lit("before"), g["before"], F.lit("after"), g["after"]))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<struct<{fields}>>"))


def places(spans: Column) -> Column:
    """The spans without their values, by start, then kind."""
    bare = F.transform(spans, lambda s: F.named_struct(F.lit("start"), s["start"], F.lit("kind"), s["kind"], F.lit("end"), s["end"]))
    return F.array_sort(bare)


def digest(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end``, comma-joined, in the order of the spans."""
    names = F.array(*map(F.lit, kinds))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def scoped(spans: Column, breaks: Column) -> Column:
    """array<struct<start, kind, end, scope>>: each span with the number of ``breaks`` (positions) at or before its start."""
    marks = F.transform(breaks, lambda b: F.named_struct(
        F.lit("at"), b, F.lit("span"), F.lit(0), F.lit("start"), b, F.lit("kind"), F.lit(-1), F.lit("end"), b))
    parts = F.transform(spans, lambda s: F.named_struct(
        F.lit("at"), s["start"], F.lit("span"), F.lit(1), F.lit("start"), s["start"], F.lit("kind"), s["kind"], F.lit("end"), s["end"]))
    merged = F.array_sort(F.concat(marks, parts))
    scopes = running(F.transform(merged, lambda m: 1 - m["span"]), lambda a, b: a + b)
    return F.filter(F.zip_with(merged, scopes, lambda m, n: F.named_struct(
        F.lit("start"), m["start"], F.lit("kind"), m["kind"], F.lit("end"), m["end"], F.lit("scope"), n)), lambda s: s["kind"] >= 0)


def _between(chunks: Column, a: Column, b: Column) -> Column:
    first, last = F.floor(a / CHUNK).cast("int"), F.floor(b / CHUNK).cast("int")
    head, tail = F.coalesce(F.get(chunks, first), F.lit("")), F.coalesce(F.get(chunks, last), F.lit(""))
    inside = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return (F.when(a >= b, F.lit("")).when(first == last, F.substr(head, a % CHUNK + 1, b - a))
            .otherwise(F.concat(F.substr(head, a % CHUNK + 1), inside, F.left(tail, b % CHUNK))))


def rewritten(text: Column, spans: Column, new: Callable[[Column, Column], Column]) -> Column:
    """``text`` with each span replaced by ``new(span, its text)``; of overlapping spans the first to start decides."""
    chunks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))
    ends = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))

    def write(chunks: Column) -> Column:
        # Up to which place the spans before one reach, with the span.
        placed = F.zip_with(spans, F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.greatest(F.size(spans) - 1, F.lit(0)))),
                            lambda s, at: F.named_struct(F.lit("s"), s, F.lit("at"), at))
        pieces = F.transform(placed, lambda p: F.when(p["s"]["start"] >= p["at"], F.concat(
            _between(chunks, p["at"], p["s"]["start"]), new(p["s"], _between(chunks, p["s"]["start"], p["s"]["end"])))).otherwise(F.lit("")))
        return F.concat(F.array_join(pieces, ""), _between(chunks, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text)))

    # A lambda's variable holds the chunks, which are thus cut once.
    whole = F.get(F.transform(F.array(chunks), write), F.lit(0))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
