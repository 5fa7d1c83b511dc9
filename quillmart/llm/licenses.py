"""Operator 3: licence scan by an Aho-Corasick automaton and an expression parser.

Texts are lower-cased (A-Z) and cut into words; one automaton over the words, joined
by blanks, finds all phrases (base ones and further notices) in a single pass.  A
second pass of the same kind finds identifier tags (``SPDX-License-Identifier:``) in
the lower-cased text; what follows on the line is parsed by a shunting-yard parser:
``with`` binds closer than ``and``, ``and`` closer than ``or``; parentheses group; a
trailing ``+`` belongs to the identifier.  The parsed expression gives labels and a
restriction: of ``or`` the least restrictive side, of ``and`` the most restrictive
one, and an exception (``with``) halves it.  A broken expression keeps the labels of
the identifiers before the break and restricts nothing.

``score`` is 0 for no evidence, and otherwise 1 - 0.5 ** (distinct labels + tags that
parse), times at least a half, and more the more restrictive the licences found are.

Defined results: a null or empty text has no words, labels or score; very long texts
are read whole, and a tag's expression only to its end, so time follows the length; of
equally restrictive sides of ``or`` either gives the result; repeated rows have
equal results; a null id stays null; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import slices, table

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notices.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "bsd license": "bsd",
    "isc license": "isc",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under the apache license": "apache",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
#: How restrictive a licence is, by label; identifiers map to labels by their first part.
RESTRICTION = {
    "public-domain": 0.0, "cc0": 0.0, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "bsl": 0.1, "apache": 0.2, "cc-by": 0.2,
    "mpl": 0.5, "epl": 0.5, "lgpl": 0.6, "gpl": 0.8, "agpl": 0.9, "reserved": 1.0,
}
UNKNOWN = 0.5
#: Bytes that part words: all of ASCII but digits and lower-case letters.
_PARTS = bytes(c if chr(c).isalnum() and c < 128 and not 65 <= c <= 90 or c > 127 else 32 for c in range(256))
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:_-]*")


def automaton(phrases) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for p in phrases:
        found.add_word(p, p)
    found.make_automaton()
    return found


def label_of(identifier: str) -> str:
    """The label of a licence identifier: the longest known beginning of its parts, else the identifier."""
    parts = identifier.rstrip("+").split("-")
    for n in (2, 1):
        if (name := "-".join(parts[:n])) in RESTRICTION:
            return name
    return identifier


def evaluate(text: str, at: int = 0, stop: int | None = None) -> tuple[list[str], float | None]:
    """(labels, restriction) of the licence expression in a stretch of text, read up to the first word after
    it; the restriction of a broken one is None."""
    binds = {"with": 3, "and": 2, "or": 1}
    labels: list[str] = []
    values: list[float] = []
    held: list[str] = []

    def apply(op: str) -> bool:
        if len(values) < 2:
            return False
        b, a = values.pop(), values.pop()
        values.append({"with": a / 2, "and": max(a, b), "or": min(a, b)}[op])
        return True

    operand = True  # whether an operand is to come
    for found in _TOKEN.finditer(text, at, len(text) if stop is None else stop):
        token = found[0]
        if token == "(":
            if not operand:
                return labels, None
            held.append(token)
        elif token == ")":
            if operand:
                return labels, None
            while held and held[-1] != "(":
                if not apply(held.pop()):
                    return labels, None
            if not held:
                return labels, None
            held.pop()
        elif token in binds:
            if operand:
                return labels, None
            while held and held[-1] != "(" and binds[held[-1]] >= binds[token]:
                if not apply(held.pop()):
                    return labels, None
            held.append(token)
            operand = True
        else:
            if not operand:
                break  # words after a whole expression end it
            label = label_of(token)
            if not (held and held[-1] == "with"):  # the name of an exception is no licence
                labels.append(label)
            values.append(RESTRICTION.get(label, UNKNOWN))
            operand = False
    if operand or "(" in held:
        return labels, None
    while held:
        apply(held.pop())
    return labels, values[-1]


class Scanner:
    def __init__(self):
        self.phrases = automaton(f" {p} " for p in {**BASE, **NOTICES})
        self.tags = automaton(TAGS)

    def scan(self, text: str | None):
        """(words, base places, first and last of them, base labels, labels, score) of a text."""
        if not text:
            return 0, 0, None, None, "", "", 0.0
        raw = text.encode().lower()
        words = raw.translate(_PARTS).split()
        joined = (b" " + b" ".join(words) + b" ").decode()
        base, labels, places = set(), set(), []
        done = at = 0  # blanks are counted once, from match to match
        for end, key in self.phrases.iter(joined):
            phrase = key[1:-1]
            if phrase in BASE:
                start = end - len(key) + 1
                at += joined.count(" ", done, start) if start >= done else -joined.count(" ", start, done)
                done = start
                places.append(at)
                base.add(BASE[phrase])
            labels.add(BASE.get(phrase) or NOTICES[phrase])
        tagged, limits = 0, []
        if b":" in raw:
            low, stop = raw.decode(), -1
            for end, _ in self.tags.iter(low):
                if stop <= end:  # a line's end is sought once
                    stop = low.find("\n", end)
                    stop = len(low) if stop < 0 else stop
                found, limit = evaluate(low, end + 1, stop)
                labels.update(found)
                if limit is not None:
                    tagged += 1
                    limits.append(limit)
        limits += [RESTRICTION.get(x, UNKNOWN) for x in labels]
        score = (1 - 0.5 ** (len(labels) + tagged)) * (0.5 + 0.5 * max(limits)) if labels else 0.0
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score)


def scan(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for part in slices(batches, 1):
            cols = zip(*map(scanner.scan, part.column(1).to_pylist()))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, cols, kinds)], names)

    names = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_base long, first_word long, "
                           "last_word long, base_labels string, labels string, score double")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, labels and score of every document."""
    return scan(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")
