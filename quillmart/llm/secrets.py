"""Operator 5: secret scan with multipart credential linking, in DataFrame operations only.

Strong spans (``assign``, ``access``, ``hex``) are found by pattern in every text and
always kept.  Weak candidates (``user``: an account or client identifier; ``key``: a
long mixed token; ``endpoint``: a URL, or an address or a host name of one or more
labels with a port) are kept only where the parts of a credential come together: a user or an endpoint needs a secret part (an
assignment, a hex run or a key) and a key needs an access part (an access id, a user
or an endpoint) that it does not overlap, however far away in the same scope.  Scopes
are the paragraphs of a text.  The link is a semi join of the weak candidates with one
row per scope, which says how early its secret and access parts end and how late they
start, so no pairs are made.

Positions are code points, spans run by start, then kind (see ``spans``).  Patterns try
each run of characters from one place only, so that time follows the length of a text.

Defined results: a null or empty text has no spans; very long texts are read whole;
of spans that share a start the kind listed first comes first; repeated rows have equal spans;
a null id is a value like any other; an empty table gives no rows; other columns are
not read by ``scan`` and are kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import checkpoint, table
from quillmart.llm.spans import digest, matches, places, rewritten, scoped

#: Characters between two parts of one credential, at most: any number, their scope alone bounds them.
REACH = float("inf")

# The base patterns, in the order in which kinds are listed.
BASE = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
}
#: The value of an assignment: what is left without its keyword, quotes, blanks and sign.
ASSIGN_HEAD = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
#: Where a host or scheme may begin: at the start of a run or after its first few signs, so that each run is tried once.
RUN_START = r"(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])(?>(?<![+.-])|(?<=(?:^|[^A-Za-z0-9_+.-])[+.-]{1,8}))"
# Runs are taken to their end, however long: no upper bounds but those of addresses and ports.
WEAK = {
    "user": r"""\b(?i:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""",
    "key": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}",
    "endpoint": RUN_START + r"""(?:[A-Za-z0-9_][A-Za-z0-9_+.-]*://[^\s"'<>]{4,}"""
                r"""|(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|(?:[A-Za-z0-9_][A-Za-z0-9_.-]*\.)?[A-Za-z][A-Za-z0-9_-]*):[0-9]{2,5}\b)""",
}
#: What a key must hold besides: a lower-case and an upper-case letter and a digit.
KEY_PARTS = ("[a-z]", "[A-Z]", "[0-9]")
#: What parts scopes: the end of a blank line.
PARAGRAPH = r"\n[\x20\t\r]*\n"
KINDS = [*BASE, *WEAK]
SECRET_PARTS, ACCESS_PARTS = ("assign", "hex", "key"), ("access", "user", "endpoint")


def base_spans(text: Column) -> Column:
    """The strong spans that pass their length test."""
    kept = {
        "assign": lambda s: F.length(F.regexp_replace(s["value"], ASSIGN_HEAD, "")) >= 6,
        "access": lambda s: F.length(s["value"]) >= 20,
        "hex": lambda s: s["end"] - s["start"] >= 24,
    }
    return F.concat(*[F.filter(matches(text, KINDS.index(k), p), kept[k]) for k, p in BASE.items()])


def _found(rows: DataFrame) -> DataFrame:
    """(id, th, base, weak, breaks) of rows (id, th, text): spans, and paragraph ends where there are weak ones."""
    text = F.col("text")
    found = {k: matches(text, KINDS.index(k), p) for k, p in WEAK.items()}
    found["key"] = F.filter(found["key"], lambda s: s["value"].rlike(KEY_PARTS[0]) & s["value"].rlike(KEY_PARTS[1])
                            & s["value"].rlike(KEY_PARTS[2]))
    slim = rows.select("id", "th", "text", places(base_spans(text)).alias("base"), places(F.concat(*found.values())).alias("weak"))
    breaks = F.when(F.size("weak") > 0, F.transform(matches(text, 0, PARAGRAPH), lambda b: b["end"]))
    return slim.select("id", "th", "base", "weak", F.coalesce(breaks, F.array().cast("array<int>")).alias("breaks"))


def linked(found: DataFrame) -> DataFrame:
    """(id, th, more): the weak candidates that complementary parts confirm, by text."""
    parts = found.where(F.size("weak") > 0).select("id", "th", F.explode(scoped(F.concat(F.col("base"), F.col("weak")), F.col("breaks"))).alias("s"))
    parts = parts.select("id", "th", "s.scope", "s.start", "s.end", "s.kind").distinct()
    secret = F.col("kind").isin([KINDS.index(k) for k in SECRET_PARTS])
    access = F.col("kind").isin([KINDS.index(k) for k in ACCESS_PARTS])
    # A part that ends before a candidate or starts after it exists if the first to end or the last to start does.
    ends = [f(F.when(side, F.col(c))).alias(f"{name}_{c}") for name, side in (("secret", secret), ("access", access))
            for f, c in ((F.min, "end"), (F.max, "start"))]
    scopes = parts.groupBy(F.col("id").alias("o_id"), F.col("th").alias("o_th"), F.col("scope").alias("o_scope")).agg(*ends)
    scopes = scopes.where(F.col("secret_end").isNotNull() & F.col("access_end").isNotNull())

    def apart(name: str) -> Column:
        return (F.col(f"{name}_end") <= F.col("start")) | (F.col(f"{name}_start") >= F.col("end"))

    weak = parts.where(F.col("kind") >= len(BASE))
    met = weak.join(
        scopes, F.col("id").eqNullSafe(F.col("o_id")) & (F.col("th") == F.col("o_th")) & (F.col("scope") == F.col("o_scope"))
        & F.when(access, apart("secret")).otherwise(apart("access")), "left_semi")
    return met.groupBy("id", "th").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more"))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def scan(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, base, spans) of every row: arrays of struct<start, kind, end>, kind by its place in KINDS.

    The texts are read once; what is found in them is checkpointed, and only that is joined.
    """
    found = checkpoint(_found(_keyed(df, id_col, text_col)))
    more = linked(found).select(F.col("id").alias("m_id"), F.col("th").alias("m_th"), "more")
    both = found.join(more, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("th") == F.col("m_th")), "left")
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.slice("base", 1, 0))))
    return both.select("id", "th", "base", spans.alias("spans"))


def redact(df: DataFrame, id_col: str, text_col: str, mask: str = "[SECRET]") -> DataFrame:
    """``df`` with every span of its texts replaced by ``mask``; overlapping spans become one."""
    found = scan(df, id_col, text_col).where(F.size("spans") > 0).select("id", "th", "spans").dropDuplicates(["id", "th"])
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    key = F.col(f"row.`{id_col}`")
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    scanned = rows.join(found, key.eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("th")), "left")
    new = rewritten(text, F.col("spans"), lambda span, old: F.lit(mask))
    clean = F.when(F.col("spans").isNull(), F.col(f"row.`{text_col}`")).otherwise(new)
    return scanned.select(*[(clean if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in df.columns])


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and linked spans of every document."""
    found = scan(table(spark, sf_dir, "documents"), "doc_id", "text")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    return found.select(F.col("id").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(digest(F.col("base"), KINDS), 256).alias("base_sha256"), digest(F.col("spans"), KINDS).alias("spans"))
