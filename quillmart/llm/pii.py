"""Operator 11: personal data, and terms that give it away, in DataFrame operations only.

Protected entities are values found by pattern (email, ip, card, phone) in every text.
A term near an entity can reveal it even after the value is gone.  How strongly is
estimated from the corpus: with p(e), p(t) the shares of documents that hold an entity
and a term, and p(e, t) that of documents with the term in the entity's context, the
term discloses PMI(e; t) = log2 p(e, t) / (p(e) p(t)) of the entity's information
IC(e) = -log2 p(e).  A term that discloses ``DISCLOSURE`` of it or more, and was met with
the entity in ``LEAST_TEXTS`` different texts, exceeds the threshold: it is generalised
to its first letters where those disclose less than that (their own share of documents
is counted alike), and removed where they don't.

Contexts are the ``CONTEXT`` characters on either side of a value, up to the next value
of its kind, cut back to whole words.  Spans are marked in the contexts of the entity
that they reveal; texts that hold no entity are left alone.

Counting: every document's distinct words and beginnings are counted (combined before
the shuffle), as are its distinct (entity, term) pairs; thresholds are joins of these
tables.  A document holds the terms of its contexts too where its own words don't show
them: one that a value is written against (``host10.0.0.1``), or whose small letters are
more than one character.  Documents never meet each other, and a value or term that a third of the
documents hold is one row a task after combining.

Patterns are the contract's, made possessive and tied to where a run begins, which
gives the same matches in time proportional to the text.

Defined results: a null or empty text has no spans; repeated rows have equal spans and
are counted each, but make one text for ``LEAST_TEXTS``; a null id is a value like any
other; an empty table gives no rows; other columns are not read by ``scan`` and are kept
by ``sanitise``; very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import checkpoint, fresh, table
from quillmart.llm.spans import digest, matches, places, rewritten

# The base patterns, in the order in which kinds are listed.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
BASE = {
    "email": EMAIL,
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a kind has no match: texts without it are not searched.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
KINDS = [*BASE, "generalise", "remove"]
GENERALISE, REMOVE = len(BASE), len(BASE) + 1

#: Characters on either side of a value.
CONTEXT = 80
#: Share of an entity's information that a term may not disclose.
DISCLOSURE = 0.9
#: Different texts that an entity and a term must share for their counts to mean anything.
LEAST_TEXTS = 3
#: Letters that a generalised term keeps.
STEM = 3
#: Terms: words of three characters or more that begin with a letter; emails are matched to be passed over.
WORD = r"(?<![\p{L}\p{N}])\p{L}[\p{L}\p{N}]{2,}+"
TOKEN = rf"(?:{EMAIL})|{WORD}"
MASK = "[{}]"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a digit text's checksum is right."""
    def add(total: Column, i: Column) -> Column:
        x = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(x > 4, x * 2 - 9).otherwise(x * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|\z)){4}\z")
    if kind == "card":
        return F.when(F.length(_digits(value)).between(14, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """One name for a value however it is written."""
    plain = F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)
    return F.sha2(F.concat(F.lit(kind + ":"), plain), 256)


def _values(text: Column, kind: str) -> Column:
    found = F.filter(matches(text, KINDS.index(kind), BASE[kind], CONTEXT), lambda s: _holds(kind, s["value"]))
    none = F.filter(found, lambda s: F.lit(False))
    return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(none) if kind in NEEDS else found


def _stem(term: Column) -> Column:
    return F.concat(F.left(term, F.lit(STEM)), F.lit("*"))


def _before(s: Column) -> Column:
    """The text before a value, without the word that CONTEXT may have cut."""
    return F.when(F.length(s["before"]) == CONTEXT, F.regexp_replace(s["before"], r"\A\S+", "")).otherwise(s["before"])


def _after(s: Column) -> Column:
    return F.when(F.length(s["after"]) == CONTEXT, F.regexp_replace(s["after"], r"\S+\z", "")).otherwise(s["after"])


def _terms(s: Column) -> Column:
    """The terms around a value."""
    words = F.regexp_extract_all(F.concat(_before(s), F.lit("\n"), _after(s)), F.lit(TOKEN), F.lit(0))
    return F.array_distinct(F.transform(F.filter(words, lambda w: ~F.contains(w, F.lit("@"))), F.lower))


def _events(terms: Column) -> Column:
    """The terms and their beginnings."""
    return F.concat(terms, F.array_distinct(F.transform(terms, _stem)))


def _own(text: Column) -> Column:
    """What a text's own words give."""
    return _events(F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), lambda w: F.length(w) >= STEM))


def _found(rows: DataFrame) -> DataFrame:
    """(id, th, row, base, contexts, more) of rows (id, text); contexts hold each value's entity and surroundings,
    ``more`` what their terms give beyond the text's own words."""
    text = F.col("text")
    values = {k: f"__{k}" for k in BASE}

    def context(kind: str) -> Callable[[Column], Column]:
        return lambda s: F.named_struct(F.lit("entity"), _entity(kind, s["value"]), F.lit("start"), s["start"], F.lit("end"), s["end"],
                                        F.lit("before"), s["before"], F.lit("after"), s["after"])

    slim = rows.select("id", "text", *[_values(text, k).alias(c) for k, c in values.items()])
    contexts = F.concat(*[F.transform(c, context(k)) for k, c in values.items()])
    base = places(F.concat(*[F.transform(c, lambda s: F.named_struct(
        F.lit("start"), s["start"], F.lit("end"), s["end"], F.lit("kind"), s["kind"])) for c in values.values()]))
    found = slim.select("id", "text", F.monotonically_increasing_id().alias("row"), base.alias("base"), contexts.alias("contexts"))
    said = _events(F.array_distinct(F.flatten(F.transform("contexts", _terms))))
    more = F.when(F.size("contexts") > 0, F.array_except(said, _own(text))).otherwise(F.array().cast("array<string>"))
    return found.select("id", F.xxhash64("text").alias("th"), "row", "base", "contexts", more.alias("more"))


def document_counts(texts: DataFrame, found: DataFrame) -> DataFrame:
    """(event, n_event): the documents that hold each word or term and each beginning of one."""
    events = texts.select(F.explode(_own(F.col("text"))).alias("event"))
    return events.union(found.select(F.explode("more"))).groupBy("event").agg(F.count(F.lit(1)).alias("n_event"))


def disclosures(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(entity, term, kind): what exceeds the threshold, and whether to generalise or remove it."""
    held = found.where(F.size("contexts") > 0)
    entities = held.select(F.explode(F.array_distinct(F.transform("contexts", lambda c: c["entity"]))).alias("entity"))
    entities = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    total = found.agg(F.count(F.lit(1)).alias("n"))

    def pairs_of(c: Column) -> Column:
        return F.transform(F.flatten(F.transform(_terms(c), lambda w: F.array(w, _stem(w)))),
                           lambda e: F.named_struct(F.lit("entity"), c["entity"], F.lit("event"), e))

    pairs = held.select("th", F.explode(F.array_distinct(F.flatten(F.transform("contexts", pairs_of)))).alias("p"))
    pairs = pairs.groupBy("p.entity", "p.event").agg(F.count(F.lit(1)).alias("n_both"), F.count_distinct("th").alias("texts"))
    pairs = pairs.where(F.col("texts") >= LEAST_TEXTS)
    known = pairs.join(document_counts(texts, found), "event").join(entities, "entity").crossJoin(F.broadcast(total))  # one row
    information = F.log2(F.col("n") / F.col("n_entity"))
    shared = F.log2(F.col("n_both") * F.col("n") / (F.col("n_entity") * F.col("n_event")))
    exceeds = (information > 0) & (shared >= DISCLOSURE * information)
    judged = checkpoint(known.where(exceeds).select("entity", "event"))
    terms = judged.where(~F.endswith("event", F.lit("*"))).withColumn("stem", _stem(F.col("event")))
    stems = judged.where(F.endswith("event", F.lit("*"))).select("entity", F.col("event").alias("stem"), F.lit(REMOVE).alias("kind"))
    return terms.join(stems, ["entity", "stem"], "left").select("entity", F.col("event").alias("term"), F.coalesce("kind", F.lit(GENERALISE)).alias("kind"))


def _scan(rows: DataFrame) -> DataFrame:
    """(id, th, row, base, spans) of rows (id, text)."""
    found = checkpoint(_found(rows))
    flagged = disclosures(found, rows)
    # Places are sought around the entities that some term gives away, and only there.
    held = found.where(F.size("contexts") > 0).select("row", F.explode("contexts").alias("c"))
    held = held.join(flagged.select(F.col("entity").alias("e")).distinct(), F.col("c.entity") == F.col("e"), "left_semi")
    sides = held.select("row", "c.entity", F.explode(F.array(
        F.struct((F.col("c.start") - F.length(_before(F.col("c")))).alias("at"), _before(F.col("c")).alias("piece")),
        F.struct(F.col("c.end").alias("at"), _after(F.col("c")).alias("piece")))).alias("side"))
    sides = sides.select("row", "entity", "side.at", F.explode(matches(F.col("side.piece"), 0, TOKEN)).alias("w"))
    said = sides.where(~F.contains(F.col("w.value"), F.lit("@"))).select(
        "row", "entity", F.lower("w.value").alias("term"), (F.col("at") + F.col("w.start")).alias("start"), (F.col("at") + F.col("w.end")).alias("end"))
    marked = said.join(flagged, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("kind").alias("kind"))
    marked = marked.groupBy(F.col("row").alias("m_row")).agg(F.collect_list(F.struct("start", "kind", "end")).alias("marked"))
    both = found.join(marked, F.col("row") == F.col("m_row"), "left")
    spans = F.array_sort(F.concat("base", F.coalesce("marked", F.slice("base", 1, 0))))
    return both.select("id", "th", "row", "base", spans.alias("spans"))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def scan(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, base, spans) of every row: arrays of struct<start, kind, end>, kind by its place in KINDS."""
    return _scan(_keyed(df, id_col, text_col)).select("id", "base", "spans")


def sanitise(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with values masked, terms cut to their first letters or removed."""
    found = _scan(_keyed(df, id_col, text_col)).where(F.size("spans") > 0)
    # Repeated rows have equal spans: one of them serves all.
    found = found.dropDuplicates(["id", "th"]).select("id", "th", "spans")
    row = fresh(df, "row")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row))
    key, text = F.col(f"{row}.`{id_col}`"), F.coalesce(F.col(f"{row}.`{text_col}`"), F.lit(""))
    joined = rows.join(found, key.eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("th")), "left")
    names = F.array(*[F.lit(MASK.format(k.upper())) for k in BASE])

    def new(s: Column, old: Column) -> Column:
        return (F.when(s["kind"] == GENERALISE, F.concat(F.left(old, F.lit(STEM)), F.lit("*")))
                .when(s["kind"] == REMOVE, F.lit("")).otherwise(F.element_at(names, F.least(s["kind"] + 1, F.lit(len(BASE))))))

    clean = F.when(F.col("spans").isNull(), F.col(f"{row}.`{text_col}`")).otherwise(rewritten(text, F.col("spans"), new))
    return joined.select(*[(clean if c == text_col else F.col(f"{row}.`{c}`")).alias(c) for c in df.columns])


def op11_information_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values and disclosing terms of every document."""
    found = scan(table(spark, sf_dir, "documents"), "doc_id", "text")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    return found.select(F.col("id").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(digest(F.col("base"), KINDS), 256).alias("base_sha256"), digest(F.col("spans"), KINDS).alias("spans"))
