"""Schema-evolving upsert of a frame into a table, as set-based Spark jobs.

Steps (all lazy until the caller writes):

1. ``infer_sync_schema`` -- column -> INTEGER | FLOAT | BOOL | TIMESTAMP | STRING.
2. ``evolve_schema`` -- add the incoming columns the target lacks (and the
   sync-time column) as typed NULLs; never drop or retype.
3. ``classify_changes`` -- incoming rows whose key is absent are *insert*; rows
   whose compared columns all equal the stored row are *unchanged*, the rest
   *update* (with the list of changed columns); target rows not in the batch
   are *keep*.
4. ``apply_upsert`` -- the new table: kept rows as stored, inserts as given,
   updates overwrite **only changed columns** and stamp the sync time;
   unchanged rows keep their old stamp.

Plan shape: one full outer join of target and batch on the key, two exchanges.
The check that keys are unique is a window count over the same partitioning, so
it costs no exchange of its own.  Nothing is collected.

Equality (``values_equal``), in order: both NULL -> equal, one NULL -> not;
'true'/'false' text (any case) is a boolean; nested values and text starting
with '{' or '[' that parses as JSON compare by content with sorted keys, where
1 and 1.0 differ; two booleans compare directly; values that read as numbers
(numbers, booleans as 1/0, numeric text) compare numerically; timestamps with
and without zone compare as UTC; dates compare as their text; anything else
compares as raw text of the same kind.

Divergences kept on purpose: NaN equals NaN (null-safe semantics), so a float
NULL does not look changed on every run; whole numbers compare exactly, not as
doubles, so ids beyond 2^53 stay apart.

JSON compares place by place: every number keeps its path and its kind, and of a key
that an object repeats the last value counts (``spark.sql.variant.allowDuplicateKeys``,
which ``apply_query_conf`` sets; without it such a text compares as raw text).

Writes never lose data silently: keys of another kind than the stored column's,
and values that the stored type cannot hold, raise.  Column names that differ
from a stored one only in case mean that column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.functions.scalars import coerce_bool, json_encode
from quillmart.sources.versions import BUCKET

SYNCED_AT = "_synced_at"
SYNC_TYPES = {
    "INTEGER": T.LongType(), "FLOAT": T.DoubleType(), "BOOL": T.BooleanType(),
    "TIMESTAMP": T.TimestampNTZType(), "STRING": T.StringType(),
}
# Text a number parser accepts: optional sign, digits with single underscores,
# optional fraction and exponent, inf/infinity/nan; surrounding blanks allowed.
NUMERIC_TEXT = (r"(?i)^\s*[+-]?(?:(?:\d(?:_?\d)*)?\.\d(?:_?\d)*(?:e[+-]?\d(?:_?\d)*)?"
                r"|\d(?:_?\d)*\.?(?:e[+-]?\d(?:_?\d)*)?|inf(?:inity)?|nan)\s*$")


def sync_type(name: str, dtype: T.DataType, synced_col: str = SYNCED_AT) -> str:
    if name == synced_col:
        return "TIMESTAMP"
    if isinstance(dtype, T.BooleanType):
        return "BOOL"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "INTEGER"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "FLOAT"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    return "STRING"


def infer_sync_schema(df: DataFrame, synced_col: str = SYNCED_AT) -> list[tuple[str, str]]:
    """(column, sync type) for every column, plus the sync-time column."""
    out = [(f.name, sync_type(f.name, f.dataType, synced_col)) for f in df.schema.fields]
    if synced_col not in df.columns:
        out.append((synced_col, "TIMESTAMP"))
    return out


def evolve_schema(target: DataFrame | None, incoming: DataFrame, synced_col: str = SYNCED_AT) -> DataFrame:
    """Target with the incoming columns it lacks (typed NULLs) and the sync column.

    ``target=None`` means the table does not exist yet: an empty frame with the
    inferred schema.
    """
    schema = infer_sync_schema(incoming, synced_col)
    if target is None:
        st = T.StructType([T.StructField(n, SYNC_TYPES[t], True) for n, t in schema])
        return incoming.sparkSession.createDataFrame([], st)
    have = {c.lower() for c in target.columns}
    extra = [F.lit(None).cast(SYNC_TYPES[t]).alias(n) for n, t in schema if n.lower() not in have]
    return target.select("*", *extra) if extra else target


def align_names(incoming: DataFrame, target: DataFrame | None) -> DataFrame:
    """``incoming`` with the stored spelling of columns that differ only in case."""
    stored = {c.lower(): c for c in (target.columns if target is not None else [])}
    return incoming.toDF(*[stored.get(c.lower(), c) for c in incoming.columns])


# ---------------------------------------------------------------- equality --

# Strings and numbers of JSON text.  Possessive, so that long strings neither backtrack nor recurse.
JSON_TOKENS = r'"(?:[^"\\]++|\\.)*+"|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?'
_NESTED = (T.StructType, T.ArrayType, T.MapType)
_STAMPS = (T.TimestampType, T.TimestampNTZType)


def utc_wall_clock(c: Column, dtype: T.DataType) -> Column:
    """A timestamp of either kind as zone-less UTC."""
    if isinstance(dtype, T.TimestampType):
        c = F.to_utc_timestamp(c, F.current_timezone())
    return c.cast("timestamp_ntz")


def canonical(c: Column, dtype: T.DataType) -> Column:
    """One comparable token per value (NULL for NULL): a struct (kind, number, whole, text).

    kind ``n`` with the exact whole number, or else the double, for booleans (1/0),
    numbers and numeric text; ``j`` with the JSON text re-serialised with sorted keys,
    where every scalar says its kind in its own place; ``d`` with a timestamp's UTC text; ``t`` with the text
    otherwise; ``o:<type>`` with the text form for other types.  Two values are equal
    when their tokens are equal (NULL = NULL).
    """
    def tok(kind: str, num=None, whole=None, text=None):
        return F.struct(F.lit(kind).alias("k"), (F.lit(None) if num is None else num).cast("double").alias("n"),
                        (F.lit(None) if whole is None else whole).cast("decimal(38,0)").alias("w"),
                        (F.lit(None) if text is None else text).cast("string").alias("t"))

    def number(x: Column):
        """Token of a double: whole where it is a whole number of up to 38 digits."""
        whole = F.when(x == F.rint(x), x.try_cast("decimal(38,0)"))
        return F.when(whole.isNotNull(), tok("n", whole=whole)).otherwise(tok("n", num=x))

    def json(text: Column):
        """Token of JSON text: strings become "s...", numbers "i..." or "f...", each where it stands, then keys are sorted."""
        typed = F.transform(
            F.regexp_extract_all(text, F.lit(JSON_TOKENS), F.lit(0)),
            lambda x: F.when(x.startswith('"'), F.concat(F.lit('"s'), F.substr(x, F.lit(2))))
            .when(x.rlike("[.eE]"), F.concat(F.lit('"f'), x.cast("double").cast("string"), F.lit('"')))
            .otherwise(F.concat(F.lit('"i'), F.when(x == "-0", F.lit("0")).otherwise(x), F.lit('"'))))
        gaps = F.split(text, JSON_TOKENS, -1)
        placed = F.array_join(F.zip_with(gaps, typed, lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))), "")
        return tok("j", text=F.to_json(F.try_parse_json(placed)))

    if isinstance(dtype, T.BooleanType):
        return F.when(c.isNotNull(), tok("n", whole=c.cast("int")))
    if isinstance(dtype, T.IntegralType):
        return F.when(c.isNotNull(), tok("n", whole=c))
    if isinstance(dtype, T.DecimalType):
        return F.when(c.isNotNull(), F.when(c == F.round(c, 0), tok("n", whole=c)).otherwise(tok("n", num=c)))
    if isinstance(dtype, T.NumericType):
        return F.when(c.isNotNull(), number(c.cast("double")))
    if isinstance(dtype, _STAMPS):
        return F.when(c.isNotNull(), tok("d", text=utc_wall_clock(c, dtype)))
    if isinstance(dtype, T.DateType):
        return F.when(c.isNotNull(), tok("t", text=c))
    if isinstance(dtype, _NESTED):
        text = json_encode(c, dtype)
        return F.when(c.isNotNull(), json(text))
    if isinstance(dtype, T.StringType):
        low = F.lower(c)
        parsed = F.try_parse_json(c)
        # cheap cast first; the strict-number pattern only runs when it succeeds
        plain = F.replace(F.trim(c), F.lit("_"), F.lit(""))
        double = plain.try_cast("double")
        whole = F.when(plain.rlike(r"^[+-]?\d+$"), plain.try_cast("decimal(38,0)"))
        return (F.when(c.isNull(), F.lit(None))
                .when(low == "true", tok("n", whole=F.lit(1)))
                .when(low == "false", tok("n", whole=F.lit(0)))
                .when((c.startswith("{") | c.startswith("[")) & parsed.isNotNull(), json(c))
                .when(double.isNotNull() & c.rlike(NUMERIC_TEXT),
                      F.when(whole.isNotNull(), tok("n", whole=whole)).otherwise(number(double)))
                .otherwise(tok("t", text=c)))
    return F.when(c.isNotNull(), tok(f"o:{dtype.simpleString()}", text=c))


def values_equal(a: Column, a_type: T.DataType, b: Column, b_type: T.DataType) -> Column:
    """The upsert's equality rule as one built-in expression (never NULL).

    Same-typed values that are identical skip canonicalisation.
    """
    full = canonical(a, a_type).eqNullSafe(canonical(b, b_type))
    if a_type == b_type:
        return F.when(a.eqNullSafe(b), F.lit(True)).otherwise(full)
    return full


DIGEST = "__row_digest"


def row_digest(types: dict[str, T.DataType], value=F.col) -> Column:
    """One long for a row: equal rows (by ``values_equal``, column by column) have equal digests.

    NULLs add nothing, so a column that a table gains leaves its rows' digests as they are.
    """
    out = F.lit(0).cast("long")
    for c, dtype in types.items():
        one = F.xxhash64(F.lit(c.lower()), canonical(value(c), dtype))
        out = out.bitwiseXOR(F.when(value(c).isNotNull(), one).otherwise(F.lit(0).cast("long")))
    return out


# ------------------------------------------------------------ classification --

def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _compared(incoming: DataFrame, key: str, synced_col: str) -> list[str]:
    return [c for c in incoming.columns if c not in (key, synced_col)]


def keyed_lookup(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Stored rows whose key occurs in ``keys`` (semi-join; keys never collected)."""
    return target.join(keys.select(key), key, "left_semi")


def _same_key(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """``incoming`` with its key in the stored key's type; keys of another kind raise."""
    stored, given = _types(target)[key], _types(incoming)[key]
    if stored != given and sync_type(key, stored, "") != sync_type(key, given, ""):
        raise ValueError(f"key {key!r} is {given.simpleString()}, the stored key {stored.simpleString()}")
    return incoming.withColumn(key, F.col(key).cast(stored)) if stored != given else incoming


def _once(df: DataFrame, key: str, what: str, within: Sequence[str] = ()) -> DataFrame:
    """``df``, raising where ``key`` is NULL or repeated (by the partitioning that the join uses)."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*within, key))
    said = F.concat(F.lit(f"{what}: key '{key}' must be unique and non-NULL; e.g. "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    bad = F.col(key).isNull() | (F.col("__n") > 1)
    return df.withColumn("__n", n).withColumn("__ok", F.when(bad, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))).drop("__n")


def _matched(target: DataFrame, incoming: DataFrame, key: str, synced_col: str, validate: bool = False,
             bucketed: tuple[Column, int] | None = None) -> DataFrame:
    """All keys of batch and target in one full outer join: the incoming row, the
    stored row's columns (``__old_*``), per-column ``__chg_*`` flags, ``__action`` of
    insert/update/unchanged/keep and ``__changed`` (changed column names).

    A target with a ``DIGEST`` column is compared by it first, if the batch has all of
    its columns.  ``bucketed`` (bucket of the key, number of partitions) deals both
    sides by the buckets of the table instead of by key, so that a bucket's rows end up
    in one task, which then writes one file for it."""
    inc = align_names(incoming, target)
    inc = _same_key(target, inc.drop(synced_col) if synced_col in inc.columns else inc, key)
    evolved = evolve_schema(target, inc, synced_col)
    cols = _compared(inc, key, synced_col)
    ti, tt = _types(inc), _types(evolved)
    stored = [c for c in target.columns if c not in (key, synced_col, DIGEST)]
    by_digest = DIGEST in tt and set(stored) <= set(cols)
    within, deal = [], {}
    if bucketed:
        within = [BUCKET]
        inc, evolved = (df.withColumn(BUCKET, bucketed[0]).repartition(bucketed[1], BUCKET) for df in (inc, evolved))
        deal = {"in": [F.col(BUCKET)], "old": [F.col(BUCKET).alias("__old_bucket")]}
    ok_in, ok_old = F.lit(True), F.lit(True)
    if validate:
        inc, evolved = _once(inc, key, "incoming", within), _once(evolved, key, "target", within)
        ok_in, ok_old = F.col("__ok"), F.col("__ok")
    old = evolved.select(F.col(key).alias("__key"), ok_old.alias("__hit"), *deal.get("old", []),
                         *[F.col(c).alias(f"__old_{c}") for c in tt if c != key])
    new = inc.select(*ti, ok_in.alias("__in"), *deal.get("in", []))
    # Comparing costs more than moving rows: by the key's partitions it runs on every
    # core, where a broadcast would leave it to the few tasks that scan a small batch.
    on = F.col(key) == F.col("__key")
    if bucketed:
        on = (F.col(BUCKET) == F.col("__old_bucket")) & on
    j = new.join(old.hint("merge"), on, "full_outer").withColumn(key, F.coalesce(key, "__key")).drop("__key")
    if bucketed:
        j = j.withColumn(BUCKET, F.coalesce(BUCKET, "__old_bucket")).drop("__old_bucket")
    both = F.col("__in").isNotNull() & F.col("__hit").isNotNull()
    if by_digest:
        j = j.withColumn("__digest", row_digest({c: ti[c] for c in cols}))
        both = both & ~F.col(f"__old_{DIGEST}").eqNullSafe(F.col("__digest"))
    j = j.select("*", *[(both & ~values_equal(F.col(f"__old_{c}"), tt[c], F.col(c), ti[c])).alias(f"__chg_{c}") for c in cols])
    any_chg = F.lit(False)
    for c in cols:
        any_chg = any_chg | F.col(f"__chg_{c}")
    action = (F.when(F.col("__hit").isNull(), F.lit("insert")).when(F.col("__in").isNull(), F.lit("keep"))
              .when(any_chg, F.lit("update")).otherwise(F.lit("unchanged")))
    changed = F.array_compact(F.array(*[F.when(F.col(f"__chg_{c}"), F.lit(c)) for c in cols]))
    return j.select("*", action.alias("__action"), changed.alias("__changed"))


def classify_changes(target: DataFrame, incoming: DataFrame, key: str,
                     synced_col: str = SYNCED_AT) -> DataFrame:
    """(key, action, changed_columns) for every incoming key and every kept key.

    ``changed_columns`` is a comma list in incoming column order for updates,
    NULL otherwise.
    """
    m = _matched(target, incoming, key, synced_col)
    return m.select(key, F.col("__action").alias("action"),
                    F.when(F.col("__action") == "update", F.array_join("__changed", ",")).alias("changed_columns"))


def cell_diff(target: DataFrame, incoming: DataFrame, key: str, synced_col: str = SYNCED_AT) -> DataFrame:
    """Long form (key, column_name, existing_value, new_value) of changed cells
    of updated rows; values rendered as text."""
    inc = align_names(incoming, target)
    cols, ti = _compared(inc, key, synced_col), _types(inc)
    m = _matched(target, incoming, key, synced_col).filter(F.col("__hit") & F.col("__in"))
    # One struct per changed cell: texts are made for changed cells only.
    cells = F.array_compact(F.array(*[
        F.when(F.col(f"__chg_{c}"), F.struct(F.lit(c).alias("column_name"), F.col(f"__old_{c}").cast("string").alias("existing_value"),
                                             json_encode(F.col(c), ti[c]).cast("string").alias("new_value"))) for c in cols]))
    # explode_outer + NULL filter: plain explode makes the optimizer infer size(cells) > 0
    # below it, which evaluates every comparison a second time inside the join condition.
    return m.select(key, F.explode_outer(cells).alias("cell")).filter(F.col("cell").isNotNull()).select(key, "cell.*")


def upsert_summary(classified: DataFrame) -> DataFrame:
    """Row counts per action."""
    return classified.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def _write_value(c: Column, src_type: T.DataType, dst_type: T.DataType, name: str) -> Column:
    """An incoming value converted to the stored column's type; a lossy conversion raises."""
    if src_type == dst_type:
        return c
    if isinstance(dst_type, T.BooleanType):
        return coerce_bool(c, src_type)
    if isinstance(dst_type, T.StringType):
        return json_encode(c, src_type).cast("string")
    if isinstance(dst_type, T.TimestampNTZType) and isinstance(src_type, _STAMPS):
        return utc_wall_clock(c, src_type)
    if isinstance(src_type, T.NumericType) and isinstance(dst_type, T.NumericType):
        value = c.try_cast(dst_type)
    else:
        value = c.cast("string").try_cast(dst_type)
        if isinstance(dst_type, T.NumericType):
            value = F.coalesce(value, c.cast("string").try_cast("double").try_cast(dst_type))
    exact = value.isNotNull()
    if isinstance(dst_type, T.NumericType):
        exact = exact & values_equal(value, dst_type, c, src_type)
    said = F.concat(F.lit(f"column '{name}': cannot store as {dst_type.simpleString()} without loss: "), c.cast("string"))
    return F.when(c.isNull(), F.lit(None).cast(dst_type)).when(exact, value).otherwise(F.raise_error(said).cast(dst_type))


ACTION = "__action"


def _same_token(given: T.DataType, stored: T.DataType) -> bool:
    """Whether a value keeps its token when it is stored (text parsed into a timestamp doesn't)."""
    return given == stored or isinstance(stored, (T.StringType, T.NumericType, T.BooleanType)) or (
        isinstance(given, _STAMPS) and isinstance(stored, _STAMPS))


def upsert_rows(target: DataFrame | None, incoming: DataFrame, key: str, as_of, synced_col: str = SYNCED_AT,
                validate: bool = False, bucketed: tuple[Column, int] | None = None) -> DataFrame:
    """The table after the upsert, with each row's action in ``__action``.

    A target with a ``DIGEST`` column comes out with the digests of its new rows."""
    incoming = align_names(incoming, target)
    inc = incoming.drop(synced_col) if synced_col in incoming.columns else incoming
    evolved = evolve_schema(target, inc, synced_col)
    tt, ti = _types(evolved), _types(inc)
    stamp = F.lit(as_of).cast(tt[synced_col])
    m = _matched(evolved, inc, key, synced_col, validate, bucketed)
    by_digest = "__digest" in m.columns and all(_same_token(ti[c], tt[c]) for c in ti if c != key)
    action, fresh = F.col(ACTION), F.col(ACTION).isin("insert", "update")
    out = []
    for c in evolved.columns:
        if c == DIGEST:
            # What is written equals what was given, so the batch's digest is the new row's.
            new = F.col("__digest") if by_digest else F.lit(None)
            out.append(F.when(fresh, new).otherwise(F.col(f"__old_{c}")).alias(c))
        elif c == key:
            out.append(F.col(key))
        elif c == synced_col:
            out.append(F.when(fresh, stamp).otherwise(F.col(f"__old_{c}")).alias(c))
        elif c in ti:
            new = _write_value(F.col(c), ti[c], tt[c], c)
            out.append(F.when((action == "insert") | F.col(f"__chg_{c}"), new).otherwise(F.col(f"__old_{c}")).alias(c))
        else:
            out.append(F.col(f"__old_{c}").alias(c))
    rows = m.select(*out, ACTION, *([BUCKET] if bucketed else []))
    if DIGEST not in tt or by_digest:
        return rows
    valued = {c: t for c, t in tt.items() if c not in (key, synced_col, DIGEST)}
    return rows.withColumn(DIGEST, F.coalesce(DIGEST, row_digest(valued)))


def apply_upsert(target: DataFrame | None, incoming: DataFrame, key: str, as_of,
                 synced_col: str = SYNCED_AT) -> DataFrame:
    """The table after the upsert (to be written as a new snapshot)."""
    return upsert_rows(target, incoming, key, as_of, synced_col).drop(ACTION)


def json_encoded(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nested columns rendered as JSON text (what the upsert stores in STRING columns)."""
    t = _types(df)
    return df.select(*[json_encode(F.col(c), t[c]).alias(c) if (columns is None or c in columns)
                       else F.col(c) for c in df.columns])
