"""Scalar helpers with the NULL and parsing behaviour the marts rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value taken from the source job: a project id follows "/project/" or
# "/0/" and ends at "/" or at the end of the text.  "\z" rather than "$" because
# Java's "$" also matches before a trailing newline.
PROJECT_URL_PATTERN = r"(?:/project/|/0/)(\d+)(?:/|\z)"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_id(c, pattern: str = PROJECT_URL_PATTERN) -> Column:
    """First capture group of ``pattern`` or NULL when nothing matches."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, 1), F.lit(""))


def full_name(first, last) -> Column:
    """``first || ' ' || last``; NULL when either part is NULL."""
    return F.concat(as_col(first), F.lit(" "), as_col(last))


def json_first_scalar(c) -> Column:
    """Scalar at ``$[0]`` of JSON text as a string.

    NULL for invalid JSON, a missing element, JSON null, and objects/arrays.
    """
    v = F.try_parse_json(as_col(c))
    elem = F.variant_get(v, "$[0]", "variant")
    kind = F.schema_of_variant(elem)
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(nested, F.lit(None).cast("string")).otherwise(
        F.variant_get(v, "$[0]", "string"))


def zero_pad(c, width: int = 3) -> Column:
    """Integer code as text padded with zeros to ``width``; longer codes are kept whole."""
    return F.format_string(f"%0{width}d", as_col(c).cast("bigint"))


def coerce_bool(c, dtype: T.DataType) -> Column:
    """Coerce a column to BOOLEAN the way the upsert writes BOOL columns.

    booleans stay; 'true'/'false' in any case map to True/False; numbers map to
    ``x != 0``.  Any other text is an error rather than a silent NULL.
    """
    x = as_col(c)
    if isinstance(dtype, T.BooleanType):
        return x
    if isinstance(dtype, T.NumericType):
        return F.when(x.isNull(), F.lit(None).cast("boolean")).otherwise(x != 0)
    if isinstance(dtype, T.StringType):
        low = F.lower(x)
        return (F.when(x.isNull(), F.lit(None).cast("boolean"))
                .when(low == "true", F.lit(True))
                .when(low == "false", F.lit(False))
                .otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), x)).cast("boolean")))
    raise TypeError(f"cannot coerce {dtype.simpleString()} to boolean")


def json_encode(c, dtype: T.DataType) -> Column:
    """Nested values become JSON text for STRING columns; NULL fields are kept."""
    x = as_col(c)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(x, {"ignoreNullFields": "false"})
    return x
