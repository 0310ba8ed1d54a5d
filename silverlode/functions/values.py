"""Value semantics that every layer shares: blanks, coercion, canonical content, ordering."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
#: What a text has to look like before Spark may cast it: the contract decides, not the parser's leniency.
GUARDS = {
    "int": r"^[+-]?\d+$",
    "bigint": r"^[+-]?\d+$",
    "double": rf"^({_NUMBER}|[+-]?(?i:nan|inf|infinity))$",
    "decimal": rf"^{_NUMBER}$",
    "date": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "timestamp": r"^\d{4}-\d{1,2}-\d{1,2}([T ].*)?$",
}
TRUE_WORDS = ("true", "yes", "y", "1")
FALSE_WORDS = ("false", "no", "n", "0")


#: What Java's \\s matches; trimming it is much cheaper than a pattern.
BLANKS = " \t\n\x0b\f\r"


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def nullish(c: Column) -> Column:
    """Null, empty or white space alone, tabs and line ends included."""
    return c.isNull() | (stripped(c) == "")


def coerce(c: Column, kind: str) -> Column:
    """A landed text as its contract type; null where it is blank or does not fit."""
    if kind == "string":
        return F.when(nullish(c), None).otherwise(c)
    text = stripped(c)
    if kind == "boolean":
        return F.when(F.lower(text).isin(*TRUE_WORDS), True).when(F.lower(text).isin(*FALSE_WORDS), False)
    return F.when(text.rlike(GUARDS[kind.split("(")[0]]), text).try_cast(kind)


def spark_type(kind: str) -> T.DataType:
    if m := re.fullmatch(r"decimal\((\d+),(\d+)\)", kind):
        return T.DecimalType(int(m[1]), int(m[2]))
    return {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType()}[kind]


def raw_schema(columns: dict[str, str], extra: tuple[str, ...] = ()) -> T.StructType:
    """All texts, as landed."""
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, *extra)])


def typed_schema(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(c, spark_type(t)) for c, t in columns.items()])


def content(columns: list[str]) -> Column:
    """Content of a row as text: fields by name, nulls kept, so that it orders totally."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def record_hash(columns: list[str], exclude: tuple[str, ...] = ()) -> Column:
    return F.sha2(content([c for c in columns if c not in exclude]), 256)


def earliest_first(columns: list[str] | tuple[str, ...]) -> list[Column]:
    """Ordering by a sequence, nulls lowest."""
    return [F.col(c).asc_nulls_first() for c in columns]


def ingestion_order(file: Column, index: Column) -> Column:
    """One text that orders rows by file and position: nine digits, or more behind a tilde for each digit more, which sorts after any digit."""
    digits = F.coalesce(index.cast("string"), F.lit("0"))
    beyond = F.greatest(F.length(digits) - 9, F.lit(0))
    return F.concat(F.coalesce(file, F.lit("")), F.lit("#"), F.repeat(F.lit("~"), beyond), F.lpad(digits, F.greatest(F.length(digits), F.lit(9)), F.lit("0")))


def lateness(ts: Column, as_of: Column, days: int) -> Column:
    """``beyond_window`` where strictly older than the window; nulls and the future are in it."""
    return F.when(ts < as_of - F.make_interval(days=F.lit(days)), "beyond_window").otherwise("in_window")
