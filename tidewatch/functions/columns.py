"""Column helpers: months, labels, casts, full matches, guarded rates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NO_INFORMATION = "(정보 없음)"


def month_of(date: Column) -> Column:
    """First day of a date's month, as a date."""
    return F.trunc(date, "month")


def month_index(date: Column) -> Column:
    """Months since year 0, for frames over months."""
    return F.year(date) * 12 + F.month(date)


def year_month(date: Column) -> Column:
    """``yyyy-MM`` of a date, or of a ``yyyyMMdd`` string; null if neither."""
    return F.date_format(F.coalesce(F.try_to_date(date.cast("string"), "yyyy-MM-dd"), F.try_to_date(date.cast("string"), "yyyyMMdd")), "yyyy-MM")


def combo(first: Column, second: Column, missing: str = NO_INFORMATION) -> Column:
    """``first - second``, or a label if either is null."""
    return F.when(first.isNull() | second.isNull(), F.lit(missing)).otherwise(F.concat_ws(" - ", first, second))


def full_match(text: Column, patterns: Sequence[str]) -> Column:
    """True if the whole text matches one of the patterns."""
    return text.rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$")


def cast_date(text: Column) -> Column:
    """``yyyyMMdd`` or ``yyyy-MM-dd``; null otherwise."""
    return F.coalesce(F.try_to_date(text, "yyyyMMdd"), F.try_to_date(text, "yyyy-MM-dd"))


def cast_integer(text: Column) -> Column:
    """A number rounded to an integer; null if it is none."""
    return F.round(text.try_cast("decimal(38,10)")).try_cast("bigint")


def cast_flag(text: Column, true: str, false: str) -> Column:
    """Booleans by their codes; other codes are null."""
    return F.when(text == true, F.lit(True)).when(text == false, F.lit(False))


def cast_columns(df: DataFrame, types: dict[str, str], codes: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Cast by declared type: date, integer, boolean (needs codes), anything else passes."""
    out = {}
    for name, kind in types.items():
        kind = kind.lower()
        if kind == "date":
            out[name] = cast_date(F.col(name))
        elif kind in ("int", "integer"):
            out[name] = cast_integer(F.col(name))
        elif kind == "boolean":
            if name not in (codes or {}):
                raise ValueError(f"no codes for the boolean column {name}")
            out[name] = cast_flag(F.col(name), *codes[name])
    return df.withColumns(out) if out else df


def share(part: Column, whole: Column, digits: int | None = 2, scale: float = 100.0) -> Column:
    """``part / whole`` times ``scale``; null where the whole is zero."""
    value = part * F.lit(scale) / F.nullif(whole, F.lit(0))
    return F.round(value, digits) if digits is not None else value


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def qualify(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of each key by ``order``."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_k", number).where(F.col("_k") <= k).drop("_k")


def count_distinct_over(df: DataFrame, column: str, keys: Sequence[str], out: str) -> DataFrame:
    """``COUNT(DISTINCT column) OVER (PARTITION BY keys)`` as a column; nulls do not count, null keys are a key.

    An aggregate joined back: no task holds the set of a key's values.
    """
    counts = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.countDistinct(column).cast("int").alias(out))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(counts, same).drop(*[f"_{k}" for k in keys])


def select_distinct(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Named columns under their aliases, distinct; no columns: the frame as it is."""
    return df.select(*[F.col(n).alias(a) for n, a in columns]).distinct() if columns else df


def sanitise(name: str) -> str:
    """A column name without ``: - .`` and spaces."""
    return name.translate(str.maketrans(":-. ", "____"))
