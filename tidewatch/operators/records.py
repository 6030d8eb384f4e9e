"""Record operators: deduplication, imputation, history (SCD2), upsert, steps."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import qualify


def changed_latest(df: DataFrame, keys: Sequence[str], order: Column, hash_col: str, ties: Sequence[Column] = ()) -> DataFrame:
    """Each key's latest row, if it is the first or its hash differs from the one before."""
    w = Window.partitionBy(*keys).orderBy(order, *ties)
    df = df.withColumns({"_k": F.row_number().over(w), "_before": F.lead(hash_col).over(w)})
    return df.where((F.col("_k") == 1) & ~F.col("_before").eqNullSafe(F.col(hash_col))).drop("_k", "_before")


def changed_this_month(df: DataFrame, keys: Sequence[str], time: str, hash_col: str, as_of: Column, zone: str = "Asia/Seoul", ties: Sequence[Column] = ()) -> DataFrame:
    """:func:`changed_latest` by time, if that row came in the month of ``as_of``; both times are UTC, the month is that of a zone."""
    month = lambda t: F.date_trunc("month", F.from_utc_timestamp(t, zone))
    return changed_latest(df, keys, F.desc(time), hash_col, ties).where(month(F.col(time)) == month(as_of))


def scope_events(df: DataFrame, device_class: str = "device_class", texts: str = "texts", wanted: str = "3") -> DataFrame:
    """Events of devices of a class that have a text."""
    return df.where((F.col(device_class) == wanted) & (F.coalesce(F.size(texts), F.lit(0)) > 0))


def scope_devices(df: DataFrame, classes: str = "classes", wanted: str = "3") -> DataFrame:
    """Devices one of whose classes is the wanted one."""
    return df.where(F.coalesce(F.array_contains(classes, wanted), F.lit(False)))


def trusted(df: DataFrame, name: str = "manufacturer_name", confidence: str = "match_confidence", levels: Sequence[str] = ("HIGH", "MEDIUM", "LOW")) -> DataFrame:
    """Rows with a maker and a sufficient match."""
    return df.where(F.col(name).isNotNull() & F.col(confidence).isin(*levels))


def quality_filter(df: DataFrame, key: str, report: Sequence[str], event_flag: Column, event: Column, unit: str, order: Sequence[Column] = ()) -> DataFrame:
    """Trusted rows, of repeated reports the first, whose flag fits the event, one for each key and unit.

    Rows with all of ``report`` are the same report if these are equal; all but
    the one of smallest key go, with every row of their keys.  ``order`` settles
    which row of a key and unit stays.
    """
    good = trusted(df)
    complete = reduce(lambda d, c: d.where(F.col(c).isNotNull()), report, good)
    gone = beyond_first(complete, report, [F.asc(key)]).select(key)
    logical = without(good, gone, [key]).where(event_flag == event)
    return qualify(logical, [key, unit], [F.asc(key), *order])


def beyond_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows of each key after its first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") > 1).drop("_k")


def without(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``gone`` (NOT EXISTS: null keys stay)."""
    return df.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def not_in(df: DataFrame, column: str, gone: DataFrame, gone_column: str) -> DataFrame:
    """SQL ``NOT IN``: any null among ``gone`` empties the result; null values drop out unless ``gone`` is empty."""
    probe = gone.agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col(gone_column).isNull(), 1)).alias("_nulls"))
    rows = df.crossJoin(F.broadcast(probe)).where((F.col("_nulls") == 0) & (F.col(column).isNotNull() | (F.col("_n") == 0))).drop("_n", "_nulls")
    return rows.join(gone.select(F.col(gone_column).alias("_gone")).distinct(), F.col(column) == F.col("_gone"), "left_anti")


def mode_of(df: DataFrame, group: str, target: str) -> DataFrame:
    """The most frequent value of each group, nulls aside; of equal counts the smallest value."""
    seen = df.where(F.col(target).isNotNull() & F.col(group).isNotNull()).groupBy(group, target).agg(F.count(F.lit(1)).alias("_n"))
    best = qualify(seen, [group], [F.desc("_n"), F.asc(target)])
    return best.select(group, F.col(target).alias("_mode"))


def impute_mode(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Fill each target by its group's mode; the modes come from the unfilled rows."""
    source = df
    for group, target in rules:
        modes = mode_of(source, group, target)
        df = df.join(modes, group, "left").withColumn(target, F.coalesce(target, "_mode")).drop("_mode").select(*source.columns)
    return df


def add_history(df: DataFrame, effective: str, batch: str, system: str, ingest: Column) -> DataFrame:
    """History columns of a new batch; the source column of the effective date goes."""
    return df.withColumns({
        "ingest_time": ingest, "is_current": F.lit(True), "effective_from": F.col(effective), "effective_to": F.lit(None).cast("date"),
        "source_batch_id": F.lit(batch), "source_system": F.lit(system),
    }).drop(effective)


def upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows replace the target's rows of equal key; null keys never match."""
    kept = target.join(staged.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(staged, allowMissingColumns=True)


def expire(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Close the current rows that a later current row of their key replaces.

    They end the day before the latest start.  Rows of equal start stay
    current, and so do rows with a null key.
    """
    latest = F.max(F.when(F.col("is_current"), F.col("effective_from"))).over(Window.partitionBy(*keys))
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    old = F.coalesce(named & F.col("is_current") & (F.col("effective_from") < F.col("_latest")), F.lit(False))
    df = df.withColumn("_latest", latest).withColumn("_old", old)
    return df.withColumns({
        "effective_to": F.when(F.col("_old"), F.date_sub("_latest", 1)).otherwise(F.col("effective_to")),
        "is_current": F.when(F.col("_old"), F.lit(False)).otherwise(F.col("is_current")),
    }).drop("_latest", "_old")


def filter_chain(sources: dict[str, DataFrame], steps: Sequence[tuple[str, str, Sequence[Column], Callable[[DataFrame], DataFrame] | None]]) -> DataFrame:
    """Named filter steps, each over a source or an earlier step; the last one's rows."""
    known, out = dict(sources), None
    for name, source, tests, after in steps:
        out = reduce(lambda d, t: d.where(t), tests, known[source])
        out = after(out) if after else out
        known[name] = out
    if out is None:
        raise ValueError("no step")
    return out


def run_steps(df: DataFrame, steps: Sequence[tuple[str, int, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Registered steps in their order; a negative number skips a step and all after it."""
    for _, number, step in steps:
        if number < 0:
            break
        df = df.transform(step)
    return df
