"""Monthly metric tables with the ``ALL`` roll-up, and their long form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import count_if, month_of, share

SEVERE = ("Death", "Serious Injury")
EXCLUDED_DEFECTS = ("Unknown", "Other")
WINDOWS = (3, 6, 9, 12)


def latest_month(dated: DataFrame, date: str = "date_received") -> Column:
    """First day of the latest month, as a scalar subquery: it is known before the rows are read, so it filters the scan."""
    return dated.agg(month_of(F.max(date))).scalar()


def trailing(reports: DataFrame, window: int, date: str = "date_received", dated: DataFrame | None = None) -> DataFrame:
    """Reports of the last ``window`` months up to the latest month of the data, with ``metric_date``.

    ``dated`` is where the latest month is looked up: a table with the dates
    alone spares the joins behind the reports.
    """
    as_of = latest_month(reports if dated is None else dated, date)
    inside = (F.col(date) >= F.add_months(as_of, -(window - 1))) & (F.col(date) < F.add_months(as_of, 1))
    return reports.where(inside).withColumn("metric_date", month_of(F.col(date)))


def rolled_up(rows: DataFrame, entity: str | None, measures: list[Column], alias: str | None = None) -> DataFrame:
    """Measures by month, manufacturer and entity, and over all manufacturers as ``ALL``.

    One pass with grouping sets: distinct counts are computed anew for ``ALL``,
    and a null manufacturer stays apart from it.
    """
    keys = ["metric_date", "manufacturer_name"] + ([entity] if entity else [])
    sets = [[F.col(k) for k in keys], [F.col(k) for k in keys if k != "manufacturer_name"]]
    out = rows.groupingSets(sets, *keys).agg(F.grouping("manufacturer_name").alias("_all"), *measures)
    out = out.withColumn("manufacturer", F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col("manufacturer_name")))
    names = [c for c in out.columns if c not in ("_all", "manufacturer", *keys)]
    head = ["metric_date", "manufacturer"] + ([F.col(entity).cast("string").alias(alias or entity)] if entity else [])
    return out.select(*head, *names)


def _harm(label: str) -> Column:
    return count_if(F.col("patient_harm") == label).cast("double")


_reports = lambda: F.countDistinct("report_key")
_severe_rate = lambda: share(count_if(F.col("patient_harm").isin(*SEVERE)), _reports()).alias("severe_harm_rate")
_confirmed_rate = lambda: share(count_if(F.col("defect_confirmed")), _reports()).alias("defect_confirmed_rate")


def cluster_monthly(reports: DataFrame, window: int = 12, dated: DataFrame | None = None) -> DataFrame:
    rows = trailing(reports, window, dated=dated).where(F.col("cluster") != -1)
    measures = [
        _reports().cast("double").alias("report_count"),
        _harm("Death").alias("death_count"),
        _harm("Serious Injury").alias("serious_injury_count"),
        _harm("Minor Injury").alias("minor_injury_count"),
        _harm("No Apparent Injury").alias("no_harm_count"),
        _severe_rate(),
        count_if(F.col("defect_confirmed")).cast("double").alias("defect_confirmed_count"),
        _confirmed_rate(),
    ]
    return rolled_up(rows, "cluster", measures, "cluster_id")


def defect_monthly(reports: DataFrame, window: int = 12, dated: DataFrame | None = None) -> DataFrame:
    rows = trailing(reports, window, dated=dated).where(~F.col("defect_type").isin(*EXCLUDED_DEFECTS))
    return rolled_up(rows, "defect_type", [_reports().cast("double").alias("report_count")])


def product_monthly(reports: DataFrame, window: int = 12, dated: DataFrame | None = None) -> DataFrame:
    measures = [_reports().cast("double").alias("report_count"), _harm("Death").alias("death_count"), _severe_rate()]
    return rolled_up(trailing(reports, window, dated=dated), "product_code", measures)


def overview_monthly(reports: DataFrame, window: int = 12, dated: DataFrame | None = None) -> DataFrame:
    measures = [_reports().cast("double").alias("total_report_count"), _harm("Death").alias("death_count"), _harm("Serious Injury").alias("serious_injury_count"), _severe_rate(), _confirmed_rate()]
    return rolled_up(trailing(reports, window, dated=dated), None, measures)


def to_long(wide: DataFrame, grain: str, entity: str | None, source: str) -> DataFrame:
    """One row per metric; null values go."""
    fixed = ["metric_date", "manufacturer"] + ([entity] if entity else [])
    values = [c for c in wide.columns if c not in fixed]
    long = wide.unpivot(fixed, values, "metric_name", "metric_value").where(F.col("metric_value").isNotNull())
    value = F.col(entity) if entity else F.lit("ALL")
    return long.select("metric_date", F.lit(grain).alias("grain"), "manufacturer", value.alias("entity_value"), "metric_name", "metric_value", F.lit(source).alias("source_table"))


def gold_long(reports: DataFrame, windows: tuple[int, ...] = WINDOWS, dated: DataFrame | None = None) -> DataFrame:
    """The long rows of every group and window, with ``table_name``.

    A month's metrics are the same in every window that holds it: each group is
    computed once, over the widest, and its rows go to the windows they lie in.
    """
    groups = {"CLUSTER": (cluster_monthly, "cluster_id"), "DEFECT": (defect_monthly, "defect_type"), "PRODUCT": (product_monthly, "product_code"), "OVERVIEW": (overview_monthly, None)}
    longs = [to_long(f(reports, max(windows), dated), g, e, "EVENT_CLUSTERED") for g, (f, e) in groups.items()]
    rows = reduce(DataFrame.unionByName, longs)
    as_of = latest_month(reports if dated is None else dated)
    rows = rows.withColumn("_window", F.explode(F.array(*map(F.lit, windows)))).where(F.col("metric_date") > F.add_months(as_of, -F.col("_window")))
    return rows.withColumn("table_name", F.concat("grain", F.lit("_"), "_window", F.lit("M_DASHBOARD"))).drop("_window")


def gold_tables(reports: DataFrame, windows: tuple[int, ...] = WINDOWS, dated: DataFrame | None = None) -> dict[str, DataFrame]:
    """The long tables of every group and window, by name."""
    rows = gold_long(reports, windows, dated)
    names = [f"{g}_{w}M_DASHBOARD" for g in ("CLUSTER", "DEFECT", "PRODUCT", "OVERVIEW") for w in windows]
    return {n: rows.where(F.col("table_name") == n).drop("table_name") for n in names}
