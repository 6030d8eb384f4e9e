"""Spike detection: ratio, z-score and Poisson over windows, with a correction and an ensemble."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import count_if, month_index
from tidewatch.functions.kernels import poisson_upper

CORRECTIONS = (None, "bonferroni", "sidak", "fdr_bh")


def keyword_months(reports: DataFrame, keyword: str, exclude: tuple[str, ...] = (), all_reports: bool = False) -> DataFrame:
    """Distinct reports of each keyword and month, and of the month in all.

    Null and excluded keywords are left out; the month's total counts the
    remaining reports, or with ``all_reports`` every one.  One pass with
    grouping sets gives both.
    """
    kept = F.col("keyword").isNotNull() & ~F.col("keyword").isin(*exclude) if exclude else F.col("keyword").isNotNull()
    rows = reports.where(F.col("date_received").isNotNull()).select("report_key", F.col(keyword).alias("keyword"), month_index(F.col("date_received")).alias("month"))
    rows = rows if all_reports else rows.where(kept)
    sets = [[F.col("keyword"), F.col("month")], [F.col("month")]]
    counted = rows.groupingSets(sets, "keyword", "month").agg(F.grouping("keyword").alias("_total"), F.countDistinct("report_key").alias("n_reports"))
    of_month = F.max(F.when(F.col("_total") == 1, F.col("n_reports"))).over(Window.partitionBy("month"))
    return counted.withColumn("n_total", of_month).where((F.col("_total") == 0) & kept).select("month", "keyword", "n_reports", "n_total")


def latest_month(dated: DataFrame) -> Column:
    """Number of the latest month, as a scalar subquery."""
    return dated.agg(F.max(month_index(F.col("date_received")))).scalar()


def window_stats(months: DataFrame, windows: tuple[int, ...], as_of: int | Column) -> DataFrame:
    """Sums, means and deviations of the recent and the base months of every window.

    Recent are the ``w`` months up to ``as_of``, base the ``w`` before.  Months in
    which a keyword is absent do not enter its mean; what is missing is 0.
    """
    spread = months.withColumns({"_as_of": as_of if isinstance(as_of, Column) else F.lit(as_of), "window": F.explode(F.array(*map(F.lit, windows)))})
    as_of = F.col("_as_of")
    recent = (F.col("month") <= as_of) & (F.col("month") > as_of - F.col("window"))
    base = (F.col("month") <= as_of - F.col("window")) & (F.col("month") > as_of - 2 * F.col("window"))
    n = F.col("n_reports")
    of = lambda test, value: F.when(test, value)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    each = spread.groupBy("window", "keyword").agg(
        F.coalesce(F.sum(of(recent, n)), F.lit(0)).alias("c_recent"),
        zero(F.avg(of(recent, n))).alias("recent_mean"),
        F.coalesce(F.sum(of(base, n)), F.lit(0)).alias("c_base"),
        zero(F.avg(of(base, n))).alias("base_mean"),
        zero(F.stddev_samp(of(base, n))).alias("base_std"),
        zero(F.avg(of(base, F.log1p(n)))).alias("log_base_mean"),
        zero(F.stddev_samp(of(base, F.log1p(n)))).alias("log_base_std"),
    )
    whole = spread.select("_as_of", "window", "month", "n_total").distinct().groupBy("window")
    whole = whole.agg(F.coalesce(F.sum(of(recent, F.col("n_total"))), F.lit(0)).alias("n_recent"), F.coalesce(F.sum(of(base, F.col("n_total"))), F.lit(0)).alias("n_base"))
    return each.join(F.broadcast(whole), "window")  # a row for each window


def ratio_metrics(df: DataFrame) -> DataFrame:
    r, c = (F.col("c_recent") + 1) / (F.col("c_base") + 1), F.col("c_recent")
    return df.withColumns({
        "ratio": F.bround(r, 2),
        "score_log": F.bround(r * F.log1p(c), 2),
        "score_sqrt": F.bround(r * F.sqrt(c), 2),
        "score_ratio": F.bround(F.log(r) * F.log1p(c), 2),
    })


def zscore_metrics(df: DataFrame, eps: float = 0.1) -> DataFrame:
    return df.withColumns({
        "z_score": F.bround((F.col("recent_mean") - F.col("base_mean")) / (F.col("base_std") + eps), 4),
        "z_log": F.bround((F.log1p("c_recent") - F.col("log_base_mean")) / (F.col("log_base_std") + eps), 4),
    })


def corrected(p: str, method: str | None, family: list[str]) -> Column:
    """The adjusted p-value within a family of rows."""
    if method not in CORRECTIONS:
        raise ValueError(f"unknown correction: {method}")
    whole = Window.partitionBy(*family or [F.lit(0)])
    n = F.count(F.lit(1)).over(whole)
    if method is None:
        return F.col(p)
    if method == "bonferroni":
        return F.least(F.col(p) * n, F.lit(1.0))
    if method == "sidak":
        return 1 - F.pow(1 - F.col(p), n)
    return F.min("_step").over(whole.orderBy(p, "keyword", "window").rowsBetween(0, Window.unboundedFollowing))


def poisson_metrics(df: DataFrame, method: str | None = "fdr_bh", family: tuple[str, ...] = ("window",)) -> DataFrame:
    """Upper Poisson tail of the recent count under the base rate, adjusted within a family (none: one family of all rows)."""
    rate = F.when(F.col("n_base") > 0, F.col("c_base") / F.col("n_base") * F.col("n_recent")).otherwise(0.001)
    df = df.withColumn("_rate", F.greatest(rate, F.lit(0.001)))
    df = df.withColumn("_p", poisson_upper("c_recent", "_rate"))
    whole = Window.partitionBy(*family or [F.lit(0)])
    order = whole.orderBy("_p", "keyword", "window")
    n = F.count(F.lit(1)).over(whole)
    df = df.withColumn("_step", F.least(F.col("_p") * n / F.row_number().over(order), F.lit(1.0)))
    return df.withColumns({
        "lambda_pois": F.bround("_rate", 6),
        "p_pois": F.bround("_p", 6),
        "p_adjusted": F.bround(corrected("_p", method, list(family)), 6),
        "score_pois": F.bround(-F.log10("_p"), 4),
    }).drop("_rate", "_p", "_step")


def spike_flags(df: DataFrame, z: float = 2.0, least: int = 20, alpha: float = 0.05, z_column: str = "z_score") -> DataFrame:
    w = Window.partitionBy("window")
    ready = (F.col("c_recent") > F.col("c_base")) & (F.col("c_recent") >= least)
    bound = F.avg("score_ratio").over(w) + z * F.stddev_samp("score_ratio").over(w)
    df = df.withColumns({
        "is_spike": F.coalesce(ready & (F.col("score_ratio") >= bound), F.lit(False)),
        "is_spike_z": ready & (F.col(z_column) >= z),
        "is_spike_p": ready & (F.col("p_adjusted") <= alpha),
    })
    votes = sum((F.col(c).cast("int") for c in ("is_spike", "is_spike_z", "is_spike_p")), F.lit(0))
    pattern = F.when(votes == 3, "severe").when(votes == 2, "alert").when(votes == 1, "attention").otherwise("general")
    return df.withColumns({"spike_count": votes, "pattern": pattern})


def detect(
    reports: DataFrame, keyword: str, windows: tuple[int, ...] = (1, 3, 6, 12), as_of: int | None = None, exclude: tuple[str, ...] = (), all_reports: bool = False,
    family: tuple[str, ...] = ("window",), method: str | None = "fdr_bh", eps: float = 0.1, dated: DataFrame | None = None, **flags,
) -> DataFrame:
    """All metrics and flags of every keyword and window.

    ``as_of`` defaults to the latest month of ``dated`` (the reports themselves
    if none is given); see :func:`keyword_months`, :func:`zscore_metrics` and
    :func:`poisson_metrics` for the other settings.
    """
    month = as_of if as_of is not None else latest_month(reports if dated is None else dated)
    df = window_stats(keyword_months(reports, keyword, exclude, all_reports), windows, month)
    return spike_flags(poisson_metrics(zscore_metrics(ratio_metrics(df), eps), method, family), **flags)


def detect_dashboard(reports: DataFrame, keyword: str, **settings) -> DataFrame:
    """The detection as the dashboard runs it: two windows that are one family, totals of all reports, the z of logarithms."""
    return detect(reports, keyword, (1, 3), all_reports=True, family=(), z_column="z_log", **settings)


def rolling_baseline(months: DataFrame, window: int = 3, digits: int = 2) -> DataFrame:
    """Each month's count against the mean of the present months ``[m - window - 11, m - window]``."""
    frame = Window.partitionBy("keyword").orderBy("month").rangeBetween(-(window + 11), -window)
    df = months.withColumn("baseline", F.avg("n_reports").over(frame))
    return df.withColumn("ratio", F.coalesce(F.round((F.col("n_reports") + 1) / (F.col("baseline") + 1), digits), F.lit(1.0)))


def ensemble(df: DataFrame, least: int = 2, window: int | None = None) -> DataFrame:
    """Spikes that enough methods agree on, highest Poisson score first."""
    df = df if window is None else df.where(F.col("window") == window)
    return df.where(F.col("spike_count") >= least).orderBy(F.desc("score_pois"), "window", "keyword")


# The flag and the score of each method.
METHODS = {"ratio": ("is_spike", "score_ratio"), "z": ("is_spike_z", "z_score"), "z_log": ("is_spike_z", "z_log"), "poisson": ("is_spike_p", "score_pois")}


def by_method(df: DataFrame, method: str, window: int | None = None) -> DataFrame:
    """Spikes of one method, its highest score first."""
    flag, score = METHODS[method]
    df = df if window is None else df.where(F.col("window") == window)
    return df.where(flag).orderBy(F.desc(score), "window", "keyword")


def result_table(df: DataFrame, patterns: Sequence[str] = (), top: int | None = None, agreed: int = 0) -> DataFrame:
    """The table that is shown: wanted patterns, spikes of at least ``agreed`` methods, the largest ratios, with the signed increase."""
    df = df.where(F.col("pattern").isin(*patterns)) if patterns else df
    df = df.where(F.col("spike_count") >= agreed) if agreed else df
    shown = df.select("keyword", "pattern", "ratio", "c_recent", (F.col("c_recent") - F.col("c_base")).alias("increase"), "c_base", "spike_count", "is_spike", "is_spike_z", "is_spike_p")
    shown = shown.orderBy(F.desc("ratio"), "keyword")
    return shown.limit(top) if top else shown


def summary(df: DataFrame, least: int = 2, new_below: int = 5) -> DataFrame:
    """One row: how many spikes of how many rows, by pattern, their mean number of methods, the largest ratio and the new ones."""
    spike = F.col("spike_count") >= least
    of = lambda pattern: count_if(F.col("pattern") == pattern).alias(pattern)
    return df.agg(
        F.count(F.lit(1)).alias("n"), count_if(spike).alias("spikes"), *[of(p) for p in ("severe", "alert", "attention", "general")],
        F.round(F.avg(F.when(spike, F.col("spike_count"))), 4).alias("mean_methods"),
        F.max(F.when(spike, F.col("ratio"))).alias("largest_ratio"),
        F.min_by(F.when(spike, F.col("keyword")), F.when(spike, F.struct(-F.col("ratio"), F.col("keyword"), F.col("window")))).alias("largest"),
        count_if(spike & (F.col("c_base") < new_below)).alias("new_spikes"),
    )
