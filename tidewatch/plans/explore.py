"""The exploration library: filters, shares, fatality rates, matrices, keyword tables, clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import combo, count_if, month_of, qualify, share, year_month
from tidewatch.plans.gold import EXCLUDED_DEFECTS, SEVERE

NO_HARM = ("No Harm", "No Apparent Injury")


def filter_reports(reports: DataFrame, months: Sequence[str] = (), extra: Sequence[Column] = (), **lists: Sequence) -> DataFrame:
    """Rows whose columns lie in the given lists; an empty list filters nothing."""
    for name, values in lists.items():
        if values:
            reports = reports.where(F.col(name).isin(*values))
    if months:
        reports = reports.where(year_month(F.col("date_received")).isin(*months))
    for test in extra:
        reports = reports.where(test)
    return reports


def between_dates(reports: DataFrame, first: str, last: str, column: str = "date_received") -> DataFrame:
    return reports.where(F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def values_of(reports: DataFrame, column: str, descending: bool = False, without: Sequence = ()) -> DataFrame:
    """Distinct values in order, without nulls."""
    out = reports.select(column).where(F.col(column).isNotNull()).distinct()
    out = out.where(~F.col(column).isin(*without)) if without else out
    return out.orderBy(F.desc(column) if descending else F.asc(column))


def counts(reports: DataFrame, keys: Sequence[str], top: int | None = None) -> DataFrame:
    out = reports.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_count"))
    return out.orderBy(F.desc("total_count"), *keys).limit(top) if top else out


def monthly(reports: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return reports.groupBy(month_of(F.col("date_received")).alias("month"), *keys).agg(F.count(F.lit(1)).alias("total_count"))


def composition(reports: DataFrame, group: str, part: str, digits: int | None = 2, scale: float = 100.0) -> DataFrame:
    """Counts of ``part`` within ``group`` and their share of the group."""
    out = reports.groupBy(group, part).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("pct", share(F.col("n"), F.sum("n").over(Window.partitionBy(group)), digits, scale))


def fatality(reports: DataFrame, key: str, least: int = 1, top: int | None = None) -> DataFrame:
    """Cases, deaths, injuries and their rates by key."""
    harm = F.col("patient_harm")
    out = reports.groupBy(key).agg(
        F.count(F.lit(1)).alias("total"), count_if(harm == "Death").alias("deaths"), count_if(harm == "Serious Injury").alias("serious"),
        count_if(harm == "Minor Injury").alias("minor"), count_if(harm == "No Harm").alias("no_harm"),
    ).where(F.col("total") >= least)
    out = out.withColumn("severe", F.col("deaths") + F.col("serious"))
    out = out.withColumns({"cfr": share(F.col("deaths"), F.col("total")), "serious_rate": share(F.col("serious"), F.col("total")), "severe_rate": share(F.col("severe"), F.col("total"))})
    return out.orderBy(F.desc("cfr"), key).limit(top) if top else out


def risk_matrix(reports: DataFrame, key: str, top: int | None = None) -> DataFrame:
    out = reports.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), share(count_if(F.col("patient_harm").isin(*SEVERE)), F.count(F.lit(1))).alias("severe_pct"), share(count_if(F.col("defect_confirmed")), F.count(F.lit(1))).alias("confirmed_pct")
    )
    return out.orderBy(F.desc("n"), key).limit(top) if top else out


def quadrants(matrix: DataFrame) -> DataFrame:
    """Which side of the exact medians of count and severity each row lies on."""
    medians = matrix.agg(F.percentile("n", F.lit(0.5)).alias("n_mid"), F.percentile("severe_pct", F.lit(0.5)).alias("s_mid"))
    many, severe = F.col("n") >= F.col("n_mid"), F.col("severe_pct") >= F.col("s_mid")
    label = F.when(many & severe, "frequent and severe").when(many, "frequent").when(severe, "severe").otherwise("low")
    return matrix.crossJoin(F.broadcast(medians)).withColumn("quadrant", label).drop("n_mid", "s_mid")


def harm_summary(reports: DataFrame) -> DataFrame:
    harm = F.col("patient_harm")
    return reports.agg(
        F.count(F.lit(1)).alias("total"), count_if(harm == "Death").alias("deaths"), count_if(harm == "Serious Injury").alias("serious"),
        count_if(harm == "Minor Injury").alias("minor"), count_if(harm.isin(*NO_HARM)).alias("no_harm"),
    )


def period_change(reports: DataFrame, first: str, last: str) -> DataFrame:
    """Headline numbers of a period and of the same period one month earlier, and their differences."""
    date = F.col("date_received")
    spans = {"now": (F.lit(first).cast("date"), F.lit(last).cast("date")), "before": (F.add_months(F.lit(first).cast("date"), -1), F.add_months(F.lit(last).cast("date"), -1))}
    aggs = []
    for name, (a, b) in spans.items():
        inside = date.between(a, b)
        aggs += [count_if(inside).alias(f"n_{name}"), share(count_if(inside & F.col("patient_harm").isin(*SEVERE)), count_if(inside)).alias(f"severe_{name}")]
    return reports.agg(*aggs).withColumns({"n_delta": F.col("n_now") - F.col("n_before"), "severe_delta": F.round(F.col("severe_now") - F.col("severe_before"), 2)})


def treemap(reports: DataFrame, top: int = 3) -> DataFrame:
    """The most frequent defects by harm, with each defect's total and severe rate."""
    totals = reports.where(F.col("defect_type").isNotNull()).groupBy("defect_type").agg(F.count(F.lit(1)).alias("total"), share(count_if(F.col("patient_harm").isin(*SEVERE)), F.count(F.lit(1))).alias("severe_rate"))
    best = totals.orderBy(F.desc("total"), "defect_type").limit(top)
    return reports.groupBy("defect_type", "patient_harm").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(best), "defect_type")


def compare_entities(reports: DataFrame, column: str, a: str, b: str, part: str = "defect_type") -> DataFrame:
    """Shares of each part in two entities, their signed and absolute difference; absent parts are 0."""
    def of(value: str, name: str) -> DataFrame:
        own = reports.where(F.col(column) == value)
        rows = own.groupBy(part).agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(own.agg(F.count(F.lit(1)).alias("_all"))))  # one row
        return rows.select(part, share(F.col("n"), F.col("_all")).alias(name))

    both = of(a, "pct_a").join(of(b, "pct_b"), part, "full_outer").na.fill(0.0, ["pct_a", "pct_b"])
    return both.withColumns({"difference": F.round(F.col("pct_a") - F.col("pct_b"), 2), "distance": F.round(F.abs(F.col("pct_a") - F.col("pct_b")), 2)})


def statistics(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(column).alias("mean"), F.percentile(column, F.lit(0.5)).alias("median"), F.stddev_samp(column).alias("std"), F.min(column).alias("low"), F.max(column).alias("high"))


def explode_words(df: DataFrame, column: str, trim_first: bool = False) -> DataFrame:
    """One row per element of a list (or of its JSON or quoted text), lower-cased and trimmed.

    A text that is no list gives no rows.  Null and empty elements go before
    trimming, or after it with ``trim_first``.
    """
    values = F.col(column)
    if dict(df.dtypes)[column] == "string":
        values = F.from_json(values, "array<string>", {"allowSingleQuotes": "true"})
    out = df.withColumn("keyword", F.explode(values))
    if trim_first:
        return out.withColumn("keyword", F.lower(F.trim("keyword"))).where(F.col("keyword") != "")
    return out.where(F.col("keyword") != "").withColumn("keyword", F.lower(F.trim("keyword")))


def keyword_table(df: DataFrame, column: str, group: str, top: int | None = None) -> DataFrame:
    """Keyword counts within a group, their share of its rows, and the keywords of dense rank up to ``top``."""
    out = explode_words(df, column).groupBy(group, "keyword").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(group)
    out = out.withColumns({"ratio": share(F.col("n"), F.sum("n").over(w)), "rank": F.dense_rank().over(w.orderBy(F.desc("n")))})
    return out.where(F.col("rank") <= top) if top else out


def vocabulary(df: DataFrame, column: str, least: int = 10) -> DataFrame:
    """Elements that occur often enough; case counts."""
    return df.select(F.explode(column).alias("keyword")).groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def keyword_text(values: Column, vocab: Sequence[str]) -> Column:
    """The elements whose lower case is in the vocabulary, joined; ``unknown`` if there is none."""
    kept = F.filter(values, lambda x: F.lower(x).isin(*vocab))
    return F.when(F.coalesce(F.size(kept), F.lit(0)) > 0, F.array_join(kept, ", ")).otherwise("unknown")


def cluster_overview(reports: DataFrame) -> DataFrame:
    harm = F.col("patient_harm")
    return reports.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("total"), count_if(harm == "Death").alias("deaths"), share(count_if(harm == "Death"), F.count(F.lit(1))).alias("cfr"),
        share(count_if(F.col("defect_confirmed")), F.count(F.lit(1))).alias("confirmed_pct"),
    )


def cluster_insights(overview: DataFrame) -> DataFrame:
    """The largest cluster and those of highest and lowest fatality; ties go to the smallest cluster."""
    tie = -F.col("cluster")
    return overview.agg(
        F.max_by("cluster", F.struct("total", tie)).alias("largest"), F.max_by("cluster", F.struct("cfr", tie)).alias("highest"), F.min_by("cluster", F.struct("cfr", "cluster")).alias("lowest")
    )


def common_keywords(df: DataFrame, column: str, a: int, b: int) -> DataFrame:
    words = explode_words(df, column)
    return words.where(F.col("cluster") == a).select("keyword").intersect(words.where(F.col("cluster") == b).select("keyword"))


# What is shown for a flag and for a pattern.
FLAG_LABELS = {True: "결함 있음", False: "결함 없음"}
UNKNOWN_LABEL = "알 수 없음"
PATTERN_LABELS = {"severe": "🔴 심각", "alert": "🟠 경고", "attention": "🟡 주의"}
GENERAL_LABEL = "🟢 일반"


def flag_label(flag: Column) -> Column:
    """The words for a confirmed flag; other values pass as text, ``Unknown`` by its word."""
    text = flag.cast("string")
    out = F.when(text == "true", FLAG_LABELS[True]).when(text == "false", FLAG_LABELS[False])
    return out.when(text == "Unknown", UNKNOWN_LABEL).otherwise(text)


def pattern_label(pattern: Column) -> Column:
    out = None
    for name, label in PATTERN_LABELS.items():
        out = F.when(pattern == name, label) if out is None else out.when(pattern == name, label)
    return out.otherwise(GENERAL_LABEL)


def _top_shares(rows: DataFrame, key: Column, total: DataFrame, top: int | None, digits: int = 2) -> DataFrame:
    """Counts of a value, the largest first, with their share of a one-row total."""
    out = rows.groupBy(key.alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label")
    out = out.limit(top) if top else out
    return out.crossJoin(F.broadcast(total)).withColumn("ratio", share(F.col("n"), F.col("_total"), digits)).drop("_total")


def cluster_headline(reports: DataFrame, cluster: int) -> DataFrame:
    """One row: cases of a cluster, its severe rate, and counts and rates by harm; 0 where the cluster is empty."""
    harm = F.col("patient_harm")
    one = reports.where(F.col("cluster") == cluster).agg(
        F.count(F.lit(1)).alias("total"), *[F.coalesce(count_if(harm == label), F.lit(0)).alias(name) for name, label in (("deaths", "Death"), ("serious", "Serious Injury"), ("minor", "Minor Injury"))]
    )
    rate = lambda part: F.coalesce(share(part, F.col("total")), F.lit(0.0))
    return one.withColumns({
        "severe": F.col("deaths") + F.col("serious"), "cfr": rate(F.col("deaths") + F.col("serious")),
        "death_rate": rate(F.col("deaths")), "serious_rate": rate(F.col("serious")), "minor_rate": rate(F.col("minor")),
    })


def cluster_check(reports: DataFrame, cluster: int, top: int = 10) -> dict[str, DataFrame]:
    """What a cluster holds: harms, components, months, defects and flags; ratios are over all its cases."""
    own = reports.where(F.col("cluster") == cluster)
    total = own.agg(F.count(F.lit(1)).alias("_total"))
    harm = F.when(F.col("patient_harm").isin(*NO_HARM), "No Harm").otherwise(F.col("patient_harm"))
    defects = own.where(F.col("defect_type") != "")
    months = own.groupBy(year_month(F.col("date_received")).alias("label")).agg(F.count(F.lit(1)).alias("n")).withColumn("ratio", F.lit(None).cast("double"))
    return {
        "harm": _top_shares(own.where(harm.isNotNull()), harm, total, None),
        "component": _top_shares(explode_words(own, "problem_components"), F.col("keyword"), total, top),
        "month": months,
        "defect": _top_shares(defects, F.col("defect_type"), total, top),
        "confirmed": _top_shares(own.where(F.col("defect_confirmed").isNotNull()), flag_label(F.col("defect_confirmed")), total, None),
    }


def shared_components(reports: DataFrame, top: int = 3) -> DataFrame:
    """Components that are among the first ``top`` of more than one cluster (noise aside), the most shared first."""
    words = explode_words(reports.where(F.col("cluster") != -1), "problem_components")
    counts_ = words.groupBy("cluster", "keyword").agg(F.count(F.lit(1)).alias("n"))
    best = qualify(counts_, ["cluster"], [F.desc("n"), F.asc("keyword")], top)
    return best.groupBy("keyword").agg(F.count(F.lit(1)).alias("clusters")).where("clusters > 1").orderBy(F.desc("clusters"), "keyword").limit(3)


def defect_components(reports: DataFrame, defect: str, top: int = 10) -> DataFrame:
    """Components of one defect with their share of its components; no rows if there are none."""
    words = explode_words(reports.where((F.col("defect_type") == defect) & F.col("problem_components").isNotNull()), "problem_components")
    out = _top_shares(words, F.col("keyword"), words.agg(F.count(F.lit(1)).alias("_total")), top)
    return out.select(F.col("label").alias("problem_component"), "n", F.col("ratio").alias("percentage"))


def monthly_severity(reports: DataFrame) -> DataFrame:
    """Count, severe cases and severe rate of each month."""
    out = reports.groupBy(month_of(F.col("date_received")).alias("month")).agg(F.count(F.lit(1)).alias("n"), count_if(F.col("patient_harm").isin(*SEVERE)).alias("severe"))
    return out.withColumn("severe_rate", share(F.col("severe"), F.col("n"), 4))


def sparkline(reports: DataFrame, last: str, months: int = 6) -> DataFrame:
    """Count, severe rate and confirmed rate of each of the last months."""
    end = F.lit(last).cast("date")
    rows = reports.where(F.col("date_received").between(F.add_months(F.trunc(end, "month"), -(months - 1)), F.last_day(end)))
    n = F.count(F.lit(1))
    return rows.groupBy(month_of(F.col("date_received")).alias("month")).agg(
        n.alias("n"), share(count_if(F.col("patient_harm").isin(*SEVERE)), n, 4).alias("severe_rate"), share(count_if(F.col("defect_confirmed")), n, 4).alias("confirmed_rate")
    )


def critical_defect(reports: DataFrame, first: str, last: str) -> DataFrame:
    """The defect of highest severe rate in a period and in the one a month earlier; ties go to the smaller name."""
    spans = {"now": (F.lit(first).cast("date"), F.lit(last).cast("date")), "before": (F.add_months(F.lit(first).cast("date"), -1), F.add_months(F.lit(last).cast("date"), -1))}
    known = reports.where(~F.col("defect_type").isin(*EXCLUDED_DEFECTS))
    inside = {name: F.col("date_received").between(a, b) for name, (a, b) in spans.items()}
    severe = F.col("patient_harm").isin(*SEVERE)
    rates = known.groupBy("defect_type").agg(*[share(count_if(t & severe), count_if(t), None).alias(name) for name, t in inside.items()])
    best = lambda name: F.min(F.when(F.col(name).isNotNull(), F.struct((-F.col(name)).alias("r"), F.col("defect_type").alias("d")))).alias(name)
    one = rates.agg(best("now"), best("before"))
    return one.select(*[c for name in spans for c in (F.coalesce(F.col(f"{name}.d"), F.lit("N/A")).alias(f"defect_{name}"), F.round(F.coalesce(-F.col(f"{name}.r"), F.lit(0.0)), 4).alias(f"rate_{name}"))])


def cascade(reports: DataFrame, manufacturers: Sequence[str], products: Sequence[str] = ()) -> dict[str, DataFrame]:
    """What may still be chosen: products of the chosen manufacturers, devices of both; nothing while no manufacturer is chosen."""
    own = reports.where(F.col("manufacturer_name").isin(*manufacturers)) if manufacturers else reports.where(F.lit(False))
    of = own.where(F.col("product_code").isin(*products)) if products else own
    device = combo(F.col("manufacturer_name"), F.col("product_code"))
    return {"products": values_of(own, "product_code"), "devices": values_of(of.withColumn("device", device), "device")}


def value_lists(reports: DataFrame) -> dict[str, DataFrame]:
    """All lists that filters offer: months descending, the others ascending, without nulls and noise."""
    months = values_of(reports.withColumn("month", year_month(F.col("date_received"))), "month", descending=True)
    named = {"manufacturers": "manufacturer_name", "products": "product_code", "defects": "defect_type"}
    return {"months": months} | {k: values_of(reports, c) for k, c in named.items()} | {"clusters": values_of(reports, "cluster", without=(-1,))}


def eda_insights(reports: DataFrame, least: int = 10, high: float = 5.0, good: float = 1.0) -> DataFrame:
    """Findings by kind: the top device, the first device of a high severe rate (or the mean rate where all are low), the top defect."""
    rows = reports.withColumn("device", combo(F.col("manufacturer_name"), F.col("product_code")))
    kind = lambda name: F.lit(name).alias("kind")
    top = counts(rows, ["device"], 1).select(kind("top_device"), F.col("device").alias("subject"), F.col("total_count").cast("double").alias("value"))
    rates = fatality(rows, "device", least).orderBy(F.desc("severe_rate"), "device").limit(5)
    risky = rates.where(F.col("severe_rate") > high).orderBy(F.desc("severe_rate"), "device").limit(1).select(kind("high_rate"), F.col("device").alias("subject"), F.col("severe_rate").alias("value"))
    mean = rates.agg(F.avg("severe_rate").alias("value"), F.max("severe_rate").alias("m")).where((F.col("m") <= high) & (F.col("value") < good))
    defects = counts(rows.where(F.col("defect_type").isNotNull()), ["defect_type"], 1)
    return top.unionByName(risky).unionByName(mean.select(kind("low_rate"), F.lit(None).cast("string").alias("subject"), "value")).unionByName(
        defects.select(kind("top_defect"), F.col("defect_type").alias("subject"), F.col("total_count").cast("double").alias("value"))
    )


def top_combos(reports: DataFrame, defects: Sequence[str] = (), top: int = 10) -> DataFrame:
    """Counts by device and defect, of the devices with the most cases under the defect filter."""
    rows = reports.withColumn("device", combo(F.col("manufacturer_name"), F.col("product_code")))
    rows = rows.where(F.col("defect_type").isin(*defects)) if defects else rows
    best = counts(rows, ["device"], top).select("device")  # ``top`` rows
    return rows.join(F.broadcast(best), "device", "left_semi").groupBy("device", "defect_type").agg(F.count(F.lit(1)).alias("n"))


def filter_by(df: DataFrame, filters: dict[str, object]) -> DataFrame:
    """Rows that meet a dictionary of filters: a list, a (low, high) pair of a range, or one value; None filters nothing."""
    for name, wanted in filters.items():
        if isinstance(wanted, tuple):
            df = df.where(F.col(name).between(*wanted))
        elif isinstance(wanted, (list, set)):
            df = df.where(F.col(name).isin(*wanted))
        elif wanted is not None:
            df = df.where(F.col(name) == wanted)
    return df


def top_by_column(df: DataFrame, column: str, top: int = 10, filters: dict[str, object] | None = None) -> DataFrame:
    return counts(filter_by(df, filters or {}), [column], top)


NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def all_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A row of statistics for each column; without a list, for every number column."""
    names = columns or [c for c, kind in df.dtypes if kind.split("(")[0] in NUMERIC]
    stats = {"mean": F.avg, "median": lambda c: F.percentile(c, F.lit(0.5)), "std": F.stddev_samp, "low": F.min, "high": F.max}
    one = df.agg(*[f(c).cast("double").alias(f"{c}|{n}") for c in names for n, f in stats.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{n}`").alias(n) for n in stats]) for c in names])
    return one.select(F.inline(rows))


def column_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


def pair_compositions(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """Composition of every pair of columns, of the groups with the most rows, one below the other."""
    out = None
    for a, b in column_pairs(columns):
        rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        if top:
            rows = rows.join(F.broadcast(counts(rows, [a], top).select(a)), a, "left_semi")
        own = composition(rows, a, b, 4, 1.0).select(F.lit(a).alias("group_column"), F.col(a).cast("string").alias("group_value"), F.lit(b).alias("part_column"), F.col(b).cast("string").alias("part_value"), "n", "pct")
        out = own if out is None else out.unionByName(own)
    return out


def keyword_shares(df: DataFrame, column: str, group: str) -> DataFrame:
    """Keyword counts within a group and their share of it from 0 to 1, not rounded, all keywords."""
    out = explode_words(df, column, trim_first=True).groupBy(group, "keyword").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("ratio", share(F.col("n"), F.sum("n").over(Window.partitionBy(group)), None, 1.0))


def fatality_range(rates: DataFrame, reports: DataFrame) -> DataFrame:
    """Lowest and highest rate of a table of rates, their distance, and the rate of all cases."""
    harm = count_if(F.col("patient_harm") == "Death")
    whole = reports.agg(share(harm, F.count(F.lit(1))).alias("overall"))
    one = rates.agg(F.min("cfr").alias("low"), F.max("cfr").alias("high")).withColumn("range", F.round(F.col("high") - F.col("low"), 2))
    return one.crossJoin(F.broadcast(whole))
