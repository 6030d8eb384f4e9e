"""The registered queries of the engine and their SQL, by the operator's number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.adapter import dated, load, reports
from tidewatch.functions import clean
from tidewatch.functions import columns as col
from tidewatch.functions.kernels import fuzzy_score
from tidewatch.operators import clusters, extraction, flatten, matching, records
from tidewatch.plans import explore, gold, spikes, stats
from tidewatch.registry import ORACLE_SQL, QUERIES, query

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.to_long(gold.cluster_monthly(reports(spark, sf_dir), dated=dated(spark, sf_dir)), "CLUSTER", "cluster_id", "EVENT_CLUSTERED")


# --- monthly metrics -------------------------------------------------------------------------------

_TRAILING = """WITH recent AS (
  SELECT *, CAST(date_trunc('month', date_received) AS DATE) AS metric_date FROM reports
  WHERE date_trunc('month', date_received) > (SELECT date_trunc('month', max(date_received)) - INTERVAL {w} MONTH FROM reports)),
both_ AS (SELECT *, manufacturer_name AS manufacturer FROM recent UNION ALL SELECT *, 'ALL' AS manufacturer FROM recent)
"""
_SEVERE = "round(100.0 * sum(CASE WHEN patient_harm IN ('Death', 'Serious Injury') THEN 1 ELSE 0 END) / nullif(count(DISTINCT report_key), 0), 2) AS severe_harm_rate"
_CONFIRMED = "round(100.0 * sum(CASE WHEN defect_confirmed THEN 1 ELSE 0 END) / nullif(count(DISTINCT report_key), 0), 2) AS defect_confirmed_rate"
_COUNT = "CAST(count(DISTINCT report_key) AS DOUBLE)"


def _harm(label: str, name: str) -> str:
    return f"CAST(sum(CASE WHEN patient_harm = '{label}' THEN 1 ELSE 0 END) AS DOUBLE) AS {name}"


_CLUSTER = f"""{_COUNT} AS report_count, {_harm('Death', 'death_count')}, {_harm('Serious Injury', 'serious_injury_count')}, {_harm('Minor Injury', 'minor_injury_count')},
  {_harm('No Apparent Injury', 'no_harm_count')}, {_SEVERE}, CAST(sum(CASE WHEN defect_confirmed THEN 1 ELSE 0 END) AS DOUBLE) AS defect_confirmed_count, {_CONFIRMED}"""
for _w in gold.WINDOWS:
    query(f"g02_cluster_monthly_{_w}m", f"{_TRAILING.format(w=_w)} SELECT metric_date, manufacturer, CAST(cluster AS VARCHAR) AS cluster_id, {_CLUSTER} FROM both_ WHERE cluster <> -1 GROUP BY ALL")(
        lambda s, d, w=_w: gold.cluster_monthly(reports(s, d), w, dated(s, d))
    )
query("g03_defect_monthly", f"{_TRAILING.format(w=12)} SELECT metric_date, manufacturer, defect_type, {_COUNT} AS report_count FROM both_ WHERE defect_type NOT IN ('Unknown', 'Other') GROUP BY ALL")(
    lambda s, d: gold.defect_monthly(reports(s, d), dated=dated(s, d))
)
query("g04_product_monthly", f"{_TRAILING.format(w=12)} SELECT metric_date, manufacturer, product_code, {_COUNT} AS report_count, {_harm('Death', 'death_count')}, {_SEVERE} FROM both_ GROUP BY ALL")(
    lambda s, d: gold.product_monthly(reports(s, d), dated=dated(s, d))
)
query("g05_overview_monthly", f"{_TRAILING.format(w=12)} SELECT metric_date, manufacturer, {_COUNT} AS total_report_count, {_harm('Death', 'death_count')}, {_harm('Serious Injury', 'serious_injury_count')}, {_SEVERE}, {_CONFIRMED} FROM both_ GROUP BY ALL")(
    lambda s, d: gold.overview_monthly(reports(s, d), dated=dated(s, d))
)
query(
    "g10_product_long",
    f"""{_TRAILING.format(w=3)}, wide AS (SELECT metric_date, manufacturer, product_code, {_COUNT} AS report_count, {_harm('Death', 'death_count')}, {_SEVERE} FROM both_ GROUP BY ALL)
SELECT metric_date, 'PRODUCT' AS grain, manufacturer, product_code AS entity_value, metric_name, metric_value, 'EVENT_CLUSTERED' AS source_table
FROM (UNPIVOT wide ON report_count, death_count, severe_harm_rate INTO NAME metric_name VALUE metric_value)""",
)(lambda s, d: gold.to_long(gold.product_monthly(reports(s, d), 3, dated(s, d)), "PRODUCT", "product_code", "EVENT_CLUSTERED"))


def _gold_part(grain: str, entity: str, measures: str, where: str = "") -> str:
    wide = f"SELECT metric_date, manufacturer, CAST({entity} AS VARCHAR) AS entity_value, {measures} FROM both_ {where} GROUP BY ALL"
    return f"""SELECT metric_date, '{grain}' AS grain, manufacturer, entity_value, metric_name, metric_value, 'EVENT_CLUSTERED' AS source_table
  FROM (UNPIVOT ({wide}) ON COLUMNS(* EXCLUDE (metric_date, manufacturer, entity_value)) INTO NAME metric_name VALUE metric_value)"""


_PRODUCT = f"{_COUNT} AS report_count, {_harm('Death', 'death_count')}, {_SEVERE}"
_OVERVIEW_MONTH = f"{_COUNT} AS total_report_count, {_harm('Death', 'death_count')}, {_harm('Serious Injury', 'serious_injury_count')}, {_SEVERE}, {_CONFIRMED}"
_PARTS = [
    _gold_part("CLUSTER", "cluster", _CLUSTER, "WHERE cluster <> -1"),
    _gold_part("DEFECT", "defect_type", f"{_COUNT} AS report_count", "WHERE defect_type NOT IN ('Unknown', 'Other')"),
    _gold_part("PRODUCT", "product_code", _PRODUCT),
    _gold_part("OVERVIEW", "'ALL'", _OVERVIEW_MONTH),
]
query(
    "m22_gold_tables",
    f"""{_TRAILING.format(w=12)}, long_ AS ({' UNION ALL '.join(_PARTS)}), win AS (SELECT unnest([3, 6, 9, 12]) AS w),
as_of AS (SELECT date_trunc('month', max(date_received)) AS m FROM reports)
SELECT long_.*, grain || '_' || w || 'M_DASHBOARD' AS table_name FROM long_, win, as_of WHERE metric_date > m - to_months(CAST(w AS INT))""",
)(lambda s, d: gold.gold_long(reports(s, d), dated=dated(s, d)))


# --- spikes ----------------------------------------------------------------------------------------

_SPIKES = """WITH rows_ AS (SELECT report_key, product_code AS keyword, year(date_received) * 12 + month(date_received) AS month FROM reports),
each_ AS (SELECT keyword, month, count(DISTINCT report_key) AS n_reports FROM rows_ GROUP BY ALL),
total AS (SELECT month, count(DISTINCT report_key) AS n_total FROM rows_ GROUP BY ALL),
latest AS (SELECT max(month) AS m FROM rows_),
win AS (SELECT unnest([1, 3, 6, 12]) AS w),
st AS (SELECT w AS "window", keyword,
   coalesce(sum(n_reports) FILTER (month > m - w), 0) AS c_recent, coalesce(avg(n_reports) FILTER (month > m - w), 0) AS recent_mean,
   coalesce(sum(n_reports) FILTER (month <= m - w AND month > m - 2 * w), 0) AS c_base, coalesce(avg(n_reports) FILTER (month <= m - w AND month > m - 2 * w), 0) AS base_mean,
   coalesce(stddev_samp(n_reports) FILTER (month <= m - w AND month > m - 2 * w), 0) AS base_std,
   coalesce(avg(ln(1 + n_reports)) FILTER (month <= m - w AND month > m - 2 * w), 0) AS log_base_mean,
   coalesce(stddev_samp(ln(1 + n_reports)) FILTER (month <= m - w AND month > m - 2 * w), 0) AS log_base_std
  FROM each_, latest, win GROUP BY ALL),
tot AS (SELECT w AS "window", coalesce(sum(n_total) FILTER (month > m - w), 0) AS n_recent, coalesce(sum(n_total) FILTER (month <= m - w AND month > m - 2 * w), 0) AS n_base FROM total, latest, win GROUP BY ALL)
"""
query(
    "x01_x02_spike_scores",
    _SPIKES
    + """SELECT st."window", keyword, CAST(c_recent AS BIGINT) AS c_recent, CAST(c_base AS BIGINT) AS c_base, CAST(n_recent AS BIGINT) AS n_recent, CAST(n_base AS BIGINT) AS n_base,
  round_even((c_recent + 1) / (c_base + 1), 2) + 0.0 AS ratio, round_even((c_recent + 1) / (c_base + 1) * ln(1 + c_recent), 2) + 0.0 AS score_log, round_even((c_recent + 1) / (c_base + 1) * sqrt(c_recent), 2) + 0.0 AS score_sqrt,
  round_even(ln((c_recent + 1) / (c_base + 1)) * ln(1 + c_recent), 2) + 0.0 AS score_ratio, round_even((recent_mean - base_mean) / (base_std + 0.1), 4) + 0.0 AS z_score, round_even((ln(1 + c_recent) - log_base_mean) / (log_base_std + 0.1), 4) + 0.0 AS z_log
FROM st JOIN tot USING ("window")""",
)(
    lambda s, d: spikes.zscore_metrics(spikes.ratio_metrics(_spike_inputs(s, d))).select(
        "window", "keyword", "c_recent", "c_base", "n_recent", "n_base", *[(F.col(c) + 0.0).alias(c) for c in ("ratio", "score_log", "score_sqrt", "score_ratio", "z_score", "z_log")]
    )
)
query(
    "x03_x04_poisson",
    _SPIKES
    + """, p AS (SELECT "window", keyword, c_recent, greatest(CASE WHEN n_base > 0 THEN c_base / n_base * n_recent ELSE 0.001 END, 0.001) AS lam FROM st JOIN tot USING ("window")),
q AS (SELECT *, CASE WHEN c_recent > 0 THEN greatest(1 - list_sum(list_transform(range(CAST(c_recent AS BIGINT)), lambda k: exp(k * ln(lam) - lam - lgamma(k + 1)))), 1e-300) ELSE 1 END AS p_raw FROM p),
r AS (SELECT *, least(p_raw * count(*) OVER (PARTITION BY "window") / row_number() OVER (PARTITION BY "window" ORDER BY p_raw, keyword), 1) AS step FROM q)
SELECT "window", keyword, round(lam, 4) AS lambda_pois, round(p_raw, 4) AS p_pois,
  round(min(step) OVER (PARTITION BY "window" ORDER BY p_raw, keyword ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 4) AS p_adjusted FROM r""",
)(lambda s, d: spikes.poisson_metrics(_spike_inputs(s, d)).select("window", "keyword", F.round("lambda_pois", 4).alias("lambda_pois"), F.round("p_pois", 4).alias("p_pois"), F.round("p_adjusted", 4).alias("p_adjusted")))


def _spikes_sql(keyword: str, windows: str, kept: str, total: str, family: str, z: str) -> str:
    """All metrics and flags of the detection, from reports on."""
    stat = lambda test, value: f"FILTER (WHERE {test})".join([f"coalesce({value} ", ", 0)"])
    recent, base = "month <= m AND month > m - w", "month <= m - w AND month > m - 2 * w"
    return f"""WITH rows_ AS (SELECT report_key, {keyword} AS keyword, year(date_received) * 12 + month(date_received) AS month FROM reports),
each_ AS (SELECT keyword, month, count(DISTINCT report_key) AS n_reports FROM rows_ WHERE {kept} GROUP BY ALL), total AS (SELECT month, count(DISTINCT report_key) AS n_total FROM rows_ WHERE {total} GROUP BY ALL),
latest AS (SELECT max(month) AS m FROM rows_), win AS (SELECT unnest({windows}) AS w),
st AS (SELECT w AS "window", keyword, {stat(recent, 'sum(n_reports)')} AS c_recent, {stat(recent, 'avg(n_reports)')} AS recent_mean, {stat(base, 'sum(n_reports)')} AS c_base, {stat(base, 'avg(n_reports)')} AS base_mean,
  {stat(base, 'stddev_samp(n_reports)')} AS base_std, {stat(base, 'avg(ln(1 + n_reports))')} AS log_base_mean, {stat(base, 'stddev_samp(ln(1 + n_reports))')} AS log_base_std FROM each_, latest, win GROUP BY ALL),
tot AS (SELECT w AS "window", {stat(recent, 'sum(n_total)')} AS n_recent, {stat(base, 'sum(n_total)')} AS n_base FROM total, latest, win GROUP BY ALL),
sc AS (SELECT *, round_even((c_recent + 1) / (c_base + 1), 2) AS ratio, round_even(ln((c_recent + 1) / (c_base + 1)) * ln(1 + c_recent), 2) AS score_ratio, round_even((recent_mean - base_mean) / (base_std + 0.1), 4) AS z_score,
  round_even((ln(1 + c_recent) - log_base_mean) / (log_base_std + 0.1), 4) AS z_log, greatest(CASE WHEN n_base > 0 THEN c_base / n_base * n_recent ELSE 0.001 END, 0.001) AS lam FROM st JOIN tot USING ("window")),
q AS (SELECT *, CASE WHEN c_recent > 0 THEN greatest(1 - list_sum(list_transform(range(CAST(c_recent AS BIGINT)), lambda k: exp(k * ln(lam) - lam - lgamma(k + 1)))), 1e-300) ELSE 1 END AS p_raw FROM sc),
r AS (SELECT *, least(p_raw * count(*) OVER ({family}) / row_number() OVER ({family} ORDER BY p_raw, keyword, "window"), 1) AS step FROM q),
adj AS (SELECT *, min(step) OVER ({family} ORDER BY p_raw, keyword, "window" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p_adj, avg(score_ratio) OVER (PARTITION BY "window") + 2 * stddev_samp(score_ratio) OVER (PARTITION BY "window") AS bound FROM r),
f AS (SELECT *, c_recent > c_base AND c_recent >= 20 AS ready FROM adj),
flags AS (SELECT *, coalesce(ready AND score_ratio >= bound, FALSE) AS is_spike, ready AND {z} >= 2 AS is_spike_z, ready AND round_even(p_adj, 6) <= 0.05 AS is_spike_p FROM f)
SELECT "window", keyword, CAST(c_recent AS BIGINT) AS c_recent, CAST(c_base AS BIGINT) AS c_base, CAST(n_recent AS BIGINT) AS n_recent, CAST(n_base AS BIGINT) AS n_base, ratio + 0.0 AS ratio, score_ratio + 0.0 AS score_ratio, z_score + 0.0 AS z_score, z_log + 0.0 AS z_log,
  round(lam, 4) AS lambda_pois, round(p_adj, 4) AS p_adjusted, is_spike, is_spike_z, is_spike_p, is_spike::INT + is_spike_z::INT + is_spike_p::INT AS spike_count,
  CASE is_spike::INT + is_spike_z::INT + is_spike_p::INT WHEN 3 THEN 'severe' WHEN 2 THEN 'alert' WHEN 1 THEN 'attention' ELSE 'general' END AS pattern FROM flags"""


def _shown(df: DataFrame) -> DataFrame:
    """The columns of a detection that are compared, without negative zeros."""
    return df.select(
        "window", "keyword", "c_recent", "c_base", "n_recent", "n_base", *[(F.col(c) + 0.0).alias(c) for c in ("ratio", "score_ratio", "z_score", "z_log")],
        F.round("lambda_pois", 4).alias("lambda_pois"), F.round("p_adjusted", 4).alias("p_adjusted"), "is_spike", "is_spike_z", "is_spike_p", "spike_count", "pattern",
    )


_M23 = _spikes_sql("product_code", "[1, 3, 6, 12]", "keyword IS NOT NULL", "keyword IS NOT NULL", 'PARTITION BY "window"', "z_score")
query("m23_spikes", _M23)(lambda s, d: _shown(spikes.detect(reports(s, d), "product_code", dated=dated(s, d))))
# The dashboard's twin: one family of p-values for both windows, totals over all reports, only null keywords left out.
query("m25_spikes_dashboard", _spikes_sql("defect_type", "[1, 3]", "keyword IS NOT NULL", "TRUE", "", "z_log"))(
    lambda s, d: _shown(spikes.detect_dashboard(reports(s, d), "defect_type", dated=dated(s, d)))
)
# Loose bounds and a month in the middle, so that the small tables show some spikes.
_AS_OF = 1998 * 12 + 8
_LOOSE = _M23.replace("c_recent >= 20 AS ready", "c_recent >= 1 AS ready").replace(">= 2 AS is_spike_z", ">= 0.5 AS is_spike_z").replace("+ 2 * stddev_samp(score_ratio)", "+ 0.5 * stddev_samp(score_ratio)").replace("<= 0.05 AS is_spike_p", "<= 0.9 AS is_spike_p")
_LOOSE = _LOOSE.replace("SELECT max(month) AS m FROM rows_", f"SELECT {_AS_OF} AS m")
_loose = lambda s, d: spikes.detect(reports(s, d), "product_code", as_of=_AS_OF, z=0.5, least=1, alpha=0.9)
query("x06_ensemble", f"{_LOOSE} WHERE spike_count >= 1 AND \"window\" = 1")(lambda s, d: _shown(spikes.ensemble(_loose(s, d), 1, window=1)))
query("o05_method_spikes", f"{_LOOSE} WHERE is_spike_z AND \"window\" = 3")(lambda s, d: _shown(spikes.by_method(_loose(s, d), "z", window=3)))
_RESULT = _LOOSE.replace('SELECT "window", keyword, CAST(c_recent', ', result AS (SELECT "window", keyword, CAST(c_recent') + ")"
query(
    "o08_result_table",
    _RESULT + """SELECT keyword, pattern, ratio, c_recent, c_recent - c_base AS increase, c_base, spike_count, is_spike, is_spike_z, is_spike_p
FROM result WHERE pattern IN ('alert', 'attention') AND "window" = 1 ORDER BY ratio DESC, keyword LIMIT 10""",
)(lambda s, d: spikes.result_table(_loose(s, d).where(F.col("window") == 1), ("alert", "attention"), 10).withColumn("ratio", F.col("ratio") + 0.0))
query(
    "g40_spike_summary",
    _RESULT + """SELECT count(*) AS n, count(*) FILTER (spike_count >= 1) AS spikes, count(*) FILTER (pattern = 'severe') AS severe, count(*) FILTER (pattern = 'alert') AS alert, count(*) FILTER (pattern = 'attention') AS attention,
  count(*) FILTER (pattern = 'general') AS general, round(avg(spike_count) FILTER (spike_count >= 1), 4) AS mean_methods, max(ratio) FILTER (spike_count >= 1) AS largest_ratio,
  (SELECT keyword FROM result WHERE spike_count >= 1 ORDER BY ratio DESC, keyword, "window" LIMIT 1) AS largest, count(*) FILTER (spike_count >= 1 AND c_base < 5) AS new_spikes FROM result""",
)(lambda s, d: spikes.summary(_loose(s, d), least=1))
query(
    "w13_rolling_baseline",
    """WITH months AS (SELECT product_code AS keyword, year(date_received) * 12 + month(date_received) AS month, count(DISTINCT report_key) AS n_reports FROM reports GROUP BY ALL),
total AS (SELECT year(date_received) * 12 + month(date_received) AS month, count(DISTINCT report_key) AS n_total FROM reports GROUP BY ALL),
b AS (SELECT *, avg(n_reports) OVER (PARTITION BY keyword ORDER BY month RANGE BETWEEN 14 PRECEDING AND 3 PRECEDING) AS baseline FROM months JOIN total USING (month))
SELECT *, coalesce(round((n_reports + 1) / (baseline + 1), 6), 1.0) AS ratio FROM b""",
)(lambda s, d: spikes.rolling_baseline(spikes.keyword_months(reports(s, d), "product_code"), 3, 6))


def _spike_inputs(s: SparkSession, d: str) -> DataFrame:
    return spikes.window_stats(spikes.keyword_months(reports(s, d), "product_code"), (1, 3, 6, 12), spikes.latest_month(dated(s, d)))


# --- contingency -----------------------------------------------------------------------------------

_CELLS = """WITH o AS (SELECT product_code AS r, defect_type AS c, count(*) AS observed FROM reports GROUP BY ALL),
cells AS (SELECT *, sum(observed) OVER (PARTITION BY r) AS row_total, sum(observed) OVER (PARTITION BY c) AS col_total, sum(observed) OVER () AS n FROM o)
"""
_EFFECT = "CASE WHEN v < 0.1 THEN 'Very Weak' WHEN v < 0.3 THEN 'Weak' WHEN v < 0.5 THEN 'Moderate' ELSE 'Strong' END"


def _chi2_tail(x: str, df: str) -> str:
    """The upper tail of the chi-square law (1 to 60 degrees) by Simpson's rule over t = u * u, where the density is smooth."""
    at = f"(sqrt({x}) * i / 4000)"
    density = f"2 * pow({at}, {df} - 1) * exp(-{at} * {at} / 2) / (pow(2, {df} / 2.0) * gamma({df} / 2.0))"
    return f"greatest(0, 1 - list_sum(list_transform(range(4001), lambda i: (CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * {density})) * sqrt({x}) / 12000)"


_CHOOSE = lambda n, k: f"(lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - ({k}) + 1))"


def _fisher(a: str, b: str, c: str, d: str) -> str:
    """Two-sided p of a 2 x 2 table from its hypergeometric law; a margin of zero gives 1."""
    row, column, n = f"({a} + {b})", f"({a} + {c})", f"({a} + {b} + {c} + {d})"
    log_p = lambda k: f"({_CHOOSE(column, k).replace(f'lgamma({column} - ({k}) + 1)', f'lgamma({column} - {k} + 1)')} + {_CHOOSE(f'({n} - {column})', f'({row} - {k})')} - {_CHOOSE(n, row)})"
    tables = f"range(CAST(greatest(0, {row} + {column} - {n}) AS BIGINT), CAST(least({row}, {column}) AS BIGINT) + 1)"
    return f"least(1, list_sum(list_transform(list_filter({tables}, lambda k: {log_p('k')} <= {log_p(a)} + 1e-7), lambda k: exp({log_p('k')}))))"


query("g15_g16_contingency", _CELLS + "SELECT r, c, observed, CAST(row_total AS BIGINT) AS row_total, CAST(col_total AS BIGINT) AS col_total, CAST(n AS BIGINT) AS n FROM cells")(
    lambda s, d: _cells(s, d)
)
query("x07_chi2_cells", _CELLS + "SELECT r, c, round(row_total * col_total / n, 6) AS expected, round((observed - row_total * col_total / n) / sqrt(row_total * col_total / n), 6) AS residual FROM cells")(
    lambda s, d: stats.chi2_cells(_cells(s, d)).select("r", "c", F.round("expected", 6).alias("expected"), F.round("residual", 6).alias("residual"))
)
query(
    "x07_chi2_by_row",
    _CELLS
    + f""", g AS (SELECT x.r, y.c, x.row_total, y.col_total, x.n, coalesce(z.observed, 0) AS o FROM (SELECT DISTINCT r, row_total, n FROM cells) x CROSS JOIN (SELECT DISTINCT c, col_total FROM cells) y LEFT JOIN cells z ON z.r = x.r AND z.c = y.c)
SELECT r, round(chi2, 4) AS chi2, df, n, round(v, 6) AS cramers_v, {_EFFECT} AS effect, round({_chi2_tail('chi2', 'df')}, 6) AS p FROM (SELECT *, sqrt(chi2 / n) AS v FROM (
  SELECT r, sum(pow(o - row_total * col_total / n, 2) / (row_total * col_total / n) + pow(col_total - o - (n - row_total) * col_total / n, 2) / ((n - row_total) * col_total / n)) AS chi2, count(*) - 1 AS df, CAST(max(n) AS BIGINT) AS n FROM g GROUP BY r))""",
)(lambda s, d: stats.chi2_by_row(_cells(s, d)).select("r", F.round("chi2", 4).alias("chi2"), "df", "n", F.round("cramers_v", 6).alias("cramers_v"), "effect", F.round("p", 6).alias("p")))
query(
    "x10_chi2_global",
    _CELLS
    + f""", g AS (SELECT x.row_total * y.col_total / x.n AS e, coalesce(z.observed, 0) AS o, x.n FROM (SELECT DISTINCT r, row_total, n FROM cells) x CROSS JOIN (SELECT DISTINCT c, col_total FROM cells) y LEFT JOIN cells z ON z.r = x.r AND z.c = y.c),
t AS (SELECT sum(pow(o - e, 2) / e) AS chi2, max(n) AS n FROM g), k AS (SELECT count(DISTINCT r) AS r, count(DISTINCT c) AS c FROM cells)
SELECT round(chi2, 4) AS chi2, df, round(v, 6) AS cramers_v, {_EFFECT} AS effect,
  CASE WHEN df = 1 THEN CASE WHEN chi2 > 10.83 THEN 0.001 WHEN chi2 > 7.88 THEN 0.005 WHEN chi2 > 6.63 THEN 0.01 WHEN chi2 > 3.84 THEN 0.05 ELSE 0.5 END
    WHEN df = 2 THEN CASE WHEN chi2 > 13.82 THEN 0.001 WHEN chi2 > 10.60 THEN 0.005 WHEN chi2 > 9.21 THEN 0.01 WHEN chi2 > 5.99 THEN 0.05 ELSE 0.5 END
    WHEN df >= 3 THEN CASE WHEN chi2 > df + 3 * sqrt(2.0 * df) THEN 0.001 WHEN chi2 > df + 2.5 * sqrt(2.0 * df) THEN 0.01 WHEN chi2 > df + 2 * sqrt(2.0 * df) THEN 0.05 ELSE 0.5 END END::DOUBLE AS p_step
FROM (SELECT chi2, (r - 1) * (c - 1) AS df, sqrt(chi2 / (n * least(r - 1, c - 1))) AS v FROM t, k)""",
)(lambda s, d: stats.chi2_global(_cells(s, d)).select(F.round("chi2", 4).alias("chi2"), "df", F.round("cramers_v", 6).alias("cramers_v"), "effect", stats.step_p(F.col("chi2"), F.col("df")).alias("p_step")))
query(
    "x11_odds_corrected",
    _CELLS
    + """, t AS (SELECT r, c, observed AS a, row_total - observed AS b, col_total - observed AS c_, n - row_total - col_total + observed AS d FROM cells)
SELECT r, c, round((a + 0.5) * (d + 0.5) / ((b + 0.5) * (c_ + 0.5)), 6) AS odds_ratio, round((a + b + c_ + d) * pow(greatest(abs(CAST(a AS DOUBLE) * d - CAST(b AS DOUBLE) * c_) - (a + b + c_ + d) / 2, 0), 2) / (CAST(a + b AS DOUBLE) * (c_ + d) * (a + c_) * (b + d)), 4) AS chi2_yates FROM t""",
)(lambda s, d: stats.odds_ratios_corrected(_cells(s, d)).select("r", "c", F.round("odds_ratio", 6).alias("odds_ratio"), F.round("chi2_yates", 4).alias("chi2_yates")))
query(
    "x08_odds_ratios",
    _CELLS
    + f""", t AS (SELECT r, c, observed AS a, row_total - observed AS b, col_total - observed AS c_, n - row_total - col_total + observed AS d FROM cells),
u AS (SELECT *, CAST(a AS DOUBLE) * d / (CAST(b AS DOUBLE) * c_) AS odds, sqrt(1 / a + 1 / b + 1 / c_ + 1 / d) AS se FROM t WHERE least(a, b, c_, d) >= 3)
SELECT r, c, round(odds, 6) AS odds_ratio, round(exp(ln(odds) - 1.96 * se), 6) AS ci_low, round(exp(ln(odds) + 1.96 * se), 6) AS ci_high, round({_fisher('a', 'b', 'c_', 'd')}, 6) AS p FROM u""",
)(lambda s, d: stats.odds_ratios(_cells(s, d)).select("r", "c", *[F.round(x, 6).alias(x) for x in ("odds_ratio", "ci_low", "ci_high", "p")]))


def _discovery_sql(inputs: str, keys: str, monotone: bool = True, alpha: float = 0.05, order: str = "p") -> str:
    """False discovery over the rows of ``inputs`` (its keys, ``p`` and what ``order`` needs: p may be too small to be told apart)."""
    adjusted = f"min(step) OVER (ORDER BY {order}, {keys} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)" if monotone else "step"
    return f"""{inputs}, st AS (SELECT *, row_number() OVER (ORDER BY {order}, {keys}) AS rank, count(*) OVER () AS m FROM ps WHERE p IS NOT NULL),
bh AS (SELECT *, least(p * m / rank, 1) AS step FROM st), adj AS (SELECT *, {adjusted} AS p_adj FROM bh)
SELECT {keys}, round(p, 6) AS p, rank, round(p_adj, 6) AS p_adjusted, p_adj <= {alpha} AS significant, p < {alpha} AS significant_raw FROM adj"""


_ODDS_P = _CELLS + f""", t AS (SELECT r, c, observed AS a, row_total - observed AS b, col_total - observed AS c_, n - row_total - col_total + observed AS d FROM cells),
ps AS (SELECT r, c, {_fisher('a', 'b', 'c_', 'd')} AS p FROM t WHERE least(a, b, c_, d) >= 3)"""
_ROW_P = _CELLS + f""", g AS (SELECT x.r, y.c, x.row_total, y.col_total, x.n, coalesce(z.observed, 0) AS o FROM (SELECT DISTINCT r, row_total, n FROM cells) x CROSS JOIN (SELECT DISTINCT c, col_total FROM cells) y LEFT JOIN cells z ON z.r = x.r AND z.c = y.c),
ch AS (SELECT r, sum(pow(o - row_total * col_total / n, 2) / (row_total * col_total / n) + pow(col_total - o - (n - row_total) * col_total / n, 2) / ((n - row_total) * col_total / n)) AS chi2, count(*) - 1 AS df FROM g GROUP BY r),
ps AS (SELECT r, chi2, {_chi2_tail('chi2', 'df')} AS p FROM ch)"""


def _found(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.round("p", 6).alias("p"), F.col("rank").cast("long").alias("rank"), F.round("p_adjusted", 6).alias("p_adjusted"), "significant", "significant_raw")


query("x09_false_discovery", _discovery_sql(_ODDS_P, "r, c", alpha=0.9))(lambda s, d: _found(stats.false_discovery(stats.odds_ratios(_cells(s, d)), alpha=0.9, ties=("r", "c")), "r", "c"))
query("x12_false_discovery_plain", _discovery_sql(_ODDS_P, "r, c", monotone=False))(lambda s, d: _found(stats.false_discovery(stats.odds_ratios(_cells(s, d)), monotone=False, ties=("r", "c")), "r", "c"))
query("m24_statistics", _discovery_sql(_ROW_P, "r", order="chi2 DESC"))(lambda s, d: _found(stats.false_discovery(stats.chi2_by_row(_cells(s, d)), ties=("r",)), "r"))
query(
    "x13_full_analysis",
    _discovery_sql(
        _CELLS
        + f""", t AS (SELECT r, c, observed AS a, row_total - observed AS b, col_total - observed AS c_, n - row_total - col_total + observed AS d FROM cells),
y AS (SELECT r, c, (a + b + c_ + d) * pow(greatest(abs(CAST(a AS DOUBLE) * d - CAST(b AS DOUBLE) * c_) - (a + b + c_ + d) / 2, 0), 2) / (CAST(a + b AS DOUBLE) * (c_ + d) * (a + c_) * (b + d)) AS x FROM t WHERE least(a, b, c_, d) >= 3),
ps AS (SELECT r, c, x, {_chi2_tail('x', '1')} AS p FROM y)""",
        "r, c", monotone=False, order="x DESC",
    ),
)(lambda s, d: _found(stats.full_analysis(reports(s, d), "product_code", "defect_type")["final"], "r", "c"))
query(
    "x15_x16_compare_rates",
    f"""WITH f AS (SELECT manufacturer_name, count(*) AS n, sum((patient_harm = 'Death')::INT) AS k FROM reports GROUP BY ALL), w AS (SELECT sum(n) AS n_all, sum(k) AS k_all FROM f),
t AS (SELECT manufacturer_name, k::DOUBLE AS a, (n - k)::DOUBLE AS b, (k_all - k)::DOUBLE AS c, (n_all - n - k_all + k)::DOUBLE AS d FROM f, w), x AS (SELECT *, (a + b + c + d) * pow(greatest(abs(a * d - b * c) - (a + b + c + d) / 2, 0), 2) / nullif((a + b) * (c + d) * (a + c) * (b + d), 0) AS chi2 FROM t),
y AS (SELECT manufacturer_name, chi2, {_chi2_tail('chi2', '1')} AS p FROM x)
SELECT manufacturer_name, round(chi2, 6) AS chi2, round(p, 6) AS p, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS stars,
  CASE WHEN p < 0.001 THEN '매우 유의함 (p < 0.001)' WHEN p < 0.01 THEN '유의함 (p < 0.01)' WHEN p < 0.05 THEN '유의함 (p < 0.05)' ELSE '유의하지 않음 (p ≥ 0.05)' END AS meaning FROM y""",
)(lambda s, d: _rates(s, d))


def _rates(s: SparkSession, d: str) -> DataFrame:
    own = explore.fatality(reports(s, d), "manufacturer_name").select("manufacturer_name", "deaths", "total")
    whole = F.broadcast(own.agg(F.sum("deaths").alias("k"), F.sum("total").alias("n")))
    rest = own.crossJoin(whole).withColumns({"rest_deaths": F.col("k") - F.col("deaths"), "rest_total": F.col("n") - F.col("total")})
    found = stats.compare_rates(rest, "deaths", "total", "rest_deaths", "rest_total")
    return found.select("manufacturer_name", F.round("chi2", 6).alias("chi2"), F.round("p", 6).alias("p"), "stars", "meaning")


query(
    "x17_wilson",
    """WITH f AS (SELECT manufacturer_name, count(*) AS n, sum(CASE WHEN patient_harm = 'Death' THEN 1 ELSE 0 END) AS k FROM reports GROUP BY ALL),
w AS (SELECT *, k / n AS p, 1.959963984540054 AS z FROM f)
SELECT manufacturer_name, round(greatest((p + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(p * (1 - p) / n + z * z / (4.0 * n * n)) / (1 + z * z / n), 0) * 100, 6) AS low,
  round(least((p + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(p * (1 - p) / n + z * z / (4.0 * n * n)) / (1 + z * z / n), 1) * 100, 6) AS high FROM w""",
)(
    lambda s, d: explore.fatality(reports(s, d), "manufacturer_name")
    .withColumns(dict(zip(("low", "high"), stats.wilson(F.col("deaths"), F.col("total")), strict=True)))
    .select("manufacturer_name", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))
)


def _cells(s: SparkSession, d: str) -> DataFrame:
    return stats.contingency(reports(s, d), "product_code", "defect_type")


query(
    "x14_fisher_fatality",
    f"""WITH f AS (SELECT manufacturer_name, count(*) AS n, sum((patient_harm = 'Death')::INT) AS k, round(100.0 * sum((patient_harm = 'Death')::INT) / count(*), 2) AS cfr FROM reports GROUP BY ALL ORDER BY cfr DESC, manufacturer_name LIMIT 10),
t AS (SELECT manufacturer_name, CAST(k AS BIGINT) AS a, CAST(n - k AS BIGINT) AS b, CAST(sum(k) OVER () - k AS BIGINT) AS c, CAST(sum(n) OVER () - n - (sum(k) OVER () - k) AS BIGINT) AS d FROM f), u AS (SELECT *, {_fisher('a', 'b', 'c', 'd')} AS p FROM t)
SELECT manufacturer_name, a, b, c, d, round(p, 6) AS p, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS stars FROM u""",
)(lambda s, d: stats.fisher_among(explore.fatality(reports(s, d), "manufacturer_name", top=10), "manufacturer_name"))

# --- exploration -----------------------------------------------------------------------------------

query(
    "p15_p16_filters",
    "SELECT report_key, line_number, manufacturer_name, product_code FROM reports WHERE product_code IN ('Brand#11', 'Brand#12', 'Brand#21') AND patient_harm IN ('Death') AND strftime(date_received, '%Y-%m') IN ('1996-01', '1996-02', '1997-07')",
)(lambda s, d: explore.filter_reports(reports(s, d), ("1996-01", "1996-02", "1997-07"), product_code=["Brand#11", "Brand#12", "Brand#21"], patient_harm=["Death"], cluster=[]).select("report_key", "line_number", "manufacturer_name", "product_code"))
query("p17_date_range", "SELECT report_key, line_number, date_received FROM reports WHERE date_received BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'")(
    lambda s, d: explore.between_dates(reports(s, d), "1997-01-01", "1997-03-31").select("report_key", "line_number", "date_received")
)
query("p18_p19_labels", "SELECT report_key, line_number, strftime(date_received, '%Y-%m') AS year_month, CASE WHEN manufacturer_name IS NULL OR catalog_number IS NULL THEN '(정보 없음)' ELSE manufacturer_name || ' - ' || catalog_number END AS label FROM reports")(
    lambda s, d: reports(s, d).select("report_key", "line_number", col.year_month(F.col("date_received")).alias("year_month"), col.combo(F.col("manufacturer_name"), F.col("catalog_number")).alias("label"))
)
query("p20_clusters", "SELECT DISTINCT cluster FROM reports WHERE cluster IS NOT NULL AND cluster <> -1")(lambda s, d: explore.values_of(reports(s, d), "cluster", without=(-1,)))
query("p02_distinct_projection", "SELECT DISTINCT product_code AS product, defect_type AS defect FROM reports")(lambda s, d: col.select_distinct(reports(s, d), [("product_code", "product"), ("defect_type", "defect")]))
query("p10_consistency", "SELECT report_key, line_number FROM reports WHERE defect_confirmed = (patient_harm IN ('Death', 'Serious Injury'))")(
    lambda s, d: reports(s, d).where(F.col("defect_confirmed") == F.col("patient_harm").isin("Death", "Serious Injury")).select("report_key", "line_number")
)
query(
    "p11_p13_casts",
    """SELECT o_orderkey, TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS a_date, CAST(round(o_totalprice) AS BIGINT) AS a_number, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS a_flag FROM orders""",
    over_reports=False,
)(
    lambda s, d: col.cast_columns(
        load(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("a_date"), F.col("o_totalprice").cast("string").alias("a_number"), F.col("o_orderstatus").alias("a_flag")),
        {"a_date": "DATE", "a_number": "INTEGER", "a_flag": "BOOLEAN"}, {"a_flag": ("F", "O")},
    )
)
query("p24_representative_date", "SELECT report_key, line_number, coalesce(date_occurred, date_received) AS event_date FROM reports")(
    lambda s, d: reports(s, d, occurred=True).select("report_key", "line_number", F.coalesce("date_occurred", "date_received").alias("event_date"))
)
query("g17_counts_top", "SELECT product_code, defect_type, count(*) AS total_count FROM reports GROUP BY ALL ORDER BY total_count DESC, product_code, defect_type LIMIT 20")(lambda s, d: explore.counts(reports(s, d), ["product_code", "defect_type"], 20))
query("g18_monthly_counts", "SELECT CAST(date_trunc('month', date_received) AS DATE) AS month, product_code, count(*) AS total_count FROM reports GROUP BY ALL")(lambda s, d: explore.monthly(reports(s, d), ["product_code"]))
query("g19_defect_share", "WITH c AS (SELECT product_code, defect_type, count(*) AS n FROM reports GROUP BY ALL) SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY product_code), 2) AS pct FROM c")(lambda s, d: explore.composition(reports(s, d), "product_code", "defect_type"))
_FATAL = """WITH f AS (SELECT {key}, count(*) AS total, sum((patient_harm = 'Death')::INT) AS deaths, sum((patient_harm = 'Serious Injury')::INT) AS serious, sum((patient_harm = 'Minor Injury')::INT) AS minor, sum((patient_harm = 'No Harm')::INT) AS no_harm FROM reports GROUP BY ALL HAVING count(*) >= {least})
SELECT {key}, total, CAST(deaths AS BIGINT) AS deaths, CAST(serious AS BIGINT) AS serious, CAST(minor AS BIGINT) AS minor, CAST(no_harm AS BIGINT) AS no_harm, CAST(deaths + serious AS BIGINT) AS severe,
  round(100.0 * deaths / total, 2) AS cfr, round(100.0 * serious / total, 2) AS serious_rate, round(100.0 * (deaths + serious) / total, 2) AS severe_rate FROM f"""
query("g20_fatality", _FATAL.format(key="manufacturer_name", least=10))(lambda s, d: explore.fatality(reports(s, d), "manufacturer_name", 10))
query("g43_fatality_range", "WITH f AS (SELECT manufacturer_name, round(100.0 * sum((patient_harm = 'Death')::INT) / count(*), 2) AS cfr FROM reports GROUP BY ALL) SELECT min(cfr) AS low, max(cfr) AS high FROM f")(
    lambda s, d: explore.fatality(reports(s, d), "manufacturer_name").agg(F.min("cfr").alias("low"), F.max("cfr").alias("high"))
)
query(
    "g22_period_change",
    """WITH x AS (SELECT count(*) FILTER (date_received BETWEEN DATE '1998-03-01' AND DATE '1998-06-01') AS n_now, count(*) FILTER (date_received BETWEEN DATE '1998-02-01' AND DATE '1998-05-01') AS n_before,
  round(100.0 * count(*) FILTER (date_received BETWEEN DATE '1998-03-01' AND DATE '1998-06-01' AND patient_harm IN ('Death', 'Serious Injury')) / count(*) FILTER (date_received BETWEEN DATE '1998-03-01' AND DATE '1998-06-01'), 2) AS severe_now,
  round(100.0 * count(*) FILTER (date_received BETWEEN DATE '1998-02-01' AND DATE '1998-05-01' AND patient_harm IN ('Death', 'Serious Injury')) / count(*) FILTER (date_received BETWEEN DATE '1998-02-01' AND DATE '1998-05-01'), 2) AS severe_before FROM reports)
SELECT *, n_now - n_before AS n_delta, round(severe_now - severe_before, 2) AS severe_delta FROM x""",
)(lambda s, d: explore.period_change(reports(s, d), "1998-03-01", "1998-06-01"))
query(
    "g23_treemap",
    """WITH t AS (SELECT defect_type, count(*) AS total, round(100.0 * sum((patient_harm IN ('Death', 'Serious Injury'))::INT) / count(*), 2) AS severe_rate FROM reports GROUP BY ALL ORDER BY total DESC, defect_type LIMIT 3)
SELECT r.defect_type, patient_harm, count(*) AS n, total, severe_rate FROM reports r JOIN t USING (defect_type) GROUP BY ALL""",
)(lambda s, d: explore.treemap(reports(s, d)))
_MATRIX = "SELECT product_code, count(*) AS n, round(100.0 * sum((patient_harm IN ('Death', 'Serious Injury'))::INT) / count(*), 2) AS severe_pct, round(100.0 * sum(defect_confirmed::INT) / count(*), 2) AS confirmed_pct FROM reports GROUP BY ALL"
query("g24_risk_matrix", _MATRIX)(lambda s, d: explore.risk_matrix(reports(s, d), "product_code"))
query(
    "g25_quadrants",
    f"""WITH m AS ({_MATRIX}), q AS (SELECT quantile_cont(n, 0.5) AS a, quantile_cont(severe_pct, 0.5) AS b FROM m)
SELECT m.*, CASE WHEN n >= a AND severe_pct >= b THEN 'frequent and severe' WHEN n >= a THEN 'frequent' WHEN severe_pct >= b THEN 'severe' ELSE 'low' END AS quadrant FROM m, q""",
)(lambda s, d: explore.quadrants(explore.risk_matrix(reports(s, d), "product_code")))
query("g27_harm_summary", "SELECT count(*) AS total, count(*) FILTER (patient_harm = 'Death') AS deaths, count(*) FILTER (patient_harm = 'Serious Injury') AS serious, count(*) FILTER (patient_harm = 'Minor Injury') AS minor, count(*) FILTER (patient_harm IN ('No Harm', 'No Apparent Injury')) AS no_harm FROM reports")(
    lambda s, d: explore.harm_summary(reports(s, d))
)
_OVERVIEW = "SELECT cluster, count(*) AS total, count(*) FILTER (patient_harm = 'Death') AS deaths, round(100.0 * count(*) FILTER (patient_harm = 'Death') / count(*), 2) AS cfr, round(100.0 * count(*) FILTER (defect_confirmed) / count(*), 2) AS confirmed_pct FROM reports GROUP BY ALL"
query("g29_cluster_overview", _OVERVIEW)(lambda s, d: explore.cluster_overview(reports(s, d)))
query("g30_cluster_insights", f"WITH o AS ({_OVERVIEW}) SELECT (SELECT cluster FROM o ORDER BY total DESC, cluster LIMIT 1) AS largest, (SELECT cluster FROM o ORDER BY cfr DESC, cluster LIMIT 1) AS highest, (SELECT cluster FROM o ORDER BY cfr, cluster LIMIT 1) AS lowest")(
    lambda s, d: explore.cluster_insights(explore.cluster_overview(reports(s, d)))
)
_WORDS = "SELECT cluster, lower(trim(unnest(problem_components))) AS keyword FROM reports"
query("g31_common_keywords", f"WITH w AS ({_WORDS}) SELECT keyword FROM w WHERE cluster = 0 INTERSECT SELECT keyword FROM w WHERE cluster = 1")(lambda s, d: explore.common_keywords(reports(s, d), "problem_components", 0, 1))
query("g34_statistics", "SELECT avg(l_quantity) AS mean, quantile_cont(l_quantity, 0.5) AS median, stddev_samp(l_quantity) AS std, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem", over_reports=False)(lambda s, d: explore.statistics(load(s, d, "lineitem"), "l_quantity"))
query("g35_date_span", "SELECT min(date_received) AS first, max(date_received) AS last FROM reports")(lambda s, d: reports(s, d).agg(F.min("date_received").alias("first"), F.max("date_received").alias("last")))
query(
    "g38_keyword_table",
    f"""WITH w AS ({_WORDS}), c AS (SELECT cluster, keyword, count(*) AS n FROM w GROUP BY ALL), k AS (SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY cluster), 2) AS ratio, dense_rank() OVER (PARTITION BY cluster ORDER BY n DESC) AS rank FROM c)
SELECT * FROM k WHERE rank <= 3""",
)(lambda s, d: explore.keyword_table(reports(s, d), "problem_components", "cluster", 3))
query("a15_vocabulary", "WITH w AS (SELECT unnest(problem_components) AS keyword FROM reports) SELECT keyword, count(*) AS n FROM w GROUP BY ALL HAVING count(*) >= 100")(lambda s, d: explore.vocabulary(reports(s, d), "problem_components", 100))
query("a16_keyword_text", "SELECT report_key, line_number, coalesce(nullif(array_to_string(list_filter(problem_components, lambda x: lower(x) IN ('red', 'bolt', 'gear')), ', '), ''), 'unknown') AS keywords FROM reports")(
    lambda s, d: reports(s, d).select("report_key", "line_number", explore.keyword_text(F.col("problem_components"), ["red", "bolt", "gear"]).alias("keywords"))
)
query(
    "j20_compare_entities",
    """WITH a AS (SELECT defect_type, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS x FROM reports WHERE product_code = 'Brand#11' GROUP BY ALL), b AS (SELECT defect_type, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS y FROM reports WHERE product_code = 'Brand#12' GROUP BY ALL)
SELECT defect_type, coalesce(x, 0) AS pct_a, coalesce(y, 0) AS pct_b, round(coalesce(x, 0) - coalesce(y, 0), 2) AS difference, round(abs(coalesce(x, 0) - coalesce(y, 0)), 2) AS distance FROM a FULL OUTER JOIN b USING (defect_type)""",
)(lambda s, d: explore.compare_entities(reports(s, d), "product_code", "Brand#11", "Brand#12"))

# --- records ---------------------------------------------------------------------------------------

query(
    "w01_changed_latest",
    """WITH o AS (SELECT o_custkey, o_orderkey, md5(o_orderstatus) AS h, row_number() OVER w AS k, lead(md5(o_orderstatus)) OVER w AS before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC))
SELECT o_custkey, o_orderkey, h FROM o WHERE k = 1 AND h IS DISTINCT FROM before""",
    over_reports=False,
)(lambda s, d: records.changed_latest(load(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", F.md5("o_orderstatus").alias("h")), ["o_custkey"], F.desc("o_orderdate"), "h", [F.desc("o_orderkey")]).drop("o_orderdate"))
query("w02_beyond_first", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS k FROM orders) WHERE k > 1", over_reports=False)(
    lambda s, d: records.beyond_first(load(s, d, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority"], [F.asc("o_orderkey")]).select("o_orderkey")
)
query("w04_distinct_over", "SELECT report_key, line_number, CAST(len(list_distinct(list(manufacturer_name) OVER (PARTITION BY product_code, catalog_number))) AS INT) AS makers FROM reports")(
    lambda s, d: col.count_distinct_over(reports(s, d), "manufacturer_name", ["product_code", "catalog_number"], "makers").select("report_key", "line_number", "makers")
)
query("j10_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')", over_reports=False)(
    lambda s, d: records.without(load(s, d, "customer"), load(s, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]).select("c_custkey")
)
query("j11_not_in", "SELECT p_partkey FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 49)", over_reports=False)(
    lambda s, d: records.not_in(load(s, d, "part"), "p_brand", load(s, d, "part").where("p_size > 49"), "p_brand").select("p_partkey")
)
query(
    "m04_impute_mode",
    """WITH p AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 10 <> 0 THEN p_type END AS p_type FROM part),
m AS (SELECT p_brand, p_type AS mode FROM (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS k FROM p WHERE p_type IS NOT NULL GROUP BY p_brand, p_type) WHERE k = 1)
SELECT p_partkey, p_brand, coalesce(p_type, mode) AS p_type FROM p LEFT JOIN m USING (p_brand)""",
    over_reports=False,
)(lambda s, d: records.impute_mode(load(s, d, "part").select("p_partkey", "p_brand", F.when(F.col("p_partkey") % 10 != 0, F.col("p_type")).alias("p_type")), [("p_brand", "p_type")]))
query(
    "m05_m06_history",
    """WITH o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS effective_from FROM orders), l AS (SELECT *, max(effective_from) OVER (PARTITION BY o_custkey) AS latest FROM o)
SELECT o_custkey, o_orderkey, effective_from, effective_from = latest AS is_current, CASE WHEN effective_from < latest THEN CAST(latest - INTERVAL 1 DAY AS DATE) END AS effective_to FROM l""",
    over_reports=False,
)(lambda s, d: _history(s, d))
query(
    "s14_upsert",
    """WITH t AS (SELECT o_orderkey, o_custkey, 'old' AS batch FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'), n AS (SELECT o_orderkey, o_custkey, 'new' AS batch FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01')
SELECT * FROM n UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)""",
    over_reports=False,
)(
    lambda s, d: records.upsert(
        load(s, d, "orders").where("o_orderdate < '1998-01-01'").select("o_orderkey", "o_custkey", F.lit("old").alias("batch")),
        load(s, d, "orders").where("o_orderdate >= '1997-06-01'").select("o_orderkey", "o_custkey", F.lit("new").alias("batch")), ["o_orderkey"],
    )
)


def _history(s: SparkSession, d: str) -> DataFrame:
    rows = load(s, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("changed"))
    first = records.add_history(rows.where("changed < '1998-01-01'"), "changed", "b1", "test", F.lit(None).cast("timestamp"))
    second = records.add_history(rows.where("changed >= '1998-01-01'"), "changed", "b2", "test", F.lit(None).cast("timestamp"))
    merged = records.upsert(first, second, ["o_custkey", "o_orderkey"])
    return records.expire(merged, ["o_custkey"]).select("o_custkey", "o_orderkey", "effective_from", "is_current", "effective_to")


# --- nested records and texts ----------------------------------------------------------------------


def _orders_nested(s: SparkSession, d: str) -> DataFrame:
    lines = load(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.struct("l_returnflag", "l_linestatus").alias("flags"), "l_quantity"))).alias("lines"))
    rows = load(s, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.select(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), "lines").alias("raw"))


query(
    "a05_a08_flatten_split",
    "SELECT o_orderkey AS key, o_orderstatus AS status, l_linenumber AS lines_l_linenumber, l_returnflag AS lines_flags_l_returnflag FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey",
    over_reports=False,
)(lambda s, d: flatten.flatten(_orders_nested(s, d), "raw", ["key", "status"], split={"lines": ["l_linenumber", "flags.l_returnflag"]}))
query(
    "a06_a07_flatten_first",
    """WITH x AS (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_returnflag, l_linestatus, l_quantity) AS flags, list(l_linenumber ORDER BY l_linenumber) AS numbers FROM lineitem GROUP BY ALL)
SELECT o_orderkey AS key, numbers[1] AS lines_l_linenumber, array_to_string(flags, ',') AS flags FROM orders LEFT JOIN x ON l_orderkey = o_orderkey""",
    over_reports=False,
)(lambda s, d: flatten.flatten(_orders_nested(s, d), "raw", ["key"], {"lines": ["l_linenumber"]}, {"lines": ["flags.l_returnflag"]}).select("key", "lines_l_linenumber", F.array_join("lines_flags_l_returnflag", ",").alias("flags")))
query("a11_combine_texts", "SELECT conv_id, string_agg('[' || role || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY turn, role, text) AS body FROM conversations GROUP BY conv_id", over_reports=False)(lambda s, d: _conversations(s, d))


def _conversations(s: SparkSession, d: str) -> DataFrame:
    turns = load(s, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return turns.select("conv_id", flatten.combine_texts(F.col("t.role"), F.col("t.text")).alias("body"))


query("f_json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events", over_reports=False)(lambda s, d: load(s, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")))
query(
    "t01_t04_clean_names",
    r"""SELECT p_partkey, nullif(trim(regexp_replace(regexp_replace(p_name, '[0-9]+|red', '', 'g'), '\s+', ' ', 'g')), '') AS removed, CASE WHEN NOT regexp_full_match(p_name, '(small .*)|(hot gear)') THEN p_name END AS deleted, CASE WHEN regexp_full_match(p_type, 'S.*') THEN p_type END AS kept FROM part""",
    over_reports=False,
)(
    lambda s, d: load(s, d, "part").select(
        "p_partkey", clean.tidy(clean.remove(F.col("p_name"), ["[0-9]+", "red"])).alias("removed"), clean.delete(F.col("p_name"), ["small .*", "hot gear"]).alias("deleted"), clean.keep(F.col("p_type"), ["S.*"]).alias("kept")
    )
)
query("t05_t07_clean_columns", "SELECT s_suppkey, nullif(trim(replace(upper(s_name) || ' GERMANY', 'GERMANY', '')), '') AS name FROM supplier", over_reports=False)(lambda s, d: clean.clean_columns(load(s, d, "supplier").select("s_suppkey", F.concat(F.upper("s_name"), F.lit(" GERMANY")).alias("name")), {"name": [("remove_country",), ("delete", clean.MISSING), ("tidy",)]}))
query(
    "t10_parent_company",
    "SELECT s_suppkey, CASE WHEN upper(trim(s_name)) LIKE 'SUPPLIER#00000001%' THEN 'ELEVEN' WHEN upper(trim(s_name)) LIKE 'SUPPLIER#0000000%' THEN 'PARENT' ELSE s_name END AS parent FROM supplier",
    over_reports=False,
)(lambda s, d: load(s, d, "supplier").select("s_suppkey", clean.parent_company(F.col("s_name"), {"SUPPLIER#0000000": "PARENT", "SUPPLIER#00000001": "ELEVEN"}).alias("parent")))
query(
    "t11_identifiers",
    r"""WITH x AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '+H' || p_partkey || '/x' WHEN 1 THEN '(01)' || lpad(CAST(p_partkey AS VARCHAR), 14, '0') || '(17)260101' WHEN 2 THEN 'ABC' ELSE '12-3' END AS public, CASE WHEN p_size < 10 THEN 'own' END AS target FROM part)
SELECT p_partkey, coalesce(target, CASE WHEN regexp_matches(public, '^\+[A-Z0-9]+') THEN regexp_extract(public, '^\+([A-Z0-9]+)', 1) WHEN regexp_matches(public, '\(01\)\d{14}') THEN regexp_extract(public, '\(01\)(\d{14})', 1) WHEN regexp_matches(public, '^[A-Za-z]+$') THEN public END) AS udi_di FROM x""",
    over_reports=False,
)(
    lambda s, d: load(s, d, "part").select(
        "p_partkey",
        clean.identifier_of(
            F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("+H"), "p_partkey", F.lit("/x"))).when(F.col("p_partkey") % 4 == 1, F.concat(F.lit("(01)"), F.lpad(F.col("p_partkey").cast("string"), 14, "0"), F.lit("(17)260101"))).when(F.col("p_partkey") % 4 == 2, "ABC").otherwise("12-3"),
            F.when(F.col("p_size") < 10, "own"),
        ).alias("udi_di"),
    )
)

# --- matching, clusters, extraction ----------------------------------------------------------------


@query("t13_fuzzy_ratio")
def t13(s: SparkSession, d: str) -> DataFrame:
    names = load(s, d, "part").select("p_name").distinct()
    return names.select("p_name", fuzzy_score(F.col("p_name"), F.lit("small ring")).alias("score"))


@query("j03_fuzzy_best")
def j03(s: SparkSession, d: str) -> DataFrame:
    part = load(s, d, "part")
    return matching.fuzzy_best(part.where("p_brand <> 'Brand#11'").select(F.col("p_name").alias("name")), part.where("p_brand = 'Brand#11'").select(F.col("p_name").alias("name")), 0.7)


def _match_inputs(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = reports(s, d).withColumnRenamed("manufacturer_name", "maker_")
    target = rows.select("report_key", "line_number", "udi_di", F.col("product_code").alias("manufacturer"), "model_number", "catalog_number", F.col("date_received").alias("target_date"))
    part = load(s, d, "part")
    key = F.col("p_partkey")
    source = part.select(
        (key - key % 2).cast("string").alias("udi_di"), (key - key % 3).cast("string").alias("primary_udi_di"), F.col("p_brand").alias("manufacturer"), F.col("p_type").alias("model_number"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_size").cast("string")).alias("catalog_number"), F.add_months(F.lit("1996-01-01").cast("date"), F.col("p_size")).alias("source_date"),
    )
    return target, source


query(
    "m01_match_identifiers",
    """WITH t AS (SELECT report_key, line_number, udi_di, product_code AS manufacturer, model_number, catalog_number, date_received AS target_date FROM reports),
s AS (SELECT CAST(p_partkey - p_partkey % 2 AS VARCHAR) AS udi, CAST(p_partkey - p_partkey % 3 AS VARCHAR) AS prim, p_brand AS m, p_type AS model, CASE WHEN p_size % 7 <> 0 THEN CAST(p_size AS VARCHAR) END AS cat, CAST(DATE '1996-01-01' + to_months(p_size) AS DATE) AS sd FROM part),
np AS (SELECT udi, count(DISTINCT prim) AS k FROM s GROUP BY udi),
direct AS (SELECT udi, prim FROM (SELECT s.*, row_number() OVER (PARTITION BY udi ORDER BY sd DESC NULLS LAST, prim) AS k FROM s JOIN np USING (udi) WHERE np.k = 1) WHERE k = 1),
amb AS (SELECT udi, prim FROM (SELECT s.udi, s.prim, row_number() OVER (PARTITION BY s.udi ORDER BY sd DESC NULLS LAST, prim) AS k FROM t JOIN s ON t.udi_di = s.udi AND t.manufacturer = s.m JOIN np ON np.udi = s.udi
  WHERE np.k > 1 AND target_date > sd AND coalesce((model_number = model)::INT, 0) + coalesce((catalog_number = cat)::INT, 0) >= 1) WHERE k = 1),
meta AS (SELECT manufacturer, model_number, catalog_number, prim FROM (SELECT t.manufacturer, t.model_number, t.catalog_number, s.prim, row_number() OVER (PARTITION BY t.manufacturer, t.model_number, t.catalog_number ORDER BY sd DESC NULLS LAST, prim) AS k
  FROM t JOIN s ON t.manufacturer = s.m WHERE t.udi_di IS NULL AND target_date > sd AND coalesce((model_number = model)::INT, 0) + coalesce((catalog_number = cat)::INT, 0) >= 1) WHERE k = 1)
SELECT report_key, line_number, coalesce(direct.prim, amb.prim) AS matched_udi_di, CASE WHEN direct.prim IS NOT NULL THEN 'UDI SUCCESS' WHEN amb.prim IS NOT NULL THEN 'META SUCCESS' ELSE 'UDI FAILED' END AS match_status,
  CASE WHEN direct.prim IS NOT NULL THEN 'HIGH' WHEN amb.prim IS NOT NULL THEN 'MEDIUM' ELSE 'VERY LOW' END AS match_confidence
FROM t LEFT JOIN direct ON t.udi_di = direct.udi LEFT JOIN amb ON t.udi_di = amb.udi WHERE t.udi_di IS NOT NULL
UNION ALL SELECT report_key, line_number, prim, CASE WHEN prim IS NULL THEN 'NO MATCH' ELSE 'NO UDI META SUCCESS' END, CASE WHEN prim IS NULL THEN 'VERY LOW' ELSE 'LOW' END
FROM t LEFT JOIN meta ON t.manufacturer = meta.manufacturer AND t.model_number IS NOT DISTINCT FROM meta.model_number AND t.catalog_number IS NOT DISTINCT FROM meta.catalog_number WHERE t.udi_di IS NULL""",
)(lambda s, d: matching.match_identifiers(*_match_inputs(s, d), ["model_number", "catalog_number"]).select("report_key", "line_number", "matched_udi_di", "match_status", "match_confidence"))
query(
    "m17_centroids",
    "SELECT label, CAST(pos - 1 AS INT) AS pos, round(avg(x), 5) + 0.0 AS value FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) WHERE label <> -1 GROUP BY ALL",
    over_reports=False,
)(lambda s, d: clusters.centroids(load(s, d, "embeddings"), "embedding", "label").select("label", F.posexplode("centroid").alias("pos", "value")).withColumn("value", F.round("value", 5) + 0.0))
query(
    "m16_nearest",
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings), c AS (SELECT label AS cl, pos, avg(x) AS c FROM x WHERE label <> -1 GROUP BY ALL),
dist AS (SELECT vec_id, cl, sum((x - c) * (x - c)) AS d FROM x JOIN c USING (pos) GROUP BY ALL)
SELECT vec_id, cl AS assigned, round(sqrt(d), 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cl) AS k FROM dist) WHERE k = 1""",
    over_reports=False,
)(lambda s, d: clusters.nearest(load(s, d, "embeddings"), "vec_id", "embedding", clusters.centroids(load(s, d, "embeddings"), "embedding", "label"), "label").select("vec_id", "assigned", F.round("distance", 6).alias("distance")))
query(
    "m18_cluster_quality",
    """WITH z AS (SELECT cluster AS label, count(*) AS n FROM reports GROUP BY ALL), o AS (SELECT *, row_number() OVER (ORDER BY n, label) AS rank, n / sum(n) OVER () AS p FROM z WHERE label <> -1), t AS (SELECT sum(n) AS a, coalesce(sum(n) FILTER (label = -1), 0) AS noise FROM z),
one AS (SELECT count(*) AS k, sum(-p * ln(p)) AS e, max(p) AS max_ratio, sum(rank * n) AS ranked, sum(n) AS s FROM o)
SELECT k, round(noise / a, 6) AS noise_ratio, round(e / ln(k), 6) AS entropy, round(2 * ranked / (k * s) - (k + 1) / k, 6) AS gini, round(max_ratio, 6) AS max_ratio FROM one, t""",
)(lambda s, d: clusters.cluster_quality(reports(s, d), "cluster").select("k", *[F.round(c, 6).alias(c) for c in ("noise_ratio", "entropy", "gini", "max_ratio")]))
_VECTORS = "e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE label <> -1)"
_LONG = "x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"
query(
    "m15_features",
    f"""WITH {_LONG}, st AS (SELECT pos, avg(x) AS m, stddev_pop(x) AS s, count(*) AS n FROM x GROUP BY pos), k AS (SELECT count(*) AS dims FROM st)
SELECT vec_id, CAST(pos AS INT) AS pos, round(CASE WHEN s > 0 THEN (x - m) / s ELSE 0 END, 5) + 0.0 AS value FROM x JOIN st USING (pos)
UNION ALL SELECT vec_id, CAST(dims + i AS INT), CASE WHEN label = i THEN 0.5 ELSE 0 END FROM embeddings, k, (SELECT unnest([0, 1, 2]) AS i)""",
    over_reports=False,
)(lambda s, d: clusters.standardise(load(s, d, "embeddings"), "embedding", {"label": [0, 1, 2]}, 0.5).select("vec_id", F.posexplode("features").alias("pos", "value")).withColumn("value", F.round("value", 5) + 0.0))
query(
    "m19_separation",
    f"""WITH {_VECTORS}, {_LONG}, cl AS (SELECT label, pos, avg(x) AS c FROM x WHERE label <> -1 GROUP BY ALL), ct AS (SELECT label, list(c ORDER BY pos) AS c FROM cl GROUP BY label),
inner_ AS (SELECT e.label, list_distance(v, c) AS d FROM e JOIN ct USING (label)), w AS (SELECT sum(d * d) AS w, count(*) AS n, count(DISTINCT label) AS k FROM inner_),
whole AS (SELECT sum(q) AS t FROM (SELECT var_pop(x) * count(*) AS q FROM x WHERE label <> -1 GROUP BY pos)), s AS (SELECT label, avg(d) AS s FROM inner_ GROUP BY label),
r AS (SELECT a.label, max((sa.s + sb.s) / list_distance(a.c, b.c)) AS r FROM ct a JOIN ct b ON a.label <> b.label JOIN s sa ON sa.label = a.label JOIN s sb ON sb.label = b.label GROUP BY a.label),
p AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) AS d, count(*) AS n FROM e a, e b GROUP BY ALL),
si AS (SELECT vec_id, max(d / nullif(n - 1, 0)) FILTER (own = other) AS a, min(d / n) FILTER (own <> other) AS b, max(n) FILTER (own = other) AS m FROM p GROUP BY vec_id)
SELECT round((t - w) / (k - 1) / (w / (n - k)), 4) AS calinski_harabasz, round(w / n, 4) AS within, (SELECT round(avg(r), 4) FROM r) AS davies_bouldin,
  (SELECT round(avg(CASE WHEN m = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 4) FROM si) AS silhouette FROM w, whole""",
    over_reports=False,
)(lambda s, d: clusters.separation(load(s, d, "embeddings"), "embedding", "label").select(*[F.round(c, 4).alias(c) for c in ("calinski_harabasz", "within", "davies_bouldin", "silhouette")]))
query("m20_cluster_score")(lambda s, d: clusters.composite_score(clusters.cluster_quality(load(s, d, "embeddings"), "label").crossJoin(clusters.silhouette(load(s, d, "embeddings"), "embedding", "label"))))
query(
    "m12_retry",
    """WITH e AS (SELECT p_name AS text, min(CASE p_type WHEN 'PROMO' THEN 'Other' WHEN 'MEDIUM' THEN 'Unknown' ELSE p_type END) AS defect_type FROM part WHERE p_size < 3 GROUP BY ALL)
SELECT DISTINCT p_name AS text FROM part LEFT JOIN e ON p_name = text WHERE defect_type IS NULL OR defect_type IN ('Unknown', 'Other')""",
    over_reports=False,
)(
    lambda s, d: extraction.to_retry(
        load(s, d, "part").select(F.col("p_name").alias("text")),
        load(s, d, "part").where("p_size < 3").groupBy(F.col("p_name").alias("text")).agg(F.min(F.when(F.col("p_type") == "PROMO", "Other").when(F.col("p_type") == "MEDIUM", "Unknown").otherwise(F.col("p_type"))).alias("defect_type")), "text",
    )
)

from tidewatch import catalog_views  # noqa: E402, F401  it registers its queries with these
