"""Registered queries of filters, cleaning rules, steps, sources and the exploration views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.adapter import load, reports
from tidewatch.functions import clean, rules
from tidewatch.operators import extraction, flatten, matching, records, steps
from tidewatch.plans import explore
from tidewatch.registry import query

_SEVERE = "patient_harm IN ('Death', 'Serious Injury')"
_ROWS = "SELECT report_key, line_number"
_key = lambda df: df.select("report_key", "line_number")

# --- scoping and quality ---------------------------------------------------------------------------

query("p07_scope_events", f"{_ROWS} FROM reports WHERE product_code = 'Brand#11' AND len(problem_components) > 0")(
    lambda s, d: _key(records.scope_events(reports(s, d), "product_code", "problem_components", "Brand#11"))
)
query("p08_scope_devices", f"{_ROWS} FROM reports WHERE list_contains(problem_components, 'small')")(lambda s, d: _key(records.scope_devices(reports(s, d), "problem_components", "small")))
_GRADED = "graded AS (SELECT *, CASE cluster WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'LOW' ELSE 'VERY LOW' END AS match_confidence FROM reports)"


def _graded(s: SparkSession, d: str) -> DataFrame:
    c = F.col("cluster")
    return reports(s, d, occurred=True).withColumn("match_confidence", F.when(c == 0, "HIGH").when(c == 1, "MEDIUM").when(c == 2, "LOW").otherwise("VERY LOW"))


query("p09_trusted", f"WITH {_GRADED} {_ROWS} FROM graded WHERE manufacturer_name IS NOT NULL AND match_confidence IN ('HIGH', 'MEDIUM', 'LOW')")(lambda s, d: _key(records.trusted(_graded(s, d))))
query(
    "w03_quality_chain",
    f"""WITH {_GRADED}, low AS (SELECT * FROM graded WHERE match_confidence <> 'VERY LOW'),
twice AS (SELECT report_key FROM (SELECT report_key, row_number() OVER (PARTITION BY date_occurred, manufacturer_name, defect_type, catalog_number ORDER BY report_key) AS k FROM low WHERE catalog_number IS NOT NULL) WHERE k > 1),
logical AS (SELECT * FROM low WHERE report_key NOT IN (SELECT report_key FROM twice) AND defect_confirmed = ({_SEVERE}))
SELECT report_key, line_number, udi_di FROM (SELECT *, row_number() OVER (PARTITION BY report_key, udi_di ORDER BY report_key, line_number) AS k FROM logical) WHERE k = 1""",
)(
    lambda s, d: records.quality_filter(
        _graded(s, d), "report_key", ["date_occurred", "manufacturer_name", "defect_type", "catalog_number"], F.col("defect_confirmed"), F.col("patient_harm").isin("Death", "Serious Injury"), "udi_di", [F.asc("line_number")]
    ).select("report_key", "line_number", "udi_di")
)
query(
    "w01_changed_this_month",
    """WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, md5(o_orderstatus) AS h, row_number() OVER w AS k, lead(md5(o_orderstatus)) OVER w AS before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC))
SELECT o_custkey, o_orderkey FROM o WHERE k = 1 AND h IS DISTINCT FROM before AND date_trunc('month', o_orderdate + INTERVAL 9 HOUR) = DATE '2001-06-01'""",
    over_reports=False,
)(
    lambda s, d: records.changed_this_month(
        load(s, d, "orders").withColumn("h", F.md5("o_orderstatus")), ["o_custkey"], "o_orderdate", "h", F.lit("2001-06-15 00:00:00").cast("timestamp"), ties=[F.desc("o_orderkey")]
    ).select("o_custkey", "o_orderkey")
)

# --- cleaning rules --------------------------------------------------------------------------------


def _rule_sql(column: str, own: list[tuple], countries: list[str]) -> str:
    """A column's rules as nested SQL expressions."""
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    out = column
    for kind, *rest in own:
        if kind == "tidy":
            out = f"nullif(trim(regexp_replace({out}, '\\s+', ' ', 'g')), '')"
        elif kind == "remove":
            out = f"regexp_replace({out}, {quote('|'.join(rest[0]))}, '', 'g')"
        elif kind == "remove_country":
            names = "|".join(sorted(countries, key=lambda c: (-len(c), c)))
            out = f"nullif(trim(regexp_replace({out}, {quote(f'(?i)\\b(?:{names})\\b')}, '')), '')"
        else:
            test = f"regexp_full_match({out}, {quote('|'.join(f'(?:{p})' for p in rest[0]))})"
            out = f"CASE WHEN {'NOT ' if kind == 'delete' else ''}{test} THEN {out} END"
    return out


_EVENT_INPUT = """x AS (SELECT p_partkey, p_name || ' ' || p_partkey AS mdr_text, CASE p_partkey % 5 WHEN 0 THEN '(01)00' || p_partkey WHEN 1 THEN '+A' || p_partkey || 'B9' WHEN 2 THEN 'X' ELSE 'D-' || p_partkey || 'ABCD' END AS udi_di,
  CASE p_partkey % 3 WHEN 0 THEN 'No answer provided' ELSE p_type END AS event_type, CASE p_partkey % 3 WHEN 0 THEN 'I' WHEN 1 THEN '*' ELSE 'R' END AS previous_use_flag, CASE p_partkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'U' ELSE 'N' END AS single_use_flag,
  CASE p_partkey % 4 WHEN 0 THEN '#* ' || p_name WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN '123' ELSE repeat(chr(34), 3) || p_name || chr(34) END AS brand_name, CASE p_partkey % 4 WHEN 0 THEN 'REF: ' || p_size WHEN 1 THEN 'N/A' WHEN 2 THEN '(10)' || p_size ELSE '-' END AS catalog_number,
  CASE p_partkey % 4 WHEN 0 THEN 'LOT #' || p_partkey || ', X' WHEN 1 THEN p_partkey || ' EXP: 2020' WHEN 2 THEN '000' ELSE 'PROTOTYPE 7' END AS lot_number,
  CASE p_partkey % 6 WHEN 0 THEN 'THE ACME MEDICAL CO. GERMANY' WHEN 1 THEN 'BETA, INC.; PARIS' WHEN 2 THEN '12 MAIN STREET' WHEN 3 THEN 'GAMMA / DELTA LTD' WHEN 4 THEN 'UNK' ELSE upper(p_name) || ' CORPORATION' END AS manufacturer_name,
  CASE p_partkey % 4 WHEN 0 THEN '**' || p_type WHEN 1 THEN 'A' WHEN 2 THEN '(GTIN) ' || p_size ELSE p_type || ' (TRIED TWICE)' END AS model_number,
  CASE p_partkey % 4 WHEN 0 THEN '+ABCDEFG' || p_size WHEN 1 THEN '(01)00000000000000' WHEN 2 THEN '9' || p_size ELSE 'letters' END AS udi_public FROM part)"""


def _dirty(s: SparkSession, d: str) -> DataFrame:
    """The input of the rule sets, through Spark's own SQL."""
    return s.sql("WITH " + _EVENT_INPUT.replace("FROM part)", "FROM {part})") + " SELECT * FROM x", part=load(s, d, "part"))


for _name, _rules in (("t08_event_rules", rules.EVENT_RULES), ("t09_udi_rules", rules.UDI_RULES)):
    _columns = [c for c in _rules if c not in ("product_problems", "reprocessed_and_reused_flag")]
    query(_name, f"WITH {_EVENT_INPUT} SELECT p_partkey, {', '.join(f'{_rule_sql(c, _rules[c], clean.COUNTRIES)} AS {c}' for c in _columns)} FROM x", over_reports=False)(
        lambda s, d, r=_rules, c=tuple(_columns): clean.clean_columns(_dirty(s, d), r).select("p_partkey", *c)
    )
query("t08_problem_list", "SELECT p_partkey, array_to_string(list_filter([p_type, 'Unclear Information', 'Leak'], lambda x: x <> 'Unclear Information'), '|') AS problems FROM part", over_reports=False)(
    lambda s, d: clean.clean_columns(load(s, d, "part").withColumn("product_problems", F.array("p_type", F.lit("Unclear Information"), F.lit("Leak"))), rules.EVENT_RULES).select("p_partkey", F.array_join("product_problems", "|").alias("problems"))
)
query("t04_plain_text", "SELECT p_partkey, p_name || ' Grosse e c - ' || chr(34) || 'x' || chr(34) AS text FROM part", over_reports=False)(
    lambda s, d: load(s, d, "part").select("p_partkey", clean.plain_text(F.concat("p_name", F.lit(" Große\té  ç – “x” "))).alias("text"))
)
_HOMES = ["GERMANY", "BRAZIL", "EGYPT", "NEPAL"]
query("t05_all_countries", "SELECT s_suppkey, upper(s_name) AS name FROM supplier", over_reports=False)(
    lambda s, d: load(s, d, "supplier").select("s_suppkey", clean.remove_country(F.concat_ws(" ", F.upper("s_name"), F.get(F.array(*map(F.lit, _HOMES)), (F.col("s_suppkey") % 4).cast("int"))), rules.country_names(s)).alias("name"))
)

# --- nested records --------------------------------------------------------------------------------


def _texts(s: SparkSession, d: str) -> DataFrame:
    part = F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size"), F.struct(F.col("p_type").alias("kind"), F.split("p_name", " ").alias("words")).alias("more"))
    return load(s, d, "part").select("p_partkey", F.to_json(F.struct(F.col("p_partkey").alias("key"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("brand"), F.array(part).alias("parts"))).alias("raw"))


query("a01_a04_keys", "SELECT * FROM (VALUES ('key', 'BIGINT'), ('brand', 'STRING'), ('parts', 'ARRAY'), ('name', 'string'), ('size', 'bigint'), ('more.kind', 'string')) t(path, kind)", over_reports=False)(
    lambda s, d: _keys(s, flatten.discovered(_texts(s, d), "raw"))
)


def _keys(s: SparkSession, kind) -> DataFrame:
    return s.createDataFrame(flatten.top_keys(kind) + flatten.breadth_first(kind["parts"].dataType), "path string, kind string")


query("a09_nested_lists", "SELECT p_partkey, p_type AS parts_more_kind, array_to_string(string_split(p_name, ' '), '|') AS words FROM part", over_reports=False)(lambda s, d: _nested(s, d))


def _nested(s: SparkSession, d: str) -> DataFrame:
    texts = _texts(s, d)
    parsed = texts.withColumn("raw", F.from_json("raw", flatten.discovered(texts, "raw")))
    flat = flatten.flatten(parsed, "raw", split={"parts": ["more.kind", "more.words"]}, keep=["p_partkey"])
    return flat.select("p_partkey", "parts_more_kind", F.array_join("parts_more_words", "|").alias("words"))


query("a13_a14_words", "SELECT cluster, lower(trim(w)) AS keyword, count(*) AS n FROM (SELECT cluster, unnest(problem_components) AS w FROM reports) WHERE w <> '' GROUP BY ALL")(
    lambda s, d: explore.explode_words(reports(s, d).withColumn("problem_components", F.to_json(F.transform("problem_components", lambda x: F.concat(F.lit(" "), F.upper(x))))), "problem_components", trim_first=True).groupBy("cluster", "keyword").agg(F.count(F.lit(1)).alias("n"))
)

# --- steps -----------------------------------------------------------------------------------------

query(
    "p01_step_builder",
    "SELECT DISTINCT n_name, r_name, upper(c_mktsegment) AS c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal > 0",
    over_reports=False,
)(lambda s, d: _built(s, d))


def _built(s: SparkSession, d: str) -> DataFrame:
    joins = [(load(s, d, "nation"), [("c_nationkey", "n_nationkey")], "inner"), (load(s, d, "region"), [("n_regionkey", "r_regionkey")], "left")]
    wide = steps.build_step(load(s, d, "customer"), joins=joins, where=[F.col("c_acctbal") > 0], replace={"c_mktsegment": F.upper("c_mktsegment")})
    return steps.build_step(wide, select=["n_name", "r_name", "c_mktsegment"], distinct=True)


query("p03_final_projection", "SELECT DISTINCT p_brand AS product_code, p_type AS kind FROM part", over_reports=False)(
    lambda s, d: steps.final_columns(load(s, d, "part"), [{"name": "p_brand", "alias": "product_code", "final": True}, {"name": "p_name"}, {"name": "p_type", "alias": "kind", "final": True}])
)
query("p04_all_but", "SELECT * EXCLUDE (p_retailprice, p_name) FROM part", over_reports=False)(lambda s, d: load(s, d, "part").drop("p_retailprice", "p_name"))
query(
    "m00_registry",
    "SELECT 'event' AS category, 2 AS stage, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000 UNION ALL SELECT 'udi', -1, 0",
    over_reports=False,
)(lambda s, d: _registry(s, d))


def _registry(s: SparkSession, d: str) -> DataFrame:
    r = steps.Registry()
    r.start("event", load(s, d, "orders"))
    r.start("udi", load(s, d, "part"))
    r.register("scope", lambda df, c: df.where("o_orderstatus = 'F'") if c == "event" else df.where("p_size < 0"), ("event", "udi"))
    r.register("price", lambda df, c: df.where("o_totalprice > 1000"), ("event",))
    r.register("never", lambda df, c: df.where("no_such_column = 1"), ("udi",))
    done = r.run_all(["scope", "price", "never"])
    out = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("category"), F.lit(r.stage[c]).alias("stage"), "n") for c, df in done.items()]
    return reduce(DataFrame.unionByName, out)


query("p21_cascade", "SELECT DISTINCT 'product' AS kind, product_code AS value FROM reports WHERE manufacturer_name = 'Supplier#000000003' UNION ALL SELECT DISTINCT 'device', manufacturer_name || ' - ' || product_code FROM reports WHERE manufacturer_name = 'Supplier#000000003' AND product_code = 'Brand#12'")(
    lambda s, d: _cascade(s, d)
)


def _cascade(s: SparkSession, d: str) -> DataFrame:
    lists = explore.cascade(reports(s, d), ["Supplier#000000003"], ["Brand#12"])
    return lists["products"].select(F.lit("product").alias("kind"), F.col("product_code").alias("value")).unionByName(lists["devices"].select(F.lit("device").alias("kind"), F.col("device").alias("value")))


query(
    "p20_value_lists",
    """SELECT DISTINCT 'months' AS list, strftime(date_received, '%Y-%m') AS value FROM reports UNION ALL SELECT DISTINCT 'manufacturers', manufacturer_name FROM reports UNION ALL SELECT DISTINCT 'products', product_code FROM reports
UNION ALL SELECT DISTINCT 'defects', defect_type FROM reports UNION ALL SELECT DISTINCT 'clusters', CAST(cluster AS VARCHAR) FROM reports WHERE cluster <> -1""",
)(lambda s, d: reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("list"), F.col(df.columns[0]).cast("string").alias("value")) for k, df in explore.value_lists(reports(s, d)).items()]))
query("p23_labels", f"{_ROWS}, CASE WHEN defect_confirmed THEN '결함 있음' ELSE '결함 없음' END AS label, CASE WHEN defect_type IN ('Other', 'Unknown') THEN '알 수 없음' ELSE defect_type END AS kind FROM reports")(
    lambda s, d: reports(s, d).select("report_key", "line_number", explore.flag_label(F.col("defect_confirmed")).alias("label"), explore.flag_label(F.when(F.col("defect_type") == "Other", "Unknown").otherwise(F.col("defect_type"))).alias("kind"))
)

# --- views -----------------------------------------------------------------------------------------

_WORDS = "SELECT *, lower(trim(unnest(problem_components))) AS keyword FROM reports"
_CHECK = f"""WITH own AS (SELECT * FROM reports WHERE cluster = 1), t AS (SELECT count(*) AS t FROM own),
x AS (SELECT 'harm' AS section, CASE WHEN patient_harm IN ('No Harm', 'No Apparent Injury') THEN 'No Harm' ELSE patient_harm END AS label, count(*) AS n FROM own GROUP BY ALL
UNION ALL SELECT * FROM (SELECT 'component', keyword, count(*) AS n FROM ({_WORDS}) WHERE cluster = 1 GROUP BY ALL ORDER BY n DESC, keyword LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'defect', defect_type, count(*) AS n FROM own WHERE defect_type <> '' GROUP BY ALL ORDER BY n DESC, defect_type LIMIT 5)
UNION ALL SELECT 'confirmed', CASE WHEN defect_confirmed THEN '결함 있음' ELSE '결함 없음' END, count(*) FROM own GROUP BY ALL)
SELECT section, label, n, round(100.0 * n / t, 2) AS ratio FROM x, t UNION ALL SELECT 'month', strftime(date_received, '%Y-%m'), count(*), NULL FROM own GROUP BY ALL"""
query("g28_cluster_check", _CHECK)(
    lambda s, d: reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("section"), "label", "n", "ratio") for k, df in explore.cluster_check(reports(s, d), 1, 5).items()])
)
query(
    "g44_cluster_headline",
    f"""SELECT count(*) AS total, count(*) FILTER (patient_harm = 'Death') AS deaths, count(*) FILTER (patient_harm = 'Serious Injury') AS serious, count(*) FILTER (patient_harm = 'Minor Injury') AS minor, count(*) FILTER ({_SEVERE}) AS severe,
  round(100.0 * count(*) FILTER ({_SEVERE}) / count(*), 2) AS cfr, round(100.0 * count(*) FILTER (patient_harm = 'Death') / count(*), 2) AS death_rate, round(100.0 * count(*) FILTER (patient_harm = 'Serious Injury') / count(*), 2) AS serious_rate,
  round(100.0 * count(*) FILTER (patient_harm = 'Minor Injury') / count(*), 2) AS minor_rate FROM reports WHERE cluster = 2""",
)(lambda s, d: explore.cluster_headline(reports(s, d), 2))
query(
    "g30_shared_components",
    f"""WITH w AS (SELECT cluster, keyword, count(*) AS n FROM ({_WORDS}) WHERE cluster <> -1 GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, keyword) AS k FROM w)
SELECT keyword, count(*) AS clusters FROM b WHERE k <= 3 GROUP BY keyword HAVING count(*) > 1 ORDER BY clusters DESC, keyword LIMIT 3""",
)(lambda s, d: explore.shared_components(reports(s, d)))
query(
    "g21_defect_components",
    f"WITH w AS ({_WORDS}), o AS (SELECT keyword AS problem_component, count(*) AS n FROM w WHERE defect_type = 'SMALL' GROUP BY ALL) SELECT problem_component, n, round(100.0 * n / (SELECT sum(n) FROM o), 2) AS percentage FROM o ORDER BY n DESC, problem_component LIMIT 7",
)(lambda s, d: explore.defect_components(reports(s, d), "SMALL", 7))
query("g26_monthly_severity", f"SELECT CAST(date_trunc('month', date_received) AS DATE) AS month, count(*) AS n, count(*) FILTER ({_SEVERE}) AS severe, round(100.0 * count(*) FILTER ({_SEVERE}) / count(*), 4) AS severe_rate FROM reports GROUP BY ALL")(
    lambda s, d: explore.monthly_severity(reports(s, d))
)
query(
    "g22_sparkline",
    f"SELECT CAST(date_trunc('month', date_received) AS DATE) AS month, count(*) AS n, round(100.0 * count(*) FILTER ({_SEVERE}) / count(*), 4) AS severe_rate, round(100.0 * count(*) FILTER (defect_confirmed) / count(*), 4) AS confirmed_rate FROM reports WHERE date_received BETWEEN DATE '1998-01-01' AND DATE '1998-06-30' GROUP BY ALL",
)(lambda s, d: explore.sparkline(reports(s, d), "1998-06-10"))
_CRITICAL = f"SELECT defect_type, count(*) FILTER ({_SEVERE}) / count(*) * 100 AS r FROM reports WHERE defect_type NOT IN ('Unknown', 'Other') AND date_received BETWEEN DATE '{{}}' AND DATE '{{}}' GROUP BY ALL ORDER BY r DESC, defect_type LIMIT 1"
query(
    "g22_critical_defect",
    f"WITH a AS ({_CRITICAL.format('1998-03-01', '1998-06-01')}), b AS ({_CRITICAL.format('1998-02-01', '1998-05-01')}) SELECT a.defect_type AS defect_now, round(a.r, 4) AS rate_now, b.defect_type AS defect_before, round(b.r, 4) AS rate_before FROM a, b",
)(lambda s, d: explore.critical_defect(reports(s, d), "1998-03-01", "1998-06-01"))
_DEVICE = "dv AS (SELECT *, manufacturer_name || ' - ' || product_code AS device FROM reports)"
query(
    "g41_eda_insights",
    f"""WITH {_DEVICE}, c AS (SELECT device, count(*) AS n, round(100.0 * count(*) FILTER ({_SEVERE}) / count(*), 2) AS r FROM dv GROUP BY device), f AS (SELECT * FROM c WHERE n >= 3 ORDER BY r DESC, device LIMIT 5)
SELECT * FROM (SELECT 'top_device' AS kind, device AS subject, CAST(n AS DOUBLE) AS value FROM c ORDER BY n DESC, device LIMIT 1) UNION ALL SELECT * FROM (SELECT 'high_rate', device, r FROM f WHERE r > 5 ORDER BY r DESC, device LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'top_defect', defect_type, CAST(count(*) AS DOUBLE) AS n FROM reports GROUP BY defect_type ORDER BY n DESC, defect_type LIMIT 1)""",
)(lambda s, d: explore.eda_insights(reports(s, d), 3))
query(
    "g42_top_combos",
    f"WITH {_DEVICE}, f AS (SELECT * FROM dv WHERE defect_type IN ('SMALL', 'LARGE', 'ECONOMY')), b AS (SELECT device FROM f GROUP BY device ORDER BY count(*) DESC, device LIMIT 5) SELECT device, defect_type, count(*) AS n FROM f WHERE device IN (SELECT device FROM b) GROUP BY ALL",
)(lambda s, d: explore.top_combos(reports(s, d), ("SMALL", "LARGE", "ECONOMY"), 5))
query("g43_fatality_all", "WITH f AS (SELECT round(100.0 * count(*) FILTER (patient_harm = 'Death') / count(*), 2) AS cfr FROM reports GROUP BY manufacturer_name) SELECT min(cfr) AS low, max(cfr) AS high, round(max(cfr) - min(cfr), 2) AS range, (SELECT round(100.0 * count(*) FILTER (patient_harm = 'Death') / count(*), 2) FROM reports) AS overall FROM f")(
    lambda s, d: explore.fatality_range(explore.fatality(reports(s, d), "manufacturer_name"), reports(s, d))
)
query("g33_filtered_top", "SELECT product_code, count(*) AS total_count FROM reports WHERE patient_harm IN ('Death', 'Minor Injury') AND date_received BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' AND cluster = 1 GROUP BY ALL ORDER BY total_count DESC, product_code LIMIT 5")(
    lambda s, d: explore.top_by_column(reports(s, d).withColumn("day", F.col("date_received").cast("string")), "product_code", 5, {"patient_harm": ["Death", "Minor Injury"], "day": ("1997-01-01", "1999-12-31"), "cluster": 1, "defect_type": None})
)
_NUMBERS = ("p_partkey", "p_size", "p_retailprice")
query(
    "g34_all_statistics",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, quantile_cont({c}::DOUBLE, 0.5) AS median, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS low, max({c})::DOUBLE AS high FROM part" for c in _NUMBERS),
    over_reports=False,
)(lambda s, d: explore.all_statistics(load(s, d, "part")).withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)}))
_PAIRED = ("product_code", "defect_type", "patient_harm")
query(
    "g36_pair_compositions",
    " UNION ALL ".join(
        f"SELECT * FROM (WITH c AS (SELECT {a} AS g, {b} AS p, count(*) AS n FROM reports GROUP BY ALL) SELECT '{a}' AS group_column, g AS group_value, '{b}' AS part_column, p AS part_value, n, round(n / sum(n) OVER (PARTITION BY g), 4) AS pct FROM c)"
        for a, b in explore.column_pairs(_PAIRED)
    ),
)(lambda s, d: explore.pair_compositions(reports(s, d), _PAIRED))
query("g37_g39_keyword_shares", f"WITH w AS ({_WORDS}), c AS (SELECT cluster, keyword, count(*) AS n FROM w GROUP BY ALL) SELECT *, round(n / sum(n) OVER (PARTITION BY cluster), 8) AS ratio FROM c")(
    lambda s, d: explore.keyword_shares(reports(s, d), "problem_components", "cluster").withColumn("ratio", F.round("ratio", 8))
)

# --- extraction ------------------------------------------------------------------------------------

_HARM = "CASE WHEN contains(lower(text), 'death') OR contains(lower(text), 'died') THEN 'Death' WHEN contains(lower(text), 'surgery') THEN 'Serious Injury' WHEN contains(lower(text), 'injur') THEN 'Minor Injury' ELSE 'No Harm' END"
query(
    "m09_m11_extraction",
    rf"""WITH c AS (SELECT DISTINCT text FROM conversations WHERE text NOT IN (SELECT text FROM conversations WHERE turn = 0)), w AS (SELECT text, list_sort(list_distinct(list_filter(string_split_regex(lower(text), '\s+'), lambda x: length(x) > 9)))[1:5] AS words FROM c)
SELECT text, {_HARM} AS patient_harm, to_json(words)::VARCHAR AS problem_components, contains(lower(text), 'defect') AS defect_confirmed, 'Other' AS defect_type FROM w""",
    over_reports=False,
)(
    lambda s, d: extraction.as_rows(
        extraction.validated(extraction.extract(extraction.candidates(load(s, d, "conversations").select("text"), load(s, d, "conversations").where("turn = 0").select("text"), "text"), "text")), "text"
    )
)
query("m08_open_records", "SELECT DISTINCT p_name, coalesce(CASE WHEN p_size > 25 THEN p_type END, '') AS kind FROM part WHERE p_partkey % 2 = 0 AND p_name NOT IN (SELECT p_name FROM part WHERE p_size = 7)", over_reports=False)(
    lambda s, d: extraction.open_records(load(s, d, "part").withColumn("kind", F.when(F.col("p_size") > 25, F.col("p_type"))), load(s, d, "part").where("p_size = 7").select("p_name"), "p_name", ("kind",), F.col("p_partkey") % 2 == 0)
)
query(
    "m12_retry_upsert",
    """WITH old AS (SELECT p_name AS text, min(p_type) AS t FROM part GROUP BY p_name), k AS (SELECT text, 'Unknown' AS patient_harm, CASE WHEN t = 'ECONOMY' THEN 'Unknown' ELSE t END AS defect_type FROM old)
SELECT text, CASE WHEN defect_type = 'Unknown' THEN 'No Harm' ELSE patient_harm END AS patient_harm, CASE WHEN defect_type = 'Unknown' THEN 'Other' ELSE defect_type END AS defect_type FROM k""",
    over_reports=False,
)(lambda s, d: _retried(s, d))


def _retried(s: SparkSession, d: str) -> DataFrame:
    part = load(s, d, "part")
    old = part.groupBy(F.col("p_name").alias("text")).agg(F.min("p_type").alias("t"))
    old = old.select("text", F.lit("Unknown").alias("patient_harm"), F.when(F.col("t") == "ECONOMY", "Unknown").otherwise(F.col("t")).alias("defect_type"))
    return extraction.retry(part.select(F.col("p_name").alias("text")), old, "text")


query("j13_j14_joined", "SELECT p_partkey, p_name, t.patient_harm, e.label AS cluster FROM part LEFT JOIN (SELECT p_name, 'Death' AS patient_harm FROM part WHERE p_size < 5 GROUP BY p_name) t USING (p_name) LEFT JOIN embeddings e ON vec_id = p_partkey", over_reports=False)(
    lambda s, d: extraction.with_clusters(
        extraction.with_extraction(load(s, d, "part").select("p_partkey", "p_name"), load(s, d, "part").where("p_size < 5").select("p_name", F.lit("Death").alias("patient_harm")), "p_name"),
        load(s, d, "embeddings").select(F.col("vec_id").alias("p_partkey"), F.col("label").alias("cluster")), "p_partkey",
    ).select("p_partkey", "p_name", "patient_harm", "cluster")
)
query("m14_embed", "SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS DOUBLE) AS words FROM part", over_reports=False)(
    lambda s, d: extraction.embed(load(s, d, "part"), "p_name", extraction.hashed_words).select("p_partkey", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).alias("words"))
)
query("j04_rewrite_names", "SELECT p_partkey, CASE WHEN starts_with(p_name, 'small ') THEN 'tiny ' || substr(p_name, 7) ELSE p_name END AS p_name FROM part", over_reports=False)(
    lambda s, d: matching.rewrite_names(load(s, d, "part").select("p_partkey", "p_name"), "p_name", load(s, d, "part").select(F.col("p_name").alias("name"), F.concat(F.lit("tiny "), F.expr("substr(p_name, 7)")).alias("other")).where("name LIKE 'small %'").distinct())
)
