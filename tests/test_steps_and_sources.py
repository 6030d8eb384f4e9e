"""Steps, sources, extraction and labels that no SQL looks at."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import clean, rules
from tidewatch.functions.kernels import deploy_udfs, poisson_cdf
from tidewatch.operators import extraction, matching, steps
from tidewatch.plans import explore, stats
from tidewatch.sources import io


def test_registry(spark):
    r = steps.Registry()
    r.start("event", spark.range(5))
    r.start("udi", spark.range(5))
    r.register("half", lambda df, c: df.where("id > 2") if c == "event" else df.where("id > 9"), ("event", "udi"))
    r.register("both", lambda df: df.withColumn("x", F.lit(1)))
    assert r.categories("half") == ("event", "udi")
    out = r.run_all(["half", "both"])
    assert out["event"].columns == ["id", "x"] and out["event"].count() == 2
    assert r.stage == {"event": 2, "udi": -1} and r.run("both", "udi") is None
    assert r.cleanup("udi") == 2 and r.cleanup("event") == 3 and r.stage == {}


def test_step_builder(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k long, v string")
    right = spark.createDataFrame([(1, 10), (None, 20)], "key long, w int")
    assert steps.equi_join(left, right, [("k", "key")], "left").where("w IS NOT NULL").count() == 1
    assert steps.build_step(left, replace={"v": F.upper("v")}, where=[F.col("k") == 1]).first()["v"] == "A"
    with pytest.raises(ValueError):
        steps.build_step(left, select=["k"], replace={"v": F.lit(1)})


def test_tables(spark, tmp_path):
    columns = [{"name": "k", "type": "bigint", "nullable": False}, {"name": "v"}]
    path = str(tmp_path / "t")
    assert io.ensure_table(spark, path, columns).count() == 0
    assert io.insert_rows(spark, path, [(1, "é"), (2, None)], columns) == 2
    table = spark.read.parquet(path)
    assert table.count() == 2 and [tuple(r) for r in io.schema_of(table).collect()] == [("k", "bigint", 1), ("v", "string", 2)]
    io.write_csv(table, str(tmp_path / "c"), F.col("v").isNotNull())
    text = next((tmp_path / "c").glob("part-*")).read_bytes()
    assert text.startswith(b"\xef\xbb\xbf") and text.count(b"\n") == 2
    io.write_sized(spark.range(25).coalesce(1), str(tmp_path / "j"), 10)
    assert len(list((tmp_path / "j").glob("*.json.gz"))) == 3 and spark.read.json(str(tmp_path / "j")).count() == 25
    io.replace_table(table.limit(1), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1
    assert io.latest_batch(spark.createDataFrame([(1, 5), (2, 9)], "k int, ingest_time int")).first()["k"] == 2
    assert io.drop_tables(spark, [path, str(tmp_path / "none")]) == 1
    assert io.dataset_path({"root": "/data/"}, "a") == ("/data/a", {})
    assert io.dataset_path({"kind": "s3", "bucket": "b", "prefix": "p/", "storage_options": {"x": "1"}}, "a") == ("s3a://b/p/a", {"x": "1"})


def test_load_report_with_a_broken_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"results": [{"k": 1}, {"k": 2}]}')
    (tmp_path / "b.json").write_text("{broken")
    raw = io.read_documents(spark, str(tmp_path))
    rows = io.bronze(raw, ["k"], "b1", "test")
    assert {f: n for f, n in io.load_report(raw.select("source_file", "results").cache(), rows, rows).first().asDict().items()} == {"files": 2, "broken": 1, "inserted": 2, "total": 2}


def test_udfs(spark):
    status = deploy_udfs(spark, {"broken": 7})
    assert status["fisher_p"] == "ok" and status["broken"] != "ok"
    assert spark.sql("SELECT clean_text('  a \t b ') AS x, clean_text(' ') AS y, first_word(' one two') AS z").first()[:] == ("a b", None, "one")


def test_poisson_law():
    import math

    for k, rate in ((0, 0.3), (3, 2.5), (40, 31.0), (200, 150.0)):
        assert poisson_cdf(k, rate) == pytest.approx(math.fsum(math.exp(i * math.log(rate) - rate - math.lgamma(i + 1)) for i in range(k + 1)), rel=1e-9)


def test_extraction_flow(spark):
    assert extraction.normalised(["plain", None, {"mdr_text": "t", "product_problems": ["a", "b"]}]) == [
        {"text": "plain", "problems": ""}, {"text": "", "problems": ""}, {"text": "t", "problems": "a, b"},
    ]
    vectors = extraction.embed(spark.createDataFrame([("a b a",), (None,)], "t string"), "t", extraction.hashed_words).collect()
    assert sorted(sum(r.embedding) for r in vectors) == [0.0, 3.0]


def test_rules_and_labels(spark):
    row = spark.createDataFrame([("THE ACME MEDICAL CO., INC. NORWAY", "LOT# 12, EXP 2020", "Ærø – ça")], "manufacturer_name string, lot_number string, t string")
    out = clean.clean_columns(row, rules.EVENT_RULES, rules.country_names(spark)).first()
    assert (out.manufacturer_name, out.lot_number) == ("ACME", "12")
    assert row.select(clean.plain_text(F.col("t"))).first()[0] == "AEro - ca"
    p = spark.createDataFrame([(0.0005,), (0.02,), (0.05,)], "p double").select(stats.stars(F.col("p")).alias("s"), stats.significance(F.col("p")).alias("w")).collect()
    assert [r.s for r in p] == ["***", "*", ""] and p[2].w.startswith("유의하지")
    assert [r[0] for r in spark.createDataFrame([("severe",), ("general",)], "x string").select(explore.pattern_label(F.col("x"))).collect()] == ["🔴 심각", "🟢 일반"]


def test_matching_needs_as_many_columns_as_asked(spark):
    target = spark.createDataFrame([(1, None, "m", "a", "b", "2020-01-02"), (2, None, "m", "a", "x", "2020-01-02"), (3, "u", "m", "a", "b", "2020-01-02")], "k int, udi_di string, manufacturer string, model string, cat string, target_date string").withColumn("target_date", F.to_date("target_date"))
    source = spark.createDataFrame([("u", "p1", "m", "a", "b", "2020-01-01"), ("u", "p2", "m", "a", "c", "2019-01-01"), ("v", "p3", "m", "a", "b", "2021-01-01")], "udi_di string, primary_udi_di string, manufacturer string, model string, cat string, source_date string").withColumn("source_date", F.to_date("source_date"))
    got = {r.k: (r.matched_udi_di, r.match_status) for r in matching.match_identifiers(target, source, ["model", "cat"], 2).collect()}
    assert got == {1: ("p1", "NO UDI META SUCCESS"), 2: (None, "NO MATCH"), 3: ("p1", "META SUCCESS")}


def test_fisher_tails_against_all_tables():
    import math
    import random

    from tidewatch.functions.kernels import fisher_exact

    rng = random.Random(1)
    for _ in range(300):
        a, b, c, d = (rng.randint(0, rng.choice((3, 12, 60))) for _ in range(4))
        n, row, col = a + b + c + d, a + b, a + c
        weights = {k: math.comb(col, k) * math.comb(n - col, row - k) for k in range(max(0, row + col - n), min(row, col) + 1)}
        want = sum(w for w in weights.values() if w <= weights[a] * (1 + 1e-7)) / math.comb(n, row)
        assert fisher_exact(a, b, c, d) == pytest.approx(want, rel=1e-9)
