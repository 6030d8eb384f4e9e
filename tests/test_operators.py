"""Operators on small hand-made rows: edges that the tables do not hold."""

from __future__ import annotations

import datetime
import math
import os

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import clean, kernels
from tidewatch.functions import columns as col
from tidewatch.operators import extraction, flatten, matching, records
from tidewatch.plans import explore, gold, spikes, stats
from tidewatch.sources import io
from tidewatch.streaming import ingest


def one(df):
    return [tuple(r) for r in df.collect()]


def test_casts(spark):
    df = spark.createDataFrame([("20240230", "12.5", "Y"), ("2024-01-02", "1x", "N"), ("20240102", "7", "Q"), ("", None, None)], "d string, n string, f string")
    got = one(col.cast_columns(df, {"d": "DATE", "n": "INTEGER", "f": "BOOLEAN"}, {"f": ("Y", "N")}))
    day = datetime.date(2024, 1, 2)
    assert got == [(None, 13, True), (day, None, False), (day, 7, None), (None, None, None)]
    with pytest.raises(ValueError, match="codes"):
        col.cast_columns(df, {"f": "BOOLEAN"})


def test_clean(spark):
    df = spark.createDataFrame([("UNKNOWN CO",), ("N/A",), ("XI",), ("ACME  germany ",), ("UNKNOWNS",), (None,)], "x string")
    got = [r[0] for r in clean.clean_columns(df, {"x": [("delete", clean.MISSING), ("remove_country",), ("tidy",)]}).collect()]
    assert got == [None, None, "XI", "ACME", "UNKNOWNS", None]
    arrays = spark.createDataFrame([(["n/a", "ok", None],)], "a array<string>")
    assert arrays.select(clean.filter_array(F.col("a"), ["(?i)n/a"])).first()[0] == ["ok"]
    ids = spark.createDataFrame([("+ABCD1234/x", None), ("(01)00012345678905(17)1", None), ("ABC", None), ("+A", "own"), ("1-2", None)], "p string, t string")
    assert [r[0] for r in ids.select(clean.identifier_of(F.col("p"), F.col("t"))).collect()] == ["ABCD1234", "00012345678905", "ABC", "own", None]


def test_flatten(spark):
    raw = spark.createDataFrame([(1, [("a", (2,)), ("b", (3,))]), (2, []), (3, None)], "id int, devices array<struct<brand: string, info: struct<model: int>>>")
    df = raw.select(F.struct("id", "devices").alias("raw"))
    assert one(flatten.flatten(df, "raw", ["id"], split={"devices": ["brand", "info.model"]})) == [(1, "a", 2), (1, "b", 3), (2, None, None), (3, None, None)]
    assert one(flatten.flatten(df, "raw", ["id"], {"devices": ["brand"]})) == [(1, "a"), (2, None), (3, None)]
    assert flatten.paths(df.schema["raw"].dataType["devices"].dataType) == [("brand", "string"), ("info.model", "int")]
    texts = spark.createDataFrame([(["D", None], ["one", "two"]), ([], [])], "c array<string>, t array<string>")
    assert [r[0] for r in texts.select(flatten.combine_texts(F.col("c"), F.col("t"))).collect()] == ["[D]\none\n\n[]\ntwo", ""]
    tagged = spark.createDataFrame([(1, "Primary", "p"), (1, "Other", "q"), (2, "Other", "r")], "rec int, kind string, v string")
    assert sorted(r.primary_id or "" for r in flatten.primary_of(tagged, "rec", "kind", "v").collect()) == ["", "p", "p"]


def test_history(spark):
    day = lambda n: datetime.date(2024, 1, n)
    rows = [("a", day(1), True), ("a", day(5), True), ("b", day(2), True), ("b", day(2), True), (None, day(1), True), (None, day(9), True)]
    df = spark.createDataFrame([(*r, None) for r in rows], "k string, effective_from date, is_current boolean, effective_to date")
    got = sorted(one(records.expire(df, ["k"])), key=str)
    closed = [r for r in got if not r[2]]
    assert closed == [("a", day(1), False, day(4))]
    with_null = records.upsert(df.select("k"), df.select("k").where("k IS NULL"), ["k"])
    assert with_null.where("k IS NULL").count() == 4  # null keys never match


def test_not_in(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    gone = lambda *v: spark.createDataFrame([(x,) for x in v], "y string")
    assert one(records.not_in(left, "x", gone("a"), "y")) == [("b",)]
    assert one(records.not_in(left, "x", gone("a", None), "y")) == []
    assert len(one(records.not_in(left, "x", gone(), "y"))) == 3


def test_mode_ties_and_steps(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", None), (None, "z"), ("h", None)], "g string, t string")
    assert sorted(one(records.impute_mode(df, [("g", "t")])), key=str) == [("g", "a"), ("g", "a"), ("g", "b"), ("h", None), (None, "z")]
    add = lambda d: d.withColumn("n", F.lit(1))
    assert records.run_steps(df, [("x", 1, add), ("y", -1, lambda d: d.drop("g")), ("z", 3, add)]).columns == ["g", "t", "n"]
    chain = records.filter_chain({"s": df}, [("one", "s", [F.col("g").isNotNull()], None), ("two", "one", [F.col("t").isNotNull()], lambda d: d.distinct())])
    assert chain.count() == 2


def test_kernels(spark):
    assert kernels.indel_ratio("kitten", "sitting") == pytest.approx(2 * 4 / 13)
    assert kernels.indel_ratio("", "") == 1.0
    assert kernels.fisher_exact(3, 1, 1, 3) == pytest.approx(0.4857142857)
    assert kernels.chi2_upper(3.841458820694124, 1) == pytest.approx(0.05)
    assert kernels.chi2_upper(5.991464547107979, 2) == pytest.approx(0.05)
    assert kernels.poisson_cdf(2, 1.5) == pytest.approx(math.exp(-1.5) * (1 + 1.5 + 1.125))
    df = spark.createDataFrame([(200, 0.001), (0, 3.0)], "c int, r double")
    assert [r[0] for r in df.select(kernels.poisson_upper("c", "r")).collect()] == [1e-300, 1.0]
    assert "fisher_p" in kernels.register_udfs(spark)
    assert spark.sql("SELECT round(fuzzy_match_score('AB', 'ab'), 2) x, fuzzy_match_score(null, 'a') y").first() == (1.0, 0.0)


def test_corrections(spark):
    df = spark.createDataFrame([(1, k, p) for k, p in (("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", 0.03))], "window int, keyword string, p double")
    got = {r.r: r.p_adjusted for r in stats.false_discovery(df.withColumnRenamed("keyword", "r"), ties=("r",)).collect()}
    assert got == pytest.approx({"a": 0.04, "b": 0.04, "c": 0.04, "d": 0.04})
    assert df.select(spikes.corrected("p", "bonferroni", ["window"]).alias("x")).agg(F.max("x")).first()[0] == pytest.approx(0.16)
    with pytest.raises(ValueError, match="unknown correction"):
        spikes.corrected("p", "holm", ["window"])


def test_spikes_edges(spark):
    day = lambda m: datetime.date(2024, m, 3)
    rows = [(i, day(6), "up") for i in range(30)] + [(100 + i, day(5), "up") for i in range(2)] + [(200, day(5), "gone"), (300, day(6), None)]
    df = spark.createDataFrame([(*r, "m") for r in rows], "report_key int, date_received date, word string, manufacturer_name string")
    got = {r.keyword: r for r in spikes.detect(df, "word", (1,)).collect()}
    assert (got["up"].c_recent, got["up"].c_base, got["up"].base_std) == (30, 2, 0.0)
    assert got["gone"].c_recent == 0 and got["gone"].p_pois == 1.0
    assert got["up"].is_spike_z
    assert spikes.detect(df.limit(0), "word").collect() == []


def test_all_is_not_null(spark):
    rows = [(1, datetime.date(2024, 1, 1), None, "Death", True, 0), (2, datetime.date(2024, 1, 2), "m", None, None, 0)]
    df = spark.createDataFrame(rows, "report_key int, date_received date, manufacturer_name string, patient_harm string, defect_confirmed boolean, cluster int")
    got = {r.manufacturer: r.report_count for r in gold.cluster_monthly(df).collect()}
    assert got == {None: 1.0, "m": 1.0, "ALL": 2.0}


def test_keywords(spark):
    df = spark.createDataFrame([(0, "['Red ', 'bolt']"), (0, '["red", ""]'), (0, "junk"), (1, None)], "cluster int, words string")
    assert sorted(r.keyword for r in explore.explode_words(df, "words").collect()) == ["bolt", "red", "red"]
    assert explore.keyword_table(df, "words", "cluster", 1).collect()[0].keyword == "red"


def test_fuzzy_finds_what_brute_force_finds(spark):
    names, known = ["ACME CORP", "ACNE CORP", "BOSTON", "X", "KNOWN", None], ["ACME CORPS", "BOSTON SCI", "KNOWN", "ACME CORP."]
    frame = lambda v: spark.createDataFrame([(x,) for x in v], "name string")
    got = {r.name: r.other for r in matching.fuzzy_best(frame(names), frame(known), 0.75).collect()}
    want = {}
    for n in names:
        if n and n not in known:
            score, other = min((-kernels.indel_ratio(n, k), k) for k in known)
            if -score >= 0.75:
                want[n] = other
    assert got == want


def test_wilson_and_stars(spark):
    low, high = stats.wilson(F.col("k"), F.col("n"))
    df = spark.createDataFrame([(0, 0), (0, 10), (10, 10)], "k int, n int")
    got = one(df.select(low, high))
    assert got[0] == (0.0, 0.0) and got[1][0] == 0.0 and got[2][1] == pytest.approx(100.0)


def test_extraction(spark):
    texts = spark.createDataFrame([("a death occurred",), ("boom",), ("fine",)], "text string")
    parsed = extraction.validated(extraction.extract(texts, "text", lambda t: {"boom": None}[t] if t == "boomx" else (1 / 0 if t == "boom" else extraction.rule_extractor(t))))
    assert {r.text: r.patient_harm for r in parsed.collect()} == {"a death occurred": "Death", "fine": "No Harm"}


def test_io(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text('{"results": [{"k": 1, "v": "x"}, {"k": 2, "v": null}]}')
    rows = io.bronze(io.read_documents(spark, str(tmp_path / "raw")), ["k"], "b1", "s")
    assert sorted((r.k, r.raw_data.v) for r in rows.collect())[0] == ("1", "x")
    snapshots = spark.createDataFrame([("d1", 1.0), ("d2", float("nan"))], "snapshot_date string, x double")
    path = str(tmp_path / "snap")
    io.replace_snapshot(snapshots, path)
    io.replace_snapshot(spark.createDataFrame([("d1", 5.0)], "snapshot_date string, x double"), path)
    assert {(r.snapshot_date, r.x) for r in spark.read.parquet(path).collect()} == {("d1", 5.0), ("d2", None)}
    io.write_csv(snapshots, str(tmp_path / "c"))
    assert io.read_table(spark, str(tmp_path / "c"), "csv").count() == 2
    assert io.append_by_name(snapshots, snapshots.select(F.col("x").alias("X"))).count() == 4
    assert io.ingest_years(2025) == (2023, 2025)
    manifest = {"results": {"device": {"event": {"partitions": [{"file": "u/2023q1/a.json.zip"}, {"file": "u/2019q1/b.json.zip"}]}, "udi": {"partitions": [{"file": "u/z.json.zip"}]}}}}
    assert io.manifest_urls(manifest, "event", 2022, 2024) == ["u/2023q1/a.json.zip"]
    assert io.object_key("u/2023q1/a.json.zip", "202401") == "202401/a.json.gz"
    with pytest.raises(ValueError, match="unknown category"):
        io.manifest_urls(manifest, "x", 1, 2)


def test_stream_merge(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(source)
    schema = spark.read.parquet(source).schema
    run = lambda: ingest.merge_new_files(spark, source, schema, target, ["k"], str(tmp_path / "cp")).awaitTermination()
    run()
    spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string").write.mode("append").parquet(source)
    run()
    assert sorted(one(spark.read.parquet(f"{target}/version=1"))) == [(1, "a"), (2, "c"), (3, "d")]
    spark.createDataFrame([(3, "e"), (3, "f")], "k int, v string").write.mode("append").parquet(source)
    run()
    assert sorted(one(spark.read.parquet(f"{target}/version=2"))) == [(1, "a"), (2, "c"), (3, "f")]
    assert sorted(d for d in os.listdir(target) if d.startswith("version")) == ["version=1", "version=2"]


def test_newest_by_key(spark):
    rows = [(1, 5, "a"), (1, None, "z"), (1, 7, "b"), (1, 7, "c"), (2, None, None), (None, 1, "x"), (None, 1, "x")]
    df = spark.createDataFrame(rows, "k int, t int, v string").repartition(3)
    assert sorted(one(ingest.newest_by_key(df, ["k"], "t")), key=str) == [(1, 7, "c"), (2, None, None), (None, 1, "x"), (None, 1, "x")]
    assert one(ingest.newest_by_key(df.limit(0), ["k"])) == []


def test_gold_query_has_every_window(spark):
    from tidewatch import catalog

    rows = catalog.QUERIES["m22_gold_tables"](spark, "/root/testdata/sf0.001").groupBy("table_name", "grain").count().collect()
    assert {(r.table_name, r.grain) for r in rows} == {(f"{g}_{w}M_DASHBOARD", g) for g in ("CLUSTER", "DEFECT", "PRODUCT", "OVERVIEW") for w in (3, 6, 9, 12)}
    assert all(r["count"] > 0 for r in rows)


def brute_separation(rows):
    """Davies-Bouldin index and silhouette of (label, vector) pairs, from every pair."""
    rows = [(k, v) for k, v in rows if k != -1]
    labels = sorted({k for k, _ in rows})
    of = {k: [v for x, v in rows if x == k] for k in labels}
    centre = {k: [sum(c) / len(of[k]) for c in zip(*of[k], strict=True)] for k in labels}
    spread = {k: sum(math.dist(v, centre[k]) for v in of[k]) / len(of[k]) for k in labels}
    dbi = sum(max((spread[k] + spread[x]) / math.dist(centre[k], centre[x]) for x in labels if x != k) for k in labels) / len(labels)
    each = []
    for k, v in rows:
        if len(of[k]) == 1:
            each.append(0.0)
            continue
        a = sum(math.dist(v, w) for w in of[k]) / (len(of[k]) - 1)
        b = min(sum(math.dist(v, w) for w in of[x]) / len(of[x]) for x in labels if x != k)
        each.append((b - a) / max(a, b))
    return dbi, sum(each) / len(each)


def test_separation_against_all_pairs(spark, monkeypatch):
    import random

    from tidewatch.operators import clusters

    rng = random.Random(3)
    rows = [(i % 4 - 1, [rng.gauss(3 * (i % 4), 1.5) for _ in range(5)]) for i in range(90)]
    rows += [(0, rows[1][1]), (0, rows[1][1]), (1, rows[1][1]), (9, [20.0] * 5)]
    df = spark.createDataFrame(rows, "label int, embedding array<double>")
    dbi, sil = brute_separation(rows)
    for block in (4096, 7):
        monkeypatch.setattr(clusters, "BLOCK", block)
        got = clusters.separation(df, "embedding", "label").collect()
        assert len(got) == 1
        assert got[0].davies_bouldin == pytest.approx(dbi)
        assert got[0].silhouette == pytest.approx(sil)
    assert one(clusters.silhouette(df.where("label < 1"), "embedding", "label")) == [(None,)]
    assert one(clusters.silhouette(df.limit(0), "embedding", "label")) == [(None,)]


def test_composite_score(spark):
    from tidewatch.operators import clusters

    df = spark.createDataFrame(
        [(3, 0.2, 0.1, 0.8, 0.25, 0.4), (6, 0.45, 0.0, 0.6, 0.5, 0.5), (7, 0.75, 0.5, 0.25, 0.0, 0.9), (4, -0.3, 0.0, 0.7, 0.0, 0.25), (1, None, 0.0, 0.0, 0.0, 1.0)],
        "k long, silhouette double, noise_ratio double, entropy double, gini double, max_ratio double",
    )
    got = {r.k: (r.valid, r.score) for r in clusters.composite_score(df).collect()}
    assert got == {3: (True, 0.575), 6: (True, 0.685), 7: (False, 0.605), 4: (True, 0.55), 1: (False, None)}
