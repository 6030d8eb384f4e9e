"""Mixing, resharding and the pipeline."""

from __future__ import annotations

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import mixing, queries, resharding


def test_quotas():
    got = mixing.quotas([("b", 10), (None, 100), ("a", 50)], [5, 2, 1], 1.5, 2)
    # 240 words: a 150 and b 60 are above 100 and 20; null takes the rest.
    assert got == {"a": 100.0, "b": 20.0, None: 120.0}
    assert mixing.quotas([], [5], 1.5, 2) == {}


def test_min_cost_flow_against_enumeration():
    rng = random.Random(4)
    for _ in range(30):
        arcs = [(0, i, rng.randint(0, 3), rng.randint(0, 4)) for i in (1, 2)] + [(i, j, rng.randint(0, 3), rng.randint(0, 4)) for i in (1, 2) for j in (3, 4)] + [(j, 5, rng.randint(0, 3), 0) for j in (3, 4)]
        flow = mixing.min_cost_flow(6, arcs, 0, 5)
        best = None
        for middle in itertools.product(*[range(c + 1) for _, _, c, _ in arcs[2:6]]):
            into = [middle[0] + middle[1], middle[2] + middle[3]]
            out = [middle[0] + middle[2], middle[1] + middle[3]]
            if into[0] <= arcs[0][2] and into[1] <= arcs[1][2] and out[0] <= arcs[6][2] and out[1] <= arcs[7][2]:
                cost = sum(a[3] * f for a, f in zip(arcs, (*into, *middle, *out), strict=True))
                key = (-sum(into), cost)
                best = key if best is None else min(best, key)
        assert (-(flow[0] + flow[1]), sum(a[3] * f for a, f in zip(arcs, flow, strict=True))) == best


def test_overlapping_sources_take_single_copies_first():
    take = mixing.plan({("a",): 100, ("a", "b"): 50, ("b",): 10}, {"a": 120.0, "b": 40.0})
    assert sum(take.values()) == 160 and take[("b",)] <= 20 and take[("a", "b")] == 50


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["s0", "s0", "s0", "s1", "s2", None])) for i in range(600)]
    rows += [(700, None, "s1"), (701, "", "s3"), (702, "one two\tthree", "s4"), (None, "x y", "s0"), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    mixed = mixing.mix(df, [5, 2, 1], 1.5)
    got = mixed.collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    target = mixing.quotas(sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or "")), [5, 2, 1], 1.5, 2)
    for source, size in sizes.items():
        own = [r for r in got if r.source == source]
        assert {r._mix.source_size for r in own} == {size} and own[0]._mix.target == pytest.approx(target[source])
        taken = sum(r._mix.size * r._mix.copies for r in own)
        assert abs(taken - target[source]) <= max(3, 0.02 * target[source])
        assert all(0 <= r._mix.copies <= 2 for r in own)
    again = {(r.doc_id, r._mix.copies) for r in mixing.mix(df.repartition(3), [5, 2, 1], 1.5).collect()}
    assert again == {(r.doc_id, r._mix.copies) for r in got}
    assert mixing.repeat(mixed).count() == sum(r._mix.copies for r in got)
    assert mixing.repeat(mixed).columns == df.columns
    assert mixing.mix(df.limit(0), [5, 2, 1], 1.5).collect() == []


def test_mix_keeps_columns_of_clashing_names(spark):
    names = ["_size", "_pattern", "_hash", "_copies", "_source_size", "_target", "_mix", "pattern", "plan", "mix", "row", "size"]
    df = spark.createDataFrame([(i, "a b", f"s{i % 2}", *range(len(names))) for i in range(8)], ["doc_id", "text", "source", *names])
    mixed = mixing.mix(df, [1], 1.0)
    assert mixed.columns == [*df.columns, "_mix_"]
    assert sorted(mixed.drop("_mix_").collect()) == sorted(df.collect())
    assert mixing.repeat(mixed).columns == df.columns


def test_many_patterns_and_overlaps(spark):
    many = {(f"s{i}",): 10 for i in range(120_000)} | {("a", "b"): 40, ("a",): 10, ("b", "c"): 5}
    take = mixing.plan(many, {f"s{i}": 15.0 for i in range(120_000)} | {"a": 30.0, "b": 30.0, "c": 8.0})
    assert all(take[(f"s{i}",)] == 15 for i in range(120_000)) and sum(take[p] for p in (("a", "b"), ("a",), ("b", "c"))) == 68
    df = spark.createDataFrame([(i, "w " * (1 + i % 7), "x" if i % 3 else "y", "z" if i % 2 else "x") for i in range(400)], "doc_id long, text string, source string, topic string")
    got = mixing.mix(df, [5, 2, 1], 0.5, source_cols=("source", "topic")).collect()
    taken: dict = {}
    for r in got:
        taken[r._mix.pattern] = taken.get(r._mix.pattern, 0) + r._mix.size * r._mix.copies
    sizes: dict = {}
    for r in got:
        sizes[r._mix.pattern] = sizes.get(r._mix.pattern, 0) + r._mix.size
    assert len(sizes) == 4 and abs(sum(taken.values()) - 0.5 * sum(sizes.values())) <= 30


def brute_taken(patterns, targets, repeats):
    """The cheapest of the largest takes, by trying every flow."""
    names, sources = list(patterns), list(targets)
    arcs = [(i, s) for i, n in enumerate(names) for s in n if s in targets]
    best = None
    for flow in itertools.product(*[range(repeats * patterns[names[i]] + 1) for i, _ in arcs]):
        out = [sum(f for f, (i, _) in zip(flow, arcs, strict=True) if i == k) for k in range(len(names))]
        into = {s: sum(f for f, (_, t) in zip(flow, arcs, strict=True) if t == s) for s in sources}
        if any(o > repeats * patterns[n] for o, n in zip(out, names, strict=True)) or any(into[s] > targets[s] for s in sources):
            continue
        cost = sum(sum((1 + k // patterns[n]) ** 2 for k in range(o)) for o, n in zip(out, names, strict=True) if patterns[n])
        key = (-sum(out), cost)
        best = key if best is None else min(best, key)
    return best


def test_plan_against_enumeration():
    rng = random.Random(9)
    for _ in range(25):
        patterns = {n: rng.randint(1, 3) for n in rng.sample([("a",), ("b",), ("a", "b"), ("b", "c"), ("c",)], 3)}
        targets = {s: float(rng.randint(0, 4)) for s in sorted({s for n in patterns for s in n})}
        take = mixing.plan(patterns, targets)
        cost = sum(sum((1 + k // patterns[n]) ** 2 for k in range(t)) for n, t in take.items())
        assert (-sum(take.values()), cost) == brute_taken(patterns, targets, 2)


def test_transfers_move_the_fewest_bytes():
    flow = resharding.transfers({0: 30, 1: 10}, {0: 14, 1: 13, 2: 13})
    assert flow[(0, 0)] == 14 and flow[(1, 1)] == 10
    assert sum(f for (a, b), f in flow.items() if a != b) == 16


def test_transfers_against_enumeration():
    rng = random.Random(2)
    for _ in range(30):
        old = {0: rng.randint(0, 4), 1: rng.randint(0, 4), 2: rng.randint(0, 3)}
        total = sum(old.values())
        capacity = {0: rng.randint(0, total)}
        capacity |= {1: rng.randint(0, total - capacity[0])}
        capacity |= {2: total - capacity[0] - capacity[1]}
        moved = sum(f for (a, b), f in resharding.transfers(old, capacity).items() if a != b)
        cells = [(a, b) for a in old for b in capacity]
        splits = lambda n: [(x, y, n - x - y) for x in range(n + 1) for y in range(n - x + 1)]
        ways = itertools.product(*[splits(old[a]) for a in old])
        fits = [w for w in ways if all(sum(row[b] for row in w) == capacity[b] for b in capacity)]
        assert len(cells) == 9 and moved == min(sum(x for a, row in enumerate(w) for b, x in enumerate(row) if a != b) for w in fits)


def test_equal_texts_stay_together(spark):
    rng = random.Random(8)
    texts = [f"{k} " * rng.randint(1, 60) for k in range(150)]
    rows = [(i, t) for i, t in enumerate(t for t in texts for _ in range(rng.choice((1, 1, 2, 9))))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    old = F.pmod(F.xxhash64("text"), F.lit(4))
    got = resharding.reshard(df, old, [1] * 6).join(df, "doc_id").collect()
    homes: dict = {}
    for r in got:
        homes.setdefault(r.text, set()).add(r.shard)
    assert all(len(s) == 1 for s in homes.values())
    hot = df.unionByName(spark.range(5000, 9000).selectExpr("id AS doc_id", "'the same again' AS text"))
    got = resharding.reshard(hot, old, [1] * 6).join(hot, "doc_id").collect()
    total, homes, sums = sum(r.size for r in got), {}, {}
    for r in got:
        homes.setdefault(r.text, set()).add(r.shard)
        sums[r.shard] = sums.get(r.shard, 0) + r.size
    assert [t for t, s in homes.items() if len(s) > 1] == ["the same again"]
    assert all(abs(s - total / 6) <= 0.03 * total / 6 for s in sums.values())


def test_reshard(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, "t" * rng.randint(0, 200) + str(i)) for i in range(900)] + [(1000 + i, "copy é") for i in range(300)] + [(2000, None), (2001, "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    placed = resharding.reshard(df, F.pmod("doc_id", F.lit(4)), [1] * 6)
    got = placed.collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    texts = dict(rows)
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    total = sum(r.size for r in got)
    for shard in range(6):
        own = [r for r in got if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 6) <= 0.02 * total / 6
    moved = sum(r.size for r in got if r.old_shard != r.shard)
    assert moved <= total * (1 - 4 / 6) * 1.1  # four of six shards keep what fits
    path = str(tmp_path / "shards")
    df.withColumn("slot", F.lit(0)).drop("shard").withColumn("shard", F.pmod("doc_id", F.lit(4)).cast("int")).write.partitionBy("shard").parquet(path)
    touched = resharding.rewrite(df.drop("shard"), placed, path)
    assert {4, 5} <= set(touched)
    back = {(r.doc_id, r.shard) for r in spark.read.parquet(path).collect()}
    assert back == {(r.doc_id, r.shard) for r in got}
    assert resharding.reshard(df.limit(0), F.lit(0), [1, 1]).collect() == []
    twins = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a"), (1, "a")], "doc_id long, text string")
    assert len({(r.shard, r.slot) for r in resharding.reshard(twins, F.lit(0), [1, 1]).collect()}) == 4


DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    table = {"op2": "embeddings", "op3": "pages", "op7": "pages"}.get(name.split("_")[0], "documents")
    assert df.count() == spark.read.parquet(f"{DATA}/{table}.parquet").count()


def test_pipeline(spark):
    import corpus_pipeline as pipeline
    from test_ngram_join import brute

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    kept = pipeline.keep_quality(spark, docs, DATA)
    assert kept.columns == columns
    labels = spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1")
    good = docs.join(labels, "doc_id", "left_semi")
    assert kept.join(labels, "doc_id", "left_semi").count() >= 0.95 * good.count()
    single = pipeline.drop_near_duplicates(spark, kept, DATA)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, _, c in brute(rows) if d == c)
    mixed = pipeline.mix_sources(spark, single, DATA)
    assert mixed.columns == columns
    ids = pipeline.encode_pieces(spark, mixed, DATA)
    assert ids.count() == mixed.count() and ids.where("NOT round_trip").count() == 0
    assert pipeline.run(spark, DATA).count() == mixed.count()


def test_pipeline_on_hostile_rows(spark):
    import corpus_pipeline as pipeline

    text = "a line of plain words about the weather in the north of the country and the sea beside it"
    kind = "doc_id long, text string, lang string, source string, n_chars long, _mix int, number int"
    rows = [(1, text), (1, text), (None, text), (None, text), (2, text.upper()), (3, None), (None, ""), (4, "another text that stands for itself among all of these rows here"), (5, None), (5, "x y")]
    docs = spark.createDataFrame([(*r, "en", None, 1, 7, 8) for r in rows], kind)
    single = pipeline.drop_near_duplicates(spark, docs, DATA).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in single) == sorted([("2", text.upper()), ("3", "None"), ("None", ""), ("4", rows[7][1]), ("5", "None"), ("5", "x y")])
    plain = docs.where("doc_id IN (2, 3, 4)")
    assert sorted(r.doc_id for r in pipeline.drop_near_duplicates(spark, plain, DATA).collect()) == [2, 3, 4]
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).collect() == []
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).columns == pipeline.COLUMNS


def test_shard_files_are_written(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    rows = [(i, "t" * rng.randint(0, 90) + str(i)) for i in range(400)] + [(None, "null id")] * 3 + [(7, "again"), (500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    old = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(4))
    columns = ["doc_id", "size", "text_crc32", "old_shard", "shard", "slot", "rewritten"]
    key = lambda found: sorted(map(str, found.select(*columns).collect()))
    path = str(tmp_path / "all")
    got = resharding.write_shards(df, old, [1] * 6, path)
    assert key(got) == key(resharding.reshard(df, old, [1] * 6))
    files = spark.read.parquet(path).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in files) == sorted((str(a), str(b)) for a, b in rows)
    assert len({(r.shard, r.slot) for r in files}) == len(rows) and {r.shard for r in files} == set(range(6))
    # Of five old shards the last one loses all to the first; those of the right size stay untouched.
    even = spark.createDataFrame([(i, "x" * 92 + str(i % 10)) for i in range(40)], "doc_id long, text string")
    at = F.when(F.col("doc_id") < 5, F.lit(4)).otherwise((F.col("doc_id") / 10).cast("int"))
    for n, (weights, homes) in enumerate((([1, 2, 2, 2, 1], set()), ([2, 2, 2, 2], {0}))):
        path = str(tmp_path / f"some{n}")
        got = resharding.write_shards(even, at, weights, path)
        assert key(got) == key(resharding.reshard(even, at, weights)) and got.count() == 40
        stored = spark.read.schema("doc_id long, shard int").parquet(path).collect()
        assert {r.shard for r in stored} == homes and len(stored) == 10 * len(homes)
    assert resharding.write_shards(even.limit(0), at, [1, 1], str(tmp_path / "none")).collect() == []
    # The query's rows come from the files.
    seen: list[str] = []
    real = resharding.write_shards
    monkeypatch.setattr(resharding, "write_shards", lambda *a, **k: (seen.append(a[3]), real(*a, **k))[1])
    digest = queries.op9_resharding(spark, DATA)
    stored = spark.read.parquet(seen[0]).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert stored and all(texts[r.doc_id] == r.text for r in stored)
    found = digest.collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    assert sorted((r.doc_id, r.shard, r.slot) for r in stored) == sorted((r.doc_id, r.shard, r.slot) for r in found if r.rewritten)


def test_stages_leave_executors_small(spark, monkeypatch):
    import corpus_pipeline as pipeline
    from tidewatch.llm import common

    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    collections = lambda: sum(b.getCollectionCount() for b in beans() if "Old" in b.getName() or "MarkSweep" in b.getName())
    monkeypatch.setattr(common, "free_shuffles", lambda spark: None)  # in local mode the driver is the executor
    for _, stage in pipeline.STAGES:
        before = collections()
        stage(spark, spark.read.parquet(f"{DATA}/documents.parquet").limit(0), DATA)
        assert collections() > before


def test_a_mix_starts_no_python_workers(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (i % 7), "ab"[i % 2]) for i in range(60)], "doc_id long, text string, source string")
    wanted = sorted(map(str, mixing.mix(docs, [5, 2], 1.3).collect()))

    def parallelize(*args, **kwargs):
        raise AssertionError("rows of the driver go through Python workers")

    monkeypatch.setattr(spark.sparkContext, "parallelize", parallelize)
    assert sorted(map(str, mixing.mix(docs, [5, 2], 1.3).collect())) == wanted
