"""Queries against their SQL, on the smallest tables and on rows that link."""

from __future__ import annotations

import random
from pathlib import Path

import duckdb
import numpy as np
import pytest

from tidewatch.llm import queries

DATA = Path("/root/testdata/sf0.001")


def compare(spark, folder, name):
    con = duckdb.connect()
    for f in folder.glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f if f.is_file() else f'{f}/*.parquet'}'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, str(folder))
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(map(tuple, got.select(*want.columns).collect()), key=str)
    assert rows == sorted(want.fetchall(), key=str)
    return rows


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_on_the_tables(spark, name):
    assert compare(spark, DATA, name)


def test_links_of_vectors(spark, tmp_path):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((6, 16))
    rows = [(i, i % 3, [float(x) for x in base[i % 6] + 0.1 * (i // 6) * rng.standard_normal(16)]) for i in range(60)]
    rows += [(60, 0, [0.0] * 16), (61, 1, None), (62, None, rows[0][2]), (63, 0, rows[0][2]), (64, 0, [float("nan")] + rows[0][2][1:]), (65, 1, [None] + rows[1][2][1:])]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = compare(spark, tmp_path, "op2_embedding_near_dedup")
    assert 10 < sum(r[1] > 0 for r in found) < len(found) - 10


def test_links_of_documents(spark, tmp_path):
    rng = random.Random(8)
    words = lambda n: [rng.choice(["Alpha", "be", "ce", "De", "é", "x1"]) + str(rng.randrange(40)) for _ in range(n)]
    rows = [(0, None), (1, ""), (2, " \t"), (3, "few Words"), (4, "few\nwords")]
    for i in range(20):
        text = words(60)
        rows.append((10 * i + 10, " ".join(text)))
        for k in range(1, 4):
            own = list(text)
            for at in rng.sample(range(60), k):
                own[at] = "changed"
            rows.append((10 * i + 10 + k, "  ".join(own) if k == 3 else "  ".join(own)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = compare(spark, tmp_path, "op6_ngram_jaccard_join")
    assert 10 < sum(r[0] != r[2] for r in found) < 50
