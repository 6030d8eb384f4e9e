"""Near-duplicate vectors against brute force."""

from __future__ import annotations

import numpy as np

from tidewatch.llm import embedding_dedup as dedup


def brute(rows, threshold=0.93):
    ok = {}
    for k, (i, v, label) in enumerate(rows):
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[k] = np.array(v, float) / np.linalg.norm(v)
    links = {k: [j for j in ok if k in ok and j != k and rows[j][2] == rows[k][2] and len(rows[j][1]) == len(rows[k][1]) and float(ok[k] @ ok[j]) >= threshold] for k in range(len(rows))}
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        comp = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((i, len(links[k]), comp, i is not None and i == comp))
    return out


def _rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    rows = []
    for i in range(n):
        v = centres[i % 6] + rng.standard_normal(dim) * rng.choice([0.0, 0.15, 0.25, 0.4, 2.0])
        rows.append((i * 3 + 1, [float(x) for x in v.astype(np.float32)], int(i % 2)))
    return rows


def test_links(spark, monkeypatch):
    rows = _rows(240, 16, 1)
    rows += [(5000, None, 1), (5001, [], 1), (5002, [0.0] * 16, 1), (5003, [float("nan")] + [1.0] * 15, 1), (5004, [None] + [1.0] * 15, 1), (5005, rows[0][1], None), (5006, [float("inf")] + [1.0] * 15, 0), (5007, [1.0, 2.0], 0), (5008, [2.0, 4.0], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, vector string")
    for block in (1024, 20):
        monkeypatch.setattr(dedup, "BLOCK", block)
        got = [tuple(r) for r in dedup.find_links(df).collect()]
        assert sorted(got) == sorted(brute(rows))


def test_hostile_rows(spark):
    v = [1.0, 0.5, -2.0]
    rows = [(7, v, 1), (7, v, 1), (3, v, 1), (9, [x * 2 for x in v], 1), (4, v, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in dedup.find_links(df).collect()) == [(3, 3, 3, True), (4, 0, 4, True), (7, 3, 3, False), (7, 3, 3, False), (9, 3, 3, False)]
    nameless = spark.createDataFrame([(None, v, 1), (None, v, 1), (8, [-x for x in v], 1)], "vec_id long, embedding array<double>, label int")
    assert sorted((r.n_links, str(r.component_id)) for r in dedup.find_links(nameless).collect()) == [(0, "8"), (1, "None"), (1, "None")]
    assert dedup.find_links(df.limit(0)).collect() == []


def test_repeated_ids_of_different_vectors(spark, monkeypatch):
    v, w = [1.0, 0.5, -2.0], [-3.0, 1.0, 0.25]
    rows = [(7, v, 1), (7, w, 1), (3, [x * 2 for x in v], 1), (9, [x * 3 for x in w], 1), (9, [x * 4 for x in v], 2), (7, [x * 5 for x in v], 2), (3, w, 2)]
    rows += [(None, [x * 6 for x in w], 1), (None, [0.0, 0.0, 1.0], 2), (-5, [0.0, 1.0, 0.0], 1), (1 << 62, [0.0, -1.0, 0.0], 1), ((1 << 62) + 1, [0.0, -2.0, 0.0], 1)]
    rows += [(i % 7, u, label) for i, u, label in _rows(60, 16, 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    key = lambda r: tuple((x is not None, x) for x in r)
    for block in (1024, 20, 2):
        monkeypatch.setattr(dedup, "BLOCK", block)
        got = [tuple(r) for r in dedup.find_links(df).collect()]
        assert sorted(got, key=key) == sorted(brute(rows), key=key)


def _unit(rng, n, dim):
    x = rng.standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _side(x):
    packed, factors, small, scale, lost = dedup.encode(x)
    return {"codes": dedup.signs(packed, x.shape[1]), "factors": factors, "vectors": small * scale[:, None], "lost": lost}


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    for dim in (3, 64, 200):
        a = _unit(rng, 400, dim)
        b = a + rng.standard_normal((400, dim)) * 0.3 / np.sqrt(dim)
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        side, other = _side(a), _side(b)
        exact = (a * b).sum(1)
        estimate = (side["codes"] * (b @ dedup.rotation(dim))).sum(1) / side["factors"]
        assert abs((estimate - exact).mean()) < 0.05
        linked = exact >= 0.93
        assert linked.sum() > 50 and (estimate[linked] >= dedup.floor_of_estimate(side["factors"], 0.93)[linked] - 1e-9).all()
        assert (np.abs((side["vectors"] * other["vectors"]).sum(1) - exact) <= side["lost"] + other["lost"] + 1e-6).all()


def test_no_pair_is_decided_wrongly():
    rng = np.random.default_rng(5)
    for dim in (2, 64, 130):
        centres = _unit(rng, 40, dim)
        x = centres[rng.integers(0, 40, 700)] + rng.standard_normal((700, dim)) * rng.choice([0.1, 0.2, 0.3], (700, 1)) / np.sqrt(dim)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        exact = x @ x.T >= 0.93
        i, j, sure = dedup.decide(_side(x), None, 0.93)
        assert exact[i[sure], j[sure]].all()
        assert {(a, b) for a, b in zip(*np.nonzero(np.tril(exact, -1)), strict=True)} <= set(zip(i, j, strict=True))
        assert (~sure).sum() < 0.02 * len(i) + 5
        k, m, _ = dedup.decide(_side(x[:300]), _side(x[300:]), 0.93)
        assert {(a, b) for a, b in zip(*np.nonzero(exact[:300, 300:]), strict=True)} <= set(zip(k, m, strict=True))


def test_pairs_at_the_threshold_are_recomputed(spark):
    beside = lambda c: [c, float(np.sqrt(1 - c * c)), 0.0]
    rows = [(1, [1.0, 0.0, 0.0], 1), (2, beside(0.930002), 1), (3, [-1.0, 0.0, 0.0], 1), (4, [-x for x in beside(0.929998)], 1), (5, [2.0, 0.0, 0.0], 1), (6, [1.0, 0.0, 0.0], 1)]
    assert not dedup.decide(_side(np.array([rows[0][1]])), _side(np.array([rows[1][1]])), 0.93)[2].any()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in dedup.find_links(df).collect()) == sorted(brute(rows))
    wide = [(1, [1e200, 0.0], 1), (2, [1e-200, 0.0], 1)]
    assert [r.n_links for r in dedup.find_links(spark.createDataFrame(wide, df.schema)).collect()] == [1, 1]
