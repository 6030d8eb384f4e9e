"""The Jaccard join against brute force."""

from __future__ import annotations

import random
import re

import numpy as np

from tidewatch.llm import common, ngram_join


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * len(a & b) >= 3 * len(a | b):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids, default=None)))
    return out


def corpus(seed, families, members):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(300))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice((3, 8, 30, 80, 200)))]
        if rng.random() < 0.3:
            base = base + passage
        for _ in range(rng.randint(1, members)):
            own = base[:]
            for _ in range(rng.randrange(0, 1 + len(own) // 25)):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.2:
                own = own[: max(1, int(len(own) * rng.uniform(0.6, 1)))]
            texts.append(rng.choice((" ", "\n", "  ")).join(w.upper() if rng.random() < 0.1 else w for w in own))
    rng.shuffle(texts)
    return texts


def test_against_brute_force(spark, monkeypatch):
    rows = list(enumerate(corpus(1, 40, 8), 100))
    rows += [(5, None), (6, ""), (7, " \n"), (8, "one two"), (9, "ONE\ttwo"), (1, rows[0][1]), (rows[1][0], rows[1][1]), (None, rows[2][1]), (None, "left alone here and now"), (3, "é " * 4000)]
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, node int, component string")
    key = lambda r: (str(r[0]), r[1], str(r[2]))
    want = sorted(brute(rows), key=key)
    assert sorted((tuple(r) for r in ngram_join.join_documents(df).collect()), key=key) == want
    monkeypatch.setattr(ngram_join, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(ngram_join, "TREE_ROWS", 8)
    monkeypatch.setattr(ngram_join, "SAMPLE", 1)
    monkeypatch.setattr(common, "SHARES", 6)
    assert sorted((tuple(r) for r in ngram_join.join_documents(df).collect()), key=key) == want


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join_documents(df).collect() == []


def test_traversal_loses_no_pair():
    rng = np.random.default_rng(4)
    sets = ngram_join.shingle_sets(corpus(2, 60, 10))
    sets.sort(key=len)
    bits = np.frombuffer(b"".join(map(ngram_join.bitmap, sets)), np.uint64).reshape(len(sets), -1)
    sizes = np.array([len(s) for s in sets])
    groups = rng.integers(0, 1000, len(sets))
    i, j = ngram_join.dual_traversal(ngram_join.SignatureTree(bits, sizes, groups))
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    similar = lambda a, b: 4 * len(np.intersect1d(a, b)) >= 3 * len(np.union1d(a, b))
    wanted = {(a, b) for b in range(len(sets)) for a in range(b) if groups[a] != groups[b] and similar(sets[a], sets[b])}
    assert wanted <= found
    assert len(found) < len(sets) * (len(sets) - 1) // 4
    half = len(sets) // 2
    x, y = (ngram_join.SignatureTree(bits[p], sizes[p], groups[p]) for p in (slice(0, half), slice(half, None)))
    i, j = ngram_join.dual_traversal(x, y)
    assert {(a, b) for a, b in wanted if a < half <= b} <= set(zip(i.tolist(), (j + half).tolist(), strict=True))
