"""Embedding near-duplicates by randomised binary codes.

Each vector is scaled to unit length and turned by a random rotation.  Stored
beside it are one sign bit per dimension with a correction factor, and its
coordinates in 16 bits with the length of what the rounding lost; the exact
vectors stay in the table of classes.  The product of a code and a vector,
divided by the code's factor, estimates their cosine without bias, and the
factor bounds its error; a pair whose interval lies below the threshold is
dropped on its code alone.  The others are decided by their 16-bit vectors,
whose error is bounded too, and the few whose interval still holds the
threshold are recomputed exactly, from the vectors in double precision.  All
bounds are certain, in any number of dimensions.

Vectors of equal label are compared in blocks: copies are folded into one
class first, classes are dealt into blocks of bounded size, and one task takes
one pair of blocks, of which it gets codes and 16-bit vectors only.  A task
gives back a spanning forest of its links, a count for each class and its
undecided pairs, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import connected_components, drop, materialise

THRESHOLD = 0.93
#: Classes of one block, about; a task holds two blocks, and compares them this many rows at a time.
BLOCK, ROWS = 4096, 512
#: Tasks that undecided pairs are dealt to, for each length of vectors.
PARTS = 256
#: A side of a join of at most this many bytes is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 16 << 20
#: What rounding in single and in double precision may add to an estimate.
SINGLE, DOUBLE = 1e-4, 1e-12


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix, the same for a seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, correction factors, 16-bit coordinates, their scale and what they lose, of unit vectors.

    The factor is the cosine between a rotated vector and its own code.
    """
    dim = unit.shape[1]
    turned = unit @ rotation(dim)
    positive = turned >= 0
    factors = np.abs(turned).sum(1) / np.sqrt(dim)
    scale = np.abs(turned).max(1) / 32767
    small = np.rint(turned / scale[:, None]).astype(np.int16)
    lost = np.linalg.norm(turned - small * scale[:, None], axis=1)
    return np.packbits(positive, axis=1), factors, small, scale, lost


def signs(packed: np.ndarray, dim: int) -> np.ndarray:
    """The codes as vectors: 1 or -1 over the square root of the dimension."""
    bits = np.unpackbits(packed, axis=1, count=dim).astype(np.float32)
    return (2 * bits - 1) / np.float32(np.sqrt(dim))


def floor_of_estimate(factors: np.ndarray, threshold: float) -> np.ndarray:
    """The least estimate that a pair at the threshold or above can have, by the code's factor.

    For unit vectors o (code c, factor f = <o, c>) and q, <c, q> / f = cos + sin
    <c, u> / f with u at right angles to o, and |<c, u>| is at most
    sqrt(1 - f^2).  The sine is at most sqrt(1 - threshold^2).
    """
    return threshold - np.sqrt(1 - threshold**2) * np.sqrt((1 - factors**2).clip(0)) / factors


def decide(a: dict, b: dict | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of the pairs that may link, and which of them certainly do; ``b`` is None for pairs within ``a``.

    A side has ``codes`` (as vectors), ``factors``, ``vectors`` (from the 16
    bits) and ``lost``.
    """
    other = a if b is None else b
    turned, low = other["vectors"].astype(np.float32), floor_of_estimate(a["factors"], threshold)
    found_i, found_j, sure = [], [], []
    for at in range(0, len(a["factors"]), ROWS):
        part = slice(at, at + ROWS)
        f = a["factors"][part][:, None]
        estimate = (a["codes"][part] @ turned.T) / f.astype(np.float32)
        maybe = estimate >= (low[part][:, None] - other["lost"].max(initial=0.0) / f - SINGLE).astype(np.float32)
        i, j = np.nonzero(maybe)
        i += at
        if b is None:
            i, j = i[j < i], j[j < i]
        for start in range(0, len(i), 1 << 15):
            p, q = i[start : start + (1 << 15)], j[start : start + (1 << 15)]
            x, y = a["lost"][p], other["lost"][q]
            cosine = np.einsum("ij,ij->i", a["vectors"][p], other["vectors"][q])
            error = x + y + x * y + DOUBLE
            keep = cosine + error >= threshold
            found_i.append(p[keep])
            found_j.append(q[keep])
            sure.append((cosine - error >= threshold)[keep])
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return join(found_i, np.int64), join(found_j, np.int64), join(sure, bool)


def _forest(u: np.ndarray, v: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def _with_codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes = batch["vector"].map(len).to_numpy()
        batch = batch.assign(code=None, factor=0.0, small=None, scale=0.0, lost=0.0)
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            x = np.array(batch["vector"].iloc[at].tolist(), np.float64)
            x /= np.abs(x).max(1, keepdims=True)  # no square overflows
            codes, factors, small, scale, lost = encode(x / np.linalg.norm(x, axis=1, keepdims=True))
            batch.iloc[at, batch.columns.get_loc("code")] = pd.Series([c.tobytes() for c in codes], dtype=object).to_numpy()
            batch.iloc[at, batch.columns.get_loc("small")] = pd.Series([c.tobytes() for c in small], dtype=object).to_numpy()
            for name, values in (("factor", factors), ("scale", scale), ("lost", lost)):
                batch.iloc[at, batch.columns.get_loc(name)] = values
        yield batch


def _side(rows: pd.DataFrame, dim: int) -> dict:
    packed = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
    vectors = np.frombuffer(b"".join(rows["small"]), np.int16).reshape(len(rows), dim) * rows["scale"].to_numpy()[:, None]
    return {"codes": signs(packed, dim), "factors": rows["factor"].to_numpy(), "vectors": vectors, "lost": rows["lost"].to_numpy()}


def compare_blocks(threshold: float):
    """The function of one task: all rows of one pair of blocks of a label."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "node"])
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        rows: list[tuple] = []
        if len(left) and (len(right) or pdf["same"].iloc[0]):
            dim = int(pdf["dim"].iloc[0])
            b = None if pdf["same"].iloc[0] else _side(right, dim)
            right = left if b is None else right
            i, j, sure = decide(_side(left, dim), b, threshold)
            ids_a, ids_b = left["node"].to_numpy(), right["node"].to_numpy()
            size_a, size_b = left["n"].to_numpy(), right["n"].to_numpy()
            rows += [(x, y, 0, False) for x, y in zip(ids_a[i[~sure]].tolist(), ids_b[j[~sure]].tolist(), strict=True)]
            i, j = i[sure], j[sure]
            counts = np.bincount(i, size_b[j], len(ids_a)), np.bincount(j, size_a[i], len(ids_b))
            for ids, c in zip((ids_a, ids_b), counts, strict=True):
                some = c > 0
                rows += [(x, None, n, True) for x, n in zip(ids[some].tolist(), c[some].astype(np.int64).tolist(), strict=True)]
            rows += [(x, y, 0, True) for x, y in _forest(ids_a[i], ids_b[j])]
        return pd.DataFrame(rows, columns=["a", "b", "n", "sure"]).astype({"a": "Int64", "b": "Int64", "n": "Int64", "sure": bool})

    return run


def _recomputed(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The undecided pairs that link, by the cosine in double precision; ``a``, ``b`` and their classes' sizes."""

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, y = (np.array(batch[c].tolist(), np.float64).reshape(len(batch), -1) for c in ("x", "y"))
            x, y = (v / np.abs(v).max(1, keepdims=True) for v in (x, y))
            cosine = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
            yield batch.loc[cosine >= threshold, ["a", "b", "n_a", "n_b"]]

    a = classes.select(F.col("node").alias("a"), F.col("vector").alias("x"), F.col("n").alias("n_a"))
    b = classes.select(F.col("node").alias("b"), F.col("vector").alias("y"), F.col("n").alias("n_b"))
    both = pairs.join(a, "a").join(b, "b").withColumn("_len", F.size("x"))
    return both.groupBy("_len", F.pmod(F.xxhash64("a", "b"), F.lit(PARTS)).alias("_part")).applyInPandas(lambda pdf: next(exact(iter([pdf]))), "a long, b long, n_a long, n_b long")


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components that are not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def find_links(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """Links and components of vectors whose cosine reaches the threshold.

    Only vectors of equal, non-null label (and equal length) are compared.
    Returns one row per input row: ``vec_id``, ``n_links`` (other rows linked
    directly), ``component_id`` (smallest id reachable by links, itself
    included) and ``kept`` (the row's id is the component's).  A vector that is
    null, empty or zero, or holds null or non-finite components, or whose label
    is null, links with nothing.  Rows without an id are counted as partners
    but have no component; rows of one id keep their own rows.  Other columns
    are not read; an empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    rows = rows.withColumn("usable", usable(F.col("vector")) & F.col("label").isNotNull())
    good = rows.where("usable")
    # Copies are one class: 128 bits of the vector's hash and the label name it.
    named = good.withColumns({"h1": F.xxhash64("label", "vector"), "h2": F.xxhash64(F.lit(1), "vector", "label")})
    classes = named.groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("vector").alias("vector"))
    # A class goes by a number of its own: ids may be null or repeated.  Written once, it stays.
    coded = classes.withColumn("node", F.monotonically_increasing_id()).select("label", "h1", "h2", "rep", "n", "vector", "node")
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in coded.schema) + "code binary, factor double, small binary, scale double, lost double"
    classes, classes_path = materialise(coded.mapInPandas(_with_codes, schema), "vectors")
    sized = classes.select("label", F.size("vector").alias("dim"), "h1", "h2", "node", "n", "code", "factor", "small", "scale", "lost")
    groups = sized.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("classes"))
    groups = groups.withColumn("blocks", F.ceil(F.col("classes") / F.lit(BLOCK)).cast("int"))
    dealt = sized.join(groups, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64(F.lit(3), "h1", "h2"), F.col("blocks")).cast("int"))
    # Block i meets every block j >= i: a class goes to as many tasks as its label has blocks.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j"), (F.col("block") > k).cast("int").alias("side"), (F.col("block") == k).alias("same")),
    )
    spread = dealt.withColumn("pair", F.explode(pairs)).select("label", "dim", "node", "n", "code", "factor", "small", "scale", "lost", "pair.*")
    found = spread.groupBy("label", "dim", "i", "j").applyInPandas(compare_blocks(threshold), "a long, b long, n long, sure boolean")
    found, found_path = materialise(found, "links")
    open_, ends_path = found.where("NOT sure").select("a", "b"), None
    if open_.isEmpty():
        open_, classes_of = open_.limit(0), classes.limit(0)
    else:
        ends, ends_path = materialise(open_.select(F.col("a").alias("node")).union(open_.select("b")).distinct(), "undecided", slim=True)
        classes_of = classes.join(F.broadcast(ends) if ends.count() * 24 <= BROADCAST_BYTES else ends, "node", "left_semi")
    late, late_path = materialise(_recomputed(open_, classes_of, threshold), "late", slim=True)
    links = found.where("sure AND b IS NOT NULL").select("a", "b").unionByName(late.select("a", "b"))
    components = connected_components(links, "vector-links")
    counted = found.where("b IS NULL").select(F.col("a").alias("node"), "n")
    counted = counted.unionByName(late.select(F.col("a").alias("node"), F.col("n_b").alias("n"))).unionByName(late.select(F.col("b").alias("node"), F.col("n_a").alias("n")))
    counts = counted.groupBy("node").agg(F.sum("n").alias("others"))
    smallest = components.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("smallest"))
    of_class = (
        classes.select("label", "h1", "h2", "node", "rep", "n")
        .join(counts, "node", "left")
        .join(components.join(smallest, "component"), "node", "left")
        .select("label", "h1", "h2", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("smallest", "rep").alias("component"))
    )
    of_class, _ = materialise(of_class, "vector-classes")
    for path in (classes_path, found_path, late_path, *([ends_path] if ends_path else [])):
        drop(vectors.sparkSession, path)
    # A row's way back to its class is small: hashes, not vectors.
    keyed = rows.select(
        "vec_id", "usable",
        F.when(F.col("usable"), F.col("label")).alias("label"),
        F.when(F.col("usable"), F.xxhash64("label", "vector")).alias("h1"),
        F.when(F.col("usable"), F.xxhash64(F.lit(1), "vector", "label")).alias("h2"),
    )
    return keyed.join(of_class, ["label", "h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
