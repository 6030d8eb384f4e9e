"""Cluster operators over embeddings: features, centroids, labels, quality."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct vectors of one block of a label, about; a task of the silhouette holds two blocks.
BLOCK = 4096
#: Rows of a block whose distances are held at once.
CHUNK = 512
#: The settings of the composite score.
VALID_K = (3, 6)
WEIGHTS = {"silhouette": 0.40, "max_ratio": 0.20, "noise_ratio": 0.20, "entropy": 0.10, "gini": 0.10}
SILHOUETTE_LOW, SILHOUETTE_MID = 0.4, 0.5
ENTROPY_GOOD, ENTROPY_ACCEPTABLE = 0.7, 0.5


def _long(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    return df.select(*keys, F.posexplode(F.col(vector).cast("array<double>")).alias("pos", "x"))


def standardise(df: DataFrame, vector: str, one_hot: dict[str, Sequence] | None = None, weight: float = 1.0) -> DataFrame:
    """Scaled dimensions (mean 0, population deviation 1; a constant one is 0), then weighted indicators."""
    stats = _long(df, vector).groupBy("pos").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).orderBy("pos")
    rows = stats.collect()  # one row for each dimension
    parts = [F.when(F.lit(r["s"] > 0), (F.col(vector)[r["pos"]].cast("double") - r["m"]) / (r["s"] or 1.0)).otherwise(0.0) for r in rows]
    for column, values in (one_hot or {}).items():
        parts += [F.when(F.col(column) == v, weight).otherwise(0.0) for v in values]
    return df.withColumn("features", F.array(*parts))


def centroids(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Mean vector of each label; noise (-1) is left out."""
    means = _long(df.where(F.col(label) != -1), vector, label).groupBy(label, "pos").agg(F.avg("x").alias("x"))
    return means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("centroid"))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def nearest(df: DataFrame, key: str, vector: str, centres: DataFrame, label: str) -> DataFrame:
    """The label of the nearest centroid; ties go to the smallest label."""
    small = F.broadcast(centres.select(F.col(label).alias("_label"), "centroid"))  # one row for each label
    pairs = df.select(key, vector).crossJoin(small).withColumn("d", squared_distance(F.col(vector), F.col("centroid")))
    return pairs.groupBy(key).agg(F.min(F.struct("d", "_label")).alias("best")).select(key, F.col("best._label").alias("assigned"), F.sqrt("best.d").alias("distance"))


def cluster_quality(df: DataFrame, label: str) -> DataFrame:
    """Number of clusters, noise share, normalised entropy, Gini index and largest share of the sizes."""
    sizes = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n").alias("all"), F.coalesce(F.sum(F.when(F.col("label") == -1, F.col("n"))), F.lit(0)).alias("noise"))
    from pyspark.sql import Window

    own = sizes.where(F.col("label") != -1).withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("n", "label")))
    own = own.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))
    one = own.agg(
        F.count(F.lit(1)).alias("k"), F.sum(-F.col("p") * F.log("p")).alias("entropy"), F.max("p").alias("max_ratio"),
        F.sum(F.col("rank") * F.col("n")).alias("ranked"), F.sum("n").alias("s"),
    )
    return one.crossJoin(total).select(
        "k", (F.col("noise") / F.col("all")).alias("noise_ratio"),
        F.when(F.col("k") > 1, F.col("entropy") / F.log("k")).otherwise(0.0).alias("entropy"),
        (2 * F.col("ranked") / (F.col("k") * F.col("s")) - (F.col("k") + 1) / F.col("k")).alias("gini"), "max_ratio",
    )


def davies_bouldin(inner: DataFrame, label: str) -> DataFrame:
    """Mean over the clusters of the largest (s + s') / d of two clusters: mean distances to the centroid over the centroids' distance.

    ``inner`` has a row's label, its cluster's ``centroid`` and ``d``, the squared distance to it.
    """
    own = inner.groupBy(F.col(label).alias("a")).agg(F.avg(F.sqrt("d")).alias("s"), F.first("centroid").alias("c"))
    other = F.broadcast(own.select(F.col("a").alias("b"), F.col("s").alias("t"), F.col("c").alias("e")))  # one row for each label
    apart = F.sqrt(squared_distance(F.col("c"), F.col("e")))
    ratio = F.when(apart > 0, (F.col("s") + F.col("t")) / apart).otherwise(0.0)
    worst = own.crossJoin(other).where(F.col("a") != F.col("b")).groupBy("a").agg(F.max(ratio).alias("r"))
    return worst.agg(F.avg("r").alias("davies_bouldin"))


def _distance_sums(sizes: dict):
    """The function of one task: what each vector of two blocks adds to its mean distance to the other block's label."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf["side"] == 0]
        same = bool(pdf["i"].iloc[0] == pdf["j"].iloc[0])
        right = left if same else pdf[pdf["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("label", pdf["label"].dtype), ("h1", "int64"), ("h2", "int64"), ("n", "int64"), ("m", "int64"), ("other", pdf["label"].dtype), ("mean", "float64"))})
        a, b = (np.array(x["vector"].tolist(), np.float64) for x in (left, right))
        n_a, n_b = left["n"].to_numpy(float), right["n"].to_numpy(float)
        of_a, of_b = np.zeros(len(a)), np.zeros(len(b))
        squares = (b * b).sum(1)
        for at in range(0, len(a), CHUNK):
            part = a[at : at + CHUNK]
            d = np.sqrt(((part * part).sum(1)[:, None] + squares - 2 * part @ b.T).clip(0))
            if same:
                d[np.arange(len(part)), at + np.arange(len(part))] = 0.0
            of_a[at : at + CHUNK] = d @ n_b
            of_b += n_a[at : at + CHUNK] @ d
        out = []
        for rows, sums, other in ((left, of_a, right["label"].iloc[0]), (right, of_b, left["label"].iloc[0]))[: 1 if same else 2]:
            own = rows["label"].iloc[0]
            part = rows[["label", "h1", "h2", "n"]].copy()
            part["m"], part["other"], part["mean"] = sizes[own], other, sums / max(sizes[other] - (own == other), 1)
            out.append(part)
        return pd.concat(out)

    return run


def silhouette(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Mean silhouette over all rows but noise, by Euclidean distance and over all pairs; a cluster of one row counts 0, fewer than two clusters give null.

    Equal vectors of a label are one class.  A label's classes are dealt into
    blocks and a task takes two blocks: the work grows with the square of the
    distinct vectors.
    """
    spark = df.sparkSession
    rows = df.where((F.col(label) != -1) & F.col(vector).isNotNull()).select(F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    named = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    classes = named.groupBy("label", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
    of_label = classes.groupBy("label").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("m")).orderBy("label").collect()  # one row for each label
    kind = rows.schema["label"].dataType.simpleString()
    dealt, total = [], 0
    for r in of_label:
        parts = -(-r["classes"] // BLOCK)
        dealt.append((r["label"], total, parts))
        total += parts
    blocks = F.broadcast(spark.createDataFrame(dealt, f"label {kind}, first int, parts int"))
    placed = classes.join(blocks, "label").withColumn("block", F.col("first") + F.pmod(F.xxhash64(F.lit(3), "h1", "h2"), F.col("parts")).cast("int"))
    # Block i meets every block j >= i: a class goes to as many tasks as there are blocks.
    pairs = placed.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(max(total - 1, 0))))).select(
        "label", "h1", "h2", "n", "vector", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), (F.col("block") > F.col("k")).cast("int").alias("side")
    )
    schema = f"label {kind}, h1 long, h2 long, n long, m long, other {kind}, mean double"
    found = pairs.groupBy("i", "j").applyInPandas(_distance_sums({r["label"]: r["m"] for r in of_label}), schema)
    means = found.groupBy("label", "h1", "h2", "n", "m", "other").agg(F.sum("mean").alias("mean"))
    each = means.groupBy("label", "h1", "h2", "n", "m").agg(
        F.max(F.when(F.col("other") == F.col("label"), F.col("mean"))).alias("a"), F.min(F.when(F.col("other") != F.col("label"), F.col("mean"))).alias("b")
    )
    widest = F.greatest("a", "b")
    value = F.when(F.col("b").isNull(), None).when((F.col("m") == 1) | (widest == 0), 0.0).otherwise((F.col("b") - F.col("a")) / widest)
    return each.agg((F.sum(value * F.col("n")) / F.sum("n")).alias("silhouette"))


def separation(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Calinski-Harabasz index and mean within-cluster scatter, from sums over the dimensions, Davies-Bouldin index and silhouette."""
    rows = df.where(F.col(label) != -1)
    centres = centroids(rows, vector, label)
    inner = rows.join(F.broadcast(centres), label).withColumn("d", squared_distance(F.col(vector), F.col("centroid")))
    within = inner.groupBy(label).agg(F.sum("d").alias("w"), F.count(F.lit(1)).alias("n"))
    whole = _long(rows, vector).groupBy("pos").agg(F.var_pop("x").alias("v"), F.count(F.lit(1)).alias("m")).agg(F.sum(F.col("v") * F.col("m")).alias("t"))
    one = within.agg(F.sum("w").alias("w"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).crossJoin(whole)
    one = one.select(((F.col("t") - F.col("w")) / (F.col("k") - 1) / (F.col("w") / (F.col("n") - F.col("k")))).alias("calinski_harabasz"), (F.col("w") / F.col("n")).alias("within"))
    return one.crossJoin(davies_bouldin(inner, label)).crossJoin(silhouette(df, vector, label))


def composite_score(metrics: DataFrame) -> DataFrame:
    """Whether the number of clusters is valid, and the weighted score of the metrics, each first rounded to 4 places.

    ``metrics`` has the columns of :func:`cluster_quality` and ``silhouette``.
    Without a silhouette (fewer than two clusters) nothing is valid and the score is null.
    """
    names = ("silhouette", "noise_ratio", "entropy", "gini", "max_ratio")
    rows = metrics.select("k", *[F.round(c, 4).alias(c) for c in names])
    sil, entropy = F.col("silhouette"), F.col("entropy")
    floor = lambda x: F.greatest(F.lit(0.0), x)
    parts = {
        "silhouette": F.when(sil < SILHOUETTE_LOW, floor(sil / SILHOUETTE_LOW * 0.5))
        .when(sil < SILHOUETTE_MID, 0.5 + (sil - SILHOUETTE_LOW) * 0.3 / (SILHOUETTE_MID - SILHOUETTE_LOW))
        .otherwise(F.least(F.lit(1.0), 0.8 + (sil - SILHOUETTE_MID) * 0.4)),
        "max_ratio": floor(1 - F.col("max_ratio")),
        "noise_ratio": floor(1 - F.col("noise_ratio")),
        "entropy": F.when(entropy >= ENTROPY_GOOD, 1.0)
        .when(entropy >= ENTROPY_ACCEPTABLE, 0.5 + (entropy - ENTROPY_ACCEPTABLE) * 2.5)
        .otherwise(floor(entropy / ENTROPY_ACCEPTABLE * 0.5)),
        "gini": floor(1 - F.col("gini")),
    }
    total = sum((parts[c] * w for c, w in WEIGHTS.items()), F.lit(0.0))
    return rows.select(
        "k", *names, (F.col("k").between(*VALID_K) & sil.isNotNull()).alias("valid"),
        F.when(sil.isNotNull(), F.round(total, 4)).alias("score"),
    )
