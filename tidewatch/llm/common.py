"""What the operators share: scratch tables in the shared folder, and connected components."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType

#: Used only where a local session names no ``spark.checkpoint.dir``.
DEFAULT_SCRATCH = "/tmp/checkpoints"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; an error on a cluster that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named or DEFAULT_SCRATCH


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return f"{scratch_dir(spark)}/tidewatch-{tag}-{uuid.uuid4().hex}"


#: A slim table is written by one task for so many shuffle partitions.
SLIM = 8


def materialise(df: DataFrame, tag: str = "t", slim: bool = False) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The table cuts the lineage and outlives any executor.  ``slim`` is for rows
    of a few numbers: fewer tasks write fewer files, in proportion to the
    shuffle partitions.  Returns the table and its path, for :func:`drop`.
    """
    spark = df.sparkSession
    if slim:
        df = df.coalesce(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // SLIM))
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


#: Rows of one Arrow batch: texts are long, and a batch lies in the executor and in its Python worker at once.
BATCH_ROWS = 1000


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let the session send Python workers at most ``BATCH_ROWS`` rows at once.

    The setting is read when a plan runs.  Operators that return a plan leave it
    with the session; those that run their Python stages themselves restore it.
    """
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, BATCH_ROWS)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that have ended.

    Its cleaner follows the driver's garbage collector, which may not run for
    long on a driver that does little.
    """
    spark._jvm.System.gc()


def free_heaps(spark: SparkSession) -> None:
    """Let the executors give back the heap that ended stages have left.

    A JVM keeps a heap that has once grown, beside the memory that Python
    workers need.  A task for each core collects garbage, after which the JVM
    returns what is free.
    """
    free_shuffles(spark)
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


def trim() -> None:
    """Give the memory that this Python worker has freed back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def trimmed(run: Callable) -> Callable:
    """The function of a Python stage that leaves its worker small: workers wait for other stages and keep what they have taken."""

    def trimming(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return trimming


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of rows that the driver holds; structs in them are dicts.

    It goes by Arrow: plain rows pass through Python workers of their own on
    the executors, which stay for a minute.
    """
    kind = DataType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(kind.names, r, strict=True)) for r in rows], to_arrow_schema(kind)), kind)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later plan reads."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: A key of more than one row in so many is hot; there are fewer such keys than that.
SHARES = 1000


def left_join_hot(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join of written tables on a key without nulls, of which ``lookup`` has one row each.

    The rows of a hot key would meet in one task.  Whatever the input, fewer
    than ``SHARES`` keys are hot, so their rows of ``lookup`` are broadcast;
    the others are shuffled.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") * SHARES > rows.count())
    hot, path = materialise(counts.select(key), "hot", slim=True)
    if hot.isEmpty():
        drop(rows.sparkSession, path)
        return rows.join(lookup, key, "left")
    hot = F.broadcast(hot)
    shuffled = rows.join(hot, key, "left_anti").join(lookup, key, "left")
    met = rows.join(hot, key, "left_semi").join(F.broadcast(lookup.join(hot, key, "left_semi")), key, "left")
    return shuffled.unionByName(met)


def connected_components(edges: DataFrame, tag: str = "cc", max_rounds: int = 64) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has the long columns ``a`` and ``b``.  Large-star and small-star
    rounds (Kiveris et al., 2014) run as aggregations and joins: a node of high
    degree is pre-aggregated on the map side, and its join partition can be
    split by adaptive execution, so no task holds a whole neighbourhood.  The
    rounds end when all links are stars (:func:`_all_stars`).  Rows with a null end, self-links and repeated links are ignored.  An empty input
    gives an empty result.  Returns ``node`` and ``component``.
    """
    spark = edges.sparkSession
    e = (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    e, path = materialise(e, tag, slim=True)
    for _ in range(max_rounds):
        if _all_stars(e):
            break
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(lowest, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .where(F.col("b") != F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        following, new_path = materialise(small, tag, slim=True)
        drop(spark, path)
        e, path = following, new_path
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _all_stars(e: DataFrame) -> bool:
    """True if each node is the centre of its links or has one link, to a centre.

    A round keeps what is connected connected, so such links are the components.
    """
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()
