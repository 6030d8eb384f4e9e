"""Resharding by min-cost flow.

The sizes of the old shards and the capacities of the new ones make a flow
problem in which a byte that stays in its shard costs nothing and a byte that
moves costs one.  The cheapest flow says how many bytes go from each old shard
to each new one; blocks of documents realise it, and only the files of shards
that gain or lose blocks are rewritten (:func:`write_shards`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import local_table, materialise
from tidewatch.llm.mixing import min_cost_flow

#: Blocks of an old shard, by a hash of the text: equal texts share a block.
BLOCKS = 2048
#: A block of more than this share of a new shard's capacity is cut into parts by another hash of the text.
HEAVY = 0.004
PARTS = 512
#: Equal texts of more than this share of a shard's capacity cannot stay together with near-equal
#: bytes: their rows are dealt to as many pieces.
GIANT, PIECES = 0.9, 256


#: Rows of a shard that one task writes, by their slots; a unit goes to one file.
FILE_ROWS = 1 << 16
#: What names a unit.
UNIT = ["old", "block", "part", "piece"]
#: Places in a unit.
BYTES, ROWS = 4, 5


def document_size(text: Column) -> Column:
    """UTF-8 bytes of a text and eight for its id; null counts as empty."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long")


def transfers(old: dict[int, int], capacity: dict[int, int]) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard that move the fewest bytes in all."""
    olds, news = sorted(old), sorted(capacity)
    start, end = 0, 1 + len(olds) + len(news)
    arcs = [(start, 1 + i, old[a], 0) for i, a in enumerate(olds)]
    pairs = [(a, b) for a in olds for b in news]
    at = {b: 1 + len(olds) + j for j, b in enumerate(news)}
    arcs += [(1 + olds.index(a), at[b], old[a], int(a != b)) for a, b in pairs]
    arcs += [(at[b], end, capacity[b], 0) for b in news]
    flow = min_cost_flow(end + 1, arcs, start, end)[len(olds) : len(olds) + len(pairs)]
    return {p: f for p, f in zip(pairs, flow, strict=True) if f}


def assign(units: list[tuple[int, int, int, int, int, int]], flow: dict[tuple[int, int], int], capacity: dict[int, int]) -> list[tuple]:
    """A new shard, and its first slot there, for every ``(old, block, part, piece, bytes, rows)`` unit.

    The units of an old shard are dealt in order to its destinations; a unit
    that straddles a border goes to the side that holds its middle.  The flow's
    own shard comes first, so what stays is one run of blocks.  What the uncut
    units leave uneven is then evened out by moving single units.
    """
    where: dict[tuple, int] = {}
    for old in sorted({u[0] for u in units}):
        goals = sorted(((b, f) for (a, b), f in flow.items() if a == old), key=lambda x: (x[0] != old, x[0]))
        ends, total = [], 0
        for b, f in goals:
            total += f
            ends.append((total, b))
        at, k = 0, 0
        for u in sorted(u for u in units if u[0] == old):
            while k < len(ends) - 1 and at + u[BYTES] / 2 > ends[k][0]:
                k += 1
            where[u] = ends[k][1]
            at += u[BYTES]
    _even_out(where, capacity)
    out, filled = [], {}
    for u in sorted(where):
        shard = where[u]
        out.append((*u[:BYTES], shard, filled.get(shard, 0)))
        filled[shard] = filled.get(shard, 0) + u[ROWS]
    return out


def _even_out(where: dict[tuple, int], capacity: dict[int, int]) -> None:
    over = {s: -c for s, c in capacity.items()}
    own: dict[int, set[tuple]] = {s: set() for s in capacity}
    for u, s in where.items():
        over[s] += u[BYTES]
        own[s].add(u)
    for _ in range(8 * len(capacity)):
        full, spare = max(over, key=over.get), min(over, key=over.get)
        gap = over[full] - over[spare]
        fits = [u for u in own[full] if u[BYTES] < gap]
        if gap <= 0.001 * max(capacity.values()) or not fits:
            break
        u = min(fits, key=lambda u: (abs(u[BYTES] - gap / 2), u))
        own[full].remove(u)
        own[spare].add(u)
        over[full] -= u[BYTES]
        over[spare] += u[BYTES]
        where[u] = spare


def reshard(docs: DataFrame, old_shard: Column, weights: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents to shards 0 to len(weights) - 1, moving the fewest bytes.

    ``old_shard`` says where a document is now; ``weights`` are the relative
    capacities of the new shards.  A shard's bytes come near its capacity, and
    equal texts of an old shard stay together, except those that alone hold
    more than ``GIANT`` of a new shard.  Returns one row per input row:
    ``doc_id``, ``size``, ``text_crc32``, ``old_shard``, ``shard``, ``slot``
    (gapless from 0 in each shard) and ``rewritten`` (the shard gains or loses
    documents, so its file is written anew: see :func:`rewrite`).  A null text
    counts as empty, a null id as an id; identical rows get slots of their own;
    an empty table gives an empty result.
    """
    place = _plan(docs, old_shard, weights, id_col, text_col)
    return place(place.rows).selectExpr(*PLACED)


PLACED = ["doc_id", "size", "text_crc32", "old AS old_shard", "shard", "slot", "rewritten"]


def write_shards(docs: DataFrame, old_shard: Column, weights: list[int], path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Reshard as :func:`reshard` does and write the files of the shards that gain or lose documents.

    ``path`` gets a folder ``shard=<n>`` for each of them, with ``doc_id``,
    ``text``, ``old_shard`` and ``slot`` of all its documents; the others stay
    where they are.  Returns the columns of :func:`reshard`, read from the
    files as far as they were written.  Ids may be null or repeated: rows are
    written as they come and meet no other table by their ids.
    """
    spark = docs.sparkSession
    place = _plan(docs, old_shard, weights, id_col, text_col)
    # The texts are dealt once, by unit, so that a task has whole units and a shard few files.
    texts = place(place.keyed(F.col(text_col).alias("text")), dealt_by=[F.col("shard"), F.floor(F.col("first") / FILE_ROWS)], only="rewritten")
    texts.select("doc_id", "text", F.col("old").alias("old_shard"), "slot", "shard").write.partitionBy("shard").parquet(path)
    written = spark.read.schema("doc_id {}, text string, old_shard int, slot long, shard int".format(docs.schema[id_col].dataType.simpleString())).parquet(path)
    text = F.coalesce("text", F.lit(""))
    found = written.select("doc_id", document_size(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "old_shard", "shard", "slot", F.lit(True).alias("rewritten"))
    if place.untouched:
        found = found.unionByName(place(place.rows, only="NOT rewritten").selectExpr(*PLACED))
    return found


class _plan:
    """Where each document goes: the flow between the shards and the units that realise it.

    ``rows`` is a table of what :meth:`keyed` tells of each document; a call
    adds ``shard``, ``slot`` and ``rewritten`` to such rows.
    """

    def __init__(self, docs: DataFrame, old_shard: Column, weights: list[int], id_col: str, text_col: str):
        self.docs, self.old_shard, self.id_col, self.text_col = docs, old_shard, id_col, text_col
        spark = docs.sparkSession
        self.rows, _ = materialise(self.keyed(), "reshard")
        sums = [F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")]
        # At most BLOCKS rows for each old shard, whatever the number of documents.
        blocks = self.rows.groupBy("old", "block").agg(*sums).collect()
        total = sum(b["size"] for b in blocks)
        capacity = _shares(total, weights)
        giant = GIANT * min(capacity.values())
        heavy = {(b["old"], b["block"]) for b in blocks if b["size"] > HEAVY * total / len(weights)}
        self.cut = F.broadcast(local_table(spark, sorted(heavy), "old int, block int"))
        dealt = self._parts(self.rows)
        parts = dealt.join(self.cut, ["old", "block"], "left_semi").groupBy("old", "block", "part").agg(*sums).collect()
        # Of the parts that are larger than a shard, the texts that are: fewer than there are shards, about.
        large = [(p["old"], p["block"], p["part"]) for p in parts if p["size"] > giant]
        within = dealt.join(F.broadcast(local_table(spark, large, "old int, block int, part int")), ["old", "block", "part"], "left_semi")
        same = within.groupBy("old", "block", "part", "same").agg(*sums).where(F.col("size") > giant).select("old", "block", "part", "same").collect()
        self.split = F.broadcast(local_table(spark, [tuple(r) for r in same], "old int, block int, part int, same long"))
        broken = {(r["old"], r["block"], r["part"]) for r in same}
        pieces = []
        if broken:
            of = F.broadcast(local_table(spark, sorted(broken), "old int, block int, part int"))
            pieces = self._pieces(dealt).join(of, ["old", "block", "part"], "left_semi").groupBy(*UNIT).agg(*sums).collect()
        units = [(b["old"], b["block"], 0, -1, b["size"], b["n"]) for b in blocks if (b["old"], b["block"]) not in heavy]
        units += [(p["old"], p["block"], p["part"], -1, p["size"], p["n"]) for p in parts if (p["old"], p["block"], p["part"]) not in broken]
        units += [(p["old"], p["block"], p["part"], p["piece"], p["size"], p["n"]) for p in pieces]
        old: dict[int, int] = {}
        for u in units:
            old[u[0]] = old.get(u[0], 0) + u[BYTES]
        where = assign(units, transfers(old, capacity), capacity)
        touched = {s for u in where if u[0] != u[4] for s in (u[0], u[4])}
        self.untouched = {u[4] for u in where} - touched
        self.placed = F.broadcast(local_table(spark, [(*u, u[4] in touched) for u in where], "old int, block int, part int, piece int, shard int, first long, rewritten boolean"))

    def keyed(self, *more: Column) -> DataFrame:
        text = F.coalesce(F.col(self.text_col), F.lit(""))
        return self.docs.select(
            F.col(self.id_col).alias("doc_id"),
            document_size(F.col(self.text_col)).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            self.old_shard.cast("int").alias("old"),
            F.pmod(F.xxhash64(F.lit(17), text), F.lit(BLOCKS)).cast("int").alias("block"),
            F.xxhash64(F.lit(19), text).alias("same"),
            *more,
        )

    def _parts(self, rows: DataFrame) -> DataFrame:
        dealt = rows.join(self.cut.withColumn("cut", F.lit(True)), ["old", "block"], "left")
        return dealt.withColumn("part", F.when(F.col("cut"), F.pmod("same", F.lit(PARTS)).cast("int")).otherwise(F.lit(0))).drop("cut")

    def _pieces(self, dealt: DataFrame) -> DataFrame:
        piece = F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(PIECES)).cast("int")
        dealt = dealt.join(self.split.withColumn("split", F.lit(True)), ["old", "block", "part", "same"], "left")
        return dealt.withColumn("piece", F.when(F.col("split"), piece).otherwise(F.lit(-1))).drop("split")

    def __call__(self, rows: DataFrame, dealt_by: list[Column] | None = None, only: str = "TRUE") -> DataFrame:
        found = self._pieces(self._parts(rows)).join(self.placed, UNIT).where(only)
        by = list(UNIT)
        if dealt_by:
            found = found.withColumns({"_a": dealt_by[0], "_b": dealt_by[1]}).repartition("_a", "_b")
            by = ["_a", "_b", *UNIT]
        order = Window.partitionBy(*by).orderBy("doc_id", "text_crc32", "size")
        return found.withColumn("slot", F.col("first") + F.row_number().over(order) - 1)


def _shares(total: int, weights: list[int]) -> dict[int, int]:
    """Whole capacities in proportion to the weights that hold ``total`` together."""
    ends = [total * sum(weights[: i + 1]) // sum(weights) for i in range(len(weights))]
    return {i: b - a for i, (a, b) in enumerate(zip([0, *ends], ends, strict=False))}


def rewrite(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> list[int]:
    """Write the files of the shards that gained or lost documents; the others stay untouched.

    ``placed`` comes from :func:`reshard` over unique, non-null ids; ``path``
    holds one folder ``shard=<n>`` for each shard.  Returns the rewritten shards.
    """
    moved = placed.where(F.col("old_shard") != F.col("shard"))
    touched = sorted(r[0] for r in moved.select(F.col("shard")).union(moved.select("old_shard")).distinct().collect())
    into = placed.where(F.col("shard").isin(touched)).select(F.col("doc_id").alias(id_col), "shard", "slot")
    rows = docs.join(into, id_col).repartition("shard").sortWithinPartitions("shard", "slot")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    return touched
