"""N-gram Jaccard join with signature trees.

A document's set is its distinct word shingles; two documents link when their
Jaccard similarity reaches the threshold.  Equal sets are one node.  Candidates
come from an exact prefix filter: in any one order of all shingles, two similar
sets share a shingle among the first quarter of each.  The prefix shingles are
dealt to partitions once, and only those leave their partition that two sets of
fitting sizes hold.  The nodes that share prefix shingles are joined through
signature trees, whose nodes hold the OR-combined bitmaps and the size range of
the sets below; a dual traversal drops pairs of tree nodes whose largest
possible overlap is too small.  What is left is verified on the whole sets.

No shingle has a task to itself.  The order puts the shingles that a sample of
the documents shows often last, rarest first; a prefix row of such a shingle is
dealt by shingle and node, and at most ``KNOWN`` are so known.  A shingle that
is not among them has at most one in ``KNOWN`` of the sample's rows, so the rows
that meet by shingle alone stay few whatever the documents are.

Only connected components are wanted, so pairs inside one component are never
looked at again: a first round links every node with the hub of most of its
shared prefix shingles, and later rounds join only what is still apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import ARROW_ROWS, connected_components, drop, free_shuffles, left_join_hot, materialise, small_batches, trimmed

WORDS = 5
#: Two sets link when PERCENT of their union is shared.
PERCENT = 75
BITS = 2048
#: The largest bitmap of a large set, and the bits of a bitmap for each shingle.
WIDEST, BITS_EACH = 1 << 17, 2
LEAF, FANOUT = 16, 8
#: Rows of one tree; the rows of a more frequent shingle are dealt into blocks of half of it.
TREE_ROWS = 1024
#: Shared prefix shingles for each thousand of a set that make the first round look at a pair.
PROMISING = 100
#: Which pairs a task returns.
OF_ONE, OF_TWO, ALL = "one", "two", "all"
#: One document in so many tells which shingles are frequent, and how many of those are known at
#: most.  Frequent shingles come last in the order; any order gives the same result.
SAMPLE, FREQUENT, KNOWN = 16, 4, 1 << 18
#: A side of a join is broadcast up to this many bytes and shuffled beyond.
BROADCAST_BYTES = 16 << 20
#: Pairs of one node that are verified in one task; the pairs of a larger hub are dealt to several.
HUB_PAIRS = 256
#: Neighbours by size within a shingle that a prefix row is compared with one by one.
NEIGHBOURS = 8
CHUNK_BYTES = 1 << 19


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)
#: Powers of the base and of its inverse modulo 2^64, as far as a worker has needed them.
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(n, 2 * CHUNK_BYTES)
        for k, base in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            step = np.full(n, base, np.uint64)
            step[0] = 1
            _POWERS[k] = np.multiply.accumulate(step)
    return _POWERS


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the runs of bytes other than white space, and where they start.

    A word's hash is the sum of its bytes' random values times rising powers of
    a base, read off running sums over all the data.
    """
    b = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[b], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    rise, fall = _powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * rise[: len(b)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * fall[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text.

    A-Z is lower-cased; words are runs other than ASCII white space.  Fewer
    than ``WORDS`` words are one shingle, no words none.
    """
    each = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    h, starts = word_hashes(b" ".join(each))
    first = np.concatenate([[0], np.cumsum([len(x) + 1 for x in each])])
    bounds = np.searchsorted(starts, first)
    rolled = np.full(max(0, len(h) - WORDS + 1), WORDS, np.uint64)
    for i in range(WORDS):
        rolled = _mix(rolled * _BASE + h[i : i + len(rolled)])
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= WORDS:
            own = np.sort(rolled[a : b - WORDS + 1])
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for x in h[a:b]:
                one = _mix(one * _BASE + x)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bitmap(tokens: np.ndarray) -> bytes:
    """A set's bitmap: ``BITS`` bits, more for a large set; a wide one folds to any smaller one."""
    size = max(BITS, min(WIDEST, 1 << (BITS_EACH * max(len(tokens), 1) - 1).bit_length()))
    bits = np.zeros(size, bool)
    bits[(tokens % np.uint64(size)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def folded(bits: bytes) -> np.ndarray:
    """The bitmap of ``BITS`` bits that a wider one folds to, as 64-bit words."""
    return np.bitwise_or.reduce(np.frombuffer(bits, np.uint64).reshape(-1, BITS // 64), 0)


def most_shared(x: bytes, y: bytes, n: int, m: int) -> int:
    """The largest overlap of two sets of n and m shingles that their bitmaps allow."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    size = min(len(a), len(b))
    a, b = (np.bitwise_or.reduce(v.reshape(-1, size), 0) for v in (a, b))
    p, q, common = (int(np.bitwise_count(v).sum()) for v in (a, b, a & b))
    return min(n - p, m - q) + common


def _fits(x: bytes, y: bytes, n: int, m: int) -> bool:
    """False for sets that the wider bitmaps rule out; those of ``BITS`` bits have been looked at."""
    return min(len(x), len(y)) * 8 <= BITS or (100 + PERCENT) * most_shared(x, y, n, m) >= PERCENT * (n + m)


def prefix(tokens: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first quarter of a set, frequent shingles last, and which of these are frequent.

    Similar sets share one of these.  ``frequent`` is sorted; ``rank`` is each
    one's place in the order, rarest first.
    """
    n = len(tokens)
    length = n - -(-PERCENT * n // 100) + 1 if n else 0
    if not len(frequent) or not n:
        return tokens[:length], np.zeros(length, bool)
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    known = frequent[at] == tokens
    rare = tokens[~known]
    if len(rare) >= length:
        return rare[:length], np.zeros(length, bool)
    often = tokens[known][np.argsort(rank[at[known]])]
    out = np.concatenate([rare, often])[:length]
    return out, np.arange(length) >= len(rare)


def largest_partners(n: int, length: int) -> np.ndarray:
    """For each place in a prefix, the size of the largest set whose first shared shingle may stand there.

    If the first shared shingle of sets of n and m shingles is number i of the
    first, at most n - i are shared; 3/7 of n + m must be.
    """
    i = np.arange(length, dtype=np.int64)
    share, whole = PERCENT, 100 + PERCENT
    return ((n - i) * whole - share * n) // share


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    sizes = np.nan_to_num(np.array(pa.compute.binary_length(batch.column(text)).to_numpy(zero_copy_only=False), float))
    ends = (np.cumsum(sizes) // CHUNK_BYTES).astype(int)
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(ends)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64)))


def _names(tokens: np.ndarray, bits: int) -> tuple[int, int]:
    """Two 64-bit names of a set; ``bits`` shortens the first one (tests)."""
    name = xxhash.xxh128_intdigest(tokens.tobytes())
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return signed(name & ((1 << bits) - 1)), signed(name >> 64)


def _node(tokens: np.ndarray, clashes: frozenset[int], bits: int) -> int:
    """A set's node: its first name, or the second one where different sets share the first."""
    one, two = _names(tokens, bits)
    return two if one in clashes else one


def _signatures(bits: int):
    """Names, sizes and bitmaps of texts (``doc_id``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                sets = shingle_sets(part.column(1).to_pylist())
                names = [_names(x, bits) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([x for x, _ in names], pa.int64()),
                        pa.array([x for _, x in names], pa.int64()),
                        pa.array([bitmap(x) if len(x) else None for x in sets], pa.binary()),
                    ],
                    names=["doc_id", "n", "one", "two", "bits"],
                )

    return run


def _sets(clashes: frozenset[int], bits: int):
    """Nodes and whole sets of texts (the only column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 0):
                sets = shingle_sets(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([_node(x, clashes, bits) for x in sets], pa.int64()), _lists(sets)], names=["node", "tokens"])

    return run


def _prefix_rows(shared, clashes: frozenset[int], bits: int):
    """A row for each prefix shingle of each different set of a batch of texts.

    ``place`` packs the set's size, the largest partner's and whether the
    shingle is a frequent one: 32, 31 and 1 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = shared.value
        for batch in batches:
            seen: set[int] = set()
            for part in _slices(batch, 0):
                tokens, nodes, places = [], [], []
                for x in shingle_sets(part.column(0).to_pylist()):
                    if not len(x) or (node := _node(x, clashes, bits)) in seen:
                        continue
                    seen.add(node)
                    own, known = prefix(x, frequent, rank)
                    tokens.append(own)
                    nodes.append(np.full(len(own), node, np.int64))
                    places.append((np.int64(len(x)) << 32) | (largest_partners(len(x), len(own)) << 1) | known)
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(places))], names=["token", "node", "place"]
                    )

    return run


def _met(token: np.ndarray, n: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Rows (sorted by shingle and size) that another row of their shingle may link with by size and place."""
    size = len(token)
    keep = np.zeros(size, bool)
    for d in range(1, min(NEIGHBOURS, size - 1) + 1):
        a, b = slice(0, size - d), slice(d, size)
        fits = (token[a] == token[b]) & (100 * n[a] >= PERCENT * n[b]) & (n[b] <= high[a]) & (n[a] <= high[b])
        keep[a] |= fits
        keep[b] |= fits
    if size > NEIGHBOURS + 1:  # in a longer run, the nearest sizes decide: none that may link is dropped
        far = token[: size - NEIGHBOURS - 1] == token[NEIGHBOURS + 1 :]
        if far.any():
            long_run = np.isin(token, token[: size - NEIGHBOURS - 1][far])
            near = (token[:-1] == token[1:]) & (100 * n[:-1] >= PERCENT * n[1:])
            above = near & (n[1:] <= high[:-1])
            keep[:-1] |= long_run[:-1] & above
            keep[1:] |= long_run[1:] & near
    return keep


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix rows of shared shingles, from rows sorted by shingle, place and node.

    Rows of frequent shingles pass, each once; the others pass if a row of
    their shingle may link with them.  ``c`` is the number of sets that hold a
    shingle, null for a frequent one.
    """

    def settle(token: np.ndarray, node: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        token, node, place = token[fresh], node[fresh], place[fresh]
        n, high, known = place >> 32, (place >> 1) & 0x7FFFFFFF, (place & 1).astype(bool)
        keep = known.copy()
        rare = np.flatnonzero(~known)
        keep[rare] = _met(token[rare], n[rare], high[rare])
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        counts = np.diff(np.concatenate([starts, [len(token)]]))
        c = pa.array(np.repeat(counts, counts)[keep], pa.int64(), mask=known[keep])
        return pa.RecordBatch.from_arrays(
            [pa.array(token[keep]), pa.array(node[keep]), pa.array(n[keep]), pa.array((high >= n)[keep]), c], names=["token", "node", "n", "short", "c"]
        )

    kept = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        now = [np.concatenate([k, batch.column(i).to_numpy()]) for i, k in enumerate(kept)]
        if not len(now[0]):
            continue
        last = np.searchsorted(now[0], now[0][-1])  # the last shingle may go on in the next batch
        kept = [x[last:] for x in now]
        if last:
            yield settle(*[x[:last] for x in now])
    if len(kept[0]):
        yield settle(*kept)


class SignatureTree:
    """A packed tree over sets; levels[0] are the sets, the last is the root.

    Each node holds the OR of the bitmaps below it, the range of sizes and of
    components, and which of the task's shared shingles lie in the prefixes
    (``probe``) and in the shorter prefixes (``index``) below it.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, groups: np.ndarray, index: np.ndarray | None = None, probe: np.ndarray | None = None):
        own = np.bitwise_count(bits).sum(1).astype(np.int64)
        all_ = np.full((len(sizes), 1), ~np.uint64(0))
        level = {"bits": bits, "low": sizes, "high": sizes, "slack": sizes - own, "first": groups, "last": groups, "index": all_ if index is None else index, "probe": all_ if probe is None else probe}
        self.levels = [level]
        fan = LEAF
        how = {"bits": np.bitwise_or, "low": np.minimum, "high": np.maximum, "slack": np.maximum, "first": np.minimum, "last": np.maximum, "index": np.bitwise_or, "probe": np.bitwise_or}
        while len(level["low"]) > 1:
            at = np.arange(0, len(level["low"]), fan)
            level = {k: f.reduceat(level[k], at, 0) for k, f in how.items()} | {"fan": fan}
            self.levels.append(level)
            fan = FANOUT


def _may_link(x: dict, i: np.ndarray, y: dict, j: np.ndarray) -> np.ndarray:
    """False for pairs that cannot hold a link between two components.

    Sizes must be in proportion; the smaller set's short prefix must meet the
    larger one's prefix; and one component on both sides needs no more links.
    A bit of one bitmap that the other lacks is a shingle that is not shared,
    so the overlap is at most the common bits and the shingles whose bits
    collide.
    """
    fits = (100 * x["high"][i] >= PERCENT * y["low"][j]) & (100 * y["high"][j] >= PERCENT * x["low"][i])
    fits &= ~((x["first"][i] == x["last"][i]) & (y["first"][j] == y["last"][j]) & (x["first"][i] == y["first"][j]))
    at = np.flatnonzero(fits)
    for a in range(0, len(at), 1 << 14):
        part = at[a : a + (1 << 14)]
        p, q = i[part], j[part]
        met = (x["index"][p] & y["probe"][q]).any(1) & (x["low"][p] <= y["high"][q])
        met |= (x["probe"][p] & y["index"][q]).any(1) & (y["low"][q] <= x["high"][p])
        p, q = p[met], q[met]
        common = np.bitwise_count(x["bits"][p] & y["bits"][q]).sum(1).astype(np.int64)
        most = np.minimum(x["slack"][p], y["slack"][q]) + common
        fits[part] = False
        fits[part[met]] = (100 + PERCENT) * most >= PERCENT * (x["low"][p] + y["low"][q])
    return fits


def dual_traversal(x: SignatureTree, y: SignatureTree | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets of two trees (or within one) that may link, level by level from the roots."""
    same = y is None
    y = x if same else y
    a, b = len(x.levels) - 1, len(y.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        keep = _may_link(x.levels[a], i, y.levels[b], j)
        i, j = i[keep], j[keep]
        if a == 0 and b == 0:
            return (i[i < j], j[i < j]) if same else (i, j)
        if a >= b:
            i, j = _children(x, a, i, j)
            a -= 1
            if same:
                j, i = _children(y, b, j, i)
                b -= 1
                i, j = i[i <= j], j[i <= j]
        else:
            j, i = _children(y, b, j, i)
            b -= 1


def _children(tree: SignatureTree, level: int, nodes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    fan, below = tree.levels[level]["fan"], len(tree.levels[level - 1]["low"])
    down = (nodes[:, None] * fan + np.arange(fan)).ravel()
    across = np.repeat(others, fan)
    return down[down < below], across[down < below]


def _join_tree(keep_pairs: str):
    """The function of one task: pairs that may link.

    All of them, or the most promising ones of each component or of each two
    components; ``more`` marks components that had others.
    """

    def tree(rows: pd.DataFrame, tokens: np.ndarray) -> SignatureTree:
        counts = rows["tokens"].map(len).to_numpy()
        at = np.repeat(np.arange(len(rows)), counts)
        column = np.searchsorted(tokens, np.concatenate(rows["tokens"].tolist()))
        seen = [np.zeros((len(rows), -(-len(tokens) // 64) * 64), bool) for _ in range(2)]
        seen[1][at, column] = True
        short = np.concatenate(rows["short"].tolist()).astype(bool)
        seen[0][at[short], column[short]] = True
        index, probe = (np.packbits(x, 1).view(np.uint64) for x in seen)
        bits = np.stack([folded(b) for b in rows["bits"]])
        return SignatureTree(bits, rows["n"].to_numpy(np.int64), rows["component"].to_numpy(np.int64), index, probe)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tokens = np.unique(np.concatenate(pdf["tokens"].tolist()))
        # Sets that share a shingle stand near each other.
        pdf = pdf.assign(key=pdf["tokens"].map(min)).sort_values(["key", "n", "node"])
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if pdf["same"].iloc[0]:
            x = y = tree(left, tokens)
            right = left
            i, j = dual_traversal(x)
        elif len(left) and len(right):
            x, y = tree(left, tokens), tree(right, tokens)
            i, j = dual_traversal(x, y)
        else:
            i = j = np.zeros(0, np.int64)
        u, v, n, m = left["bits"].tolist(), right["bits"].tolist(), left["n"].tolist(), right["n"].tolist()
        keep = [_fits(u[a], v[b], n[a], m[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
        i, j = i[keep], j[keep]
        ca, cb = left["component"].to_numpy()[i], right["component"].to_numpy()[j]
        out = pd.DataFrame({"a": left["node"].to_numpy()[i], "b": right["node"].to_numpy()[j], "p": np.minimum(ca, cb), "q": np.maximum(ca, cb)})
        out["more"] = False
        if keep_pairs != ALL and len(out):
            common = np.bitwise_count(x.levels[0]["bits"][i] & y.levels[0]["bits"][j]).sum(1)
            out["rank"] = -common.astype(float) / (x.levels[0]["low"][i] + y.levels[0]["low"][j])
            out = out.sort_values(["rank", "a", "b"], ignore_index=True)
            if keep_pairs == OF_TWO:
                out["more"] = out.duplicated(["p", "q"], keep=False)
                out = out.drop_duplicates(["p", "q"])
            else:
                ends = pd.concat([out["p"], out["q"]]).sort_index(kind="stable")
                first = ends[~ends.reset_index(drop=True).duplicated().to_numpy()]
                kept = out.index.isin(first.index)
                others = pd.concat([out["p"][~kept], out["q"][~kept]]).unique()
                out = out[kept]
                out["more"] = out["p"].isin(others) | out["q"].isin(others)
        low, high = out[["a", "b"]].min(axis=1), out[["a", "b"]].max(axis=1)
        return out.assign(a=low, b=high)[["a", "b", "p", "q", "more"]].astype({"a": "int64", "b": "int64", "p": "int64", "q": "int64"})

    return run


def _plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that the bitmaps do not rule out."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [(100 + PERCENT) * most_shared(x, y, n, m) >= PERCENT * (n + m) for x, y, n, m in zip(batch["x"], batch["y"], batch["n"], batch["m"], strict=True)]
            yield batch.loc[keep, ["a", "b"]]

    a = nodes.select(F.col("node").alias("a"), "n", F.col("bits").alias("x"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    return pairs.select("a", "b").distinct().join(a, "a").join(b, "b").mapInPandas(trimmed(check), "a long, b long")


def _small(df: DataFrame, bytes_a_row: int) -> DataFrame:
    """Broadcast what is small enough; ``df`` is a written table, so counting is cheap."""
    return F.broadcast(df) if df.count() * bytes_a_row <= BROADCAST_BYTES else df


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles most often seen in a sample of the documents, sorted, and each one's place in the order.

    ``KNOWN`` at most, whatever the number of documents.
    """
    sample = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE)) == 0).select("text")
    tokens = sample.mapInArrow(trimmed(_sets(frozenset(), 64)), "node long, tokens array<long>").select(F.explode("tokens").alias("token"))
    top = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= FREQUENT).orderBy(F.desc("c"), "token").limit(KNOWN)
    found = top.toArrow()
    token, count = found.column("token").to_numpy().view(np.uint64), found.column("c").to_numpy()
    by_hash = np.argsort(token)
    rank = np.empty(len(token), np.int64)
    rank[np.lexsort((token, count))] = np.arange(len(token))
    return token[by_hash], rank[by_hash]


class _Corpus:
    """The texts, the node of each row (``named``, which outlives it), and what is read again by node."""

    def __init__(self, texts: DataFrame):
        self.texts, self.spark = texts, texts.sparkSession
        signed = texts.mapInArrow(trimmed(_signatures(NODE_BITS)), "doc_id long, n long, one long, two long, bits binary")
        self.signed, self.path = materialise(signed, "signatures")
        self.filled = self.signed.where("n > 0")
        # Sets are equal by 128 bits: of those that share the first 64, each goes by the other 64.
        names = self.filled.groupBy("one").agg(F.min("two").alias("low"), F.max("two").alias("high")).where("low <> high")
        self.clashes = frozenset(r["one"] for r in names.select("one").collect())  # about one for 10^10 documents
        self.named, _ = materialise(self.signed.withColumn("node", self._node()).select("doc_id", "n", "node"), "named")
        reps = self.named.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
        self.reps, self.reps_path = materialise(reps, "reps", slim=True)

    def _node(self):
        return F.when(F.col("one").isin(*self.clashes), F.col("two")).otherwise(F.col("one")) if self.clashes else F.col("one")

    def prefixes(self, shared) -> DataFrame:
        return self.texts.select("text").mapInArrow(trimmed(_prefix_rows(shared, self.clashes, NODE_BITS)), "token long, node long, place long")

    def bitmaps(self, involved: DataFrame) -> DataFrame:
        """Size and bitmap of each node of ``involved`` (a written table)."""
        own = self.filled.withColumn("node", self._node()).join(_small(involved, 24), "node", "left_semi")
        return own.groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))

    def whole_sets(self, involved: DataFrame) -> tuple[DataFrame, str]:
        """The whole sets of the nodes of ``involved`` (a written table), one row each, in a table.

        They are built again from one text of each node only.
        """
        wanted, wanted_path = materialise(self.reps.join(_small(involved, 24), "node", "left_semi").select("doc_id").distinct(), "wanted", slim=True)
        wanted = wanted.select(F.col("doc_id").alias("wanted"))
        picked = self.texts.join(_small(wanted, 24), F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
        sets = picked.mapInArrow(trimmed(_sets(self.clashes, NODE_BITS)), "node long, tokens array<long>").join(_small(involved, 24), "node", "left_semi")
        found, path = materialise(sets, "sets")
        if found.count() > found.select("node").distinct().count():  # rows of one id, or without one
            first, first_path = found, path
            found, path = materialise(first.groupBy("node").agg(F.first("tokens").alias("tokens")), "sets")
            drop(self.spark, first_path)
        drop(self.spark, wanted_path)
        return found, path

    def close(self) -> None:
        drop(self.spark, self.path)
        drop(self.spark, self.reps_path)


#: Bits of a set's first name.
NODE_BITS = 64


def _verify(pairs: DataFrame, corpus: _Corpus) -> DataFrame | None:
    """The pairs whose whole sets are similar enough, written to a table; None if there are no pairs.

    The set of a node of many pairs goes to a task for each ``HUB_PAIRS`` of them.
    """
    spark = corpus.spark
    pairs, pairs_path = materialise(pairs, "plausible", slim=True)
    if pairs.isEmpty():
        drop(spark, pairs_path)
        return None
    involved, involved_path = materialise(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "involved", slim=True)
    sets, sets_path = corpus.whole_sets(involved)
    hubs, hubs_path = materialise(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_PAIRS).cast("int").alias("parts")), "hubs", slim=True)
    parts = F.coalesce("parts", F.lit(1))
    salted = pairs.join(_small(hubs.where("parts > 1"), 24), "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("part"))
    a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")).join(_small(hubs, 24), "a")
    a = a.select("a", "x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    salted, salted_path = materialise(salted, "salted", slim=True)
    both = b.join(_small(salted, 40), "b").join(a, ["a", "part"])
    both = both.withColumn("shared", F.size(F.array_intersect("x", "y")))
    similar = both.where(F.lit(100) * F.col("shared") >= F.lit(PERCENT) * (F.size("x") + F.size("y") - F.col("shared"))).select("a", "b")
    links, _ = materialise(similar, "links", slim=True)
    for path in (involved_path, sets_path, pairs_path, hubs_path, salted_path):
        drop(spark, path)
    free_shuffles(spark)
    return links


def _merge(component: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links: only the links between components are followed."""
    of = component.select(F.col("node").alias("x"), F.col("component").alias("y"))
    for c in ("a", "b"):
        links = links.join(of.withColumnsRenamed({"x": c, "y": f"{c}_of"}), c, "left").withColumn(f"{c}_of", F.coalesce(f"{c}_of", c))
    joined = connected_components(links.select(F.col("a_of").alias("a"), F.col("b_of").alias("b")), "cc")
    joined = joined.select(F.col("node").alias("was"), F.col("component").alias("now"))
    new = joined.join(component, F.col("was") == F.col("node"), "left_anti").select(F.col("was").alias("node"), F.col("was").alias("component"))
    every = component.unionByName(new).join(joined, F.col("component") == F.col("was"), "left")
    return materialise(every.select("node", F.coalesce("now", "component").alias("component")), "component", slim=True)[0]


def _tree_pairs(rows: DataFrame, component: DataFrame, corpus_nodes: DataFrame, keep_pairs: str) -> tuple[DataFrame, str]:
    """Candidates of the shingles that more than one component shares, tree by tree."""
    spark = rows.sparkSession
    named = rows.join(_small(component, 32), "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.select("token", "hub", "node", "short", "component")
    multi = named.groupBy("token").agg(F.min("component").alias("p"), F.max("component").alias("q"), F.count(F.lit(1)).alias("rows"))
    multi, multi_path = materialise(multi.where("p < q").select("token", "rows"), "multi", slim=True)
    apart = named.join(_small(multi, 24), "token")
    apart, path = materialise(apart, "apart")
    trees = max(1, -(-apart.count() // TREE_ROWS))
    involved, involved_path = materialise(apart.select("node").distinct(), "involved", slim=True)
    # Frequent shingles have trees of their own, one for each two blocks.  The others share trees:
    # those of one hub, often one passage, stay together while they are few.
    own_hub, hubs_path = materialise(apart.where(F.col("rows") <= TREE_ROWS).groupBy("hub").agg(F.count(F.lit(1)).alias("of_hub")), "hubs", slim=True)
    blocks = F.when(F.col("rows") > TREE_ROWS, F.ceil(F.col("rows") / F.lit(TREE_ROWS // 2))).otherwise(F.lit(1)).cast("int")
    dealt = apart.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(F.lit(23), "node"), F.col("blocks")).cast("int"))
    dealt = dealt.join(_small(own_hub, 24), "hub", "left")
    shared = F.when(F.col("of_hub") <= 4 * TREE_ROWS, F.xxhash64("hub")).otherwise(F.xxhash64("token"))
    own = F.when(F.col("blocks") > 1, F.col("token")).otherwise(F.pmod(shared, F.lit(trees)))
    spread = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j"), (F.col("block") > k).cast("int").alias("side"), (F.col("block") == k).alias("same")),
    )
    placed = dealt.withColumn("tree", own).withColumn("pair", F.explode(spread)).select("tree", (F.col("blocks") > 1).alias("hot"), "token", "node", "short", "component", "pair.*")
    # One row for each set of a tree; the list holds prefix shingles of one set.  Dealt by node, the
    # rows meet their bitmaps where they are.
    placed = placed.repartition("node").groupBy("hot", "tree", "i", "j", "side", "same", "node", "component").agg(F.collect_list(F.struct("token", "short")).alias("held"))
    placed = placed.select("hot", "tree", "i", "j", "side", "same", "node", "component", F.col("held.token").alias("tokens"), F.col("held.short").alias("short"))
    placed = placed.join(corpus_nodes.join(_small(involved, 24), "node", "left_semi"), "node")
    pairs = placed.groupBy("hot", "tree", "i", "j").applyInPandas(_join_tree(keep_pairs), "a long, b long, p long, q long, more boolean")
    found = materialise(pairs, "pairs")
    for p in (path, involved_path, hubs_path, multi_path):
        drop(spark, p)
    free_shuffles(spark)
    return found


@contextmanager
def _own_batches(spark: SparkSession) -> Iterator[None]:
    """Small Arrow batches while the Python stages run; the session's own setting after them."""
    before = spark.conf.get(ARROW_ROWS)
    small_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def _hubs(rows: DataFrame) -> tuple[DataFrame, str]:
    """The rows of shingles that several sets hold, each with its shingle's hub.

    A hub is the set whose prefix is seen most often for its size: the middle of a family.
    """
    spark = rows.sparkSession
    # Frequent shingles are counted here, and there are at most KNOWN of them.
    often, often_path = materialise(rows.where("c IS NULL").groupBy("token").agg(F.count(F.lit(1)).alias("often")), "often", slim=True)
    rows = rows.join(F.broadcast(often), "token", "left").withColumn("c", F.coalesce("c", "often")).where("c > 1").drop("often")
    fame = rows.groupBy("node").agg((F.sum("c") / F.first("n")).alias("fame"))
    fame, fame_path = materialise(fame, "fame", slim=True)
    hubs = rows.join(_small(fame, 24), "node").groupBy("token").agg(F.max(F.struct("fame", "node")).alias("hub"))
    out = materialise(rows.join(hubs.select("token", F.col("hub.node").alias("hub")), "token").select("token", "node", "n", "short", "hub"), "rows")
    for path in (often_path, fame_path):
        drop(spark, path)
    return out


def _components(corpus: _Corpus) -> DataFrame:
    """Component of every node that links with another, in a table."""
    spark = corpus.spark
    shared = spark.sparkContext.broadcast(_frequent(corpus.texts))
    free_shuffles(spark)
    dealt = F.when(F.col("place").bitwiseAND(F.lit(1)) == 1, F.xxhash64("token", "node")).otherwise(F.col("token"))
    tokens = corpus.prefixes(shared).repartition(dealt).sortWithinPartitions("token", "place", "node")
    found, found_path = materialise(tokens.mapInArrow(trimmed(_shared_rows), "token long, node long, n long, short boolean, c long"), "shared")
    free_shuffles(spark)
    shared.destroy()
    rows, rows_path = _hubs(found)
    drop(spark, found_path)
    involved, involved_path = materialise(rows.select("node").distinct(), "involved", slim=True)
    nodes, nodes_path = materialise(corpus.bitmaps(involved), "nodes")
    drop(spark, involved_path)
    free_shuffles(spark)

    # First round: each node with the hub of most of its shared shingles, if those are many.
    votes = rows.where("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
    votes = votes.groupBy("node").agg(F.max(F.struct("c", "hub")).alias("best"), F.first("n").alias("n"))
    pairs = votes.where(F.col("best.c") * 1000 >= PROMISING * F.col("n")).select(F.col("best.hub").alias("a"), F.col("node").alias("b"))
    links = _verify(_plausible(pairs, nodes), corpus)
    links = spark.createDataFrame([], "a long, b long") if links is None else links
    component, _ = materialise(connected_components(links, "cc"), "component", slim=True)
    # Then the most promising pair of each component in a tree, of each two components, and all pairs;
    # each round only for the components that had more pairs in the round before.
    scope, seen, paths = rows, None, []
    for keep_pairs in (OF_ONE, OF_TWO, ALL):
        found, path = _tree_pairs(scope, component, nodes, keep_pairs)
        paths.append(path)
        pairs = found.select("a", "b").distinct()
        links = _verify(pairs if seen is None else pairs.join(seen, ["a", "b"], "left_anti"), corpus)
        seen = pairs if seen is None else seen.unionByName(pairs)
        before = component
        component = component if links is None else _merge(component, links)
        if keep_pairs == ALL:
            break
        unsettled = found.where("more").select("p", "q").distinct()
        if keep_pairs == OF_TWO:
            now = component.select(F.col("node").alias("x"), F.col("component").alias("y"))
            for c in ("p", "q"):
                unsettled = unsettled.join(now.withColumnsRenamed({"x": c, "y": f"{c}_now"}), c, "left").withColumn(f"{c}_now", F.coalesce(f"{c}_now", c))
            unsettled = unsettled.where("p_now <> q_now")
        open_, path = materialise(unsettled.select(F.col("p").alias("was")).union(unsettled.select("q")).distinct(), "unsettled", slim=True)
        paths.append(path)
        if open_.isEmpty():
            break
        named = scope.join(before, "node", "left").withColumn("was", F.coalesce("component", "node"))
        scope = named.join(_small(open_, 24), "was", "left_semi").select("token", "hub", "node", "short")
    for path in (*paths, rows_path, nodes_path):
        drop(spark, path)
    return component


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose shingle sets are similar.

    Returns one row per input row: ``doc_id``, ``n_shingles`` (size of its set)
    and ``component_id`` (smallest id reachable by links, itself included).  A
    null or empty text, or one of white space, has an empty set and links with
    nothing; shorter texts than a shingle are one shingle.  Rows of equal sets
    link, repeated rows included; a component of rows without ids has a null
    id.  Other columns are not read; an empty table gives an empty result.
    Shingles are compared by 64-bit hashes, sets by 128 bits.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with _own_batches(docs.sparkSession):
        corpus = _Corpus(texts)
        component = _components(corpus)
    # Nodes first, rows last: a component may have a third of the nodes, a node a third of the rows.
    resolved = corpus.reps.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    resolved, resolved_path = materialise(resolved, "resolved")
    lowest = resolved.groupBy("component").agg(F.min("doc_id").alias("lowest"), F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    lowest, lowest_path = materialise(lowest.drop("nodes"), "lowest")
    of_node = left_join_hot(resolved, lowest, "component").select("node", F.coalesce("lowest", "doc_id").alias("component_id"))
    of_node, _ = materialise(of_node, "of-node")
    for path in (resolved_path, lowest_path):
        drop(docs.sparkSession, path)
    filled = left_join_hot(corpus.named.where("n > 0"), of_node, "node").select("doc_id", "n", "component_id")
    empty = corpus.named.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = filled.unionByName(empty).withColumnRenamed("n", "n_shingles")
    corpus.close()
    return out
