"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that a
document belongs to).  A flow of tokens runs from the patterns, in tiers whose
cost rises with each repetition, to the quotas of the sources; the cheapest
flow says how often each pattern's tokens are taken.  Documents are then
selected in a seeded order until the pattern's share is reached.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import drop, local_table, materialise

#: Parts of a pattern's seeded order whose sizes are summed on the executors and seen by the driver.
SLICES = 256
#: Slices within the one slice that the share ends in, and so on, this many levels deep.
LEVELS = 3
#: Passes that fill a share: the later ones take shorter documents.
PASSES = 3
MAX_REPEATS = 2
#: The plan of the patterns is broadcast up to this many bytes, about so many each, and shuffled beyond.
BROADCAST_BYTES, PLAN_BYTES = 32 << 20, 512


def word_count(text: Column) -> Column:
    """Number of runs other than ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quotas(sizes: list[tuple[str | None, int]], weights: list[int], share: float, most: int) -> dict[str | None, float]:
    """Target of each source: shares of ``share`` times all sizes by weight.

    Sources are in code point order, null last, and take the weights in turn.
    A target stops at ``most`` times its source's size; the excess is shared
    anew by weight among the others until none is above.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    rest = share * sum(size.values())
    open_ = set(size)
    target: dict[str | None, float] = {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] / total > most * size[s]}
        if not over:
            return target | {s: rest * weight[s] / total for s in open_}
        for s in over:
            target[s] = float(most * size[s])
        rest -= sum(target[s] for s in over)
        open_ -= over
    return target


def min_cost_flow(n: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each ``(from, to, capacity, cost)`` arc of a cheapest largest flow (costs at least 0).

    Successive shortest paths with potentials; capacities and flows are whole.
    """
    graph: list[list[int]] = [[] for _ in range(n)]
    to, room, cost = [], [], []
    for a, b, capacity, price in arcs:
        graph[a].append(len(to))
        graph[b].append(len(to) + 1)
        to += [b, a]
        room += [capacity, 0]
        cost += [price, -price]
    potential = [0] * n
    while True:
        distance: list[float] = [float("inf")] * n
        by = [-1] * n
        distance[source] = 0
        queue = [(0, source)]
        while queue:
            d, u = heapq.heappop(queue)
            if d > distance[u]:
                continue
            for e in graph[u]:
                if room[e] and (new := d + cost[e] + potential[u] - potential[to[e]]) < distance[to[e]]:
                    distance[to[e]] = new
                    by[to[e]] = e
                    heapq.heappush(queue, (new, to[e]))
        if by[sink] < 0:
            break
        potential = [p + int(d) if d < float("inf") else p for p, d in zip(potential, distance, strict=True)]
        path, v = [], sink
        while v != source:
            path.append(by[v])
            v = to[by[v] ^ 1]
        pushed = min(room[e] for e in path)
        for e in path:
            room[e] -= pushed
            room[e ^ 1] += pushed
    return [room[2 * i + 1] for i in range(len(arcs))]


def plan(patterns: dict[tuple, int], targets: dict, repeats: int = MAX_REPEATS) -> dict[tuple, int]:
    """Tokens to take of each pattern: the cheapest flow that fills the sources' targets.

    Taking a token the k-th time costs k * k, so all patterns of a source are
    taken once before any is taken twice.  Sources that no pattern links share
    no tokens, so each linked group is a flow of its own; a source with one
    pattern needs none.
    """
    parent: dict = {s: s for name in patterns for s in name}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for name in patterns:
        for s in name[1:]:
            parent[find(s)] = find(name[0])
    groups: dict = {}
    for name in patterns:
        groups.setdefault(find(name[0]) if name else None, []).append(name)
    take = dict.fromkeys(patterns, 0)
    for names in groups.values():
        sources = sorted({s for name in names for s in name if s in targets}, key=lambda s: (s is None, s or ""))
        if len(names) == 1:
            take[names[0]] = min(sum(round(targets[s]) for s in sources), repeats * patterns[names[0]])
        elif sources:
            take |= _flow({name: patterns[name] for name in names}, {s: targets[s] for s in sources}, repeats)
    return take


def _flow(patterns: dict[tuple, int], targets: dict, repeats: int) -> dict[tuple, int]:
    names, sources = list(patterns), list(targets)
    start, end = 0, 1 + len(names) + len(sources)
    at = {s: 1 + len(names) + i for i, s in enumerate(sources)}
    arcs, tiers = [], []
    for i, name in enumerate(names):
        for k in range(1, repeats + 1):
            tiers.append(name)
            arcs.append((start, 1 + i, patterns[name], k * k))
    for i, name in enumerate(names):
        arcs += [(1 + i, at[s], repeats * patterns[name], 0) for s in name if s in at]
    arcs += [(at[s], end, round(targets[s]), 0) for s in sources]
    flow = min_cost_flow(end + 1, arcs, start, end)
    take = dict.fromkeys(names, 0)
    for name, f in zip(tiers, flow, strict=False):
        take[name] += f
    return take


def membership(*sources: Column) -> Column:
    """The name of a document's pattern: its sorted distinct sources as a JSON list."""
    return F.to_json(F.array_sort(F.array_distinct(F.array(*sources))))


def seeded_hash(id_col: str, text_col: str, seed: int) -> Column:
    """A row's place in the seeded order."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), F.lit(SLICES**LEVELS))


def cut_points(sized: DataFrame, extra: dict[str, int]) -> list[tuple[str, int, int, int]]:
    """Ranges of each pattern's seeded order that hold about ``extra`` tokens together.

    ``sized`` has ``pattern``, ``size`` and ``_hash``.  The slices of the order
    are summed on the executors, and the slice that the share ends in is cut
    again, ``LEVELS`` times.  What is left because the next document is too long
    is filled by further passes over the documents behind the cut that are short
    enough.  Returns ``(pattern, start, cut, longest)``: documents with a hash
    in [start, cut) and at most ``longest`` tokens are taken.
    """
    spark, end = sized.sparkSession, SLICES**LEVELS
    ranges: list[tuple[str, int, int, int]] = []
    start, left = dict.fromkeys(extra, 0), dict(extra)
    for _ in range(PASSES):
        longest = {p: n for p, n in left.items() if n > 0 and start[p] < end}
        cut = {p: start[p] for p in longest}
        high = dict.fromkeys(longest, end)
        for level in range(LEVELS - 1, -1, -1):
            active = [(p, cut[p], high[p], longest[p]) for p in longest if cut[p] < high[p]]
            if not active:
                break
            step = SLICES**level
            table = local_table(spark, active, "pattern string, lo long, hi long, longest long")  # a row for each pattern
            if len(active) * PLAN_BYTES <= BROADCAST_BYTES:
                table = F.broadcast(table)
            inside = sized.join(table, "pattern").where("_hash >= lo AND _hash < hi AND size <= longest")
            sums: dict[str, list[tuple[int, int]]] = {p: [] for p, *_ in active}
            for r in inside.groupBy("pattern", F.expr(f"_hash div {step}").alias("slot")).agg(F.sum("size").alias("size")).collect():
                sums[r["pattern"]].append((r["slot"], r["size"]))  # at most SLICES rows for each pattern
            for p, slots in sums.items():
                stop = high[p]
                for slot, size in sorted(slots):
                    if size > left[p]:
                        stop = slot * step
                        break
                    left[p] -= size
                cut[p], high[p] = (stop, stop) if stop == high[p] else (max(stop, cut[p]), min(high[p], stop + step))
        ranges += [(p, start[p], cut[p], longest[p]) for p in longest if cut[p] > start[p]]
        start |= cut
    return ranges


def mix(
    docs: DataFrame,
    weights: list[int],
    share: float,
    most: int = MAX_REPEATS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_cols: tuple[str, ...] = ("source",),
    seed: int = 7,
) -> DataFrame:
    """How often each document is taken so that the sources come near their targets.

    A document's sources are its ``source_cols``; its size is its words.  See
    :func:`quotas` for the targets and :func:`plan` for the flow.  Returns the
    input rows and columns and, last, one struct named ``_mix`` (with further
    underscores where the input has such names) of ``size``, ``pattern``,
    ``copies`` (0 to ``most``) and, for the first source column,
    ``source_size`` and ``target``.  A null source is a source of its own, a
    null text has size 0; identical rows are taken or left together; an empty
    table gives an empty result.  Reruns agree.  The driver sees a row for each
    pattern of sources, however many there are, and none for a document.
    """
    spark, own = docs.sparkSession, "_mix"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    parts = {"size": word_count(F.col(text_col)), "pattern": membership(*[F.col(c) for c in source_cols]), "hash": seeded_hash(id_col, text_col, seed)}
    rows = docs.withColumn(own, F.struct(*[c.alias(n) for n, c in parts.items()]))
    sized, path = materialise(rows.select(f"{own}.pattern", f"{own}.size", F.col(f"{own}.hash").alias("_hash")), "mix")
    sums = sized.groupBy("pattern").agg(F.sum("size").alias("size")).collect()
    sums.sort(key=lambda r: r["pattern"])
    of = {r["pattern"]: tuple(json.loads(r["pattern"])) for r in sums}
    size = {of[r["pattern"]]: r["size"] for r in sums}
    by_source: dict[str | None, int] = {}
    for name, n in size.items():
        for s in name:
            by_source[s] = by_source.get(s, 0) + n
    order = sorted(by_source.items(), key=lambda x: (x[0] is None, x[0] or ""))
    # Overlapping sources share tokens: the whole is that of the documents, not of the sources.
    whole, listed = sum(size.values()), sum(by_source.values())
    target = quotas(order, weights, share * whole / listed if listed else share, most)
    take = plan(size, target, most)
    extra = {p: take[name] % size[name] if size[name] else 0 for p, name in of.items()}
    ranges: dict[str, list[dict[str, int]]] = {}
    for p, start, cut, longest in cut_points(sized, extra):
        ranges.setdefault(p, []).append({"start": start, "cut": cut, "longest": longest})
    drop(spark, path)

    plans = {p: {"rounds": take[name] // size[name] if size[name] else 0, "ranges": ranges.get(p, []), "source_size": by_source[name[0]], "target": target[name[0]]} for p, name in of.items()}
    table = local_table(
        spark,
        list(plans.items()),
        f"{own}k string, {own}p struct<rounds: long, ranges: array<struct<start: long, cut: long, longest: long>>, source_size: long, target: double>",
    )  # a row for each pattern
    if len(of) * PLAN_BYTES <= BROADCAST_BYTES:
        table = F.broadcast(table)
    mix_, plan_ = (lambda c: F.col(own)[c]), (lambda c: F.col(f"{own}p")[c])
    joined = rows.join(table, mix_("pattern") == F.col(f"{own}k"))
    chosen = F.exists(plan_("ranges"), lambda r: (mix_("hash") >= r["start"]) & (mix_("hash") < r["cut"]) & (mix_("size") <= r["longest"]))
    copies = F.when(mix_("size") > 0, plan_("rounds") + chosen.cast("long")).otherwise(F.lit(0))
    found = F.struct(mix_("size").alias("size"), mix_("pattern").alias("pattern"), copies.alias("copies"), plan_("source_size").alias("source_size"), plan_("target").alias("target"))
    return joined.withColumn(own, found).drop(f"{own}k", f"{own}p")


def repeat(mixed: DataFrame) -> DataFrame:
    """The rows that a mix takes, each as often as it is taken; the added last column goes."""
    own = mixed.columns[-1]
    taken = mixed.where(F.col(own)["copies"] > 0)
    return taken.withColumn(own, F.explode(F.sequence(F.lit(1), F.col(own)["copies"].cast("int")))).drop(own)
