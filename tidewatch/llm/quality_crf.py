"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad.  A line's potentials come from its own
features and those of the lines around it, neighbouring labels are tied by
transition potentials, and forward-backward gives each line's marginal.  The
length-weighted mean of the marginals, calibrated, is the document's score.

The field is fitted on at most ``SAMPLE_DOCS`` labelled documents of at most
``SAMPLE_LINES`` lines together (each line starts with its document's label);
everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import drop, materialise, small_batches, trim, trimmed

#: Labelled documents that the fit takes at most, the ones of smallest hash.
SAMPLE_DOCS = 5000
#: Lines that the fit takes at most; a document that would go beyond is left out.
SAMPLE_LINES = 200_000
#: Characters that are looked at together; bounds a worker's memory.
CHUNK_CHARS = 1 << 18
#: Bin edges of a feature, as quantiles over the sample's lines; the tails are finer.
QUANTILES = (0.002, 0.01, 0.03, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.97, 0.99, 0.998)
BINS = len(QUANTILES) + 1
OFFSETS = (-1, 0, 1)
FEATURES = ("length", "upper", "symbol", "pipe", "digit", "space", "shout", "stop", "word", "repeat", "distinct")
STEPS, RATE, RIDGE = 120, 0.15, 2e-3

_CLASSES = ("upper", "lower", "digit", "space", "pipe", "shout", "stop", "other")


def _class_table() -> np.ndarray:
    kinds = np.full(65536, _CLASSES.index("other"), np.uint8)
    for code in range(65536):
        c = chr(code)
        if c.islower() or (c.isalpha() and not c.isupper()):
            kinds[code] = _CLASSES.index("lower")
        elif c.isupper():
            kinds[code] = _CLASSES.index("upper")
        elif c.isdigit():
            kinds[code] = _CLASSES.index("digit")
        elif c.isspace():
            kinds[code] = _CLASSES.index("space")
    for name, chars in (("pipe", "|\t"), ("shout", "!"), ("stop", ".,;:?")):
        for c in chars:
            kinds[ord(c)] = _CLASSES.index(name)
    return kinds


_TABLE: list[np.ndarray] = []


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all lines of the texts, and the number of lines of each text.

    A text of n line feeds has n + 1 lines, so an empty text has one empty line.
    """
    if not _TABLE:
        _TABLE.append(_class_table())
    lines = [t.split("\n") for t in texts]
    counts = np.array([len(x) for x in lines])
    flat = [x for own in lines for x in own]
    sizes = np.array([len(x) for x in flat])
    codes = np.frombuffer(("\n".join(flat) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _TABLE[0][np.minimum(codes, 65535)]
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    each = {name: np.add.reduceat(kinds == i, starts, dtype=np.int64) for i, name in enumerate(_CLASSES)}
    each["space"] = each["space"] - 1  # the line feed
    n, letters = sizes + 1.0, each["upper"] + each["lower"]
    repeat, distinct = [], []
    for own in lines:
        seen: dict[str, int] = {}
        for x in own:
            seen[x] = seen.get(x, 0) + 1
        for x in own:
            words = x.split()
            repeat.append(seen[x] > 1 and len(words) > 2)
            distinct.append((len(set(words)) + 1.0) / (len(words) + 1.0))
    columns = [
        np.log1p(sizes), each["upper"] / (letters + 1), each["other"] / n, each["pipe"] / n, each["digit"] / n, each["space"] / n,
        each["shout"] / n, each["stop"] / n, letters / (each["space"] + 1.0), np.array(repeat, float), np.array(distinct),
    ]
    return np.stack(columns, 1).astype(np.float64), counts


@dataclass
class LineField:
    """A fitted field: bin edges, emission weights, transitions, calibration."""

    edges: list[np.ndarray] = field(default_factory=lambda: [np.array([]) for _ in FEATURES])
    weights: np.ndarray = field(default_factory=lambda: np.zeros((len(OFFSETS), len(FEATURES), BINS)))
    bias: float = 0.0
    tie: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    scale: tuple[float, float] = (0.0, 0.0)

    def bins(self, features: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, features[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def potentials(self, bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log potential of good against bad for each line."""
        out = np.full(len(bins), self.bias)
        for offset, where, at in _neighbours(counts):
            for j in range(len(FEATURES)):
                out[at] += self.weights[offset, j][bins[where, j]]
        return out

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The length-weighted mean probability of good lines of each text."""
        features, counts = line_features(texts)
        good, _ = forward_backward(self.potentials(self.bins(features), counts), self.tie, counts)
        weight = np.maximum(np.expm1(features[:, 0]), 1.0)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts), counts

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        mean, _ = self.marginals(texts)
        return _sigmoid(self.scale[0] * (2 * mean - 1) + self.scale[1])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _neighbours(counts: np.ndarray):
    """For each offset: its index, the neighbouring lines, and the lines that have one within their text."""
    total = int(counts.sum())
    doc = np.repeat(np.arange(len(counts)), counts)
    lines = np.arange(total)
    for k, offset in enumerate(OFFSETS):
        where = lines + offset
        inside = (where >= 0) & (where < total)
        inside[inside] = doc[where[inside]] == doc[lines[inside]]
        yield k, where[inside], lines[inside]


def forward_backward(unary: np.ndarray, tie: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of good for each line, and the pair marginals summed over all neighbours.

    Texts are taken together line by line, longest first, so a step costs as
    much as there are texts that long.
    """
    order = np.argsort(-counts, kind="stable")
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])[order]
    length = counts[order]
    local = np.zeros((len(unary), 2))
    local[:, 1] = unary
    alpha = np.zeros_like(local)
    beta = np.zeros_like(local)
    longest = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(longest), side="left")  # texts longer than t
    for t in range(longest):
        at = first[: alive[t]] + t
        if t == 0:
            alpha[at] = local[at]
        else:
            before = alpha[at - 1]
            alpha[at] = local[at] + np.logaddexp(before[:, :1] + tie[0], before[:, 1:] + tie[1])
        alpha[at] -= alpha[at].max(1, keepdims=True)
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = first[: alive[t + 1]] + t
        after = beta[at + 1] + local[at + 1]
        beta[at] = np.logaddexp(tie[:, 0] + after[:, :1], tie[:, 1] + after[:, 1:])
        beta[at] -= beta[at].max(1, keepdims=True)
        joint = alpha[at][:, :, None] + tie + after[:, None, :]
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    both = alpha + beta
    return _sigmoid(both[:, 1] - both[:, 0]), pairs


def fit(features: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> LineField:
    """Fit by gradient ascent on the likelihood of the lines' labels.

    Classes are balanced by weight.  Without rows of both classes the field
    stays empty and scores 0.5.
    """
    model = LineField()
    if len(counts) == 0 or len(set(labels.tolist())) < 2:
        return model
    model.edges = [np.unique(np.quantile(features[:, j], QUANTILES)) for j in range(len(FEATURES))]
    bins = model.bins(features)
    gold = np.repeat(labels, counts).astype(float)
    # Each document weighs the same, whatever its number of lines.
    weight = np.repeat(1 / np.maximum(counts, 1), counts)
    pair_gold = np.zeros((2, 2))
    doc = np.repeat(np.arange(len(counts)), counts)
    same = doc[1:] == doc[:-1]
    for label in (0, 1):
        pair_gold[label, label] = (same & (gold[1:] == label)).sum()
    spots = list(_neighbours(counts))
    moment = [np.zeros_like(model.weights), np.zeros_like(model.weights)]
    side = [np.zeros(5), np.zeros(5)]
    for step in range(1, STEPS + 1):
        good, pairs = forward_backward(model.potentials(bins, counts), model.tie, counts)
        error = (gold - good) * weight
        slope = -RIDGE * model.weights
        for k, where, at in spots:
            for j in range(len(FEATURES)):
                slope[k, j] += np.bincount(bins[where, j], error[at], BINS) / len(counts)
        rest = np.concatenate([[error.sum() / len(counts)], ((pair_gold - pairs) / max(same.sum(), 1) - 0.02 * model.tie).ravel()])
        for own, change, rate in ((moment, slope, RATE), (side, rest, RATE)):
            own[0] = 0.9 * own[0] + 0.1 * change
            own[1] = 0.99 * own[1] + 0.01 * change**2
            move = rate * (own[0] / (1 - 0.9**step)) / (np.sqrt(own[1] / (1 - 0.99**step)) + 1e-6)
            if own is moment:
                model.weights = model.weights + move
            else:
                model.bias += move[0]
                model.tie = model.tie + move[1:].reshape(2, 2)
    _calibrate(model, bins, counts, features, labels)
    return model


def _calibrate(model: LineField, bins, counts, features, labels) -> None:
    """Logistic regression of the label on the mean marginal, each class weighing the same."""
    good, _ = forward_backward(model.potentials(bins, counts), model.tie, counts)
    weight = np.maximum(np.expm1(features[:, 0]), 1.0)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    x = 2 * np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts) - 1
    own = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    a, b = 2.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * x + b)
        g = np.array([((labels - p) * own * x).sum() - 1e-3 * a, ((labels - p) * own).sum()])
        h = own * p * (1 - p)
        hessian = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-9]])
        a, b = np.array([a, b]) + np.linalg.solve(hessian, g)
    model.scale = (float(a), float(b))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> LineField:
    """Fit on the labelled documents whose crc32(doc_id as text) mod 3 is not 1.

    At most ``sample_docs`` of them are taken: those of smallest hash of the id.
    A repeated id counts once, with its smallest label and the text of smallest
    hash.  In the same order, documents are left out that would bring the
    sample beyond ``sample_lines`` lines.  Line features are computed on the
    executors; only they reach the driver.
    """
    spark = docs.sparkSession
    small_batches(spark)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    sample, path = materialise(one.select("doc_id", "quality", F.col("least.text").alias("text")), "labelled")
    lines = (F.length("text") - F.length(F.translate("text", "\n", "")) + 1).alias("lines")
    sizes = sample.select("doc_id", lines, F.xxhash64("doc_id").alias("hash")).collect()
    kept, room = [], sample_lines
    for row in sorted(sizes, key=lambda r: (r["hash"], r["doc_id"])):
        if row["lines"] <= room:
            kept.append(row["doc_id"])
            room -= row["lines"]
    if len(kept) < len(sizes):
        few = spark.createDataFrame([(k,) for k in kept], sample.select("doc_id").schema)
        sample = sample.join(F.broadcast(few), "doc_id", "left_semi")

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _chunks(batch):
                features, counts = line_features(part["text"].tolist())
                split = np.split(features.astype(np.float32), np.cumsum(counts)[:-1])
                yield pd.DataFrame({"doc_id": part["doc_id"].values, "quality": part["quality"].values, "features": [x.tobytes() for x in split]})

    found = sample.select("doc_id", "quality", "text").mapInPandas(trimmed(featured), "doc_id long, quality int, features binary").collect()
    drop(spark, path)
    found = sorted(found, key=lambda r: r["doc_id"])
    parts = [np.frombuffer(r["features"], np.float32).reshape(-1, len(FEATURES)) for r in found]
    features = np.concatenate(parts).astype(float) if parts else np.zeros((0, len(FEATURES)))
    return fit(features, np.array([len(p) for p in parts], int), np.array([r["quality"] for r in found], int))


def _chunks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows in their order, ``CHUNK_CHARS`` characters at a time or one longer text."""
    ends = (batch["text"].str.len().cumsum() // CHUNK_CHARS).values
    for _, part in batch.groupby(ends, sort=False):
        yield part


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scorer(model: LineField):
    """A vectorised function of a text column (null: empty) that gives the quality score."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            frame = pd.DataFrame({"text": batch.fillna("").values})
            parts = [model.scores(part["text"].tolist()) for part in _chunks(frame)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))
        trim()

    return score


def score_documents(docs: DataFrame, model: LineField) -> DataFrame:
    """Quality of every whole text.

    Returns one row per input row: ``doc_id``, ``held_out``, ``score`` (0 to 1)
    and ``predicted`` (1 if score >= 0.5).  A null or empty text is one empty
    line; a null id is not held out; other columns are not read.
    """
    score = scorer(model)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
