"""License scans by diagonal voting.

All rolling word k-gram hashes of the documents are joined, in Spark, to the
positions of the same grams in a small set of templates.  A hit votes for its
diagonal (place in the document less place in the template); votes are
aggregated by diagonal, neighbouring diagonals are merged into spans, and each
span is verified word by word against its template.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialise, small_batches

GRAM = 3
#: Diagonals of one template this close, with touching spans, are merged.
DRIFT = 6
#: Share of a notice's words that a span must hold in order to count.
MIN_COVER = 0.6
#: Keys of documents with hits are broadcast up to this many bytes, and shuffled beyond.
BROADCAST_BYTES = 32 << 20
CHUNK_CHARS = 1 << 20
#: Distinct words whose hashes a worker remembers.
CACHE_WORDS = 500_000

# The phrases whose places are counted, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# The opening words of public license notices, and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "all rights reserved no part of this publication may be reproduced": "all-rights-reserved",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "the person who associated a work with this deed has dedicated the work to the public domain": "cc0",
    "this program and the accompanying materials are made available under the terms of the eclipse public license": "epl",
}
# Short wordings that name a license, and their labels; they count only where all their words stand.
# A version or "license" follows where the name alone is also the start of another license's.
NAMES = {
    "the mit license": "mit",
    "under mit license": "mit",
    "apache license 2 0": "apache-2",
    "apache license v2": "apache-2",
    "apache 2 0 license": "apache-2",
    "apache software license version 2": "apache-2",
    "creative commons attribution noncommercial 4 0": "cc-by-nc",
    "creative commons attribution noncommercial 3 0": "cc-by-nc",
    "creative commons attribution noncommercial license": "cc-by-nc",
    "creative commons attribution non commercial 4 0": "cc-by-nc",
    "creative commons attribution non commercial 3 0": "cc-by-nc",
    "creative commons attribution non commercial license": "cc-by-nc",
    "creative commons attribution 4 0": "cc-by",
    "creative commons attribution 3 0": "cc-by",
    "creative commons attribution license": "cc-by",
    "cc by 4 0": "cc-by",
    "cc by 3 0": "cc-by",
    "the bsd license": "bsd",
    "under bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "2 clause bsd": "bsd",
    "3 clause bsd": "bsd",
    "gnu general public license": "gpl",
    "the gnu gpl": "gpl",
    "mozilla public license 2 0": "mpl-2",
    "mozilla public license v 2 0": "mpl-2",
    "mozilla public license version 2 0": "mpl-2",
    "all rights reserved": "all-rights-reserved",
    "the isc license": "isc",
    "under isc license": "isc",
    "under the unlicense": "unlicense",
    "cc0 1 0 universal": "cc0",
    "eclipse public license": "epl",
    "boost software license": "boost",
}

_KEEP = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Runs of digits, a-z and characters beyond ASCII, after A-Z is lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def gram_hashes(tokens: list[bytes], cache: dict, k: int = GRAM) -> np.ndarray:
    """The hash of every run of k words, as signed 64-bit integers."""
    if len(tokens) < k:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(cache.__getitem__, tokens), np.uint64, len(tokens))
    n = len(h) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _key(id_col: str, text_col: str) -> list[Column]:
    """128 bits that name a row by its content: repeated rows share them."""
    return [F.xxhash64(F.lit(1), id_col, text_col).alias("_k1"), F.xxhash64(F.lit(2), id_col, text_col).alias("_k2")]


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``CHUNK_CHARS`` bytes of text, or one longer row."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.nan_to_num(np.array(pa.compute.binary_length(column).to_numpy(zero_copy_only=False), float))
    ends = (np.cumsum(sizes) // CHUNK_CHARS).astype(int)
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(ends)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _Hashes()
    for batch in batches:
        for part in _slices(batch, "_text"):
            each = [gram_hashes(words(t), cache) for t in part.column(2).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32)
            values = np.concatenate(each) if each else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(offsets, values)], names=["_k1", "_k2", "grams"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch, "_text"):
            counts = pa.array([len(words(t)) for t in part.column(3).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns[:3], counts], names=["doc_id", "_k1", "_k2", "n_words"])


def _verify_batches(templates: list[tuple[list[bytes], str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "_text"):
                rows = []
                for text, votes in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    rows.append(verify(words(text), votes, templates))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
                names = ["n_base", "first_word", "last_word", "base_labels", "labels", "score"]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["_k1", "_k2", *names])

    return run


def merge_diagonals(votes: list[dict]) -> list[tuple[int, int]]:
    """Spans of neighbouring diagonals of one template: the first and last place of their grams."""
    spans: list[list[int]] = []
    for v in sorted(votes, key=lambda v: (v["lo"], v["diagonal"])):
        last = spans[-1] if spans else None
        if last and abs(v["diagonal"] - last[2]) <= DRIFT and v["lo"] <= last[1] + DRIFT:
            last[1], last[2] = max(last[1], v["hi"]), v["diagonal"]
        else:
            spans.append([v["lo"], v["hi"], v["diagonal"]])
    return [(a, b) for a, b, _ in spans]


def verify(tokens: list[bytes], votes: list[dict], templates: list[tuple[list[bytes], str, str]]) -> tuple:
    """Places and labels that the words bear out.

    A phrase counts at each place where all its words stand; a name counts
    once all its words stand somewhere, and gives its label only; a notice
    counts where a merged span holds at least ``MIN_COVER`` of its words in order.
    """
    starts, base, all_labels, score = [], set(), set(), 0.0
    for number in sorted({v["template"] for v in votes}):
        wanted, label, kind = templates[number]
        own = [v for v in votes if v["template"] == number]
        if kind != "notice":
            places = [v["diagonal"] for v in own if v["diagonal"] >= 0 and tokens[v["diagonal"] : v["diagonal"] + len(wanted)] == wanted]
            if places:
                score = 1.0
                if kind == "phrase":
                    starts += places
                    base.add(label)
                else:
                    all_labels.add(label)
            continue
        for lo, hi in merge_diagonals(own):
            around = tokens[max(0, lo - len(wanted)) : hi + GRAM + len(wanted)]
            blocks = SequenceMatcher(None, wanted, around, autojunk=False).get_matching_blocks()
            cover = sum(b.size for b in blocks) / len(wanted)
            if cover >= MIN_COVER:
                all_labels.add(label)
                score = max(score, cover)
    join = lambda x: ",".join(sorted(x))
    return len(starts), min(starts, default=None), max(starts, default=None), join(base), join(base | all_labels), min(score, 1.0)


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Phrases, notices and names of licenses in every whole text.

    Returns one row per input row: ``doc_id``, ``n_words``, ``n_base`` (places
    of phrases), ``first_word`` and ``last_word`` (smallest and largest start,
    from 0, else null), ``base_labels`` and ``labels`` (distinct, sorted,
    comma-joined; the latter with those of notices and names), and ``score`` (1
    for a phrase or a name, else the best share of a notice's words, else 0).
    A null text is empty; null ids and repeated rows stay; other columns are
    not read.  A phrase needs at least ``GRAM`` words.
    """
    spark = docs.sparkSession
    small_batches(spark)
    wanted = [(words(p), label, "phrase") for p, label in (PHRASES if phrases is None else phrases).items()]
    wanted += [(words(p), label, "notice") for p, label in (NOTICES if notices is None else notices).items()]
    wanted += [(words(p), label, "name") for p, label in (NAMES if names is None else names).items()]
    if any(len(w) < GRAM for w, _, _ in wanted):
        raise ValueError(f"a phrase needs at least {GRAM} words")
    cache = _Hashes()
    places = [(int(h), t, i) for t, (w, _, _) in enumerate(wanted) for i, h in enumerate(gram_hashes(w, cache))]
    grams = spark.createDataFrame(places, "gram long, template int, place int")  # a few hundred rows

    keyed = docs.select(F.col(id_col).alias("doc_id"), *_key(id_col, text_col), F.col(text_col).alias("_text"))
    hashed = keyed.select("_k1", "_k2", "_text").mapInArrow(_hash_batches, "_k1 long, _k2 long, grams array<long>")
    hits = (
        hashed.select("_k1", "_k2", F.posexplode("grams").alias("at", "gram"))
        .join(F.broadcast(grams), "gram")
        .select("_k1", "_k2", "template", (F.col("at") - F.col("place")).alias("diagonal"), "at")
        .distinct()
    )
    votes = hits.groupBy("_k1", "_k2", "template", "diagonal").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.count(F.lit(1)).alias("n"))
    # All diagonals of one text; no more than the text has words for each template.
    by_doc = votes.groupBy("_k1", "_k2").agg(F.collect_list(F.struct("template", "diagonal", "lo", "hi", "n")).alias("votes"))
    by_doc, _ = materialise(by_doc, "licenses")
    keys = by_doc.select("_k1", "_k2")
    if keys.count() * 24 <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    found = keyed.select("_k1", "_k2", "_text").join(keys, ["_k1", "_k2"], "left_semi")
    found = found.dropDuplicates(["_k1", "_k2"]).join(by_doc, ["_k1", "_k2"])
    schema = "_k1 long, _k2 long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    verified = found.select("_k1", "_k2", "_text", "votes").mapInArrow(_verify_batches(wanted), schema)
    counted = keyed.mapInArrow(_count_batches, "doc_id long, _k1 long, _k2 long, n_words long")
    return counted.join(verified, ["_k1", "_k2"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
