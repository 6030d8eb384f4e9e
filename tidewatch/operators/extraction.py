"""Structured extraction from report texts: candidates, a pluggable extractor, validation, rows."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.records import not_in, upsert

# The labels that an extraction may give.
HARMS = ("Death", "Serious Injury", "Minor Injury", "No Harm", "Unknown")
SCHEMA = "patient_harm string, problem_components array<string>, defect_confirmed boolean, defect_type string"


def rule_extractor(text: str) -> dict:
    """A deterministic stand-in for a language model: the harm that the words name."""
    lower = text.lower()
    harm = next((h for word, h in (("death", "Death"), ("died", "Death"), ("surgery", "Serious Injury"), ("injur", "Minor Injury")) if word in lower), "No Harm")
    words = sorted({w for w in lower.split() if len(w) > 9})[:5]
    return {"patient_harm": harm, "problem_components": words, "defect_confirmed": "defect" in lower, "defect_type": "Other"}


def candidates(reports: DataFrame, done: DataFrame, text: str, batch: Column | None = None) -> DataFrame:
    """Texts of a batch that are not extracted yet, each once; null texts drop out."""
    rows = reports.where(batch) if batch is not None else reports
    return not_in(rows.select(text).where(F.col(text).isNotNull()).distinct(), text, done, text)


def extract(texts: DataFrame, text: str, extractor: Callable[[str], dict] = rule_extractor) -> DataFrame:
    """The extractor's answer for each text as JSON, and whether there was one; errors are not raised."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = []
            for value in batch[text]:
                try:
                    answers.append(json.dumps(extractor(value)))
                except Exception:  # an extractor may fail on a text; the row says so
                    answers.append(None)
            yield pd.DataFrame({text: batch[text], "answer": answers, "success": [a is not None for a in answers]})

    return texts.select(text).mapInPandas(run, f"{text} string, answer string, success boolean")


def validated(answers: DataFrame) -> DataFrame:
    """Parsed answers that keep the schema: known harm, at most five components, a flag."""
    parsed = answers.where("success").withColumn("parsed", F.from_json("answer", SCHEMA)).select("*", "parsed.*").drop("parsed")
    return parsed.where(F.col("patient_harm").isin(*HARMS) & F.col("defect_confirmed").isNotNull() & (F.coalesce(F.size("problem_components"), F.lit(0)) <= 5))


def as_rows(parsed: DataFrame, text: str) -> DataFrame:
    return parsed.select(text, "patient_harm", F.to_json("problem_components").alias("problem_components"), "defect_confirmed", "defect_type")


def to_retry(texts: DataFrame, extracted: DataFrame, text: str) -> DataFrame:
    """Texts without an extraction, or one of an unknown or other defect."""
    both = texts.select(text).distinct().join(extracted.select(text, "defect_type"), text, "left")
    return both.where(F.col("defect_type").isNull() | F.col("defect_type").isin("Unknown", "Other")).select(text).distinct()


def normalised(records: list) -> list[dict]:
    """Extraction inputs from plain texts or from dictionaries: each with its text and its problems as one string."""
    out = []
    for r in records:
        if isinstance(r, dict):
            problems = r.get("product_problems") or ""
            out.append({"text": r.get("mdr_text") or "", "problems": ", ".join(problems) if isinstance(problems, (list, tuple)) else str(problems)})
        else:
            out.append({"text": "" if r is None else str(r), "problems": ""})
    return out


def open_records(reports: DataFrame, done: DataFrame, text: str, others: tuple[str, ...] = (), batch: Column | None = None) -> DataFrame:
    """Distinct records of a batch whose text is not extracted yet, nulls of the further columns as empty texts."""
    rows = reports.where(batch) if batch is not None else reports
    rows = rows.where(F.col(text).isNotNull()).select(text, *others).na.fill("", list(others)).distinct()
    return not_in(rows, text, done, text)


def retry(texts: DataFrame, extracted: DataFrame, text: str, extractor: Callable[[str], dict] = rule_extractor) -> DataFrame:
    """The extractions after a second try of the texts that :func:`to_retry` names: valid answers replace the old rows."""
    again = as_rows(validated(extract(to_retry(texts, extracted, text), text, extractor)), text)
    return upsert(extracted, again.select(*extracted.columns), [text])


def with_extraction(reports: DataFrame, extracted: DataFrame, text: str) -> DataFrame:
    """Reports with what was extracted from their text, by the full text; null without an extraction."""
    return reports.join(extracted.dropDuplicates([text]), text, "left")


def with_clusters(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Rows with the cluster of their key; keys keep their type, and null keys meet nothing."""
    return rows.join(labels.select(key, "cluster"), key, "left")


def embed(df: DataFrame, text: str, embedder: Callable[[list[str]], list[list[float]]], out: str = "embedding") -> DataFrame:
    """Vectors of texts by any function from a batch of texts to vectors; null texts are embedded as empty ones."""

    @F.pandas_udf("array<float>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(embedder(texts.fillna("").tolist()))

    return df.withColumn(out, run(F.col(text)))


def hashed_words(texts: list[str], dim: int = 16) -> list[list[float]]:
    """A deterministic embedder: counts of words by a checksum of theirs."""
    out = []
    for t in texts:
        v = [0.0] * dim
        for w in t.lower().split():
            v[zlib.crc32(w.encode()) % dim] += 1.0
        out.append(v)
    return out
