"""Text cleaning rules: remove, delete, keep, filter arrays, aliases, identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import full_match

# What stands for a missing value, in upper case.
MISSING_ANYWHERE = [
    r"\bUNKNOWN\b", r"\bUNKOWN\b", r"\bUKNOWN\b", r"\bNULL\b", r"\bNONE\b", r"\bNIL\b", r"\bN\.A\.?\b", r"\bNOT\s+AVAILABLE\b",
    r"\bNOT\s+SPECIFIED\b", r"\bNOT\s+PROVIDED\b", r"\bNOT\s+APPLICABLE\b", r"\bUNAVAILABLE\b", r"\bUNSPECIFIED\b", r"\bMISSING\b",
    r"\bINVALID\b", r"\bNOT\s*VALID\b", r"\bNO\s+INFORMATION\b",
]
MISSING_EXACT = [
    "N/A", "NA", "NI", "UNK", "UKN", r"NO[\s_]?DATA", "EMPTY", r"UNK\s+MANUFACTURER", "NASK", "ASKU", "TRC", "QS", "MSK", "NAV",
    "INV", "OTH", "PINF", "NINF", "UNC", "DER",
]
MISSING = [f".*{p}.*" for p in MISSING_ANYWHERE] + MISSING_EXACT
COUNTRIES = ["USA", "US", "UNITED STATES", "GERMANY", "FRANCE", "JAPAN", "CHINA", "KOREA", "IRELAND", "SWITZERLAND", "MEXICO", "CANADA", "ITALY", "SPAIN", "UK", "UNITED KINGDOM"]


def remove(text: Column, patterns: Sequence[str]) -> Column:
    return F.regexp_replace(text, "|".join(patterns), "")


def delete(text: Column, patterns: Sequence[str]) -> Column:
    """Null where the whole value matches."""
    return F.when(~full_match(text, patterns), text)


def keep(text: Column, patterns: Sequence[str]) -> Column:
    """Null where the whole value does not match."""
    return F.when(full_match(text, patterns), text)


def filter_array(values: Column, patterns: Sequence[str]) -> Column:
    """Elements that match none of the patterns; null elements go."""
    return F.filter(values, lambda x: ~full_match(x, patterns))


def tidy(text: Column) -> Column:
    """White space folded and control characters gone; blank is null."""
    folded = F.trim(F.regexp_replace(F.regexp_replace(text, r"[\p{Cc}&&[^\s]]", ""), r"\s+", " "))
    return F.when(folded != "", folded)


# Plain forms of letters and marks that do not decompose.
PLAIN = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "Th", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "…": "...", "•": "*", "€": "EUR"}


def plain_text(text: Column) -> Column:
    """ASCII form of a text: compatibility decomposition without marks, plain forms of the rest where there is one; then :func:`tidy`.

    Characters without a plain form go.
    """
    out = text
    for letter, plain in PLAIN.items():
        out = F.replace(out, F.lit(letter), F.lit(plain))
    out = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), out, F.lit(True))
    return tidy(F.when(text.isNotNull(), F.regexp_replace(out, r"[^\x00-\x7F]", "")))


def remove_country(text: Column, countries: Sequence[str] = COUNTRIES) -> Column:
    """The first country name that is found goes, whatever its case; blank is null."""
    names = "|".join(sorted(countries, key=lambda c: (-len(c), c)))
    found = F.regexp_extract(text, rf"(?is)^(.*?)\b(?:{names})\b", 1)
    rest = F.regexp_extract(text, rf"(?is)^.*?\b(?:{names})\b(.*)$", 1)
    out = F.trim(F.when(text.rlike(rf"(?i)\b(?:{names})\b"), F.concat(found, rest)).otherwise(text))
    return F.when(out != "", out)


def clean_columns(df: DataFrame, rules: dict[str, list[tuple]], countries: Sequence[str] = COUNTRIES) -> DataFrame:
    """Apply each column's rules step by step: the i-th rule of every column together; columns that are absent are passed over."""
    apply = {"remove": remove, "delete": delete, "keep": keep, "filter_array": filter_array, "remove_country": lambda c, _: remove_country(c, countries), "tidy": lambda c, _: tidy(c)}
    rules = {name: own for name, own in rules.items() if name in df.columns}
    for step in range(max((len(r) for r in rules.values()), default=0)):
        df = df.withColumns({name: apply[own[step][0]](F.col(name), own[step][1] if len(own[step]) > 1 else []) for name, own in rules.items() if step < len(own)})
    return df


def parent_company(name: Column, aliases: dict[str, str]) -> Column:
    """The parent of the longest alias that the name starts with; else the name."""
    upper = F.upper(F.trim(name))
    out = None
    for alias in sorted(aliases, key=lambda a: (-len(a), a)):
        hit = upper.startswith(alias.upper())
        out = F.when(hit, aliases[alias]) if out is None else out.when(hit, aliases[alias])
    return name if out is None else out.otherwise(name)


def identifier_of(public: Column, target: Column) -> Column:
    """The target, or the device identifier read from a public one: ``+`` codes, ``(01)`` numbers, letters."""
    hibc = F.regexp_extract(public, r"^\+([A-Z0-9]+)", 1)
    gtin = F.regexp_extract(public, r"\(01\)(\d{14})", 1)
    found = F.when(public.rlike(r"^\+[A-Z0-9]+"), hibc).when(public.rlike(r"\(01\)\d{14}"), gtin).when(public.rlike(r"^[A-Za-z]+$"), public)
    return F.coalesce(target, found)
