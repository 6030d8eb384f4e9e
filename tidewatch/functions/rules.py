"""The cleaning rules of every column of the two kinds of records."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidewatch.functions.clean import COUNTRIES, MISSING

# What the columns' rules remove, delete and keep.
QUOTES = [r'"{3,}', r'^"+|"+$']
QUOTES_APART = [r'"{3,}', r'^"+', r'"+$']
IDENTIFIER = [
    ("remove", [r"^\(\d{2}\)", r"\(\d{2}\).*", r"^\d*\+", r"[^a-zA-Z0-9]"]),
    ("delete", MISSING),
    ("delete", [r"^$", r"^0+$", r"^N$", r"^X+$", r"^.{2,3}$", r"^.{31,}$"]),
]
BRAND = [
    ("remove", [r'"{3,}', r"^\d{2}/\d{2}/\d{4}", r"Â+[¿¢]*", r'^"+|"+$', r"^[#*.\-]+\s*"]),
    ("delete", MISSING),
    ("delete", [r"^$", r"^0$", r"^\*$", r"^\.$", r"^-$", r"^[0-9]+$"]),
]
CATALOG_PREFIXES = [r"^(REF|LOT)\s*[#:\-]?\s*", r"^\(\d+\)", r"^0\s", r"^\*"]
CATALOG_DELETE = ("delete", [r"^$", r"^-$", r"^\*$", r"^\.$", r"^#$", r"^0{10,}.*"])
LOT = [
    ("remove", [*QUOTES_APART, r",.*$", r"^\(\d+\)\s*:?\s*", r"^(LOT|BATCH|REF|REV)\s*[#:\-]?\s*", r"\s+(EXPIRY|EXP\.?DATE|EXP)[\s:\-].*$", r"^[#$*]+\s*"]),
    ("delete", MISSING),
    ("delete", [r"^$", r"^-$", r"^\.$", r"^\*$", r"^#$", r"^/NA$", r"^0+$", r".*\bPROTOTYPE\b.*", r".*\bBATCH\s+CODE\b.*"]),
]
SUFFIXES = [
    r"\b(INC\.?|INCORPORATED)\b", r"\b(CO\.?|COMPANY)\b", r"\b(CORP\.?|CORPORATION)\b", r"\b(LTD\.?|LIMITED)\b", r"\b(LLC\.?|L\.L\.C\.?)\b", r"\b(PLC\.?)\b",
    r"\b(S\.A\.?)\b", r"\b(GMBH\.?)\b", r"\b(AG\.?)\b", r"\b(PTY\.?)\b", r"\b(PVT\.?)\b", r"\b(OPERATIONS)\b", r"\bMANUFACTURING\b", r"\bMEDICAL\s+SYSTEMS\b",
    r"\bMEDICAL\b", r"^THE\b\s*", r"[^a-zA-Z0-9\s&]",
]
MAKER = [
    ("remove", [r"AMP;", r";.*$", r"\s*/\s*.*$"]),
    ("remove_country",),
    ("delete", MISSING),
    ("remove", [*QUOTES, r"\s+D/B/A\s+.*$", r"\s+DBA\s+.*$", r"^[?\.\(]+\s*", r"\\+$", r"/+$", r"[\s\.]+$"]),
    ("remove", SUFFIXES),
    ("tidy",),
    ("delete", [
        r"^$", r"^\.$", r"^-$", r"^\?$", r".*\bMANUFACTURER\s+(UNKNOWN|UNK)\b.*", r"^[0-9]+\s+[A-Za-z\s]+(WAY|DR|STREET|AVE|PARKWAY)$", r"^\(.*\)$",
        r"^\d+\.\s+MANUFACTURER", r"^ESTABLISHMENT\s+NAME", r"^EMAIL\s+ADDRESS", r"^MFG\s+SITE\s+NAME",
    ]),
]
MODEL = [
    ("remove", [*QUOTES, r"\(.*?TRIED.*?\)", r"\(.*?MAGNIFY.*?\)", r"\(.*?UNABLE.*?\)", r"\(GTIN\)\s*", r"\(\d+\)[^\(]*", r"^[*]+\s*", r"^\.+", r"\\+$"]),
    ("delete", MISSING),
    ("delete", [r"^$", r"^-$", r"^\.$", r"^\*$", r"^N\s*/\s*A$", r"^[A-Z]$", r"^0{10,}.*"]),
]
EVENT_RULES: dict[str, list[tuple]] = {
    "mdr_text": [("remove", [r"[0-9]+"]), ("tidy",)],
    "udi_di": IDENTIFIER,
    "event_type": [("delete", ["No answer provided"])],
    "previous_use_flag": [("delete", ["[^IR]"])],
    "reprocessed_and_reused_flag": [("delete", ["[^YN]"])],
    "single_use_flag": [("delete", ["[^YN]"])],
    "product_problems": [("filter_array", ["Appropriate Term/Code Not Available", "Adverse Event Without Identified Device or Use Problem", "Unclear Information", "Unable to Obtain Readings"])],
    "brand_name": BRAND,
    "catalog_number": [("remove", [*QUOTES_APART, *CATALOG_PREFIXES]), ("delete", MISSING), CATALOG_DELETE],
    "lot_number": LOT,
    "manufacturer_name": MAKER,
    "model_number": MODEL,
    "udi_public": [("keep", [r"^\+[A-Za-z0-9]{7,}.*", r"^\(01\)[0-9]{14,}.*", r"^[a-zA-Z].*"]), ("delete", [r"^\(01\)0{14,}.*"])],
}
UDI_RULES: dict[str, list[tuple]] = {
    "udi_di": IDENTIFIER,
    "brand_name": BRAND,
    "catalog_number": [("remove", [*QUOTES, *CATALOG_PREFIXES]), ("delete", MISSING), CATALOG_DELETE],
    "manufacturer_name": MAKER,
    "model_number": MODEL,
}


def country_names(spark: SparkSession) -> list[str]:
    """Upper-case English names of all countries that Java's locales know, and the common short names."""
    locale = spark._jvm.java.util.Locale
    english = locale.forLanguageTag("en")
    names = {locale.forLanguageTag(f"und-{code}").getDisplayCountry(english).upper() for code in locale.getISOCountries()}
    return sorted(names | set(COUNTRIES))
