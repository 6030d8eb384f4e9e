"""Semi-structured records: key discovery, projection of paths, arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, _parse_datatype_string

from tidewatch.functions.columns import sanitise


def discovered(df: DataFrame, json: str) -> DataType:
    """The type that fits the JSON texts of a column, from all of its rows: keys, nested keys, elements of lists."""
    found = df.where(F.col(json).isNotNull()).agg(F.schema_of_variant_agg(F.try_parse_json(json)).alias("kind")).first()["kind"]
    return _parse_datatype_string((found or "VOID").replace("OBJECT<", "STRUCT<"))


def breadth_first(kind: DataType, default: str = "string") -> list[tuple[str, str]]:
    """Dotted paths below a struct or a list's elements, level by level, the names of a level in order; keys without a type get the default."""
    level = [("", kind.elementType if isinstance(kind, ArrayType) else kind)]
    out: list[tuple[str, str]] = []
    while level:
        following = []
        for prefix, t in level:
            for f in sorted(t, key=lambda f: f.name) if isinstance(t, StructType) else []:
                if isinstance(f.dataType, StructType):
                    following.append((f"{prefix}{f.name}.", f.dataType))
                elif not isinstance(f.dataType, ArrayType):
                    kind_ = f.dataType.simpleString()
                    out.append((prefix + f.name, default if kind_ == "void" else kind_))
        level = following
    return out


def top_keys(schema: StructType) -> list[tuple[str, str]]:
    """Top-level keys and their kinds: ARRAY, OBJECT, or a scalar type's name."""
    kind = lambda t: "ARRAY" if isinstance(t, ArrayType) else "OBJECT" if isinstance(t, StructType) else t.simpleString().upper()
    return sorted((f.name, kind(f.dataType)) for f in schema)


def paths(kind: DataType, prefix: str = "") -> list[tuple[str, str]]:
    """Dotted paths and types below a struct or an array's elements; arrays within elements are left out."""
    if isinstance(kind, ArrayType):
        kind = kind.elementType
    if not isinstance(kind, StructType):
        return [(prefix.rstrip("."), kind.simpleString())] if prefix else []
    out = []
    for f in kind:
        if isinstance(f.dataType, StructType):
            out += paths(f.dataType, f"{prefix}{f.name}.")
        elif not isinstance(f.dataType, ArrayType):
            out.append((prefix + f.name, f.dataType.simpleString()))
    return sorted(out)


def flatten(df: DataFrame, raw: str, scalars: Sequence[str] = (), first: dict[str, Sequence[str]] | None = None, transform: dict[str, Sequence[str]] | None = None, split: dict[str, Sequence[str]] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Columns from a nested record.

    ``scalars`` are taken as they are; of the arrays in ``first`` the first
    element's paths; of those in ``transform`` each path as an array of strings;
    those in ``split`` give a row per element (an empty or null array gives one
    row of nulls), and several of them multiply.
    """
    for name in split or {}:
        df = df.withColumn(f"_{name}", F.explode_outer(F.col(f"{raw}.{name}")))
    kinds = df.schema[raw].dataType

    def one(value: Column, path: str, holder: DataType) -> Column:
        """The value at a path of an element; a list within the element as a list of strings."""
        kind: DataType = holder.elementType if isinstance(holder, ArrayType) else holder
        for part in path.split("."):
            kind = kind[part].dataType
        value = _at(value, path)
        return F.transform(value, lambda x: x.cast("string")) if isinstance(kind, ArrayType) else value

    out = [F.col(c) for c in keep] + [F.col(f"{raw}.{c}").alias(sanitise(c)) for c in scalars]
    for name, own in (first or {}).items():
        out += [one(F.get(F.col(f"{raw}.{name}"), F.lit(0)), p, kinds[name].dataType).alias(sanitise(f"{name}.{p}")) for p in own]
    for name, own in (transform or {}).items():
        out += [F.transform(F.col(f"{raw}.{name}"), _text_at(p)).alias(sanitise(f"{name}.{p}")) for p in own]
    for name, own in (split or {}).items():
        out += [one(F.col(f"_{name}"), p, kinds[name].dataType).alias(sanitise(f"{name}.{p}")) for p in own]
    return df.select(*out)


def _text_at(path: str):
    return lambda x: _at(x, path).cast("string")


def _at(value: Column, path: str) -> Column:
    for part in path.split("."):
        value = value[part]
    return value


def combine_texts(codes: Column, texts: Column) -> Column:
    """``[code]`` and its text on the next line, blocks parted by a blank line; empty for no texts."""
    pairs = F.arrays_zip(codes.alias("code"), texts.alias("text"))
    return F.array_join(F.transform(pairs, lambda p: F.concat(F.lit("["), F.coalesce(p["code"], F.lit("")), F.lit("]\n"), F.coalesce(p["text"], F.lit("")))), "\n\n")


def primary_of(df: DataFrame, record: str, kind: str, value: str, primary: str = "Primary", out: str = "primary_id") -> DataFrame:
    """Give every row of a record the value of its primary row."""
    from pyspark.sql import Window

    return df.withColumn(out, F.max(F.when(F.col(kind) == primary, F.col(value))).over(Window.partitionBy(record)))
