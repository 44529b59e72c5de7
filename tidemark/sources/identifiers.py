"""Identifying fields anywhere in nested documents, schemas and table headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col
from tidemark.functions.predicates import IDENTIFYING_FIELDS, identifying_field
from tidemark.session import cut_lineage


def _is_container(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def identifying_keys(docs: DataFrame, keys: Sequence[str], body: str) -> DataFrame:
    """(keys, path, field): every key that spells an identifying field, at any depth of the JSON text `body`.

    A document is parsed once. Each round opens the containers of one level and keeps only their identifying keys and the
    containers below, until none is left, so the work is that of the deepest document and no depth is cut off. A text that is no
    JSON has no keys."""
    keys = list(keys)
    left = docs.select(*keys, F.lit("$").alias("path"), F.try_parse_json(col(body)).alias("held")).filter(F.col("held").isNotNull())
    opener = docs.sparkSession.tvf
    found = None
    while True:
        step = F.when(F.col("key").isNotNull(), F.concat(F.lit("."), F.col("key"))).otherwise(F.concat(F.lit("["), F.col("pos"), F.lit("]")))
        opened = left.lateralJoin(opener.variant_explode(F.col("held").outer()))
        opened = opened.select(
            *keys, F.concat("path", step).alias("path"), identifying_field(F.col("key")).alias("field"), F.when(_is_container(F.col("value")), F.col("value")).alias("held")
        )
        opened = cut_lineage(opened.filter(F.col("field").isNotNull() | F.col("held").isNotNull()))
        hits = opened.filter(F.col("field").isNotNull()).select(*keys, "path", "field")
        found = hits if found is None else found.unionByName(hits)
        left = opened.filter(F.col("held").isNotNull()).select(*keys, "path", "held")
        if left.isEmpty():
            return found


def identifying_columns(schema: T.StructType) -> list[tuple[str, str]]:
    """(path, field) of the columns and nested fields of a schema that spell an identifying field; array elements are `[]`, values of maps `{}`."""
    table = {"".join(ch for ch in f.lower() if ch.isascii() and ch.isalnum()): f for f in IDENTIFYING_FIELDS}

    def walk(kind: T.DataType, path: str):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                here = f"{path}.{f.name}" if path else f.name
                field = table.get("".join(ch for ch in f.name.lower() if ch.isascii() and ch.isalnum()))
                if field:
                    yield here, field
                yield from walk(f.dataType, here)
        elif isinstance(kind, T.ArrayType):
            yield from walk(kind.elementType, f"{path}[]")
        elif isinstance(kind, T.MapType):
            yield from walk(kind.valueType, f"{path}{{}}")

    return list(walk(schema, ""))


def identifying_headers(tables: DataFrame, keys: Sequence[str], text: str, delimiter: str = "\t") -> DataFrame:
    """(keys, column, field): identifying column names in the header line of each delimited text."""
    head = F.regexp_replace(F.regexp_extract(col(text), r"\A([^\r\n]*)", 1), '"', "")
    names = tables.select(*keys, F.explode(F.split(head, F.lit(f"\\Q{delimiter}\\E"))).alias("column"))
    return names.withColumn("field", identifying_field("column")).filter(F.col("field").isNotNull())
