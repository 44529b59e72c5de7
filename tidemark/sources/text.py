"""Text sources: identifying names and values in free text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import identifying_field, searchable_value

#: A name standing as its own token: letters, digits, apostrophes, underscores and single words run together.
TOKEN_PATTERN = r"([A-Za-z][A-Za-z0-9'_ ]*[A-Za-z0-9]|[A-Za-z])"


def lines_of(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """One row per line with its 1-based number."""
    return df.select(*keys, F.posexplode(F.split(text, r"\r\n|\n|\r")).alias("_i", "line")).select(
        *keys, (F.col("_i") + 1).alias("line_number"), "line"
    )


def identifying_words(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Lines of a text in which an identifying field name stands as a token or as up to three words of one."""
    tokens = lines_of(df, keys, text).select(
        *keys, "line_number", F.explode(F.regexp_extract_all("line", F.lit(TOKEN_PATTERN), F.lit(1))).alias("_t")
    )
    words = F.split("_t", " ")
    runs = F.transform(
        F.sequence(F.lit(1), F.size(words)),
        lambda i: F.array(*[F.array_join(F.slice(words, i, n), " ") for n in (1, 2, 3)]),
    )
    candidates = tokens.select(
        *keys, "line_number", F.explode(F.array_distinct(F.concat(F.array("_t"), F.flatten(runs)))).alias("_c")
    )
    hits = candidates.withColumn("field", identifying_field("_c")).filter(F.col("field").isNotNull())
    return hits.select(*keys, "line_number", "field").distinct()


def texts_with_values(
    texts: DataFrame, keys: Sequence[str], text: str, values: DataFrame, value: str
) -> DataFrame:
    """(keys, value) where one of the unit's own identifying values occurs in its text, in any case.

    Values belong to the unit they identify, so this is an equi-join on the unit; `^` between name parts also matches a
    space. Values too short to tell anything are not searched."""
    wanted = values.filter(searchable_value(value)).select(*keys, F.trim(F.col(value)).alias("_v")).distinct()
    joined = texts.select(*keys, F.lower(F.col(text)).alias("_text")).join(wanted, list(keys))
    lower = F.lower("_v")
    hit = F.contains(F.col("_text"), lower) | F.contains(F.col("_text"), F.replace(lower, F.lit("^"), F.lit(" ")))
    return joined.filter(hit).select(*keys, F.col("_v").alias(value))
