"""URL filter: host and path rules, then a blocked Bloom filter of listed canonical URLs in front of an exact join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, measured

#: A block is 8 lanes of 64 bits; a URL sets one bit in each lane of one block.
LANES, LANE_BITS = 8, 64


def host_of(url: Column) -> Column:
    """What stands between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; empty for null and other urls."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without `www.` and default port, path without closing slashes, query without `utm_` parts; no scheme, no fragment."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.coalesce(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), F.lit(""))
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    return F.concat(host, path, F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise(F.lit("")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (verdict, host, path) that fits, as STRUCT<rule, verdict>, or null."""
    fitting = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    return F.coalesce(*fitting)


def _places(url: str, blocks: int) -> list[Column]:
    """Block number and the bit of each lane of a canonical URL."""
    spread = F.xxhash64(F.col(url), F.lit(1))
    bits = [F.shiftrightunsigned(spread, 6 * i).bitwiseAND(LANE_BITS - 1).cast("int").alias(f"b{i}") for i in range(LANES)]
    return [F.pmod(F.xxhash64(url), F.lit(blocks).cast("long")).alias("block"), *bits]


def bloom_filter(listed: DataFrame, url: str, bits_per_url: int = 16) -> tuple[DataFrame, int]:
    """(block, lane0 .. lane7) of the listed canonical URLs, and the number of blocks, which follows their count."""
    blocks = max(1, -(-listed.count() * bits_per_url // (LANES * LANE_BITS)))
    places = listed.select(*_places(url, blocks))
    lanes = [F.bit_or(F.expr(f"shiftleft(1L, b{i})")).alias(f"lane{i}") for i in range(LANES)]
    return places.groupBy("block").agg(*lanes), blocks


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
    bits_per_url: int = 16,
) -> DataFrame:
    """(id_col, host, path, rule, verdict, listed), one row per row of `pages`.

    A rule decides where one fits. Else a URL whose canonical form is listed is blocked and all others are allowed. The Bloom
    filter is a table with a row per block, so a URL meets one row of it; it is broadcast while small and joined by block
    beyond that. Its hits go to an exact join with the list, which removes the false ones, and no listed URL is missed.

    Null url: empty host and path, no rule, allowed. Null or repeated list entries count once at most. An empty list blocks
    nothing. Repeated pages each get their row.
    """
    view = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_url")).select(
        "_id",
        host_of(F.col("_url")).alias("host"),
        path_of(F.col("_url")).alias("path"),
        F.when(F.col("_url").contains("://"), canonical(F.col("_url"))).alias("canon"),
    )
    view = view.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    names = listed.select(F.col(f"`{listed_col}`").alias("_url")).filter(F.col("_url").contains("://"))
    names = names.select(canonical(F.col("_url")).alias("canon")).distinct()
    lanes, blocks = bloom_filter(names, "canon", bits_per_url)

    kept = ["_id", "host", "path", "fit"]
    # what a rule decides, or has no canonical form, is set aside: it would share one key in a shuffle
    asked = F.col("fit").isNull() & F.col("canon").isNotNull()
    decided = view.filter(~asked).select(*kept, F.lit(False).alias("listed"))
    placed = view.filter(asked).select("*", *_places("canon", blocks)).join(measured(lanes), "block", "left")
    hit = F.lit(True)
    for i in range(LANES):
        hit = hit & F.coalesce(F.expr(f"shiftright(lane{i}, b{i}) & 1L") == 1, F.lit(False))
    placed = placed.withColumn("maybe", hit)
    sure = decided.unionByName(placed.filter(~F.col("maybe")).select(*kept, F.lit(False).alias("listed")))
    exact = placed.filter("maybe").select(*kept, "canon").join(names.withColumn("found", F.lit(True)), "canon", "left")
    exact = exact.select(*kept, F.coalesce("found", F.lit(False)).alias("listed"))
    verdict = F.coalesce(F.col("fit")["verdict"], F.when(F.col("listed"), "block").otherwise("allow"))
    return sure.unionByName(exact).select(
        F.col("_id").alias(id_col), "host", "path", F.col("fit")["rule"].alias("rule"), verdict.alias("verdict"), "listed"
    )
