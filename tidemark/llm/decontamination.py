"""Benchmark decontamination: a positional index of rare benchmark terms, intersected at their offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, ascii_lower, cut_lineage, measured, row_view

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words in order, A-Z lower-cased: runs of letters, digits and all that is not ASCII. Null: none."""
    found = F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS)
    return F.filter(found, lambda w: w != "")


def windows_of(items: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(item, phrase ARRAY<STRING>): every `size` consecutive words of an item; a shorter item is one window, an empty one none."""
    view = row_view(items, item_col, text_col).select(F.col("_id").alias("item"), words_of(F.col("_text")).alias("w"))
    view = view.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    return view.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), size).alias("phrase")).distinct()


def term_counts(view: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): occurrences of the benchmark's terms in all documents; counted in the tasks before the shuffle."""
    found = view.select(F.explode(words_of(F.col("_text"))).alias("term"))
    return found.join(measured(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def with_anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows with their rarest term and the one after it, each with its offset in the window.

    A window with a term that no document has cannot occur; it has no posting to start from and leaves here.
    """
    spread = windows.withColumn("window", F.xxhash64("phrase")).select("window", F.posexplode("phrase").alias("offset", "term"))
    spread = spread.distinct().join(counts, "term", "left")
    order = F.sort_array(F.collect_list(F.struct("n", "term", "offset")))
    picked = spread.groupBy("window").agg(order.alias("o"), F.count("n").alias("known"), F.count("*").alias("size"))
    picked = picked.filter("known = size").select(
        "window",
        F.col("o")[0]["term"].alias("term"),
        F.col("o")[0]["offset"].alias("offset"),
        F.try_element_at("o", F.lit(2))["term"].alias("next_term"),
        F.try_element_at("o", F.lit(2))["offset"].alias("next_offset"),
    )
    phrases = windows.withColumn("window", F.xxhash64("phrase"))
    return phrases.join(picked, "window")


def near_anchors(windows: DataFrame, counts: DataFrame, proximity: int) -> DataFrame:
    """(window, item, phrase, term, offset): for windows with at least `proximity` terms that documents have, those terms but for
    the `proximity` - 1 most frequent: whatever `proximity` of its words a passage holds, one of these is among them."""
    phrases = windows.withColumn("window", F.xxhash64("phrase"))
    spread = phrases.select("window", F.posexplode("phrase").alias("offset", "term")).groupBy("window", "term").agg(F.min("offset").alias("offset"))
    order = F.sort_array(F.collect_list(F.struct("n", "term", "offset")))
    held = spread.join(counts, "term").groupBy("window").agg(order.alias("o")).filter(F.size("o") >= proximity)
    picked = held.select("window", F.explode(F.slice("o", F.lit(1), F.size("o") - proximity + 1)).alias("a"))
    return phrases.join(picked.select("window", "a.term", "a.offset"), "window")


def positional_index(view: DataFrame, terms: DataFrame, reach: int) -> DataFrame:
    """(term, _id, key, pos, first, around): postings of `terms` in all documents, with the words up to `reach` places away.

    The index is partitioned by document: a posting brings its neighbours, so lists of other terms are intersected
    at their offsets without going back to the texts. `first` is the place of the first neighbour.
    """
    found = view.select("_id", "key", words_of(F.col("_text")).alias("w"))
    found = found.select("_id", "key", "w", F.posexplode("w").alias("pos", "term")).join(measured(terms), "term", "left_semi")
    first = F.greatest(F.col("pos") - reach, F.lit(0))
    return found.select(
        "term", "_id", "key", "pos", first.alias("first"), F.slice("w", first + 1, F.col("pos") - first + reach + 1).alias("around")
    )


def benchmark_matches(
    docs: DataFrame, items: DataFrame, size: int = 10, proximity: int | None = None, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(_id, key, item, start, length, kind): where an item's window stands in a document.

    kind `phrase`: its words stand there one after another. With `proximity` = p also `near`: at least p of the window's
    distinct words stand around one of them, less than the window's length away, in any order; `start` is where the window would
    begin by the place of that word. Any word may be missing, the rarest too. `key` is a hash of the text: rows with the
    same id and text are one document here.
    """
    view = row_view(docs, id_col, text_col).select("_id", "_text", F.xxhash64("_text").alias("key"))
    windows = cut_lineage(windows_of(items, item_col, item_text_col, size))
    terms = windows.select(F.explode("phrase").alias("term")).distinct()
    counts = cut_lineage(term_counts(view, terms)) if proximity is not None else term_counts(view, terms)
    anchored = cut_lineage(with_anchors(windows, counts))
    rarest = anchored.select("term")
    if proximity is not None:
        loose = cut_lineage(near_anchors(windows, counts, proximity))
        rarest = rarest.unionByName(loose.select("term"))
    postings = cut_lineage(positional_index(view, rarest.distinct(), size - 1))
    met = postings.join(measured(anchored), "term")
    start = F.col("pos") - F.col("offset")
    met = met.withColumn("start", start).withColumn("length", F.size("phrase")).withColumn("at", start - F.col("first"))
    second = F.try_element_at("around", F.greatest(F.col("at") + F.col("next_offset") + 1, F.lit(1)))
    exact = met.filter((F.col("at") >= 0) & (F.col("next_term").isNull() | (second == F.col("next_term"))))
    exact = exact.filter(F.slice("around", F.col("at") + 1, F.col("length")) == F.col("phrase"))
    out = ["_id", "key", "item", "start", "length"]
    found = exact.select(*out, F.lit("phrase").alias("kind"))
    if proximity is not None:
        around = postings.join(measured(loose), "term").filter(F.size(F.array_intersect("around", "phrase")) >= proximity)
        near = around.withColumns({"start": F.col("pos") - F.col("offset"), "length": F.size("phrase")}).select(*out).distinct()
        near = near.join(exact.select(*out).distinct(), out, "left_anti")
        found = found.unionByName(near.withColumn("kind", F.lit("near")))
    return found.distinct()


def contamination(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(id_col, n_words, n_hit, n_items, items, contaminated), one row per row of `docs`.

    n_hit counts the words of the document inside any occurrence of a window; `items` are the sorted ids, as text, of the
    items with an occurring window. Null and empty texts have no words and no hits; an item without words has no window.
    Null ids are matched null-safely; repeated rows each get their row. No items: no document is hit.
    """
    found = benchmark_matches(docs, items, size, None, id_col, text_col, item_col, item_text_col)
    places = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("stop"))))
    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))
    covered = F.aggregate(
        "places",
        none,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["stop"] - F.greatest(x["start"], acc["stop"]), F.lit(0))).alias("n"),
            F.greatest(acc["stop"], x["stop"]).alias("stop"),
        ),
    )["n"]
    hits = found.groupBy("_id", "key").agg(
        places.alias("places"), F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")
    )
    hits = hits.select(F.col("_id").alias("hit_id"), F.col("key").alias("hit_key"), covered.alias("n_hit"), "items")
    view = row_view(docs, id_col, text_col)
    rows = view.select(
        "_id", F.xxhash64("_text").alias("key"), F.coalesce(F.regexp_count("_text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words")
    )
    joined = rows.join(hits, F.col("_id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left")
    return joined.select(
        F.col("_id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
