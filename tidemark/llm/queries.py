"""The corpus operators bound to the given tables, one query each, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_simhash_dedup")
def op1(spark, folder):
    from tidemark.llm.simhash_dedup import simhash_groups

    return simhash_groups(table(spark, folder, "documents"), size=4, max_bits=4)


@query("op2_best_fit_packing")
def op2(spark, folder):
    import public_tokenizers

    from tidemark.llm.best_fit_packing import pack_documents

    # the ranks hold the vocabulary of byte_bpe_50k.json, with the same ids
    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), size=1024)


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query("op3_pii")
def op3(spark, folder):
    from tidemark.llm.pii import BASE, find_personal_data

    found = find_personal_data(table(spark, folder, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *(count_kind(spans, k) for k in BASE),
        F.sha2(digest(F.filter(spans, lambda s: s["base"])), 256).alias("base_sha256"),
        digest(spans).alias("spans"),
    )


@query("op4_quality_rules")
def op4(spark, folder):
    from tidemark.llm.quality_rules import gram_counts, log_ratios, quality_verdicts

    docs = table(spark, folder, "documents")
    trusted = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return quality_verdicts(docs, log_ratios(gram_counts(docs, trusted)))


@query("op5_secret_scan")
def op5(spark, folder):
    from tidemark.llm.secret_scan import BASE, find_secrets

    spans = F.col("spans")
    return find_secrets(table(spark, folder, "documents")).select(
        "doc_id",
        *(count_kind(spans, k) for k in BASE),
        F.sha2(digest(F.filter(spans, lambda s: s["base"])), 256).alias("base_sha256"),
        digest(spans).alias("spans"),
    )


@query("op6_license_scan")
def op6(spark, folder):
    from tidemark.llm.license_scan import scan_licenses

    return (
        scan_licenses(table(spark, folder, "documents"))
        .withColumn("base_labels", F.array_join("base_labels", ","))
        .withColumn("labels", F.array_join("labels", ","))
    )


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
spread AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM spread),
lens AS (SELECT DISTINCT n FROM win),
spot AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
occ AS (SELECT spot.rid, spot.i, spot.n, win.item_id FROM spot JOIN win ON win.n = spot.n AND array_to_string(spot.w[spot.i:spot.i + spot.n - 1], ' ') = win.p),
hit AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM occ) GROUP BY rid),
items AS (
  SELECT rid, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM occ GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""


@query("op7_decontamination", OP7_SQL)
def op7(spark, folder):
    from tidemark.llm.decontamination import contamination

    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=10)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


@query("op8_sharding")
def op8(spark, folder):
    from tidemark.llm.sharding import balanced_shards

    placed = balanced_shards(table(spark, folder, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_quality_classifier")
def op9(spark, folder):
    from tidemark.llm.quality_classifier import quality_scores, train

    docs = table(spark, folder, "documents")
    return quality_scores(docs, train(docs, table(spark, folder, "labels")))


#: Verdict, host and path of the rules. Fixed values.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Pages whose host has a part of these names make up the list.
LISTED_HOSTS = r"://([^/?#]*\.)?(spam-farm|casino-win|free-bets)\."

OP10_SQL = r"""
WITH p AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         list_filter(string_split(coalesce(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), ''), '&'),
                     lambda x: x <> '' AND NOT starts_with(x, 'utm_')) AS parts
  FROM pages),
c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
              regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || regexp_replace(path, '/+$', '')
              || CASE WHEN len(parts) > 0 THEN '?' || array_to_string(parts, '&') ELSE '' END END AS canon,
         CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p),
l AS (SELECT DISTINCT canon FROM c WHERE regexp_matches(url, '://([^/?#]*\.)?(spam-farm|casino-win|free-bets)\.'))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN canon IN (SELECT canon FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM c
"""


@query("op10_url_filter", OP10_SQL)
def op10(spark, folder):
    from tidemark.llm.url_filter import filter_urls

    pages = table(spark, folder, "pages").select("page_id", "url")
    listed = pages.filter(F.col("url").rlike(LISTED_HOSTS)).select("url")
    return filter_urls(pages, listed, URL_RULES).drop("listed")


OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
d AS (
  SELECT row_number() OVER () AS rid, *, CAST(doc_id AS VARCHAR) AS id_text,
         xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                         lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1])), 4294967295) % 2 = 0 AS changed
  FROM documents, crc),
e AS (
  SELECT rid, doc_id, source,
         coalesce(strlen(id_text) || ':' || id_text, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
         text, CASE WHEN changed THEN replace(text, chr(10), '') ELSE text END AS given
  FROM d),
l AS (
  SELECT rid, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(given) || ':' || given, '-')) AS given FROM e),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM l)),
p AS (
  SELECT rid, doc_id, tree, leaf, given, count(*) OVER (PARTITION BY tree) AS n,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source),
nodes AS (
  SELECT tree, 0 AS lvl, pos, leaf AS h, n FROM p
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM nodes WHERE n > 1
  GROUP BY tree, lvl, pos // 3, n),
subs AS (SELECT tree, h FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, tree AS pos, h, (SELECT count(*) FROM subs) AS n FROM subs
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY lvl, pos // 3, n),
fold AS (
  SELECT rid, tree, 0 AS lvl, pos, n, given AS f, '' AS proof FROM p
  UNION ALL
  SELECT a.rid, a.tree, a.lvl + 1, a.pos // 3, (a.n + 2) // 3,
         sha256(string_agg(CASE WHEN b.pos = a.pos THEN a.f ELSE b.h END, '' ORDER BY b.pos)),
         a.proof || coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos <> a.pos), '')
  FROM fold a JOIN nodes b ON b.tree = a.tree AND b.lvl = a.lvl AND b.pos // 3 = a.pos // 3
  WHERE a.n > 1 GROUP BY a.rid, a.tree, a.lvl, a.pos, a.n, a.f, a.proof),
up AS (
  SELECT rid, 0 AS lvl, tree AS pos, (SELECT count(*) FROM subs) AS n, f, proof FROM fold WHERE n = 1
  UNION ALL
  SELECT a.rid, a.lvl + 1, a.pos // 3, (a.n + 2) // 3,
         sha256(string_agg(CASE WHEN b.pos = a.pos THEN a.f ELSE b.h END, '' ORDER BY b.pos)),
         a.proof || coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos <> a.pos), '')
  FROM up a JOIN tops b ON b.lvl = a.lvl AND b.pos // 3 = a.pos // 3
  WHERE a.n > 1 GROUP BY a.rid, a.lvl, a.pos, a.n, a.f, a.proof)
SELECT p.doc_id, p.leaf, subs.h AS subroot, r.h AS root, sha256(up.proof) AS proof_sha256, up.f AS folded_root, up.f = r.h AS verified
FROM p JOIN subs USING (tree) JOIN up ON up.rid = p.rid AND up.n = 1 CROSS JOIN (SELECT h FROM tops WHERE n = 1) r
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11(spark, folder):
    from tidemark.llm.merkle_manifest import manifest_proofs

    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    handed_in = F.when(changed, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return manifest_proofs(table(spark, folder, "documents"), changed_text=handed_in)


@query("op12_token_counts")
def op12(spark, folder):
    import public_tokenizers

    from tidemark.llm.token_counts import token_counts

    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT row_number() OVER () AS no, item_id, unnest(list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
t AS (SELECT rid, doc_id, len(w) AS n, term, count(*) AS tf FROM (SELECT rid, doc_id, w, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
i AS (
  SELECT rid, doc_id, term,
         CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
         * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS amount
  FROM t JOIN f USING (term), c),
s AS (SELECT no, item_id, rid, doc_id, CAST(sum(amount) AS BIGINT) AS score FROM b JOIN i USING (term) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""


@query("op13_ranked_search", OP13_SQL)
def op13(spark, folder):
    from tidemark.llm.lexical_search import ranked_search

    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=50)
