"""Secrets: known forms, and tokens whose symbols pass a battery of randomness tests under false-discovery control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, row_view

#: Known forms: kind, pattern, least length of the checked group, the group. Fixed values.
FORMS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),
)
BASE = tuple(f[0] for f in FORMS)
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
QUICK = r"(?i:password|passwd|secret|token|api_?key)|" + TOKEN

#: Inferred encodings, smallest alphabet first: kind, pattern, and the share of steps at which ordinary writing in it goes over
#: from letters to digits, back, or to another capitalised word. Model values of this method, like those below.
ENCODINGS = (
    ("random_hex", "^([0-9a-f]+|[0-9A-F]+)$", 0.05),
    ("random_letters", "^([a-z]+|[A-Z]+)$", 0.05),
    ("random_base32", "^[A-Z2-7]+=*$", 0.05),
    ("random_base36", "^([a-z0-9]+|[A-Z0-9]+)$", 0.05),
    ("random_base62", "^[A-Za-z0-9]+$", 0.08),
    ("random_base64", "^", 0.08),
)
SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
#: Ordinary writing: chance that two symbols are equal and that three are, and that a letter is followed by one of the other
#: kind, vowel or consonant.
EQUAL, EQUAL_THREE, ALTERNATES = 0.065, 0.0055, 0.6
#: Lower ends of the length classes; each is a family of its own in the false-discovery control.
LENGTHS = (20, 28, 40, 64, 128)
#: Cells of the logarithmic scale on which p-values are counted: CELL decades wide.
CELL, CELLS = 0.05, 1200


def pieces_of(text: Column, pattern: str, group: int) -> Column:
    """ARRAY<STRUCT<gap, hit, size>> of a pattern's matches in order: code points before it since the last one, the match,
    and the length of the checked group."""
    p = F.lit(pattern)
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, p, F.lit(0))
    sizes = F.transform(F.regexp_extract_all(text, p, F.lit(group)), F.length) if group else F.transform(hits, F.length)
    made = F.arrays_zip(F.slice(F.transform(gaps, F.length), 1, F.size(hits)).alias("gap"), hits.alias("hit"), sizes.alias("size"))
    return F.transform(made, lambda x: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), x["size"].alias("size")))


def places(view: DataFrame) -> DataFrame:
    """(_id, key, kind number, start, end, hit, size): matches of all forms and all long tokens, with code-point places.

    Only rows that have any are cut up. Places are running sums inside one row's matches of one kind, and rows that are equal
    in id and text are one here.
    """
    some = view.filter(F.col("_text").rlike(QUICK))
    forms = [*((p, g) for _, p, _, g in FORMS), (TOKEN, 0)]
    lists = F.array(*(F.struct(F.lit(n).alias("kind"), pieces_of(F.col("_text"), p, g).alias("found")) for n, (p, g) in enumerate(forms)))
    one = some.select("_id", "key", F.explode(lists).alias("l")).select("_id", "key", "l.kind", F.posexplode("l.found").alias("n", "f"))
    one = one.repartition("_id", "key", "kind").dropDuplicates(["_id", "key", "kind", "n"])
    so_far = F.expr("sum(gap + length(hit)) over (partition by _id, key, kind order by n)")
    one = one.select("_id", "key", "kind", "n", "f.*").withColumn("end", so_far)
    return one.select("_id", "key", "kind", (F.col("end") - F.length("hit")).alias("start"), "end", "hit", "size")


def encoding_of(token: Column) -> Column:
    """Number of the smallest encoding that holds the token."""
    return F.coalesce(*(F.when(token.rlike(p), F.lit(n)) for n, (_, p, _) in enumerate(ENCODINGS)))


def by_encoding(column: str, values: list[float]) -> Column:
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), F.col(column) + 1)


def _divergence(share: Column, model: Column) -> Column:
    """Kullback-Leibler divergence of two chances: exp(-n times it) bounds the tail of n trials (Chernoff)."""
    yes = F.when(share > 0, share * F.log(share / model)).otherwise(0.0)
    return yes + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - model))).otherwise(0.0)


def battery(tokens: DataFrame) -> DataFrame:
    """`tokens` (with `hit`) and `encoding`, `uniform`, `runs`, `serial`, `p`.

    Each test asks how likely ordinary writing, words and numbers joined in the inferred encoding, is to look as random as the
    token; `uniform`, `runs` and `serial` are natural logarithms of bounds of these p-values, 0 where it looks like writing.
    uniform: symbols are as evenly used as by a uniform draw (pairs of equal symbols, which is the chi-squared statistic up to
    constants, against those of writing). runs: runs of digits, small and capital letters are short. serial: vowels and consonants
    do not alternate at lag one. `p` is Fisher's combination of the three.
    Signs that join words (+/_=-) are no symbols. All counts are of one token, so the tests hold at any length.
    """
    core = F.translate("hit", "+/_=-", "")
    counted = tokens.withColumn("encoding", encoding_of(F.col("hit"))).withColumn("core", core).withColumn("n", F.length("core").cast("double"))
    squares = None
    for c in SIGNS:
        times = F.col("n") - F.length(F.replace("core", F.lit(c), F.lit("")))
        squares = times * times if squares is None else squares + times * times
    lower, upper, digits = SIGNS[26:52], SIGNS[:26], SIGNS[52:]
    kinds = F.translate("core", lower + upper + digits, "l" * 26 + "u" * 26 + "d" * 10)
    sounds = F.translate(F.lower("core"), lower + digits, "".join("v" if c in "aeiou" else "c" for c in lower) + "d" * 10)
    counted = counted.withColumns(
        {
            "pairs": (squares - F.col("n")) / 2,
            "turns": F.regexp_count(kinds, F.lit("l(?=[ud])|d(?=[lu])|u(?=d)")),
            "letters": F.regexp_count(sounds, F.lit("[vc](?=[vc])")),
            "changes": F.regexp_count(sounds, F.lit("v(?=c)|c(?=v)")),
        }
    )
    n, model = F.col("n"), by_encoding("encoding", [e[2] for e in ENCODINGS])
    possible = n * (n - 1) / 2
    spread = possible * (EQUAL - EQUAL**2) + n * (n - 1) * (n - 2) * (EQUAL_THREE - EQUAL**2)
    uniform = F.when(F.col("pairs") < EQUAL * possible, -F.pow(EQUAL * possible - F.col("pairs"), F.lit(2)) / (2 * spread)).otherwise(0.0)
    turned = F.when(n > 1, F.col("turns") / (n - 1)).otherwise(0.0)
    runs = F.when(turned > model, -(n - 1) * _divergence(turned, model)).otherwise(0.0)
    changed = F.when(F.col("letters") > 0, F.col("changes") / F.col("letters")).otherwise(1.0)
    serial = F.when(changed < ALTERNATES, -F.col("letters") * _divergence(changed, F.lit(ALTERNATES))).otherwise(0.0)
    counted = counted.withColumns({"uniform": uniform, "runs": runs, "serial": serial})
    half = -(F.col("uniform") + F.col("runs") + F.col("serial"))
    counted = counted.withColumn("p", F.exp(-half) * (1 + half + half * half / 2))
    return counted.drop("core", "n", "pairs", "turns", "letters", "changes")


def length_class(hit: Column) -> Column:
    n = F.length(hit)
    return F.coalesce(*(F.when(n >= low, F.lit(i)) for i, low in reversed(list(enumerate(LENGTHS)))), F.lit(0))


def discoveries(scored: DataFrame, rate: float) -> DataFrame:
    """The rows of `scored` that pass the step-up control at `rate` inside their length class.

    p-values are counted on a fixed logarithmic grid (rounded to the unfavourable side), so the control over all tokens of
    the corpus needs one small table and no global sort. A class's cut is its last cell where tokens x p <= rate x tokens
    found so far.
    """
    cell = F.least(F.floor(-F.log10(F.greatest("p", F.lit(1e-300))) / CELL), F.lit(CELLS)).cast("int")
    celled = scored.withColumn("family", length_class(F.col("hit"))).withColumn("cell", F.greatest(cell, F.lit(0)))
    counts = celled.groupBy("family", "cell").agg(F.count("*").alias("n"))
    steps = counts.select(
        "family",
        "cell",
        F.pow(F.lit(10.0), -F.col("cell") * CELL).alias("p"),  # the edge of the cell nearer to one
        F.expr("sum(n) over (partition by family order by cell desc)").alias("found"),
        F.expr("sum(n) over (partition by family)").alias("all"),
    )
    cuts = steps.filter(F.col("all") * F.col("p") <= rate * F.col("found")).groupBy("family").agg(F.min("cell").alias("cut"))
    return celled.join(F.broadcast(cuts), "family").filter("cell >= cut").drop("family", "cell", "cut")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01) -> DataFrame:
    """(id_col, key, spans ARRAY<STRUCT<start, rank, kind, end, base>>), one row per row of `docs`; spans by start, then kind.

    Base spans are the matches of FORMS. The method adds tokens of 20 and more characters found random at the false-discovery
    `rate`, with the inferred encoding as kind, unless they lie inside a base span of the row. `key` is a hash of the text.

    Null and empty texts: no spans. Null ids are matched null-safely; repeated rows each get their row. DataFrame functions only.
    """
    view = row_view(docs, id_col, text_col).withColumn("key", F.xxhash64("_text"))
    found = cut_lineage(places(view))
    least = F.element_at(F.array(*(F.lit(f[2]) for f in FORMS)), F.col("kind") + 1)
    base = found.filter((F.col("kind") < len(FORMS))).filter(F.col("size") >= least)
    names = F.element_at(F.array(*(F.lit(b) for b in BASE)), F.col("kind") + 1)
    base = base.select("_id", "key", "start", F.col("kind").alias("rank"), names.alias("name"), "end", F.lit(True).alias("base"))
    random = discoveries(battery(found.filter(F.col("kind") == len(FORMS))), rate)
    coded = F.element_at(F.array(*(F.lit(e[0]) for e in ENCODINGS)), F.col("encoding") + 1)
    random = random.select(
        "_id", "key", "start", (F.col("encoding") + len(FORMS)).alias("rank"), coded.alias("name"), "end", F.lit(False).alias("base")
    )
    span = F.struct("start", "rank", F.col("name").alias("kind"), F.col("end"), "base")
    rows = base.unionByName(random).groupBy("_id", "key").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    inside = lambda s: ~s["base"] & F.exists("spans", lambda b: b["base"] & (b["start"] <= s["start"]) & (s["end"] <= b["end"]))
    rows = rows.withColumn("spans", F.filter("spans", lambda s: ~inside(s)))
    rows = rows.select(F.col("_id").alias("hit_id"), F.col("key").alias("hit_key"), "spans")
    joined = view.select("_id", "key").join(rows, F.col("_id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left")
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,base:boolean>>")
    return joined.select(F.col("_id").alias(id_col), "key", F.coalesce("spans", empty).alias("spans"))
