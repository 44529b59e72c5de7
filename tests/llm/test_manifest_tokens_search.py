"""Merkle manifest, token counts and ranked search against plain Python, with nulls, ties, repeats and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import lexical_search, merkle_manifest, token_counts

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, n bigint, row string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(level, proofs):
    """Root of a list of nodes; `proofs[i]`: steps (left, right) of node i."""
    where = list(range(len(level)))
    while len(level) > 1:
        for i, at in enumerate(where):
            run = at - at % 3
            proofs[i].append((level[run:at], level[at + 1 : run + 3]))
        level = [H(*level[i : i + 3]) for i in range(0, len(level), 3)]
        where = [at // 3 for at in where]
    return level[0]


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        head = "".join(enc(r[k]) for k in (0, 3, 2, 4))
        text = r[1]
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        given = text.replace("\n", "") if changed and text is not None else text
        groups[r[3]].append((r[0], H(head, enc(text)), H(head, enc(given))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs, inner = [], {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        inner[name] = [[] for _ in groups[name]]
        subs.append(climb([x[1] for x in groups[name]], inner[name]))
    outer = [[] for _ in names]
    root = climb(list(subs), outer)
    out = []
    for k, name in enumerate(names):
        for (doc, leaf, given), steps in zip(groups[name], inner[name], strict=True):
            steps = steps + outer[k]
            at = given
            for left, right in steps:
                at = H(*left, at, *right)
            proof = H(*(x for left, right in steps for x in (*left, *right)))
            out.append((doc, leaf, subs[k], root, proof, at, at == root))
    return out


def manifest(df):
    from pyspark.sql import functions as F

    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle_manifest.manifest_proofs(df, changed_text=F.when(changed, F.translate("text", "\n", "")).otherwise(F.col("text")))


def key(t):
    return [(x is not None, str(x)) for x in t]


def doc_rows():
    rnd = random.Random(3)
    rows = [(i, "one\ntwo " * rnd.randrange(4) + str(i), "de", f"s{i % 5 if i % 3 else 0}", i) for i in range(400)]
    rows += [(None, None, None, None, None), (None, "x\n", "en", "s1", 2), (1000, "", None, "", 0), (1001, "\n\n", "ü", "Ü", None), (1002, "a" * 300_000, "en", "lone", 1)]
    rows += [(7, "copy\n", "de", "s2", 5)] * 3 + [(7, "other", "de", "s2", 5), (-4, "low", "de", "s2", 5)]
    return [(*r, "clash", 9, "clash") for r in rows]


def test_manifest_equals_plain_trees(frame):
    rows = doc_rows()
    got = sorted(map(tuple, manifest(frame(rows, DOCS)).collect()), key=key)
    assert got == sorted(brute_manifest(rows), key=key)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 81, 82, 243, 244])
def test_manifest_of_one_source(frame, n):
    rows = [(i, f"text\n{i}", "en", None, i, "", 0, "") for i in range(n)]
    assert sorted(map(tuple, manifest(frame(rows, DOCS)).collect())) == sorted(brute_manifest(rows))


def test_manifest_of_many_sources(frame):
    rows = [(i, f"text{i}", "en", f"source {i % 290}", i, "", 0, "") for i in range(600)]
    assert sorted(map(tuple, manifest(frame(rows, DOCS)).collect())) == sorted(brute_manifest(rows))


def test_manifest_of_no_rows(frame):
    assert manifest(frame([], DOCS)).collect() == []


def test_segments_span_any_distance(frame, monkeypatch):
    """Blocks of three, so that pointers need several rounds of jumps."""
    monkeypatch.setattr(merkle_manifest, "LEVELS", 1)
    monkeypatch.setattr(merkle_manifest, "BLOCK", 3)
    rows = [(i, f"t{i}\n", "en", "hot" if i % 3 else f"s{i % 7}", i, "", 0, "") for i in range(500)]
    assert sorted(map(tuple, manifest(frame(rows, DOCS)).collect())) == sorted(brute_manifest(rows))


# -- token counts

FILE = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = [
    None, "", "   ", "don't we'LL 'sx 're's !'s ''s 'r 'v'", "x<|endoftext|>y <|startoftext|><|ENDOFTEXT|> <|endof", "1234 ٣ Ⅷ", "İSTANBUL ΣΑΣ ſ K",
    "éa ́ 각 가 日本語テスト😀", "a\x1cb\x85c d e​f\x00g\x0bh", "'", "x" * 5000, "q9" * 40_000, "word " * 50_000 + "end",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def count_rows(df, **more):
    return token_counts.token_counts(df, FILE, **more)


def expected(library, rows, limit=2048):
    out = []
    for r in rows:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        out.append((r[0], len((r[1] or "").encode()), n, n > limit))
    return sorted(out, key=key)


@pytest.mark.parametrize("chunk_bytes", [1 << 18, 1000, 7])
def test_token_counts_of_awkward_texts(frame, library, chunk_bytes):
    texts = AWKWARD if chunk_bytes > 100 else [t for t in AWKWARD if len(t or "") <= 5000]
    rows = [(i if i % 4 else None, t, "en", "s", 1, "clash", 5, "clash") for i, t in enumerate(texts + texts[:3])]
    got = sorted(map(tuple, count_rows(frame(rows, DOCS), chunk_bytes=chunk_bytes).collect()), key=key)
    assert got == expected(library, rows)


def test_token_counts_of_all_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for chunk_bytes in (1 << 18, 512):
        assert sorted(map(tuple, count_rows(docs, chunk_bytes=chunk_bytes).collect()), key=key) == expected(library, rows)


def test_token_counts_of_no_rows(frame):
    assert count_rows(frame([], DOCS)).collect() == []


def test_composition_is_associative():
    machine = token_counts.compiled(open(FILE, encoding="utf-8").read())
    text = "it's a 'story' <|endoftext|>of ünbroken\n\twords'll do ".encode()
    maps = [machine.chunk_map(p) for p in token_counts.pieces_of(text, 3)]
    left = maps[0]
    for m in maps[1:]:
        left = machine.compose([left, m])
    right = maps[-1]
    for m in maps[-2::-1]:
        right = machine.compose([m, right])
    assert left == right and machine.applied(*left[:3]) == machine.count(text)


def test_forgotten_states_change_no_count(monkeypatch, library):
    monkeypatch.setattr(token_counts, "TRANSITIONS", 40)
    monkeypatch.setattr(token_counts, "WORDS", 2)
    machine = token_counts.Transducer(open(FILE, encoding="utf-8").read())
    rnd = random.Random(5)
    for _ in range(300):
        text = "".join(rnd.choice(["ab", "the", "ing", " ", "'ll", "é", "9", "zq"]) for _ in range(rnd.randrange(20)))
        assert machine.count(text.encode()) == len(library.encode(text, add_special_tokens=False).ids)


# -- ranked search

ITEMS = "item_id bigint, text string, rank int, score bigint, no int"


def words_of(text):
    up = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [w.translate(up) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute_search(docs, items, k=50):
    held = [(r[0], words_of(r[1])) for r in docs]
    held = [(d, w) for d, w in held if w]
    n_docs, total = len(held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    out = []
    for item in items:
        found = []
        for doc, w in held:
            tf, m = Counter(w), 50 + (50 * len(w) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                for t in set(words_of(item[1])) if t in tf
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for at, (score, missing, doc) in enumerate(sorted(found)[:k]):
            out.append((item[0], at + 1, None if missing else doc, -score))
    return sorted(out, key=key)


def search_input():
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Zürich", "日本", "a"]
    docs = [(i, " ".join(rnd.choices(words[: rnd.choice([4, 30, 63])], k=rnd.randrange(1, 30))) + "!") for i in range(300)]
    docs += [(None, "w1 w2 w3"), (None, "w1 w2 w3"), (3, "w1 w2 w3"), (3, "w1 w2 w3"), (900, None), (901, ""), (902, "!?"), (903, "w5 " * 40_000)]
    docs = [(d, t, "en", "s", 1, "clash", 2, "clash") for d, t in docs]
    shared = "w1 w2 w3 w4"
    items = [(i, f"{shared} {' '.join(rnd.sample(words, 6))} ONLY{i} w1") for i in range(25)]
    items += [(None, "w7 W8"), (3, "W9"), (3, "w10 w9"), (70, None), (71, "..."), (72, "absent"), (73, shared)]
    return docs, [(i, t, 1, 1, 1) for i, t in items]


@pytest.mark.parametrize("limit", [200_000, 60])
def test_ranked_search_equals_plain_scores(frame, monkeypatch, limit):
    monkeypatch.setattr(lexical_search, "PLAN_TERMS", limit)
    docs, items = search_input()
    got = lexical_search.ranked_search(frame(docs, DOCS).repartition(5), frame(items, ITEMS), k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == brute_search(docs, items, 7)


def test_ranked_search_of_no_rows(frame):
    docs, items = search_input()
    assert lexical_search.ranked_search(frame([], DOCS), frame(items, ITEMS)).collect() == []
    assert lexical_search.ranked_search(frame(docs, DOCS), frame([], ITEMS)).collect() == []


def test_shared_sets_are_added_once():
    plan = lexical_search.mine([[b"a", b"b", b"c", b"d"], [b"a", b"b", b"c"], [b"a", b"b", b"d"], [b"e"]])
    assert plan.sets == 4 and plan.set_of[0] == plan.set_of[1]
    assert sum(len(a) for a, _ in plan.steps) >= 1
    scores = plan.scores(np.arange(5), np.zeros(5, int), 10 ** np.arange(5), 1)
    order = list(plan.vocabulary)
    amount = {t: 10**i for i, t in enumerate(order)}
    assert scores[:, 0].tolist() == [sum(amount[t] for t in item) for item in ([b"a", b"b", b"c", b"d"], [b"a", b"b", b"c"], [b"a", b"b", b"d"], [b"e"])]
