"""Token counts by a tokenizer compiled to a deterministic transducer, composed over chunks of long texts."""

from __future__ import annotations

import json
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, row_view

#: The pre-tokenizer that the scanner below stands for. Fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE, LETTER, NUMBER, OTHER = range(4)
#: State of the scanner behind an apostrophe and the first letter of a contraction of three signs.
HALF = 4
CONTRACTIONS = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}

#: Transitions and words that a worker remembers; when there are more, they are forgotten and compiled anew.
TRANSITIONS = 400_000
WORDS = 300_000
#: Words that are remembered have no more bytes than this.
WORD_BYTES = 64
#: Longer texts are cut into chunks of this many bytes, whose maps are made by different tasks.
CHUNK_BYTES = 1 << 18
#: Chunk maps that one row of a round of composition holds.
FAN = 64


class Transducer:
    """A byte-pair tokenizer with word ends as a transducer, compiled on demand.

    Its input are atoms: the bytes of a word, the last one as a distinct atom 256 higher. For every prefix of a word there is one last
    token, and the tokens before it are those of the prefix without it; so the tokens of a longer prefix follow from the
    last tokens of the prefixes that a token can still start from. A state is just that: the atoms from which a token can
    go on, with the last token and the token count (relative to here) at each of their borders. A transition is annotated
    with the change of the token count, and the counts of a path add up. Words with equal futures share states.
    """

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        split = [x.get("pattern", {}).get("Regex") for x in spec["pre_tokenizer"].get("pretokenizers", [])]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or SPLIT not in split:
            raise ValueError("not a byte-pair tokenizer with word ends and the known split")
        from tokenizers import Tokenizer

        bare = Tokenizer.from_str(json.dumps({**spec, "added_tokens": [], "model": {**model, "vocab": {}, "merges": []}}))
        self.normalise, self.split = bare.normalizer.normalize_str, bare.pre_tokenizer.pre_tokenize_str
        marks = [x["content"] for x in spec["added_tokens"]]
        self.marks = re.compile("|".join(map(re.escape, sorted(marks, key=len, reverse=True)))) if marks else None
        own = _byte_of_sign()

        def atoms(token: str) -> str:
            ends = token.endswith("</w>")
            plain = [own[c] for c in (token[:-4] if ends else token)]
            return "".join(map(chr, plain[:-1] + [plain[-1] + 256 * ends]))

        special = set(marks)
        self.tokens = {atoms(t) for t in model["vocab"] if t not in special}
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            one, two = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[atoms(one), atoms(two)] = rank
        self.starts = {t[:k] for t in self.tokens for k in range(1, len(t))}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.kinds: dict[str, int] = {}
        self.words: dict[bytes, int] = {}
        self.forget()

    # -- the byte-pair part

    def forget(self):
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, int]] = {}
        self.pairs.clear()
        self.number(("", (None,), (0,)))

    def number(self, state: tuple) -> int:
        at = self.numbers.setdefault(state, len(self.states))
        if at == len(self.states):
            self.states.append(state)
        return at

    def merged(self, parts: list[str]) -> list[str]:
        """Byte-pair merges as defined: the lowest rank first, from the left."""
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stand_together(self, one: str | None, two: str) -> bool:
        """Whether `two` may follow `one` (None: the start of a word)."""
        known = self.pairs.get((one, two))
        if known is None:
            known = self.merged(list((one or "") + two)) == ([two] if one is None else [one, two])
            self.pairs[one, two] = known
        return known

    def compile(self, at: int, atom: int) -> tuple[int, int]:
        """(next state, change of the count) of a transition not seen yet."""
        if len(self.steps) > TRANSITIONS:
            state = self.states[at]
            self.forget()
            at = self.number(state)
        held, lasts, counts = self.states[at]
        longer = held + chr(atom)
        for k, last in enumerate(lasts):
            token = longer[k:]
            if token in self.tokens and self.stand_together(last, token):
                break
        else:
            raise ValueError("a byte without a token")
        now = counts[k] + 1
        keep = next((i for i in range(len(longer)) if longer[i:] in self.starts), len(longer))
        lasts, counts = (*lasts, token)[keep:], tuple(c - now for c in (*counts, now)[keep:])
        step = self.steps[at << 9 | atom] = self.number((longer[keep:], lasts, counts)), now
        return step

    def tokens_of(self, word: bytes) -> int:
        """The sum of counts along the path of a word's atoms."""
        at, total, steps = 0, 0, self.steps
        for atom in (*word[:-1], word[-1] + 256):
            step = steps.get(at << 9 | atom)
            if step is None:
                step = self.compile(at, atom)
                steps = self.steps
            at = step[0]
            total += step[1]
        return total

    # -- the scanner

    def kind(self, sign: str) -> int:
        """Space, letter, number or other, as the pre-tokenizer of the file has it."""
        found = self.kinds.get(sign)
        if found is None:
            pieces = len(self.split(f"a{sign}a"))
            found = LETTER if pieces == 1 else SPACE if pieces == 2 else NUMBER if len(self.split(sign * 2)) == 2 else OTHER
            self.kinds[sign] = found
        return found

    def scan(self, text: str) -> int:
        """Tokens of a normalised text: its state is the kind of run it is in, and the run so far."""
        total, run, state = 0, "", SPACE
        for sign in text:
            kind = self.kind(sign)
            if kind == LETTER and (run == "'" or state == HALF):
                if run + sign in CONTRACTIONS:
                    total += self.tokens_of((run + sign).encode())
                    run, state = "", SPACE
                    continue
                if run + sign in ("'r", "'v", "'l"):
                    run, state = run + sign, HALF
                    continue
            if state == HALF:  # no contraction: the apostrophe is a run, the letter starts another one
                total += self.tokens_of(b"'")
                run, state = run[1:], LETTER
            if kind != state or kind == NUMBER:
                if run:
                    total += self.tokens_of(run.encode())
                run, state = "", kind
            if kind == NUMBER:
                total += self.tokens_of(sign.encode())
                state = SPACE
            elif kind != SPACE:
                run += sign
        if state == HALF:
            return total + self.tokens_of(b"'") + self.tokens_of(run[1:].encode())
        return total + (self.tokens_of(run.encode()) if run else 0)

    def word(self, raw: bytes) -> int:
        """Tokens of bytes without ASCII white space."""
        text = raw.decode()
        if self.marks is not None and self.marks.search(text):
            return sum(map(self.plain, self.marks.split(text))) + len(self.marks.findall(text))
        return self.plain(text)

    def plain(self, text: str) -> int:
        return self.scan(text.lower() if text.isascii() else self.normalise(text))

    def count(self, text: bytes) -> int:
        """Tokens of a text. ASCII white space leads every state back to the first one, so the paths between add up."""
        total, words = 0, self.words
        if len(words) > WORDS:
            words.clear()
        for raw, times in Counter(text.split()).items():
            n = words.get(raw)
            if n is None:
                n = self.word(raw)
                if len(raw) <= WORD_BYTES:
                    words[raw] = n
            total += n * times
        return total

    # -- maps of chunks

    def chunk_map(self, piece: bytes) -> tuple[bytes, int, bytes, bool]:
        """(head, n, tail, closed): the state map of a chunk. Before its first white space it is the run over `head`, from
        whatever state the chunk is entered; there all states meet, and from there it is constant: `n` tokens, and the state
        that `tail` leads to. Not closed: no white space, `head` is the whole chunk."""
        first = re.search(rb"[ \t-\r]", piece)
        if first is None:
            return piece, 0, b"", False
        tail = re.split(rb"[ \t-\r]", piece[-WORD_BYTES:])[-1]
        if len(tail) == len(piece[-WORD_BYTES:]):
            tail = re.split(rb"[ \t-\r]", piece)[-1]
        return piece[: first.start()], self.count(piece[first.start() : len(piece) - len(tail)]), tail, True

    def compose(self, maps: list[tuple[bytes, int, bytes, bool]]) -> tuple[bytes, int, bytes, bool]:
        """One map after the other: an associative operation, so it may be done in any bracketing."""
        head, total, open_, closed = [], 0, [], False
        for front, n, tail, shut in maps:
            (open_ if closed else head).append(front)
            if shut:
                total += n + (self.count(b"".join(open_)) if closed else 0)
                open_, closed = [tail], True
        return b"".join(head), total, b"".join(open_), closed

    def applied(self, front: bytes, n: int, tail: bytes) -> int:
        """The count of a map entered in the first state and left at the end of the text."""
        return self.count(front) + n + self.count(tail)


def _byte_of_sign() -> dict[str, int]:
    """Bytes of the printable signs that byte-level vocabularies are written in: printable ones stand for themselves, the
    others for the signs from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


@lru_cache(maxsize=2)
def compiled(text: str) -> Transducer:
    return Transducer(text)


def pieces_of(text: bytes, size: int) -> list[bytes]:
    """A text in pieces of about `size` bytes that do not break a sign."""
    out, at = [], 0
    while at < len(text):
        to = min(at + size, len(text))
        while to < len(text) and text[to] & 0xC0 == 0x80:
            to += 1
        out.append(text[at:to])
        at = to
    return out


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit), one row per row of `docs`: the tokens of whole texts as the library gives them for
    the file `tokenizer`, without added begin and end; special strings inside a text are one token each.

    One map over the texts. Those of more than `chunk_bytes` leave it as chunks, are dealt out anew, and each chunk becomes a
    state map; the maps of FAN neighbours compose in one row, round after round, until one map per text is left.
    The file is read once and broadcast: it does not grow with the data.

    Null or empty text: no bytes, no tokens. Null ids and repeated rows keep their rows. No rows: no rows.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    view = row_view(docs, id_col, text_col)
    kind = view.schema["_id"].dataType.simpleString()
    view = view.select("_id", F.col("_text").cast("binary").alias("_text"), F.monotonically_increasing_id().alias("row"))

    def first(batches):
        machine = compiled(spec.value)
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                whose, chunk, size, n, piece = [], [], [], [], []
                for i, scalar in enumerate(part.column("_text")):
                    text = scalar.as_py() or b""
                    long = len(text) > chunk_bytes
                    held = pieces_of(text, chunk_bytes) if long else []
                    whose += [i] * (1 + len(held))
                    chunk += [None, *range(len(held))]
                    size += [len(text)] * (1 + len(held))
                    n += [None if long else machine.count(text)] + [None] * len(held)
                    piece += [None, *held]
                where = pa.array(whose, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").take(where), part.column("row").take(where), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(chunk, pa.int64()), pa.array(piece, pa.binary())],
                    names=["_id", "row", "n_bytes", "n", "chunk", "piece"],
                )

    made = view.mapInArrow(first, f"_id {kind}, row bigint, n_bytes bigint, n bigint, chunk bigint, piece binary")
    made = cut_lineage(made)
    texts = made.filter("chunk is null").select("_id", "row", "n_bytes", "n")
    last = made.agg(F.max("chunk")).first()[0]
    if last is not None:
        counts = _composed(made.filter("chunk is not null").select("row", "chunk", "piece"), spec, last + 1)
        long = texts.filter("n is null").drop("n").join(counts, "row").select("_id", "row", "n_bytes", "n")
        texts = texts.filter("n is not null").unionByName(long)
    return texts.select(F.col("_id").alias(id_col), "n_bytes", F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit"))


def _composed(chunks: DataFrame, spec, most: int) -> DataFrame:
    """(row, n): prefix scan over the chunk maps of each row, of which only the last value is needed."""
    names = ["row", "chunk", "head", "n", "tail", "closed"]
    shape = "row bigint, chunk bigint, head binary, n bigint, tail binary, closed boolean"

    def maps(batches):
        machine = compiled(spec.value)
        for batch in batches:
            made = [machine.chunk_map(p.as_py()) for p in batch.column("piece")]
            yield _record([batch.column("row"), batch.column("chunk")], made, names)

    def joined(batches):
        machine = compiled(spec.value)
        for batch in batches:
            made = [machine.compose([(m["head"], m["n"], m["tail"], m["closed"]) for m in held.as_py()]) for held in batch.column("held")]
            yield _record([batch.column("row"), batch.column("chunk")], made, names)

    def ended(batches):
        machine = compiled(spec.value)
        for batch in batches:
            parts = zip(*(batch.column(c).to_pylist() for c in ("head", "n", "tail")), strict=True)
            made = [machine.applied(*x) for x in parts]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, pa.int64())], names=["row", "n"])

    left = chunks.repartition("row", "chunk").mapInArrow(maps, shape)
    while most > 1:
        held = F.sort_array(F.collect_list(F.struct("chunk", "head", "n", "tail", "closed")))
        left = left.groupBy("row", F.floor(F.col("chunk") / FAN).alias("chunk")).agg(held.alias("held")).mapInArrow(joined, shape)
        most = -(-most // FAN)
    return left.select("row", "head", "n", "tail").mapInArrow(ended, "row bigint, n bigint")


def _record(keys: list, made: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.binary(), pa.bool_())
    return pa.RecordBatch.from_arrays([*keys, *(pa.array([m[k] for m in made], t) for k, t in enumerate(kinds))], names=names)
