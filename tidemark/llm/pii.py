"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import map_texts, row_view

#: Kinds whose spans are reported whatever their score, in report order.
BASE = ("email", "ip", "card", "phone")
#: Kinds the method adds, behind them.
ADDED = ("iban", "short_card", "national_id", "local_phone")
KINDS = BASE + ADDED

# fixed values: lengths of international bank account numbers by country
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24,
    "TR": 26,
}

#: Words that speak for a kind when they stand near it.
CONTEXT = {
    "email": "email e-mail mail contact",
    "ip": "ip address server host",
    "card": "card visa mastercard amex credit debit payment",
    "phone": "phone tel telephone mobile call fax",
    "iban": "iban account bank transfer bic",
    "short_card": "card visa mastercard amex credit debit payment",
    "national_id": "ssn social security taxpayer",
    "local_phone": "phone tel telephone mobile call fax",
}
#: Score of a proposal by itself, and what a passed checksum and a context word add. The method keeps spans of KEEP and more.
PROPOSED = {"email": 0.7, "ip": 0.6, "card": 0.3, "phone": 0.5, "iban": 0.2, "short_card": 0.1, "national_id": 0.2, "local_phone": 0.3}
CHECKED, NEAR, KEEP, REACH = 0.5, 0.3, 0.6, 48

# The same leftmost matches as the plain patterns, without their repeated starts inside a run
_EMAIL = re.compile(r"([A-Za-z0-9._%+-]++)(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+)?")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_ANY = re.compile(r"[0-9@]")
_NEAR = {k: re.compile(rf"(?<![a-z])(?:{'|'.join(map(re.escape, w.split()))})(?![a-z])", re.I | re.A) for k, w in CONTEXT.items()}


def digits_of(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod97(found: str) -> bool:
    code = found.replace(" ", "")
    if IBAN_LENGTH.get(code[:2]) != len(code):
        return False
    rest = 0
    for c in code[4:] + code[:4]:
        rest = int(f"{rest}{int(c, 36)}") % 97
    return rest == 1


def spans_of(text: str) -> list[tuple[int, int, int, float, bool]]:
    """(kind number, start, end, score, checked) of one text, by kind, then start; code points, end exclusive."""
    if not _ANY.search(text):
        return []
    found: list[tuple[int, int, int, float, bool]] = []

    def add(kind: str, start: int, end: int, checked: bool) -> None:
        around = text[max(0, start - REACH) : start] + "\n" + text[end : end + REACH]
        score = PROPOSED[kind] + CHECKED * checked + NEAR * bool(_NEAR[kind].search(around))
        if kind in BASE or score >= KEEP and not any(s < end and start < e for _, s, e, _, _ in taken):
            found.append((KINDS.index(kind), start, end, min(score, 1.0), checked))

    taken: list[tuple[int, int, int, float, bool]] = []
    if "@" in text:
        for m in _EMAIL.finditer(text):
            if m[2]:
                add("email", *m.span(), False)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            add("ip", *m.span(), False)
    numbers = [(m, digits_of(m[0])) for m in _CARD.finditer(text)]
    for m, digits in numbers:
        if 16 <= len(digits) <= 19 and luhn(digits):
            add("card", *m.span(), True)
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(digits_of(m[0])) <= 15:
                add("phone", *m.span(), False)
    taken = list(found)
    for m in _IBAN.finditer(text):
        # the pattern may run into the next word: the country tells the length
        want, end, seen = IBAN_LENGTH.get(m[0][:2], 0), 0, 0
        for end, c in enumerate(m[0], 1):
            seen += c != " "
            if seen == want:
                break
        if seen == want and mod97(m[0][:end]):
            add("iban", m.start(), m.start() + end, True)
    taken = list(found)
    for m, digits in numbers:
        if 13 <= len(digits) <= 15 and luhn(digits) and len(set(digits)) > 1:
            add("short_card", *m.span(), True)
    for m in _NATIONAL.finditer(text):
        area, group, serial = m[0].split("-")
        sound = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
        if sound and _NEAR["national_id"].search(text[max(0, m.start() - REACH) : m.end() + REACH]):
            add("national_id", *m.span(), True)
    for m in _LOCAL.finditer(text):
        add("local_phone", *m.span(), False)
    return sorted(found)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans ARRAY<STRUCT<kind, start, end, score, checked, base>>), one row per row of `docs`, a map without a shuffle.

    Base kinds (email, ip, card, phone) are reported wherever their pattern and check hold; the score then only grades them.
    Added kinds need a score of KEEP: bank accounts pass mod-97 and the country's length, 13 to 15 digits pass Luhn and
    stand near a card word, national ids and unprefixed phone numbers stand near a word for them; none overlaps a base span.
    Null and empty texts: an empty array. Ids are passed on as they are, null or repeated.
    """

    def work(texts, _):
        rows = [spans_of(t.decode()) if t else [] for t in texts]
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]), pa.int32())
        flat = [s for r in rows for s in r]
        fields = {
            "kind": pa.array([KINDS[s[0]] for s in flat], pa.string()),
            "start": pa.array([s[1] for s in flat], pa.int64()),
            "end": pa.array([s[2] for s in flat], pa.int64()),
            "score": pa.array([s[3] for s in flat], pa.float64()),
            "checked": pa.array([s[4] for s in flat], pa.bool_()),
            "base": pa.array([s[0] < len(BASE) for s in flat], pa.bool_()),
        }
        made = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
        return {"spans": pa.ListArray.from_arrays(offsets, made)}

    schema = "spans array<struct<kind:string,start:bigint,end:bigint,score:double,checked:boolean,base:boolean>>"
    return map_texts(row_view(docs, id_col, text_col), schema, work).withColumnRenamed("_id", id_col)
