"""Personal data: patterns propose, checksums confirm, context words adjust the score.

Base kinds are email, ip, card and phone; their spans are reported whatever their score.
The method adds bank account numbers (iban, confirmed modulo 97) and social security
numbers (ssn, whose digits prove nothing: only a word nearby lifts them over the
threshold). Spans of one kind are leftmost and do not overlap; offsets are code points.

Every scan is linear in the text: emails are found from their ``@`` outwards, and digit
patterns only start where a run of digits starts. Work stays within a row, so nothing is
shuffled and a long text costs one task its own length only.

Defined cases: a null or empty text has no spans; repeated rows are searched one by one;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
THRESHOLD = 0.5
#: Score of a confirmed span, and what a context word within NEAR characters adds.
SCORES = {"email": (0.8, 0.1), "ip": (0.6, 0.3), "card": (0.7, 0.3), "phone": (0.6, 0.3), "iban": (0.9, 0.1), "ssn": (0.3, 0.5)}
NEAR = 60
CONTEXT = {
    "email": r"e-?mail|courriel|correo",
    "ip": r"\bip\b|address|adresse|host|server",
    "card": r"card|visa|credit|kredit|karte|carte|tarjeta",
    "phone": r"phone|tel\b|call|fon\b|mobil|móvil",
    "iban": r"iban|account|konto|compte|cuenta|bank",
    "ssn": r"ssn|social security|sozialversicherung|sécurité sociale|seguridad social",
}
#: Length of a bank account number by country.
IBAN_LENGTH = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27,
    "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "TR": 26,
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_CONTEXT = {k: re.compile(v) for k, v in CONTEXT.items()}

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[Span]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield "email", start, done
        at = text.find("@", max(at + 1, done))


def _digits(piece: str) -> str:
    return "".join(c for c in piece if "0" <= c <= "9")


def _part_ok(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _numbers(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(map(_part_ok, m.group().split("."))):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            yield "phone", *m.span()
    for m in _IBAN.finditer(text):
        size, end, seen = IBAN_LENGTH.get(m.group(1), 0), m.start(), ""
        while end < m.end() and len(seen) < size:
            seen += text[end].strip()
            end += 1
        ends_here = end == len(text) or not (text[end].isascii() and text[end].isalnum())
        if size and len(seen) == size and ends_here and mod97(seen):
            yield "iban", m.start(), end
    for m in _SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *m.span()


def _score(text: str, span: Span) -> float:
    kind, start, end = span
    base, more = SCORES[kind]
    around = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    return round(base + more * bool(_CONTEXT[kind].search(around.lower())), 2)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by start and kind."""
    if not text:
        return []
    found = list(_emails(text))
    if _DIGIT.search(text):
        found += _numbers(text)
    scored = [(*s, _score(text, s)) for s in found]
    kept = [s for s in scored if s[0] in BASE_KINDS or s[3] >= THRESHOLD]
    return sorted(kept, key=lambda s: (s[1], KINDS.index(s[0])))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
_SCHEMA = pa.schema([("id", pa.int64()), ("spans", pa.list_(_SPAN))])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rows = [
                [{"kind": k, "start": s, "end": e, "score": c} for k, s, e, c in find_spans(t.as_py())] for t in part.column(1)
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, _SCHEMA.field("spans").type)], schema=_SCHEMA)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, spans (array of kind, start, end, score)."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = texts.mapInArrow(_search, "id bigint, spans array<struct<kind:string,start:int,end:int,score:double>>")
    return found.select(F.col("id").alias(id_col), "spans")
