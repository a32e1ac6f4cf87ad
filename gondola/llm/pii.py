"""Personal data by patterns, checksums and context.

Patterns propose spans. Validators confirm them: Luhn for cards, mod-97 for bank
accounts, number ranges for addresses and social security numbers. Words near a span, on either side, raise its score, and
a span whose kind needs context is dropped without it.

All scans are linear in the text: a pattern is only tried where a run of its
characters begins, and e-mail addresses are searched from their ``@``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick

#: The base kinds, then those that the method adds, in the order of results.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
#: Spans that the method adds have at least this score.
LEAST_SCORE = 0.6
#: A kind's score once its pattern and validator agree, and what context adds.
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "adresse"),
    "card": ("card", "visa", "credit", "mastercard", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
}
CONTEXT_SCORE = 0.4
#: Characters before and behind a span in which a context word counts.
CONTEXT_CHARS = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match ends where a run of digits ends, so the next one begins with a run too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
                   r"(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_][\w-]*")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number without blanks has the remainder 1."""
    moved = account[4:] + account[:4]
    return 15 <= len(account) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: the whole run before an ``@`` that has a domain behind it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0]) if m.end() - m.start() < 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield m.span()


def ssns(text: str) -> Iterator[tuple[int, int]]:
    """Social security numbers whose area, group and serial may be issued."""
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _context(text: str, start: int, end: int, kind: str) -> float:
    """The context score if a word of the kind stands near, on either side."""
    near = f"{text[max(0, start - CONTEXT_CHARS):start]} {text[end:end + CONTEXT_CHARS]}".lower()
    return CONTEXT_SCORE if any(w in CONTEXT[kind] for w in _WORD.findall(near)) else 0.0


def _uncovered(spans: Iterable[tuple[int, int]],
               covers: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Spans that no cover overlaps, by one look at the sorted covers each."""
    covers = sorted(covers)
    starts = [s for s, _ in covers]
    reach = list(accumulate((e for _, e in covers), max))
    for s, e in spans:
        before = bisect_left(starts, e)
        if not before or reach[before - 1] <= s:
            yield s, e


def spans_of(text: str | None) -> list[Span]:
    """All spans of a text, by kind as in ``KINDS``, then by start."""
    found: list[tuple[str, int, int]] = []
    if not text:
        return []
    if "@" in text:
        found += [("email", *s) for s in emails(text)]
    if _DIGIT.search(text):
        found += [("ip", *s) for s in ips(text)] + [("card", *s) for s in cards(text)]
        if "+" in text:
            found += [("phone", *s) for s in phones(text)]
        base = [(s, e) for _, s, e in found]
        # An account has its own checksum; a number without one gives way to a base span.
        found += [("iban", *s) for s in ibans(text)]
        found += [("ssn", *s) for s in _uncovered(ssns(text), base)]
    scored = [Span(k, s, e, min(1.0, SCORES[k] + _context(text, s, e, k))) for k, s, e in found]
    return [x for x in scored if x.kind in BASE or x.score >= LEAST_SCORE]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                             ("score", pa.float64())]))


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{x.kind}:{x.start}:{x.end}" for x in spans)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [spans_of(t.as_py()) for t in batch.column(1)]
        base = [[x for x in row if x.kind in BASE] for row in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)]
            + [pa.array([sum(x.kind == k for x in b) for b in base], pa.int64()) for k in BASE]
            + [pa.array([hashlib.sha256(_listed(b).encode()).hexdigest() for b in base]),
               pa.array([_listed(row) for row in rows]),
               pa.array([[x._asdict() for x in row] for row in rows], _SPANS)],
            names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "found"])


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Personal data of every row: ``doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, found``.

    ``n_*`` and ``base_sha256`` are about the four base kinds, ``spans`` lists all spans as
    ``kind:start:end`` in code points, ``found`` holds them with their scores. The
    method adds bank accounts that pass mod-97, also where a base span overlaps them, and
    social security numbers that may be issued, where a word near by names them and no base span
    covers the place. Work is linear in a text of any length.

    Null and empty texts have no spans. Rows that repeat get the same result each;
    null ids stay. An empty table gives an empty result.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    return rows.mapInArrow(_find, (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
        + "".join(f"n_{k} bigint, " for k in BASE)
        + "base_sha256 string, spans string, "
        "found array<struct<kind: string, start: int, end: int, score: double>>"))
