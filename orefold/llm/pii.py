"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Kinds: ``email``, ``ip``, ``card`` and ``phone`` in their base form are always
reported. The method adds cards within a longer run of digit groups (``part_card``, Luhn), bank
accounts (``iban``, mod 97), social security numbers (``ssn``), access keys (``key``)
and assigned secrets (``password``), each only where its score, raised or lowered by words
within ``NEAR`` characters, reaches ``ACCEPT``. Spans count code points, end exclusive.

Defined cases: null and empty texts have no spans; texts are read whole; spans of
different kinds may overlap; of equal spans of one kind there is one, and spans stand by
kind, start and end, so there are no ties; rows with equal ids are judged one by one; an
empty table gives no rows; extra columns pass through ``keep``, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.arrow import append
from orefold.llm.words import Texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "part_card", "iban", "ssn", "key", "password")
NEAR = 48
ACCEPT = 0.5
# Score before context, by kind.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "part_card": 0.6, "iban": 0.8, "ssn": 0.4, "key": 0.8, "password": 0.7}
FOR = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "part_card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "key": ("key", "access", "aws"),
    "password": ("login", "user", "secret"),
}
AGAINST = ("version", "isbn", "sample", "dummy", "placeholder")
SCHEMA = "array<struct<kind:string,start:long,end:long,score:double>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot begin inside a digit run, and digits and separators differ, so these never backtrack.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_KEY = re.compile(r"(?<![A-Za-z0-9])A[KS]IA[0-9A-Z]{16}(?![A-Za-z0-9])")
_SECRET = re.compile(r"(?<![A-Za-z])(?:password|passwd|secret|token|api_?key)\x20?[=:]\x20?[\"']?([^\s\"']{8,})", re.IGNORECASE)
_GROUP = re.compile(r"[0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def _base(text: str):
    """The spans of the base definition, by kind and start."""
    for start, end in _emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m.groups()):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            yield "phone", m.start(), m.end()


def _hidden_cards(text: str):
    """Groups of digits within a longer run that make up a card number."""
    for m in _CARD.finditer(text):
        groups = [g.span() for g in _GROUP.finditer(text, m.start(), m.end())]
        if len(groups) < 2:
            continue
        whole = (m.start(), m.end())
        i = 0
        while i < len(groups):
            digits, hit = "", None
            for j in range(i, len(groups)):
                digits += text[slice(*groups[j])]
                if len(digits) > 19:
                    break
                span = (groups[i][0], groups[j][1])
                if len(digits) >= 15 and span != whole and luhn(digits):
                    hit = j, span
            if hit:
                yield "part_card", *hit[1]
            i = hit[0] + 1 if hit else i + 1


def _proposed(text: str):
    yield from _hidden_cards(text)
    for m in _IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield "iban", m.start(), m.end()
    for m in _SSN.finditer(text):
        yield "ssn", m.start(), m.end()
    for m in _KEY.finditer(text):
        yield "key", m.start(), m.end()
    for m in _SECRET.finditer(text):
        yield "password", m.start(1), m.end(1)


def _score(text: str, kind: str, start: int, end: int) -> float:
    around = {w.lower() for w in _WORD.findall(text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR])}
    score = START[kind] + 0.2 * any(w in around for w in FOR[kind]) - 0.2 * any(w in around for w in AGAINST)
    return round(min(1.0, max(0.0, score)), 3)


def find(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text by kind (as in ``KINDS``), start and end."""
    base = list(_base(text))
    spans = {s: _score(text, *s) for s in base}
    for s in _proposed(text):
        if s not in spans and (score := _score(text, *s)) >= ACCEPT:
            spans[s] = score
    rank = {k: i for i, k in enumerate(KINDS)}
    return [(*s, spans[s]) for s in sorted(spans, key=lambda s: (rank[s[0]], s[1], s[2]))]


_FLAGS = np.zeros(256, dtype=bool)
_FLAGS[[*b"0123456789@=:"]] = True


def _suspects(texts: Texts) -> np.ndarray:
    """The texts that can have a span: those with a digit, ``@``, ``=`` or ``:``, or with the beginning of an access key, which may be all letters."""
    data = texts.data
    found = _FLAGS[data]
    if len(data) >= 4:
        a, b, c, d = (data[i : len(data) - 3 + i] for i in range(4))
        found[: len(data) - 3] |= (a == 65) & ((b == 75) | (b == 83)) & (c == 73) & (d == 65)
    return np.unique(np.searchsorted(texts.offsets, np.flatnonzero(found), "right") - 1)


def _in_slices(redacted: bool):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def work():
        def made(texts: Texts, _: pa.RecordBatch) -> list[pa.Array]:
            cuts, raw = texts.offsets, texts.data.tobytes()
            rows = _suspects(texts)
            spans: list = [[]] * len(texts)
            out = [raw[cuts[r] : cuts[r + 1]] for r in range(len(texts))] if redacted else []
            for r in rows:
                text = raw[cuts[r] : cuts[r + 1]].decode("utf-8", "replace")
                found = find(text)
                spans[r] = [dict(zip(("kind", "start", "end", "score"), s)) for s in found]
                if redacted and found:
                    out[r] = redact(text, found).encode()
            columns = [pa.array(spans, type=kind)]
            return [*columns, pa.array(out, type=pa.binary()).cast(pa.string())] if redacted else columns

        return made

    return work


def redact(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span, overlapping ones together, replaced by ``<kind>``."""
    out, done = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def pii_spans(docs: DataFrame, keep: list[Column], text: Column) -> DataFrame:
    """``keep`` and ``pii``, the spans of each whole text."""
    return append(docs, keep, text, T.StructType([T.StructField("pii", T._parse_datatype_string(SCHEMA))]), _in_slices(False))


def pii_redacted(docs: DataFrame, keep: list[Column], text: Column) -> DataFrame:
    """``keep``, ``pii`` and ``pii_text``, the text with its spans replaced."""
    added = T.StructType([T.StructField("pii", T._parse_datatype_string(SCHEMA)), T.StructField("pii_text", T.StringType())])
    return append(docs, keep, text, added, _in_slices(True))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
