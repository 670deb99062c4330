"""Personal data: patterns propose spans, checks confirm them, nearby words set a score.

The base kinds are ``email``, ``ip``, ``card`` (Luhn) and ``phone``; the method
adds ``iban`` (mod 97) and ``ssn`` (area rules, and only where a context word
raises its score). Offsets are code points, ends exclusive. NULL texts count as
empty and give no spans; an empty table gives no rows. Each row stands alone, so
keys may be NULL or repeated, and no shuffle is needed.

All scans are linear in the text: e-mail addresses are found from their ``@``
and digit runs are entered at their first digit only, which yields the same
leftmost matches as trying every start.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
KEEP_SCORE = 0.5
CONTEXT_CHARS = 40

#: Confidence in a confirmed span without any context word.
BASE_SCORE = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
CONTEXT = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write)\b", re.I),
    "ip": re.compile(r"\b(?:ip|address|host|server|login)\b", re.I),
    "card": re.compile(r"\b(?:card|credit|debit|visa|payment)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax)\b", re.I),
    "iban": re.compile(r"\b(?:iban|bank|account|transfer)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social|security)\b", re.I),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """ISO 13616: country and check digits moved to the end, letters as 10 to 35."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@``: the run of local characters before it, not before the last match, and the domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        account = m.group().replace(" ", "")
        if 15 <= len(account) <= 34 and mod97(account):
            yield m.span()


def ssns(text: str) -> Iterator[tuple[int, int]]:
    if "-" in text:
        for m in _SSN.finditer(text):
            area, group, serial = m.group().split("-")
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns}


def score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    return round(min(1.0, BASE_SCORE[kind] + (0.3 if CONTEXT[kind].search(near) else 0.0)), 2)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """Kind, start, end and score, by kind and then start. Base kinds stay at any score."""
    out = []
    for kind, finder in FINDERS.items():
        for start, end in finder(text):
            s = score(kind, text, start, end)
            if kind in BASE_KINDS or s >= KEEP_SCORE:
                out.append((kind, start, end, s))
    return out


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def _find(batches):
    for batch in batches:
        found = [
            [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_spans(t)] if t else []
            for t in batch.column("text").to_pylist()
        ]
        spans = pa.array(found, type=pa.list_(SPAN))
        yield pa.RecordBatch.from_arrays([batch.column("key"), spans], names=["key", "spans"])


def personal_data(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans``: an array of kind, start, end and score for every row."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        _find, f"key {kind}, spans array<struct<kind: string, start: bigint, end: bigint, score: double>>"
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans and all spans as text."""
    shown = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    base_shown = F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("key").alias("doc_id"),
        *[count(k) for k in BASE_KINDS],
        F.sha2(F.array_join(base_shown, ","), 256).alias("base_sha256"),
        F.array_join(shown, ",").alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("max_score"),
    )
