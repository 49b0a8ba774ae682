"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Four base kinds (email, ip, card, phone) are reported whenever their pattern and
check hold.  Others (iban, ssn, account, local_phone) are looser patterns and are
reported from ``min_score`` on.  A confirmed checksum starts at 0.9, a pattern
alone at 0.5; a context word within CONTEXT characters adds 0.3.

Null and empty texts have no spans.  A text is searched whole, in time that
grows with its length alone: runs of characters are found from their rare marks
or taken possessively, so no pattern starts twice in one run.  Rows with null or
repeated ids are documents of their own, extra columns are left out by
``find_pii`` and kept as they are by ``redact``; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "account", "local_phone")
CONTEXT = 40
MIN_SCORE = 0.6

CONTEXT_WORDS = {
    "email": "mail email e-mail contact write adresse correo courriel",
    "ip": "ip address host server login adresse",
    "card": "card visa credit payment mastercard karte carte tarjeta",
    "phone": "phone call tel mobile telephone fax handy teléfono téléphone",
    "iban": "iban bank account konto compte cuenta transfer",
    "ssn": "ssn social security insurance",
    "account": "account konto iban bank compte cuenta routing",
    "local_phone": "phone call tel mobile telephone fax office",
}

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
ACCOUNT = re.compile(r"(?<![0-9A-Za-z+])[0-9]{8,12}(?![0-9A-Za-z])")
LOCAL_PHONE = re.compile(r"\([0-9]{3}\) ?[0-9]{3}[ -][0-9]{4}(?![0-9])")

SPAN_DDL = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Country and check digits to the end, letters as 10..35, remainder 1."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ to both sides, which finds the leftmost matches without trying every start."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_PART:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest run of groups from each country code on that its check digits fit."""
    at = 0
    while m := IBAN.search(text, at):
        start, end = m.span()
        at = start + 2
        # capitals after the number match the pattern too; they are left off group by group
        while end > 0 and len(packed := text[start:end].replace(" ", "")) >= 15:
            if mod97(packed):
                yield start, end
                at = end
                break
            end = text.rfind(" ", start, end)


def proposals(text: str) -> Iterator[tuple[str, int, int, float]]:
    """Spans of each kind that pass its check, with the score before any context."""
    for a, b in emails(text):
        yield "email", a, b, 0.7
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", *m.span(), 0.7
    cards = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = digits_of(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
                yield "card", *m.span(), 0.9
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(digits_of(m[0])) <= 15:
                yield "phone", *m.span(), 0.7
    for start, end in ibans(text):
        yield "iban", start, end, 0.9
    for m in SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "ssn", *m.span(), 0.5
    for m in ACCOUNT.finditer(text):
        yield "account", *m.span(), 0.4
    if "(" in text:
        for m in LOCAL_PHONE.finditer(text):
            yield "local_phone", *m.span(), 0.6


def find_spans(text: str, context: dict[str, frozenset], min_score: float) -> list[dict]:
    """All spans of one text by kind and start."""
    found = []
    for kind, start, end, score in proposals(text):
        near = f"{text[max(0, start - CONTEXT) : start]} {text[end : end + CONTEXT]}".lower()
        if not context[kind].isdisjoint(re.split(r"[^\w-]+", near)):
            score = min(1.0, score + 0.3)
        if kind in BASE_KINDS or score >= min_score:
            found.append({"kind": kind, "start": start, "end": end, "score": score})
    found.sort(key=lambda s: (KINDS.index(s["kind"]), s["start"]))
    return found


def context_sets(words: dict[str, str]) -> dict[str, frozenset]:
    return {k: frozenset(words.get(k, "").split()) for k in KINDS}


def scan(min_score: float, words: dict[str, str]):
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = context_sets(words)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            spans = [find_spans(t, context, min_score) if t else [] for t in texts]
            yield batch_of(schema, batch.column("doc_id"), spans)

    return run


def find_pii(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_score: float = MIN_SCORE,
    context_words: dict[str, str] = CONTEXT_WORDS,
) -> DataFrame:
    """One row per document: doc_id and its spans (code points, end exclusive)."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInArrow(scan(min_score, context_words), f"doc_id bigint, spans {SPAN_DDL}")


def replaced(text: str, spans: list[dict]) -> str:
    """The text with each span, or overlap of spans, replaced by its first kind."""
    out, end = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= end:
            out += [text[end : s["start"]], f"[{s['kind'].upper()}]"]
        end = max(end, s["end"])
    return "".join([*out, text[end:]])


def redact(
    docs: DataFrame,
    text_col: str = "text",
    length_col: str | None = None,
    min_score: float = MIN_SCORE,
    context_words: dict[str, str] = CONTEXT_WORDS,
) -> DataFrame:
    """The same rows and columns with spans in the text replaced, and their length column kept true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = context_sets(context_words)
        for batch in slices(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            spans = [find_spans(t, context, min_score) if t else [] for t in texts]
            clean = [replaced(t, s) if s else t for t, s in zip(texts, spans)]
            at = batch.schema.get_field_index(text_col)
            batch = batch.set_column(at, batch.schema.field(at), pa.array(clean, pa.string()))
            if length_col:
                at = batch.schema.get_field_index(length_col)
                old, kind = batch.column(at).to_pylist(), batch.schema.field(at)
                sizes = [len(t) if s else n for t, s, n in zip(clean, spans, old)]
                batch = batch.set_column(at, kind, pa.array(sizes, kind.type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
