"""Personal data: patterns propose spans, validators confirm them, words nearby adjust the score.

A span has a kind, a start and an end in code points, whether it is of a base kind, and a score. Base kinds (email, ip,
card, phone) are kept whenever their validator passes. The further kinds (iban by mod-97, short cards by Luhn, nine-digit
identity numbers) are kept from ``THRESHOLD`` on, which for the weaker ones takes a context word.

Defined cases: null and empty texts have no spans; repeated rows are searched one by one; every pattern takes time
linear in the text; extra columns are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import col

KINDS = ("email", "ip", "card", "phone", "iban", "short_card", "identity")
BASE = KINDS[:4]
THRESHOLD = 0.5
#: Characters before and after a span in which context words count.
NEAR = 40

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_CONTEXT = {
    kind: re.compile(words, re.I)
    for kind, words in {
        "email": r"\b(?:e-?mail|contact|write|mailto)\b",
        "ip": r"\b(?:ip|address|host|server)\b",
        "card": r"\b(?:card|credit|visa|mastercard|pay)",
        "phone": r"\b(?:phone|call|tel|mobile|fax)\b",
        "iban": r"\b(?:iban|account|bank|konto|compte|cuenta)\b",
        "short_card": r"\b(?:card|credit|visa|mastercard|amex)",
        "identity": r"\b(?:ssn|social|identity|security)\b",
    }.items()
}
_PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "short_card": 0.4, "identity": 0.4}


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def mod97(account: str) -> bool:
    """The check of an international account number: country and check digits last, letters as 10 to 35."""
    rest = 0
    for character in account[4:] + account[:4]:
        value = int(character, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with what stands before and after it; the runs before different @ never overlap."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        free = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", free)


def _octets(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers. A match may have swallowed words after the number, so its parts up to a blank are tried as well,
    the longest first; a match has at most 30 of them."""
    at = 0
    while m := _IBAN.search(text, at):
        start, end = m.span()
        at = start + 1
        while len(account := text[start:end].replace(" ", "")) >= 15:
            if mod97(account):
                yield start, end
                at = end
                break
            end = max(start, text.rfind(" ", start, end))


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans that pass their validator."""
    if "@" in text:
        yield from (("email", *span) for span in _emails(text))
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if _octets(m[0]):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card" if len(digits) >= 16 else "short_card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span()
    yield from (("iban", *span) for span in _ibans(text))
    for m in _IDENTITY.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "identity", *m.span()


def spans_of(text: str | None) -> list[tuple[str, int, int, bool, float]]:
    """All spans of one text, by kind as listed, then by start."""
    found = []
    for kind, start, end in _proposed(text or ""):
        near = text[max(0, start - NEAR) : start] + "\n" + text[end : end + NEAR]
        score = min(1.0, _PRIOR[kind] + (0.3 if _CONTEXT[kind].search(near) else 0.0))
        if kind in BASE or score >= THRESHOLD:
            found.append((kind, start, end, kind in BASE, score))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("score", T.DoubleType()),
    ]
)


@F.pandas_udf(T.ArrayType(SPAN))
def _spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(SPAN.names, span, strict=True)) for span in spans_of(text)] for text in texts])


def masked(text: str | None) -> str | None:
    """``text`` with each span replaced by its kind in angle brackets; overlapping spans become the first one's kind."""
    if text is None:
        return None
    parts, done = [], 0
    for kind, start, end, *_ in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


@F.pandas_udf(T.StringType())
def _masked(texts: pd.Series) -> pd.Series:
    return pd.Series([masked(text) for text in texts], dtype=object)


def with_spans(docs: DataFrame, into: str, text_col: str = "text") -> DataFrame:
    """``docs`` and an array of spans in the column ``into``."""
    return docs.withColumn(into, _spans(col(text_col)))


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data in the text replaced by ``<KIND>``."""
    return docs.withColumns({text_col: _masked(col(text_col))})


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    texts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(texts, ",")
