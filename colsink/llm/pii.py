"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Kinds with a plain rule (email, ip, card, phone) are reported whenever the rule holds.
Two more are added by the method: ``iban`` (a proposed account number whose mod-97
remainder is 1) and ``ssn`` (a number in 3-2-4 form that a nearby word names). Context
counts where it stands as a whole word: "ssn" in "classname" is none. Each span carries
its score, so that a caller may ask for more certainty than the kinds' own rules do.
Every pattern is written so that a text is scanned in linear time.

Defined cases: null and empty texts have no spans; repeated rows each get theirs; spans
that begin at one place (ties) are ordered by kind as listed; very long texts are scanned
whole; an empty table stays empty. A column that has the result's name is replaced, all
other columns stay as they are.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colsink.llm.common import read_table
from colsink.llm.spans import Span, digest, in_order, mask_udf, spans_udf

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

#: Words that raise the score of a kind when they stand within ``NEAR`` characters.
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write to"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "telephone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer"),
    "ssn": ("ssn", "social security"),
}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.5, "iban": 0.9, "ssn": 0.3}
NEAR, LIFT, REPORT = 40, 0.2, 0.5
_CONTEXT = {k: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")s?(?!\w)") for k, words in CONTEXT.items()}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its start only: a match from inside it would fail or succeed alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
# Chains of fewer than 12 digits can't pass, and starts within them are shorter still.
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """The Luhn sum of a digit string is a multiple of ten."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """ISO 7064 check of an account number without spaces."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        if m := _DOMAIN.match(text, at):
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = m.end()
                found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def _score(kind: str, text: str, start: int, end: int) -> float:
    # one character more on the outside tells whether a word goes on there
    before, after = text[max(0, start - NEAR - 1) : start].lower(), text[end : end + NEAR + 1].lower()
    named = _CONTEXT[kind].search(before, min(len(before), int(start > NEAR))) or _CONTEXT[kind].search(after)
    return min(1.0, PRIOR[kind] + LIFT * bool(named))


def find_pii(text: str) -> list[Span]:
    """All spans of a text, by start and then kind."""
    found: list[Span] = []

    def add(kind: str, start: int, end: int) -> None:
        base, score = kind in BASE_KINDS, _score(kind, text, start, end)
        if base or score >= REPORT:
            found.append((kind, start, end, score, base))

    if "@" in text:
        for start, end in _emails(text):
            add("email", start, end)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x) < 4 and int(x or 0) <= 255 for x in (part.lstrip("0") for part in m[0].split("."))):
                add("ip", *m.span())
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if len(digits) <= 19 and luhn(digits):
                add("card", *m.span())
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    add("phone", *m.span())
        for m in _IBAN.finditer(text):
            # the chain may run on into words that follow: the longest valid length decides
            chars = [i for i in range(m.start(), m.end()) if text[i] != " "]
            for n in range(min(34, len(chars)), 14, -1):
                end = chars[n - 1] + 1
                if (n == len(chars) or text[end] == " ") and mod97("".join(text[i] for i in chars[:n])):
                    add("iban", m.start(), end)
                    break
        for m in _SSN.finditer(text):
            add("ssn", *m.span())
    return in_order(found, KINDS)


pii_spans = spans_udf(find_pii)
mask_pii = mask_udf(find_pii)


def with_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Each row with its spans in ``into``; null and empty texts have none, repeated rows each get theirs."""
    return docs.withColumn(into, pii_spans(docs[text].cast("string")))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each row with its spans masked as ``[KIND]``; columns and rows stay as they are."""
    return docs.withColumn(text, mask_pii(docs[text].cast("string")))


def op9_checked_spans(spark, sf_dir: str) -> DataFrame:
    """Personal data of every whole text of ``documents`` (null: empty).

    ``n_spans`` counts the spans of all kinds, ``scores`` has one for each, in the order of ``spans``.
    """
    docs = with_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    scores = F.concat_ws(",", F.transform("pii", lambda x: F.format_number(x["score"], 1)))
    added = [F.size("pii").cast("long").alias("n_spans"), scores.alias("scores")]
    return docs.select("doc_id", *[c.alias(n) for n, c in digest(docs["pii"], BASE_KINDS).items()], *added)
