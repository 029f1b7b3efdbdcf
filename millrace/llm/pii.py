"""Personal data by anchor expansion.

One Aho-Corasick automaton walks each text once and stops at anchors: at-signs, plus signs, digits,
address schemes and account cues. At each anchor a small deterministic parser expands to both
sides and validates what it finds.

Base kinds (leftmost, non-overlapping per kind; a match that fails its test is dropped, not retried):
``email``, ``ip`` (each part at most 255), ``card`` (12 to 19 digits passing Luhn), ``phone`` (9 to 15 digits).
Added kinds: ``url`` (a scheme or ``www.`` up to white space, quotes or brackets, closing punctuation left off)
and ``account`` (a cue such as ``iban`` or ``account no``, a word of its own in any case of A-Z, followed by an identifier: the longest run of
parts with digits, joined by single blanks, of at least 6 digits and at most 34 characters; an IBAN must pass its mod-97 test).

Defined results: a null text counts as empty and has no spans; rows are judged one by one, so repeated rows and
ties repeat their result; an output name that the input already has is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "www.")
CUES = ("iban", "account", "acct", "konto", "compte", "cuenta", "customer id", "passport", "ssn")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL = re.compile(r"[^\s\"'<>()\[\]{}|\\^`]+")
ACCOUNT = re.compile(r"(?:[ ]*+(?:no|nr|number|id)\b\.?)?+[ ]*+[:#=]?+[ ]*+([A-Za-z0-9](?:[ -]?[A-Za-z0-9]){0,45})", re.ASCII | re.IGNORECASE)
SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
UPPER = re.compile(r"[A-Z]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def iban(word: str) -> bool:
    code = word.replace(" ", "").replace("-", "").upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", code):
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    """Anchors with what they announce; cues and schemes in lower case."""
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for what, words in (("url", SCHEMES), ("cue", CUES)):
        for word in words:
            found.add_word(word, (what, len(word)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """The text with A-Z in lower case, at the same offsets."""
    return text.lower() if text.isascii() else UPPER.sub(lambda m: m[0].lower(), text)


def scan(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, str, int]]:
    """Spans as (start, order of kind, kind, end), sorted."""
    spans = []
    free = dict.fromkeys(KINDS, 0)  # where each kind may start again

    def found(kind: str, start: int, end: int, valid: bool) -> None:
        free[kind] = end
        if valid:
            spans.append((start, KINDS.index(kind), kind, end))

    for last, (what, length) in anchors.iter(lowered(text)):
        at = last - length + 1
        if what == "digit":
            if at >= free["ip"]:
                if m := IP.match(text, at):
                    found("ip", at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()))
                else:
                    free["ip"] = DIGITS.match(text, at).end()
            if at >= free["card"]:
                if m := CARD.match(text, at):
                    digits = _NOT_DIGIT.sub("", m[0])
                    found("card", at, m.end(), 12 <= len(digits) <= 19 and luhn(digits))
                else:
                    free["card"] = at + 1
        elif what == "at":
            start = at
            while start > free["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                found("email", start, m.end(), True)
        elif what == "plus":
            if at >= free["phone"] and (m := PHONE.match(text, at)):
                found("phone", at, m.end(), 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15)
        elif what == "url":
            if at >= free["url"] and (m := URL.match(text, last + 1)):
                end = last + 1 + len(m[0].rstrip(".,;:!?"))
                if end > last + 1:
                    found("url", at, end, True)
        elif at >= free["account"] and (at == 0 or not text[at - 1].isalnum()) and not text[last + 1 : last + 2].isalpha() and (m := ACCOUNT.match(text, last + 1)):
            word = account_word(m[1])
            if word:
                found("account", m.start(1), m.start(1) + len(word), True)
    spans.sort()
    return spans


def account_word(run: str) -> str:
    """The part of a run of words that is an account identifier, or nothing."""
    words = re.split(r"( )", run)
    for n in range(len(words), 0, -2):  # the longest run of blank-separated parts that is an IBAN
        if n <= 19 and iban("".join(words[:n])):
            return "".join(words[:n])
    found = ""
    for part in words[::2]:  # else the longest run of parts with digits
        longer = f"{found} {part}" if found else part
        if len(longer) > 34 or not DIGITS.search(part):
            break
        found = longer
    if sum(c in "0123456789" for c in found) < 6 or re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", found.replace(" ", "")):
        return ""
    return found


def _scan_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    anchors = automaton()
    for texts in batches:
        yield pa.array([[{"kind": k, "start": s, "end": e} for s, _, k, e in scan(t, anchors)] if t else [] for t in texts.to_pylist()], ARROW_SPAN)


def annotate(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with an array of (kind, start, end) in code points, sorted by start and then by kind."""
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _scan_all(batches)

    return docs.withColumn(out, F.arrow_udf(spans, SPAN)(F.col(text)))
