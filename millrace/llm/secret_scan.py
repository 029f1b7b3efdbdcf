"""Secret scans by dictionary-primed zstandard novelty.

A candidate is a run of secret-like characters. Two zstandard frames are measured with a dictionary primed with the
identifiers of the corpus, which a grouped aggregation counts over all texts: the text around the candidate without it, and with it. The difference, its marginal bytes over its length, is
its novelty: words, repeated strings and identifiers cost little, random strings nearly the entropy of their alphabet.
Novel candidates are reported as ``novel`` if any part of them is within ``REACH`` characters before or after a sensitive word.
Every run of 12 characters or more is measured. Common words prime the dictionary, and runs without digits, which may be
words and names, must be more novel than others: see ``NOVEL_WORD``.

Base kinds (leftmost, non-overlapping per kind; a match that fails its test is dropped, not retried): ``assign``
(a password, secret, token or key name, ``:`` or ``=`` and a value of at least 12 characters; the span is the whole
assignment), ``access`` (AKIA and capitals or digits, at least 18 characters), ``hex`` (at least 16 lower hex digits).
These always stay; the method adds ``novel`` spans that no base span covers.

Defined results: a null text counts as empty; rows are judged one by one, so repeated rows repeat their result; an output
name that the input already has is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "novel")
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Words after which a novel string is taken for a secret, and the reach of each in characters.
SENSITIVE = re.compile(r"passw|passwd|passphrase|pwd|secret|token|credential|api[_ -]?key|private[_ -]?key|access[_ -]?key|client[_ -]?id|auth|bearer|session|signature|login", re.ASCII | re.IGNORECASE)
REACH = 64
#: A text without any of these holds no sensitive word, in whatever case.
STEMS = ("passw", "passphrase", "pwd", "secret", "token", "credential", "key", "client", "auth", "bearer", "session", "signature", "login")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~-]{12,}", re.ASCII)
DIGIT = re.compile(r"[0-9]")
#: Characters of surrounding text that a candidate is measured against, on each side; and the longest piece measured at once.
AROUND, PIECE = 256, 4096
#: Marginal bytes per character from which a candidate is novel. Random hex digits cost about 0.5, base64 about 0.75.
NOVEL = 0.45
#: The same for runs without digits. Random letters cost over 0.65, in lower case not all that are short; most words cost less.
NOVEL_WORD = 0.65
#: Words of identifiers: runs of letters beside what joins or follows names in code. They are shorter than any candidate, so no secret becomes one.
IDENTIFIER = r"(?<![A-Za-z0-9])[A-Za-z]{3,11}(?=[_=:(]|\.[A-Za-z])|(?<=[_]|[A-Za-z]\.)[A-Za-z]{3,11}(?![A-Za-z0-9])"
#: A text without any of these holds no identifier either.
JOINED = r"[_=:(]|\.[A-Za-z]"
#: The most frequent of them prime the dictionary, this many.
MOST = 4000
#: Identifiers that prime the dictionary where no corpus is at hand.
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key private_key client_id client_secret authorization bearer session_id "
    "username user_name email config settings environment production development database connection localhost default value "
    "string integer boolean return function class import export const public static void null true false self this request "
    "response header content-type application/json http https www.example.com index version description license copyright"
).split()
#: Long words that often stand near sensitive ones.
COMMON = (
    "authentication authenticated authenticator authoritative administrator administration application applications architecture availability "
    "certificate certification communication communications compatibility configuration configurations confidential consideration "
    "cryptographic customization decryption deployment description development directory distribution documentation encryption "
    "environment established expiration following functionality identification implementation implementations independent individual "
    "information infrastructure initialization installation instructions integration international investigation management "
    "manufacturer microservices multi-factor notification opportunities organization organizations participants particularly "
    "performance permissions professional publication recommendation registration relationship representative representatives repository "
    "requirements responsibilities responsibility signatures significant significantly specification specifications subscription "
    "successfully synchronization technologies transaction transactions transformation understanding unfortunately universities verification"
).split()
RESULT = "array<struct<kind:string,start:int,end:int,novelty:double>>"
ARROW_RESULT = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())]))


class Novelty:
    """Marginal compressed bytes per character under a primed dictionary."""

    def __init__(self, known: tuple[str, ...] | list[str]):
        primed = zstandard.ZstdCompressionDict(" ".join([*COMMON, *known]).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=3)
        self.frame = zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)

    def size(self, text: str) -> int:
        return len(self.frame.compress(text.encode("utf-8", "surrogatepass")))

    def of(self, text: str, start: int, end: int) -> float:
        """Of ``text[start:end]``, against what stands around it; long candidates piece by piece."""
        before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
        cost = 0
        for at in range(start, end, PIECE):
            piece = text[at : min(end, at + PIECE)]
            cost += self.size(before + after + piece) - self.size(before + after)
            before = text[max(0, at + len(piece) - AROUND) : at + len(piece)]
        return cost / (end - start)


def identifiers(docs: DataFrame, text: str = "text", most: int = MOST) -> list[str]:
    """The ``most`` frequent words of identifiers in all texts, in lower case, the most frequent last; of equal counts the first in the alphabet."""
    words = docs.where(F.col(text).rlike(JOINED)).select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(IDENTIFIER), F.lit(0))).alias("word"))
    ranked = words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return [r.word for r in reversed(ranked.collect())]


def base(text: str, lower: str | None = None) -> list[tuple[int, int, str, int]]:
    """Base spans as (start, order of kind, kind, end), sorted; ``lower`` is the text in lower case, if it is known."""
    spans = [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text)]
    lower = text.lower() if lower is None else lower
    if any(name in lower for name in NAMES):
        spans += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    return sorted(spans)


def scan(text: str, novelty: Novelty, least: float = NOVEL) -> list[dict]:
    lower = text.lower()
    spans = base(text, lower)
    covered = sorted((s, e) for s, _, _, e in spans)
    scores = {(s, e): novelty.of(text, s, e) for s, e in covered}
    words = list(SENSITIVE.finditer(text)) if any(stem in lower for stem in STEMS) else []
    ends, taken = [w.end() for w in words], 0
    for m in CANDIDATE.finditer(text) if words else ():
        start, end = m.span()
        near = bisect_right(ends, start - REACH)  # the first word that reaches the run from the left, or stands after it
        if near == len(words) or words[near].start() - REACH >= end:
            continue
        while taken < len(covered) and covered[taken][1] <= start:
            taken += 1
        if not any(s < end for s, _ in covered[taken:taken + 1]):
            score = novelty.of(text, start, end)
            if score >= (least if DIGIT.search(m[0]) else max(least, NOVEL_WORD)):
                spans.append((start, 3, "novel", end))
                scores[start, end] = score
    return [{"kind": k, "start": s, "end": e, "novelty": round(scores[s, e], 6)} for s, _, k, e in sorted(spans)]


def annotate(docs: DataFrame, text: str = "text", out: str = "secrets", known: tuple[str, ...] | list[str] = tuple(IDENTIFIERS), least: float = NOVEL) -> DataFrame:
    """``docs`` with an array of (kind, start, end, novelty), in code points, sorted by start and then by kind; ``known`` are identifiers."""
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        novelty = Novelty(known)
        for texts in batches:
            yield pa.array([scan(t, novelty, least) if t else [] for t in texts.to_pylist()], ARROW_RESULT)

    return docs.withColumn(out, F.arrow_udf(found, RESULT)(F.col(text)))
