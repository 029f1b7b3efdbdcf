"""Toxicity by a weighted lexicon, matched with one Aho-Corasick automaton over folded texts.

Folding undoes disguise: compatibility forms and invisible characters go, letters of other scripts that look like Latin ones become these, digits and
signs within words become the letters they stand for (``1d10t``, ``l0$er``), and letters that look alike (i, l) become one. Accents stay, as they
tell words apart. What is matched are words, and beginnings of words that several words share.

Weights are log-odds of a word's documents among toxic and other ones, learned from a bounded sample of labelled rows (``SAMPLE``), with the
words of ``SEED`` as if some toxic documents had held them. Exception phrases, two words of which one is in the lexicon or single words that only
begin like an entry, take their hits out: those of ``EXCEPTIONS`` and those that the sample shows to be no sign of toxicity.

A text's hits are summed, once as they stand and once per entry, and normalised by the text's length; a logistic function of these sums, fitted on
documents that had no part in the weights they are judged by (two halves of the sample, crosswise), is the score.

Defined results: a null text counts as empty, and empty texts get the score of a text without hits; long texts are walked whole; rows are judged
one by one, so repeated rows and ties repeat their score; labels that are null, or without a document, take no part, of an id with several documents the smallest text counts; with too
few labels (``FEWEST`` of a kind) the seed's weights are judged by fixed coefficients; output names that the input already has are replaced; an empty
table gives an empty table. Of the input only the text makes a score.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled ids that the model is fitted on, by label: all, or about so many of them, chosen by their hash.
SAMPLE = {1: 8_000, 0: 24_000}
FEWEST = 20
#: Entries and learned exceptions at most: the most significant ones.
ENTRIES, LEARNED = 50_000, 20_000
#: An entry has this many toxic documents, log-odds and log-likelihood ratio at least; a beginning has this many letters, and more documents than its most frequent word by this factor.
LEAST_DOCS, LEAST_ODDS, LEAST_RATIO = 3, 1.0, 12.0
PREFIX, LONGEST, SHARED = 4, 12, 1.5
#: Toxic documents that count as seen with each seed.
SEED_DOCS = 3

# Common insults, and phrases in which such words are none.
SEED = "idiot idiots moron morons stupid dumb imbecile loser losers scum trash worthless pathetic disgusting clown garbage filth vermin dumbass asshole bastard bitch retard idiota estupido imbecil basura connard imbécile ordure dummkopf arschloch abschaum trottel".split()
EXCEPTIONS = "trash can|trash bin|trash bag|trash collection|trash talk|circus clown|class clown|clown fish|clown car|garbage collection|garbage collector|garbage truck|garbage can|soil filth|stupid simple|stupid question".split("|")

# Letters of other scripts by the Latin ones that they look like, and signs by the letters that they stand for.
LIKE = {"a": "аαɑ", "b": "вβ", "c": "сϲ", "d": "ԁ", "e": "еεҽ", "g": "ɡ", "h": "һн", "i": "іιıӏ", "j": "ј", "k": "кκ", "m": "м", "n": "ո", "o": "оοօσ", "p": "рρ", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ"}
SIGNS = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i"}

_LIKE = str.maketrans({ord(x): latin for latin, like in LIKE.items() for x in like})
_ALIKE = re.compile(f"[{''.join(LIKE.values())}]")
_SIGNS = str.maketrans(SIGNS)
_SIGN = re.compile(r"(?:(?<=[^\W\d_])|(?<![\w@$!|]))[0-9@$!|]+(?=[^\W\d_])")
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_GAP = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Folded words, each between two single blanks."""
    text = text.lower()
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text).lower()
        text = _HIDDEN.sub("", text)
        if _ALIKE.search(text):
            text = text.translate(_LIKE)
    text = _SIGN.sub(lambda m: m[0].translate(_SIGNS), text)
    return f" {_GAP.sub(' ', text).strip()} ".replace("l", "i")


@dataclass
class Lexicon:
    """Folded words (``" word "``) and beginnings of words (``" wor"``) with their weights, and exception phrases (``" two words "``)."""

    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            out.add_word(entry, (len(entry), entry, weight))
        for phrase in self.exceptions:
            out.add_word(phrase, (len(phrase), phrase, 0.0))
        out.make_automaton()
        return out


def hits(folded: str, automaton: ahocorasick.Automaton, exceptions: set[str]) -> dict[int, tuple[str, float]]:
    """The longest entry at each word that has one, by the place of the blank before it, without those within exceptions."""
    found: dict[int, tuple[str, float]] = {}
    spared: set[int] = set()
    if not len(automaton):
        return found
    for end, (size, entry, weight) in automaton.iter(folded):
        start = end - size + 1
        if entry in exceptions:
            spared.update(start + k for k, c in enumerate(entry[:-1]) if c == " ")
        elif start not in found or len(found[start][0]) < size:
            found[start] = (entry, weight)
    return {at: hit for at, hit in found.items() if at not in spared}


#: How many there are of ``features``, and their coefficients (the last is that of 1) when there is nothing to fit them on.
FEATURES = 6
DEFAULT = np.array([1.0, 1.0, 0.5, 0.5, 0.0, 0.0, -4.0])


def features(found: dict[int, tuple[str, float]], words: int) -> list[float]:
    """Sums of the hits' weights, and of those of different entries, by the length; the largest weight."""
    every, each = sum(w for _, w in found.values()), sum(dict(found.values()).values())
    norm = (words + 10) ** 0.5
    return [every / norm, each / norm, np.log1p(every), np.log1p(each), np.log1p(words), max((w for _, w in found.values()), default=0.0)]


@dataclass
class Model:
    lexicon: Lexicon
    coefficients: np.ndarray


def _seeded() -> dict[str, int]:
    return {fold(w): SEED_DOCS for w in SEED}


def _sample(docs: DataFrame, labels: DataFrame, key: str) -> tuple[DataFrame, dict[int, int]]:
    """Text, label (y) and half of a sample of labelled ids, about SAMPLE of each label, one document each; and how many each label has in all."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col("toxic").cast("int").alias("y")).distinct()
    total = {0: 0, 1: 0} | {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    place = F.xxhash64(F.col("id").cast("string"))
    most = F.when(F.col("y") == 1, 1_000_000 * SAMPLE[1] // max(1, total[1])).otherwise(1_000_000 * SAMPLE[0] // max(1, total[0]))
    chosen = F.broadcast(known.where(F.pmod(place, F.lit(1_000_000)) < most))
    rows = docs.select(F.col(key).alias("id"), "text").join(chosen, "id").groupBy("id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return rows.select("text", "y", F.pmod(F.shiftright(place, 40), F.lit(2)).cast("int").alias("half")), total


_COUNTS = "term string, y int, half int, n long"


def _counts_of(terms, batch: pa.RecordBatch, counts: Counter) -> None:
    for text, y, half in zip(*(batch.column(c).to_pylist() for c in ("text", "y", "half")), strict=True):
        counts.update((t, y, half) for t in terms(fold(text or "")))


def _rows(counts: Counter) -> pa.RecordBatch:
    columns = zip(*counts, strict=True) if counts else ((), (), ())
    out = [pa.array(list(c), k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.int32()), strict=True)]
    out.append(pa.array(list(counts.values()), pa.int64()))
    counts.clear()
    return pa.RecordBatch.from_arrays(out, ["term", "y", "half", "n"])


def _document_counts(sample: DataFrame, terms_of) -> DataFrame:
    """In how many documents of each label and half a term is; ``terms_of()`` gives a function of a folded text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = terms_of(), Counter()
        for batch in batches:
            _counts_of(terms, batch, counts)
            if len(counts) > 300_000:
                yield _rows(counts)
        yield _rows(counts)

    named = {(y, h): F.coalesce(F.sum(F.when((F.col("y") == y) & (F.col("half") == h), F.col("n"))), F.lit(0)).alias(f"n{y}{h}") for y in (0, 1) for h in (0, 1)}
    return sample.mapInArrow(count, _COUNTS).groupBy("term").agg(*named.values())


def _words(folded: str) -> set[str]:
    return {f" {w} " for w in folded.split()}


def _with_beginnings(words: DataFrame) -> DataFrame:
    """Words, and beginnings of words that aren't those of one word alone."""
    numbers = [c for c in words.columns if c != "term"]
    ends = F.sequence(F.lit(PREFIX + 1), F.least(F.length("term") - 2, F.lit(LONGEST + 1)))
    cut = words.where(F.length("term") >= PREFIX + 3).withColumn("end", F.explode(ends)).withColumn("begins", F.expr("substring(term, 1, end)"))
    most = F.max(F.col("n10") + F.col("n11"))
    begun = cut.groupBy("begins").agg(*(F.sum(n).alias(n) for n in numbers), most.alias("most"))
    shared = begun.where(F.col("n10") + F.col("n11") >= SHARED * F.col("most")).select(F.col("begins").alias("term"), *numbers)
    return words.select("term", *numbers).unionByName(shared)


def _odds(toxic: float, clean: float, totals: tuple[float, float]) -> float:
    return float(np.log((toxic + 0.5) / (totals[1] + 1)) - np.log((clean + 0.5) / (totals[0] + 1)))


def _ratio(toxic: float, clean: float, totals: tuple[float, float]) -> float:
    """How much likelier the counts are with a rate for each label than with one for all, as twice a logarithm."""
    share = (toxic + clean) / max(1, sum(totals))
    return 2 * sum(n * np.log(n / (t * share)) for n, t in ((toxic, totals[1]), (clean, totals[0])) if n and t)


def _entries(counts: list, halves: tuple[int, ...], totals: dict[tuple[int, int], int]) -> dict[str, float]:
    """Weights of the terms that are significant in the given halves."""
    total = (sum(totals[0, h] for h in halves), sum(totals[1, h] for h in halves))
    found = {}
    seeds = _seeded()
    for row in counts:
        toxic, clean = (sum(row[f"n{y}{h}"] for h in halves) for y in (1, 0))
        toxic += seeds.get(row.term, 0)
        odds = _odds(toxic, clean, total)
        if toxic >= LEAST_DOCS and odds >= LEAST_ODDS and (row.term in seeds or _ratio(toxic, clean, total) >= LEAST_RATIO):
            found[row.term] = (odds, _ratio(toxic, clean, total))
    known = {r.term for r in counts}
    found |= {s: (odds, 0.0) for s, n in seeds.items() if s not in known and (odds := _odds(n, 0, total)) >= LEAST_ODDS}
    best = sorted(found, key=lambda t: (-found[t][1], t))[:ENTRIES]
    return {t: found[t][0] for t in best}


def _phrases(lexicon: Lexicon):
    """A function of a folded text that gives the phrases around its hits, and the words that only begin like an entry."""

    def terms() -> object:
        automaton = lexicon.automaton()

        def of(folded: str) -> set[str]:
            out = set()
            for at, (entry, _) in hits(folded, automaton, lexicon.exceptions).items():
                end = folded.index(" ", at + 1)
                if not entry.endswith(" "):
                    out.add(folded[at : end + 1])
                if at:
                    out.add(folded[folded.rindex(" ", 0, at) : end + 1])
                if end + 1 < len(folded):
                    out.add(folded[at : folded.index(" ", end + 1) + 1])
            return out

        return of

    return terms


def _spared(counts: DataFrame, halves: tuple[int, ...], totals: dict[tuple[int, int], int]) -> set[str]:
    total = (sum(totals[0, h] for h in halves), sum(totals[1, h] for h in halves))
    toxic, clean = (sum((F.col(f"n{y}{h}") for h in halves), F.lit(0)) for y in (1, 0))
    rare = (toxic + 0.5) * (total[0] + 1) <= (clean + 0.5) * (total[1] + 1)
    rows = counts.where((clean >= LEAST_DOCS) & rare).orderBy(clean.desc(), "term").limit(LEARNED).select("term").collect()
    return {r.term for r in rows}


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> Model:
    """Lexicon, exceptions and coefficients from documents and the ``toxic`` labels (0 or 1) of their ids."""
    own = {fold(p) for p in EXCEPTIONS}
    sample, all_rows = _sample(docs, labels, key)
    sample = sample.persist()
    try:
        totals = {(y, h): 0 for y in (0, 1) for h in (0, 1)} | {(r.y, r.half): r["count"] for r in sample.groupBy("y", "half").count().collect()}
        if min(totals[y, 0] + totals[y, 1] for y in (0, 1)) < FEWEST:
            return Model(Lexicon(dict.fromkeys(_seeded(), 4.0), own), DEFAULT)
        terms = _with_beginnings(_document_counts(sample, lambda: _words))
        # what is no rarer among toxic documents than among others
        telling = terms.where((F.col("n10") + F.col("n11") >= LEAST_DOCS) | F.col("term").isin(*_seeded()))
        total = (totals[0, 0] + totals[0, 1] + 1, totals[1, 0] + totals[1, 1] + 1)
        telling = telling.where((F.col("n10") + F.col("n11") + 0.5 + SEED_DOCS) * total[0] >= (F.col("n00") + F.col("n01") + 0.5) * total[1])
        counts = telling.orderBy((F.col("n10") + F.col("n11")).desc(), "term").limit(4 * ENTRIES).collect()
        every = {halves: _entries(counts, halves, totals) for halves in ((0, 1), (0,), (1,))}
        around = _document_counts(sample, _phrases(Lexicon(every[0, 1], own)))
        around = around.where(F.col("n00") + F.col("n01") >= LEAST_DOCS).persist()
        lexicons = {halves: Lexicon(weights, own | _spared(around, halves, totals)) for halves, weights in every.items()}
        around.unpersist()
        return Model(lexicons[0, 1], _coefficients(sample, lexicons, all_rows))
    finally:
        sample.unpersist()


def _coefficients(sample: DataFrame, lexicons: dict[tuple[int, ...], Lexicon], all_rows: dict[int, int]) -> np.ndarray:
    """Of a logistic regression on features by the lexicon of the other half; each label weighs as it does among all rows."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {half: (lexicons[(1 - half,)].automaton(), lexicons[(1 - half,)].exceptions) for half in (0, 1)}
        for batch in batches:
            rows = []
            for text, half in zip(batch.column("text").to_pylist(), batch.column("half").to_pylist(), strict=True):
                folded = fold(text or "")
                rows.append(features(hits(folded, *known[half]), len(folded.split())))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("y")], ["x", "y"])

    rows = sorted((r.y, r.x) for r in sample.mapInArrow(judge, "x array<double>, y int").collect())
    x, y = np.array([[*r[1], 1.0] for r in rows]), np.array([r[0] for r in rows], float)
    share = np.array([all_rows[int(v)] / max(1, np.sum(y == v)) for v in y])
    share *= len(share) / share.sum()
    return _regression(x, y, share)


def _regression(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton's method with a small penalty on all but the constant, steps halved while they don't help."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[-1] = 1
    x, w = x / scale, np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((share * (np.logaddexp(0, z) - y * z)).sum() + (penalty * w * w).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (share * (p - y)) + penalty * w
        step = np.linalg.solve((x.T * (share * p * (1 - p))) @ x + np.diag(penalty + 1e-9), gradient)
        size, now = 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w / scale


def annotate(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a struct of the score (0 to 1), the entries that were hit and the number of hits."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        automaton, exceptions = model.lexicon.automaton(), model.lexicon.exceptions
        for texts in batches:
            x, entries, sizes = [], [], []
            for t in texts.to_pylist():
                folded = fold(t or "")
                found = hits(folded, automaton, exceptions)
                x.append([*features(found, len(folded.split())), 1.0])
                entries.append(sorted({e.strip() for e, _ in found.values()}))
                sizes.append(len(found))
            z = np.array(x).reshape(-1, FEATURES + 1) @ model.coefficients
            score = np.round(1 / (1 + np.exp(-np.clip(z, -40, 40))), 9)
            yield pa.StructArray.from_arrays([pa.array(score), pa.array(entries, pa.list_(pa.string())), pa.array(sizes, pa.int64())], ["score", "entries", "hits"])

    return docs.withColumn(out, F.arrow_udf(judge, "struct<score: double, entries: array<string>, hits: long>")(F.col(text)))
