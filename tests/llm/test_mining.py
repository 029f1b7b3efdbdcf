"""Phrases, periodic runs and toxicity against brute force, and on odd tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import periodic_runs, phrases, queries, toxicity
from millrace.llm.quotient_filter import Filter, Layout

from .conftest import LONG

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("words,bits", [(2, 3), (2, 20), (3, 17), (4, 17), (5, 25), (5, 30), (2, 33)])
def test_filters_lose_nothing(words, bits):
    rng = np.random.default_rng(words * bits)
    layout = Layout(words, bits)
    ids = [rng.integers(1, min(1 << bits, 9), 4000).astype(np.uint64) for _ in range(words - 1)] + [rng.integers(1, min(1 << bits, 1 << 30), 4000).astype(np.uint64)]
    ids = [np.append(c, np.repeat(c[:1], 700)) for c in ids]  # one counter above a byte
    want = Counter(zip(*(c.tolist() for c in ids), strict=True))
    placed = layout.permuted(layout.packed(ids))
    assert all((a == b).all() for a, b in zip(layout.packed(ids), layout.restored(placed), strict=True))
    for bits_of_shards in (0, 3, 16):
        halves = [Filter.of(layout, [limb[part] for limb in placed]) for part in (slice(0, 2000), slice(2000, None))]
        wires = [w for half in halves for w in half.shards(bits_of_shards)]
        found = Counter()
        for shard in {s for s, _ in wires}:
            whole = Filter.merged([Filter.from_wire(layout, s, bits_of_shards, w) for s, w in wires if s == shard])
            found.update(dict(zip(zip(*(c.tolist() for c in whole.ids()), strict=True), whole.counts.tolist(), strict=True)))
        assert found == want
    assert Filter.of(layout, [c[:0] for c in placed]).shards(3) == []


def _mined(docs, least, top):
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 6):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, seen in counts.items():
        own = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in own.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in own.items()):
                continue
            score, k = min((1000 * a * totals[lang] // (seen[p[:k]] * seen[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), seen[p[:k]], seen[p[k:]], p))
        out += [(lang, i + 1, " ".join(p), -a, x, y, totals[lang], -s) for i, (s, a, _, x, y, p) in enumerate(sorted(rows)[:top])]
    return sorted(out)


@pytest.mark.parametrize("head", [phrases.HEAD, 3, 0])
def test_phrases_against_brute_force(spark, head):
    rng = random.Random(7)
    words = ["a", "B", "c", "é", "\U0001f600", "x y", "don't", "zz", "Q\x1cq"]
    docs = [(rng.choice(["en", None, "", "de"]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", " ", ". ", "\n", "\x0b", ";"]) for _ in range(rng.randrange(40)))) for _ in range(150)]
    docs += [("en", "a a a a a a a"), ("en", None), (None, ""), ("fr", "  . "), ("en", "c c x rare c c")] * 3
    frame = spark.createDataFrame([(*d, "old", 1) for d in docs], "lang string, text string, word string, id long").repartition(5)
    for least, top in ((4, 2000), (9, 6)):
        found = sorted(map(tuple, phrases.mine(frame, least=least, top=top, head=head).collect()))
        assert found == _mined(docs, least, top) and found


def test_phrases_are_flushed_in_parts(spark, monkeypatch):
    docs = [("en", " ".join(f"w{(i * k) % 7}" for k in range(60))) for i in range(80)]
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(2)
    # bound small in this process's tasks only through arguments of the functions themselves
    layout = Layout(2, 4)
    whole = Filter.of(layout, layout.permuted(layout.packed([np.array([1, 2, 1, 3], np.uint64), np.array([2, 3, 2, 1], np.uint64)])))
    assert dict(zip(zip(*(c.tolist() for c in whole.ids()), strict=True), whole.counts.tolist(), strict=True)) == {(1, 2): 2, (2, 3): 1, (3, 1): 1}
    assert sorted(map(tuple, phrases.mine(frame, least=5).collect())) == _mined(docs, 5, 2000)


def test_phrases_of_odd_tables(spark, odd, empty):
    assert phrases.mine(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and phrases.mine(empty).count() == 0
    rows = {r.phrase: r for r in phrases.mine(odd).collect()}
    assert rows["lorem ipsum dolor lorem ipsum"].a == 19_999 and rows["lorem ipsum dolor lorem ipsum"].lang == "EN-us"


def _runs(x):
    n, out = len(x), {}
    for q in range(1, n // 3 + 1):
        k = 0
        while k < n - q:
            if x[k] != x[k + q]:
                k += 1
                continue
            s = k
            while k < n - q and x[k] == x[k + q]:
                k += 1
            if k + q - s >= max(24, 3 * q):
                out.setdefault((s, k + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


@pytest.mark.parametrize("block", [4096, 16])
def test_runs_against_brute_force(monkeypatch, block):
    monkeypatch.setattr(periodic_runs, "BLOCK", block)
    rng = random.Random(block)
    found = 0
    for _ in range(400):
        n, k, x = rng.choice([0, 5, 23, 24, 25, 30, 60, 120, 300]) + rng.randrange(10), rng.choice([1, 2, 3, 50]), []
        while len(x) < n:
            kind = rng.randrange(4)
            if kind == 0:
                x += [rng.randrange(k) for _ in range(rng.randrange(30))]
            elif kind == 1:
                word = [rng.randrange(k) for _ in range(rng.randrange(1, 40))]
                x += (word * 12)[: rng.randrange(1, 5 * len(word) + 30)]
            elif kind == 2:
                x += [rng.randrange(1000, 2000) for _ in range(rng.randrange(30))]
            elif x:
                at = rng.randrange(len(x))
                x += x[at : at + rng.randrange(60)] * rng.randrange(1, 4)
        want = _runs(x[:n])
        assert periodic_runs.runs_of(np.array(x[:n], np.int64)) == want
        found += len(want)
    assert found > 100


def test_transforms_are_exact():
    rng = np.random.default_rng(3)
    for size in (8, 64, 512):
        blocks, windows = rng.integers(0, periodic_runs.PRIME, (5, size)).astype(np.uint64), rng.integers(0, periodic_runs.PRIME, (5, 2 * size)).astype(np.uint64)
        windows[2, 3 : 3 + size] = blocks[2]
        found = periodic_runs.mismatches(blocks, windows)
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(blocks[r], windows[r, d : d + size], strict=True)) % periodic_runs.PRIME for d in range(size + 1)] for r in range(5)]
        assert found.tolist() == want and found[2, 3] == 0


def test_runs_of_long_texts_take_linear_time():
    rng = np.random.default_rng(1)
    for x in (np.zeros(400_000, np.int64), np.tile(rng.integers(0, 9, 1000), 400), np.tile(rng.integers(0, 5000, 100_000), 4)):
        assert len(periodic_runs.runs_of(x)) == 1


def test_runs_of_odd_tables(spark, odd, empty):
    found = {(r.doc_id, r.text): r.repeats for r in periodic_runs.annotate(odd).collect()}
    assert [tuple(r) for r in found[5, LONG].runs] == [(0, 60_000, 3)] and found[5, LONG].text == "lorem ipsum dolor"
    assert found[3, None].text == "" and found[6, " \t\n"].runs == [] and found[1, "a b c d"].text == "a b c d"
    again = periodic_runs.annotate(odd, out="pii")
    assert again.columns == odd.columns and periodic_runs.annotate(empty).count() == 0


def test_query_of_runs(spark):
    seen = 0
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for row in queries.op12_periodic_runs(spark, SMALL).collect():
        words, h = (texts[row.doc_id] or "").encode().split(), zlib.crc32(str(row.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = _runs(words) if len(set(words)) < n else []
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest() and row.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        seen += len(runs)
    assert seen > 5


def test_folding():
    for text in ("You IDIOT, loser", "you 1d10t - l0$er!", "you іdіоt lоsеr", "ｙｏｕ ｉｄｉｏｔ l​oser", "you !d|ot _ 1oser"):
        assert toxicity.fold(text) == " you idiot ioser "
    assert toxicity.fold("") == toxicity.fold(" .,- ") == "  "
    assert toxicity.fold("v2 100 über 3") == " v2 100 über 3 "


def _brute(text, weights, exceptions):
    words = toxicity.fold(text).split()
    found = {}
    for i, w in enumerate(words):
        own = [e for e in weights if (e == f" {w} " if e.endswith(" ") else f" {w} ".startswith(e))]
        phrases_here = [f" {' '.join(words[j:k])} " for j in range(max(0, i - 1), i + 1) for k in range(i + 1, i + 3)]
        if own and not any(p in exceptions for p in phrases_here if len(p.split()) <= 2):
            found[i] = max(own, key=len)
    return found


def test_hits_against_brute_force():
    rng = random.Random(2)
    weights = {" idiot ": 3.0, " idio": 1.0, " trash ": 2.0, " abcd": 1.5, " abcde": 0.5}
    weights = {k.replace("l", "i"): v for k, v in weights.items()}
    exceptions = {" trash can ", " idiotic ", " the abcdx "}
    automaton = toxicity.Lexicon(weights, exceptions).automaton()
    for _ in range(500):
        text = " ".join(rng.choice(["idiot", "idiotic", "trash", "can", "the", "abcdx", "abcdef", "x", "TRASH", "1diot"]) for _ in range(rng.randrange(12)))
        folded = toxicity.fold(text)
        found = toxicity.hits(folded, automaton, exceptions)
        assert {folded[:at].count(" "): e for at, (e, _) in found.items()} == _brute(text, weights, exceptions)


def _labelled(spark, n):
    rng = random.Random(4)
    plain = ["road", "house", "river", "stone", "travel", "garden"]
    docs, labels = [], []
    for i in range(n):
        words, toxic = [rng.choice(plain) for _ in range(rng.randrange(5, 60))], i % 4 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["grubble", "snarkling", "snarklet", "snarkish"])
        elif i % 8 == 1:
            words += ["grubble", "pie"] * 2
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_words_beginnings_and_exceptions_are_learned(spark):
    docs, labels = _labelled(spark, 1200)
    model = toxicity.fit(docs, labels)
    assert " grubbie " in model.lexicon.weights and " snark" in model.lexicon.weights and " grubbie pie " in model.lexicon.exceptions
    judged = {r.doc_id: r.toxicity for r in toxicity.annotate(docs, model).collect()}
    assert all((judged[r.doc_id].score >= 0.5) == (r.toxic == 1) for r in labels.collect())
    unseen = spark.createDataFrame([(1, "a snarkoid and a GRUBB1E in the garden"), (2, "grubble pie in the garden"), (3, None), (4, "")], docs.schema)
    one, two, three, four = (r.toxicity for r in toxicity.annotate(unseen, model).orderBy("doc_id").collect())
    assert one.score > 0.5 > two.score and one.hits == 2 and two.hits == 0 and three == four
    again = toxicity.fit(docs.repartition(7), labels.repartition(3))
    assert again.lexicon == model.lexicon and np.allclose(again.coefficients, model.coefficients)


def test_toxicity_of_odd_tables(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, None), (99, 0)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    scores = toxicity.annotate(odd, model)
    assert scores.columns == [*odd.columns, "toxicity"] and all(0 <= r.toxicity.score < 0.5 for r in scores.collect())
    assert toxicity.annotate(odd, model, out="fp").columns == odd.columns and toxicity.annotate(empty, toxicity.fit(empty, labels.where("false"))).count() == 0
    rude = spark.createDataFrame([(1, "idiot, moron, what trash"), (2, "the trash can of the class clown")], "doc_id long, text string")
    bad, good = (r.toxicity.score for r in toxicity.annotate(rude, model).orderBy("doc_id").collect())
    assert bad > 0.5 > good


def test_held_out_documents(spark):
    """Labels of a fifth of the ids are only looked at here."""
    at = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    judged = queries.op13_toxicity(spark, at).join(labels, "doc_id").where("held_out")
    right = judged.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("all"), F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("toxic"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("clean")).first()
    assert right["all"] > 0.975 and right["toxic"] > 0.88 and right["clean"] < 0.01
