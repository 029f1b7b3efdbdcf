"""Rows are told apart, columns keep their names, ids are of any type; what queries return against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import decontamination, exact_dedup, language_id, mixing, queries
from millrace.llm._common import free, numbered, table, work_path

from .conftest import LONG
from .test_spans import PII, SECRET, brute

SMALL = "/root/testdata/sf0.001"


def test_rows_of_exploded_and_joined_files_are_told_apart(spark):
    docs = table(spark, SMALL, "documents")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("text"))
    twice = docs.join(spark.range(2).withColumnRenamed("id", "n"), F.col("n") >= 0)
    for frame in (lines, twice, docs.unionByName(docs), docs.groupBy("text").count(), docs.where("doc_id > 3").select("text")):
        rows = numbered(frame, "_row")
        assert rows.select("_row").distinct().count() == rows.count() == frame.count()
    assert free(docs.withColumn("_Row", F.lit(1)).withColumn("__row", F.lit(1)), "_row") == "___row"


def test_blocks_of_the_benchmark_see_the_same_rows(spark):
    docs, benchmark = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("text")).withColumns({"overlap__row": F.lit("mine"), "overlap__hits": F.lit(7)})
    whole, parts = (decontamination.annotate(lines, benchmark, block_bytes=b) for b in (32 << 20, 20_000))
    assert whole.columns == parts.columns == [*lines.columns, "overlap"]
    assert Counter(map(repr, whole.collect())) == Counter(map(repr, parts.collect()))
    assert whole.where("overlap.n_hit > 0").count() > 2 and parts.where("overlap__row = 'mine' AND overlap__hits = 7").count() == lines.count()


CLASHING = ("_row", "_copies", "overlap", "__row", "_copy", "size", "source_size", "place", "n", "id", "toxicity")


def test_stages_keep_columns_whatever_their_names(spark, odd):
    docs = odd.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"own {c}" for r in rows for c in CLASHING)
        known = Counter(map(repr, docs.collect()))
        assert set(map(repr, rows)) <= set(known)
    last = corpus_pipeline.write_tokens(spark, docs, SMALL)
    assert last.count() > 0


def test_stages_walk_long_texts(spark):
    """What matters stands behind 400,000 characters."""
    item = max((r.text for r in table(spark, SMALL, "benchmark").collect()), key=len)
    docs = spark.createDataFrame([(1, LONG + f"{item} " * (4000 // len(item.split())), "en", "s"), (2, LONG, "en", "s"), (3, LONG + "and an end of its own", "en", "s")], "doc_id long, text string, lang string, source string")
    assert sorted(r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, SMALL).collect()) == [2, 3]
    assert corpus_pipeline.identify_language(spark, docs, SMALL).count() == 3
    assert {r.text for r in corpus_pipeline.mix_sources(spark, docs, SMALL).collect()} <= {r.text for r in docs.collect()}
    tokens = corpus_pipeline.write_tokens(spark, docs, SMALL)
    assert sorted({d for r in tokens.collect() for d in r.doc_ids}) == [1, 2, 3]


@pytest.mark.parametrize("kind", ["string", "int", "decimal(20,0)"])
def test_ids_of_any_type(spark, kind):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (None, "b"), (30, "c")], "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    index = exact_dedup.DigestIndex(spark, work_path(spark, "index"), 4)
    out = {(r.doc_id, r.text_sha256): r for r in exact_dedup.ingest(docs, index).collect()}
    digest = hashlib.sha256(b"a").hexdigest()
    ids = {r.doc_id for r in docs.collect()} - {None}
    assert len(out) == 4 and out[max(i for i in ids if int(i) < 3), digest].kept
    again = exact_dedup.DigestIndex(spark, index.path)
    assert again.id_type == kind and exact_dedup.ingest(docs, again).where("kept").count() == 0
    with pytest.raises(ValueError, match="ids of type"):
        exact_dedup.ingest(docs.withColumn("doc_id", F.lit(1.5)), again)


def test_crowds_of_equal_rows_are_spread(spark):
    """A third of the rows are equal and without id."""
    docs = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("w x "), "id")).otherwise("same words").alias("text"), F.lit("s").alias("source"))
    sized = docs.select("doc_id", "source", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place"), F.lit(2).cast("long").alias("size"))
    spread = mixing._spread(mixing.cut(sized))
    sizes = [r["count"] for r in spread.groupBy(F.substring("place", 1, 1).alias("bin")).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * min(sizes)
    small = mixing.cut(sized.limit(900))
    assert small.select("place").collect() == mixing._spread(small).select("place").collect()
    mixed = mixing.mix(docs, digits=2)
    taken = mixed.agg(F.sum("taken"), F.max(F.col("taken") / F.col("size")), F.first("target")).first()
    assert mixed.count() == 30_000 and abs(taken[0] - taken[2]) < 0.01 * taken[2] and taken[1] <= 2


def test_models_are_what_counts_say(spark):
    """Log-probabilities of a few trigram classes from all texts, counted anew."""
    rows = [(0, "abcabc", "aa"), (1, "abd", "aa"), (2, "xyz", "bb"), (3, None, "bb"), (4, "abc", None)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb"]
    counts = {"aa": Counter(t[i : i + 3] for _, t, k in rows if k == "aa" for i in range(len(t) - 2)), "bb": Counter(["xyz"])}
    import numpy as np

    for at, lang in enumerate(model.languages):
        total = sum(counts[lang].values()) + language_id.ALPHA * language_id.CLASSES
        for gram in ("abc", "bca", "xyz", "qqq"):
            place = int(next(language_id.trigrams(gram))[0])
            want = np.log((1 - language_id.NOISE) * (counts[lang][gram] + language_id.ALPHA) / total + language_id.NOISE / language_id.CLASSES)
            assert abs(model.table[place, at] - want) < 1e-5


def _texts(spark):
    return {r.doc_id: r.text or "" for r in table(spark, SMALL, "documents").collect()}


def _digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in spans).encode()).hexdigest()


@pytest.mark.parametrize("query,patterns,names", [("op2_pii", PII, ("email", "ip", "card", "phone")), ("op8_secrets", SECRET, ("assign", "access", "hex"))])
def test_spans_that_queries_return(spark, query, patterns, names):
    texts, rows = _texts(spark), queries.QUERIES[query](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = brute(texts[r.doc_id], patterns)
        assert r.base_sha256 == _digest(want)
        assert tuple(r[f"n_{k}"] for k in names) == tuple(sum(s[2] == k for s in want) for k in names)
        assert {f"{k}:{s}:{e}" for s, _, k, e in want} <= set(r.spans.split(",")) | {""}


def test_fingerprints_and_components_that_the_query_returns(spark):
    texts, rows = _texts(spark), {r.doc_id: r for r in queries.op3_simhash(spark, SMALL).collect()}
    prints = {}
    for doc, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[doc] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    docs = sorted(texts)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {d: (r.fingerprint, r.component_id) for d, r in rows.items()} == {d: (f"{prints[d]:016x}", find(d)) for d in docs}


def test_token_counts_that_the_query_returns(spark):
    texts, tokenizer = _texts(spark), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) for d, t in texts.items()}
    rows = queries.op5_token_counts(spark, SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {d: (len(t.encode()), want[d], want[d] > 1024) for d, t in texts.items()}
    assert isinstance(rows[0].__fields__, list) and queries.op5_token_counts(spark, SMALL).schema["n_tokens"].dataType == T.LongType()
