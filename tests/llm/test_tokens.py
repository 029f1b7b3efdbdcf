"""Token counts, language-model scores and token output against the libraries and brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import lm_scoring, pretokens, token_counts, token_output
from millrace.llm._common import table, work_path

from .conftest import LONG

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(9)
    parts = [" ", " ", "\n", "a", "b", "é", "1", ".", "'s", "\t", "　", "<|endoftext|>", "½", "\x1c", "\x85", "ع", "՘", "Hello", " world"]
    fixed = [None, "", " ", "  ", "a  b", "a   b  ", "x<|endoftext|>y", "it's we'll", "a \n b", "\x000 \x001", "q" * 3000, " " * 60_000 + "x", "₏Ᲊ"]
    return fixed + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 16))) for _ in range(800)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i // 2, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, pretoken string")


@pytest.mark.parametrize("head", [token_counts.HEAD, 5])
def test_counts_are_the_librarys(docs, texts, head):
    tokenizer = Tokenizer.from_file(JSON)
    expected = Counter((i // 2, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts))
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count(docs, JSON, head=head).collect()) == expected


def test_counts_of_no_rows_and_wrong_tokenizers(docs):
    assert token_counts.count(docs.where("false"), JSON).count() == 0
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.special_tokens(public_tokenizers.path("word_bpe_49k.json"))


def test_words_hold_the_pretokens(texts):
    for text in texts:
        whole, rest = pretokens.words(text or "")
        assert whole + [p for w in rest for p in pretokens.of_word(w)] == pretokens.cut(text or "")


@pytest.mark.parametrize("share", [0, 0.02, 2])
def test_scores(spark, share):
    rnd = random.Random(10)
    data = [(i, " ".join(rnd.choice(["red", "green", "blue", "zq"]) for _ in range(rnd.randint(1, 12)))) for i in range(60)] + [(70, None), (71, ""), (72, "unheard"), (1, "red red"), (1, "red red")]
    encoder = token_output.Encoder(RANKS)
    tokens = [encoder.encode(t or "") for _, t in data]
    pairs = [list(zip([lm_scoring.END, *x[:-1]], x, strict=True)) if x else [] for x in tokens]
    bigrams = Counter(p for x in pairs for p in x)
    first, second = Counter(), Counter()
    for (a, b), n in bigrams.items():
        first[a] += n
        second[b] += n
    total = sum(second.values())

    def score(x):
        out = 0.0
        own, heads, tails = Counter(x), Counter(a for a, _ in x), Counter(b for _, b in x)
        for a, b in x:
            if bigrams[a, b] > own[a, b]:
                out += math.log10((bigrams[a, b] - own[a, b]) / (first[a] - heads[a]))
            elif second[b] > tails[b]:
                out += math.log10(0.4 * (second[b] - tails[b]) / (total - len(x)))
            else:
                out += math.log10(0.16 / lm_scoring.VOCABULARY)
        return out

    expected = sorted((d, len(x), round(score(x), 6)) for (d, _), x in zip(data, pairs, strict=True))
    found = lm_scoring.score(spark.createDataFrame(data, "doc_id long, text string"), RANKS, share=share).collect()
    assert sorted((r.doc_id, r.n_tokens, round(r.log10_prob, 6)) for r in found) == expected
    assert all((r.score is None) == (r.n_tokens == 0) for r in found)


def test_scores_of_no_rows_and_odd_rows(docs, odd):
    assert lm_scoring.score(docs.where("false"), RANKS).count() == 0
    out = lm_scoring.score(odd, RANKS).collect()
    of = {r.doc_id: r for r in out}
    assert len(out) == 10 and of[3].score is None and of[4].n_tokens == 0 and of[5].n_tokens == len(token_output.Encoder(RANKS).encode(LONG)) and of[1] == of[2].__class__(1, *of[2][1:])


def test_texts_are_scored_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(lm_scoring, "AT_ONCE", 40)
    texts = [b"\0" * 2 * n for n in (0, 10, 30, 1, 0, 90, 5, 40)]
    assert list(lm_scoring._parts(texts)) == [(0, 3), (3, 5), (5, 6), (6, 7), (7, 8)] and list(lm_scoring._parts([])) == []


def test_heavy_bigrams_are_bounded_and_others_are_joined(spark, tmp_path):
    """Bigrams of less than the share meet the table in a join, and on the benchmark table there are more of these than documents."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    ids = lm_scoring.encoded(docs, RANKS, f"{tmp_path}/ids")
    grams = lm_scoring.counts(ids).cache()
    total = grams.agg(F.sum("n")).first()[0]
    heavy = sorted((r.gram, r.n) for r in grams.where(F.col("n") >= lm_scoring.SHARE * total).collect())
    assert len(heavy) <= 1 / lm_scoring.SHARE
    few = [h for h in heavy if h[1] >= 1e-4 * total]
    first, second = (lm_scoring._by_token(grams, c) for c in (F.shiftright("gram", 16), F.col("gram").bitwiseAND(0xFFFF)))
    parts = lm_scoring.exploded(ids, first, second, np.array([g for g, _ in few]), np.array([n for _, n in few]))
    assert parts.where("gram >= 0").join(grams, "gram").count() == parts.where("gram >= 0").count() > docs.count()


def test_ids_of_many_texts_are_those_of_each(texts):
    encoder = token_output.Encoder(RANKS)
    blank = [c for c in map(chr, range(0x10000)) if c.isspace()]
    odd = ["'", "''", "it's,'s 's", "5", "5a,b", "é", " é,", "\n\n", " \n", "\r\na", "\n" * 60_000 + "x", *(f"a{c} \n b{c}\n{c} c,{c}" for c in blank), *(f"{c} x{c}" for c in blank)]
    for some in (texts, odd, [*texts, *odd] * 2, [None], [""], []):
        assert list(encoder.many(pa.array(some, pa.string()))) == [encoder.ids(t or "") for t in some]
    assert list(encoder.many(pa.array(["x", "a b", None]).slice(1))) == [encoder.ids("a b"), encoder.ids("")]


def test_what_comes_up_again_is_encoded_once():
    encoder, seen = token_output.Encoder(RANKS), []

    class Counting:
        def encode_ordinary(self, text):
            seen.append(text)
            return library.encode_ordinary(text)

    library, encoder.encoding = encoder.encoding, Counting()
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdeé") for _ in range(9)) for _ in range(300)]
    some = [" ".join(rnd.choice(words) + rnd.choice(["", ",", ".\n"]) for _ in range(200)) for _ in range(100)]
    assert list(encoder.many(pa.array(some))) == [np.array([*library.encode_ordinary(t), token_output.END], "<u2").tobytes() for t in some]
    assert sum(map(len, seen)) < sum(map(len, some)) / 10


@pytest.mark.parametrize("domain", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(domain):
    numbers = np.arange(domain)
    slots = token_output.permute(numbers, domain, "k")
    assert sorted(slots) == list(numbers) and (token_output.permute(slots, domain, "k", back=True) == numbers).all()
    if domain >= 64:
        assert (slots != token_output.permute(numbers, domain, "other")).any() and (slots != numbers).any()


def test_shards_round_trip(spark, docs, texts):
    path = work_path(spark, "shards")
    some = docs.repartition(3, "doc_id")
    out = token_output.write(some, path, RANKS, length=16, per_shard=40).orderBy("number").collect()
    assert [r.number for r in out] == list(range(len(out))) and sorted(r.slot for r in out) == list(range(len(out)))
    assert all((r.shard, r.byte_offset) == (r.slot // 40, r.slot % 40 * 32) for r in out)
    reader = token_output.Reader(path)
    ids = list(reader.read())
    assert len(ids) == len(out) and (next(reader.read(57)) == ids[57]).all()
    stream = np.concatenate([ids[r.slot][: r.n_tokens] for r in out])
    encoder = token_output.Encoder(RANKS)
    found = Counter(x.tobytes() for x in np.split(stream, np.flatnonzero(stream == token_output.END) + 1) if len(x))
    assert found == Counter(encoder.ids(t or "") for t in texts)
    assert {d for r in out for d in r.docs} == {i // 2 for i in range(len(texts))}
    assert token_output.manifest(spark, path).count() == len(out)


def test_a_repeated_job_leaves_whole_shards_and_mends_others(spark, docs):
    path = work_path(spark, "shards")
    some, base = docs.repartition(3, "doc_id").persist(), path.removeprefix("file://")

    def state() -> dict[str, tuple[bytes, int]]:
        return {p.name: (p.read_bytes(), p.stat().st_mtime_ns) for p in Path(base).glob("shard-*")}

    first = token_output.write(some, path, RANKS, length=16, per_shard=40).orderBy("slot").collect()
    before = state()
    whole, names = {n: b for n, (b, _) in before.items()}, sorted(before)
    assert len(names) > 8
    Path(base, names[1]).write_bytes(whole[names[1]][:100])
    Path(base, names[2]).write_bytes(whole[names[2]][:64] + b"xx" + whole[names[2]][66:])
    Path(base, names[3]).write_bytes(whole[names[3]] + b"more")
    Path(base, names[4]).unlink()
    Path(base, f"{names[5]}.77").write_bytes(b"left")
    Path(base, "shard-999999.bin").write_bytes(b"of a larger job")
    assert token_output.write(some, path, RANKS, length=16, per_shard=40, partitions=4).orderBy("slot").collect() == first
    after = state()
    assert {n: b for n, (b, _) in after.items()} == whole
    assert [n for n in names if after[n][1] == before[n][1]] == [n for i, n in enumerate(names) if i not in (1, 2, 3, 4)]
    other = token_output.write(some, path, RANKS, "another order", length=16, per_shard=40).orderBy("slot").collect()
    assert {n: b for n, (b, _) in state().items()} != whole and [r.ids_sha256 for r in other] != [r.ids_sha256 for r in first]
    assert [hashlib.sha256(x.tobytes()).hexdigest() for x in token_output.Reader(path).read()] == [r.ids_sha256 for r in other]


def test_shards_of_odd_rows(spark, odd):
    path = work_path(spark, "shards")
    out = token_output.write(odd, path, RANKS, length=64, per_shard=8).collect()
    encoder = token_output.Encoder(RANKS)
    assert sum(r.n_tokens for r in out) == sum(len(encoder.encode(r.text or "")) + 1 for r in odd.collect()) and {d for r in out for d in r.docs} == {1, 2, 3, 4, 5, 6, 7, 8, None}


def test_shards_of_no_rows(spark, docs):
    path = work_path(spark, "shards")
    assert token_output.write(docs.where("false"), path, RANKS).count() == 0 and list(token_output.Reader(path).read()) == []
