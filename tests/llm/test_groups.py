"""Exact and near duplicates, components, mixing and language against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import components, exact_dedup, language_id, mixing, simhash
from millrace.llm._common import join_groups, table, work_path

from .conftest import LONG


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def brute_fingerprint(text: str) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    rnd = random.Random(4)
    texts = ["", " \x0b", "a", "A b", "é É x y"] + [" ".join(rnd.choice(["a", "B", "c d", "é"]) for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    expected = [brute_fingerprint(t) for t in texts]
    assert [simhash.fingerprint(t) for t in texts] == expected
    monkeypatch.setattr(simhash, "AT_ONCE", 3)
    assert [simhash.fingerprint(t) for t in texts] == expected


def test_bk_tree():
    rnd = random.Random(5)
    values = {rnd.getrandbits(64) for _ in range(50)}
    values |= {v ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for v in list(values) for _ in range(6)}
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
        tree.add(v)
    for v in list(values)[:80]:
        for radius in (0, 2, 5):
            assert sorted(tree.near(v, radius)) == sorted(x for x in values if (x ^ v).bit_count() <= radius)


def test_crowded_shards_are_cut_until_trees_are_small(spark, monkeypatch):
    """1,200 values around one, of which any two are within four bits: no tree has more than 256 members, and all are linked."""
    rnd = random.Random(13)
    center = rnd.getrandbits(63)
    values = sorted({center ^ (1 << a) ^ (1 << b) for a in range(50) for b in range(50)})
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    shards, bits = frame.selectExpr("0L AS shard", "fp", "fp AS rest"), 64
    for _ in range(3):
        shards, bits = simhash._shards(shards, bits), bits // 2
    assert shards.groupBy("shard").count().agg(F.max("count")).first()[0] <= 256
    found = [tuple(r) for r in simhash.links(frame, 100).collect()]
    assert len(set(union(found, values).values())) == 1


@pytest.mark.parametrize("cap", [1024, 3])
def test_links_connect_what_is_near(spark, cap):
    rnd = random.Random(6)
    values = [rnd.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    values += [v ^ sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, 2, 2, 3]))) for v in values for _ in range(8)]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    near = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & simhash.ALL).bit_count() <= 2]
    found = [tuple(r) for r in simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), cap).collect()]
    assert all(((a ^ b) & simhash.ALL).bit_count() <= 2 for a, b in found)
    assert union(found, values) == union(near, values)


def test_roots(spark):
    rnd = random.Random(7)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(0, i) for i in range(1, 60)]
    loose = [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)]
    pairs = chain + star + loose + [(5, 5)]
    found = dict(tuple(r) for r in components.roots(spark.createDataFrame(pairs, "a long, b long")).collect())
    expected = union(pairs, {n for p in pairs for n in p})
    assert found == {n: r for n, r in expected.items() if n != r}
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_odd_rows(odd, empty):
    out = [(r.doc_id, r.fp & simhash.ALL, r.component_id) for r in simhash.components(odd).collect()]
    assert len(out) == 10
    of = {d: (f, c) for d, f, c in out}
    assert of[1][1] == of[2][1] == of[8][1] == 1 and of[3] == of[4] == of[6] == (0, 3) and of[None][1] is None
    assert of[5][0] == brute_fingerprint(LONG)
    assert simhash.components(empty).count() == 0


def test_join_groups_with_heavy_and_light(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i}", i) for i in range(500)], "k string, v long")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m"))
    out = join_groups(rows, groups, "k", "n", 1000)
    assert out.count() == 1000 and out.where("k = 'hot'").agg(F.min("m")).first()[0] == 499


def test_exact_duplicates_and_index(spark, odd, empty):
    index = exact_dedup.DigestIndex(spark, work_path(spark, "index"), 4)
    out = exact_dedup.ingest(odd, index).collect()
    of = {r.doc_id: r for r in out}
    assert len(out) == 10 and (of[1].keep_id, of[1].group_size, of[1].kept, of[2].kept) == (2, 3, False, True)
    assert sum(r.kept for r in out) == len({r.text_sha256 for r in out})
    assert of[3].keep_id == of[4].keep_id == 4 and of[4].text_sha256 == hashlib.sha256(b"").hexdigest()
    assert of[None].keep_id is None and of[None].kept and of[5].text_sha256 == hashlib.sha256(LONG.encode()).hexdigest() and of[8].group_size == 1
    new = spark.createDataFrame([(90, "a b c d"), (91, "new"), (92, "new")], "doc_id long, text string")
    again = exact_dedup.DigestIndex(spark, index.path, 4)
    assert {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.ingest(new, again).collect()} == {90: (2, False), 91: (92, False), 92: (92, True)}
    assert again.rows().count() == again.rows().select("digest").distinct().count() == 8
    assert exact_dedup.ingest(empty, again).count() == 0
    plan = spark.table(again.table).groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    with pytest.raises(ValueError, match="4 buckets, not 8"):
        exact_dedup.DigestIndex(spark, index.path, 8)
    same = exact_dedup.DigestIndex(spark, index.path)
    assert same.buckets == 4 and exact_dedup.ingest(new, same).where("kept").count() == 0 and same.rows().count() == 8


def test_repeated_rows_keep_one_and_batches_can_be_repeated(spark):
    docs = spark.createDataFrame([(7, "a"), (7, "a"), (7, "b"), (None, "c"), (None, "c"), (1, "a")], "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, work_path(spark, "index"), 4)
    first, second = (sorted(map(str, exact_dedup.ingest(docs, index, batch="one").collect())) for _ in range(2))
    assert first == second and sum("kept=True" in r for r in first) == 3 and index.rows().count() == 3
    assert exact_dedup.ingest(docs, index, batch="two").where("kept").count() == 0


@pytest.mark.parametrize("bounds", [[], [150], [250, 100, 0]])
def test_batches_keep_the_largest_id(spark, bounds):
    rnd = random.Random(12)
    data = [(rnd.choice([None, *range(300)]), rnd.choice("abcdefgh") * rnd.randint(0, 3)) for _ in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    out = exact_dedup.ingest(docs, exact_dedup.DigestIndex(spark, work_path(spark, "index"), 4), bounds=bounds).collect()
    groups: dict = {}
    for d, t in data:
        groups.setdefault(hashlib.sha256(t.encode()).hexdigest(), []).append(d)
    assert len(out) == len(data) and all(r.group_size == len(groups[r.text_sha256]) and r.keep_id == max((d for d in groups[r.text_sha256] if d is not None), default=None) for r in out)
    kept = [r for r in out if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(groups) and all(r.doc_id == r.keep_id for r in kept)


def brute_targets(sizes: dict, share=1.5, repeats=2) -> dict:
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, (s or "").encode())), [mixing.WEIGHTS[i % 3] for i in range(len(sizes))], strict=True))
    full, left = {}, dict(sizes)
    budget = share * sum(sizes.values())
    while True:
        total = sum(weights[s] for s in left)
        over = [s for s in left if left and weights[s] * budget / total > repeats * sizes[s]]
        if not over:
            return full | {s: weights[s] * budget / total for s in left}
        for s in over:
            full[s] = repeats * sizes[s]
            budget -= full[s]
            del left[s]


@pytest.mark.parametrize("seed", range(3))
def test_mixing(spark, seed):
    rnd = random.Random(seed)
    data = [(i, " w" * rnd.choice([0, 1, 5, 40]), rnd.choice(["a", "b", "B", "é", None, "a", "a"])) for i in range(300)] + [(1, " w w", "a"), (1, " w w", "a"), (None, "w", "c")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    sizes: dict = {}
    for _, text, source in data:
        sizes[source] = sizes.get(source, 0) + text.count("w")
    goals = brute_targets(sizes)
    finished = sorted(((r.virtual_finish + n * r.source_size / r.target, r.size) for r in out if r.size for n in range(2)), key=lambda x: x[0])
    words = list(itertools.accumulate(n for _, n in finished))
    until = next(at for (at, _), n in zip(finished, words, strict=True) if n >= 1.5 * sum(sizes.values()))
    assert 1 - 1e-9 <= until < 1.1
    for s in sizes:
        own = [r for r in out if r.source == s]
        assert all(abs(r.target - goals[s]) < 1e-6 and r.source_size == sizes[s] and 0 <= r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - min(2 * sizes[s], until * goals[s])) <= 1 + 1e-6
    assert len(out) == len(data) and abs(sum(goals.values()) - 1.5 * sum(sizes.values())) < 1e-6
    assert sorted(map(repr, mixing.mix(df.repartition(7), digits=5).collect())) == sorted(map(repr, out))


def test_mixing_odd_rows(odd, empty):
    out = mixing.mix(odd).collect()
    assert len(out) == 10 and all(r.size == 0 and r.taken == 0 for r in out if r.doc_id in (3, 4, 6))
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(odd.where("doc_id = 4")).first().taken == 0


def test_language(spark, odd, empty):
    rnd = random.Random(8)
    alphabets = {"xx": ["foo", "bar", "baz", "qua"], "yy": ["çé", "éa", "ôu", "lé"]}
    data = [(i, " ".join(rnd.choice(alphabets[k]) for _ in range(30)), k, f"s{i % 3}") for i in range(200) for k in [rnd.choice(["xx", "yy"])]]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    model = language_id.fit(df)
    assert model.languages == ["xx", "yy"]
    held = spark.createDataFrame([(1000 + i, " ".join(rnd.choice(alphabets[k]) for _ in range(8)), None, None) for i, k in enumerate(["xx", "yy"] * 20)], df.schema)
    out = {r.id: r for r in language_id.fuse(language_id.document_evidence(df.unionByName(held)), model).collect()}
    assert all(out[i].lang == k and out[i].accepted for i, _, k, _ in data)
    assert sum(out[1000 + i].lang == k for i, k in enumerate(["xx", "yy"] * 20)) >= 38
    junk = spark.createDataFrame([(1, "".join(chr(rnd.randrange(33, 127)) for _ in range(400)), None, None), (2, None, "yy", None), (3, "", None, None)], df.schema)
    judged = {r.id: r for r in language_id.fuse(language_id.document_evidence(df.unionByName(junk)), model).where("id <= 3").collect() if r.id in (1, 2, 3)}
    assert (judged[1].lang, judged[1].accepted) in (("und", False), ("xx", True), ("yy", True))  # doc 1 exists twice
    assert language_id.fuse(language_id.document_evidence(junk), model).where("id = 1").first().lang == "und"
    assert language_id.fuse(language_id.document_evidence(odd), model).count() == 10
    assert language_id.fuse(language_id.document_evidence(empty), language_id.fit(empty)).count() == 0


def test_page_evidence_and_host_prior(spark):
    pages = spark.createDataFrame(
        [(1, "https://u:p@De.Ex.ORG:80/x", '<html class=a lang="de-AT"><script>var x="</p>"</script><p>a<b>c</b></html>'), (2, None, None), (3, "no url", "<html>")],
        "page_id long, url string, html string",
    )
    out = {r.id: r for r in language_id.page_evidence(pages).collect()}
    assert (out[1].declared, out[1].host, out[1].domain, out[1].suffix) == ("de", "de.ex.org", "ex.org", "org") and out[1].text.split() == ["a", "c"]
    assert (out[2].host, out[2].text, out[3].host, out[3].declared) == (None, "", None, None)
    train = spark.createDataFrame([(i, t, k) for i in range(20) for t, k in (("aaa aba", "aa"), ("ccc cdc", "cc"))], "doc_id long, text string, lang string")
    rows = spark.createDataFrame([(f"{h}{i}", t, None, h, None, None) for h, t in (("h1", "aaa aba"), ("h2", "ccc cdc")) for i in range(30)] + [("q1", "", None, "h1", None, None), ("q2", "", None, "h2", None, None)], "id string, text string, declared string, host string, domain string, suffix string")
    judged = {r.id: r.lang for r in language_id.fuse(rows, language_id.fit(train)).collect()}
    assert (judged["q1"], judged["q2"]) == ("aa", "cc")


def brute_fusion(rows: list[tuple], model: language_id.TextModel) -> dict:
    """The evidence of each row added up, from counts taken in plain Python. Rows are (id, text, declared, host, domain, suffix)."""
    names, W, E, UND = [*model.languages, "und"], language_id.HOST_WEIGHT, language_id.EVIDENCE_WEIGHT, language_id.UND
    logs = {r[0]: model.of(r[1] or "") for r in rows}
    best = {i: int(np.argmax(x)) if x.min() < 0 else None for i, x in logs.items()}
    votes = [b for b in best.values() if b is not None]
    k = len(names)
    prior = [(1 - UND) * (votes.count(i) + 1) / (len(votes) + k) for i in range(k - 1)] + [UND]
    known = lambda said: None if said is None else said if said in model.languages else "other"

    def voted(of, **same) -> list[int]:
        at = ["id", "text", "declared", "host", "domain", "suffix"]
        return [best[r[0]] for r in rows if best[r[0]] is not None and r[0] != of and all((known(r[at.index(c)]) if c == "declared" else r[at.index(c)]) == v for c, v in same.items())]

    declaring = [r for r in rows if r[2] is not None and best[r[0]] is not None]
    out = {}
    for i, _, declared, host, domain, suffix in rows:
        total = np.array(logs[i])
        if declared is not None and (own := voted(None, declared=known(declared))):
            for j in range(k):
                says = (own.count(j) + E * len(own) / len(declaring)) / (sum(best[r[0]] == j for r in declaring) + E)
                total[j] += math.log(says)
        mine, wider = (voted(i, host=host) if host else []), (voted(i, domain=domain) if domain else [])
        for j in range(k):
            smooth = (wider.count(j) + W * prior[j]) / (len(wider) + W)
            total[j] += math.log((mine.count(j) + W * smooth) / (len(mine) + W)) if host else math.log(prior[j])
        if suffix is not None and (own := voted(None, suffix=suffix)):
            at_all = sum(r[5] is not None and best[r[0]] is not None for r in rows)
            for j in range(k):
                lift = (own.count(j) + E * len(own) / at_all) / (votes.count(j) + E) / (len(own) / at_all)
                total[j] += math.log(lift)
        share = np.exp(total - total.max())
        out[i] = (names[int(np.argmax(total))], float(share.max() / share.sum()))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_fusion_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = {"xx": ["foo", "bar", "baz"], "yy": ["çé", "éa", "fôo"], "zz": ["плод", "вода"]}
    train = spark.createDataFrame([(i, " ".join(rnd.choice(words[k]) for _ in range(20)), k) for i in range(60) for k in words], "doc_id long, text string, lang string")
    rows = []
    for i in range(120):
        host = rnd.choice([None, "a.x.com", "b.x.com", "c.y.de", "y.de"])
        text = rnd.choice([None, "", "fo", " ".join(rnd.choice(words[rnd.choice("xyz") * 2]) for _ in range(rnd.randint(1, 3)))])
        rows.append((i, text, rnd.choice([None, "xx", "yy", "qq"]), host, host and ".".join(host.split(".")[-2:]), host and host.split(".")[-1]))
    model = language_id.fit(train)
    found = language_id.fuse(spark.createDataFrame(rows, "id long, text string, declared string, host string, domain string, suffix string"), model).collect()
    expected = brute_fusion(rows, model)
    assert len(found) == len(rows)
    for r in found:
        lang, chance = expected[r.id]
        if lang == r.lang:
            assert abs(r.confidence - chance) < 1e-6
        else:  # an unmodelled language that its row declares
            assert r.lang == "qq" and lang == "und"


def test_held_out_accuracy(spark):
    """Rows that the model wasn't fitted on and that declare nothing: at least 99 of 100 get the language that they are labelled with."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("lang IS NOT NULL AND length(text) >= 40").select("doc_id", "text", "lang", "source")
    model = language_id.fit(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1")
    judged = language_id.fuse(language_id.document_evidence(held.withColumn("said", F.lit(None).cast("string")), declared="said"), model)
    both = judged.join(held, F.col("id") == F.col("doc_id")).select(judged.lang, held.lang.alias("label"))
    right, n = both.where(judged.lang == F.col("label")).count(), both.count()
    assert n > 300 and right >= 0.99 * n


def test_pages_take_linear_time(spark):
    hostile = ["<script " * 50_000, "<style>" * 50_000, "<!--" * 80_000, "<html " * 50_000, "<" * 300_000, "</script" + " " * 300_000, "&amp" * 80_000, "<html " + "lang " * 60_000]
    pages = spark.createDataFrame([(i, "http://a.co.uk/", h + " tail") for i, h in enumerate(hostile)], "page_id long, url string, html string")
    began = time.time()
    out = {r.id: r for r in language_id.page_evidence(pages).collect()}
    assert time.time() - began < 20 and out[0].text.strip() == "" and out[4].text.endswith("tail") and {r.domain for r in out.values()} == {"a.co.uk"}


def test_rare_languages_keep_their_documents(spark):
    rnd = random.Random(11)
    words = {"xx": ["foo", "bar", "baz", "qua"], "yy": ["çé", "éa", "ôu", "lé"], "zz": ["плод", "вода", "небо", "лес"], "ww": ["ξένο", "λόγο", "άνεμο"]}
    data = [(i, " ".join(rnd.choice(words[k]) for _ in range(30)), k, "s") for i, k in enumerate(["xx"] * 1200 + ["yy"] * 800 + ["zz"] * 4 + ["ww"] * 3)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    for most, languages in ((language_id.LANGUAGES, ["ww", "xx", "yy", "zz"]), (2, ["xx", "yy", "other"])):
        model = language_id.fit(df, sample=400, most=most)
        assert model.languages == languages
        out = {r.id: r for r in language_id.fuse(language_id.document_evidence(df), model).collect()}
        assert all(out[i].lang == k and out[i].accepted for i, _, k, _ in data)
    model = language_id.fit(df.where("lang IN ('xx', 'yy')"))
    out = {r.id: r for r in language_id.fuse(language_id.document_evidence(df), model).collect()}
    assert all(out[i].lang == k and out[i].accepted for i, _, k, _ in data)


def test_more_languages_than_models(spark):
    codes = [a + b for a in "abcdefgh" for b in "qrstuvwxyz"]
    data = [(i * 3 + n, f"{chr(0x4E00 + 40 * i)}{chr(0x4E01 + 40 * i)}{chr(0x4E02 + 40 * i)} " * 20, k, "s") for i, k in enumerate(codes) for n in range(3)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    every = language_id.fit(df)
    assert every.languages == sorted(codes)
    silent = df.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.col("lang")))  # named by their texts alone
    assert [(r.id, r.lang) for r in language_id.fuse(language_id.document_evidence(silent), every).where("accepted").orderBy("id").collect()] == [(i, k) for i, _, k, _ in data]
    model = language_id.fit(df, most=64)
    assert len(model.languages) == 65
    assert [(r.id, r.lang) for r in language_id.fuse(language_id.document_evidence(df), model).where("accepted").orderBy("id").collect()] == [(i, k) for i, _, k, _ in data]


def test_texts_without_trigrams_are_no_evidence(spark):
    train = spark.createDataFrame([(i, t, k) for i in range(20) for t, k in (("aaa aba", "aa"), ("ccc cdc", "cc"))], "doc_id long, text string, lang string")
    kind = "id string, text string, declared string, host string, domain string, suffix string"
    full = [(f"c{i}", "ccc cdc", "cc", "h1", "d1", "x") for i in range(30)]
    blank = [(f"e{i}", (None, "", "c")[i % 3], "cc", "h1", "d1", "x") for i in range(90)] + [("only", "", "dd", "h2", None, "y"), ("none", None, None, None, None, None)]
    model = language_id.fit(train)
    out = {r.id: r for r in language_id.fuse(spark.createDataFrame(full + blank, kind), model).collect()}
    alone = {r.id: r for r in language_id.fuse(spark.createDataFrame(full, kind), model).collect()}
    assert len(out) == len(full) + len(blank) and all(r.confidence is not None for r in out.values())
    assert all(out[i].confidence == alone[i].confidence and out[i].text_lang == "cc" for i, *_ in full)
    assert all(out[i].lang == "cc" and out[i].text_lang is None for i, *_ in blank)
