"""The registered queries on the smallest tables, against their SQL where they have it, and the pipeline against what its stages promise."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from millrace.llm import queries
from millrace.llm._common import numbered, table

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    rows = df.collect()
    if name not in queries.SQL:
        assert rows
        return
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    cursor = con.execute(queries.SQL[name])
    at = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(at) == cols
    assert sorted(repr([r[c] for c in cols]) for r in rows) == sorted(repr([r[at[c]] for c in cols]) for r in cursor.fetchall())


def test_pipeline(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name == "token_output":
            rows = out.collect()
            assert sorted(r.slot for r in rows) == list(range(len(rows))) and {d for r in rows for d in r.doc_ids} == seen["mixing"].keys()
            break
        assert out.columns == columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        seen[name] = Counter(r.doc_id for r in docs.collect())
        assert all(tuple(before[r.doc_id]) == tuple(r) for r in docs.collect())
    assert len(seen["language_id"]) == len(before)
    groups = queries.op3_simhash(spark, SMALL).collect()
    assert seen["near_dedup"] == Counter(r.doc_id for r in groups if r.doc_id == r.component_id)
    hit = {r.doc_id for r in queries.op9_decontamination(spark, SMALL).collect() if r.contaminated}
    assert seen["decontamination"] == Counter({d: 1 for d in seen["near_dedup"] if d not in hit})
    assert max(seen["mixing"].values()) <= 2 and set(seen["mixing"]) <= set(seen["decontamination"])


def test_pipeline_without_documents(spark):
    docs = table(spark, SMALL, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0


def test_rows_of_files_are_told_apart_without_a_copy(spark, odd, tmp_path):
    odd.repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for frame, copied in ((docs, False), (docs.where("doc_id > 0"), False), (odd, True)):
        rows = numbered(frame, "_row")
        first, again = ({r._row: tuple(r)[:-1] for r in rows.collect()} for _ in range(2))
        assert first == again and len(first) == frame.count() and (len(rows.inputFiles()) > 0 and "numbered-" in rows.inputFiles()[0]) == copied
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.select("doc_id", "text", "lang", "source"), SMALL)
    assert kept.count() == 5


def test_pipeline_rows_without_ids_or_with_shared_ids(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()
    assert Counter((r.doc_id, (r.text or "").lower().strip()[:7]) for r in kept) == Counter([(1, "a b c d"), (3, ""), (None, "x y z"), (5, "lorem i"), (7, "é中\U0001f600 \x00​")])
    clean = [(None if i % 3 else i % 2, f"the cat {i} sat on the mat by the {i * 7} dogs and looked around " * 3, "en", "s") for i in range(60)]
    noise = "".join(chr(33 + i * i * 7 % 94) for i in range(900))
    mixed = spark.createDataFrame([*clean, (None, noise, None, None), (0, noise, None, None)], docs.schema)
    found = Counter(map(tuple, corpus_pipeline.identify_language(spark, mixed, SMALL).collect()))
    assert found == Counter(clean)
    copies = spark.createDataFrame([(None, "x y z", "en", "s")] * 5 + [(4, "x y z", "en", "s"), (4, "x y z", "en", "s"), (4, "p q r s t u v", "en", "s")], docs.schema)
    assert Counter(map(tuple, corpus_pipeline.drop_near_duplicates(spark, copies, SMALL).collect())) == Counter([(4, "x y z", "en", "s"), (4, "p q r s t u v", "en", "s")])
    nameless = spark.createDataFrame([(None, "w " * 10 + str(i), "en", s) for s in "ab" for i in range(100)], docs.schema)
    taken = Counter(r.source for r in corpus_pipeline.mix_sources(spark, nameless, SMALL).collect())
    assert taken == {"a": 200, "b": 100}
    assert corpus_pipeline.write_tokens(spark, corpus_pipeline.mix_sources(spark, docs, SMALL), SMALL).count() > 0
