"""The registered queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, exact_dedup, language_id, lm_scoring, mixing, periodic_runs, phrases, pii, secret_scan, simhash, token_counts, token_output, toxicity
from ._common import spans_text, table, work_path


def _digest(spans, kinds: tuple[str, ...]):
    return F.sha2(spans_text(F.filter(spans, lambda s: s["kind"].isin(*kinds))), 256)


def _count(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (with doc_id) and web pages (with page_id), whose markup and addresses give the further evidence."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language_id.fit(docs)
    none = F.lit(None).cast("long")
    of_docs = language_id.fuse(language_id.document_evidence(docs), model).withColumnRenamed("id", "doc_id").withColumn("page_id", none)
    of_pages = language_id.fuse(language_id.page_evidence(pages), model).withColumnRenamed("id", "page_id").withColumn("doc_id", none)
    return of_docs.unionByName(of_pages).select("doc_id", "page_id", "lang", F.round("confidence", 9).alias("confidence"), "accepted", "text_lang")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    s = F.col("pii")
    return found.select("doc_id", *(_count(s, k) for k in pii.BASE), _digest(s, pii.BASE).alias("base_sha256"), spans_text(s).alias("spans"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "virtual_finish")


OP4_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS place
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank FROM s),
c AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM w),
f AS (SELECT *, 2 * source_size AS lim, CAST(2 * source_size AS DOUBLE) / weight AS full_at FROM c),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - coalesce(CAST(sum(lim) OVER b AS DOUBLE), 0)) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS level
  FROM f WINDOW b AS (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
x AS (SELECT arg_min(level, (full_at, rank)) AS level FROM l WHERE level <= full_at),
t AS (
  SELECT source, source_size, CASE WHEN x.level IS NULL OR full_at <= x.level THEN CAST(lim AS DOUBLE) ELSE CAST(weight AS DOUBLE) * x.level END AS target
  FROM f LEFT JOIN x ON true),
q AS (
  SELECT d.doc_id, d.source, d.place, d.size, t.source_size, t.target, CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS finish
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT source, place, doc_id, size, n, CAST(n * source_size + finish AS DOUBLE) / target AS copy_finish FROM q, (SELECT unnest([0, 1]) AS n) WHERE size > 0 AND target > 0),
m AS (SELECT copy_finish, sum(size) OVER (ORDER BY copy_finish, encode(source) NULLS FIRST, place, doc_id NULLS FIRST, n ROWS UNBOUNDED PRECEDING) AS words FROM k),
e AS (SELECT min(copy_finish) AS until FROM m WHERE words >= 1.5 * (SELECT sum(size) FROM d)),
g AS (SELECT *, CASE WHEN until IS NULL THEN 2 * source_size ELSE floor(target * until) END AS given FROM q, e)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(greatest(0, least(size, given - (finish - size))) + greatest(0, least(size, given - (source_size + finish - size))) AS BIGINT) AS taken,
  CASE WHEN target > 0 THEN CAST(finish AS DOUBLE) / target END AS virtual_finish
FROM g
"""


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the upper half of the ids first, so that the second one meets the index that the first one left."""
    docs = table(spark, sf_dir, "documents")
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    return exact_dedup.ingest(docs, exact_dedup.DigestIndex(spark, work_path(spark, "digest-index")), bounds=[] if middle is None else [middle])


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_scoring.score(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return scores.select("doc_id", "n_tokens", F.round("log10_prob", 6).alias("log10_prob"), F.round("score", 6).alias("score"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.annotate(docs, known=secret_scan.identifiers(docs))
    s = F.col("secrets")
    return found.select("doc_id", *(_count(s, k) for k in secret_scan.BASE), _digest(s, secret_scan.BASE).alias("base_sha256"), spans_text(s).alias("spans"), F.array_max(s["novelty"]).alias("max_novelty"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    o = F.col("overlap")
    found = decontamination.annotate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", o["n_words"].alias("n_words"), o["n_hit"].alias("n_hit"), F.size(o["items"]).cast("long").alias("n_items"), F.sha2(F.array_join(o["items"], ","), 256).alias("items_sha256"), o["contaminated"].alias("contaminated"))


OP9_SQL = """
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM low),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(list_slice(w, k, k + least(13, len(w)) - 1), ' ') AS g
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS k FROM i WHERE len(w) > 0)),
n AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d, n WHERE len(w) >= n)),
m AS (SELECT doc_id, item, k, n FROM dw JOIN iw USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS p FROM m) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)
"""

def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    written = token_output.write(docs, work_path(spark, "shards"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return written.withColumnRenamed("docs", "doc_ids")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\\x0A-\\x0D]+')) AS piece
  FROM documents),
s AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM d),
g AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS gram
  FROM (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM s, (SELECT unnest(generate_series(1, 5)) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, gram, count(*) AS f FROM g GROUP BY lang, m, gram),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, gram, f AS a, string_split(gram, ' ') AS w FROM f WHERE m >= 2 AND f >= 100),
inside AS (
  SELECT DISTINCT lang, array_to_string(list_slice(w, i, i + k - 1), ' ') AS gram, a
  FROM (SELECT lang, w, a, k, unnest(generate_series(1, m - k + 1)) AS i FROM (SELECT lang, w, a, m, unnest(generate_series(2, m - 1)) AS k FROM c WHERE m > 2))),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.gram = c.gram AND 100 * i.a >= 100 * c.a)),
cuts AS (
  SELECT lang, gram, a, k, array_to_string(list_slice(w, 1, k), ' ') AS first, array_to_string(list_slice(w, k + 1, m), ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM kept)),
scored AS (
  SELECT u.lang, u.gram, u.a, t.n, x.f AS l, y.f AS r, u.k, CAST((1000::HUGEINT * u.a * t.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts u JOIN t USING (lang) JOIN f x ON x.lang = u.lang AND x.gram = u.first JOIN f y ON y.lang = u.lang AND y.gram = u.rest),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(gram)) AS rank FROM worst)
SELECT lang, rank, gram AS phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as they are but for a tenth of them, which gets a period of its own from some word on (ids that are missing leave texts as they are)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.when(F.expr("h % 10 = 0"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = docs.withColumn("words", words).withColumn("n", F.size("words"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n"))).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    bent = F.expr("array_join(transform(sequence(0, n - 1), i -> words[int(CASE WHEN i < a THEN i ELSE a + (i - a) % p END)]), ' ')")
    runs = F.col("repeats.runs")
    better = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    found = periodic_runs.annotate(docs.select("doc_id", F.when(F.col("a").isNotNull(), bent).otherwise(F.col("text")).alias("text")))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    best = F.aggregate(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"), better)
    found = found.withColumns({"n_runs": F.size(runs).cast("long"), "best": best, "runs_sha256": F.sha2(lines, 256), "collapsed_sha256": F.sha2("repeats.text", 256)})
    milli = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli, "runs_sha256", "collapsed_sha256")


#: Ranks of all stretches of 1, 2, 4 ... words, by doubling: where those of the first size from a period on occur next one period later, there is a run.
_RANKS = 15
OP12_SQL = (
    """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS d, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w, list_reduce(
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda h, c: CASE WHEN c >= 0 THEN xor(h, c) ELSE xor(h >> 1, CASE WHEN h & 1 = 1 THEN 3988292384 ELSE 0 END) END, CAST(4294967295 AS BIGINT)) AS inverse
  FROM documents),
e AS (SELECT d, doc_id, w, len(w) AS n, xor(inverse, 4294967295) AS h, xor(inverse, 4294967295) // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM e),
x AS MATERIALIZED (
  SELECT d, i, w[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] AS word
  FROM (SELECT *, unnest(generate_series(0, n - 1)) AS i FROM f WHERE n > 0)),
r0 AS MATERIALIZED (SELECT d, i, dense_rank() OVER (ORDER BY word) AS r FROM x),
"""
    + "".join(f"r{k + 1} AS MATERIALIZED (SELECT a.d, a.i, dense_rank() OVER (ORDER BY a.r, b.r) AS r FROM r{k} a JOIN r{k} b ON b.d = a.d AND b.i = a.i + {1 << k}),\n" for k in range(_RANKS - 1))
    + "s AS (\n  "
    + "\n  UNION ALL ".join(f"SELECT d, i, lead(i) OVER (PARTITION BY d, r ORDER BY i) - i AS q, {1 << k} AS len FROM r{k}" for k in range(_RANKS))
    + """),
t AS (SELECT *, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS island FROM s WHERE q <= len AND 2 * q > len),
runs AS MATERIALIZED (
  SELECT * FROM (SELECT d, min(i) AS start, max(i) - min(i) + any_value(len) + q AS length, q AS period FROM t GROUP BY d, q, island)
  WHERE length >= greatest(24, 3 * period)),
own AS (
  SELECT d, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first(start ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS start, first(length ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS length,
    first(period ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS period
  FROM runs GROUP BY d),
gone AS (SELECT DISTINCT d, unnest(generate_series(start + period, start + length - 1)) AS i FROM runs),
kept AS (SELECT d, string_agg(word, ' ' ORDER BY i) AS text FROM x ANTI JOIN gone USING (d, i) GROUP BY d)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM f LEFT JOIN own USING (d) LEFT JOIN kept USING (d)
"""
)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from four fifths of the labelled ids; a fifth is held out."""
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~out))
    score = F.col("toxicity.score")
    judged = toxicity.annotate(docs, model)
    return judged.select("doc_id", out.alias("held_out"), score.alias("score"), F.when(score >= 0.5, 1).otherwise(0).alias("predicted"), F.col("toxicity.hits").alias("n_hits"))


QUERIES = {"op1_language_id": op1_language_id, "op2_pii": op2_pii, "op3_simhash": op3_simhash, "op4_mixing": op4_mixing, "op5_token_counts": op5_token_counts, "op6_exact_dedup": op6_exact_dedup, "op7_lm_scoring": op7_lm_scoring, "op8_secrets": op8_secrets, "op9_decontamination": op9_decontamination, "op10_token_output": op10_token_output, "op11_phrases": op11_phrases, "op12_periodic_runs": op12_periodic_runs, "op13_toxicity": op13_toxicity}
SQL: dict[str, str] = {"op4_mixing": OP4_SQL, "op6_exact_dedup": OP6_SQL, "op9_decontamination": OP9_SQL, "op11_phrases": OP11_SQL, "op12_periodic_runs": OP12_SQL}
