"""Stupid-backoff language-model scores, computed relationally.

Texts become token ids of a public byte-level vocabulary, each text after a begin mark; they are encoded once, into a table. A table of
all bigram counts of the corpus is aggregated in each task, then by hash, and written; counts of single tokens follow from it and are
bounded by the vocabulary. Every document is scored by the rest of the corpus: its own counts are taken off first.

    S(w | v) = c(v w) / c(v)            if the rest of the corpus has v w
               0.4 * c(w) / N           else, if it has w
               0.4 * 0.4 / vocabulary   else

Each document is exploded into its distinct bigrams, which are joined to the table by hash, and their logarithms are summed per document.
Bigrams that make up at least ``SHARE`` of all occurrences, of which there are no more than 1 / ``SHARE`` in a corpus of any size, would be
hot keys of that join; their counts are broadcast and they never leave the task that reads the document. What a bigram is worth if
seen, but for its count, and if unseen, is known before the join and travels with it.

Defined results: a null text counts as empty; a text without tokens has score null; rows are documents of their own, so a repeated
row finds its copies in the rest of the corpus; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import work_path
from .token_output import END, Encoder

SHARE, BACKOFF, VOCABULARY = 2e-6, 0.4, 1 << 16
#: Bigrams that a task holds before it merges them, and before it hands them on; rows of a batch; tokens that are scored at once.
MERGE, HOLD, ROWS, AT_ONCE = 1 << 22, 1 << 22, 1 << 16, 1 << 18
#: How the table of ids is written.
TABLE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary#ids": "false"}


def encoded(docs: DataFrame, ranks_path: str, at: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc, ids): a number for each row, its id and its 16-bit token ids, as a table written to ``at``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(F.col(key).alias("doc_id")).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path)
        for batch in batches:
            ids = pa.array([encoder.ids(t)[:-2] if t else b"" for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids], names=["row", "doc", "ids"])

    rows.mapInArrow(encode, f"row long, doc {kind}, ids binary").write.options(**TABLE).parquet(at)
    return docs.sparkSession.read.parquet(at)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams of several encoded texts, first token * 65536 + second, and the number of each one's text."""
    lengths = np.array([len(t) // 2 for t in texts], np.int64)
    second = np.frombuffer(b"".join(texts), "<u2").astype(np.int64)
    first = np.concatenate((second[:0], [END], second[:-1]))[: len(second)]
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = END
    return (first << 16) | second, np.repeat(np.arange(len(texts)), lengths)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _batches(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(columns[0]), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[k : k + ROWS]) for c in columns], names=names)


def counts(ids: DataFrame) -> DataFrame:
    """Every bigram of the encoded texts with its number of occurrences."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)
        keys, ns, raw, size = empty, empty, [], 0
        for batch in batches:
            raw.append(joined(batch.column(0).to_pylist())[0])
            size += len(raw[-1])
            if size >= MERGE:
                new, n = np.unique(np.concatenate(raw), return_counts=True)
                keys, ns = _summed(np.concatenate((keys, new)), np.concatenate((ns, n)))
                raw, size = [], 0
                if len(keys) >= HOLD:
                    yield from _batches([keys, ns], ["gram", "n"])
                    keys, ns = empty, empty
        if raw:
            new, n = np.unique(np.concatenate(raw), return_counts=True)
            keys, ns = _summed(np.concatenate((keys, new)), np.concatenate((ns, n)))
        yield from _batches([keys, ns], ["gram", "n"])

    return ids.select("ids").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _by_token(table: DataFrame, token) -> np.ndarray:
    """Counts by token, as an array over the vocabulary."""
    out = np.zeros(VOCABULARY, np.int64)
    for token, n in table.groupBy(token.cast("int").alias("token")).agg(F.sum("n").alias("n")).collect():
        out[token] = n
    return out


def _parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about AT_ONCE tokens, or one text."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) // 2 > AT_ONCE:
            yield start, i
            start, size = i, 0
        size += len(t) // 2
    if texts:
        yield start, len(texts)


def exploded(ids: DataFrame, as_first: np.ndarray, as_second: np.ndarray, grams: np.ndarray, totals: np.ndarray) -> DataFrame:
    """A row for each document, with what its heavy bigrams are worth, and one for each other distinct bigram of it, with what that is worth.

    ``grams`` are the heavy ones, sorted, with their ``totals``. A document's own row has a key below all bigrams, so that it joins nothing.
    """
    sent = ids.sparkSession.sparkContext.broadcast((as_first, as_second, grams, totals))
    names = ["row", "gram", "own", "seen", "unseen", "tokens", "doc"]

    def worth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_first, as_second, grams, totals = sent.value
        n_all = int(as_second.sum())
        for batch in batches:
            texts, rows = batch.column(2).to_pylist(), batch.column(0).to_numpy()
            for start, end in _parts(texts):
                n = end - start
                keys, of = joined(texts[start:end])
                found, own = np.unique((of << 32) | keys, return_counts=True)
                doc, gram = found >> 32, found & 0xFFFFFFFF
                tokens = np.bincount(doc, own, n).astype(np.int64)
                at_first = np.flatnonzero(np.diff(found >> 16, prepend=-1))  # sorted, so a history's bigrams follow each other
                own_first = np.repeat(np.add.reduceat(own, at_first), np.diff(at_first, append=len(found))) if len(found) else own
                _, same = np.unique((doc << 16) | (gram & 0xFFFF), return_inverse=True)
                own_second = np.bincount(same, own)[same] if len(found) else own
                single = as_second[gram & 0xFFFF] - own_second
                with np.errstate(divide="ignore", invalid="ignore"):
                    seen = -np.log10((as_first[gram >> 16] - own_first).astype(float))
                    unseen = np.where(single > 0, np.log10(BACKOFF * single / np.maximum(n_all - tokens[doc], 1)), np.log10(BACKOFF * BACKOFF / VOCABULARY))
                at = np.searchsorted(grams, gram)
                heavy = grams[np.minimum(at, len(grams) - 1)] == gram if len(grams) else np.zeros(len(gram), bool)
                left = totals[at[heavy]] - own[heavy]
                with np.errstate(divide="ignore", invalid="ignore"):
                    value = np.where(left > 0, np.log10(left.astype(float)) + seen[heavy], unseen[heavy])
                summed = np.bincount(doc[heavy], value * own[heavy], n).astype(float)
                mine, docs = rows[start:end], batch.column(1).slice(start, n)
                lead = [mine, -1 - mine, np.ones(n, np.int32), np.zeros(n), summed, tokens]
                yield pa.RecordBatch.from_arrays([*map(pa.array, lead), docs], names=names)
                others = ~heavy
                rest = [mine[doc[others]], gram[others], own[others].astype(np.int32), seen[others], unseen[others]]
                for k in range(0, len(rest[0]), ROWS):
                    part = [pa.array(c[k : k + ROWS]) for c in rest]
                    yield pa.RecordBatch.from_arrays([*part, pa.array(np.zeros(len(part[0]), np.int64)), pa.nulls(len(part[0]), docs.type)], names=names)

    kind = ids.schema["doc"].dataType.simpleString()
    return ids.select("row", "doc", "ids").mapInArrow(worth, f"row long, gram long, own int, seen double, unseen double, tokens long, doc {kind}")


def score(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text", share: float = SHARE) -> DataFrame:
    """One row per document: doc_id, n_tokens, log10_prob (of all its tokens) and score, its mean."""
    spark = docs.sparkSession
    ids = encoded(docs, ranks_path, work_path(spark, "token-ids"), key, text)
    counts(ids).write.parquet(at := work_path(spark, "bigrams"))
    table = spark.read.parquet(at)
    as_first, as_second = _by_token(table, F.shiftright("gram", 16)), _by_token(table, F.col("gram").bitwiseAND(0xFFFF))
    heavy = F.col("n") >= F.lit(share * float(as_second.sum()))
    top = table.where(heavy).sort("gram").toArrow()
    parts = exploded(ids, as_first, as_second, top["gram"].to_numpy(), top["n"].to_numpy())
    found = parts.join(table.where(~heavy).withColumnRenamed("n", "total"), "gram", "left")
    left = F.coalesce("total", F.lit(0)) - F.col("own")
    value = F.when(left > 0, F.log10(left) + F.col("seen")).otherwise(F.col("unseen")) * F.col("own")
    summed = found.groupBy("row").agg(F.first("doc", ignorenulls=True).alias("doc"), F.sum("tokens").alias("n_tokens"), F.sum(value).alias("log10_prob"))
    return summed.select("doc.doc_id", "n_tokens", "log10_prob", F.when(F.col("n_tokens") > 0, F.col("log10_prob") / F.col("n_tokens")).alias("score"))
