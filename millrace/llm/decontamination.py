"""Benchmark decontamination with one Aho-Corasick automaton over normalised benchmark texts.

Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters. Windows of ``width``
consecutive words of each item (the whole item where it is shorter) form the automaton. Each document is normalised to
its words joined by single spaces and walked once; matches become word positions, which map back to code point offsets
of the original text. Windows of one item overlap, so a long quotation is covered from its first to its last word.

The automaton's symbols are words, so a window takes no more nodes than it has words. Windows are made in tasks and one automaton
of all is broadcast while it takes no more than ``block_bytes`` (``NODE`` bytes a word, and what names the items); otherwise pairs of window
and item are hashed into blocks within that size. Each block is broadcast, scanned for and its hits are written before
the next one; a document's hits of all blocks then meet in a grouped aggregation.

Defined results: null and empty texts have no words and are never contaminated; items without words are ignored; rows
sharing an item_id count as one item, a null item_id counts as the empty string; documents are judged one by one, so
repeated rows repeat their result, also those that an explode or a join made; long texts are walked whole; without items nothing is hit; an output name that the
input already has is replaced, other columns stay, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import free, numbered, remove, work_path

#: Words of the original text: as of the normal one, with A-Z.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes to their normal form: A-Z in lower case, what parts words to a space, the rest (and all of UTF-8 beyond ASCII) kept.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes that an automaton takes for a word of a window (measured: 46 a node), and for a window besides; windows that a task gives at once.
NODE, PAIR, AT_ONCE = 48, 512, 10_000
RESULT = "struct<n_words:long,n_hit:long,items:array<string>,spans:array<struct<start:int,end:int>>>"
ARROW_RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def normalise(text: str) -> str:
    """Words joined by single spaces, with one before the first and after the last."""
    return (b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(NORMAL).split()) + b" ").decode("utf-8", "surrogatepass")


def words_of(text: str) -> list[str]:
    normal = normalise(text)
    return normal[1:-1].split(" ") if len(normal) > 2 else []


def windows_in(text: str, width: int) -> Iterator[str]:
    """Windows of a text: words joined by single spaces."""
    words = words_of(text)
    for i in range(max(1, len(words) - width + 1) if words else 0):
        yield " ".join(words[i : i + width])


def windows_of(items: list[tuple[str, str]], width: int) -> dict[str, list[str]]:
    """Window to the items that hold it."""
    return grouped((window, item) for item, text in items for window in windows_in(text, width))


def grouped(pairs: Iterable[tuple[str, str]]) -> dict[str, list[str]]:
    found: dict[str, set[str]] = defaultdict(set)
    for window, item in pairs:
        found[window].add(item)
    return {window: sorted(names) for window, names in found.items()}


@dataclass
class Windows:
    """An automaton over numbers of words, 0 standing for words that no window has, and the words of the shortest window."""

    numbers: dict[str, int]
    found: ahocorasick.Automaton
    least: int

    def matches(self, words: list[str]) -> list[tuple[int, tuple[int, list[str]]]]:
        """Last word and window of each match. All words of a match are known, so only runs of known words that are long enough are walked."""
        number = self.numbers.get
        numbers = [number(w, 0) for w in words]
        edges = np.flatnonzero(np.diff(np.array(numbers, np.int64) > 0, prepend=False, append=False))
        found = []
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - start >= self.least:
                found += [(start + last, window) for last, window in self.found.iter(tuple(numbers[start:end]))]
        return found


#: The automaton that a Python worker built last, under the name of what it was sent: its next tasks need not build it again.
_built: dict[str, Windows | None] = {}


def built(name: str, pairs: list[tuple[str, str]]) -> Windows | None:
    if name not in _built:
        _built.clear()
        _built[name] = automaton(grouped(pairs))
    return _built[name]


def automaton(windows: dict[str, list[str]]) -> Windows | None:
    if not windows:
        return None
    numbers: dict[str, int] = {}
    least, found = None, ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window, names in windows.items():
        key = tuple([numbers.setdefault(w, len(numbers) + 1) for w in window.split(" ")])
        found.add_word(key, (len(key), names))
        least = len(key) if least is None else min(least, len(key))
    found.make_automaton()
    return Windows(numbers, found, least)


def hits(text: str, windows: Windows | None) -> tuple[int, list[str], list[tuple[int, int]]]:
    """Words of the text, items, and runs of hit words as (first, last)."""
    words = words_of(text)
    matches = windows.matches(words) if windows and words else []
    if not matches:
        return len(words), [], []
    edge = np.zeros(len(words) + 1, np.int64)
    last = np.array([end for end, _ in matches])
    np.add.at(edge, last + 1, -1)
    np.add.at(edge, last + 1 - np.array([n for _, (n, _) in matches]), 1)
    hit = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
    return len(words), sorted({item for _, (_, names) in matches for item in names}), [(int(run[0]), int(run[-1])) for run in runs]


def result(text: str, n_words: int, items: list[str], runs: list[tuple[int, int]]) -> dict:
    """Runs as spans in code points of ``text``."""
    places = [m.span() for m in WORD.finditer(text)] if runs else []
    return {"n_words": n_words, "n_hit": sum(b - a + 1 for a, b in runs), "items": items, "spans": [{"start": places[a][0], "end": places[b][1]} for a, b in runs]}


def scan(text: str, windows: Windows | None) -> dict:
    """Words, hit words, items and the spans of hit words in code points of ``text``."""
    return result(text, *hits(text, windows))


def _pairs(items: DataFrame, width: int, at: str) -> DataFrame:
    """Distinct (window, item), written to ``at``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, str]] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for window in windows_in(text, width):
                    rows.append((window, item))
                    if len(rows) == AT_ONCE:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], names=["window", "item"])
                        rows = []
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], names=["window", "item"])

    items.mapInArrow(cut, "window string, item string").distinct().write.parquet(at)
    return items.sparkSession.read.parquet(at)


def _pass(docs: DataFrame, pairs: list[tuple[str, str]], text: str, out: str) -> DataFrame:
    """All documents with the result of one automaton."""
    sent, name = docs.sparkSession.sparkContext.broadcast(pairs), uuid4().hex

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        windows = built(name, sent.value)
        for texts in batches:
            yield pa.array([scan(t or "", windows) for t in texts.to_pylist()], ARROW_RESULT)

    return docs.withColumn(out, F.arrow_udf(found, RESULT)(F.col(text)))


def _write_hits(rows: DataFrame, pairs: list[tuple[str, str]], at: str) -> None:
    """Append (row, items, runs) of the documents that a block hits."""
    sent, name = rows.sparkSession.sparkContext.broadcast(pairs), uuid4().hex

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = built(name, sent.value)
        for batch in batches:
            out = [(row, *hits(t or "", windows)[1:]) for row, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            out = [(row, names, [{"a": a, "b": b} for a, b in runs]) for row, names, runs in out if runs]
            kinds = [batch.column(0).type, pa.list_(pa.string()), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=["row", "items", "runs"])

    rows.mapInArrow(found, f"row {rows.schema.fields[0].dataType.simpleString()}, items array<string>, runs array<struct<a:int,b:int>>").write.mode("append").parquet(at)
    sent.destroy()


def _in_blocks(docs: DataFrame, pairs: DataFrame, blocks: int, text: str, out: str) -> DataFrame:
    """All documents with the results of automata that are scanned for one after another; words that several hit count once."""
    spark, row, found = docs.sparkSession, free(docs, f"{out}__row"), free(docs, f"{out}__hits")
    rows, at = numbered(docs, row), work_path(docs.sparkSession, "hits")
    own = F.pmod(F.xxhash64("window", "item"), F.lit(blocks))
    for block in range(blocks):
        _write_hits(rows.select(row, text), [tuple(r) for r in pairs.where(own == block).collect()], at)
    each = spark.read.parquet(at).groupBy(F.col("row").alias(row)).agg(F.struct(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.flatten(F.collect_list("runs")).alias("runs")).alias(found))

    def merged(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, results in batches:
            whole = []
            for t, r in zip(texts.to_pylist(), results.to_pylist(), strict=True):
                runs: list[tuple[int, int]] = []
                for a, b in sorted((x["a"], x["b"]) for x in r["runs"]) if r else ():
                    if runs and a <= runs[-1][1] + 1:
                        runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
                    else:
                        runs.append((a, b))
                whole.append(result(t or "", len(words_of(t or "")), sorted(r["items"]) if r else [], runs))
            yield pa.array(whole, ARROW_RESULT)

    return rows.join(each, row, "left").withColumn(out, F.arrow_udf(merged, RESULT)(F.col(text), F.col(found))).drop(row, found)


def annotate(docs: DataFrame, benchmark: DataFrame, width: int = 13, parts: int = 20, text: str = "text", item: str = "item_id", item_text: str = "text", out: str = "overlap", block_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` with a struct of n_words, n_hit, items, spans and contaminated.

    A document is contaminated when some words are hit and they are at least one in ``parts`` of its words.
    """
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    pairs = _pairs(items, width, at := work_path(docs.sparkSession, "windows"))
    size = pairs.agg(F.sum(NODE * (F.regexp_count("window", F.lit(" ")) + 1) + F.octet_length("window") + F.octet_length("item") + PAIR)).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    docs = _pass(docs, [tuple(r) for r in pairs.collect()], text, out) if blocks == 1 else _in_blocks(docs, pairs, blocks, text, out)
    remove(docs.sparkSession, at)
    o = F.col(out)
    hit = (o["n_hit"] > 0) & (o["n_hit"] * parts >= o["n_words"])
    return docs.withColumn(out, o.withField("contaminated", hit))
