"""Token counts without token ids.

Pieces are counted once per distinct pre-token: the corpus' pre-tokens are counted (in each task first), and the tokenizer is
asked for the number of pieces of each distinct one. Documents then need only their pre-token frequencies, joined to these
numbers and summed. Pre-tokens that make up most of the text, no more than ``HEAD`` of them and none longer than ``HEAD_LENGTH``, are joined by broadcast as
soon as a document is cut; the frequencies of all the others meet their piece counts in a shuffle join.

Works for tokenizers files with a byte-level pre-tokenizer and no normaliser; others are refused. Added special
tokens that occur in a text count as one token each, as the library has it by default.

Defined results: a null text counts as empty, with 0 bytes and tokens; rows are counted one by one, so repeated rows repeat
their result; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens
from ._common import frequent, work_path

#: Pre-tokens joined by broadcast at most, and the characters that they may have.
HEAD, HEAD_LENGTH = 1 << 17, 64
#: Entries and characters after which a task hands on what it has counted or forgets what it knows.
HOLD, HOLD_LENGTH = 1 << 17, 1 << 26
#: Rows of a batch that a task hands on, and characters.
ROWS, LENGTH = 1 << 14, 1 << 23


def special_tokens(path: str) -> list[str]:
    """Added special tokens of a tokenizers file, which must cut and merge bytes as this module assumes."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cutter = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True) or spec["model"]["type"] != "BPE":
        raise ValueError(f"{path} isn't a plain byte-level BPE tokenizer")
    return [t["content"] for t in spec["added_tokens"]]


def _cut_out(text: str, specials) -> tuple[list[str], int]:
    """The parts of a text between special tokens, and the number of these."""
    if specials is None:
        return [text], 0
    parts = specials.split(text)
    return parts, len(parts) - 1


def _frequencies(specials) -> Callable:
    """Batches of texts to batches of (pretoken, n); a pre-token may come several times."""
    def pretokens_of(found: Counter, words: Counter) -> Iterator[pa.RecordBatch]:
        names, counts, size = [], [], 0
        for own, n in chain((((p,), n) for p, n in found.items()), ((pretokens.of_word(w), n) for w, n in words.items())):
            names += own
            counts += [n] * len(own)
            size += sum(map(len, own))
            if len(names) >= ROWS or size >= LENGTH:
                yield _batch(names, counts)
                names, counts, size = [], [], 0
        yield _batch(names, counts)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        words: Counter = Counter()
        size = 0  # characters of the texts, which no entries exceed
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for part in _cut_out(text, specials)[0]:
                    whole, rest = pretokens.words(part)
                    found.update(whole)
                    words.update(rest)
                size += len(text)
                if len(found) + len(words) >= HOLD or size >= HOLD_LENGTH:
                    yield from pretokens_of(found, words)
                    found.clear()
                    words.clear()
                    size = 0
        yield from pretokens_of(found, words)

    return frequencies


def _batch(names: list[str], counts: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["pretoken", "n"])


def _pieces(path: str) -> Callable:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        for batch in batches:
            lengths = [len(tokenizer.encode(p, add_special_tokens=False)) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lengths, pa.int64())], names=["pretoken", "n", "pieces"])

    return pieces


def dictionary(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every distinct pre-token of the texts with its number of occurrences ``n`` and its number of ``pieces``."""
    specials = pretokens.specials_of(special_tokens(path))
    counts = docs.select(F.col(text)).where(F.col(text).isNotNull()).mapInArrow(_frequencies(specials), "pretoken string, n long")
    return counts.groupBy("pretoken").agg(F.sum("n").alias("n")).mapInArrow(_pieces(path), "pretoken string, n long, pieces long")


def _rows(rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["row", "pretoken", "n", "head", "doc"])


def count(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """One row per document: doc_id, n_bytes and n_tokens."""
    spark = docs.sparkSession
    specials = pretokens.specials_of(special_tokens(path))
    dictionary(docs, path, text).write.parquet(at := work_path(spark, "pretokens"))
    words = spark.read.parquet(at)
    common = frequent(words, "n", head) & (F.char_length("pretoken") <= HEAD_LENGTH)
    known = spark.sparkContext.broadcast(dict(map(tuple, words.where(common).select("pretoken", "pieces").collect())))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = known.value
        seen: dict[str, int | tuple[int, list[str]]] = {}  # pieces of a word; with the pre-tokens that aren't known, if any
        held = 0

        def look(word: str) -> int | tuple[int, list[str]]:
            nonlocal held
            held += len(word)
            if len(seen) >= HOLD or held >= HOLD_LENGTH:
                seen.clear()
                held = len(word)
            own = pretokens.of_word(word)
            others = [p for p in own if p not in pieces]
            here = sum(pieces.get(p, 0) for p in own)
            out = seen[word] = (here, others) if others else here
            return out

        for batch in batches:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), batch.column(2).type]
            rows: list[tuple] = []
            size = 0
            for row, text, doc in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                parts, total = _cut_out(text or "", specials)
                rest: Counter = Counter()
                for part in parts:
                    whole, words = pretokens.words(part)
                    for p in whole:
                        if p in pieces:
                            total += pieces[p]
                        else:
                            rest[p] += 1
                    for word, n in Counter(words).items():
                        found = seen.get(word)
                        if found is None:
                            found = look(word)
                        if found.__class__ is int:
                            total += found * n
                        else:
                            total += found[0] * n
                            for p in found[1]:
                                rest[p] += n
                rows.append((row, f"\0{row}", 0, total, doc))  # no pre-token has a digit after another character: this one joins nothing
                rows += [(row, p, n, 0, None) for p, n in rest.items()]
                size += sum(map(len, rest))
                if len(rows) >= ROWS or size >= LENGTH:
                    yield _rows(rows, kinds)
                    rows, size = [], 0
            yield _rows(rows, kinds)

    doc = F.struct(F.col(key).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"), doc.alias("doc"))
    kind = numbered.schema["doc"].dataType.simpleString()
    frequencies = numbered.mapInArrow(split, f"row long, pretoken string, n long, head long, doc {kind}")
    joined = frequencies.join(words.where(~common).select("pretoken", "pieces"), "pretoken", "left")
    tokens = F.sum(F.col("head") + F.col("n") * F.coalesce("pieces", F.lit(0)))
    return joined.groupBy("row").agg(F.first("doc", ignorenulls=True).alias("doc"), tokens.alias("n_tokens")).select("doc.doc_id", "doc.n_bytes", "n_tokens")
