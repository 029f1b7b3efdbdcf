"""Token ids in training order, as fixed-stride binary shards.

Texts become token ids, each text closed by the end-of-text id, and are packed into sequences of ``length`` ids in the order in
which they are read; the last sequence of a task is padded with end-of-text ids. The texts of an Arrow batch are cut where
the vocabulary's pattern always cuts, and each different piece is encoded once. Sequences are numbered without gaps over all tasks.
A keyed Feistel network over the next even power of two, walked along its cycles until it is back among the numbers in
use, permutes these numbers: every sequence gets a global slot of its own and the training order needs no shuffle buffer.
Range partitions of the slots write shards of ``per_shard`` sequences; every sequence takes the same number of bytes, so slot s
is found by arithmetic and a training run reads on from any slot, shard after shard.

A shard is written under a temporary name and renamed when it is whole, so a lost task leaves nothing half-written. A task that is
repeated, and a job that is run again, compare each shard with the file that is there while they make it: one that is the same stays as it is, else
what was the same is copied and the rest written, so nothing stale is ever kept. What lost tasks left is deleted at the end.
A partition writes one shard, or several that follow each other where there would be more than ``PARTITIONS``. Ids are little-endian 16-bit.

Defined results: a null text counts as empty and gives only its end-of-text id; repeated rows give repeated tokens; an empty
table gives no shards; sequences carry the ids of their documents in order, null ids included; other columns are left out.
The order of packing, and so the numbers, follow the input's partitions; the same input and settings give the same shards.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import pretokens
from ._common import remove, work_path

LENGTH, PER_SHARD, ROUNDS = 1024, 4096, 6
#: Range partitions that write shards, at most.
PARTITIONS = 50_000
END = 50256
#: How the table of sequences is written: ids are large and repeat each other, so pages are compressed well.
TABLE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.enable.dictionary#ids": "false", "parquet.page.size": str(8 << 20)}
#: Sequences that prime the compression of the others on their way to the shards: they hold the common ids.
PRIMER = 64
#: White space of this length is left to a pattern library without a stack.
RUN = 50_000
BLANK = re.compile(rf"\s{{{RUN}}}")
#: Kinds of bytes: within characters beyond ASCII, white space, letters, digits, others.
BEYOND, WHITE, LETTER, DIGIT, OTHER = range(5)
KIND = np.array([WHITE if c in b" \t\n\v\f\r" else LETTER if chr(c).isalpha() else DIGIT if chr(c).isdigit() else OTHER for c in range(128)] + [BEYOND] * 128, np.uint8)
#: White space beyond ASCII; texts that hold it are encoded whole.
WIDE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: What pieces that don't start with a space are encoded after: a space, which tells where a piece starts, and a digit, which none of them goes on from.
LEAD = " 1"


class Encoder:
    """16-bit ids of texts."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pretokens.PATTERN.pattern, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for token, i in ranks.items() if token.startswith(b" ")]] = True

    def encode(self, text: str) -> list[int]:
        """The library's pattern runs out of stack on very long white space; such texts are cut here and encoded piece by piece."""
        if len(text) > RUN and BLANK.search(text):
            return [i for piece in pretokens.cut(text) for i in self.encoding._encode_single_piece(piece)]
        return self.encoding.encode_ordinary(text)

    def ids(self, text: str) -> bytes:
        """Ids of the text and the end-of-text id."""
        return np.array([*self.encode(text), END], "<u2").tobytes()

    def many(self, texts: pa.Array) -> Iterator[bytes]:
        """``ids`` of each text, null counting as empty; a piece that comes up again in these texts is encoded once."""
        texts = texts.cast(pa.large_string()).fill_null("")
        wide = pc.match_substring_regex(texts, WIDE)
        ends, data = _buffers(pc.if_else(wide, pa.scalar("", pa.large_string()), texts))
        at = _cuts(ends, data)
        pieces = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)).dictionary_encode()
        flat, starts, sizes = self._encoded(pieces.dictionary)
        closing = [np.array([END], "<u2"), *(np.array([*self.encode(t), END], "<u2") for t in texts.filter(wide).to_pylist())]
        starts, sizes = _appended(starts, sizes, len(flat), closing)
        flat = np.concatenate([flat, *closing])

        wide = wide.to_numpy(zero_copy_only=False)
        upto = np.searchsorted(at, ends[1:])
        which = np.insert(pieces.indices.to_numpy(), upto, len(pieces.dictionary) + np.where(wide, np.cumsum(wide), 0))
        size = sizes[which]
        stop = np.cumsum(size)
        out = flat[np.arange(size.sum()) + np.repeat(starts[which] - stop + size, size)].tobytes()
        begin = 0
        for end in (2 * stop[upto + np.arange(len(upto))]).tolist():
            yield out[begin:end]
            begin = end

    def _encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different pieces, and where in these the ids of each piece start and how many they are.

        Pieces are encoded in one go where each has one space before what isn't white space, its own or that of LEAD, and no other:
        there the pattern always cuts, so an id that starts with a space is the first one of a piece. The few others are encoded one by one.
        """
        at, data = _buffers(pieces)
        first, second = (data[np.minimum(at[:-1] + i, len(data) - 1)] for i in (0, 1))
        size, spaces = np.diff(at), np.diff(np.concatenate([[0], np.cumsum(data == ord(" "))])[at])
        spaced = (first == ord(" ")) & (size > 1) & (KIND[second] != WHITE)
        joined = (spaces == spaced) & (spaced | np.isin(KIND[first], (WHITE, LETTER, OTHER))) & (size < RUN)
        lead = pc.if_else(pa.array(spaced[joined]), pa.scalar("", pa.large_string()), pa.scalar(LEAD, pa.large_string()))
        _, text = _buffers(pc.binary_join_element_wise(lead, pieces.filter(pa.array(joined)), pa.scalar("", pa.large_string())))
        flat = np.array(self.encoding.encode_ordinary(text.tobytes().decode()), "<u2")
        begin = np.flatnonzero(self.spaced[flat])
        if len(begin) != joined.sum():
            raise ValueError(f"{joined.sum()} pieces became {len(begin)}")
        skipped = np.where(spaced[joined], 0, len(self.encoding.encode_ordinary(LEAD)))
        alone = [np.array(self.encode(p), "<u2") for p in pieces.filter(pa.array(~joined)).to_pylist()]
        order = np.argsort(np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)]))
        starts, sizes = _appended(begin + skipped, np.diff(np.append(begin, len(flat))) - skipped, len(flat), alone)
        return np.concatenate([flat, *alone]), starts[order], sizes[order]


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text starts and the last one ends, and the bytes of all."""
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1] if at and len(texts) else np.zeros(1, np.int64)
    return at - at[0], np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]


def _cuts(ends: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Where texts without WIDE characters fall apart into pieces that have the same ids alone: before ASCII white space, and between a letter and a mark."""
    kind, cut = KIND[data], np.zeros(len(data) + 1, bool)
    before, here = kind[:-1], kind[1:]
    cut[1:-1] = ((here == WHITE) & (before != WHITE)) | ((here == OTHER) & (before == LETTER))
    cut[ends] = True
    return np.flatnonzero(cut)


def _appended(starts: np.ndarray, sizes: np.ndarray, end: int, more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of ids when ``more`` follow at ``end``."""
    size = np.array([len(x) for x in more], np.int64)
    return np.concatenate([starts, end + np.cumsum(size) - size]), np.concatenate([sizes, size])


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permute(numbers: np.ndarray, domain: int, key: str, back: bool = False) -> np.ndarray:
    """Keyed permutation of 0 .. domain - 1, or its inverse."""
    half = np.uint64(max(1, -(-max(domain - 1, 1).bit_length() // 2)))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8], "little")) for r in range(ROUNDS)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & low
        for k in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (_mixed(left ^ k) & low), left
            else:
                left, right = right, left ^ (_mixed(right ^ k) & low)
        return (left << half) | right

    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        out[todo] = once(out[todo])
        todo = todo[out[todo] >= domain]
    return out.astype(np.int64)


def sequences(docs: DataFrame, at: str, ranks_path: str, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Packed sequences: task, number within the task, ids in use, their documents, and the unpadded ids, as a table written to ``at``."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder(ranks_path), TaskContext.get().partitionId()
        names, stride = ["task", "n", "n_tokens", "docs", "ids"], 2 * length
        pending, held, n = bytearray(), [], 0
        key_kind = pa.int64()

        def rows(full: list[tuple]) -> pa.RecordBatch:
            columns = zip(*full, strict=True) if full else [[]] * 4
            kinds = [pa.int64(), pa.int32(), pa.list_(key_kind), pa.binary()]
            cols = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([task] * len(full), pa.int32()), *cols], names=names)

        for batch in batches:
            key_kind, full = batch.column(0).type, []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.many(batch.column(1)), strict=True):
                at = 0
                while at < len(ids):
                    part = ids[at : at + stride - len(pending)]
                    pending += part
                    held.append(doc)
                    at += len(part)
                    if len(pending) == stride:
                        full.append((n, length, held, bytes(pending)))
                        pending, held, n = bytearray(), [], n + 1
            yield rows(full)
        if pending:
            yield rows([(n, len(pending) // 2, held, bytes(pending))])

    packed = docs.select(F.col(key), F.col(text)).mapInArrow(pack, f"task int, n long, n_tokens int, docs array<{kind}>, ids binary")
    packed.write.options(**TABLE).parquet(at)
    return spark.read.parquet(at)


def _primed(primer: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(primer or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def slotted(packed: DataFrame, key: str, per_shard: int = PER_SHARD) -> tuple[DataFrame, int, bytes]:
    """Sequences with their global number, slot and shard, ids compressed for the way to their shards; how many; what primed them.

    The numbers where tasks start are one small row for each task that read the input, so they are broadcast.
    """
    tasks = packed.groupBy("task").agg(F.count("*").alias("sequences"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.select("task", F.coalesce(F.sum("sequences").over(before), F.lit(0)).alias("start"))
    total = packed.count()
    primer = b"".join(r.ids for r in packed.select("ids").limit(PRIMER).collect())

    def slots(numbers: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in numbers:
            yield pa.array(permute(batch.to_numpy(zero_copy_only=False), total, key))

    def smaller(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        frame = zstandard.ZstdCompressor(level=3, dict_data=_primed(primer))
        for batch in ids:
            yield pa.array([frame.compress(x) for x in batch.to_pylist()], pa.binary())

    numbered = packed.join(F.broadcast(starts), "task").withColumn("number", F.col("start") + F.col("n"))
    placed = numbered.withColumns({"slot": F.arrow_udf(slots, "long")(F.col("number")), "ids": F.arrow_udf(smaller, "binary")(F.col("ids"))})
    return placed.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("int")), total, primer


def shard_name(shard: int) -> str:
    return f"shard-{shard:06d}.bin"


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


class ShardWriter:
    """One shard after another; a shard that is there with the same bytes isn't written again."""

    def __init__(self, path: str, attempt: int):
        self.files, self.base = _filesystem(path)
        self.attempt, self.shard, self.size, self.old, self.out = attempt, None, 0, None, None

    def begin(self, shard: int) -> None:
        self.shard, self.size, self.out = shard, 0, None
        self.at = f"{self.base}/{shard_name(shard)}"
        there = self.files.get_file_info(self.at)
        self.length = there.size if there.type == pafs.FileType.File else None
        self.old = None if self.length is None else self.files.open_input_stream(self.at)

    def add(self, ids: bytes) -> None:
        if self.out is None and (self.old is None or self.old.read(len(ids)) != ids):
            self._rewrite()
        if self.out is not None:
            self.out.write(ids)
        self.size += len(ids)

    def _rewrite(self) -> None:
        """From here on the shard isn't what is there: write a new one, which begins as the old one does."""
        self._close()
        self.out = self.files.open_output_stream(f"{self.at}.{self.attempt}")
        if self.size:
            with self.files.open_input_stream(self.at) as same:
                left = self.size
                while left:
                    part = same.read(min(left, 1 << 20))
                    self.out.write(part)
                    left -= len(part)

    def _close(self) -> None:
        if self.old is not None:
            self.old.close()
            self.old = None

    def finish(self, want: int) -> bool:
        """Whether the shard had to be written."""
        if self.size != want:
            raise ValueError(f"{shard_name(self.shard)} has {self.size} bytes instead of {want}")
        if self.out is None and self.length != want:
            self._rewrite()
        self._close()
        if self.out is None:
            return False
        self.out.close()
        if self.length is not None:
            self.files.delete_file(self.at)  # not every store replaces a file by renaming another
        self.files.move(f"{self.at}.{self.attempt}", self.at)
        return True


def _tidy(files: pafs.FileSystem, base: str, shards: int) -> None:
    """Delete what lost tasks left, and shards beyond the last one."""
    for info in files.get_file_info(pafs.FileSelector(base)):
        m = re.fullmatch(r"shard-(\d{6,})\.bin(\.\d+)?", info.base_name)
        if m and (m[2] or int(m[1]) >= shards):
            files.delete_file(info.path)


def write(docs: DataFrame, path: str, ranks_path: str, order_key: str = "order", length: int = LENGTH, per_shard: int = PER_SHARD, key: str = "doc_id", text: str = "text", partitions: int = PARTITIONS) -> DataFrame:
    """Write the shards of ``docs`` below ``path`` (a URI that all executors share) and return one row per sequence.

    Columns: number, slot, shard, byte_offset in its shard, n_tokens without padding, docs, ids_sha256 of the padded ids.
    """
    spark = docs.sparkSession
    packed = work_path(spark, "sequences")
    placed, total, primer = slotted(sequences(docs, packed, ranks_path, length, key, text), order_key, per_shard)
    stride, shards = 2 * length, -(-total // per_shard)
    files, base = _filesystem(path)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/layout.json") as out:
        out.write(json.dumps({"sequences": total, "length": length, "per_shard": per_shard, "dtype": "<u2", "order_key": order_key}).encode())

    def shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, pad = zstandard.ZstdDecompressor(dict_data=_primed(primer)), END.to_bytes(2, "little")
        writer = ShardWriter(path, TaskContext.get().taskAttemptId())

        def finish() -> None:
            writer.finish(stride * (min(total, (writer.shard + 1) * per_shard) - writer.shard * per_shard))

        for batch in batches:
            digests = []
            for own, packed in zip(batch.column(2).to_pylist(), batch.column(6).to_pylist(), strict=True):
                if own != writer.shard:
                    if writer.shard is not None:
                        finish()
                    writer.begin(own)
                ids = plain.decompress(packed)
                ids += pad * ((stride - len(ids)) // 2)
                writer.add(ids)
                digests.append(hashlib.sha256(ids).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(digests, pa.string())], names=[*batch.schema.names[:6], "ids_sha256"])
        if writer.shard is not None:
            finish()

    kind = docs.schema[key].dataType.simpleString()
    chosen = placed.select("number", "slot", "shard", ((F.col("slot") % per_shard) * stride).alias("byte_offset"), "n_tokens", "docs", "ids")
    each = -(-shards // partitions) or 1
    at = F.floor(F.col("shard") / each).cast("int")
    ranged = chosen.repartitionById(max(-(-shards // each), 1), at).sortWithinPartitions("slot")  # a shard is a range of slots: no sampling
    rows = ranged.mapInArrow(shards_of, f"number long, slot long, shard int, byte_offset long, n_tokens int, docs array<{kind}>, ids_sha256 string")
    rows.write.mode("overwrite").parquet(f"{path}/manifest")
    _tidy(files, base, shards)
    remove(spark, packed)
    return spark.read.parquet(f"{path}/manifest")


class Reader:
    """Sequences in training order from any slot on."""

    def __init__(self, path: str):
        self.files, self.base = _filesystem(path)
        with self.files.open_input_stream(f"{self.base}/layout.json") as file:
            self.layout = json.loads(file.read())

    def read(self, slot: int = 0) -> Iterator[np.ndarray]:
        per_shard, stride = self.layout["per_shard"], 2 * self.layout["length"]
        while slot < self.layout["sequences"]:
            with self.files.open_input_file(f"{self.base}/{shard_name(slot // per_shard)}") as file:
                file.seek(slot % per_shard * stride)
                while ids := file.read(stride):
                    yield np.frombuffer(ids, self.layout["dtype"])
                    slot += 1


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")
