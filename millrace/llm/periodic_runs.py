"""Periodic runs of words by block convolution.

A run is a stretch of consecutive words that a period q repeats (words q apart are identical), at least 24 words and three periods long, which no
neighbouring word extends; q is the smallest period of the stretch. Periods are looked for scale by scale: for those from B to 2B - 1 (1 to 15 at
the first scale, where B is 8) each run holds a block of B words, beginning at a multiple of B, that occurs again one period later within the run.
Words become residues of a prime, and a number-theoretic transform gives, exactly, the sum of squared differences between a block and every
place of the windows that follow: where it is zero, the block occurs again, and the distance seeds an extension to both sides, which compares words.

Two things spare transforms without losing a run. A block can't occur again nearer than all of its stretches of eight words do, and where these
occur next is known from one sort. And a block whose windows lie in a run with a period q of no more than B words only meets multiples of q there.

Blocks of over ``BLOCK`` words are sought by their first words, in windows cut to the same size, so long texts need no long transforms. Time grows with
n log n, and with the length of what is found.

Defined results: a null text has no words, and neither it nor an empty or a short one has runs; rows are judged one by one, so repeated rows repeat
their result; long texts are walked whole; of stretches with several periods the smallest counts; an output name that the input already has is
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The shortest run, in words and in periods.
SHORTEST, PERIODS = 24, 3
#: Words of the smallest block, and of the largest that is transformed at once.
SMALL, BLOCK = 8, 4096
#: Residues in one batch of transforms.
BATCH = 1 << 18
PRIME, ROOT = 998244353, 3
_P = np.uint64(PRIME)
RUN = "array<struct<start: long, length: long, period: long>>"
ARROW_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


@cache
def _roots(size: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of order ``size``, up to half of them."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    out = np.ones(size // 2, np.uint64)
    done = 1
    while done < len(out):
        out[done : 2 * done] = out[:done] * np.uint64(pow(root, done, PRIME)) % _P
        done *= 2
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    """The transform of each row, in bit-reversed order."""
    count, size = rows.shape
    half = size // 2
    while half:
        x = rows.reshape(count, -1, 2, half)
        low, high = x[:, :, 0], x[:, :, 1]
        rows = np.stack([(low + high) % _P, (low + (_P - high)) * _roots(2 * half, False) % _P], axis=2)
        half //= 2
    return rows.reshape(count, size)


def restore(rows: np.ndarray) -> np.ndarray:
    """The way back from ``transform``."""
    count, size = rows.shape
    half = 1
    while half < size:
        x = rows.reshape(count, -1, 2, half)
        low, high = x[:, :, 0], x[:, :, 1] * _roots(2 * half, True) % _P
        rows = np.stack([(low + high) % _P, (low + (_P - high)) % _P], axis=2)
        half *= 2
    return rows.reshape(count, size) * np.uint64(pow(size, -1, PRIME)) % _P


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences (residues) between each block and the places 0 to its length in its window, which is twice as long."""
    size = blocks.shape[1]
    reverse = np.zeros_like(windows)
    reverse[:, :size] = blocks[:, ::-1]
    products = restore(transform(reverse) * transform(windows) % _P)[:, size - 1 :]
    squares = np.cumsum(windows * windows % _P, axis=1)
    within = squares[:, size - 1 :].copy()
    within[:, 1:] -= squares[:, :size]
    own = (blocks * blocks % _P).sum(axis=1, keepdims=True)
    return (own + within + np.uint64(2) * (_P - products)) % _P


def _hashed(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def _nearest(x: np.ndarray) -> np.ndarray:
    """For each multiple of SMALL how far on its SMALL words occur next (never: more than there are words)."""
    grams, width, factor = _hashed(x), 1, 0x2545F4914F6CDD1D
    while width < SMALL:
        grams = grams[:-width] + grams[width:] * np.uint64(factor)
        factor = factor * factor % (1 << 64)
        width *= 2
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    gaps = np.full(len(grams), 2 * len(x))
    gaps[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gaps[::SMALL]


def _matching(x: np.ndarray, left: int, right: int, step: int) -> int:
    """How many words from two places on are identical, forwards or backwards."""
    found, size = 0, 64
    most = len(x) - right if step > 0 else left + 1
    while found < most:
        size = min(size, most - found)
        if step > 0:
            differ = x[left + found : left + found + size] != x[right + found : right + found + size]
        else:
            differ = (x[left - found - size + 1 : left - found + 1] != x[right - found - size + 1 : right - found + 1])[::-1]
        if differ.any():
            return found + int(differ.argmax())
        found += size
        size *= 2
    return found


def _seeds(x: np.ndarray, residues: np.ndarray, starts: np.ndarray, first: int, last: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks and distances, from ``first`` to ``last``, at which they occur again; by distance and start."""
    padded = np.concatenate([residues, np.zeros(2 * length, np.uint64)])
    cuts = np.arange(first, last + 1, length + 1)
    at, away = np.repeat(starts, len(cuts)), np.tile(cuts, len(starts))
    there = at + away + length <= len(x)
    at, away = at[there], away[there]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rows = max(1, BATCH // (2 * length))
    for k in range(0, len(at), rows):
        a, d = at[k : k + rows, None], away[k : k + rows, None]
        zero, place = np.nonzero(mismatches(padded[a + np.arange(length)], padded[a + d + np.arange(2 * length)]) == 0)
        found.append((a[zero, 0], d[zero, 0] + place))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, away = (np.concatenate(c) for c in zip(*found, strict=True))
    good = (away <= last) & (at + away + length <= len(x))
    at, away = at[good], away[good]
    order = np.lexsort((at, away))
    return at[order], away[order]


def runs_of(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text's word codes, by start and period."""
    n = len(x)
    if n < SHORTEST:
        return []
    gaps = _nearest(x)
    if gaps.min() > n:
        return []
    residues = _hashed(x) % _P
    runs: list[tuple[int, int, int]] = []
    block, first = SMALL, 1
    while first <= n // PERIODS:
        last = min(2 * block - 1, n // PERIODS)
        starts = np.arange(len(gaps)) * block
        active = (gaps <= last) & (starts + block + first <= n)
        for s, e, q in runs:
            if q <= block:
                active &= ~((starts >= s) & (np.minimum(starts + last + block, n) <= e))
        if active.any():
            _extend(x, *_seeds(x, residues, starts[active], first, last, min(block, BLOCK)), min(block, BLOCK), runs)
        gaps = gaps[: len(gaps) // 2 * 2].reshape(-1, 2).max(axis=1)
        block *= 2
        first = block
        if not len(gaps):
            break
    return sorted((s, e - s, q) for s, e, q in runs)


def _extend(x: np.ndarray, starts: np.ndarray, distances: np.ndarray, length: int, runs: list[tuple[int, int, int]]) -> None:
    """Adds the runs that seeds lead to. Seeds within a run whose period divides their distance lead to that run again."""
    for d in np.unique(distances).tolist():
        at = starts[np.searchsorted(distances, d) : np.searchsorted(distances, d, "right")]
        for s, e, q in runs:
            if d % q == 0 and len(at):
                at = at[(at < s) | (at + d + length > e)]
        until = -1
        for j in at.tolist():
            if j + d + length <= until:
                continue
            ahead = _matching(x, j, j + d, 1)
            if ahead < length:
                continue
            s, e = j - _matching(x, j - 1, j + d - 1, -1), j + d + ahead
            until = e
            if e - s >= max(SHORTEST, PERIODS * d):
                runs.append((s, e, d))


def coded(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    codes: dict[bytes, int] = {}
    return np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return words if keep.all() else [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def annotate(docs: DataFrame, text: str | Column = "text", out: str = "repeats") -> DataFrame:
    """``docs`` with a struct of the runs of each text, by start and period, and the text with each run cut to its first period, one blank between words."""
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            runs, kept = [], []
            for t in texts.cast(pa.binary()).to_pylist():
                words = (t or b"").split()  # of bytes: at the six blanks of ASCII only
                own = runs_of(coded(words)) if len(words) >= SHORTEST else []
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                kept.append(b" ".join(collapsed(words, own)))
            yield pa.StructArray.from_arrays([pa.array(runs, ARROW_RUN), pa.array(kept, pa.binary()).cast(pa.string())], ["runs", "text"])

    column = F.col(text) if isinstance(text, str) else text
    return docs.withColumn(out, F.arrow_udf(found, f"struct<runs: {RUN}, text: string>")(column))
