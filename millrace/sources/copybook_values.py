"""Values of copybook items, decoded column by column from a matrix of bytes with one row for each record.

Texts become UTF-8 and numbers integers by table lookups and array arithmetic, whatever the number of records; Python touches single values only
to say what is wrong with them. A number that can't be read is null and noted; an empty one (all blanks, or beyond the end of a short record) is null
without a note.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .copybook_items import BINARY, DISPLAY, DOUBLE, FLOAT, PACKED, Item

_TRIM = {"none": lambda x: x, "left": pc.utf8_ltrim_whitespace, "right": pc.utf8_rtrim_whitespace, "both": pc.utf8_trim_whitespace}
#: What a byte is in a number: a digit, or one of these.
BAD, BLANK = -1, -2
_BILLION = np.uint64(10**9)


@dataclass
class Code:
    """A single-byte code page: code points, digits and signs of bytes; ``over`` and ``negative`` are for a byte that is digit and sign in one."""

    points: np.ndarray
    blank: int
    digits: np.ndarray = field(init=False)
    over: np.ndarray = field(init=False)
    negative: np.ndarray = field(init=False)
    apart: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.digits, self.over, self.apart = (np.full(256, BAD, np.int8) for _ in range(3))
        self.negative = np.zeros(256, bool)
        for byte, point in enumerate(self.points.tolist()):
            char = chr(point)
            if char in "0123456789":
                self.digits[byte] = self.over[byte] = int(char)
            elif char == " " or byte == 0:
                self.digits[byte] = self.over[byte] = BLANK
            elif char in "+-":
                self.apart[byte] = char == "-"
        self.apart[self.blank] = 0

    @staticmethod
    def ebcdic(points: np.ndarray) -> Code:
        """The upper half of a digit's last byte is its sign: B or D for less than zero."""
        out = Code(points, 0x40)
        for half, negative in ((0xA, False), (0xB, True), (0xC, False), (0xD, True), (0xE, False), (0xF, False)):
            out.over[half * 16 : half * 16 + 10] = np.arange(10)
            out.negative[half * 16 : half * 16 + 10] = negative
        return out

    @staticmethod
    def ascii(points: np.ndarray) -> Code:
        """A digit with its sign is what the same punch was in ASCII, or a letter from p on for less than zero."""
        out = Code(points, 0x20)
        for chars, negative in (("{ABCDEFGHI", False), ("}JKLMNOPQR", True), ("pqrstuvwxy", True)):
            for digit, char in enumerate(chars):
                out.over[ord(char)] = digit
                out.negative[ord(char)] = negative
        return out


def code(encoding: str, charset: str | None) -> Code:
    """The code page of an encoding ("ascii" or "ebcdic"). Without a charset only what can be printed in ASCII (or in page 037) is read, all else is a blank."""
    name = charset or ("ascii" if encoding == "ascii" else "cp037")
    try:
        if len("é".encode(name, "replace")) > 1:
            raise LookupError
        points = np.array([ord(bytes([b]).decode(name, "replace")) for b in range(256)], np.uint32)
    except LookupError:
        raise ValueError(f"unknown charset {charset}, or not one of single bytes") from None
    if charset is None:
        points[(points < 32) | (points == 0xFFFD) | ((points >= 127) & (points < 160))] = 32
    return (Code.ascii if encoding == "ascii" else Code.ebcdic)(points)


@dataclass
class Notes:
    """Numbers that couldn't be read: rows of the record matrix, paths and raw values."""

    rows: list[np.ndarray] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)
    raw: list[list[str]] = field(default_factory=list)

    def by_row(self, count: int) -> list[list[tuple[str, str]]]:
        out: list[list[tuple[str, str]]] = [[] for _ in range(count)]
        for rows, path, raw in zip(self.rows, self.paths, self.raw, strict=True):
            for row, value in zip(rows.tolist(), raw, strict=True):
                out[row].append((path, value))
        return out


def matrix(records: pa.Array, width: int, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """Binary values as rows of ``width`` bytes, longer ones cut and shorter ones filled with blanks, and how much of each is there."""
    records = records.cast(pa.large_binary())
    offsets = np.frombuffer(records.buffers()[1], np.int64)[records.offset : records.offset + len(records) + 1]
    data = np.frombuffer(records.buffers()[2], np.uint8) if records.buffers()[2] else np.zeros(0, np.uint8)
    lengths = np.minimum(np.diff(offsets), width)
    if len(records) and (np.diff(offsets) == width).all():
        return data[offsets[0] : offsets[-1]].reshape(-1, width), lengths
    there = np.arange(width) < lengths[:, None]
    out = np.full((len(records), width), blank, np.uint8)
    out[there] = data[(offsets[:-1, None] + np.arange(width))[there]]
    return out, lengths


def utf8(points: np.ndarray, there: np.ndarray) -> pa.Array:
    """Strings of the rows of a matrix of code points below 65,536, of which those not ``there`` are left out."""
    flat, sizes = points.ravel(), np.where(there, 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800), 0)
    ends = np.cumsum(sizes.ravel())
    offsets = np.concatenate(([0], ends[points.shape[1] - 1 :: points.shape[1]])) if points.shape[1] else np.zeros(len(points) + 1, np.int64)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    at, size = ends - sizes.ravel(), sizes.ravel()
    for width, lead in ((1, 0), (2, 0xC0), (3, 0xE0)):
        chosen = size == width
        first, point = at[chosen], flat[chosen]
        out[first] = lead | (point >> (6 * (width - 1)))
        for k in range(1, width):
            out[first + k] = 0x80 | (point >> (6 * (width - 1 - k)) & 0x3F)
    return pa.Array.from_buffers(pa.large_string(), len(points), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.string())


def _texts(item: Item, rows: np.ndarray, lengths: np.ndarray, page: Code, trimming: str) -> pa.Array:
    there = np.arange(item.width) < lengths[:, None]
    found = _TRIM[trimming](utf8(page.points[rows], there))
    return pc.if_else(pa.array(lengths > 0), found, pa.scalar(None, pa.string()))


def _decimal(negative: np.ndarray, digits: np.ndarray, valid: np.ndarray, kind: T.DecimalType) -> pa.Array:
    """Decimals of 128 bits from a matrix of decimal digits: nine at a time into limbs of 32 bits."""
    count, width = digits.shape
    padded = np.zeros((count, -(-width // 9) * 9), np.uint64)
    padded[:, padded.shape[1] - width :] = digits
    powers = 10 ** np.arange(8, -1, -1, dtype=np.uint64)
    limbs = np.zeros((count, 4), np.uint64)
    low = np.uint64(0xFFFFFFFF)
    for chunk in (padded.reshape(count, -1, 9) * powers).sum(axis=2).T:
        carry = chunk
        for k in range(4):
            value = limbs[:, k] * _BILLION + carry
            limbs[:, k], carry = value & low, value >> np.uint64(32)
    carry = negative.astype(np.uint64)
    for k in range(4):
        value = np.where(negative, ~limbs[:, k] & low, limbs[:, k]) + carry
        limbs[:, k], carry = value & low, value >> np.uint64(32)
    data = limbs.astype("<u4").tobytes()
    return pa.Array.from_buffers(pa.decimal128(kind.precision, kind.scale), count, [pa.py_buffer(np.packbits(valid, bitorder="little").tobytes()), pa.py_buffer(data)])


def _from_digits(item: Item, negative: np.ndarray, digits: np.ndarray, valid: np.ndarray) -> pa.Array:
    if isinstance(item.element, T.DecimalType):
        return _decimal(negative & valid, np.where(valid[:, None], digits, 0), valid, item.element)
    value = digits.astype(np.int64) @ 10 ** np.arange(digits.shape[1] - 1, -1, -1, dtype=np.int64)
    return pa.array(np.where(negative, -value, value).astype(np.int32 if isinstance(item.element, T.IntegerType) else np.int64), mask=~valid)


def _display(item: Item, rows: np.ndarray, page: Code) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Values, which are bad and which are empty. Blanks may stand before and after the digits."""
    keep = [k for k in range(item.width) if k != item.point]
    good = np.ones(len(rows), bool)
    if item.point is not None:
        good = page.points[rows[:, item.point]] == ord(".")
    empty = (page.digits[rows] == BLANK).all(axis=1)
    rows = rows[:, keep]
    negative = np.zeros(len(rows), bool)
    if item.apart:
        at = 0 if item.sign == "leading" else rows.shape[1] - 1
        sign = page.apart[rows[:, at]]
        good &= sign != BAD
        negative = sign == 1
        digits = page.digits[np.delete(rows, at, axis=1)]
    else:
        digits = page.digits[rows]
        if item.signed:
            at = 0 if item.sign == "leading" else rows.shape[1] - 1
            digits = digits.copy()
            digits[:, at] = page.over[rows[:, at]]
            negative = page.negative[rows[:, at]]
    blank = digits == BLANK
    leading = np.cumsum(~blank, axis=1) == 0
    if item.point is None and (item.apart or not item.signed):
        trailing = np.cumsum(~blank[:, ::-1], axis=1)[:, ::-1] == 0
        moved = (trailing & ~leading).sum(axis=1)
        if moved.any():  # what stands before blanks moves to the end
            place = np.arange(digits.shape[1]) - moved[:, None]
            digits = np.where(place >= 0, np.take_along_axis(digits, np.maximum(place, 0), axis=1), BLANK)
            leading = np.cumsum(digits != BLANK, axis=1) == 0
    digits = np.where(leading, 0, digits)
    good &= (digits >= 0).all(axis=1) & ~empty
    return _from_digits(item, negative, np.maximum(digits, 0), good), ~good & ~empty, empty


def _packed(item: Item, rows: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    halves = np.stack([rows >> 4, rows & 15], axis=2).reshape(len(rows), -1)
    digits, sign = halves[:, :-1], halves[:, -1]
    surplus = digits.shape[1] - item.digits
    good = (digits <= 9).all(axis=1) & (sign > 9) & (digits[:, :surplus] == 0).all(axis=1)
    negative = (sign == 0xD) | (sign == 0xB)
    if not item.signed:
        good &= ~negative
    return _from_digits(item, negative, np.where(good[:, None], digits, 0)[:, surplus:], good), ~good


def _binary(item: Item, rows: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Big-endian numbers, of two's complement if the picture has a sign."""
    value = np.ascontiguousarray(rows).view(f">u{item.width}").reshape(-1)
    signed = value.astype(f"=u{item.width}").view(f"=i{item.width}").astype(np.int64) if item.signed else value.astype(np.uint64).astype(np.int64)
    good = np.ones(len(rows), bool) if item.signed or item.width < 8 else signed >= 0
    if isinstance(item.element, T.DecimalType):
        size = np.abs(signed).astype(np.uint64)  # the smallest number is its own opposite, which is right without its sign
        good &= size < np.uint64(10**item.digits) if item.digits < 19 else True
        digits = size[:, None] // 10 ** np.arange(item.digits - 1, -1, -1, dtype=np.uint64) % np.uint64(10)
        return _decimal((signed < 0) & good, np.where(good[:, None], digits, 0), good, item.element), ~good
    if isinstance(item.element, T.IntegerType):
        good &= np.abs(signed) < 1 << 31
        return pa.array(np.where(good, signed, 0).astype(np.int32), mask=~good), ~good
    return pa.array(signed, mask=~good), ~good


def _floating(item: Item, rows: np.ndarray, floats: str) -> pa.Array:
    if floats == "ieee":
        value = np.ascontiguousarray(rows).view(f">f{item.width}").reshape(-1).astype(np.float64)
    else:  # a sign, a power of 16 above 64, and the fraction
        word = np.ascontiguousarray(rows).view(f">u{item.width}").reshape(-1).astype(np.uint64)
        bits = 8 * item.width - 8
        fraction = (word & np.uint64((1 << bits) - 1)).astype(np.float64) / 2.0**bits
        power = ((word >> np.uint64(bits)) & np.uint64(127)).astype(np.int64) - 64
        value = np.where(word >> np.uint64(bits + 7), -1.0, 1.0) * fraction * 16.0**power
    return pa.array(value.astype(np.float32 if item.packing == FLOAT else np.float64))


def _words(item: Item, rows: np.ndarray, page: Code) -> list[str]:
    """Raw values as they are reported: digits as text, other numbers in hexadecimal."""
    if item.packing == DISPLAY:
        return ["".join(map(chr, r)) for r in page.points[rows].tolist()]
    return [r.tobytes().hex().upper() for r in rows]


@dataclass
class Decoder:
    page: Code
    trimming: str
    floats: str

    def columns(self, items: list[Item] | tuple[Item, ...], rows: np.ndarray, lengths: np.ndarray, notes: Notes, record: np.ndarray | None = None, path: str = "", known: dict[str, np.ndarray] | None = None) -> Iterator[pa.Array]:
        """A column for each item. ``record`` is the row of the whole matrix that a row belongs to, ``known`` has numbers that arrays may depend on."""
        record = np.arange(len(rows)) if record is None else record
        known = {} if known is None else dict(known)
        for item in items:
            times = item.occurs or 1
            own = np.ascontiguousarray(rows[:, item.start : item.start + item.width * times]).reshape(len(rows) * times, item.width)
            left = np.clip(lengths[:, None] - item.start - np.arange(times) * item.width, 0, item.width).reshape(-1)
            each = np.repeat(record, times)
            used, sizes = np.ones(len(own), bool), np.full(len(rows), times)
            if item.depends:
                sizes = np.clip(known.get(item.depends.replace("-", "_"), sizes), item.least, times)
                used = (np.arange(times) < sizes[:, None]).reshape(-1)
                own, left, each = own[used], left[used], each[used]
            if item.children:
                inner = {k: np.repeat(v, times)[used] for k, v in known.items()}
                children = list(self.columns(item.children, own, left, notes, each, f"{path}{item.name}.", inner))
                found: pa.Array = pa.StructArray.from_arrays(children, [c.name for c in item.children])
            else:
                found = self.values(item, own, left, notes, each, path)
                if item.numeric and not item.occurs and not item.scale and item.packing not in (FLOAT, DOUBLE):
                    known[item.name.upper()] = pc.fill_null(found, 0).cast(pa.int64(), safe=False).to_numpy(zero_copy_only=False) if item.digits <= 18 else np.zeros(len(rows), np.int64)
            if item.occurs:
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(offsets), found)
            yield found.cast(to_arrow_type(item.type)) if not item.children else found

    def values(self, item: Item, rows: np.ndarray, lengths: np.ndarray, notes: Notes, record: np.ndarray, path: str) -> pa.Array:
        if not item.numeric:
            return _texts(item, rows, lengths, self.page, self.trimming)
        whole = lengths == item.width
        if item.packing in (FLOAT, DOUBLE):
            value, bad = _floating(item, rows, self.floats), np.zeros(len(rows), bool)
        elif item.packing == PACKED:
            value, bad = _packed(item, rows)
        elif item.packing == BINARY:
            value, bad = _binary(item, rows)
        else:
            value, bad, _ = _display(item, rows, self.page)
        bad = (bad & whole) | ((lengths > 0) & ~whole)
        if bad.any():
            notes.rows.append(record[bad])
            notes.paths.append(f"{path}{item.name}")
            notes.raw.append(_words(item, rows[bad], self.page))
        return value if whole.all() and not bad.any() else pc.if_else(pa.array(whole & ~bad), value, pa.scalar(None, value.type))
