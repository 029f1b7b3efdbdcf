"""What the records that a copybook describes hold, and where.

An elementary item is a column. Groups only hold items together, and their names fall away, unless they are repeated: these are arrays of
structs. OCCURS makes an array, DEPENDING ON one that is as long as an earlier number says (its place in the record stays the largest), REDEFINES
gives an item or group the place of an earlier one. FILLER takes its place and is no column; condition names (88) and renamings (66) take none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import types as T

#: How numbers are written: a digit in each byte, big-endian binary, two digits in each byte, or floating point.
DISPLAY, BINARY, PACKED, FLOAT, DOUBLE = "display", "binary", "packed", "float", "double"
#: Words of the USAGE clause.
_USAGE = {
    "DISPLAY": DISPLAY,
    "COMP": BINARY,
    "COMPUTATIONAL": BINARY,
    "BINARY": BINARY,
    "COMP-4": BINARY,
    "COMPUTATIONAL-4": BINARY,
    "COMP-5": BINARY,
    "COMPUTATIONAL-5": BINARY,
    "COMP-3": PACKED,
    "COMPUTATIONAL-3": PACKED,
    "PACKED-DECIMAL": PACKED,
    "COMP-1": FLOAT,
    "COMPUTATIONAL-1": FLOAT,
    "COMP-2": DOUBLE,
    "COMPUTATIONAL-2": DOUBLE,
}
_IDLE = {"USAGE", "IS", "TIMES", "CHARACTER", "JUSTIFIED", "JUST", "RIGHT", "SYNC", "SYNCHRONIZED", "BLANK", "WHEN", "ZERO", "ZEROS", "ZEROES"}


@dataclass(frozen=True)
class Item:
    """A column, or a repeated group with ``children``, whose places count from the beginning of the group."""

    name: str
    start: int
    width: int
    numeric: bool = False
    scale: int = 0
    digits: int = 0
    packing: str = DISPLAY
    #: Times that the item follows itself, None if it isn't an array; the fewest, and the number that says how many there are.
    occurs: int | None = None
    least: int = 0
    depends: str = ""
    signed: bool = False
    #: Where the sign stands: "leading" or "trailing"; whether it has a place of its own.
    sign: str = "trailing"
    apart: bool = False
    #: Place of a decimal point that is written.
    point: int | None = None
    children: tuple[Item, ...] = ()

    @property
    def element(self) -> T.DataType:
        if self.children:
            return schema(self.children)
        if self.packing in (FLOAT, DOUBLE):
            return T.FloatType() if self.packing == FLOAT else T.DoubleType()
        if not self.numeric:
            return T.StringType()
        if self.scale:
            return T.DecimalType(self.digits, self.scale)
        return T.IntegerType() if self.digits <= 9 else T.LongType() if self.digits <= 18 else T.DecimalType(self.digits, 0)

    @property
    def type(self) -> T.DataType:
        return T.ArrayType(self.element) if self.occurs else self.element


def schema(items: list[Item] | tuple[Item, ...]) -> T.StructType:
    return T.StructType([T.StructField(i.name, i.type, True) for i in items])


def length_of(items: list[Item] | tuple[Item, ...]) -> int:
    """Bytes up to the end of the last item."""
    return max((i.start + i.width * (i.occurs or 1) for i in items), default=0)


@dataclass
class Record:
    """Items, and the length of a record, which fillers may make longer than they are."""

    items: list[Item]
    length: int


class _Words:
    """The words of one entry, taken one after the other."""

    def __init__(self, text: str):
        self.text, self.left = text, re.findall(r"'[^']*'|\"[^\"]*\"|[^\s,;]+(?:,[^\s,;]+)*", text)

    def refuse(self) -> ValueError:
        return ValueError(f"can't read the copybook at {self.text!r}")

    def next(self, *optional: str) -> str:
        while self.left and self.left[0].upper() in optional:
            self.left.pop(0)
        if not self.left:
            raise self.refuse()
        return self.left.pop(0)

    def skip(self, *words: str) -> bool:
        found = bool(self.left) and self.left[0].upper() in words
        if found:
            self.left.pop(0)
        return found

    def count(self) -> int:
        word = self.next()
        if not word.isdigit():
            raise self.refuse()
        return int(word)


@dataclass
class _Entry:
    level: int
    name: str
    picture: str = ""
    usage: str = ""
    redefines: str = ""
    occurs: int | None = None
    least: int = 0
    depends: str = ""
    sign: str = ""
    apart: bool = False


def _entry(text: str) -> _Entry | None:
    """An entry by its words; None for one that takes no place."""
    words = _Words(text)
    level = words.next()
    if not re.fullmatch(r"\d{1,2}", level):
        raise words.refuse()
    if int(level) in (66, 88):
        return None
    clauses = {"PIC", "PICTURE", "REDEFINES", "OCCURS", "VALUE", *_USAGE, *_IDLE}
    name = "FILLER" if not words.left or words.left[0].upper() in clauses else words.next()
    if not re.fullmatch(r"[A-Za-z0-9_-]+", name) or (name == "FILLER" and not words.left):
        raise words.refuse()
    out = _Entry(int(level), name)
    while words.left:
        word = words.next().upper()
        if word in ("PIC", "PICTURE"):
            out.picture = words.next("IS").upper()
        elif word == "REDEFINES":
            out.redefines = words.next().upper()
        elif word == "OCCURS":
            out.occurs = out.least = words.count()
            if words.skip("TO"):
                out.occurs = words.count()
            words.skip("TIMES")
            if words.skip("DEPENDING"):
                out.depends = words.next("ON").upper()
        elif word in ("ASCENDING", "DESCENDING", "INDEXED"):
            words.next("KEY", "IS", "BY")
        elif word == "SIGN":
            out.sign = words.next("IS").lower()
        elif word in ("LEADING", "TRAILING"):
            out.sign = word.lower()
        elif word == "SEPARATE" and out.sign:
            out.apart = True
        elif word in ("VALUE", "VALUES"):
            words.next("IS", "ARE")
        elif word in _USAGE:
            out.usage = _USAGE[word]
        elif word not in _IDLE:
            raise words.refuse()
    if out.sign not in ("", "leading", "trailing"):
        raise words.refuse()
    return out


def _elementary(entry: _Entry) -> Item:
    """The item of an entry with a picture or a floating-point usage, at the beginning."""
    name = entry.name.replace("-", "_")
    usage = entry.usage or DISPLAY
    repeated = {"occurs": entry.occurs, "least": entry.least if entry.depends else entry.occurs or 0, "depends": entry.depends}
    if usage in (FLOAT, DOUBLE):
        return Item(name, 0, 4 if usage == FLOAT else 8, True, packing=usage, signed=True, **repeated)
    picture = re.sub(r"(.)\((\d+)\)", lambda r: r[1] * int(r[2]), entry.picture)
    if not re.fullmatch(r"S?9*(?:[V.]9*)?", picture) or "9" not in picture:
        if "P" in picture and re.fullmatch(r"S?[9PV]+", picture) or usage != DISPLAY:
            raise ValueError(f"{entry.name}: the picture {entry.picture} isn't supported")
        return Item(name, 0, len(picture.replace("S", "").replace("V", "")), **repeated)
    whole, point, part = re.fullmatch(r"S?(9*)([V.]?)(9*)", picture).groups()
    digits, signed = len(whole) + len(part), picture.startswith("S")
    if digits > 38:
        raise ValueError(f"{entry.name}: numbers have at most 38 digits")
    written = point == "." and usage == DISPLAY
    if usage == PACKED:
        width = digits // 2 + 1
    elif usage == BINARY:
        if digits > 18:
            raise ValueError(f"{entry.name}: binary numbers have at most 18 digits")
        width = 2 if digits <= 4 else 4 if digits <= 9 else 8
    else:
        width = digits + written + (signed and entry.apart)
    sign = entry.sign or "trailing"
    place = len(whole) + (signed and entry.apart and sign == "leading") if written else None
    return Item(name, 0, width, True, len(part), digits, usage, signed=signed, sign=sign, apart=signed and entry.apart, point=place, **repeated)


def _laid_out(entries: list[_Entry]) -> tuple[list[Item], int]:
    """Items of the entries of one level and those below them, and their length."""
    items: list[Item] = []
    places: dict[str, int] = {}
    at = end = k = 0
    while k < len(entries):
        entry, k = entries[k], k + 1
        below = k
        while below < len(entries) and entries[below].level > entry.level:
            below += 1
        inside, k = entries[k:below], below
        if entry.redefines and entry.redefines not in places:
            raise ValueError(f"{entry.name} redefines {entry.redefines}, which isn't there")
        start = places[entry.redefines] if entry.redefines else at
        places[entry.name.upper()] = start
        if entry.picture or entry.usage in (FLOAT, DOUBLE):
            if inside:
                raise ValueError(f"{entry.name} has a picture and items below it")
            own = [replace(_elementary(entry), start=start)]
            size = own[0].width * (entry.occurs or 1)
        elif not inside:
            raise ValueError(f"{entry.name} has neither a picture nor items below it")
        else:
            for e in inside:  # usage and sign of a group hold for what is in it
                e.usage = e.usage or entry.usage
                if entry.sign and not e.sign:
                    e.sign, e.apart = entry.sign, entry.apart
            children, width = _laid_out(inside)
            size = width * (entry.occurs or 1)
            if entry.occurs:
                own = [Item(entry.name.replace("-", "_"), start, width, occurs=entry.occurs, least=entry.least if entry.depends else entry.occurs, depends=entry.depends, children=tuple(children))]
            else:
                own = [replace(c, start=c.start + start) for c in children]
        if entry.name.upper() != "FILLER" or (not entry.picture and not entry.occurs):
            items += own
        at = max(at, start + size) if entry.redefines else start + size
        end = max(end, at)
    return items, end


def record(text: str) -> Record:
    """The record that a copybook describes."""
    lines = [line for line in text.splitlines() if line[6:7] not in ("*", "/") and not line.lstrip().startswith("*")]
    clean = " ".join(line[6:72] if re.match(r"^(?: {6}|\d{6})[ -]", line) and len(line) > 7 else line for line in lines)
    entries = [e for e in (_entry(c.strip()) for c in re.findall(r"(?:'[^']*'|\"[^\"]*\"|[^.]|\.(?!\s|$))+", clean) if c.strip()) if e is not None]
    items, length = _laid_out(entries)
    names = [i.name.upper() for i in items]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"the copybook has several items named {', '.join(twice)}")
    return Record(items, length)


def parse(text: str) -> list[Item]:
    """The items of a copybook."""
    return record(text).items
