"""Mainframe files: numbers and texts decoded by column, against Python's own arithmetic."""

from __future__ import annotations

import random
import struct
from decimal import Decimal

import pytest

from millrace.plans.standardize import standardize
from millrace.sources import copybook, readers, schemas

BOOK = """
       01  RECORD.
           05  A1   PIC X(1).
           05  A2   PIC X(5).
           05  A3   PIC X(10).
"""
FOUR = "1Tes  01234567892 est2 SomeText 3None Data¡3    4 on      Data 4".encode("latin-1")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def written(tmp_path, data, name="r.bin"):
    (tmp_path / name).write_bytes(data)
    return str(tmp_path / name)


def told(found):
    return [(e["errCode"], e["errCol"], e["rawValues"]) for e in found]


@pytest.mark.parametrize(
    "trimming,charset,want",
    [
        ("none", "ISO-8859-1", [("Tes  ", "0123456789"), (" est2", " SomeText "), ("None ", "Data¡3    "), (" on  ", "    Data 4")]),
        ("left", None, [("Tes  ", "0123456789"), ("est2", "SomeText "), ("None ", "Data 3    "), ("on  ", "Data 4")]),
        ("right", None, [("Tes", "0123456789"), (" est2", " SomeText"), ("None", "Data 3"), (" on", "    Data 4")]),
        ("both", "ISO-8859-1", [("Tes", "0123456789"), ("est2", "SomeText"), ("None", "Data¡3"), ("on", "Data 4")]),
    ],
)
def test_fixed_ascii(spark, tmp_path, trimming, charset, want):
    out = rows(copybook.read(spark, written(tmp_path, FOUR), BOOK, encoding="ascii", trimming=trimming, charset=charset))
    assert [(r["A1"], r["A2"], r["A3"]) for r in sorted(out, key=lambda r: r["A1"])] == [(str(i + 1), *x) for i, x in enumerate(want)]
    assert all(r["errCol"] == [] for r in out)


def test_lines_in_ascii(spark, tmp_path):
    lines = "1Tes  0123456789\n2 est2 SomeText\n3None Data¡3    \n4 on      Data 4".encode("latin-1")
    out = rows(copybook.read(spark, written(tmp_path, lines), BOOK, encoding="ascii", is_text=True))
    assert [(r["A2"], r["A3"]) for r in out] == [("Tes", "0123456789"), ("est2", "SomeText"), ("None", "Data 3"), ("on", "Data 4")]
    out = rows(copybook.read(spark, written(tmp_path, "caf\xe9 1\n".encode("latin-1"), "l.txt"), "01 R. 05 A PIC X(9).", encoding="ascii", is_text=True, charset="latin-1"))
    assert out[0]["A"] == "café 1"


def test_refusals(spark, tmp_path):
    at = written(tmp_path, FOUR)
    for wrong in ({"trimming": "bogus"}, {"charset": "bogus"}, {"charset": "utf-16"}, {"encoding": "morse"}, {"floats": "x"}):
        with pytest.raises(ValueError):
            copybook.read(spark, at, BOOK, **{"encoding": "ascii", **wrong})
    for wrong in ("05 A PIC X. 05 B REDEFINES Z PIC X.", "05 A VALUE 3.", "A PIC X.", "05 A.", "05 A PIC 9(3)PP COMP.", "05 A PIC 9(39).", "05 A PIC 9(19) COMP.", "05 A PIC X. 05 A PIC X.", "05 A PIC 9 BOGUS."):
        with pytest.raises(ValueError):
            copybook.parse(wrong)


def _zoned(value, width, ascii):
    digits = f"{abs(value):0{width}d}"
    if ascii:
        return digits[:-1].encode() + ("}JKLMNOPQR" if value < 0 else "{ABCDEFGHI")[int(digits[-1])].encode()
    return bytes(0xF0 + int(d) for d in digits[:-1]) + bytes([(0xD0 if value < 0 else 0xC0) + int(digits[-1])])


def _packed(value, digits):
    text = f"{abs(value):0{digits}d}" + ("d" if value < 0 else "c")
    return bytes.fromhex(text if len(text) % 2 == 0 else f"0{text}")


@pytest.mark.parametrize("ascii", [False, True])
def test_numbers_of_every_width(spark, tmp_path, ascii):
    rng = random.Random(5 + ascii)
    widths = [1, 2, 4, 5, 9, 10, 17, 18, 19, 27, 28, 37, 38]
    book = "01 R. " + " ".join(f"05 Z{w} PIC S9({w}). 05 P{w} PIC S9({max(1, w - 2)})V9({w - max(1, w - 2)}) COMP-3. " for w in widths)
    book += "05 H PIC S9(4) COMP. 05 I PIC S9(9) COMP. 05 J PIC S9(18) COMP. 05 K PIC 9(4) COMP. 05 L PIC S9(7)V99 BINARY."
    data, want = b"", []
    for k in range(60):
        numbers = {w: (rng.choice([0, 10**w - 1, 1 - 10**w]) if k < 9 else rng.randrange(1 - 10**w, 10**w)) for w in widths}
        binary = [rng.randrange(-(1 << 15), 1 << 15), rng.randrange(-(1 << 31) + 1, 1 << 31), rng.randrange(-(1 << 63) + 1, 1 << 63), rng.randrange(1 << 16), rng.randrange(-(10**9) + 1, 10**9)]
        data += b"".join(_zoned(n, w, ascii) + _packed(n, w) for w, n in numbers.items()) + struct.pack(">hiqHi", *binary)
        want.append([x for w, n in numbers.items() for x in (Decimal(n), Decimal(n).scaleb(-(w - max(1, w - 2))) if w < 29 else Decimal((n < 0, tuple(map(int, str(abs(n)))), -2)))] + [Decimal(b) for b in binary[:4]] + [Decimal(binary[4]).scaleb(-2)])
    out = copybook.read(spark, written(tmp_path, data), book, encoding="ascii" if ascii else "ebcdic").collect()
    assert sorted([Decimal(v) for v in r[:-1]] for r in out) == sorted(want)
    assert all(r.errCol == [] for r in out)


def test_signs(spark, tmp_path):
    book = "01 R. 05 A PIC S9(3). 05 B PIC S9(2) SIGN LEADING. 05 C PIC S9(2) SIGN IS TRAILING SEPARATE. 05 D PIC S9(2) SIGN LEADING SEPARATE CHARACTER. 05 E PIC 9(4)."
    ebcdic = bytes.fromhex("F1F2D3 D1F2 F1F260 4EF3F4 4040F1F2".replace(" ", "")) + bytes.fromhex("F1F2F3 C1F2 F1F24E 60F3F4 F1F24040".replace(" ", ""))
    out = rows(copybook.read(spark, written(tmp_path, ebcdic), book))
    assert [tuple(r.values()) for r in out] == [(-123, -12, -12, 34, 12, []), (123, 12, 12, -34, 12, [])]
    text = "12L" + "J2" + "12-" + "+34" + "  12" + "\n" + "12C" + "A2" + "12+" + "-34" + "12  " + "\n" + "12s" + "12" + "12 " + " 34" + "1 2 " + "\n"
    out = rows(copybook.read(spark, written(tmp_path, text.encode(), "t.txt"), book, encoding="ascii", is_text=True))
    assert [tuple(r.values())[:-1] for r in out] == [(-123, -12, -12, 34, 12), (123, 12, 12, -34, 12), (-123, 12, 12, 34, None)]
    assert told(out[2]["errCol"]) == [("E00000", "E", ["1 2 "])]


def test_numbers_that_are_none(spark, tmp_path):
    book = "01 R. 05 A PIC S9(3). 05 B PIC 9(3) COMP-3. 05 C PIC 9(18) COMP. 05 D PIC 9(2).9. 05 G OCCURS 2. 10 H PIC 9(1)."
    good = bytes.fromhex("F1F2C3 123F 0000000000000007 F0F14BF2 F1 F2".replace(" ", ""))
    bad = bytes.fromhex("F17BD3 1A3F FFFFFFFFFFFFFFFF F0F1F2F2 C1 F2".replace(" ", ""))
    blank = bytes.fromhex("404040 012D 0000000000000001 40404040 40 F3".replace(" ", ""))
    schema = schemas.parse(book, "copybook")
    raw, _ = readers.read(spark, "cobol", written(tmp_path, good + bad + blank), schema, copybook=book)
    one, two, three = rows(standardize(raw, schema))
    assert (one["A"], one["B"], one["C"], one["D"], one["G"], one["errCol"]) == (123, 123, 7, Decimal("1.2"), [{"H": 1}, {"H": 2}], [])
    assert (two["A"], two["B"], two["C"], two["D"], two["G"]) == (None, None, None, None, [{"H": None}, {"H": 2}])
    assert told(two["errCol"]) == [("E00000", "A", ["1#L"]), ("E00000", "B", ["1A3F"]), ("E00000", "C", ["FFFFFFFFFFFFFFFF"]), ("E00000", "D", ["0122"]), ("E00000", "G.H", ["A"])]
    assert (three["A"], three["D"], three["G"][0]) == (None, None, {"H": None}) and told(three["errCol"]) == [("E00000", "B", ["012D"])]


def test_groups_and_floats(spark, tmp_path):
    book = """
      * a comment
       01 R.
          05 N PIC 9.
          05 GS OCCURS 0 TO 3 TIMES DEPENDING ON N INDEXED BY I.
             10 K PIC X(2).
             10 FILLER PIC X VALUE 'a. b'.
             10 V PIC S9(3) COMP-3 OCCURS 2 TIMES.
          05 IBM COMP-1.
          05 WIDE COMP-2.
             88 YES VALUE 1.
          05 REST PIC X(2).
          05 BOTH REDEFINES REST.
             10 ONE PIC X.
             10 TWO PIC X.
          05 FILLER PIC X(2).
    """
    group = "ab?".encode("cp037") + _packed(12, 3) + _packed(-345, 3)
    data = b"".join("0123459"[k].encode("cp037") + group * 3 + bytes.fromhex("C276A000") + bytes.fromhex("4276A00000000000") + "xyzz".encode("cp037") for k in range(7))
    out = rows(copybook.read(spark, written(tmp_path, data), book))
    assert [len(r["GS"]) for r in out] == [0, 1, 2, 3, 3, 3, 3] and out[1]["GS"] == [{"K": "ab", "V": [12, -345]}]
    assert (out[0]["IBM"], out[0]["WIDE"], out[0]["REST"], out[0]["ONE"], out[0]["TWO"]) == (-118.625, 118.625, "xy", "x", "y")
    ieee = struct.pack(">fd", 1.5, -2.25)
    assert rows(copybook.read(spark, written(tmp_path, ieee, "f.bin"), "01 R. 05 A COMP-1. 05 B USAGE IS COMP-2.", floats="ieee"))[0] == {"A": 1.5, "B": -2.25, "errCol": []}


@pytest.mark.parametrize("big", [False, True])
def test_records_with_lengths(spark, tmp_path, monkeypatch, big):
    rng = random.Random(3)
    book = "01 R. 05 K PIC 9(6). 05 T PIC X(300)."
    for name in ("a", "b", "c"):
        data = b""
        for k in range(0 if name == "c" else 3000):
            body = f"{k:06d}".encode("cp037") + ("x" * rng.randrange(400)).encode("cp037")
            data += (struct.pack(">HH", len(body), 0) if big else struct.pack("<HH", 0, len(body))) + body
        written(tmp_path, data, name)
    found = copybook.ranges(spark, str(tmp_path), big, size=20_000).collect()
    assert len(found) > 40 and sum(r.size for r in found) == sum((tmp_path / n).stat().st_size for n in "abc")
    assert len({(r.path, r.start) for r in found}) == len(found) and max(r.size for r in found) < 21_000
    out = copybook.read(spark, str(tmp_path), book, xcom=True, big_endian=big).collect()
    assert sorted(r.K for r in out) == sorted(list(range(3000)) * 2) and all(set(r.T or "") <= {"x"} for r in out)
    with pytest.raises(Exception, match="no record header"):
        copybook.read(spark, written(tmp_path, b"\x01\x02\x03\x04abcdefgh", "d"), book, xcom=True).collect()
    with pytest.raises(Exception, match="cut off"):
        copybook.read(spark, written(tmp_path, struct.pack(">HH", 99, 0) if big else struct.pack("<HH", 0, 99), "d"), book, xcom=True, big_endian=big).collect()
