"""Byte-level BPE texts cut into pre-tokens.

A pre-token is what the merges of the vocabulary never cross. A space before a character that isn't white space always starts
one, so a text whose white space is single spaces and line breaks falls apart at its spaces; a word that comes up again
needs no second look. Texts in which a space stands between white space are cut by the full pattern instead.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import cache

import regex

#: The split of the public 50k byte-level vocabularies.
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: A space that may belong to a longer run of white space: cutting there could change the pre-tokens.
GAP = re.compile(r"\s (?:\s|\Z)")
#: Characters that Unicode may have given a class after a library took over its tables; the ranges of ``unsettled`` lie here.
BEYOND = re.compile("[\u0530-\U0010FFFF]")


@cache
def unsettled() -> re.Pattern:
    """Code points without a class in Python's tables: on these, pattern libraries of different age may disagree."""
    free = [c for c in range(0x530, 0x110000) if unicodedata.category(chr(c)) == "Cn"]
    starts = [c for c, before in zip(free, [0, *free], strict=False) if c != before + 1]
    ends = [c for c, after in zip(free, [*free[1:], 0], strict=True) if c + 1 != after]
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True)) + "]")


def cut(text: str) -> list[str]:
    """Pre-tokens in order; a text with unsettled characters is cut by the tokenizers library itself."""
    if BEYOND.search(text) and unsettled().search(text):
        from tokenizers.pre_tokenizers import ByteLevel

        return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
    return PATTERN.findall(text)


def specials_of(names: Iterable[str]) -> re.Pattern | None:
    """Finds added special tokens, longest first, in texts; they are tokens of their own."""
    known = sorted(names, key=len, reverse=True)
    return re.compile("|".join(map(re.escape, known))) if known else None


def words(text: str) -> tuple[list[str], list[str]]:
    """A text as pre-tokens and as words that a space stands before; the pre-tokens of a word w are those of ``" " + w``."""
    if GAP.search(text):
        return cut(text), []
    first, *rest = text.split(" ")
    return cut(first) if first else [], rest


def of_word(word: str) -> list[str]:
    """Pre-tokens of a word with the space before it."""
    return [f" {word}"] if word.isalpha() else cut(f" {word}")
