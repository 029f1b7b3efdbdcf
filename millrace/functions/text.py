"""Text helpers for parameters that come as one string: lists with quoted parts, and values in brackets or quotes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_quoted(text: Column, delimiter: str = ",", keep_empty_end: bool = False) -> Column:
    """Parts between delimiters that are outside double quotes; an empty text has none, empty parts at the end are left out unless asked for.

    Quotes are paired from the end, so of an odd number the first is an ordinary character that no delimiter before it counts. One pass over the text.
    """
    d = re.escape(delimiter)
    odd = F.regexp_count(text, F.lit('"')) % 2 == 1
    head = F.when(odd, F.regexp_extract(text, '^[^"]*"', 0)).otherwise(F.lit(""))
    rest = F.substring(text, F.length(head) + 1, F.length(text))
    parts = F.regexp_extract_all(F.concat(rest, F.lit(delimiter)), F.lit(f'((?:[^{d}"]|"[^"]*")*+){d}'), F.lit(1))
    whole = F.transform(parts, lambda x, i: F.when(i == 0, F.concat(head, x)).otherwise(x))
    filled = F.array_max(F.transform(whole, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
    ended = whole if keep_empty_end else F.slice(whole, F.lit(1), filled)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(ended)


def trim_ends(text: Column, start: str, end: str | None = None) -> Column:
    """A text of two characters or more without its first and last one, if they are these."""
    bounded = (F.length(text) > 1) & F.startswith(text, F.lit(start)) & F.endswith(text, F.lit(end or start))
    return F.when(bounded, F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)
