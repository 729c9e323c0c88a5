"""Names: folding, birth-date tokens and their comparison, character n-grams, and the token-sort ratio."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Letters that stand for two (fixed values).
DOUBLE = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}
#: Letters without a decomposition and what they are folded to (fixed values).
SINGLE = {"ø": "o", "đ": "d", "ð": "d", "ł": "l", "ħ": "h", "ı": "i", "ŧ": "t", "ŋ": "n"}
#: A letter for each month in a birth token (fixed values).
MONTHS = "ABCDEFGHIJKL"


def _folds() -> dict[str, str]:
    """Lower-case Latin letters with marks and the ASCII letters they decompose to."""
    out = dict(SINGLE)
    for code in range(0xC0, 0x250):
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if letter == letter.lower() and base != letter and base.isascii():
            out[letter] = base
    return out


FOLDS = _folds()


def folded_name(name: Column) -> Column:
    """Lower case without accents; punctuation becomes space, runs of space one space, none at the ends. Null is empty."""
    text = F.lower(F.coalesce(name.cast("string"), F.lit("")))
    for letter, two in DOUBLE.items():
        text = F.replace(text, F.lit(letter), F.lit(two))
    text = F.regexp_replace(F.translate(text, "".join(FOLDS), "".join(FOLDS.values())), r"\p{Mn}", "")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def birth_token(date: Column) -> Column:
    """``DDXYY`` of a date as text (year-month-day), X the month's letter; empty for null and for what is no such text."""
    part = F.split(F.coalesce(date.cast("string"), F.lit("")), "-")
    number = lambda i: F.get(part, F.lit(i)).try_cast("int")
    token = F.concat(F.lpad(number(2).cast("string"), 2, "0"), F.substr(F.lit(MONTHS), number(1), F.lit(1)), F.right(F.get(part, F.lit(0)), F.lit(2)))
    return F.when((F.size(part) == 3) & number(1).between(1, 12) & number(2).isNotNull(), token).otherwise(F.lit(""))


def birth_match(a: Column, b: Column) -> Column:
    """100 for equal dates (year-month-day texts), 90 a day apart in one month, 80 with day and month swapped, else 0; null if one is missing."""
    a, b = F.trim(F.nullif(a.cast("string"), F.lit(""))), F.trim(F.nullif(b.cast("string"), F.lit("")))
    x, y = F.split(a, "-"), F.split(b, "-")
    at = lambda p, i: F.get(p, F.lit(i))
    whole = (F.size(x) == 3) & (F.size(y) == 3) & (at(x, 0) == at(y, 0))
    near = (at(x, 1) == at(y, 1)) & (F.abs(at(x, 2).try_cast("int") - at(y, 2).try_cast("int")) <= 1)
    swapped = (at(x, 1) == at(y, 2)) & (at(x, 2) == at(y, 1))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(a == b, 100.0).when(whole & F.coalesce(near, F.lit(False)), 90.0).when(whole & swapped, 80.0).otherwise(0.0)


def grams(name: Column, n: int = 3) -> Column:
    """The character n-grams of a name without its spaces, repeats included."""
    text = F.replace(F.coalesce(name, F.lit("")), F.lit(" "), F.lit(""))
    places = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.substr(text, i, F.lit(n)))


def sorted_tokens(name: Column) -> Column:
    """A name's tokens in order, joined by one space."""
    return F.array_join(F.array_sort(F.split(F.trim(F.coalesce(name, F.lit(""))), r"\s+")), " ")


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a column of the table in one integer at a time."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    whole = row = (1 << len(a)) - 1
    for c in b:
        met = row & places.get(c, 0)
        row = ((row + met) | (row - met)) & whole
    return len(a) - row.bit_count()


@F.pandas_udf(DoubleType())
def subsequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 times twice the longest common subsequence over both lengths: with ``sorted_tokens`` the token-sort ratio. Null for an empty text."""
    return pd.Series([200.0 * common_subsequence(x, y) / (len(x) + len(y)) if x and y else None for x, y in zip(a, b, strict=True)], dtype="float64")
