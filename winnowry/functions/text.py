"""Column expressions over texts: screening, cleaning, splitting and n-grams.

Lengths named *_bytes are UTF-8 bytes, others code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import windows

#: Signs of text that was decoded with the wrong charset.
GARBLE_SIGNS = "�Ã©¤¶¼"

#: Lines of capitals, lines of digits, phone numbers, e-mail addresses, QQ numbers.
CLEAN_PATTERN = r"\n+[A-Z]+\n|\n+[0-9]+\n|\b\+?\d{1,3}\s?\d{4,14}\b|\b[\w\-\.]+@([\w-]+\.)+[\w-]{2,4}\b|\b[Qq]{2}.{1,3}\d{6,10}\b"

TRIM_PATTERN = r"^[\s\p{Z}\x0B\x{85}]+|[\s\p{Z}\x0B\x{85}]+$"


def garble_count(text: Column, within: int = 300) -> Column:
    """Signs of wrong decoding among the first characters."""
    return F.length(F.regexp_replace(F.substring(text, 1, within), f"[^{GARBLE_SIGNS}]", ""))


def is_readable(text: Column, most: int = 5) -> Column:
    return garble_count(text) <= most


def clean(text: Column) -> Column:
    """Text without boilerplate lines, phone numbers, e-mail addresses and QQ numbers; classes are Unicode-aware."""
    # without an @ no address matches: its branch, which reads each word anew from every place, is left out
    plain = "|".join(x for x in CLEAN_PATTERN.split("|") if "@" not in x)
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, "(?U)" + CLEAN_PATTERN, "")).otherwise(F.regexp_replace(text, "(?U)" + plain, ""))


def split_spans(text: Column) -> Column:
    """Spans between punctuation and separators; empty ends stay."""
    return F.split(text, r"[\p{P}\p{Z}]+", -1)


def has_repeated_spans(text: Column) -> Column:
    """Whether three neighbouring spans are equal; the last span isn't looked at."""
    return F.exists(F.transform(F.array(split_spans(text)), lambda w: F.when(F.size(w) >= 4, F.exists(F.sequence(F.lit(2), F.size(w) - 2), lambda i: (F.get(w, i) == F.get(w, i - 1)) & (F.get(w, i - 1) == F.get(w, i - 2)))).otherwise(False)), lambda x: x)


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n", -1)


def has_short_lines(text: Column, run: int = 5, least_bytes: int = 20) -> Column:
    """Whether `run` lines in a row are under least_bytes once trimmed."""
    flags = F.transform(paragraphs(text), lambda x: F.when(F.octet_length(F.regexp_replace(x, TRIM_PATTERN, "")) < least_bytes, "1").otherwise("0"))
    return F.contains(F.array_join(flags, ""), F.lit("1" * run))


def textlen_bytes(text: Column) -> Column:
    """Bytes without line feeds."""
    return F.octet_length(text) - F.size(paragraphs(text)) + 1


def paralen(text: Column) -> Column:
    """Whole bytes for each paragraph."""
    return F.floor(F.octet_length(text) / F.size(paragraphs(text))).cast("long")


def least_textlen(language: Column) -> Column:
    """Bytes that a document must have: 250, in Chinese 150."""
    return F.when(language == "zh", 150).otherwise(250)


def is_cjk(text: Column) -> Column:
    return F.rlike(text, F.lit("[一-龥]"))


def ngrams(text: Column, n: int, step: int) -> Column:
    """Character n-grams `step` apart; none if n or step exceed the text. One pass over the text: no gram is looked up from its beginning."""
    size = F.length(text)
    grams = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}})).{{1,{step}}}"), 1)
    return F.when((size >= n) & (size >= step), grams).otherwise(F.array().cast("array<string>"))


def ngram_lcs(a: Column, b: Column, least: int) -> Column:
    """The first block of the text of fewer bytes that the other contains: 100 characters 30 apart, then `least` 10 apart."""

    @F.pandas_udf("string")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for shorts, longs in parts:
            found = []
            for s, t in zip(shorts, longs, strict=True):
                none = s is None or t is None
                found.append(None if none else windows.first_shared(s, t, 100, 30) or windows.first_shared(s, t, least, 10))
            yield pd.Series(found, dtype=object)

    first = F.octet_length(a) <= F.octet_length(b)
    return run(F.when(first, a).otherwise(b), F.when(first, b).otherwise(a))


def ngram_match(block: Column, paras: Column, least_bytes: int) -> Column:
    """Number from 1 of the first paragraph of least_bytes or more that contains the block; 0 if none does."""
    return F.array_position(F.transform(paras, lambda p: (F.octet_length(p) >= least_bytes) & F.contains(p, block)), True)


def truncate_words(text: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(text, " ", -1), 1, n), " ")


def truncate_chars(text: Column, n: int) -> Column:
    """The first n characters without spaces."""
    return F.substring(F.replace(text, F.lit(" "), F.lit("")), 1, n)
