"""Bad-word screening: one trie for each language, shared with the workers as a dictionary."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = ""


def build(words: list[str]) -> dict:
    """A trie as nested dictionaries; the key END marks a word."""
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        if w:
            node[END] = w
    return root


def begins(trie: dict, most: int = 64) -> re.Pattern | None:
    """Finds the places where words of two characters or more may begin: by their first two characters, or the first one where there are over `most` of these."""
    first = {c: "".join(map(re.escape, sorted(k for k in node if k != END))) for c, node in trie.items() if c != END and any(k != END for k in node)}
    if not first:
        return None
    if len(first) > most:
        return re.compile(f"[{''.join(map(re.escape, sorted(first)))}]")
    return re.compile("|".join(f"{re.escape(c)}(?=[{k}])" for c, k in sorted(first.items())))


def matches(trie: dict, text: str, fold: bool = False, places: re.Pattern | None = None) -> list[str]:
    """All occurrences of words of two characters or more, overlapping ones too, by where they begin, shorter first; places: begins(trie), where it is at hand."""
    text = text.lower() if fold else text
    places = places or begins(trie)
    out = []
    for m in places.finditer(text) if places else ():
        node, j = trie, m.start()
        i = j
        while j < len(text) and (node := node.get(text[j])) is not None:
            j += 1
            if END in node and j - i > 1:
                out.append(node[END])
    return out


def passes(trie: dict, text: str, most: int) -> bool:
    """One scan of the lower-cased text, from the root again at a miss, whose character is passed over; false beyond `most` hits."""
    node, hits = trie, 0
    for c in text.lower():
        node = node.get(c)
        if node is None:
            node = trie
        elif END in node:
            hits += 1
            if hits > most:
                return False
    return True


def forest(rows: DataFrame, most: int = 1_000_000) -> dict[str, dict]:
    """Tries by language from rows (language, word), of which there may be `most`."""
    held = rows.select("language", "word").limit(most + 1).collect()
    if len(held) > most:
        raise ValueError(f"more than {most} words")
    by: dict[str, list[str]] = {}
    for r in held:
        by.setdefault(r["language"], []).append(r["word"])
    return {k: build(v) for k, v in by.items()}


def find_matches(text: Column, language: Column, tries: dict[str, dict], fold: bool = False) -> Column:
    """Array of all matches; empty for languages without a trie."""

    @F.pandas_udf("array<string>")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        places = {k: begins(t) for k, t in tries.items()}
        for texts, languages in parts:
            yield pd.Series([matches(tries[k], t, fold, places[k]) if t and k in tries else [] for t, k in zip(texts, languages, strict=True)])

    return run(text, language)


def query(text: Column, language: Column, tries: dict[str, dict], most: int) -> Column:
    """Whether a text passes; true for languages without a trie."""

    @F.pandas_udf("boolean")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, languages in parts:
            yield pd.Series([passes(tries[k], t, most) if t and k in tries else True for t, k in zip(texts, languages, strict=True)], dtype=bool)

    return run(text, language)
