"""Prediction: rows of reliable language, split into those of the target language and the rest, scored piece by piece, and written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scoring

#: Labels of scripts that the scorer can't read.
REFUSED = ("yue_Hant", "zho_Hant")


def reliable(rows: DataFrame, least: float = 0.6) -> DataFrame:
    """Rows whose language was still sure after deduplication; raises an error if one is in a refused script. Null scores are unsure."""
    fine = F.when(F.col("language").isin(*REFUSED), F.raise_error(F.concat(F.lit("script can't be scored: "), "language")).cast("boolean")).otherwise(F.lit(True))
    return rows.filter(F.col("dedup_after_lang_score") > least).filter(fine)


def is_target(language: str = "zh", least: float = 0.6):
    """Whether a row is of the target language, by what it was after deduplication or surely before."""
    after = F.coalesce(F.col("lang_after_dedup") == language, F.lit(False))
    return after | F.coalesce((F.col("language") == language) & (F.col("lang_score") > least), F.lit(False))


def split(rows: DataFrame, language: str = "zh", least: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """Rows to score, and the rest for its own output."""
    own = reliable(rows, least)
    return own.filter(is_target(language, least)), own.filter(~is_target(language, least))


def windows_needed(units: DataFrame, room: int) -> DataFrame:
    """most_windows: how many windows of room - 2 units the longest row of units (n) takes."""
    return units.agg(F.ceil(F.max(F.col("n") / (room - 2))).cast("long").alias("most_windows"))


def scored(rows: DataFrame, tokenizer: scoring.Tokenizer, scorer: scoring.Scorer, *, language: str = "zh", least: float = 0.6, length: int = 512, batch: int = 32, score_filter: float = 0.0, threshold: float = 0.5, convert: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the target language with the text of their good pieces, scores and bucket (see scoring.selected), and the rest as it is.

    rows as refined: text, language, lang_score, lang_after_dedup, dedup_after_lang_score and more. convert: what is done to texts before (scripts).
    """
    own, rest = split(rows, language, least)
    if convert is not None:
        own = own.withColumn("text", convert(F.col("text")))
    found = scoring.score(own, scoring.by_segment(tokenizer, length), scorer, length=length, batch=batch)
    return scoring.selected(found, score_filter, threshold), rest


def write_scored(found: DataFrame, rest: DataFrame, path: str) -> None:
    """JSON lines: scored rows below scored/bucket=hq and bucket=lowq, the rest below rest. Rows are scored once."""
    found.write.partitionBy("bucket").json(f"{path}/scored")
    rest.write.json(f"{path}/rest")


def document_scores(docs: DataFrame, tokenizer: scoring.Tokenizer, encoder: scoring.Scorer, model: Callable, *, length: int = 512, batch: int = 32, most: int | None = None) -> DataFrame:
    """docs with score: a model over the vectors that an encoder gives for their windows, the first `most` of them if given."""
    return scoring.score(docs, scoring.by_window(tokenizer, length, most), encoder, length=length, batch=batch, finish=model)
