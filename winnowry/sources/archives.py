"""Reading of crawl archives and writing of stage outputs.

Archives are read in ranges (see wet); `register` also offers them as the data source "crawl".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from ..functions import text as T
from ..functions import url as U
from . import wet

def read_archives(spark: SparkSession, path: str, pattern: str = "*.gz") -> DataFrame:
    """The records of all archives below path, without what can't be read (see wet.read_records)."""
    return wet.read_records(spark, path, pattern).filter("error is null").drop("path", "offset", "error")


class Crawl(DataSource):
    """Archives as the data source "crawl", one task a range; options path, pattern, range (bytes)."""

    @classmethod
    def name(cls) -> str:
        return "crawl"

    def schema(self) -> str:
        return wet.SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return wet.RangeReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Crawl)


def extracted(rows: DataFrame, decoder, detector, languages: list[str] | None = None, blacklist: DataFrame | None = None, large: DataFrame | None = None) -> DataFrame:
    """text, uri, date, language, langscore, domain of conversion records; cheap screens come before decoding and detection.

    decoder and detector map columns to columns (see functions.lang). large: domain, parts of domains to split.
    """
    own = rows.filter((F.lower("warc_type") == "conversion") & (F.col("content_length") >= 200) & F.col("target_uri").isNotNull())
    own = own.withColumn("host", U.domain(F.col("target_uri"))).filter("host is not null")
    if blacklist is not None:
        own = own.join(blacklist.select(F.col("domain").alias("host")).distinct(), "host", "left_anti")
    own = own.withColumn("text", decoder(F.col("body"))).filter(F.col("text").isNotNull() & T.is_readable(F.col("text")) & (F.octet_length("text") >= 200))
    own = own.withColumn("found", detector(F.col("text")))
    if languages is not None:
        own = own.filter(F.col("found.lang").isin(languages))
    parts = F.lit(0)
    if large is not None:
        own = own.join(large.select(F.col("domain").alias("host"), "parts"), "host", "left")
        parts = F.coalesce("parts", F.lit(0))
    return own.select(T.clean(F.col("text")).alias("text"), F.col("target_uri").alias("uri"), F.coalesce("date", F.lit("")).alias("date"), F.col("found.lang").alias("language"), F.col("found.score").alias("langscore"), U.salted_domain(F.col("host"), F.col("target_uri"), parts).alias("domain"))


def extracted_table(spark: SparkSession, path: str) -> DataFrame:
    """Rows of already extracted parquet files; null dates and infos are empty, damaged files are passed over."""
    own = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("ignoreCorruptFiles", "true").parquet(path)
    return own.select("text", "uri", "domain", F.coalesce("date", F.lit("")).alias("date"), F.coalesce("info", F.lit("")).alias("info"), "language", F.col("langscore").cast("float").alias("langscore"))


def write_by_domain(rows: DataFrame, path: str) -> None:
    """Parquet below alpha=first letter; a domain's rows lie together."""
    rows.withColumn("alpha", F.substring("domain", 1, 1)).repartition("alpha", "domain").sortWithinPartitions("domain").write.partitionBy("alpha").option("compression", "snappy").parquet(path)


def write_rolled(rows: DataFrame, path: str, most: int = 100_000, kind: str = "parquet") -> None:
    """Files of at most `most` rows."""
    rows.write.format(kind).option("maxRecordsPerFile", most).save(path)


def write_hashes(hashes: DataFrame, path: str) -> None:
    hashes.sortWithinPartitions("hi", "lo").write.csv(path)


def read_hashes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema="doc_id long, hi long, lo long")


def write_buckets(scored: DataFrame, path: str) -> None:
    """JSON lines below bucket=hq and bucket=lowq."""
    scored.write.partitionBy("bucket").json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines that aren't blank."""
    return spark.read.text(path).select(F.trim("value").alias("value")).filter("value <> ''")


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """language, word of word lists named after their language."""
    own = spark.read.text(path, pathGlobFilter="*.txt").select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.txt$", 1).alias("language"), F.trim("value").alias("word"))
    return own.filter("word <> ''")


def read_training(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """text, label of scored JSON (an array if whole): label 1 for score 1, else cc_score where given."""
    own = spark.read.option("multiLine", whole).json(path)
    rest = F.col("cc_score") if "cc_score" in own.columns else F.lit(0)
    return own.select("text", F.when(F.col("score") == 1, 1).otherwise(rest).cast("double").alias("label"))


def read_essays(spark: SparkSession, path: str, rate: float = 1.0, words: int = 1024, seed: int = 0) -> DataFrame:
    """text, label of lines of id, text, label or text, label; a share of them, cut to some words."""
    f = F.split("value", "\t")
    own = spark.read.text(path).sample(fraction=rate, seed=seed) if rate < 1 else spark.read.text(path)
    n = F.size(f)
    return own.filter(n.isin(2, 3)).select(T.truncate_words(F.get(f, n - 2), words).alias("text"), F.get(f, n - 1).cast("double").alias("label"))


def write_domains(domains: DataFrame, path: str) -> None:
    """JSON lines, one domain each; a list in one document would have to pass through one task."""
    domains.select("domain").write.json(path)
