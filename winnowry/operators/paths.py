"""Crawl releases, path tables, download state and domain lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import url as U


def months(spark: SparkSession, start: str, end: str) -> DataFrame:
    """year, month, stamp yyyy/MM from end back to start; both dates are the first of a month, start not before August 2016."""
    if start < "2016-08-01":
        raise ValueError("releases begin in August 2016")
    own = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(end)), F.to_date(F.lit(start)), F.expr("interval -1 month"))).alias("day"))
    return own.select(F.year("day").alias("year"), F.month("day").alias("month"), F.date_format("day", "yyyy/MM").alias("stamp"))


def by_segment(links: DataFrame) -> DataFrame:
    """corpus, segment, links of link rows (corpus, link)."""
    return links.withColumn("segment", U.segment_of(F.col("link"))).groupBy("corpus", "segment").agg(F.array_sort(F.collect_list("link")).alias("links"))


def flatten_table(tables: DataFrame) -> DataFrame:
    """corpus/segment, link from rows of a JSON text {corpus: {segment: [link]}}."""
    parsed = F.from_json("value", "map<string,map<string,array<string>>>")
    one = tables.select(F.explode(parsed).alias("corpus", "segments")).select("corpus", F.explode("segments").alias("segment", "links"))
    return one.select(F.concat_ws("/", "corpus", "segment").alias("name"), F.explode("links").alias("link"))


def crawl_ids(texts: DataFrame) -> DataFrame:
    """All crawl ids in rows of text."""
    return texts.select(F.explode(F.regexp_extract_all("text", F.lit("(CC-MAIN.{8})"), 1)).alias("crawl_id"))


def in_years(ids: DataFrame, first: int, last: int, column: str = "crawl_id") -> DataFrame:
    return ids.filter(F.try_to_number(F.substring(F.col(column), -7, 4), F.lit("9999")).between(first, last))


def missing(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """Links whose file name isn't among the names that are there; files with an unfinished twin don't count."""
    unfinished = have.filter(F.endswith("name", F.lit(".aria2"))).select(F.regexp_replace("name", r"\.aria2$", "").alias("name"))
    done = have.filter(~F.endswith("name", F.lit(".aria2"))).join(unfinished, "name", "left_anti")
    return wanted.withColumn("name", U.basename(F.col("link"))).join(done, "name", "left_anti").drop("name")


def difference(rows: DataFrame, other: DataFrame, column: str) -> DataFrame:
    """Rows whose value the other lacks; repeats stay."""
    return rows.join(other.select(column), column, "left_anti")


def blacklist_with(blacklist: DataFrame, dirty: DataFrame) -> DataFrame:
    return blacklist.select("domain").union(dirty.select("domain")).distinct()


def host_ranks(lines: DataFrame) -> DataFrame:
    """Hosts of rank lines: the fifth field, reversed; the header goes."""
    own = lines.select(F.get(F.split(F.trim("value"), r"\s+"), F.lit(4)).alias("reversed")).filter("reversed is not null and not startswith(reversed, '#host')")
    return own.select(U.reverse_host(F.col("reversed")).alias("domain"))


def large_domains(lines: DataFrame, divisor: int = 10_000) -> DataFrame:
    """domain, parts of lines of host and count: the whole part of count / divisor."""
    fields = F.split("value", "\t")
    return lines.select(F.get(fields, F.lit(0)).alias("domain"), F.floor(F.get(fields, F.lit(1)).cast("long") / divisor).cast("int").alias("parts")).filter("parts is not null")
