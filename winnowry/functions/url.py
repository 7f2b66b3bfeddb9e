"""Column expressions over URLs, hosts and archive paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IPV4 = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"


def host(url: Column) -> Column:
    """The host in lower case; null for unreadable URLs."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def domain(url: Column) -> Column:
    """The host where it is a name and no address."""
    h = host(url)
    return F.when(~F.rlike(h, F.lit(IPV4)) & ~F.startswith(h, F.lit("[")), h)


def salted_domain(name: Column, key: Column, parts: Column) -> Column:
    """`name---r` with r in 0 .. parts - 1 from a digest of key where parts is set, else the first 128 characters."""
    r = F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long"), parts.cast("long"))
    return F.when(parts > 0, F.concat(name, F.lit("---"), r.cast("string"))).otherwise(F.substring(name, 1, 128))


def reverse_host(name: Column) -> Column:
    return F.array_join(F.reverse(F.split(name, r"\.")), ".")


def path_listing(release: Column, kind: str) -> Column:
    """Where a crawl release lists its paths."""
    return F.format_string(f"crawl-data/%s/{kind}.paths.gz", release)


def segment_of(link: Column) -> Column:
    """The segment id of an archive link."""
    return F.rtrim(F.substring(link, 66, 16), F.lit("/"))


def flat_name(link: Column) -> Column:
    """What stands between "crawl-data/" and the sign before "warc" (the last two characters where that is missing), with - for /."""
    end = F.when(F.instr(link, "warc") > 0, F.instr(link, "warc") - 2).otherwise(F.length(link) - 2)
    begin = F.instr(link, "crawl-data/") + 10
    return F.replace(F.substr(link, begin + 1, F.greatest(F.lit(0), end - begin)), F.lit("/"), F.lit("-"))


def basename(link: Column) -> Column:
    return F.element_at(F.split(link, "/"), -1)
