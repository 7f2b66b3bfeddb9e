"""Extraction screens, paragraph and block boilerplate removal, group statistics.

Input rows are doc_id, text, domain, language; every stage is a DataFrame to DataFrame step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.windows import folded, mixed

#: Bits of the filter of shared anchors; beyond what these can tell apart, more blocks are counted, with the same result.
ANCHOR_BITS = 22


@dataclass(frozen=True)
class Config:
    keys: tuple[str, ...] = ("domain", "language")
    least_group: int = 7
    least_support: int = 3
    least_bytes: int = 200
    least_paralen: int = 10
    gate: float = 0.6
    final_gate: float = 0.4
    block: int = 50
    block_zh: int = 30
    #: Only blocks whose hash ends in so many zero bits are looked at; 0: all.
    block_bits: int = 0


def extract(docs: DataFrame, cfg: Config = Config(), languages: list[str] | None = None, blacklist: DataFrame | None = None) -> DataFrame:
    """Documents that are long enough, readable, of the languages asked for and of no blacklisted domain, cleaned."""
    own = docs.filter((F.octet_length("text") >= cfg.least_bytes) & T.is_readable(F.col("text")))
    if languages is not None:
        own = own.filter(F.col("language").isin(languages))
    if blacklist is not None:
        own = own.join(blacklist.select(F.col("domain")).distinct(), "domain", "left_anti")
    return own.withColumn("text", T.clean(F.col("text")))


def support_needed(n: Column, least: int) -> Column:
    """Documents of a group of n that must share a pattern: three, and more in groups where chance draws would not meet it."""
    tries = F.greatest(F.lit(20), F.least(F.lit(500), F.floor(n / 5)))
    return F.greatest(F.lit(least), F.ceil(n / F.sqrt(tries)))


def _few(groups: DataFrame, name: str) -> DataFrame:
    """groups as stored: their size is known before the join, so that few of them are broadcast and no rows are dealt by group, of which one may hold most rows."""
    from ..plans.session import stored

    return stored(groups, name)


def _sizes(docs: DataFrame, cfg: Config) -> DataFrame:
    """keys, group_docs of the groups that aren't small."""
    return _few(docs.groupBy(*cfg.keys).agg(F.count("*").alias("group_docs")).filter(F.col("group_docs") >= cfg.least_group), "group-sizes")


def paragraph_patterns(docs: DataFrame, cfg: Config = Config()) -> DataFrame:
    """keys, para_md5, support: paragraphs to remove, by exact counts; small groups are left alone."""
    keys = list(cfg.keys)
    paras = docs.select(*keys, "doc_id", F.explode(T.paragraphs(F.col("text"))).alias("para")).filter(F.octet_length("para") > 2)
    support = paras.select(*keys, "doc_id", F.md5(F.col("para").cast("binary")).alias("para_md5")).distinct().groupBy(*keys, "para_md5").agg(F.count("*").alias("support"))
    sizes = _sizes(docs, cfg)
    return support.filter(F.col("support") >= cfg.least_support).join(sizes, keys).filter(F.col("support") >= support_needed(F.col("group_docs"), cfg.least_support)).select(*keys, "para_md5", "support")


def _numbered(docs: DataFrame) -> DataFrame:
    """docs with a number of each row, `_row`; docs must be a table as read, stored or cached, as it is numbered more than once."""
    _reserved(docs, "_row", "_drop", "_examples", "n_removed", "patterns")
    return docs.withColumn("_row", F.monotonically_increasing_id())


def _without(own: DataFrame, hits: DataFrame, columns: list[str], examples: DataFrame | None = None) -> DataFrame:
    """Numbered rows without the paragraphs at places hits (_row, pos), and n_removed; texts are cut within their rows.

    examples (_row, pos, at, size): places of patterns, one each; `patterns` then has the texts of those that lie in a row.
    """
    drop = hits.groupBy("_row").agg(F.collect_set("pos").alias("_drop"))
    found = own.join(drop, "_row", "left")
    paras = T.paragraphs(F.col("text"))
    kept = F.filter(paras, lambda p, i: ~F.array_contains("_drop", i))
    text = F.when(F.col("_drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    more = []
    if examples is not None:
        found = found.join(examples.groupBy("_row").agg(F.collect_list(F.struct("pos", "at", "size")).alias("_examples")), "_row", "left")
        # in a step of its own: beside a new column text, the lambda would see that one
        found = found.withColumn("patterns", F.transform("_examples", lambda e: F.substr(F.get(paras, e["pos"]), e["at"] + 1, e["size"])))
        more = ["patterns"]
    return found.select(*(text.alias(c) if c == "text" else F.col(c) for c in columns), F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_removed"), *more)


def _reserved(docs: DataFrame, *names: str) -> DataFrame:
    """docs; raises an error where a column has a name that the step needs for itself."""
    clash = {c.lower() for c in docs.columns} & {n.lower() for n in names}
    if clash:
        raise ValueError(f"columns must not be named {', '.join(sorted(clash))}")
    return docs


def dedup_paragraphs(docs: DataFrame, cfg: Config = Config(), examples: bool = False) -> DataFrame:
    """docs with the shared paragraphs taken out, and n_removed; with `examples` also patterns: each paragraph that was taken out, in one row that had it.

    Each row is a document, repeated ids too; null texts stay null; rows with a null key stay as they are; further columns are kept.
    """
    keys = list(cfg.keys)
    own = _numbered(docs)
    patterns = paragraph_patterns(own.withColumn("doc_id", F.col("_row")), cfg).select(*keys, "para_md5")
    paras = own.select(*keys, "_row", F.posexplode(T.paragraphs(F.col("text"))).alias("pos", "para")).filter(F.octet_length("para") > 2)
    hits = paras.select(*keys, "_row", "pos", F.md5(F.col("para").cast("binary")).alias("para_md5")).join(patterns, [*keys, "para_md5"])
    if not examples:
        return _without(own, hits.select("_row", "pos"), docs.columns)
    from ..plans.session import stored

    hits = stored(hits, "paragraph-hits")
    first = hits.groupBy(*keys, "para_md5").agg(F.min(F.struct("_row", "pos")).alias("e")).select("e.*", F.lit(0).alias("at"), F.lit((1 << 31) - 1).alias("size"))
    return _without(own, hits, docs.columns, first)


def _blocks(paras: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each block of n characters: its paragraph, its hash, the least hash of the pieces of n // 2 characters in it, and its place."""
    codes = np.frombuffer("".join(paras).encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(codes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.array([len(p) for p in paras])
    owner = np.repeat(np.arange(len(paras)), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    own = owner[: len(owner) - n + 1] == owner[n - 1 :]
    anchor = folded(folded(codes, max(1, n // 2), mixed), n - max(1, n // 2) + 1, np.minimum)
    return owner[: len(own)][own], folded(codes, n, mixed)[own], anchor[own], place[: len(own)][own]


def _hashed(rows: DataFrame, cfg: Config, shared: Broadcast | None = None) -> DataFrame:
    """keys, doc_id, pos, hash and at (its first place), once a paragraph: of anchors, or of the blocks whose anchors are in the filter `shared`."""
    names = [*cfg.keys, "doc_id", "pos"]
    kinds = rows.select(*names).withColumns({"hash": F.lit(0).cast("long"), "at": F.lit(0)}).schema
    zeros = np.uint64((1 << cfg.block_bits) - 1)

    def emit(batches):
        for b in batches:
            sizes, texts = b.column("size").to_pylist(), b.column("para").to_pylist()
            for n in set(sizes):
                at, total = [], 0
                todo = [k for k, x in enumerate(sizes) if x == n]
                for k in todo:
                    at.append(k)
                    total += len(texts[k])
                    if total < 1 << 19 and k != todo[-1]:
                        continue
                    of, block, anchor, place = _blocks([texts[x] for x in at], n)
                    keep = block & zeros == 0
                    of, block, anchor, place = of[keep], block[keep], anchor[keep], place[keep]
                    if shared is not None:
                        keep = shared.value[(anchor & np.uint64((1 << ANCHOR_BITS) - 1)).astype(np.int64)]
                        of, block, place = of[keep], block[keep], place[keep]
                    value = anchor if shared is None else block
                    by = np.lexsort((value, of))  # stable: the first place of a hash comes first
                    of, value, place = of[by], value[by], place[by]
                    fresh = np.ones(len(of), bool)
                    fresh[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
                    of, value, place = of[fresh], value[fresh], place[fresh]
                    for lo in range(0, len(of), 1 << 16):
                        take = pa.array(np.array(at, np.int64)[of[lo : lo + (1 << 16)]])
                        yield pa.RecordBatch.from_arrays([*(b.column(x).take(take) for x in names), pa.array(value[lo : lo + (1 << 16)].view(np.int64)), pa.array(place[lo : lo + (1 << 16)].astype(np.int32))], names=[*names, "hash", "at"])
                    at, total = [], 0

    return rows.mapInArrow(emit, kinds)


def _shared(hashes: DataFrame, docs: DataFrame, cfg: Config) -> DataFrame:
    """keys, hash, support of the hashes that enough documents of a group share."""
    keys = list(cfg.keys)
    support = hashes.select(*keys, "doc_id", "hash").distinct().groupBy(*keys, "hash").agg(F.count("*").alias("support"))
    sizes = _sizes(docs, cfg)
    return support.filter(F.col("support") >= cfg.least_support).join(sizes, keys).filter(F.col("support") >= support_needed(F.col("group_docs"), cfg.least_support)).select(*keys, "hash", "support")


def _candidates(docs: DataFrame, cfg: Config) -> DataFrame:
    """keys, doc_id, pos, hash of all blocks that enough documents may share.

    A block's anchor is decided by its characters alone, so documents that share the block share its anchor: only blocks whose
    anchors enough documents have are counted, and no other can be shared by as many.
    """
    keys = list(cfg.keys)
    size = F.when(F.col("language") == "zh", cfg.block_zh).otherwise(cfg.block)
    rows = docs.select(*keys, "doc_id", size.alias("size"), F.posexplode(T.paragraphs(F.col("text"))).alias("pos", "para")).filter(F.length("para") >= F.col("size"))
    bits = _shared(_hashed(rows, cfg), docs, cfg).select(F.col("hash").bitwiseAND((1 << ANCHOR_BITS) - 1).alias("bit")).distinct().toArrow().column(0).to_numpy()
    shared = np.zeros(1 << ANCHOR_BITS, bool)
    shared[bits] = True
    return _hashed(rows, cfg, docs.sparkSession.sparkContext.broadcast(shared))


def block_patterns(docs: DataFrame, cfg: Config = Config()) -> DataFrame:
    """keys, hash, support: newline-free blocks of cfg.block characters (Chinese: cfg.block_zh), at every place, that enough documents share."""
    return _shared(_candidates(docs, cfg), docs, cfg)


def dedup_blocks(docs: DataFrame, cfg: Config = Config(), examples: bool = False) -> DataFrame:
    """docs without the paragraphs that hold a shared block, and n_removed; rows as in dedup_paragraphs.

    With `examples` also patterns: each block that is the first shared one of a paragraph, in one row that had it.
    """
    keys = list(cfg.keys)
    own = _numbered(docs)
    plain = own.withColumn("doc_id", F.col("_row"))
    from ..plans.session import stored

    blocks = stored(_candidates(plain, cfg), "blocks")  # counted and looked up: hashed once
    found = blocks.join(_shared(blocks, plain, cfg).select(*keys, "hash"), [*keys, "hash"], "left_semi").withColumnRenamed("doc_id", "_row")
    if not examples:
        return _without(own, found.select("_row", "pos").distinct(), docs.columns)
    hits = stored(found.groupBy(*keys, "_row", "pos").agg(F.min(F.struct("at", "hash")).alias("b")).select(*keys, "_row", "pos", "b.at", "b.hash"), "block-hits")
    size = F.when(F.col("language") == "zh", cfg.block_zh).otherwise(cfg.block)
    if "language" not in keys:
        hits = hits.join(own.select("_row", "language"), "_row")
    return _without(own, hits, docs.columns, hits.groupBy(*{**dict.fromkeys(keys), "language": None}, "hash").agg(F.min(F.struct("_row", "pos", "at")).alias("e")).select("e.*", size.alias("size")))


def flagged(docs: DataFrame, cfg: Config = Config()) -> DataFrame:
    """docs with a flag for each screen, and paralen."""
    t = F.col("text")
    return docs.select("*", T.has_repeated_spans(t).alias("span_repeat"), (T.textlen_bytes(t) < T.least_textlen(F.col("language"))).alias("short_text"), T.has_short_lines(t).alias("short_lines"), (T.paralen(t) <= cfg.least_paralen).alias("short_paras"), T.paralen(t).alias("paralen"))


def stats(docs: DataFrame, cfg: Config = Config()) -> DataFrame:
    """One row for each group: documents before and after the four screens of flagged(), and what each dropped, in its turn; no bad-word gate or dedup."""
    f = flagged(docs, cfg)
    span, text, lines, paras = (F.col(c) for c in ("span_repeat", "short_text", "short_lines", "short_paras"))
    kept = ~span & ~text & ~lines & ~paras
    own = f.groupBy(*cfg.keys).agg(
        F.count("*").alias("orig_len"),
        F.count_if(span).alias("num_span_repeat"),
        F.count_if(~span & text).alias("num_short_text"),
        F.count_if(~span & ~text & lines).alias("num_short_lines"),
        F.count_if(~span & ~text & ~lines & paras).alias("num_short_paralen"),
        F.count_if(kept).alias("len"),
        F.round(F.avg(F.when(kept, F.col("paralen"))), 6).alias("avg_paralen"),
        F.round(F.avg(F.when(kept, F.octet_length("text"))), 6).alias("avg_textlen"),
    )
    return own.withColumn("dirty", F.col("len") < cfg.final_gate * F.col("orig_len"))


def refine(docs: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Documents that pass the four screens of flagged(), of groups of which enough is left; no bad-word gate or dedup (see rounds)."""
    from ..plans.session import stored

    f = stored(flagged(docs, cfg), "flagged")  # the screens run once
    left = ~F.col("span_repeat") & ~F.col("short_text") & ~F.col("short_lines") & ~F.col("short_paras")
    kept = f.filter(left)
    clean = f.groupBy(*cfg.keys).agg(F.count("*").alias("orig_len"), F.count_if(left).alias("len")).filter(F.col("len") >= cfg.final_gate * F.col("orig_len")).select(*cfg.keys)
    clean = _few(clean, "clean-groups")
    return kept.join(clean, list(cfg.keys), "left_semi").select(*docs.columns, "paralen")


def rounds(docs: DataFrame, hits: Column, cfg: Config = Config(), most: int = 2, sens_gate: float = 0.1, detector: Callable[[Column], Column] | None = None) -> dict[str, DataFrame]:
    """The whole refinement, step by step: what is left of docs after each of the steps, by name, the last one "kept".

    hits: how many bad words a row has, or an array of them, which is kept as bad_words. detector: struct<lang, score> of a text, for what is left of it. "paras_cut" and
    "blocks_cut" are the rows before short texts go, with patterns: what was taken out, each in one row. Repeated spans go; then rows of more than `most` bad words, and groups of which they are more than sens_gate;
    then short texts. Groups of which less than cfg.gate is left go before shared paragraphs and before shared blocks are taken
    out, with short texts after each. At last short lines and short paragraphs go, and groups of which less than cfg.final_gate is left.
    """
    from ..plans.session import stored

    _reserved(docs, "_all", "_n", "_share", "n_hits", "bad_words", "orig_textlen", "para_removed", "block_removed", "paralen", "textlen", "text_ret_rate")
    listed = dict(docs.select(hits.alias("h")).dtypes)["h"].startswith("array")
    keys, t = list(cfg.keys), F.col("text")
    full = T.textlen_bytes(t) >= T.least_textlen(F.col("language"))
    totals = docs.groupBy(*keys).agg(F.count("*").alias("_all"))

    def gated(rows: DataFrame, share: float) -> DataFrame:
        groups = rows.groupBy(*keys).agg(F.count("*").alias("_n")).join(totals, keys).filter(F.col("_n") >= share * F.col("_all")).select(*keys)
        groups = _few(groups, "round-groups")
        return rows.join(groups, keys, "left_semi")

    own = docs.select("*", *([hits.alias("bad_words")] if listed else []), T.textlen_bytes(t).alias("orig_textlen"))
    own = own.withColumn("n_hits", F.size("bad_words") if listed else hits)
    span = stored(own.filter(~T.has_repeated_spans(t)), "round-span")
    clean = span.groupBy(*keys).agg((F.count_if(F.col("n_hits") > most) / F.count("*")).alias("_share")).filter(F.col("_share") <= sens_gate).select(*keys)
    clean = _few(clean, "round-clean")
    sens = span.filter(F.col("n_hits") <= most).join(clean, keys, "left_semi")
    text = sens.filter(full)
    paras_cut = stored(dedup_paragraphs(stored(gated(text, cfg.gate), "round-text"), cfg, True).withColumnRenamed("n_removed", "para_removed"), "round-paras")
    paras = paras_cut.drop("patterns").filter(full)
    blocks_cut = stored(dedup_blocks(stored(gated(paras, cfg.gate), "round-gate"), cfg, True).withColumnRenamed("n_removed", "block_removed"), "round-blocks")
    blocks = blocks_cut.drop("patterns").filter(full)
    lines = blocks.filter(~T.has_short_lines(t))
    ends = lines.filter(T.paralen(t) > cfg.least_paralen)
    out = gated(ends, cfg.final_gate).select("*", T.paralen(t).alias("paralen"), T.textlen_bytes(t).alias("textlen"), (F.octet_length("text") / F.col("orig_textlen")).alias("text_ret_rate"))
    if detector is not None:
        after = detector(t)
        out = out.withColumns({"lang_after_dedup": after["lang"], "dedup_after_lang_score": after["score"]})
    return {"all": docs, "paras_cut": paras_cut, "blocks_cut": blocks_cut, "span": span, "sens": sens, "text": text, "paras": paras, "blocks": blocks, "lines": lines, "paralen": ends, "kept": out}


def round_stats(steps: dict[str, DataFrame], cfg: Config = Config()) -> DataFrame:
    """For each group: rows left after each step (n_<step>), paragraphs and blocks taken out, and means over the rows kept."""
    keys = list(cfg.keys)
    out = steps["all"].groupBy(*keys).agg(F.count("*").alias("orig_len"))
    counted = [k for k in steps if k not in ("all", "kept", "paras_cut", "blocks_cut")]
    for name, rows in steps.items():
        if name in counted:
            out = out.join(rows.groupBy(*keys).agg(F.count("*").alias(f"n_{name}")), keys, "left")
    kept = steps["kept"].groupBy(*keys).agg(
        F.count("*").alias("len"), F.sum("para_removed").alias("num_dedup_para"), F.sum("block_removed").alias("num_dedup_block"),
        F.round(F.avg("paralen"), 6).alias("avg_paralen"), F.round(F.avg("text_ret_rate"), 6).alias("avg_text_ret_rate"),
    )
    counts = ["len", "num_dedup_para", "num_dedup_block", *(f"n_{k}" for k in counted)]
    return out.join(kept, keys, "left").na.fill(0, counts)


def group_patterns(steps: dict[str, DataFrame], cfg: Config = Config()) -> DataFrame:
    """For each group: orig_len, num_sens, sens_patterns (the bad words found), num_dedup_para, num_dedup_block, dedup_patterns (the paragraphs and blocks
    taken out, each once), and over the rows kept len, avg_lang_score, avg_dedup_after_lang_score, avg_paralen and avg_text_ret_rate, where their columns are there.

    Patterns are sorted. A group's lists are as long as it has different patterns, so they suit groups such as a domain's documents in a language.
    """
    keys = list(cfg.keys)
    out = steps["all"].groupBy(*keys).agg(F.count("*").alias("orig_len"))
    sens = steps["span"].groupBy(*keys).agg(F.count("*").alias("_span")).join(steps["sens"].groupBy(*keys).agg(F.count("*").alias("_left")), keys, "left")
    out = out.join(sens.select(*keys, (F.col("_span") - F.coalesce("_left", F.lit(0))).alias("num_sens")), keys, "left")
    if "bad_words" in steps["span"].columns:
        words = steps["span"].select(*keys, F.explode(F.array_distinct("bad_words")).alias("w")).distinct()
        out = out.join(words.groupBy(*keys).agg(F.array_sort(F.collect_list("w")).alias("sens_patterns")), keys, "left")
    cut = [steps[k].select(*keys, F.explode("patterns").alias("p")) for k in ("paras_cut", "blocks_cut")]
    out = out.join(cut[0].unionByName(cut[1]).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("p")).alias("dedup_patterns")), keys, "left")
    means = {"avg_lang_score": "lang_score", "avg_dedup_after_lang_score": "dedup_after_lang_score", "avg_paralen": "paralen", "avg_text_ret_rate": "text_ret_rate"}
    kept = steps["kept"]
    out = out.join(kept.groupBy(*keys).agg(F.count("*").alias("len"), F.sum("para_removed").alias("num_dedup_para"), F.sum("block_removed").alias("num_dedup_block"), *(F.avg(F.col(c).cast("double")).alias(k) for k, c in means.items() if c in kept.columns)), keys, "left")
    return out.na.fill(0, ["num_sens", "len", "num_dedup_para", "num_dedup_block"])


def is_dirty(stats_row: dict[str, Column] | None = None) -> Column:
    """The inspection rule over statistics: few documents, low quality, short paragraphs, or little left."""
    return (F.col("len") < 0.1) | (F.col("avg_quality") < 0) | (F.col("avg_paralen") < 20) | (F.col("len") / F.col("orig_len") < 0.3)


def screen_bad_words(docs: DataFrame, hits: Column, cfg: Config = Config(), most: int = 2, gate: float = 0.1, first: int | None = None) -> DataFrame:
    """doc_id, keys, flagged, group_dirty of each row, repeated ids too; hits: how many bad words a row has (null: none). `first` documents of a group, or all, set the gate."""
    from pyspark.sql import Window

    from ..plans.session import stored

    own = stored(docs.select("doc_id", *cfg.keys, (F.coalesce(hits, F.lit(0)) > most).alias("flagged")), "flags")
    seen = own
    if first is not None:
        seen = own.withColumn("_rank", F.row_number().over(Window.partitionBy(*cfg.keys).orderBy("doc_id"))).filter(F.col("_rank") <= first)
    gates = seen.groupBy(*(F.col(k).alias(f"_{k}") for k in cfg.keys)).agg((F.count_if("flagged") / F.count("*") > gate).alias("group_dirty"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in cfg.keys]
    return own.join(gates, same).select("doc_id", *cfg.keys, "flagged", "group_dirty")
