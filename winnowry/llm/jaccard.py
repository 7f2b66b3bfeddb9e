"""Jaccard join of documents on word shingles, by token-combination prefixes.

Texts are read once. Shingles are dealt by their hashes and counted over the whole corpus; those that only one set holds can't
be shared, so only the others go back to their sets, each with the number of sets that hold it. They are the sets' prefixes,
buckets and what is compared in the end: single ones count only by their number.

Shingles are ordered by how many sets hold them, rare ones first, and by hash. Rare ones are indexed alone, frequent ones (FEW sets) in
pairs, very frequent ones (MANY sets) in triples, within groups by hash. A set's prefix is extended until those of its
shingles that can't be left out of combinations outnumber those that a linked set may lack: two sets that link then share a rare
shingle or a combination of one group. The number of groups grows with the set's size, so that combinations stay few; sets
whose linked ones may have more groups are indexed with both numbers. Sets of three to five shingles are indexed whole and with
each one left out.

Of buckets that hold the same sets one stays: what copied passages share is many shingles, but one bucket. A bucket of the index isn't
expanded into all pairs. Each class (documents with equal sets) is compared with few others that it
meets, chosen anew in rounds; components of the links found so far are formed; then only members of different components are left whose
sizes, places and shared shingles allow a link. They are met within tasks, in blocks of BLOCK rows of a bucket, by bitmaps of their
shingles: how many bits differ bounds how many shingles are shared, from above. Only pairs that this bound lets link go on and are compared
shingle by shingle. No link between different sets is lost to this: pairs within a component add nothing to components. What the
bound costs: a bucket of b rows of different components takes b * b / 2 bounds of half a byte a shingle, in (b / BLOCK)**2 / 2 tasks' groups.

Rows are numbered more than once, so the input must be a table as read, stored or cached, not a plan whose row order may change.

Rows: null, empty or wordless text has no shingles and links with nothing; fewer words than a shingle's are one shingle;
null doc_ids are kept, and stand for no component unless all of it have null; repeated doc_ids are kept row by row; further
columns are ignored or passed through. Shingles are told apart by 40 bits of their hash and those that choose the part, which
grow with the corpus. Memory: a chunk of about CHUNK shingles, or those of one longer text, or one part of the counts; shingles in HOT
sets of a chunk go to their part once for the chunk.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, cut, ranges, stored, table, text_parts
from .hashing import mix
from .words import LOWER, VISIBLE, hashes, spans

WORDS = 5
#: Shingles and documents of a chunk, sets of a chunk from which a shingle is sent once, bytes of text for each part of the counts.
CHUNK, DOCS, HOT, PART = 1 << 20, 60_000, 4, 8 << 20
#: Shingles in FEW sets are indexed in pairs, those in MANY in triples; beyond MOST, sets aren't told apart by how many hold a shingle.
FEW, MANY, MOST = 1024, 16384, 65535
#: Sets of 2**k * BAND shingles have 2**k groups of combinations.
BAND = 5.5
#: Members that stand for a bucket in a round, those of them that a class is compared with, and the most rounds.
PIVOTS, BEST, TURNS = 4, 3, 12
#: Rounds end with so few pairs of different components for each row of the index that is left, or where one finds no link.
LEFT = 0.1
NONE = (1 << 63) - 1
#: Rows of a block; bits of a bitmap at most, beyond which the bound grows weaker, not wrong.
BLOCK, BITS = 256, 1 << 17


def shingles(data: np.ndarray, at: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the rows, with repeats, and the rows they are of, ascending."""
    n = len(at) - 1
    base = int(at[0])
    lower = LOWER[data[base : at[-1]]]
    begin, end = spans(lower, at - base, VISIBLE)
    keys = hashes(lower, begin, end)
    first = np.searchsorted(begin, at - base)
    count = np.diff(first)
    row = np.repeat(np.arange(n), count)
    ks = np.flatnonzero(np.arange(len(keys)) - first[row] + words <= count[row])
    total = np.zeros(len(ks), np.uint64)
    for k in range(words):
        total = mix(total + keys[ks + k] + np.uint64(k + 1))
    short = np.flatnonzero((count > 0) & (count < words))
    if not len(short):
        return total, row[ks]
    rest = np.zeros(len(short), np.uint64)
    for i, r in enumerate(short.tolist()):
        x = np.full(1, 7919, np.uint64)
        for k in range(first[r], first[r + 1]):
            x = mix(keys[k : k + 1] + x * np.uint64(31))
        rest[i] = x[0]
    value, owner = np.concatenate([total, rest]), np.concatenate([row[ks], short])
    by = np.argsort(owner, kind="stable")
    return value[by], owner[by]


def distinct(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different (value, owner), by value and then owner."""
    by = np.argsort(value)
    value, owner = value[by], owner[by]
    same = np.zeros(len(value) + 1, bool)
    same[1:-1] = value[1:] == value[:-1]
    many = np.flatnonzero(same[1:] | same[:-1])
    owner[many] = owner[many][np.lexsort((owner[many], value[many]))]
    fresh = ~same[:-1]
    fresh[1:] |= owner[1:] != owner[:-1]
    return value[fresh], owner[fresh]


def keys_of(value: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key for each of n sets, and the sets' sizes."""
    count = np.bincount(owner, minlength=n).astype(np.int64)
    sums = np.zeros(n, np.uint64)
    np.add.at(sums, owner, mix(value ^ np.uint64(0x5BD1E995)))
    return mix(mix(sums) + count.astype(np.uint64)), count


def pack(*arrays: np.ndarray) -> bytes:
    return b"".join([np.array([len(arrays), *map(len, arrays)], np.int64).tobytes(), *(np.ascontiguousarray(a).astype(np.int64, copy=False).tobytes() for a in arrays)])


def unpack(data: bytes) -> list[np.ndarray]:
    x = np.frombuffer(data, np.int64)
    ends = np.cumsum(x[1 : 1 + x[0]]) + 1 + x[0]
    return [x[e - n : e] for e, n in zip(ends, x[1 : 1 + x[0]], strict=True)]


def _split(key: np.ndarray) -> bytes:
    """40-bit numbers as their lower 32 bits and then their upper 8."""
    return (key & 0xFFFFFFFF).astype("<u4").tobytes() + (key >> 32).astype(np.uint8).tobytes()


def _joined(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u4", n).astype(np.int64) | np.frombuffer(data, np.uint8, n, 4 * n).astype(np.int64) << 32


#: Rows between the steps: of a chunk (kind 1: its documents, sets and lists of sets with frequent shingles) and of a part of its shingles.
ROW = "part int, chunk long, kind int, data binary, more binary, hot binary"
ROW_ARROW = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("data", pa.binary()), ("more", pa.binary()), ("hot", pa.binary())])


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ROW_ARROW, strict=True)] if rows else [pa.array([], f.type) for f in ROW_ARROW], schema=ROW_ARROW)


def dealt(docs: DataFrame, bits: int, words: int = WORDS) -> DataFrame:
    """The shingles of (uid, doc_id, text) in 2**bits parts, and a row of each chunk's documents and sets."""

    def emit(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        ids: list[pa.RecordBatch] = []
        size = many = 0

        def flush():
            value, owner = distinct(np.concatenate([v for v, _ in held]), np.concatenate([o for _, o in held]))
            sid, n = keys_of(value, owner, many)
            uid = np.concatenate([b.column(0).to_numpy() for b in ids])
            doc_id = np.concatenate([b.column(1).fill_null(0).to_numpy() for b in ids])
            null = np.concatenate([b.column(1).is_null().to_numpy(zero_copy_only=False) for b in ids])
            full = np.flatnonzero(n > 0)
            sids, first, of = np.unique(sid[full], return_index=True, return_inverse=True)
            number = np.full(many, -1, np.int64)
            number[full] = of
            stays = np.zeros(many, bool)
            stays[full[first]] = True
            keep = stays[owner]
            value, owner = value[keep], number[owner[keep]]
            short = value >> np.uint64(24 - bits) << np.uint64(24 - bits)
            if ((short[1:] == short[:-1]) & (value[1:] != value[:-1])).any():
                short, owner = distinct(short, owner)
            value = short
            part = (value >> np.uint64(64 - bits)).astype(np.int64)
            key = ((value << np.uint64(bits)) >> np.uint64(24)).astype(np.int64)
            begins = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])])) if len(key) else np.zeros(0, np.int64)
            count = np.diff(np.append(begins, len(key)))
            hot = count >= HOT
            plain = np.repeat(~hot, count)
            p, k, o = part[plain], key[plain], owner[plain]
            hp, hk, hn = part[begins[hot]], key[begins[hot]], count[hot]
            at, hat = np.searchsorted(p, np.arange((1 << bits) + 1)), np.searchsorted(hp, np.arange((1 << bits) + 1))
            chunk = int(uid[0])
            yield (int(mix(uid[:1].astype(np.uint64))[0] % np.uint64(1 << bits)), chunk, 1, pack(uid, doc_id, null, number), pack(sids.view(np.int64), n[full[first]]), pack(hp << 40 | hk, hn, owner[~plain]))
            for i in np.flatnonzero((np.diff(at) > 0) | (np.diff(hat) > 0)).tolist():
                own, hown = slice(at[i], at[i + 1]), slice(hat[i], hat[i + 1])
                yield i, chunk, 0, _split(k[own]) + o[own].astype("<u2").tobytes(), None, _split(hk[hown]) + hn[hown].astype("<u4").tobytes()

        def flushed():
            rows = []
            for r in flush():
                rows.append(r)
                if len(rows) == 4096:
                    yield from _rows(rows).to_batches()
                    rows = []
            yield from _rows(rows).to_batches()

        for b in batches:
            data, at = text_parts(b.column(2))
            for lo, hi in chunks(at):
                for x in range(lo, hi, DOCS):
                    y = min(hi, x + DOCS)
                    value, owner = shingles(data, at[x : y + 1], words)
                    if many and (size + len(value) > CHUNK or many + y - x > DOCS):
                        yield from flushed()
                        held, ids, size, many = [], [], 0, 0
                    held.append((value, owner + many))
                    ids.append(b.select(["uid", "doc_id"]).slice(x, y - x))
                    size += len(value)
                    many += y - x
        if many:
            yield from flushed()

    return docs.select("uid", "doc_id", "text").mapInArrow(emit, ROW)


def counted(rows: DataFrame) -> DataFrame:
    """For each chunk and part, the shingles that several sets hold and by how many, MOST at most; chunk rows as they are."""

    def count(key, t):
        rows = [tuple(r.values()) for r in t.to_pylist()]
        out = [r for r in rows if r[2]]
        rows = [r for r in rows if not r[2]]
        if not rows:
            return _rows(out)
        n, h = [len(r[3]) // 7 for r in rows], [len(r[5]) // 9 for r in rows]
        keys = np.concatenate([*(_joined(r[3], k) for r, k in zip(rows, n, strict=True)), *(_joined(r[5], k) for r, k in zip(rows, h, strict=True))])
        many = np.concatenate([np.ones(sum(n), np.int64), *(np.frombuffer(r[5], "<u4", k, 5 * k).astype(np.int64) for r, k in zip(rows, h, strict=True))])
        by = np.argsort(keys)
        ordered = keys[by]
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        total = np.add.reduceat(many[by], begins)
        held = np.zeros(len(keys), "<u2")
        held[by] = np.repeat(np.minimum(MOST, total).astype("<u2"), np.diff(np.append(begins, len(keys))))
        a, z = np.concatenate([[0], np.cumsum(n)]), sum(n) + np.concatenate([[0], np.cumsum(h)])
        for i, r in enumerate(rows):
            own, hown = slice(a[i], a[i + 1]), slice(z[i], z[i + 1])
            keep = held[own] > 1
            if keep.any() or h[i]:
                refs = np.frombuffer(r[3], "<u2", n[i], 5 * n[i])
                out.append((*r[:3], _split(keys[own][keep]) + held[own][keep].tobytes() + refs[keep].tobytes(), None, _split(keys[hown]) + held[hown].tobytes()))
        return _rows(out)

    return rows.groupBy("part").applyInArrow(count, ROW)


def groups_of(n: np.ndarray) -> np.ndarray:
    """How many groups of combinations sets of these sizes have."""
    return 1 << np.maximum(0, np.floor(np.log2(np.maximum(n, 1) / BAND))).astype(np.int64)


def signatures(key: np.ndarray, many: np.ndarray, offs: np.ndarray, n: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index keys of sets, the sets they are of, and places: of a single shingle in its set's order, of a combination the first frequent one's.

    The first shingle that two sets share, if it is rare, is an index key of both, as all before it are among those that a set may lack; if it is frequent,
    they share no rare ones. So sets that link meet in a bucket from whose places on both have as many shingles as they share.

    key, many: the shingles of each set that others hold too and how many hold them, by many and key; offs: the sets' offsets; n: the sets' sizes.
    """
    count = np.diff(offs)
    owner = np.repeat(np.arange(len(n)), count)
    place = np.arange(len(key)) - offs[:-1][owner] + (n - count)[owner]
    kind = 1 + (many >= FEW).astype(np.int64) + (many >= MANY)
    group = np.where(kind > 1, (mix(key.view(np.uint64) ^ np.uint64(0xA5A5)) % groups.astype(np.uint64)[owner]).astype(np.int64), 0)
    rare = n - np.bincount(owner[kind > 1], minlength=len(n))
    # the how manieth of its group each is: those before the kind-th don't count
    cell = np.lexsort((place, group, kind, owner))
    o, k, g = owner[cell], kind[cell], group[cell]
    begins = np.concatenate([[True], (o[1:] != o[:-1]) | (k[1:] != k[:-1]) | (g[1:] != g[:-1])]) if len(cell) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(begins, np.arange(len(cell)), 0)) if len(cell) else np.zeros(0, np.int64)
    nth = np.empty(len(cell), np.int64)
    nth[cell] = np.arange(len(cell)) - start
    counts = nth >= kind - 1
    run = np.concatenate([[0], np.cumsum(counts)])
    before = run[:-1] - run[offs[:-1]][owner] + (n - count)[owner]
    need = n - (3 * n + 3) // 4 + 1
    inside = before < need[owner]
    single = inside & (kind == 1)
    sigs, of, at = [mix(key[single].view(np.uint64) ^ np.uint64(0x51))], [owner[single]], [place[single]]
    cell = cell[inside[cell] & (kind[cell] > 1)]
    o, k, v = owner[cell], kind[cell], mix(key[cell].view(np.uint64) + np.uint64(0x77))
    cid = np.cumsum(np.concatenate([[True], (o[1:] != o[:-1]) | (k[1:] != k[:-1]) | (group[cell][1:] != group[cell][:-1])])) if len(cell) else o
    for i in range(1, len(cell)):
        two = np.flatnonzero(cid[i:] == cid[:-i])
        if not len(two):
            break
        pair = v[two] * np.uint64(0x9E3779B97F4A7C15) + v[two + i]
        twos = k[two] == 2
        sigs.append(mix(pair[twos]))
        of.append(o[two[twos]])
        at.append(rare[of[-1]])
        two, pair = two[~twos] + i, pair[~twos]
        for j in range(1, len(cell)):
            two, pair = two[two + j < len(cell)], pair[: (two + j < len(cell)).sum()]
            more = cid[two + j] == cid[two]
            if not more.any():
                break
            sigs.append(mix(mix(pair[more]) * np.uint64(0xC2B2AE3D27D4EB4F) + v[two[more] + j]))
            of.append(o[two[more]])
            at.append(rare[of[-1]])
    return np.concatenate(sigs), np.concatenate(of), np.concatenate(at)


def tiny(key: np.ndarray, offs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of sets of three to five shingles, and the sets: whole up to four, and with one left out from four on."""
    sigs, of = [], []
    count = np.diff(offs)
    for i in np.flatnonzero((n >= 3) & (n <= 5) & (count >= np.minimum(n, 4) - (n == 4))).tolist():
        own = sorted(key[offs[i] : offs[i + 1]].tolist())
        for size in {int(n[i]), int(n[i]) - 1} & {3, 4}:
            for x in combinations(own, size):
                sigs.append(hash((size, x)) & 0xFFFFFFFFFFFFFFFF)  # of integers: the same in every process
                of.append(i)
    return mix(np.array(sigs, np.uint64)), np.array(of, np.int64)


#: Rows of documents have uid; those of sets that may link have shingles, ascending, and how many sets hold each.
SETS = "uid long, doc_id long, sid long, n long, shingles binary, many binary"
SETS_ARROW = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary()), ("many", pa.binary())])


def gathered(rows: DataFrame) -> DataFrame:
    """Documents of each chunk, and its sets of which other sets hold enough shingles for a link."""

    def gather(key, t):
        refs, keys, counts = [], [], []
        hot_keys, hot_counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in t.to_pylist():
            if r["kind"]:
                uid, doc_id, null, number = unpack(r["data"])
                sids, n = unpack(r["more"])
                listed, size, lists = unpack(r["hot"])
                continue
            top = r["part"] << 40
            m, h = len(r["data"]) // 9, len(r["hot"]) // 7
            keys.append(_joined(r["data"], m) | top)
            counts.append(np.frombuffer(r["data"], "<u2", m, 5 * m).astype(np.int64))
            refs.append(np.frombuffer(r["data"], "<u2", m, 7 * m).astype(np.int64))
            hot_keys.append(_joined(r["hot"], h) | top)
            hot_counts.append(np.frombuffer(r["hot"], "<u2", h, 5 * h).astype(np.int64))
        hk, hc = np.concatenate(hot_keys), np.concatenate(hot_counts)
        place, ends = np.searchsorted(listed, hk), np.cumsum(size)
        key = np.concatenate([*keys, np.repeat(hk, size[place])])
        many = np.concatenate([*counts, np.repeat(hc, size[place])])
        ref = np.concatenate([*refs, lists[ranges(ends[place] - size[place], size[place])]])
        by = np.lexsort((key, ref))
        key, many, ref = key[by], many[by].astype("<u2"), ref[by]
        count = np.bincount(ref, minlength=len(sids))
        offs = np.concatenate([[0], np.cumsum(count)])
        some = np.flatnonzero((n >= 3) & (4 * count >= 3 * n))
        blobs = [[x[offs[i] : offs[i + 1]].tobytes() for i in some.tolist()] for x in (key, many)]
        docs = pa.Table.from_arrays([pa.array(uid), pa.array(doc_id, mask=null != 0), pa.array(np.append(sids, 0)[number], mask=number < 0), pa.array(np.append(n, 0)[number]), *(pa.nulls(len(uid), pa.binary()) for _ in range(2))], schema=SETS_ARROW)
        sets = pa.Table.from_arrays([*(pa.nulls(len(some), pa.int64()) for _ in range(2)), pa.array(sids[some]), pa.array(n[some]), *(pa.array(x, pa.binary()) for x in blobs)], schema=SETS_ARROW)
        return pa.concat_tables([docs, sets])

    return rows.groupBy("chunk").applyInArrow(gather, SETS)


INDEX = "sid long, n long, rep long, sigs array<long>, places array<int>"


def indexed(sets: DataFrame) -> DataFrame:
    """INDEX rows of the sets in SETS rows; rep is how many of a set's shingles other sets hold.

    Copies of a set in several chunks are counted as many sets. A shingle that just so many hold is in no other set.
    """
    once = sets.groupBy("sid").agg(F.count("*").alias("copies"), F.first("n").alias("n"), F.first("shingles").alias("shingles"), F.first("many").alias("many"))

    def index(batches):
        for b in batches:
            blobs, counts = b.column(3).to_pylist(), b.column(4).to_pylist()
            sizes = np.cumsum([len(x) for x in counts])
            lo = 0
            while lo < len(blobs):
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + CHUNK)))
                yield signed(b.slice(lo, hi - lo), blobs[lo:hi], counts[lo:hi])
                lo = hi

    def signed(b, blobs, counts):
        sid, copies, n = (b.column(i).to_numpy() for i in range(3))
        key, many = np.frombuffer(b"".join(blobs), np.int64), np.frombuffer(b"".join(counts), "<u2").astype(np.int64)
        ref = np.repeat(np.arange(len(n)), [len(x) // 8 for x in blobs])
        shared = (many > copies[ref]) | (many == MOST)
        key, many, ref = key[shared], many[shared], ref[shared]
        by = np.lexsort((key, many, ref))
        key, many, ref = key[by], many[by], ref[by]
        rep = np.bincount(ref, minlength=len(n))
        offs = np.concatenate([[0], np.cumsum(rep)])
        own = groups_of(n)
        found = [signatures(key, many, offs, n, own)]
        wider = np.flatnonzero(groups_of(n * 4 // 3) > own)
        if len(wider):  # sets that may link with some of more groups
            s, o, a = signatures(key[ranges(offs[:-1][wider], rep[wider])], many[ranges(offs[:-1][wider], rep[wider])], np.concatenate([[0], np.cumsum(rep[wider])]), n[wider], 2 * own[wider])
            found.append((s, wider[o], a))
        found = [tuple(x[n[o] >= 5] for x in (s, o, a)) for s, o, a in found]
        s, o = tiny(key, offs, n)
        sigs, of, at = (np.concatenate(x) for x in zip(*found, (s, o, np.zeros(len(s), np.int64)), strict=True))
        by = np.lexsort((sigs, of))
        sigs, of, at = sigs[by], of[by], at[by]
        fresh = np.ones(len(sigs), bool)
        fresh[1:] = (sigs[1:] != sigs[:-1]) | (of[1:] != of[:-1])
        sigs, of, at = sigs[fresh], of[fresh], at[fresh]
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(n)))]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (sigs.view(np.int64), at.astype(np.int32))]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(rep.astype(np.int64)), *lists], names=["sid", "n", "rep", "sigs", "places"])

    return once.mapInArrow(index, INDEX)


def class_rows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """SETS of docs (uid, doc_id, text)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(3, int(total // PART).bit_length())
    return stored(gathered(counted(dealt(docs, bits, words))), "shingle-sets")


def may(x: Column, y: Column) -> Column:
    """Whether sets of such sizes, shared shingles at most, and places may link; they share 3 * (n + m) / 7 shingles then."""
    n, m = x["n"], y["n"]
    least = F.least(x["rep"], y["rep"], n - x["place"], m - y["place"])
    return (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (7 * least >= 3 * (n + m))


def spare() -> Column:
    """Three times the largest size of a set that a row may link with, as far as its shared shingles and its place tell."""
    return 7 * F.least("x.rep", F.col("x.n") - F.col("x.place")) - 3 * F.col("x.n")


def bounds(rows: DataFrame) -> DataFrame:
    """For each bucket of several components: the largest spare() and the least size, the components that have them, and the same among all others.

    rows: sig, x.
    """
    comps = rows.groupBy("sig", F.col("x.comp").alias("comp")).agg(F.max(spare()).alias("most"), F.min("x.n").alias("least"))
    one = comps.groupBy("sig").agg(F.max(F.struct("most", "comp")).alias("most_of"), F.min(F.struct("least", "comp")).alias("least_of"), F.count("*").alias("n")).filter("n > 1").drop("n")
    other = lambda c: F.when(F.col("comp") != F.col(f"{c}_of.comp"), F.col(c))
    return comps.join(one, "sig").groupBy("sig").agg(F.first("most_of").alias("most_of"), F.first("least_of").alias("least_of"), F.max(other("most")).alias("most_else"), F.min(other("least")).alias("least_else"))


def open_rows() -> Column:
    """Whether a row joined with its bucket's bounds may still link with one of another component; what `may` refuses for all of them is left out."""
    else_ = lambda c: F.when(F.col("x.comp") != F.col(f"{c}_of.comp"), F.col(f"{c}_of.{c}")).otherwise(F.col(f"{c}_else"))
    return (else_("most") >= 3 * F.col("x.n")) & (spare() >= 3 * else_("least"))


def compare(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """Of the pairs (a, b, ...) those whose sets link: 100 * intersection >= 75 * union. held: sid, n and shingles, with repeats."""

    def check(batches):
        for b in batches:
            keep = []
            for n, m, x, y in zip(*(b.column(i).to_pylist() for i in range(b.num_columns - 4, b.num_columns)), strict=True):
                both = len(np.intersect1d(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), assume_unique=True))
                keep.append(100 * both >= 75 * (n + m - both))
            yield b.select(list(range(b.num_columns - 4))).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    held = held.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    one = held.select(F.col("sid").alias("a"), F.col("n").alias("_n"), F.col("shingles").alias("_x"))
    two = held.select(F.col("sid").alias("b"), F.col("n").alias("_m"), F.col("shingles").alias("_y"))
    own = pairs.columns
    return pairs.join(one, "a").join(two, "b").select(*own, "_n", "_m", "_x", "_y").mapInArrow(check, pairs.schema)


def components(links: DataFrame) -> DataFrame:
    """sid, comp: the smallest sid that links (a, b) reach, for all sids in links. Rounds until nothing changes."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
    labels = cut(labels.select(F.col("a").alias("sid"), "label"))
    while True:
        near = both.join(labels.withColumnRenamed("sid", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "sid"), "sid").select("sid", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = step.select(F.col("sid").alias("label"), F.col("label").alias("far"))
        new = cut(step.join(jump, "label", "left").select("sid", "old", F.least("label", F.coalesce("far", "label")).alias("label")))
        changed = new.filter("label <> old").limit(1).count()
        labels = new.select("sid", "label")
        if not changed:
            return labels.withColumnRenamed("label", "comp")


def once_each(rows: DataFrame) -> DataFrame:
    """sig, least (the smallest size) of the buckets of several sets, and of those of the same sets one: that of the first shingle in the sets' order.

    All its sets share the others, too, so that none of their pairs shares a shingle of these before it; places in it are the least for all.
    """
    members = [F.bit_xor(F.xxhash64("x.sid", F.lit(k))).alias(f"m{k}") for k in range(2)]
    buckets = rows.groupBy("sig").agg(F.count("*").alias("rows"), F.min("x.sid").alias("lo"), F.max("x.sid").alias("hi"), F.min("x.n").alias("least"), F.min(F.struct("x.sid", "x.place")).alias("first"), *members).filter("lo <> hi")
    return buckets.groupBy("m0", "m1", "rows").agg(F.min(F.struct("first.place", "sig", "least")).alias("b")).select("b.sig", "b.least")


def bitmap(keys: np.ndarray) -> bytes:
    """One of 2 to 4 bits a key, BITS at most, set for each key by its hash; longer ones fold into shorter ones by halves."""
    size = min(BITS, max(64, 2 << int(max(1, len(keys)) - 1).bit_length()))
    bits = np.zeros(size, bool)
    bits[(mix(keys.view(np.uint64) ^ np.uint64(0x3C3C)) % np.uint64(size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def differing(xs: list[bytes], ys: list[bytes]) -> np.ndarray:
    """How many bits each x and each y differ in, the longer folded to the shorter one's size."""
    out = np.zeros((len(xs), len(ys)), np.int64)

    def fold(rows: np.ndarray, size: int) -> np.ndarray:
        while rows.shape[1] > size:
            half = rows.shape[1] // 2
            rows = rows[:, :half] | rows[:, half:]
        return rows

    by_size = [{n: np.array([i for i, v in enumerate(vs) if len(v) == n]) for n in {len(v) for v in vs}} for vs in (xs, ys)]
    for n, i in by_size[0].items():
        for m, j in by_size[1].items():
            size = min(n, m) // 8
            a, b = (fold(np.frombuffer(b"".join(vs[k] for k in own), np.uint64).reshape(len(own), -1), size) for vs, own in ((xs, i), (ys, j)))
            for k, row in zip(i.tolist(), a, strict=True):
                out[k, j] = np.bitwise_count(b ^ row).sum(axis=1)
    return out


def bounded(left: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs (a, b), once each, of rows (sig, x) of one bucket and different components that sizes, places and bitmaps let link."""

    def maps(batches):
        for b in batches:
            shingles = [np.frombuffer(v, np.int64) for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(v) for v in shingles], pa.int64()), pa.array([bitmap(v) for v in shingles], pa.binary())], names=["sid", "many", "bits"])

    wanted = left.select(F.col("x.sid").alias("sid")).distinct()
    own = held.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.first("shingles").alias("shingles")).mapInArrow(maps, "sid long, many long, bits binary")
    sizes = left.groupBy("sig").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = left.join(sizes, "sig").select("sig", "x.*", "blocks", F.pmod(F.xxhash64("x.sid"), F.col("blocks")).cast("int").alias("mine"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.join(own, "sid").withColumn("other", each).withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})

    def meet(t: pa.Table) -> pa.Table:
        mine = t.column("mine").to_numpy()
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        sid, n, place, comp, many = (t.column(c).to_numpy().astype(np.int64) for c in ("sid", "n", "place", "comp", "many"))
        rep, bits = np.minimum(t.column("rep").to_numpy(), n - place), t.column("bits").to_pylist()
        x, y = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        shared = (many[x][:, None] + many[y] - differing([bits[k] for k in x], [bits[k] for k in y])) // 2
        shared = np.minimum(shared, np.minimum(rep[x][:, None], rep[y]))
        a, b = n[x][:, None], n[y]
        may_link = (comp[x][:, None] != comp[y]) & (4 * np.minimum(a, b) >= 3 * np.maximum(a, b)) & (7 * shared >= 3 * (a + b))
        if i == j:
            may_link &= sid[x][:, None] < sid[y]
        p, q = np.nonzero(may_link)
        p, q = sid[x[p]], sid[y[q]]
        return pa.table({"a": np.minimum(p, q), "b": np.maximum(p, q)})

    return dealt.groupBy("sig", "i", "j").applyInArrow(meet, "a long, b long").distinct()


def links(sets: DataFrame) -> DataFrame:
    """Links (a, b) of the classes in SETS rows that span all components."""
    spark = sets.sparkSession
    sets = sets.filter("uid is null")
    held = sets.select("sid", "n", "shingles")
    rows = stored(indexed(sets), "signatures").select("sid", "n", "rep", F.explode(F.arrays_zip("sigs", "places")).alias("s")).select(F.col("s.sigs").alias("sig"), F.struct("sid", "n", "rep", F.col("s.places").alias("place"), F.col("sid").alias("comp")).alias("x"))
    several = once_each(rows)
    # without those that can't link with the smallest set of the bucket, as far as sizes and places tell
    most = F.least("x.rep", F.col("x.n") - F.col("x.place"))
    left = stored(rows.join(several, "sig").filter(7 * most >= 3 * (F.col("x.n") + F.greatest("least", F.ceil(3 * F.col("x.n") / 4)))).select("sig", "x"), "index")
    found = spark.createDataFrame([], "a long, b long")
    other = lambda p: (p["comp"] != F.col("x")["comp"]) & may(F.col("x"), p)
    for turn in range(TURNS):
        # each class with a few of those that it meets most often among the ones that stand for its buckets: every other with least of its own
        order = [F.struct(F.col("x.place") * F.lit(1 - k % 2), F.xxhash64("x.sid", F.lit(PIVOTS * turn + k))) for k in range(PIVOTS if turn else 1)]
        some = F.array_distinct(F.array(*(F.min_by("x", o) for o in order)))
        pivots = left.groupBy("sig").agg(some.alias("pivots"))
        # one of them in each bucket, so that rows stay as many as the index has
        fit = left.join(pivots, "sig").select("sig", "x", F.filter("pivots", other).alias("fit")).filter(F.size("fit") > 0)
        met = fit.select("x", F.get("fit", F.pmod(F.xxhash64("sig", "x.sid"), F.size("fit")).cast("int")).alias("y"))
        met = met.groupBy(F.col("y.sid").alias("a"), F.col("x.sid").alias("b")).agg(F.count("*").alias("shared"), F.first("y.comp").alias("ca"), F.first("x.comp").alias("cb"))
        best = met.groupBy("b", F.pmod(F.xxhash64("a"), F.lit(BEST if turn else 1)).alias("slot")).agg(F.max(F.struct("shared", "a", "ca", "cb")).alias("top"))
        pairs = stored(best.select("top.a", "b", "top.ca", "top.cb").dropDuplicates(["a", "b"]), "pairs")
        new = stored(compare(pairs, held), "links")
        found = found.unionByName(new.select("a", "b"))
        labels = components(new.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(F.col("sid").alias("old"), F.col("comp").alias("fresh"))
        own = left.join(labels, F.col("x.comp") == F.col("old"), "left").select("sig", F.col("x").withField("comp", F.coalesce("fresh", "x.comp")).alias("x"))
        left = stored(own.join(stored(bounds(own), "bounds"), "sig").filter(open_rows()).select("sig", "x"), "left")
        sizes = left.groupBy("sig", F.col("x.comp").alias("comp")).agg(F.count("*").alias("n"))
        mixed = sizes.groupBy("sig").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
        rows_left, pairs_left = mixed.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2)).first()
        if not rows_left or pairs_left <= LEFT * rows_left or not new.limit(1).count():
            break
    pairs = stored(bounded(left, held), "rest")
    return stored(found.unionByName(compare(pairs, held)), "all-links")


def join_classes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """uid, doc_id, n_shingles, sid, comp (the smallest sid that links reach) and component_id of all documents (doc_id, text)."""
    own = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = class_rows(own, words)
    classes = sets.filter("uid is not null").select("uid", "doc_id", "sid", "n")
    labels = components(links(sets))
    first = cut(classes.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first")))
    comps = cut(first.join(labels, "sid", "left").select("sid", "first", F.coalesce("comp", "sid").alias("comp")))
    ids = comps.join(comps.groupBy("comp").agg(F.min("first").alias("component_id")), "comp").select("sid", "comp", "component_id")
    full = classes.filter("n > 0").join(ids, "sid").select("uid", "doc_id", F.col("n").alias("n_shingles"), "sid", "comp", "component_id")
    none = F.lit(None).cast("long")
    return full.unionByName(classes.filter("n = 0").select("uid", "doc_id", F.col("n").alias("n_shingles"), none.alias("sid"), none.alias("comp"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """docs without near copies: of each component of links, the row with the smallest doc_id stays, the first of equals."""
    name = "_uid"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    groups = join_classes(docs, words)
    found = groups.filter("n_shingles > 0").groupBy("comp").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NONE)), "uid")).alias("top")).select(F.col("top.uid").alias(name))
    bare = groups.filter("n_shingles = 0").select(F.col("uid").alias(name))
    return docs.withColumn(name, F.monotonically_increasing_id()).join(found.unionByName(bare), name, "left_semi").select(*docs.columns)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
