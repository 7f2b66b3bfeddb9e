"""Byte-level BPE as a finite-state transducer, determinised where texts lead it, and streaming decoding.

Merging the adjacent pair of least rank, again and again, gives a sequence of tokens in which each two neighbours are what merging
gives for their bytes alone; and no other sequence of a text has that property. (No merge that the whole text makes crosses the edge
of two final neighbours, so their own bytes merge alike; and the first merge to cross an edge would cross it in the
neighbours' bytes alone, too.) So merges become a finite relation: which token may follow which. The transducer
reads a byte at a time. A configuration is the last complete token, the node of the vocabulary's trie for the bytes since, and the
tokens complete but not yet emitted. As each prefix of a text has one sequence of tokens, one of the configurations after a byte is at the root.
A state is the set of all configurations that can go on. What all of them have in front is emitted: a token
waits until no longer token can cover its end, which a token's length bounds. States and transitions are built when a text asks for
them, and kept.

A text that is a token as a whole is that token, whatever merging gives.

Rows: null text is empty: no ids, nothing decoded; null and repeated doc_ids are kept row by row; further columns are ignored; an empty table
gives no rows. Texts of any length are worked on in pieces between words; a word without white space is read byte by byte.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ranges, table, text_parts
from .tokens import L, N, S, Encoder, _classes

#: Transitions that a worker keeps before it starts anew.
KEPT = 100_000
#: Ids that the decoder takes at a time.
STEP = 1 << 15


def read_ranks(path: str) -> list[bytes]:
    """The tokens' bytes in the order of their ranks, which are 0, 1, 2, ... ."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [base64.b64decode(a) for a, b in sorted(pairs, key=lambda p: int(p[1]))]
    if sorted(int(b) for _, b in pairs) != list(range(len(tokens))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return tokens


class Transducer:
    """feed(data) gives the ids that are sure, finish() the rest."""

    def __init__(self, tokens: list[bytes]):
        self.tokens, self.rank = tokens, {t: i for i, t in enumerate(tokens)}
        if any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError("each byte must be a token")
        # the trie: children by node << 8 | byte, the token that ends at a node
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        for i, t in enumerate(tokens):
            node = 0
            for b in t:
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.token)
                    self.token.append(-1)
                node = nxt
            self.token[node] = i
        self.inner = {k >> 8 for k in self.child}
        self.follows: dict[int, bool] = {}
        self.reset()

    def reset(self, keep: tuple = ((-1, 0, ()),)) -> None:
        """Forgets all states but the start and the present one, whose configurations are `keep`."""
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.ends: dict[int, tuple[int, ...]] = {}
        self.start = self.state(((-1, 0, ()),))
        self.now = self.state(keep)

    def state(self, configurations: tuple) -> int:
        k = self.number.get(configurations)
        if k is None:
            k = self.number[configurations] = len(self.states)
            self.states.append(configurations)
        return k

    def merged(self, data: bytes) -> list[int]:
        """What merging gives, by its rule."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min((self.rank.get(a + b, len(self.tokens)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best == len(self.tokens):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def may_follow(self, last: int, token: int) -> bool:
        """Whether token may stand after last (-1: first)."""
        key = (last + 1) * (len(self.tokens) + 1) + token
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) > 4 * KEPT:
                self.follows.clear()
            own = self.tokens[token]
            known = self.follows[key] = self.merged(own) == [token] if last < 0 else self.may_follow(-1, token) and self.may_follow(-1, last) and self.merged(self.tokens[last] + own) == [last, token]
        return known

    def move(self, at: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after a byte, and the tokens emitted."""
        out, done = [], None
        for last, node, waiting in self.states[at]:
            nxt = self.child.get(node << 8 | byte)
            if nxt is None:
                continue
            token = self.token[nxt]
            if done is None and token >= 0 and self.may_follow(last, token):
                done = (token, 0, (*waiting, token))
            out.append((last, nxt, waiting))
        if done is None:
            raise ValueError("no token ends here")
        out.append(done)
        # a configuration whose node has no children ends here, unless the text does: the whole text may be its token
        whole = [c for c in out if c[0] < 0 and c[1] and self.token[c[1]] >= 0]
        out = [c for c in out if c is done or c in whole or c[1] in self.inner]
        first = out[0][2]
        n = min(len(c[2]) for c in out)
        while n and any(c[2][:n] != first[:n] for c in out):
            n -= 1
        found = (self.state(tuple((last, node, waiting[n:]) for last, node, waiting in out)), first[:n])
        self.moves[at << 8 | byte] = found
        return found

    def ending(self, at: int) -> tuple[int, ...]:
        """The tokens to emit where the text ends in a state."""
        found = self.ends.get(at)
        if found is None:
            whole = [self.token[node] for last, node, _ in self.states[at] if last < 0 and node and self.token[node] >= 0]
            found = self.ends[at] = tuple(whole[:1]) or next(waiting for _, node, waiting in self.states[at] if not node)
        return found

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        at, moves = self.now, self.moves
        for b in data:
            step = moves.get(at << 8 | b)
            if step is None:
                if len(moves) > KEPT:
                    self.reset(self.states[at])
                    at, moves = self.now, self.moves
                step = self.move(at, b)
            at = step[0]
            if step[1]:
                out += step[1]
        self.now = at
        return out

    def finish(self) -> list[int]:
        """The rest of a text's ids; the next byte begins another text."""
        out = list(self.ending(self.now))
        self.now = self.start
        return out

    def encode(self, data: bytes) -> list[int]:
        return self.feed(data) + self.finish()


def _kinds() -> np.ndarray:
    """Classes of all code points as the tiktoken library's patterns see them: what lies between matches has no ids."""
    try:
        import tiktoken
    except ModuleNotFoundError:
        return _classes()
    place = np.array([*range(0xD800), *range(0xE000, 0x110000)], np.uint32)
    text = place.astype("<u4").tobytes().decode("utf-32-le")
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((L, r"\p{L}"), (N, r"\p{N}"), (S, r"\s")):
        own = tiktoken.Encoding(f"class-{kind}", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        for lo in range(0, len(text), 1 << 16):
            part = bytes(own.encode_ordinary(text[lo : lo + (1 << 16)])).decode()
            out[np.frombuffer(part.encode("utf-32-le"), np.uint32)] = kind
    return out


class FstEncoder(Encoder):
    """encode(data, at) as Encoder's, each distinct pretoken by the transducer."""

    def __init__(self, path: str):
        self.machine = Transducer(read_ranks(path))
        self.kinds = _kinds()
        self.reset()

    def _add(self, keys: np.ndarray, words: list[bytes]) -> None:
        found = [self.machine.encode(w) for w in words]
        lens = np.fromiter(map(len, found), np.int64, len(found))
        k, total = self.table.add(keys), int(lens.sum())
        while self.n_flat + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.n_flat : self.n_flat + total] = np.fromiter((x for f in found for x in f), self.flat.dtype, total)
        self.first[k : k + len(words)] = self.n_flat + np.cumsum(lens) - lens
        self.length[k : k + len(words)] = lens
        self.n_flat += total

    def _add_line(self, key: np.ndarray, word: bytes) -> None:
        self._add(key, [word])


def utf8_table() -> list[list[int]]:
    """Next states of the UTF-8 machine by state and byte: 0 between characters, -1 where a byte can't stand.

    States say what may come next: 1, 2, 3: so many continuation bytes; 4: after E0, 5: after ED, 6: after F0, 7: after F4.
    """
    out = [[-1] * 256 for _ in range(8)]
    for b in range(256):
        lead = {0xE0: 4, 0xED: 5, 0xF0: 6, 0xF4: 7}.get(b)
        out[0][b] = 0 if b < 0x80 else 1 if 0xC2 <= b <= 0xDF else lead or (2 if 0xE1 <= b <= 0xEF else 3 if 0xF1 <= b <= 0xF3 else -1)
        if 0x80 <= b <= 0xBF:
            out[1][b], out[2][b], out[3][b] = 0, 1, 2
            out[4][b] = 1 if b >= 0xA0 else -1  # no longer form than needed
            out[5][b] = 1 if b <= 0x9F else -1  # no surrogates
            out[6][b] = 2 if b >= 0x90 else -1
            out[7][b] = 2 if b <= 0x8F else -1  # nothing beyond U+10FFFF
    return out


class Utf8:
    """Incremental decoding: feed(data) gives the characters that are complete, finish() what a cut one leaves.

    A malformed sequence gives U+FFFD for each of its longest beginnings of a character.
    """

    TABLE = utf8_table()
    WIDE = re.compile(rb"[\x80-\xff]+")

    def __init__(self) -> None:
        self.state, self.held, self.bad = 0, b"", 0

    def feed(self, data: bytes) -> str:
        out, at = [], 0
        table, state, held = self.TABLE, self.state, self.held
        if state and data and data[0] < 0x80:
            out.append("�")
            self.bad += 1
            state, held = 0, b""
        for m in self.WIDE.finditer(data):
            lo, hi = m.span()
            if lo > at:
                out.append(data[at:lo].decode("ascii"))
            begin = good = lo  # bytes from begin are of characters that are complete up to good
            i = lo
            while i < hi:
                nxt = table[state][data[i]]
                if nxt >= 0:
                    state = nxt
                    i += 1
                    if not state:
                        good = i
                    continue
                out.append((held + data[begin:good]).decode() if good > begin else "")
                out.append("�")
                self.bad += 1
                i += state == 0  # a byte that ends a character's beginning is looked at again
                held, state, begin, good = b"", 0, i, i
            if good > begin:
                out.append((held + data[begin:good]).decode())
                held, begin = b"", good
            if state and hi < len(data):
                out.append("�")
                self.bad += 1
                held, state = b"", 0
            else:
                held += data[begin:hi]
            at = hi
        if at < len(data):
            out.append(data[at:].decode("ascii"))
        self.state, self.held = state, held
        return "".join(out)

    def finish(self) -> str:
        rest = "�" if self.state else ""
        self.bad += self.state > 0
        self.state, self.held = 0, b""
        return rest


class Decoder:
    """Bytes and text of id streams."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def data(self, ids: np.ndarray) -> bytes:
        return self.flat[ranges(self.at[ids], self.size[ids])].tobytes()

    def stream(self, ids: np.ndarray) -> Iterator[str]:
        """The text of ids, some at a time."""
        machine = Utf8()
        for lo in range(0, len(ids), STEP):
            yield machine.feed(self.data(ids[lo : lo + STEP]))
        yield machine.finish()


_loaded: dict[str, tuple[FstEncoder, Decoder, Decoder]] = {}


def loaded(path: str) -> tuple[FstEncoder, Decoder, Decoder]:
    """The worker's encoder, decoder, and a table of ids as decimal text, for a file of ranks."""
    if path not in _loaded:
        enc = FstEncoder(path)
        _loaded[path] = enc, Decoder(enc.machine.tokens), Decoder([b" %d" % i for i in range(len(enc.machine.tokens))])
    return _loaded[path]


def encoded(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, ids of all rows of docs (doc_id, text). ranks: a file that all workers can open."""

    def run(batches):
        enc, *_ = loaded(ranks)
        for b in batches:
            data, at = text_parts(b.column(1))
            for lo, hi, ids, offs in enc.batches(data, at):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, ranks: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids)."""

    def run(batches):
        _, dec, _ = loaded(ranks)
        for b in batches:
            texts = ["".join(dec.stream(np.asarray(x or [], np.int64))) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: texts are encoded, and their ids decoded in a stream, where they lie."""

    def run(batches):
        enc, dec, decimal = loaded(ranks)
        for b in batches:
            data, at = text_parts(b.column(1))
            for lo, hi, ids, offs in enc.batches(data, at):
                offs = offs.tolist()
                names, texts = [], []
                for i, j in zip(offs, offs[1:], strict=False):
                    own, name, text = ids[i:j].astype(np.int64), hashlib.sha256(), hashlib.sha256()
                    for k in range(0, len(own), STEP):
                        name.update(decimal.data(own[k : k + STEP])[k == 0 :])
                    for part in dec.stream(own):
                        text.update(part.encode())
                    names.append(name.hexdigest())
                    texts.append(text.hexdigest())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(np.diff(offs), pa.int64()), pa.array(names), pa.array(texts)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op12_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), ranks_path())
