"""Byte-level BPE of whole texts at batch speed.

Byte-level BPE merges within pretokens only, so the tokenizers library encodes each distinct pretoken of a batch
once, and the ids of the texts are gathered from those. The split into pretokens is done on code points with numpy.
The strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import numpy as np

from .common import chunks, env_single, ranges
from .hashing import HashTable, span_hashes

#: Distinct pretokens that a worker keeps before it starts anew.
CACHE = 1_200_000

L, N, S, O = 1, 2, 3, 0  # noqa: E741


def _classes() -> np.ndarray:
    """Letter, number, white space or other for each code point, as the split pattern of the vocabulary sees them."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    place = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    for kind, pattern in ((L, r"\p{L}+"), (N, r"\p{N}+"), (S, r"\s+")):
        for m in regex.finditer(pattern, text):
            out[place[m.start() : m.end()]] = kind
    return out


def _signs() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """encode(data, at) gives the ids of all rows and the rows' n + 1 offsets into them."""

    def __init__(self, path: str):
        env_single()
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.joined = Tokenizer(self.tok.model)
        self.joined.pre_tokenizer = pre_tokenizers.Split("\u010a", "isolated")
        self.line = self.tok.token_to_id("\u010a")
        self.signs = _signs()
        self.kinds = _classes()
        self.reset()

    def reset(self) -> None:
        self.table = HashTable(CACHE)
        self.flat, self.n_flat = np.zeros(1 << 16, np.uint32), 0
        self.first, self.length = np.zeros(CACHE, np.int64), np.zeros(CACHE, np.int32)

    def _add(self, keys: np.ndarray, words: list[bytes]) -> None:
        text = b"\n".join(words).decode("latin-1").translate(self.signs)  # a line feed stands alone between words
        ids = np.array(self.joined.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        breaks = np.flatnonzero(ids == self.line)
        ids = np.delete(ids, breaks).astype(self.flat.dtype)
        lens = np.diff(np.concatenate([[-1], breaks, [len(ids) + len(breaks)]])) - 1
        k, total = self.table.add(keys), len(ids)
        while self.n_flat + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.n_flat : self.n_flat + total] = ids
        self.first[k : k + len(words)] = self.n_flat + np.cumsum(lens) - lens
        self.length[k : k + len(words)] = lens
        self.n_flat += total

    def pretokens(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start bytes of the pretokens of the rows (whose bytes are contiguous), and the first pretoken of each row."""
        text = data[at[0] : at[-1]]
        head = (text & 0xC0) != 0x80
        cp = np.frombuffer(text.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        byte = np.flatnonzero(head)
        n = len(cp)
        kind = self.kinds[cp]
        row = np.searchsorted(byte, at[:-1] - at[0])  # first character of each row
        opens = np.zeros(n + 1, bool)
        opens[row] = True
        opens[n] = True
        prev = np.concatenate([[255], kind[:-1]]).astype(np.uint8)
        run = (kind != prev) | opens[:n]
        space, white = cp == 0x20, kind == S
        joined = np.zeros(n, bool)  # its run takes the space before it
        joined[1:] = space[:-1]
        joined &= ~opens[:n]
        starts = run & (white | ~joined)
        last = white.copy()  # last white character of a run, with text after it
        last[:-1] &= ~white[1:]
        last[-1:] = False
        last &= ~opens[1:]
        starts |= last
        tick = np.flatnonzero((cp == 0x27) & run & ~joined)
        if len(tick):
            far = np.concatenate([cp, np.zeros(3, np.uint32)])
            own = ~opens[tick + 1]
            a, b = far[tick + 1], far[tick + 2]
            two = own & np.isin(a, [0x73, 0x74, 0x6D, 0x64])
            near2 = own & ~opens[np.minimum(tick + 2, n)]
            three = near2 & (((b == 0x65) & ((a == 0x72) | (a == 0x76))) | ((a == 0x6C) & (b == 0x6C)))
            starts[tick[two | three] + 1] = False
            ends = np.concatenate([tick[two] + 2, tick[three] + 3])
            starts[ends[ends < n]] = True
        where = np.flatnonzero(starts)
        return byte[where] + at[0], np.searchsorted(where, row)

    def _encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if at[-1] == at[0]:
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        begin, row = self.pretokens(data, at)
        ends = np.append(begin[1:], at[-1])
        keys = span_hashes(data[at[0] : at[-1]], begin - at[0], ends - at[0])
        parts = []
        for lo in range(0, len(keys), CACHE // 2):
            own = slice(lo, lo + CACHE // 2)
            place = self._places(data, keys[own], begin[own], ends[own])
            lens = self.length[place].astype(np.int64)
            parts.append((self.flat[ranges(self.first[place], lens)], lens))
        ids, lens = (np.concatenate(x) for x in zip(*parts, strict=True))
        total = np.concatenate([[0], np.cumsum(lens)])
        return ids, total[np.append(row, len(begin))]

    def _places(self, data: np.ndarray, keys: np.ndarray, begin: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers in the table of at most CACHE pretokens, which are added where it lacks them."""
        place = self.table.find(keys)
        if len(miss := np.flatnonzero(place < 0)):
            new, where = np.unique(keys[miss], return_index=True)
            if self.table.n + len(new) > CACHE:
                self.reset()
                miss, place = np.arange(len(keys)), np.full(len(keys), -1, np.int32)
                new, where = np.unique(keys, return_index=True)
            where = miss[where]
            raw = memoryview(np.ascontiguousarray(data))
            words = [bytes(raw[lo:hi]) for lo, hi in zip(begin[where].tolist(), ends[where].tolist(), strict=True)]
            lines = np.fromiter((b"\n" in w for w in words), bool, len(words))
            plain = [w for w in words if b"\n" not in w] if lines.any() else words
            if plain:
                self._add(new[~lines], plain)
            for i in np.flatnonzero(lines):
                self._add_line(new[i : i + 1], words[i])
            place[miss] = self.table.find(keys[miss])
        return place

    def _add_line(self, key: np.ndarray, word: bytes) -> None:
        ids = np.array([t.id for t in self.joined.model.tokenize(word.decode("latin-1").translate(self.signs))], self.flat.dtype)
        k = self.table.add(key)
        while self.n_flat + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.n_flat : self.n_flat + len(ids)] = ids
        self.first[k], self.length[k] = self.n_flat, len(ids)
        self.n_flat += len(ids)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As _encode, but a row of many bytes is worked on in pieces that end before white space."""
        if len(at) == 2 and at[1] - at[0] > 1 << 22:
            ids, lo, end = [], int(at[0]), int(at[1])
            while lo < end:
                hi = min(lo + (1 << 21), end)
                while hi < end:
                    step = data[hi : hi + 65536]
                    gap = np.flatnonzero((step[1:] == 0x20) & (step[:-1] < 0x80) & (step[:-1] > 0x20) & (step[:-1] != 0x7F))
                    if len(gap):
                        hi += int(gap[0]) + 1
                        break
                    hi = min(hi + len(step), end) if len(step) > 1 else end
                ids.append(self._encode(data, np.array([lo, hi]))[0])
                lo = hi
            all_ids = np.concatenate(ids)
            return all_ids, np.array([0, len(all_ids)])
        return self._encode(data, at)

    def batches(self, data: np.ndarray, at: np.ndarray):
        """lo, hi, ids, offsets for ranges of rows of bounded size."""
        for lo, hi in chunks(at):
            yield lo, hi, *self.encode(data, at[lo : hi + 1])


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
