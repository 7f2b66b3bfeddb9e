"""Spelling variants, the BPE transducer and the Merkle manifest against brute force, with nulls, ties, repeated rows, clashing columns."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("winnowry.llm")

from winnowry.llm import merkle, spelling, transducer  # noqa: E402

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
R = random.Random(7)


def typo(w):
    k = R.randrange(len(w))
    return R.choice((w[:k] + w[k + 1 :], w[:k] + R.choice("abcéß×") + w[k:], w[:k] + R.choice("xyzÀÿ") + w[k + 1 :]))


def rows():
    words = ["".join(R.choice("abcdeéñ") for _ in range(R.randint(4, 14))) for _ in range(60)] + ["Straße", "naïveté", "×÷×÷×", "z" * 300, "Ārgument", "words2words"]
    words = words * 8 + [typo(w) for w in words for _ in range(3)]
    texts = [" ".join(R.choice(words) + R.choice((" ", ", ", "\n", "1")) for _ in range(R.randint(0, 300))) for _ in range(60)]
    texts += [None, "", "     ", "abcde" * 900, texts[3], texts[3], "".join(f"q{a}q{b}q " * 3 for a in "abcdefghij" for b in "abcdefghij")]
    ids = [*range(len(texts) - 3), 3, None, None]
    return [(i, t, s, n, lang, 1, "x", 5) for i, t, s, n, lang in zip(ids, texts, [None, "b", "a", "é"] * len(texts), [None, 5, 0] * len(texts), ["en", None] * len(texts), strict=False)]


ROWS = rows()
SCHEMA = "doc_id long, text string, source string, n_chars long, lang string, tree int, word string, n long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


def same(found, expected):
    assert collections.Counter(map(tuple, found)) == collections.Counter(map(tuple, expected))


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(rows):
    counts = collections.Counter()
    for i, t, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            counts[w if h % 97 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        top = min(near[w], key=lambda x: (-words[x], x), default=None)
        if top is not None and words[top] >= 2 * n:
            form[w] = top
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        yield w, n, len(near[w]), form.get(w), words.get(form.get(w)), root


@pytest.mark.parametrize("most", [spelling.MOST, 8])
def test_spelling(docs, most, monkeypatch):
    """most 8: blocks are subdivided by Spark, round by round, as far as they can be."""
    monkeypatch.setattr(spelling.near_words, "__defaults__", (spelling.LETTERS, most))
    found = spelling.variants(docs).select("word", "n", "n_near", "form", "form_n", "root").collect()
    want = list(expected_variants(ROWS))
    assert len([1 for w in want if w[3]]) > 20 and max(w[2] for w in want) > 10
    same(found, want)


def test_spelling_of_nothing(docs):
    assert spelling.variants(docs.limit(0)).count() == 0
    assert spelling.variants(docs.filter("text is null")).count() == 0


def test_blocks_hold_each_pair_once():
    """Near pairs of one block, whatever its size, come once, also where their beginnings and endings are both the same."""
    words = sorted({w for x in ("aaaaaa", "abcabcabc", "zzzzzzzzzz") for w in (x, *(typo(x) for _ in range(60)))})
    for m in range(4, 12):
        own = [w.encode("latin-1") for w in words if len(w) in (m, m + 1)]
        n = len(own)
        if not n:
            continue
        zero = np.zeros(n, np.int64)
        got = [p for a, b in spelling.Block(own, zero + m, zero, zero, zero + spelling.ALL, zero).pairs() for p in zip(a.tolist(), b.tolist(), strict=True)]
        want = {frozenset((i, j)) for i in range(n) for j in range(i) if m in (len(own[i]), len(own[j])) and one_edit(own[i].decode("latin-1"), own[j].decode("latin-1"))}
        assert len(got) == len(want) and {frozenset(p) for p in got} == want


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(transducer.ranks_path(), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


HARD = ["a" * 3000, " " * 700, "\n\t \n", "don't we'll 'S 'st", "ab" * 900 + "<|endoftext|>", "漢字" * 200, "é​\U0001f434" * 50, "".join(chr(c) for c in range(1, 3000)), "1234567" * 40]


def test_transducer(spark, docs, reference):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(HARD)], "doc_id long, text string")
    own = docs.select("doc_id", "text").unionByName(more)
    found = transducer.digests(own, transducer.ranks_path()).collect()
    want = []
    for i, t in [*((r[0], r[1]) for r in ROWS), *((100 + i, t) for i, t in enumerate(HARD))]:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    same(found, want)
    ids = transducer.encoded(own, transducer.ranks_path())
    same([(r.doc_id, tuple(r.ids)) for r in ids.collect()], [(i, tuple(reference.encode_ordinary(t or ""))) for i, t in [*((r[0], r[1]) for r in ROWS), *((100 + i, t) for i, t in enumerate(HARD))]])
    same(transducer.decoded(ids, transducer.ranks_path()).collect(), [(r[0], r[1] or "") for r in ROWS] + [(100 + i, t) for i, t in enumerate(HARD)])
    assert transducer.digests(own.limit(0), transducer.ranks_path()).count() == 0


def test_transducer_feeds_in_pieces(monkeypatch):
    """Any cut of a text gives the same ids, tokens come before its end, and few states kept change nothing."""
    machine = transducer.loaded(transducer.ranks_path())[0].machine
    monkeypatch.setattr(transducer, "KEPT", 50)
    longest = max(map(len, machine.tokens))
    for text in ("".join(R.choice("abcdefghijklmnop") for _ in range(2000)), "=" * 500 + "-" * 90, "漢字仮名交" * 30):
        data, out, at, wait = text.encode(), [], 0, 0
        while at < len(data):
            n = R.randint(1, 40)
            out += machine.feed(data[at : at + n])
            at += n
            wait = max(wait, min(at, len(data)) - sum(len(machine.tokens[x]) for x in out))
        out += machine.finish()
        assert b"".join(machine.tokens[x] for x in out) == data
        assert out == machine.merged(data)
        assert wait <= 2 * longest + 40


def test_utf8_machine():
    for _ in range(20000):
        raw = bytes(R.choice([0x41, 0x80, 0x9F, 0xA0, 0xBF, 0xC2, 0xC3, 0xE0, 0xED, 0xEF, 0xF0, 0xF4, 0xF5, 0xFF, 0x90, 0x8F]) for _ in range(R.randint(0, 12)))
        machine, out, at = transducer.Utf8(), "", 0
        while at < len(raw):
            n = R.randint(1, 4)
            out += machine.feed(raw[at : at + n])
            at += n
        assert out + machine.finish() == raw.decode("utf-8", "replace")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def code(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def route(tree, place):
    for level in tree[:-1]:
        lo = place // 16 * 16
        run = level[lo : lo + 16]
        yield place - lo, run[: place - lo] + run[place - lo + 1 :]
        place //= 16


def expected_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r[1]].append((H(*map(code, r)), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
    trees = {s: levels([x for x, _ in by[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    for j, s in enumerate(names):
        for i, (leaf, r) in enumerate(by[s]):
            way, x = [*route(trees[s], i), *route(top, j)], leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                x = H(*map(code, (*r[:4], r[4] and r[4].translate(LOWER))))
            for place, others in way:
                x = H(*others[:place], x, *others[place:])
            yield r[0], leaf, trees[s][-1][0], top[-1][0], H(*(o for _, others in way for o in others)), x, x == top[-1][0]


@pytest.mark.parametrize("height", [3, 1])
def test_merkle(spark, docs, height, monkeypatch):
    """height 1: blocks of 16 nodes, so that trees take several traversals."""
    monkeypatch.setattr(merkle, "LEVELS", height)
    monkeypatch.setattr(merkle, "SPAN", 16**height)
    many = [(i, f"Text {i % 7}" if i % 11 else None, f"s{i}" if i % 3 == 0 and i < 700 else "hot", i if i % 4 else None, "en", 1, "x", 1) for i in range(1, 1200)]
    for own in (ROWS, ROWS + many, many[:1], [r for r in many if r[2] == "hot"]):
        frame = spark.createDataFrame(own, SCHEMA).repartition(3)
        found = merkle.checked(merkle.proofs(frame)).collect()
        want = list(expected_manifest([(r[0], r[2], r[4], r[3], r[1]) for r in own]))
        same(found, want)
        assert any(not w[6] for w in want) or len(own) == 1
    assert merkle.checked(merkle.proofs(docs.limit(0))).count() == 0


def test_merkle_paths_are_checkable():
    """climb gives paths that lead each node to the digest, and nothing else does."""
    for n in (1, 2, 16, 17, 255, 256, 257, 4096):
        nodes = [hashlib.sha256(b"%d" % i).digest() for i in range(n)]
        top, paths = merkle.climb(nodes, merkle.levels_of(n))
        assert top.hex() == levels([x.hex() for x in nodes])[-1][0]
        assert all(merkle.fold(x, p) == top for x, p in zip(nodes, paths, strict=True))
        if n > 1:
            assert merkle.fold(nodes[1], paths[0]) != top
