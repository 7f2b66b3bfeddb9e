"""Toxicity scores from Levenshtein automata intersected with a lexicon trie.

The lexicon is learnt: words and word beginnings that documents labelled toxic hold far more often than others. Its trie is
walked together with the automata of all its terms at once; sets of (node, edits) are states of one automaton that is
built as words ask for it, so that a word costs a few steps. Long terms match with one or two edits, short ones exactly.
Each match gets a context score from the words around it: how dense other matches are, and whether quotation marks enclose
it. A logistic regression on these numbers, learnt from the same labels, gives the score.

Rows: null, empty and wordless texts have no matches and get the score of such; without labels of both kinds all scores are
0.0; null, repeated and clashing doc_ids are kept row by row. Memory: a batch of text; on the driver the lexicon, of TERMS
at most, and nine numbers for each of the DOCS documents learnt from.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .labelled import held_out, sample, texts

#: Bounds: labelled documents that are learnt from, and terms of the lexicon.
DOCS, TERMS = 8000, 1000
#: Lengths of word beginnings that may become terms; toxic documents, their share and the odds that a term needs.
STEMS, SUPPORT, SHARE, ODDS = (4, 5, 6), 6, 0.02, 3.0
#: Words near to terms, but not meant by them, that are learnt.
PLAIN = 20_000
#: Words to each side of a match that make its context.
CONTEXT = 12
MOD, REST = 5, 0
STATES = 200_000

WORD = re.compile(r"[^\W_]+")
#: Quotation marks, and lines, which end quotations.
MARKS = re.compile("[\"“”„«»‘’‚‹›`\n]")
#: The marks that each one closes.
PARTNERS = {'"': '"', "`": "`", "”": "“„\"", "“": "„", "»": "«", "«": "»", "’": "‘", "‘": "‚", "›": "‹", "‹": "›"}
#: What a term counts whose every match is quoted.
QUOTED = 0.25


def edits(term: str) -> int:
    """How many edits a match of a whole-word term may have."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Automaton:
    """Finds the lexicon's term nearest to a word. Terms: {word: weight}; those that end in * match word beginnings."""

    def __init__(self, terms: dict[str, float], plain: set[str] = frozenset()):
        self.plain = plain
        self.child: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.weights = dict(terms)
        self.far = max([0, *(edits(t) for t in terms if t[-1:] != "*")])
        for t in terms:
            node = 0
            for c in t.rstrip("*"):
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.word.append(None)
                    self.stem.append(None)
                node = self.child[node][c]
            if t[-1:] == "*":
                self.stem[node] = t
            else:
                self.word[node] = t
        self.reset()

    def reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []  # a stem that ends here, or else the nearest word
        self.ends: list[bool] = []
        self.begin = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """nodes: the least edits for each. Letters of terms may be left out."""
        todo = list(nodes)
        while todo:
            n = todo.pop()
            if (e := nodes[n] + 1) <= self.far:
                for m in self.child[n].values():
                    if nodes.get(m, 9) > e:
                        nodes[m] = e
                        todo.append(m)
        key = tuple(sorted(nodes.items()))
        if key in self.number:
            return self.number[key]
        stems = [(self.stem[n], 0) for n, e in key if e == 0 and self.stem[n]]
        words = sorted((e, self.word[n]) for n, e in key if self.word[n] and e <= edits(self.word[n]))
        self.number[key] = k = len(self.states)
        self.states.append(key)
        self.moves.append({})
        self.ends.append(bool(stems))
        self.found.append(stems[0] if stems else (words[0][1], words[0][0]) if words else None)
        return k

    def _move(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}
        for n, e in self.states[state]:
            for letter, m in self.child[n].items():
                cost = e + (letter != c)
                if cost <= self.far and nodes.get(m, 9) > cost:
                    nodes[m] = cost
            if e < self.far and nodes.get(n, 9) > e + 1:  # c is one too many
                nodes[n] = e + 1
        to = self._state(nodes) if nodes else -1
        self.moves[state][c] = to
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """The term and the edits."""
        if len(self.states) > STATES:
            self.reset()
        state, moves, ends = self.begin, self.moves, self.ends
        for c in word:
            state = moves[state].get(c, -2)
            if state == -2:
                break
            if state == -1:
                return None
            if ends[state]:
                return self.found[state]
        else:
            return self.found[state]
        state = self.begin
        for c in word:
            to = self.moves[state].get(c, -2)
            state = self._move(state, c) if to == -2 else to
            if state == -1:
                return None
            if self.ends[state]:
                break
        return self.found[state]


WIDTH = 9


def quotations(text: str) -> list[tuple[int, int]]:
    """Spans between paired marks, disjoint and in order; an outer pair covers those in it.

    A mark closes the latest open mark that it fits, unless it stands as an opening one (a space before, none after); else it
    opens, if no letter or digit is before it. Marks between letters are apostrophes. What is open where a line ends encloses nothing.
    """
    out: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []
    at: defaultdict[str, list[int]] = defaultdict(list)  # places of each mark in the stack

    def back(size: int) -> None:
        while len(stack) > size:
            at[stack.pop()[0]].pop()

    for m in MARKS.finditer(text):
        mark, p = m.group(), m.start()
        if mark == "\n":
            back(0)
            continue
        before, after = text[p - 1 : p] if p else "", text[p + 1 : p + 2]
        if before.isalnum() and after.isalnum() and mark in "`‘’":
            continue
        fit = max((at[x][-1] for x in PARTNERS.get(mark, "") if at[x]), default=-1)
        if fit >= 0 and not (not before.strip() and after.isalnum()):
            begin = stack[fit][1]
            back(fit)
            while out and out[-1][0] > begin:
                out.pop()
            out.append((begin, p))
        elif mark not in "”’" and not before.isalnum():
            if fit >= 0 and mark in PARTNERS[mark]:  # the one before was never closed
                back(fit)
            at[mark].append(len(stack))
            stack.append((mark, p))
    return out


def numbers(text: str | None, finder: Automaton) -> np.ndarray:
    """What the score is made of: matches by edits and quotation, their context and weight."""
    out = np.zeros(WIDTH)
    low = (text or "").lower()
    words = WORD.findall(low)
    kinds = {w: m for w in set(words) if (m := finder.match(w)) and not (m[1] and w in finder.plain)}
    out[8] = np.log1p(len(words)) / 10
    if not kinds:
        return out
    at = [i for i, w in enumerate(words) if w in kinds]
    spots = [m.span() for m in WORD.finditer(low) if m.group() in kinds]
    quoted = densest = 0
    spans = quotations(low)
    begins = [a for a, _ in spans]
    bare = set()
    j = 0
    for k, i in enumerate(at):
        while at[j] < i - CONTEXT:
            j += 1
        densest = max(densest, k - j + 1)
        _, far = kinds[words[i]]
        x, y = spots[k]
        own = bisect_left(begins, x) - 1
        inside = own >= 0 and y <= spans[own][1]
        quoted += inside
        if not inside:
            bare.add(words[i])
        out[(2 if far else 0) + inside] += 1
    share = {w: 1.0 if w in bare else QUOTED for w in kinds}
    weight = max(share[w] * finder.weights[t] / (1 + d) for w, (t, d) in kinds.items())
    out[:4] = np.log1p(out[:4])
    out[4] = weight / 5
    out[5] = densest / len(at)
    out[6] = quoted / len(at)
    out[7] = np.log1p(sum(share.values()))
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 0.02) -> np.ndarray:
    """Weights of a logistic regression, the last for 1, by Newton's method."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def lexicon(rows: DataFrame, most: int = TERMS) -> tuple[dict[str, float], set[str]]:
    """From rows of text and label: terms and weights, and words near to terms that are words of other documents."""

    def count(batches):
        yes: Counter = Counter()
        no: Counter = Counter()
        docs = [0, 0]
        for b in batches:
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = set(WORD.findall((text or "").lower()))
                terms = words | {w[:k] + "*" for w in words for k in STEMS if len(w) >= k}
                (yes if label else no).update(terms)
                docs[bool(label)] += 1
        terms = [*yes.keys(), *(no.keys() - yes.keys())]
        for lo in range(0, len(terms), 50_000):
            own = terms[lo : lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([yes[t] for t in own], pa.int64()), pa.array([no[t] for t in own], pa.int64())], names=["term", "yes", "no"])
        yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([docs[1]], pa.int64()), pa.array([docs[0]], pa.int64())], names=["term", "yes", "no"])

    sums = stored(rows.select("text", "label").mapInArrow(count, "term string, yes long, no long").groupBy("term").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "toxicity-terms")
    whole = sums.filter("term = ''").first()
    if not whole or not whole["yes"] or not whole["no"]:
        return {}, set()
    odds = F.log((F.col("yes") + 0.5) / (whole["yes"] + 1)) - F.log((F.col("no") + 0.5) / (whole["no"] + 1))
    least = max(SUPPORT, SHARE * whole["yes"])
    best = sums.filter("term <> ''").withColumn("odds", odds).filter((F.col("yes") >= least) & (F.col("odds") >= ODDS)).orderBy(F.desc("yes"), "term").limit(most)
    found = {r["term"]: (r["yes"], float(r["odds"])) for r in best.collect()}
    # a beginning goes where a longer term holds nearly as many toxic documents, a longer beginning where a shorter one stays;
    # whole words stay beside their beginnings, since only they match with edits
    longer = Counter()
    for t, (yes, _) in found.items():
        for k in STEMS:
            if len(t.rstrip("*")) > k or (t[-1] != "*" and len(t) >= k):
                longer[t[:k] + "*"] = max(longer[t[:k] + "*"], yes)
    stems = {t for t, (yes, _) in found.items() if t[-1] == "*" and longer[t] < 0.9 * yes}
    terms = {t: o for t, (_, o) in found.items() if t[-1] != "*" or (t in stems and not any(t[:k] + "*" in stems and t != t[:k] + "*" for k in STEMS))}

    def near(batches):
        finder = Automaton(terms)
        for b in batches:
            own = [bool((m := finder.match(w)) and m[1]) for w in b.column(0).to_pylist()]
            yield b.filter(pa.array(own, pa.bool_()))

    plain = sums.filter((F.col("no") >= 2) & (F.col("no") >= F.col("yes")) & (F.right("term", F.lit(1)) != "*")).select("term", "no")
    return terms, {r["term"] for r in plain.mapInArrow(near, "term string, no long").orderBy(F.desc("no"), "term").limit(PLAIN).collect()}


class Model:
    def __init__(self, terms: dict[str, float], plain: set[str], weights: np.ndarray | None):
        self.terms, self.plain, self.weights, self.finder = terms, plain, weights, None

    def __getstate__(self):
        return {"terms": self.terms, "plain": self.plain, "weights": self.weights, "finder": None}

    def score(self, texts_: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts_))
        if self.finder is None:
            self.finder = Automaton(self.terms, self.plain)
        x = np.array([numbers(t, self.finder) for t in texts_]).reshape(-1, WIDTH)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, docs_most: int = DOCS) -> Model:
    """A model of labels.toxic from a sample of rows that aren't held out."""
    chosen = stored(sample(labels, "toxic", MOD, REST, docs_most), "toxicity-sample")
    rows = stored(texts(docs, chosen).select("doc_id", "text", "label"), "toxicity-texts")
    terms, plain = lexicon(rows)
    if not terms:
        return Model({}, set(), None)

    def encode(batches):
        finder = Automaton(terms, plain)
        for b in batches:
            x = [numbers(t, finder).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.binary())], names=["doc_id", "label", "x"])

    once = rows.mapInArrow(encode, "doc_id long, label int, x binary").groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("own")).select("doc_id", "own.*")  # one row of each id, the same on every run
    got = sorted((r["doc_id"], r["label"], bytes(r["x"])) for r in once.collect())
    x = np.stack([np.frombuffer(x, np.float64) for *_, x in got])
    return Model(terms, plain, fit(x, np.array([y for _, y, _ in got], float)))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def score(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.value.score(b.column(1).to_pylist()))], names=["doc_id", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = own.mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", held_out(MOD, REST).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
