"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks of text. Each block is a vector of its hashed tag path (tags, words of classes and ids),
its hashed words and a few shares; a bidirectional LSTM in numpy reads the page's blocks in order and labels every block in
the light of all others. There are no labelled pages to learn from, so the labeller is trained on pages that a small grammar
composes from a seed: articles among menus, headers, footers, sidebars, notices, adverts, forms and reader comments, in many
mark-ups.

Rows: null or empty html has no text; pages without main text give an empty text; cut-off and misnested mark-up is read as far as
it goes; null and repeated ids are kept row by row; further columns are ignored. Memory: a batch of pages and the states of
a few thousand blocks at a time.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .words import LOWER, VISIBLE, hashes, spans

PATH, HASHED, SHARES, HIDDEN = 160, 32, 10, 20
WIDTH = PATH + HASHED + SHARES
#: Pages and rounds of the training; blocks that are labelled at a time.
PAGES, ROUNDS, CELLS = 700, 8, 1 << 14

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
RAW = {"script", "style", "template", "noscript", "iframe", "svg", "textarea", "select", "object", "math", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul caption button label".split())
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
PART = re.compile(r"[a-z]+")
ENDS = re.compile(r"[.!?…。！？]")


@lru_cache(20_000)
def marks(tag: str, attributes: str) -> tuple[int, ...]:
    """Places in the path vector of a tag and the words of its class, id and role."""
    names = ["<" + tag]
    low = attributes.lower()
    for k, v in ATTRIBUTE.findall(low):
        if k in ("class", "id", "role", "itemprop"):
            names += PART.findall(v)
        elif k == "style" and "none" in v:
            names.append("hidden")
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)", low):
        names.append("hidden")
    return tuple(sorted({zlib.crc32(n.encode()) % PATH for n in names}))


def blocks(page: str) -> list[tuple[str, tuple[int, ...], int]]:
    """Text, path places and characters within links of the page's leaf blocks."""
    out: list[tuple[str, tuple[int, ...], int]] = []
    stack: list[tuple[str, tuple[int, ...]]] = []
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            own = " ".join(html.unescape("".join(text)).split())
            if own:
                out.append((own, tuple(sorted({p for _, ps in stack for p in ps})), min(linked, len(own))))
            text.clear()
        linked = 0

    def close(name: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                del stack[i:]
                return

    at, skip = 0, None
    links = 0
    for m in TAG.finditer(page):
        if m.start() < at:
            continue
        name = m.group(2) or m.group(5)
        if m.start() > at:
            part = page[at : m.start()]
            text.append(part)
            if links:
                linked += len(part.strip())
        at = m.end()
        if not name:
            continue
        name = name.lower()
        ends = bool(m.group(1) or m.group(4))
        attributes = m.group(3) if m.group(2) else m.group(6)
        if name in RAW and not ends and not attributes.rstrip().endswith("/"):
            skip = re.compile(f"</{name}\\s*>", re.I).search(page, at)
            at = skip.end() if skip else len(page) if name in ("script", "style", "textarea") else at
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCKS:
            flush()
        if ends:
            if name == "a":
                links = max(0, links - 1)
            close(name)
            if name in BLOCKS:
                links = 0
            continue
        if name in VOID:
            continue
        if name in BLOCKS:
            if any(s[0] == "p" for s in stack[-8:]):
                close("p")
            if name == "li" and stack and stack[-1][0] == "li":
                stack.pop()
        if name == "a":
            links += 1
        stack.append((name, marks(name, attributes)))
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


def vectors(found: list[tuple[str, tuple[int, ...], int]]) -> np.ndarray:
    """A row of WIDTH for each block of a page."""
    n = len(found)
    x = np.zeros((n, WIDTH), np.float32)
    raw = [t.encode("utf-8", "replace") for t, _, _ in found]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    begin, end = spans(data, at, VISIBLE)
    row = np.searchsorted(at, begin, side="right") - 1
    counts = np.bincount(row * HASHED + (hashes(data, begin, end) % np.uint64(HASHED)).astype(np.int64), minlength=n * HASHED).reshape(n, HASHED)
    words = np.maximum(1, counts.sum(axis=1))
    x[:, PATH : PATH + HASHED] = counts / words[:, None]
    for k, (t, path, linked) in enumerate(found):
        x[k, list(path)] = 1
        m = len(t)
        x[k, PATH + HASHED :] = (np.log1p(m) / 5, np.log1p(words[k]) / 3, linked / m, min(1, len(ENDS.findall(t)) * 20 / m), min(1, t.count(",") * 20 / m), k / n, (n - k) / n, 1, sum(c.isupper() for c in t) / m, "©" in t)
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM; batches are (time, pages, width) with a mask (time, pages)."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        f = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"w{d}": f(WIDTH, 4 * HIDDEN), f"u{d}": f(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
        self.p |= {"o": f(2 * HIDDEN, 1)[:, 0], "e": np.zeros(1, np.float32)}

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        steps, pages, _ = x.shape
        z = x @ self.p[f"w{d}"] + self.p[f"c{d}"]
        h, c = (np.zeros((pages, HIDDEN), np.float32) for _ in range(2))
        out, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = z[t] + h @ self.p[f"u{d}"]
            i, f, o = (sigmoid(a[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(a[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            s = np.tanh(new)
            if keep:
                kept.append((t, i, f, o, g, c, s, h, m))
            h, c = m * (o * s) + (1 - m) * h, m * new + (1 - m) * c
            out[t] = h
        return out, kept

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> np.ndarray:
        a, b = self._run("f", x, mask, keep), self._run("b", x, mask, keep)
        h = np.concatenate([a[0], b[0]], axis=2)
        if keep:
            self.kept = (x, h, a[1], b[1])
        return sigmoid(h @ self.p["o"] + self.p["e"])

    def backward(self, error: np.ndarray) -> dict[str, np.ndarray]:
        x, h, *runs = self.kept
        g = {"o": np.einsum("tpk,tp->k", h, error), "e": np.array([error.sum()])}
        dh = error[:, :, None] * self.p["o"]
        for n, (d, kept) in enumerate(zip("fb", runs, strict=True)):
            u = self.p[f"u{d}"]
            da_all = np.zeros((*error.shape, 4 * HIDDEN), np.float32)
            du = np.zeros_like(u)
            back_h = np.zeros((error.shape[1], HIDDEN), np.float32)
            back_c = np.zeros_like(back_h)
            for t, i, f, o, gg, c, s, before, m in reversed(kept):
                own = back_h + dh[t][:, n * HIDDEN : (n + 1) * HIDDEN]
                do, dc = own * m * s, back_c * m + own * m * o * (1 - s * s)
                da = np.concatenate([dc * gg * i * (1 - i), dc * c * f * (1 - f), do * o * (1 - o), dc * i * (1 - gg * gg)], axis=1)
                da_all[t] = da
                du += before.T @ da
                back_h = own * (1 - m) + da @ u.T
                back_c = dc * f + back_c * (1 - m)
            g[f"u{d}"], g[f"c{d}"] = du, da_all.sum(axis=(0, 1))
            g[f"w{d}"] = x.reshape(-1, WIDTH).T @ da_all.reshape(-1, 4 * HIDDEN)
        return g

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Scores of the blocks of each page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        while order:
            most = len(pages[order[-1]])
            own, order = order[-max(1, CELLS // most) :], order[: -max(1, CELLS // most)]
            x, mask = padded([pages[i] for i in own])
            score = self.forward(x, mask)
            for k, i in enumerate(own):
                out[i] = score[: len(pages[i]), k]
        return out

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], rounds: int = ROUNDS, size: int = 25, rate: float = 0.01) -> Labeller:
        rng = np.random.default_rng(5)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(rounds):
            for own in np.array_split(rng.permutation(len(pages)), max(1, len(pages) // size)):
                x, mask = padded([pages[i] for i in own])
                y = np.zeros(mask.shape, np.float32)
                for k, i in enumerate(own):
                    y[: len(labels[i]), k] = labels[i]
                grads = self.backward(((self.forward(x, mask, True) - y) * mask / mask.sum()).astype(np.float32))
                norm = np.sqrt(sum(float((v * v).sum()) for v in grads.values()))
                step += 1
                for k, v in grads.items():
                    v = v * min(1, 2 / (norm + 1e-9))
                    m[k], q[k] = 0.9 * m[k] + 0.1 * v, 0.999 * q[k] + 0.001 * v * v
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(q[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        self.kept = None
        return self


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), WIDTH), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


class Grammar:
    """Composes pages whose main blocks are known."""

    SIDE = {
        "nav": ("nav menu navbar navigation breadcrumb breadcrumbs topnav links", ("nav", "div", "ul", "header")),
        "header": ("header masthead banner site top logo brand", ("header", "div")),
        "footer": ("footer bottom copyright legal colophon", ("footer", "div")),
        "aside": ("sidebar side aside widget related recommended popular trending more tags share social", ("aside", "div", "section")),
        "notice": ("notice cookie cookies consent alert warning message popup modal overlay gdpr", ("div", "section", "aside", "dialog")),
        "ad": ("ad ads advert adverts advertisement sponsor sponsored promo banner", ("div", "aside", "section", "ins")),
        "form": ("form search login subscribe newsletter signup contact", ("form", "div", "fieldset")),
        "comments": ("comments comment replies reply discussion responses respond thread", ("section", "div", "ol", "aside")),
    }
    MAIN = ("article", "main", "section", "div", "div", "article")
    NAMES = "content article post entry main story body text page".split()
    SYLLABLES = "ka lo mi ne ru sa te vo zi an er on th in es or ou ver sch ung de la que re é ü ción ment ".split()

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(self.SYLLABLES) for _ in range(self.r.choice((1, 1, 2, 2, 3, 4))))

    def words(self, n: int, sign: str = "") -> str:
        out = [self.word() + sign for _ in range(n)]
        return " ".join(w + self.r.choice((",", ".", ".", "")) if self.r.random() < 0.15 else w for w in out).capitalize()

    def text(self, n: int) -> str:
        kind = self.r.random()
        if kind < 0.7:
            return self.words(n) + self.r.choice(".!?")
        if kind < 0.78:
            return self.words(n).upper() + "!!"
        if kind < 0.86:
            return " | ".join(self.word() for _ in range(n))
        if kind < 0.94:
            return self.words(n, self.r.choice(("%%%", "&amp;&amp;", "$$$", "***")))
        return " ".join([self.word()] * n)

    def attributes(self, names: list[str], chance: float = 0.8) -> str:
        if self.r.random() > chance:
            return ""
        own = self.r.sample(names, min(len(names), self.r.choice((1, 1, 2))))
        return f' {self.r.choice(("class", "class", "id"))}="{self.r.choice(("-", "_", " ")).join(own)}"'

    def item(self, tag: str, text: str, main: bool) -> None:
        if self.r.random() < 0.15:
            text = f"<b>{text}</b>"
        if main and self.r.random() < 0.15:
            text += f' <a href="#">{self.word()}</a> {self.words(3)}'
        self.out.append(f"<{tag}>{text}" + ("" if tag in ("p", "li") and self.r.random() < 0.1 else f"</{tag}>"))
        self.labels.append(main)

    def side(self, kind: str) -> None:
        names, tags = self.SIDE[kind]
        tag = self.r.choice(tags)
        plain = tag in ("nav", "header", "footer", "aside", "form")
        self.out.append(f"<{tag}{self.attributes(names.split(), 0.5 if plain else 1.0)}>")
        if kind == "nav":
            n = self.r.randint(2, 9)
            for _ in range(n):
                self.item("li", f'<a href="/{self.word()}">{self.words(self.r.choice((1, 1, 2)))}</a>', False)
        elif kind == "comments":
            for _ in range(self.r.randint(1, 6)):
                self.out.append(f"<{self.r.choice(('div', 'li', 'article'))}{self.attributes(['comment', 'reply', 'item'], 0.7)}>")
                if self.r.random() < 0.5:
                    self.item("span" if False else "div", self.words(2), False)
                self.item("p", self.text(self.r.randint(3, 40)), False)
                self.out.append("</div>")
        elif kind == "form":
            self.item("label", self.words(2), False)
            self.out.append('<input type="text">')
            self.item("button", self.word(), False)
        elif self.r.random() < 0.5:
            lead = "&copy; " if kind == "footer" and self.r.random() < 0.7 else ""
            self.out.append(lead + self.text(self.r.randint(2, 20)))
            self.labels.append(False)
        else:
            for _ in range(self.r.randint(1, 5)):
                text = self.text(self.r.randint(1, 15))
                self.item(self.r.choice(("p", "div", "li", "h3", "h4")), f'<a href="#">{text}</a>' if self.r.random() < 0.4 else text, False)
        self.out.append(f"</{tag}>")

    def page(self) -> tuple[str, list[bool]]:
        r = self.r
        self.out, self.labels = ["<!DOCTYPE html><html><head><title>"], []
        self.out.append(self.words(5) + "</title><style>p{margin:0}</style></head><body>")
        self.labels.append(False)
        for kind in ("notice", "header", "nav", "nav", "ad", "form", "aside"):
            if r.random() < (0.6 if kind == "nav" else 0.3):
                self.side(kind)
        wrap = r.random() < 0.3
        if wrap:
            self.out.append(f"<div{self.attributes(['wrapper', 'container', 'page', 'main', 'layout'])}>")
        if r.random() < 0.97:
            tag = r.choice(self.MAIN)
            self.out.append(f"<{tag}{self.attributes(self.NAMES, 0.3 if tag in ('article', 'main') else 0.9)}>")
            if r.random() < 0.85:
                self.item(r.choice(("h1", "h1", "h2")), self.text(r.randint(1, 9)), True)
            for k in range(r.choice((1, 1, 2, 3, 5, 8, 14, 25))):
                kind = r.random()
                if kind < 0.08:
                    self.item(r.choice(("h2", "h3")), self.words(r.randint(1, 6)), True)
                elif kind < 0.16:
                    self.out.append("<ul>")
                    for _ in range(r.randint(2, 5)):
                        self.item("li", self.text(r.randint(1, 12)), True)
                    self.out.append("</ul>")
                elif kind < 0.2:
                    self.item(r.choice(("blockquote", "pre", "figcaption", "td")), self.text(r.randint(3, 30)), True)
                elif kind < 0.26 and k:
                    self.side(r.choice(("ad", "aside", "form", "notice")))
                else:
                    self.item("p" if r.random() < 0.9 else "div", self.text(r.choice((1, 1, 2, 4, 10, 25, 60))), True)
            self.out.append(f"</{tag}>")
        for kind in ("aside", "form", "ad", "comments", "notice", "nav"):
            if r.random() < 0.25:
                self.side(kind)
        if wrap:
            self.out.append("</div>")
        if r.random() < 0.85:
            self.side("footer")
        if r.random() < 0.9:
            self.out.append("</body></html>")
        return "".join(self.out), self.labels

    def sample(self) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and labels of a page whose blocks come out as composed."""
        while True:
            page, labels = self.page()
            found = blocks(page)
            if len(found) == len(labels):
                return vectors(found), np.array(labels, np.float32)


def train(pages: int = PAGES, seed: int = 1) -> Labeller:
    own = [Grammar(seed + k).sample() for k in range(pages)]
    return Labeller().fit([x for x, _ in own], [y for _, y in own])


def extract(pages: list[str | None], labeller: Labeller) -> list[str]:
    found = [blocks(p) if p else [] for p in pages]
    scores = labeller.label([vectors(f) if f else np.zeros((0, WIDTH), np.float32) for f in found])
    return ["\n".join(t for (t, _, _), s in zip(f, score.tolist(), strict=True) if s >= 0.5) for f, score in zip(found, scores, strict=True)]


def report(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of all pages (page_id, url, html)."""
    model = pages.sparkSession.sparkContext.broadcast(train())

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                own = b.slice(lo, 256)
                texts = extract(own.column(2).to_pylist(), model.value)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op10_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "pages"))
