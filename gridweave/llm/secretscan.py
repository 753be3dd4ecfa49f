"""Secret scans: fixed rules, and a character convolutional network over every candidate with its context.

Rules (assign, access, hex) give base spans, which stay. A candidate is any run of LEAST or more of the characters A-Z a-z 0-9 + / _ . = - (without dots at
its ends) that no single base span covers, ordinary words included. The network reads the candidate and the 24 characters before and 8 behind it: filters over 3 and 5
characters, max-pooled over each of the three parts; means over the candidate of a weight for each character and for each pair of neighbouring character classes; its length.

It learns from labelled findings (text, start, end, label) by Adagrad, on all but a quarter of them; that quarter calibrates the logit (Platt
scaling) and sets the threshold: the largest that still finds RECALL of its secrets. findings() takes them from the corpus: of about SAMPLE documents, drawn by a hash
of the text, what the rules find without the word that gave it away (label 1), secrets of other shapes put in the place of
a candidate (label 1; there are no other labels for them, so they are made), and up to KEPT other candidates each (label 0; a missed secret among them is noise). A
document's findings are all learnt from or all kept apart. More labelled rows can be passed in.

All candidates of a piece of text are scored by the same array operations. Positions are code points, ends exclusive. Odd input: null texts are empty; texts of any length are
scanned whole; repeated rows are scanned each; an empty table gives no rows (its network learns from labelled() only); other columns are ignored.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import picked
from .words import runs

KINDS = ("assign", "access", "hex", "net")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
WORDS = ("passw", "secret", "token", "api")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{24,}")
LEAST, BEFORE, AFTER = 8, 24, 8
WIDTHS, FILTERS, SYMBOLS = (3, 5), 12, 130
OTHER, OUTSIDE = 128, 129
EPOCHS, BATCH, RATE, RECALL = 10, 64, 0.12, 0.97
#: Documents that findings are taken from, candidates of each, the length of those, and findings altogether.
SAMPLE, KEPT, LONGEST, MOST_FINDINGS = 1500, 6, 160, 20_000
#: Characters scored at once.
PIECE = 1 << 16

_MEMBER = np.zeros(SYMBOLS, bool)
_MEMBER[[ord(c) for c in string.ascii_letters + string.digits + "+/_.=-"]] = True
#: Classes of characters: vowel, other small letter, capital, digit, sign within candidates, anything else.
_CLASS = np.full(SYMBOLS, 5, np.int64)
for _k, _chars in enumerate(("aeiouy", "bcdfghjklmnpqrstvwxz", string.ascii_uppercase, string.digits, "+/_.=-")):
    _CLASS[[ord(c) for c in _chars]] = _k
CLASSES = 6


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def symbols(text: str) -> np.ndarray:
    """The text's characters as 0-127, others as OTHER."""
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8).astype(np.int16)
    return np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), OTHER).astype(np.int16)


def candidates(code: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the candidates in texts that stand one after another."""
    start, end = runs(_MEMBER[code], offsets)
    dot = code == ord(".")
    while (lead := (start < end) & dot[np.minimum(start, len(code) - 1)] if len(code) else start < end).any():
        start = start + lead
    while (tail := (start < end) & dot[end - 1] if len(code) else start < end).any():
        end = end - tail
    keep = end - start >= LEAST
    return start[keep], end[keep]


def _uncovered(start: np.ndarray, end: np.ndarray, base: list[tuple[int, int]]) -> np.ndarray:
    """Which spans no single one of the base spans (by start) covers."""
    if not base:
        return np.ones(len(start), bool)
    a, b = (np.array(x, np.int64) for x in zip(*base, strict=True))
    reach = np.concatenate(([-1], np.maximum.accumulate(b)))
    return reach[np.searchsorted(a, start, "right")] < end


def _pool(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Maxima of the rows of each range, at least 0; an empty range has 0."""
    out = np.zeros((len(start), values.shape[1]), np.float32)
    some = np.flatnonzero(end > start)
    if len(some):
        padded = np.concatenate((values, np.zeros((1, values.shape[1]), np.float32)))
        # One after another, so that ranges that overlap don't matter: every other result is the one wanted.
        out[some] = np.maximum(np.maximum.reduceat(padded, np.stack([start[some], end[some]], 1).ravel(), axis=0)[::2], 0)
    return out


@dataclass
class CharNet:
    filters: list[np.ndarray]  # for each width: (width, SYMBOLS, FILTERS)
    weights: np.ndarray  # of the pooled filters: before, own, behind
    letters: np.ndarray  # a weight for each character
    pairs: np.ndarray  # and for each two classes of neighbours
    lengths: np.ndarray  # of the logarithm of the length, and its square
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 0.5
    parts: int = field(default=3 * len(WIDTHS) * FILTERS)

    @classmethod
    def new(cls, seed: int = 5) -> CharNet:
        r = np.random.default_rng(seed)
        scaled = lambda x, *shape: (r.standard_normal(shape) * x).astype(np.float32)
        return cls([scaled(0.3, k, SYMBOLS, FILTERS) for k in WIDTHS], scaled(0.2, 3 * len(WIDTHS) * FILTERS), np.zeros(SYMBOLS, np.float32), np.zeros(CLASSES * CLASSES, np.float32), np.zeros(2, np.float32))

    def logits(self, code: np.ndarray, start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For candidates (by start) in code whose texts reach from low to high; block by block, whatever their lengths."""
        out = np.zeros(len(start), np.float64)
        lo = 0
        while lo < len(start):
            hi = max(lo + 1, int(np.searchsorted(end, start[lo] + PIECE)))
            first, last = int(max(low[lo], start[lo] - BEFORE)), int(min(len(code), high[hi - 1], end[hi - 1] + AFTER))
            pools = np.zeros((hi - lo, self.parts), np.float32)
            for a in range(first, last, PIECE):  # one block, unless a candidate is longer than that
                self._pooled(code, a, min(a + PIECE, last), start[lo:hi], end[lo:hi], low[lo:hi], high[lo:hi], pools)
            own = code[start[lo] : end[hi - 1]]
            s, e = start[lo:hi] - start[lo], end[lo:hi] - start[lo]
            sums = lambda x: np.concatenate(([0.0], np.cumsum(x, dtype=np.float64)))
            letter, cls = sums(self.letters[own]), _CLASS[own]
            pair = sums(self.pairs[cls[:-1] * CLASSES + cls[1:]]) if len(own) > 1 else np.zeros(1)
            out[lo:hi] = pools @ self.weights + (letter[e] - letter[s]) / (e - s) + (pair[e - 1] - pair[s]) / (e - s - 1) + self.sizes(e - s) @ self.lengths + self.bias
            lo = hi
        return out

    def _pooled(self, code, a, b, start, end, low, high, pools) -> None:
        """Takes the filters' values at places a to b into the pools of the candidates."""
        at = 0
        for width, f in zip(WIDTHS, self.filters, strict=True):
            own = code[a : b + width - 1]
            n = len(own) - width + 1
            value = f[0][own[:n]] if n > 0 else np.zeros((0, FILTERS), np.float32)
            for j in range(1, width):
                value += f[j][own[j : j + n]]
            for s, e in ((np.maximum(low, start - BEFORE), start), (start, end), (end, np.minimum(high, end + AFTER))):
                first, last = np.clip(s - a, 0, max(n, 0)), np.clip(e - width + 1 - a, 0, max(n, 0))
                part = pools[:, at : at + FILTERS]
                np.maximum(part, _pool(value, first, last), out=part)
                at += FILTERS

    @staticmethod
    def sizes(n: np.ndarray) -> np.ndarray:
        x = np.log(np.maximum(n, 1) / 16)
        return np.stack([x, x * x], 1)

    def probability(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(z) + self.offset, -500, 500)))

    def learn(self, findings: list[tuple[str, int, int, int]], seed: int = 3) -> None:
        """Batches of findings of like lengths, padded; a batch is a few array operations."""
        r = np.random.default_rng(seed)
        params = [*self.filters, self.weights, self.letters, self.pairs, self.lengths]
        gains, gain_bias = [np.full_like(p, 1e-2) for p in params], 1e-2
        order = sorted(range(len(findings)), key=lambda i: findings[i][2] - findings[i][1])
        batches = [self._batch([findings[i] for i in order[lo : lo + BATCH]]) for lo in range(0, len(order), BATCH)]
        for _ in range(EPOCHS):
            for k in r.permutation(len(batches)):
                moves, d_bias = self._gradient(*batches[k])
                for p, d, s in zip(params, moves, gains, strict=True):
                    s += d * d
                    p -= (RATE * d / np.sqrt(s)).astype(np.float32)
                gain_bias += d_bias**2
                self.bias -= float(RATE * d_bias / np.sqrt(gain_bias))

    @staticmethod
    def _batch(findings):
        most = max(e - s for _, s, e, _ in findings)
        x = np.full((len(findings), BEFORE + most + AFTER), OUTSIDE, np.int64)
        n = np.array([e - s for _, s, e, _ in findings])
        lead, tail = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for i, (text, s, e, _) in enumerate(findings):
            lead[i], tail[i] = min(s, BEFORE), min(len(text) - e, AFTER)
            x[i, BEFORE - lead[i] : BEFORE + n[i] + tail[i]] = symbols(text[s - lead[i] : e + tail[i]])
        place, row = np.arange(x.shape[1])[None, :], np.arange(len(n))[:, None]
        own = (place >= BEFORE) & (place < BEFORE + n[:, None])
        letters = np.zeros((len(n), SYMBOLS), np.float32)
        np.add.at(letters, (np.broadcast_to(row, x.shape)[own], x[own]), 1)
        cls = _CLASS[x]
        both, pairs = own[:, 1:] & own[:, :-1], np.zeros((len(n), CLASSES * CLASSES), np.float32)
        np.add.at(pairs, (np.broadcast_to(row, both.shape)[both], (cls[:, :-1] * CLASSES + cls[:, 1:])[both]), 1)
        ranges = [(BEFORE - lead, np.full(len(n), BEFORE)), (np.full(len(n), BEFORE), BEFORE + n), (BEFORE + n, BEFORE + n + tail)]
        return x, ranges, letters / n[:, None], pairs / (n - 1)[:, None], CharNet.sizes(n).astype(np.float32), np.array([f[3] for f in findings], np.float32)

    def _gradient(self, x, ranges, letters, pairs, sizes, labels):
        place, rows, pools, peaks = np.arange(x.shape[1])[None, :], np.arange(len(x))[:, None], [], []
        for width, f in zip(WIDTHS, self.filters, strict=True):
            n = x.shape[1] - width + 1
            value = sum(f[j][x[:, j : j + n]] for j in range(width))
            for s, e in ranges:
                inside = (place[:, :n] >= s[:, None]) & (place[:, :n] <= e[:, None] - width)
                held = np.where(inside[:, :, None], value, -np.inf)
                peak = held.argmax(1)
                pools.append(np.maximum(held[rows, peak, np.arange(FILTERS)[None, :]], 0))
                peaks.append(peak)
        pool = np.concatenate(pools, 1)
        z = pool @ self.weights + letters @ self.letters + pairs @ self.pairs + sizes @ self.lengths + self.bias
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels).astype(np.float32)
        moves = [np.zeros_like(f) for f in self.filters]
        for k, (part, peak) in enumerate(zip(pools, peaks, strict=True)):
            i, c = np.nonzero(part > 0)
            own = k // 3
            for j in range(WIDTHS[own]):
                np.add.at(moves[own][j], (x[i, peak[i, c] + j], c), g[i] * self.weights[k * FILTERS + c])
        return [*moves, g @ pool, g @ letters, g @ pairs, g @ sizes], float(g.sum())

    def calibrate(self, z: np.ndarray, labels: np.ndarray) -> None:
        """Platt scaling by Newton steps with a little ridge; then the largest threshold that keeps RECALL."""
        a, x = np.array([1.0, 0.0]), np.stack([z, np.ones_like(z)], 1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
            a -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), x.T @ (p - labels) + 0.1 * (a - [1, 0]))
        self.slope, self.offset = max(1e-3, float(a[0])), float(a[1])
        secrets = np.sort(self.probability(z[labels == 1]))
        self.threshold = float(secrets[int(np.floor((1 - RECALL) * len(secrets)))]) if len(secrets) else 1.1


def score_findings(net: CharNet, findings: list[tuple[str, int, int, int]]) -> np.ndarray:
    """Logits, the texts laid one after another."""
    size = np.array([len(t) for t, *_ in findings], np.int64)
    low = np.cumsum(size) - size
    start, end = (low + np.array([f[k] for f in findings], np.int64) for k in (1, 2))
    return net.logits(symbols("".join(t for t, *_ in findings)), start, end, low, low + size) if findings else np.zeros(0)


_ALNUM = string.ascii_letters + string.digits


class Maker:
    """Secrets and harmless strings of many shapes, the same for a seed."""

    def __init__(self, seed: int):
        self.r = np.random.default_rng(seed)

    def pick(self, chars: str, least: int, most: int | None = None) -> str:
        n = least if most is None else int(self.r.integers(least, most + 1))
        return "".join(np.array(list(chars))[self.r.integers(0, len(chars), n)])

    def word(self) -> str:
        syllables = ["an", "re", "ti", "on", "er", "the", "ing", "st", "ver", "lo", "ma", "ed", "sch", "que", "men", "al", "in", "or", "us"]
        return "".join(syllables[i] for i in self.r.integers(0, len(syllables), self.r.integers(1, 4)))

    def number(self, a: int, b: int) -> str:
        return str(self.r.integers(a, b))

    def secret(self) -> str:
        p = self.pick
        shapes = (
            lambda: p("0123456789ABCDEF", 32, 64), lambda: p(_ALNUM, 20, 48), lambda: p(_ALNUM + "+/", 40), lambda: p(_ALNUM + "+/", 43) + "=",
            lambda: "ey" + p(_ALNUM, 20) + "." + p(_ALNUM, 30) + "." + p(_ALNUM + "_-", 40), lambda: self.word()[:4] + "_" + p(_ALNUM, 24, 36), lambda: p(_ALNUM + "_-", 36),
            lambda: "-".join(p("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)), lambda: p(string.ascii_letters, 24, 40), lambda: p(string.ascii_lowercase, 28, 40), lambda: p(string.digits, 24, 40), lambda: p(_ALNUM, 12, 19),
        )
        return shapes[int(self.r.integers(0, len(shapes)))]()

    def harmless(self) -> str:
        w, n = self.word, self.number
        shapes = (
            lambda: w() + "-" + w() + "-" + n(1, 100) + "-" + w() + w(), lambda: "/".join([w(), w(), w() + n(0, 10), w()]) + ".html", lambda: f"{w()}.{n(1, 100)}.{w()}{n(1, 9)}.example.com", lambda: f"{w()}_{w()}_{w()}_{n(0, 99)}x",
            lambda: f"2024-0{n(1, 9)}-1{n(0, 9)}T0{n(0, 9)}.{n(10, 59)}.00Z", lambda: f"v{n(0, 20)}.{n(0, 20)}.{n(0, 20)}-{w()}.{n(1, 9)}-{w()}", lambda: w() + w() + w() + w() + w() + n(1, 99), lambda: "chapter" + n(1, 99) + "-" + w() + "-" + w() + w(),
            lambda: "=" * 12 + w() + n(1, 9) + "=" * 4, lambda: n(10**15, 10**16) + "x" + n(10, 99) + "cm", lambda: "-".join(w() + n(0, 9) for _ in range(5)), lambda: w() + w() + w() + w(), lambda: (w() + w() + w() + w()).capitalize(), lambda: (w() + w() + w() + w()).upper(),
        )
        own = ""
        while len(own) < LEAST:
            own = shapes[int(self.r.integers(0, len(shapes)))]()
        return own


def labelled(n: int = 1200, seed: int = 20) -> list[tuple[str, int, int, int]]:
    """Findings (text, start, end, label) in plain contexts, the same for a seed."""
    m, out = Maker(seed), []
    for k in range(n):
        own = m.secret() if k % 2 else m.harmless()
        lead = " ".join(m.word() for _ in range(int(m.r.integers(0, 6)))) + str(m.r.choice([" ", "\n", ' "', "### ", " ("]))
        tail = str(m.r.choice([" ", "\n", '" ', ". ", ") ", "%%% "])) + m.word()
        out.append((lead + own + tail, len(lead), len(lead) + len(own), k % 2))
    return out


def of_text(text: str, seed: int) -> Iterator[tuple[str, int, int, int]]:
    """Labelled findings of one document: excerpts around what rules find (the telling word left out), secrets in the places of candidates, and other candidates."""
    m, base = Maker(seed), base_spans(text)
    around = lambda s, own, e, y: (text[max(0, s - BEFORE) : s] + own + text[e : e + AFTER], min(s, BEFORE), min(s, BEFORE) + len(own), y)
    for s, e, kind in base[:KEPT]:
        own = ASSIGN.fullmatch(text, s, e)[2] if kind == "assign" else text[s:e]
        if LEAST <= len(own) <= LONGEST:
            lead = text[max(0, s - BEFORE) : s]
            yield lead + own + text[e : e + AFTER], len(lead), len(lead) + len(own), 1
    start, end = candidates(symbols(text), np.array([0, len(text)]))
    open_ = _uncovered(start, end, [(a, b) for a, b, _ in base]) & (end - start <= LONGEST)
    start, end = start[open_], end[open_]
    for k, i in enumerate(m.r.permutation(len(start))[: KEPT + 2].tolist()):
        s, e = int(start[i]), int(end[i])
        yield around(s, m.secret(), e, 1) if k < 2 else around(s, text[s:e], e, 0)
    plain = np.array([text[s:e].islower() and text[s:e].isalpha() for s, e in zip(start.tolist(), end.tolist(), strict=True)], bool)
    for i in m.r.permutation(np.flatnonzero(~plain))[:KEPT].tolist():  # rarer than words, and harder
        yield around(int(start[i]), text[start[i] : end[i]], int(end[i]), 0)


def findings(docs: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> list[tuple[str, int, int, int, int]]:
    """(text, start, end, label, document's number) of about `sample` documents, drawn by a hash of their texts, MOST_FINDINGS at most."""
    docs = picked(docs, text_col, text_col).select("text").where("text is not null")
    share = min(1.0, sample / max(1, docs.count()))

    def work(batches):
        for b in batches:
            rows = [(*x, h) for t, h in zip(b.column("text").to_pylist(), b.column("h").to_pylist(), strict=True) for x in of_text(t, h)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))], ["text", "start", "end", "label", "h"])

    h = F.xxhash64("text", F.lit(20)).bitwiseAND((1 << 40) - 1)
    some = docs.withColumn("h", h).where(F.col("h") < int(share * (1 << 40))).mapInArrow(work, "text string, start long, end long, label long, h long")
    rows = some.limit(MOST_FINDINGS).collect()  # excerpts of at most BEFORE + LONGEST + AFTER characters
    return sorted((r.text, r.start, r.end, r.label, r.h) for r in rows)


def trained(found: list[tuple[str, int, int, int, int]] | None = None) -> CharNet:
    """From findings with their documents' numbers, and labelled() in addition."""
    rows = [*(found or []), *((*x, k) for k, x in enumerate(labelled()))]
    apart = [r[4] % 4 == 3 for r in rows]
    net = CharNet.new()
    net.learn([r[:4] for r, a in zip(rows, apart, strict=True) if not a])
    held = [r[:4] for r, a in zip(rows, apart, strict=True) if a]
    net.calibrate(score_findings(net, held), np.array([r[3] for r in held], np.float64))
    return net


def spans_of(texts: list[str], net: CharNet) -> list[list[tuple[str, int, int, float | None]]]:
    """For each text (kind, start, end, score) by start, then kind as listed."""
    code = symbols("".join(texts))
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    start, end = candidates(code, offsets)
    row = np.searchsorted(offsets, start, "right") - 1
    base = [base_spans(t) for t in texts]
    every = [(offsets[k] + s, offsets[k] + e) for k, own in enumerate(base) for s, e, _ in own]
    open_ = _uncovered(start, end, every)
    start, end, row = start[open_], end[open_], row[open_]
    p = net.probability(net.logits(code, start, end, offsets[row], offsets[row + 1]))
    out: list[list[tuple[str, int, int, float | None]]] = [[(k, s, e, None) for s, e, k in own] for own in base]
    hit = np.flatnonzero(p >= net.threshold)
    for i in hit.tolist():
        k = int(row[i])
        out[k].append(("net", int(start[i] - offsets[k]), int(end[i] - offsets[k]), float(p[i])))
    for k in np.unique(row[hit]).tolist():
        out[k].sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return out


def spans(text: str, net: CharNet) -> list[tuple[str, int, int, float | None]]:
    return spans_of([text], net)[0]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def scan(docs: DataFrame, net: CharNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: spans, an array of (kind, start, end, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size

    def work(batches):
        for b in batches:
            texts, lo = [t or "" for t in b.column("text").to_pylist()], 0
            while lo < len(texts):
                hi, n = lo + 1, len(texts[lo])
                while hi < len(texts) and n + len(texts[hi]) <= PIECE:
                    n += len(texts[hi])
                    hi += 1
                rows = [[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in own] for own in spans_of(texts[lo:hi], shared.value)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), pa.array(rows, _SPANS)], ["doc_id", "spans"])
                lo = hi

    return picked(docs, id_col, text_col).mapInArrow(work, "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>")
