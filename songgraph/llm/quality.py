"""Document quality by a linear-chain CRF over lines.

Every line gets features of its own characters and words and those of its neighbours.
A two-state chain (bad, good) is trained on labelled documents, whose lines all carry
the document's label; forward-backward gives each line's probability of being good, and
the mean over a document, weighted by line lengths, is its quality.
"""

from __future__ import annotations

from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songgraph.llm.common import map_rows, sample_ids

# Classes of characters, counted per line.
LETTER, UPPER, DIGIT, SPACE, STOP, MARK, BAR, OTHER = range(8)
_KIND = np.full(0x3000, LETTER, np.int8)            # letters beyond ASCII by default
_KIND[:128] = OTHER
for _c in range(0x250):
    _s = chr(_c)
    if _s.isdigit():
        _KIND[_c] = DIGIT
    elif _s.isspace():
        _KIND[_c] = SPACE
    elif _s.isupper():
        _KIND[_c] = UPPER
    elif _s.isalpha():
        _KIND[_c] = LETTER
    elif _s in ".,;:'\"()?-":
        _KIND[_c] = STOP
    elif _s == "!":
        _KIND[_c] = MARK
    elif _s == "|":
        _KIND[_c] = BAR
    else:
        _KIND[_c] = OTHER
OWN = 15                    # features of a line
WIDTH = 3 * OWN + 3         # with both neighbours' and edge marks and a constant


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of the texts, their lengths, and each text's first line.

    Empty lines are lines of length 0; an empty text is one empty line."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _KIND[np.minimum(codes, 0x2fff)]
    ends = np.flatnonzero(codes == 10)
    starts = np.r_[0, ends[:-1] + 1]
    length = ends - starts
    first = np.r_[0, np.cumsum([t.count("\n") + 1 for t in texts])]
    counts = np.empty((len(ends), 8))
    for k in range(8):
        sums = np.r_[0, np.cumsum(kind == k, dtype=np.int64)]
        counts[:, k] = sums[ends] - sums[starts]
    words, repeats, distinct = (np.zeros(len(ends)) for _ in range(3))
    for i, line in enumerate(joined.split("\n")[:-1]):
        w = line.split()
        if w:
            words[i] = len(w)
            repeats[i] = sum(map(eq, w, w[1:]))
            distinct[i] = len(set(w))
    size, many = np.maximum(length, 1), np.maximum(words, 1)
    share = counts / size[:, None]
    letters = np.maximum(counts[:, LETTER] + counts[:, UPPER], 1)
    x = np.column_stack([
        share[:, OTHER], share[:, BAR], share[:, MARK], share[:, DIGIT], share[:, STOP],
        counts[:, UPPER] / letters, repeats / many, 1 - distinct / many,
        np.log1p(length) / 8, np.minimum(size / many, 40) / 10,
        np.minimum(counts[:, OTHER] / many, 3), np.minimum(counts[:, BAR] / many, 2),
        np.minimum(counts[:, MARK] / many, 3), share[:, OTHER] > .02, length == 0])
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    head, tail = first[:-1], first[1:] - 1
    before[head], after[tail] = 0, 0
    edges = np.zeros((len(x), 3))
    edges[head, 0], edges[tail, 1], edges[:, 2] = 1, 1, 1
    return np.hstack([x, before, after, edges]), length, first


def marginals(energy: np.ndarray, first: np.ndarray, step: np.ndarray):
    """Forward-backward over all chains at once. ``energy`` (lines, 2), ``first`` chain
    starts, ``step`` (2, 2). Returns log scale-free P(good) per line, pair marginals
    summed over all links, and the log partition. Chains are sorted by length, so each
    round works on those that still have a line."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    n, head = sizes[order], first[:-1][order]
    pot = np.exp(energy - energy.max(1, keepdims=True))
    log_z = energy.max(1).sum()
    M = np.exp(step - step.max())
    log_z += step.max() * (sizes - 1).sum()
    fwd, bwd, scale = np.empty_like(pot), np.empty_like(pot), np.empty(len(pot))
    alive = len(n)
    for t in range(int(n[0])):
        alive = int(np.searchsorted(-n, -t, "left"))        # chains longer than t
        at = head[:alive] + t
        a = pot[at] if t == 0 else (fwd[at - 1] @ M) * pot[at]
        scale[at] = a.sum(1)
        fwd[at] = a / scale[at][:, None]
    log_z += np.log(scale).sum()
    pair = np.zeros((2, 2))
    for t in range(int(n[0]) - 1, -1, -1):
        alive = int(np.searchsorted(-n, -t, "left"))
        more = int(np.searchsorted(-n, -(t + 1), "left"))   # those with a line after t
        at = head[:alive] + t
        b = np.ones((alive, 2))
        if more:
            nxt = at[:more] + 1
            w = pot[nxt] * bwd[nxt] / scale[nxt][:, None]
            b[:more] = w @ M.T
            pair += fwd[at[:more]].T @ w * M
        bwd[at] = b
    both = fwd * bwd
    return both / both.sum(1, keepdims=True), pair, log_z


class Chain:
    """Weights: (WIDTH, 2) of the features (state 0 fixed at zero) and (2, 2) of links."""

    def __init__(self):
        self.w, self.t, self.base = np.zeros(WIDTH), np.zeros((2, 2)), 0.5

    def line_quality(self, x, first):
        return marginals(np.column_stack([np.zeros(len(x)), x @ self.w]), first, self.t)[0][:, 1]

    def fit(self, x, first, good, rounds: int = 150, rate: float = 0.15, ridge: float = 1e-4):
        """Adam on the conditional log-likelihood; ``good`` is each line's state."""
        sizes = np.diff(first)
        link = np.ones(len(x), bool)
        link[first[1:] - 1] = False
        g = good.astype(int)
        seen = np.zeros((2, 2))
        idx = np.flatnonzero(link)
        np.add.at(seen, (g[idx], g[idx + 1]), 1)
        n, m, q = len(x), 0, 0
        theta = np.r_[self.w, self.t.ravel()]
        for k in range(1, rounds + 1):
            self.w, self.t = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
            p, pair, _ = marginals(np.column_stack([np.zeros(n), x @ self.w]), first, self.t)
            grad = np.r_[x.T @ (p[:, 1] - good), (pair - seen).ravel()] / n + ridge * theta
            m, q = .9 * m + .1 * grad, .99 * q + .01 * grad ** 2
            theta = theta - rate * (1 - k / (rounds + 1)) * (m / (1 - .9 ** k)) / (np.sqrt(q / (1 - .99 ** k)) + 1e-8)
        self.w, self.t = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        return sizes

    def score(self, texts: list[str]) -> list[float]:
        """Length-weighted mean of P(good); a text without characters gets the base rate."""
        x, length, first = line_features(texts)
        p = self.line_quality(x, first)
        mass = np.add.reduceat(length.astype(float), first[:-1])
        mean = np.add.reduceat(p * length, first[:-1]) / np.maximum(mass, 1)
        return np.where(mass > 0, mean, self.base).tolist()


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", sample: int = 3000, longest: int = 64) -> Chain:
    """Fit on at most ``sample`` labelled documents, chosen by a hash of the id; chains of
    more than ``longest`` lines are fitted in parts. Null keys, labels and texts are left
    out; without labelled documents every line gets probability one half."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()) \
        .groupBy(key).agg(F.min(label).alias("_y"))
    picked = sample_ids(known, key, sample)

    def run(cols):
        x, length, first = line_features(cols[text])
        return {"y": cols["_y"], "x": [np.round(x[a:b], 6).ravel().tolist() for a, b in zip(first, first[1:])]}

    rows = map_rows(docs.where(F.col(text).isNotNull()).select(key, text)
                    .join(F.broadcast(picked), key).orderBy(key).select("_y", text),
                    run, "y int, x array<float>", rows=64).collect()
    chain = Chain()
    if not rows:
        return chain
    xs, firsts, ys, at = [], [0], [], 0
    for r in rows:
        x = np.array(r["x"]).reshape(-1, WIDTH)
        for a in range(0, len(x), longest):
            part = x[a:a + longest]
            xs.append(part)
            at += len(part)
            firsts.append(at)
            ys.append(np.full(len(part), float(r["y"])))
    chain.base = float(np.clip(np.mean([r["y"] for r in rows]), .01, .99))
    chain.fit(np.vstack(xs), np.array(firsts), np.concatenate(ys))
    return chain


def score(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """One row per input row: key, score (0 to 1), predicted (1 if score >= threshold).

    A null or empty text gets the training documents' share of good ones. Null keys and
    repeated rows are scored each on its own; other columns are ignored."""
    kind = docs.schema[key].dataType.simpleString()

    def run(cols):
        s = chain.score([t or "" for t in cols[text]])
        return {key: cols[key], "score": s, "predicted": [int(v >= threshold) for v in s]}

    return map_rows(docs.select(key, text), run, f"`{key}` {kind}, score double, predicted int")


def keep_good(docs: DataFrame, chain: Chain, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows whose text scores at least the threshold, all columns as they are."""
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(cols):
        s = chain.score([t or "" for t in cols[text]])
        return {n: [v for v, p in zip(cols[n], s) if p >= threshold] for n in names}

    return map_rows(docs, run, schema)
