"""Toxic passages by maximum-scoring segments.

Token scores are log-odds of document frequencies in toxic against clean labelled
documents, smoothed by an informative Dirichlet prior: one pseudo-count and more by a token's
share of all labelled documents. Tokens whose log-odds are clear of zero (by their
standard error) keep them; an unseen token has the log-odds of its first letters. Every score is lowered by a constant, so ordinary text has a
negative drift. One linear scan (Ruzzo and Tompa) finds all maximal scoring segments of
a text. Their scores are calibrated by extreme-value statistics (Karlin and Altschul):
the expected number of segments of that score in clean text of the same length, fitted
on clean labelled documents. A logistic curve over the evidence of a document's
segments gives its score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songgraph.llm.common import map_rows, materialize, sample_ids

_WORD = re.compile(r"[^\W_]+")
STEM = 4                 # letters of an unseen token that are looked up
DRIFT = 0.4              # taken from every token's score


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def stem(word: str) -> str:
    return "^" + word[:STEM]


@dataclass
class Model:
    score: dict[str, float] = field(default_factory=dict)   # tokens and "^" stems
    decay: float = 1.0                                      # lambda of the extreme-value law
    log_k: float = 0.0
    weight: tuple[float, float, float] = (-6.0, 0.0, 1.0)   # intercept, best, all segments


def segments(model: Model, words: list[str]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first token, end token) in one linear scan.
    Runs of tokens without evidence are passed as one step of their summed drift. Each
    candidate keeps the place of the nearest earlier one that starts lower, so a search
    passes no candidate twice; when none starts lower, no later segment can reach back
    over this point, and the candidates so far are final."""
    get, out = model.score.get, []
    # stack of candidate segments: (sum before, sum after, first, end, nearest lower start)
    total, last = 0.0, 0
    stack: list[tuple[float, float, int, int, int]] = []
    for i, s in enumerate(map(get, words)):
        if i and words[i] == words[i - 1]:      # a word said again at once is no new evidence
            continue
        if s is None:
            w = words[i]
            if len(w) <= STEM:
                continue
            s = get(stem(w))
            if s is None:
                continue
        s -= DRIFT
        total -= DRIFT * (i - last)         # the passed tokens
        last = i + 1
        before, total = total, total + s
        if s <= 0:
            continue
        left, right, first, end = before, total, i, i + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0:
                out += [(y - x, a, b) for x, y, a, b, _ in stack]
                stack = [(left, right, first, end, -1)]
                break
            if stack[j][1] >= right:
                stack.append((left, right, first, end, j))
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:]
    return out + [(y - x, a, b) for x, y, a, b, _ in stack]


def evidence(model: Model, found, n: int) -> tuple[float, float]:
    """Negative log of the expected number of segments as good as the best one, and the
    sum over all significant ones; zero without any."""
    if not found:
        return 0.0, 0.0
    space = model.log_k + math.log(max(n, 2))
    bits = sorted((max(0.0, model.decay * s - space) for s, _, _ in found), reverse=True)
    return min(bits[0], 60.0), min(sum(bits), 200.0) ** 0.5


def score_text(model: Model, text: str) -> tuple[float, list[tuple[float, int, int]]]:
    words = tokens(text)
    found = segments(model, words)
    best, every = evidence(model, found, len(words))
    a, b, c = model.weight
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, a + b * best + c * every)))), found


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic", sample: int = 20_000, least_docs: int = 3, prior: float = 5.0) -> Model:
    """Fit on at most ``sample`` labelled documents, chosen by a hash of the id, and keep
    all their tokens and stems with clear log-odds (over 1.25 sqrt(ln n) standard errors
    for n documents, as noise grows with their number).
    Rows with a null key, label or text are left out; with one class only, the scores are
    flat."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()) \
        .groupBy(key).agg(F.max(label).alias("_y"))
    picked = sample_ids(known, key, sample)
    rows = materialize(docs.where(F.col(text).isNotNull()).select(key, text)
                       .join(F.broadcast(picked), key).select("_y", text), "toxic-sample")
    sizes = {r["_y"]: r["count"] for r in rows.groupBy("_y").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    model = Model()
    if not n1 or not n0:
        share = n1 / max(1, n0 + n1)
        model.weight = (math.log((share + .01) / (1.01 - share)), 0.0, 0.0)
        return model

    def count(cols):
        seen = [Counter(), Counter()]
        for y, t in zip(cols["_y"], cols[text]):
            words = set(tokens(t))
            seen[y].update(words)
            seen[y].update({stem(w) for w in words if len(w) > STEM})
        words = list(seen[0].keys() | seen[1].keys())
        return {"w": words, "c0": [seen[0][w] for w in words], "c1": [seen[1][w] for w in words]}

    counts = map_rows(rows, count, "w string, c0 long, c1 long", rows=2048).groupBy("w").agg(
        F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).where(F.col("c0") + F.col("c1") >= least_docs)
    share = (F.col("c0") + F.col("c1") + 0.5) / (n0 + n1 + 1.0)
    a1, a0 = F.col("c1") + 1 + prior * share, F.col("c0") + 1 + prior * share
    odds = F.log(a1 / (n1 + prior + 2 - a1)) - F.log(a0 / (n0 + prior + 2 - a0))
    table = (counts.select("w", odds.alias("s"), (odds / F.sqrt(1 / a1 + 1 / a0)).alias("z"))
             .where(F.abs("z") > 1.25 * math.sqrt(math.log(n0 + n1))).select("w", "s").collect())
    model.score = {r["w"]: max(-2.0, min(6.0, r["s"])) for r in table}

    def measure(cols):
        out = {"y": cols["_y"], "n": [], "best": []}
        for t in cols[text]:
            words = tokens(t)
            out["n"].append(len(words))
            out["best"].append(max((s for s, _, _ in segments(model, words)), default=0.0))
        return out

    seen = map_rows(rows, measure, "y int, n long, best double").collect()
    clean = [(r["n"], r["best"]) for r in seen if r["y"] == 0 and r["n"] > 1]
    best = np.array([b for _, b in clean if b > 0])
    if len(best) > 20:      # Gumbel moments of the best segment in clean text that has one
        model.decay = float(np.clip(math.pi / math.sqrt(6 * max(best.var(), 1e-3)), .2, 3))
        model.log_k = float(model.decay * best.mean() - 0.5772
                            - np.mean([math.log(n) for n, b in clean if b > 0]))

    def weigh(cols):            # under the law just fitted
        got = [evidence(model, segments(model, words), len(words)) for words in map(tokens, cols[text])]
        return {"y": cols["_y"], "best": [a for a, _ in got], "every": [b for _, b in got]}

    seen = map_rows(rows, weigh, "y int, best double, every double").collect()
    x = np.array([[1.0, r["best"], r["every"]] for r in seen])
    model.weight = logistic(x, np.array([r["y"] for r in seen], float))
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Ridge logistic regression by damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * np.r_[0, w[1:]]
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
          threshold: float = 0.7) -> DataFrame:
    """One row per input row: key, score (0 to 1), predicted (1 if score >= threshold) and
    passages, the significant segments as (first token, end token, score).

    A null or empty text has no segment and gets the lowest score. Null keys and
    repeated rows are scored each on its own; other columns are ignored."""
    kind = docs.schema[key].dataType.simpleString()

    def run(cols):
        out = {key: cols[key], "score": [], "predicted": [], "passages": []}
        for t in cols[text]:
            p, found = score_text(model, t or "")
            out["score"].append(p)
            out["predicted"].append(int(p >= threshold))
            out["passages"].append([{"first": a, "end": b, "score": s} for s, a, b in found
                                    if model.decay * s > 3])
        return out

    return map_rows(docs.select(key, text), run,
                    f"`{key}` {kind}, score double, predicted int, "
                    "passages array<struct<first:int,end:int,score:double>>")
