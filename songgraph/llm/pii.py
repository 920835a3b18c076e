"""Personal data: fixed patterns plus a character-level bidirectional LSTM with CRF
transitions, trained in numpy from labelled spans.

The patterns give the base spans. The model reads a text in overlapping windows of
characters; each window is decoded by Viterbi over start / inside tags, and where
windows overlap a tag comes from the window in which the character is farthest from an
edge, so the result is one labelling of the whole text. A span of any of the four kinds
holds a digit or an at sign, so the decoder allows spans only around such characters;
a window without one can only decode to "nothing" and is not computed. Spans of the
model that meet no base span are added; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songgraph.llm.common import map_rows, thin

KINDS = ("email", "ip", "card", "phone")

# The base patterns. The look-behinds and possessive runs only save
# repeated attempts inside a run of the same characters; they match the same spans.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, leftmost and non-overlapping per kind, ordered by
    start and then kind. Offsets are code points, the end exclusive."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > floor and text[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append((lo, 0, m.end()))
            floor = m.end()
        at = text.find("@", max(at + 1, floor))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(KINDS[k], a, b) for a, k, b in sorted(out)]


# -- the tagger -------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)          # nothing, then start and inside of each kind
WINDOW, EDGE, REACH = 96, 24, 24   # characters of a window, of its margins, around a digit


def char_ids(text: str) -> np.ndarray:
    """A small alphabet: ASCII characters by themselves (letters folded to lower case,
    digits to one symbol), every other character by one symbol."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    codes = np.where(codes < 128, codes, 127).astype(np.int64)
    codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    return np.where((codes >= 48) & (codes <= 57), 48, codes)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Tagger:
    def __init__(self, hidden: int = 24, embed: int = 12, seed: int = 7):
        r = np.random.default_rng(seed)
        self.h, n = hidden, hidden
        self.p = {"E": r.normal(0, .3, (128, embed)), "O": r.normal(0, .2, (2 * n, TAGS)),
                  "o": np.zeros(TAGS), "T": np.zeros((TAGS, TAGS))}
        for d in "fb":
            self.p["W" + d] = r.normal(0, 1 / np.sqrt(embed + n), (embed + n, 4 * n))
            self.p["c" + d] = np.r_[np.ones(n), np.zeros(3 * n)]    # open forget gates
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.allowed = np.zeros((TAGS, TAGS), np.float32)           # inside follows its kind
        for k in range(len(KINDS)):
            for a in range(TAGS):
                if a not in (1 + 2 * k, 2 + 2 * k):
                    self.allowed[a, 2 + 2 * k] = -1e4

    def _lstm(self, x, d, keep=None):
        """x: (steps, batch, embed) -> (steps, batch, hidden)."""
        steps, batch, e = x.shape
        W, c0, n = self.p["W" + d], self.p["c" + d], self.h
        pre = x.reshape(-1, e) @ W[:e] + c0
        pre = pre.reshape(steps, batch, 4 * n)
        h, c, out = np.zeros((batch, n), np.float32), np.zeros((batch, n), np.float32), []
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            z = pre[t] + h @ W[e:]
            g = _sigmoid(z[:, :3 * n])
            f, i, o, u = g[:, :n], g[:, n:2 * n], g[:, 2 * n:], np.tanh(z[:, 3 * n:])
            before, past = c, h
            c = f * c + i * u
            tc = np.tanh(c)
            h = o * tc
            out.append(h)
            if keep is not None:
                keep.append((t, f, i, o, u, before, past, tc))
        return np.stack(out if d == "f" else out[::-1])

    def scores(self, ids):
        """(steps, batch) -> (steps, batch, TAGS)."""
        x = self.p["E"][ids]
        y = np.concatenate([self._lstm(x, "f"), self._lstm(x, "b")], 2)
        return y @ self.p["O"] + self.p["o"]

    def decode(self, ids, lengths, near):
        """Viterbi tags; ``near`` marks the characters where a span may be."""
        s = self.scores(ids)
        s = s + np.where(near[..., None] | (np.arange(TAGS) == 0), 0, -1e4)
        T = self.p["T"] + self.allowed
        steps, batch, _ = s.shape
        v = s[0] + np.where((np.arange(TAGS) > 0) & (np.arange(TAGS) % 2 == 0), -1e4, 0)
        back = np.zeros((steps, batch, TAGS), np.int8)
        for t in range(1, steps):
            all_ = v[:, :, None] + T
            back[t] = all_.argmax(1)
            new = all_.max(1) + s[t]
            v = np.where((t < lengths)[:, None], new, v)
            back[t][t >= lengths] = np.arange(TAGS)
        tag = v.argmax(1)
        out = np.zeros((steps, batch), np.int8)
        for t in range(steps - 1, -1, -1):
            out[t] = tag
            tag = back[t][np.arange(batch), tag]
        return np.where(np.arange(steps)[:, None] < lengths, out, 0)

    def step(self, ids, tags):
        """Loss and gradients of one batch of equal-length windows: CRF forward-backward
        on top, back-propagation through both directions below."""
        p, n = self.p, self.h
        steps, batch = ids.shape
        x, kf, kb = p["E"][ids], [], []
        y = np.concatenate([self._lstm(x, "f", kf), self._lstm(x, "b", kb)], 2)
        s = (y @ p["O"] + p["o"]).astype(np.float64)
        T = (p["T"] + self.allowed).astype(np.float64)
        lse = lambda a, ax: np.log(np.exp(a - a.max(ax, keepdims=True)).sum(ax)) + a.max(ax)
        al, be = [s[0]], [np.zeros((batch, TAGS))]
        for t in range(1, steps):
            al.append(lse(al[-1][:, :, None] + T, 1) + s[t])
        for t in range(steps - 1, 0, -1):
            be.append(lse(T[None] + (s[t] + be[-1])[:, None, :], 2))
        be = be[::-1]
        z = lse(al[-1], 1)
        ds = np.stack([np.exp(a + b - z[:, None]) for a, b in zip(al, be)])
        g = {k: np.zeros_like(v) for k, v in p.items()}
        loss = z.sum()
        rows = np.arange(batch)
        for t in range(steps):
            loss -= s[t][rows, tags[t]].sum()
            ds[t][rows, tags[t]] -= 1
            if t:
                pair = np.exp(al[t - 1][:, :, None] + T + (s[t] + be[t])[:, None, :]
                              - z[:, None, None]).sum(0)
                np.add.at(pair, (tags[t - 1], tags[t]), -1)
                g["T"] += pair
                loss -= T[tags[t - 1], tags[t]].sum()
        ds = ds.astype(np.float32)
        g["O"] = np.einsum("tbi,tbj->ij", y, ds)
        g["o"] = ds.sum((0, 1))
        dy, dx = ds @ p["O"].T, np.zeros_like(x)
        e = x.shape[2]
        for d, keep, part in (("f", kf, dy[:, :, :n]), ("b", kb, dy[:, :, n:])):
            W = p["W" + d]
            dh, dc = np.zeros((batch, n), np.float32), np.zeros((batch, n), np.float32)
            for t, f, i, o, u, before, past, tc in reversed(keep):
                dh = dh + part[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * before * f * (1 - f), dc * u * i * (1 - i),
                                     dh * tc * o * (1 - o), dc * i * (1 - u * u)], 1)
                g["W" + d] += np.concatenate([x[t], past], 1).T @ dz
                g["c" + d] += dz.sum(0)
                back = dz @ W.T
                dx[t] += back[:, :e]
                dh, dc = back[:, e:], dc * f
        np.add.at(g["E"], ids.reshape(-1), dx.reshape(-1, e))
        return loss / (steps * batch), {k: v / batch for k, v in g.items()}

    def fit(self, ids, tags, rounds: int = 240, batch: int = 64, rate: float = 0.01, seed: int = 3):
        """Adam over random batches; ``ids`` and ``tags`` are (windows, WINDOW)."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for t in range(1, rounds + 1):
            pick = r.integers(0, len(ids), min(batch, len(ids)))
            loss, g = self.step(ids[pick].T, tags[pick].T)
            losses.append(loss)
            now = rate * (1 - 0.9 * t / rounds)
            for k in self.p:
                step = np.clip(g[k], -5, 5)
                m[k] = .9 * m[k] + .1 * step
                q[k] = .999 * q[k] + .001 * step * step
                self.p[k] -= (now * (m[k] / (1 - .9 ** t))
                              / (np.sqrt(q[k] / (1 - .999 ** t)) + 1e-8)).astype(np.float32)
        return losses


def windows(text: str, ids: np.ndarray):
    """Starts of the overlapping windows that hold a digit or at sign near their core,
    and the mask of characters where a span may be."""
    seeds = np.flatnonzero((ids == 48) | (ids == 64))
    if not len(seeds):
        return [], None
    near = np.zeros(len(ids) + 1, np.int32)
    np.add.at(near, np.maximum(seeds - REACH, 0), 1)
    np.add.at(near, np.minimum(seeds + REACH + 1, len(ids)), -1)
    near = np.cumsum(near[:-1]) > 0
    stride = WINDOW - 2 * EDGE
    cores = np.unique(np.flatnonzero(near) // stride)
    return [int(c) * stride - EDGE for c in cores], near


def model_spans(texts: list[str], tagger: Tagger, batch: int = 256) -> list[list[tuple]]:
    """Spans of the tagger for each text, windows decoded in batches and reconciled:
    a character's tag comes from the window whose core holds it."""
    jobs, tags, ids = [], {}, []
    for n, t in enumerate(texts):
        x = char_ids(t)
        ids.append(x)
        starts, near = windows(t, x)
        if starts:
            tags[n] = (np.zeros(len(x), np.int8), near)
            jobs += [(n, s) for s in starts]
    for at in range(0, len(jobs), batch):
        part = jobs[at:at + batch]
        block = np.zeros((WINDOW, len(part)), np.int64)
        mask = np.zeros((WINDOW, len(part)), bool)
        for j, (n, s) in enumerate(part):
            lo, hi = max(0, s), min(len(ids[n]), s + WINDOW)
            block[lo - s:hi - s, j] = ids[n][lo:hi]
            mask[lo - s:hi - s, j] = tags[n][1][lo:hi]
        got = tagger.decode(block, np.full(len(part), WINDOW), mask)
        for j, (n, s) in enumerate(part):
            lo, hi = max(0, s + EDGE), min(len(ids[n]), s + WINDOW - EDGE)
            tags[n][0][lo:hi] = got[lo - s:hi - s, j]
    out = []
    for n, t in enumerate(texts):
        spans = []
        if n in tags:
            tag = tags[n][0]
            inside = np.flatnonzero(tag)
            i = 0
            while i < len(inside):
                a = int(inside[i])
                kind = (int(tag[a]) - 1) // 2
                b = a + 1
                i += 1
                while i < len(inside) and inside[i] == b and tag[b] == 2 + 2 * kind:
                    b, i = b + 1, i + 1
                if plausible(t[a:b], KINDS[kind]):
                    spans.append((KINDS[kind], a, b))
        out.append(spans)
    return out


def plausible(piece: str, kind: str) -> bool:
    """The least a span of a kind must hold; decoded spans without it are dropped."""
    digits = sum(c.isdigit() for c in piece)
    if kind == "email":
        return "@" in piece and "." in piece.split("@")[-1] and piece[0] != "@"
    if kind == "ip":
        parts = piece.split(".")
        return len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        only = "".join(c for c in piece if c.isdigit())
        return 13 <= digits <= 19 and luhn(only) and all(c.isdigit() or c in " -." for c in piece)
    return 10 <= digits <= 15 and all(c.isdigit() or c in " ()+.-/" for c in piece) \
        and any(c in " ()+.-/" for c in piece)


# -- training ---------------------------------------------------------------

def examples(texts: list[str], seed: int = 11):
    """Windows with tags. Labelled spans are the base spans of the texts; half of the
    copies of a window rewrite them in other usual forms (a phone number without its
    country code, dots for blanks), which the fixed patterns do not know."""
    r = np.random.default_rng(seed)
    ids, tags = [], []

    def add(text, spans):
        x, y = char_ids(text), np.zeros(len(text), np.int64)
        for kind, a, b in spans:
            k = KINDS.index(kind)
            y[a], y[a + 1:b] = 1 + 2 * k, 2 + 2 * k
        starts, _ = windows(text, x)
        for s in starts:
            w, v = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
            lo, hi = max(0, s), min(len(x), s + WINDOW)
            w[lo - s:hi - s], v[lo - s:hi - s] = x[lo:hi], y[lo:hi]
            first = v[0]
            if first and first % 2 == 0:        # a window may begin inside a span
                v[0] = first - 1
            ids.append(w)
            tags.append(v)

    for text in texts:
        spans = []
        for span in base_spans(text):
            if not spans or span[1] >= spans[-1][2]:
                spans.append(span)
        add(text, spans)
        if not spans:
            continue
        out, at, moved = "", 0, []
        for kind, a, b in spans:
            out += text[at:a]
            piece = text[a:b]
            if kind == "phone":
                form = r.integers(3)
                bare = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", piece)
                piece = (bare, re.sub(r"[() -]+", ".", bare).strip("."),
                         re.sub(r"[() .]+", "-", bare).strip("-"))[form]
            elif kind == "card" and r.random() < .5:
                piece = ".".join(piece[i:i + 4] for i in range(0, len(piece), 4))
            elif kind == "email" and r.random() < .5:
                piece = piece.replace("@", " @ ")
            moved.append((kind, len(out), len(out) + len(piece)))
            out += piece
            at = b
        add(out + text[at:], moved)
    return (np.array(ids), np.array(tags)) if ids else (np.zeros((0, WINDOW), int),) * 2


def train(docs: DataFrame, text: str = "text", documents: int = 30_000, sample: int = 600,
          around: int = 120, rounds: int = 240) -> Tagger:
    """Fit a tagger on at most ``sample`` stretches of text around a digit or at sign, one
    per document, from about ``documents`` documents chosen by a hash of the text. Without any
    such text the tagger stays untrained; what it then finds is still held to
    ``plausible``."""
    pattern = r"(?s).{0,%d}[0-9@].{0,%d}" % (around, around)
    some = thin(docs.select(text), F.col(text), documents)
    rows = (some.where(F.col(text).rlike("[0-9@]"))
            .select(F.xxhash64(text).alias("h"), F.regexp_extract(text, pattern, 0).alias("t"))
            .orderBy("h", "t").limit(sample).collect())     # sample x 2 x around characters
    tagger = Tagger()
    ids, tags = examples([r["t"] for r in rows])
    if len(ids):
        tagger.fit(ids, tags, rounds)
    return tagger


def all_spans(base, extra):
    """Base spans plus the model's spans that meet none of them, by start and kind."""
    taken = sorted((a, b) for _, a, b in base)
    out = list(base)
    for kind, a, b in extra:
        if all(b <= x or a >= y for x, y in taken):
            out.append((kind, a, b))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, tagger: Tagger, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans (base and model, "kind:start:end" joined by commas).

    A null text counts as empty: no spans, the digest of the empty string. Null keys
    and repeated rows are kept as they are; other columns are ignored."""
    kind = docs.schema[key].dataType.simpleString()
    params = tagger.p

    def run(cols):
        model = Tagger()
        model.p = params
        texts = [t or "" for t in cols[text]]
        out = {key: cols[key], **{f"n_{k}": [] for k in KINDS}, "base_sha256": [], "spans": []}
        for t, extra in zip(texts, model_spans(texts, model)):
            base = base_spans(t)
            for k in KINDS:
                out[f"n_{k}"].append(sum(s[0] == k for s in base))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(all_spans(base, extra)))
        return out

    schema = (f"`{key}` {kind}, n_email long, n_ip long, n_card long, n_phone long, "
              "base_sha256 string, spans string")
    return map_rows(docs.select(key, text), run, schema, rows=512)


def redact(docs: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """The same rows and columns with every found span replaced by <KIND>. A null text
    stays null; overlapping spans are replaced once, under the first one's kind."""
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    params = tagger.p

    def run(cols):
        model = Tagger()
        model.p = params
        texts, done = [t or "" for t in cols[text]], []
        for given, t, extra in zip(cols[text], texts, model_spans(texts, model)):
            out, at = [], 0
            for kind, a, b in all_spans(base_spans(t), extra):
                if b <= at:
                    continue
                if a >= at:
                    out += [t[at:a], f"<{kind.upper()}>"]
                at = b
            done.append(None if given is None else "".join(out) + t[at:])
        return {n: cols[n] for n in names} | {text: done}

    return map_rows(docs, run, schema, rows=512)
