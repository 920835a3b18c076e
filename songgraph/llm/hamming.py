"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

Vectors are normalised and centred, those of each width on their own. Several starts each
learn a rotation that makes the signs of the rotated coordinates good and balanced binary
codes (iterative quantisation), so a vector gets a 64-bit code a start. The codes are cut
into substrings, one hash table each; two vectors that agree in a whole substring are
candidates, those whose first codes differ in few bits are compared on the original
vectors in double precision. Equal vectors are one class, so a vector repeated in a third
of all rows is indexed once.

Centring widens the angle of a linked pair where vectors share an offset, so the number of
tables, the length of a substring and the bits that may differ are chosen by the recall
measured on pairs at the threshold made from the sample, and on the sample's own links.
Where no choice reaches RECALL, all vectors of the width are compared.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songgraph.llm.common import map_rows, materialize
from songgraph.llm.components import components

STARTS, BITS = 3, 64        # starts at least, whose codes are compared
PARTS, MOST = (16, 8), 48   # lengths of the substrings, and starts at most
RECALL, DEVIATIONS = 0.9, 3.9


def usable(vector) -> np.ndarray | None:
    """The vector in double precision, or None if it is null, zero or not finite."""
    if vector is None or any(v is None for v in vector):
        return None
    v = np.array(vector, np.float64)
    return v if len(v) and np.isfinite(v).all() and v.any() else None


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()
    return v / np.sqrt((v * v).sum())


def rotation(x: np.ndarray, seed: int, rounds: int = 40) -> np.ndarray:
    """(dimensions, BITS) by iterative quantisation of the centred sample ``x``."""
    r = np.random.default_rng(seed)
    d = x.shape[1]
    if d < BITS:            # fewer dimensions than bits: a random frame on top of them
        x = x @ np.linalg.qr(r.normal(size=(BITS, d)))[0].T
    basis = np.eye(x.shape[1])
    if x.shape[1] > BITS:
        basis = np.linalg.eigh(x.T @ x)[1][:, -BITS:]
    v = x @ basis
    rot = np.linalg.qr(r.normal(size=(BITS, BITS)))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ rot >= 0, 1.0, -1.0).T @ v)
        rot = w.T @ u.T
    frame = np.linalg.qr(np.random.default_rng(seed).normal(size=(BITS, d)))[0].T if d < BITS else basis
    return frame @ rot


class Model(NamedTuple):
    mean: np.ndarray
    rots: list[np.ndarray]
    part: int           # bits of a substring; 0: all vectors in one table
    far: int            # bits of the first STARTS codes a linked pair may differ in


def learn(vectors: DataFrame, column: str, least: float, sample: int = 4000) -> dict[int, Model]:
    """A model for each width, from at most ``sample`` distinct vectors of it, chosen by hash."""
    rows = (vectors.select(F.col(column).alias("v")).where(F.size("v") > 0)
            .withColumn("h", F.xxhash64("v")).groupBy("h").agg(F.first("v").alias("v")))
    out = {}
    for (width,) in rows.select(F.size("v")).distinct().collect():
        some = rows.where(F.size("v") == width).orderBy("h").limit(sample).collect()
        good = [unit(x) for x in (usable(r["v"]) for r in some) if x is not None]
        # where the sample holds no usable vector, others of that width are all compared
        out[width] = fit(np.array(good), least) if good else Model(np.zeros(width), [], 0, STARTS * BITS)
    return out


def near_pairs(x: np.ndarray, least: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Kinds of linked pairs: those of the sample, and vectors at the threshold made from it,
    moved in the direction of another one and in any direction."""
    r, n = np.random.default_rng(1), len(x)
    a, b = [], []
    for at in range(0, n, 256):
        i, j = np.nonzero(x[at:at + 256] @ x.T >= least)
        pick = np.flatnonzero(i + at < j)[:1000]
        a.append(x[i[pick] + at])
        b.append(x[j[pick]])
    kinds = [(np.concatenate(a), np.concatenate(b))]
    for z in (x[r.permutation(n)] - x.mean(0), r.normal(size=x.shape)):
        z = z - (z * x).sum(1, keepdims=True) * x
        size = np.sqrt((z * z).sum(1))
        ok = size > 1e-9
        kinds.append((x[ok], least * x[ok] + np.sqrt(1 - least * least) * z[ok] / size[ok, None]))
    return [k for k in kinds if len(k[0]) >= 30]


def fit(x: np.ndarray, least: float) -> Model:
    mean = x.mean(0)
    kinds = near_pairs(x, least)
    every = Model(mean, [], 0, STARTS * BITS)
    if not kinds:
        return every            # a handful of vectors
    rots = [rotation(x - mean, seed) for seed in range(STARTS)]
    pairs = [tuple(codes(v, mean, rots) for v in k) for k in kinds]
    differ = [np.bitwise_count(a ^ b).sum(1) for a, b in pairs]
    far = max(int(np.ceil(d.mean() + DEVIATIONS * d.std())) for d in differ)
    close = [d <= far for d in differ]
    for part in PARTS:
        hit = [np.zeros(len(d), bool) for d in differ]
        for n in range(MOST):
            if n == len(rots):
                rots.append(rotation(x - mean, n, 8))
            for k, (v, w) in enumerate(kinds):
                a, b = (codes(y, mean, rots[n:n + 1]).view(f"u{part // 8}") for y in (v, w))
                hit[k] |= (a == b).any(1)
            if n + 1 >= STARTS and min((h & c).mean() for h, c in zip(hit, close)) >= RECALL:
                return Model(mean, rots[:n + 1], part, far)
    return every


def codes(x: np.ndarray, mean: np.ndarray, rots: list[np.ndarray]) -> np.ndarray:
    """64-bit codes of unit vectors, one a rotation."""
    return np.stack([np.packbits((x - mean) @ r >= 0, axis=1).view(np.uint64).reshape(-1) for r in rots], 1)


def places(x: np.ndarray, model: Model) -> tuple[list[list[int]], list[list[int]]]:
    """The first codes of unit vectors and the keys of their places in the tables: width,
    table and substring."""
    width = x.shape[1] << 32
    if not model.part:
        return [[0] * STARTS] * len(x), [[width]] * len(x)
    c = codes(x, model.mean, model.rots)
    parts = c.view(f"u{model.part // 8}").astype(np.int64)
    return c[:, :STARTS].view(np.int64).tolist(), (parts + (np.arange(parts.shape[1]) << 16) + width).tolist()


def near_duplicates(vectors: DataFrame, key: str = "vec_id", column: str = "embedding",
                    least: float = 0.95) -> DataFrame:
    """One row per input row: key, n_links (other vectors linked directly), component_id
    (least id reachable, itself included), kept (id = component_id).

    Vectors that are null, zero, or hold null or non-finite components link with
    nothing; vectors of different widths are not linked. Equal vectors are linked. Rows
    with a null id are not linked: 0 links, a null component, kept = false. Rows sharing
    an id are separate vectors of one component. An empty table gives an empty result."""
    vectors = vectors.select(F.col(key).cast("long").alias(key), column)
    models = learn(vectors, column, least)

    def encode(cols):
        out = {key: cols[key], "same": [], "codes": [], "parts": [], "far": [], "unit": []}
        xs = [usable(v) for v in cols[column]]
        xs = [None if x is None else unit(x) for x in xs]
        found: dict[int, tuple] = {}
        for width in {len(x) for x in xs if x is not None}:
            own = [n for n, x in enumerate(xs) if x is not None and len(x) == width]
            found |= zip(own, zip(*places(np.array([xs[n] for n in own]), models[width])))
        for n, (v, x) in enumerate(zip(cols[column], xs)):
            data = None if x is None else np.array(v, np.float64).tobytes()
            out["same"].append(None if x is None else xxhash.xxh3_128_digest(data))
            out["codes"].append(None if x is None else found[n][0])
            out["parts"].append(None if x is None else found[n][1])
            out["far"].append(None if x is None else models[len(x)].far)
            out["unit"].append(None if x is None else x.tobytes())
        return out

    rows = materialize(map_rows(vectors, encode, f"`{key}` long, same binary, codes array<long>, parts array<long>, far int, unit binary",
                                rows=2048), "codes")
    known = rows.where(F.col("same").isNotNull() & F.col(key).isNotNull())
    classes = materialize(known.groupBy("same").agg(
        F.min(key).alias("node"), F.count("*").alias("many"), F.first("codes").alias("codes"),
        F.first("parts").alias("parts"), F.first("far").alias("far"),
        F.first("unit").alias("unit")), "classes")

    parts = materialize(classes.select("same", "codes", "far", F.explode("parts").alias("part")), "tables")
    one, two = parts.alias("x"), parts.alias("y")
    differ = sum((F.bit_count(F.col("x.codes")[i].bitwiseXOR(F.col("y.codes")[i])) for i in range(STARTS)), F.lit(0))
    pairs = (one.join(two, (F.col("x.part") == F.col("y.part")) & (F.col("x.same") < F.col("y.same"))
                      & (differ <= F.col("x.far")))
             .select(F.col("x.same").alias("a"), F.col("y.same").alias("b")).distinct())
    both = (pairs.join(classes.select(F.col("same").alias("a"), F.col("unit").alias("ua"),
                                      F.col("node").alias("na"), F.col("many").alias("ma")), "a")
            .join(classes.select(F.col("same").alias("b"), F.col("unit").alias("ub"),
                                 F.col("node").alias("nb"), F.col("many").alias("mb")), "b"))

    def rerank(cols):
        names = ("a", "b", "na", "nb", "ma", "mb")
        if not cols["a"]:
            return {n: [] for n in names}
        cosine = np.empty(len(cols["a"]))
        sizes = np.array(list(map(len, cols["ua"])))
        for size in set(sizes.tolist()):
            at = np.flatnonzero(sizes == size)
            x, y = (np.frombuffer(b"".join(cols[c][i] for i in at)).reshape(len(at), -1) for c in ("ua", "ub"))
            cosine[at] = np.einsum("ij,ij->i", x, y)
        return {n: [cols[n][i] for i in np.flatnonzero(cosine >= least)] for n in names}

    links = materialize(map_rows(both, rerank, "a binary, b binary, na long, nb long, ma long, mb long",
                                 rows=4096), "vector-links")
    near = (links.select(F.col("a").alias("same"), F.col("mb").alias("m"))
            .union(links.select("b", "ma")).groupBy("same").agg(F.sum("m").alias("near")))
    shared = known.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    same_id = known.join(shared, key).join(classes.select("same", "node"), "same") \
        .select(F.col(key).alias("na"), F.col("node").alias("nb")).where("na <> nb")
    labels = components(materialize(links.select("na", "nb").union(same_id), "links"), "na", "nb")
    per = (classes.select("same", "node", "many").join(near, "same", "left").join(labels, "node", "left")
           .select("same", F.coalesce("label", "node").alias("component"),
                   (F.col("many") - 1 + F.coalesce("near", F.lit(0))).alias("links")))
    out = rows.select(key, F.when(F.col(key).isNotNull(), F.col("same")).alias("same")).join(per, "same", "left")
    component = F.coalesce("component", key)
    return out.select(key, F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col(key) == component, F.lit(False)).alias("kept"))
