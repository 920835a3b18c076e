"""MinHash near-duplicates with sequential Bayesian verification.

1. Every document's set of distinct word shingles is hashed (64 bits a shingle).
   Documents with the same set are one class from here on, so exact copies cost one
   member each whatever their number.
2. Each class gets a signature; bands of it propose candidates. In a bucket of classes
   with an equal band each member is proposed to the bucket's least class only.
3. Candidate pairs compare their signatures batch by batch. After each batch the
   posterior of the similarity (uniform prior, binomial matches) is bounded: when the
   chance that it reaches the threshold falls below ``miss``, the pair is dropped.
4. Survivors are verified on their full shingle sets, read from the texts again.
5. Links give components. Where near copies of a text are not all similar enough to the
   least one, the members outside the main component are compared with the others in
   blocks; members of a bucket that lie farther apart run through 3 and 4 once more.
   After that every pair with an equal band is either verified, pruned or inside one
   component, so no link between components is lost (``components.cluster``).
"""

from __future__ import annotations

import math
import struct

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songgraph.llm.common import id_filter, map_rows, materialize, may_hold
from songgraph.llm.components import cluster
from songgraph.session import scratch

BANDS, ROWS, BATCH = 30, 5, 30      # a pair at similarity 0.8 shares no band with odds 7e-6
HASHES = BANDS * ROWS
_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def shingles(text: str | None, width: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a text of fewer words than the
    width is one shingle, one without words has none. Words are split at ASCII white
    space and lower-cased in A-Z only, which is what ``bytes`` do."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    n = max(1, len(h) - width + 1)
    out = np.full(n, min(width, len(h)), np.uint64)
    for k in range(min(width, len(h))):
        out = (out ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(grams: np.ndarray) -> np.ndarray:
    """Minima of HASHES multiply-shift functions (upper 32 bits)."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 512):
        low = np.minimum(low, (grams[at:at + 512, None] * _MUL + _ADD).min(0))
    return (low >> np.uint64(32)).astype("<u4")


def least_matches(threshold: float, miss: float, bits: int = 8) -> list[int]:
    """For each batch end, the number of matches below which a pair is dropped: the
    posterior chance of reaching the threshold is a binomial tail. Signature values of
    ``bits`` bits also match by chance."""
    t, out = threshold + (1 - threshold) / 2**bits, []
    for n in range(BATCH, HASHES + 1, BATCH):
        m, tail = 0, 0.0
        while m <= n:
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append(m)
    return out


def prune(pairs: DataFrame, signs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The pairs (a, b) whose signatures keep the threshold possible."""
    least = least_matches(threshold, miss)
    both = (pairs.join(signs.select(F.col("node").alias("a"), F.col("short").alias("sa")), "a")
            .join(signs.select(F.col("node").alias("b"), F.col("short").alias("sb")), "b"))

    def run(cols):
        if not cols["a"]:
            return {"a": [], "b": []}
        x = np.frombuffer(b"".join(cols["sa"]), np.uint8).reshape(-1, HASHES)
        y = np.frombuffer(b"".join(cols["sb"]), np.uint8).reshape(-1, HASHES)
        alive, match = np.arange(len(x)), np.zeros(len(x), int)
        for k, m in enumerate(least):           # only pairs still alive see the next batch
            part = slice(k * BATCH, (k + 1) * BATCH)
            match[alive] += (x[alive, part] == y[alive, part]).sum(1)
            alive = alive[match[alive] >= m]
        return {"a": [cols["a"][i] for i in alive], "b": [cols["b"][i] for i in alive]}

    return map_rows(both, run, "a long, b long", rows=4096)


def shingle_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(node, set) for the given nodes: the texts of their classes' least ids are read again
    and told apart by the digest of their sets."""
    wanted = materialize(classes.join(nodes.select("node").distinct(), "node", "left_semi"), "wanted-sets")
    bits = id_filter(wanted, "least")

    def grams(cols):
        out = {"same": [], "set": []}
        for i in np.flatnonzero(may_hold(bits, cols[key])):
            g = shingles(cols[text][i], width).tobytes()
            if g:
                out["same"].append(xxhash.xxh3_128_digest(g))
                out["set"].append(g)
        return out

    sets = map_rows(docs.select(key, text), grams, "same binary, set binary")
    return materialize(sets.join(wanted, "same").select("node", "set").dropDuplicates(["node"]), "shingle-sets")


def alike(shared, x: int, y: int, percent: int):
    return 100 * shared >= percent * (x + y - shared)


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, width: int,
           percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity. ``pairs`` is a written
    table. Sets come from the texts of the pairs' documents only."""
    wanted = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "wanted")
    sets = shingle_sets(wanted, classes, docs, key, text, width)
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b"))

    def run(cols):
        out = {"a": [], "b": []}
        for a, b, x, y in zip(cols["a"], cols["b"], cols["sa"], cols["sb"]):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if alike(min(len(x), len(y)), len(x), len(y), percent) \
                    and alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent):
                out["a"].append(a)
                out["b"].append(b)
        return out

    return map_rows(both, run, "a long, b long")


def compare_crowds(members: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, width: int,
                   percent: int, block: int = 256) -> DataFrame:
    """Links between the components of a crowd. ``members``: (node, crowd, part). Every
    member outside the crowd's largest component meets every member of another one, in
    blocks of about ``block`` by ``block``: a task holds one pair of blocks, and only links are
    emitted, one for a member and a component."""
    sizes = members.groupBy("crowd", "part").agg(F.count("*").alias("n"))
    crowds = (sizes.groupBy("crowd").agg(F.sum("n").alias("all"), F.count("*").alias("parts"),
                                         F.max(F.struct("n", "part"))["part"].alias("main"),
                                         F.max("n").alias("most")).where("parts > 1"))
    mine = materialize(members.join(crowds, "crowd"), "crowd-members")
    sets = shingle_sets(mine, classes, docs, key, text, width)
    rows = mine.join(sets, "node")
    slots = F.ceil(F.col("all") / block).cast("int")
    probes = F.ceil((F.col("all") - F.col("most")) / block).cast("int")
    at = F.xxhash64("node")
    left = rows.where("part <> main").select(
        "crowd", F.pmod(at, probes).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), slots - 1)).alias("j"),
        "node", "part", "set", F.lit(True).alias("probe"), F.lit(False).alias("big"))
    right = rows.select(
        "crowd", F.explode(F.sequence(F.lit(0), probes - 1)).alias("i"), F.pmod(at, slots).cast("int").alias("j"),
        "node", "part", "set", F.lit(False).alias("probe"), (F.col("part") == F.col("main")).alias("big"))

    def compare(group):
        import pyarrow as pa
        cols = group.to_pydict()
        sets = [np.frombuffer(s, np.uint64) for s in cols["set"]]
        sizes = np.array([len(s) for s in sets])
        ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
        starts = np.r_[0, np.cumsum(sizes)]
        probe, big = np.array(cols["probe"]), np.array(cols["big"])
        node, part = np.array(cols["node"]), np.array(cols["part"])
        rest = np.flatnonzero(~probe)
        a, b = [], []
        if len(rest):
            flat = np.concatenate([ids[starts[r]:starts[r + 1]] for r in rest])
            heads = np.r_[0, np.cumsum(sizes[rest])[:-1]]
            flag = np.zeros(ids.max() + 1, np.int32)
            for p in np.flatnonzero(probe):
                own = ids[starts[p]:starts[p + 1]]
                flag[own] = 1
                shared = np.add.reduceat(flag[flat], heads)
                flag[own] = 0
                hit = (100 * shared >= percent * (sizes[rest] + sizes[p] - shared)) & (part[rest] != part[p]) \
                    & (big[rest] | (node[p] < node[rest]))
                for r in rest[hit][np.unique(part[rest[hit]], return_index=True)[1]]:
                    a.append(int(min(node[p], node[r])))
                    b.append(int(max(node[p], node[r])))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return left.union(right).groupBy("crowd", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 2,
                    percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """One row per input row: key, n_shingles, component_id (least id reachable over
    links of similarity >= percent / 100), kept (the id is its component's).

    A node is a distinct shingle set, known by its 128-bit digest; ids are joined to nodes
    at the end, so each text of an id given to several is pruned and verified by itself.
    Texts without words (null, empty, blank) link with nothing. Rows sharing an id are
    one document: their components are joined. Rows with a null id are not linked and
    get a null component and kept = false. Other columns are ignored; an empty table
    gives an empty result. ``docs`` is read twice; the id must be an integer. The result is
    a written table."""
    docs = docs.select(F.col(key).cast("long").alias(key), text)

    def sign(cols):
        out = {key: cols[key], "n_shingles": [], "same": [], "sign": []}
        for t in cols[text]:
            g = shingles(t, width)
            out["n_shingles"].append(len(g))
            out["same"].append(xxhash.xxh3_128_digest(g.tobytes()) if len(g) else None)
            out["sign"].append(signature(g).tobytes() if len(g) else None)
        return out

    def shorten(cols):
        band = struct.Struct("<" + "q" * BANDS)
        out = {"node": cols["node"], "bands": [], "short": [], "sketch": []}
        for s in cols["sign"]:
            v = np.frombuffer(s, "<u4").reshape(BANDS, ROWS)
            out["bands"].append(list(band.unpack(b"".join(
                xxhash.xxh3_64_digest(bytes([i]) + v[i].tobytes()) for i in range(BANDS)))))
            # values of a batch come from all bands, so that batches are alike
            low = v.T.reshape(-1).astype(np.uint8)
            out["short"].append(low.tobytes())
            out["sketch"].append(np.packbits(np.pad(low & 1, (0, -HASHES % 64))).view(np.int64).tolist())
        return out

    differ = HASHES - least_matches(percent / 100, miss, bits=1)[-1]

    def near(x, y):         # the last test of the sequence on one-bit signatures, inside the join
        return sum(F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(-(-HASHES // 64))) <= differ

    with scratch(docs.sparkSession) as own:
        rows = materialize(map_rows(docs, sign, f"`{key}` long, n_shingles long, same binary, sign binary"),
                           "signatures")
        known = rows.where(F.col("same").isNotNull() & F.col(key).isNotNull())
        classes = materialize(known.groupBy("same").agg(F.min(key).alias("least"))
                              .withColumn("node", F.monotonically_increasing_id()), "classes")
        heads = known.select(F.col(key).alias("least"), "same", "sign").join(classes, ["least", "same"]) \
            .dropDuplicates(["node"])
        signs = materialize(map_rows(heads.select("node", "sign"), shorten,
                                     "node long, bands array<long>, short binary, sketch array<long>"),
                            "class-signatures")
        bands = signs.select("node", "sketch", F.explode("bands").alias("band"))

        # an id given to several texts joins their nodes
        each = known.select(key, "same").join(classes.select("same", "node"), "same").groupBy(key, "node").agg(F.lit(1))
        several = each.groupBy(key).agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
        same_id = several.select(key, "a").join(each, key).select("a", F.col("node").alias("b")).where("a <> b")

        labels = cluster(
            bands, lambda pairs: materialize(verify(pairs, classes, docs, key, text, width, percent), "verified"),
            lambda pairs: prune(pairs, signs.select("node", "short"), percent / 100, miss),
            lambda members: compare_crowds(members, classes, docs, key, text, width, percent),
            same_id, "sketch", near)
        found = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        heads = found.groupBy("label").agg(F.min("least").alias("component"))
        member = found.join(heads, "label").select("same", "component")
        out = rows.select(key, "n_shingles", "same").join(member, "same", "left").withColumn(
            "component_id", F.when(F.col(key).isNotNull(), F.coalesce("component", key)))
        return own.keep(out.select(key, "n_shingles", "component_id",
                                   F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)).alias("kept")),
                        "near-duplicates")
