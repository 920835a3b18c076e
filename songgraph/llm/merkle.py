"""Merkle manifest of a dataset with an inclusion proof for every row.

Rows are leaves of one binary tree per group, the groups' roots (subroots) are leaves of
a last tree. A tree is built bottom up, ``2 ** STEP`` consecutive nodes of a level at a
time, so a step shuffles what the step before left of it and no task holds a level.

Proofs come by pointer jumping. A node starts with the sibling beside it and so points
one level up; a self-join of the nodes doubles the distance of the pointers and appends
to each path the path of the ancestor reached. After round k only levels that 2^k divides
are needed, so the tables of inner nodes shrink at each round; the leaves follow with one
join a round. The node that a path leads to is looked up by (group, level, index): at
distance d each is asked for by 2^d leaves, and there are only 1 / 2^d as many of them.

H is the lower-case hex SHA-256 of its concatenated inputs, digests taken as hex text.
Everything is plain DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songgraph.llm.common import materialize
from songgraph.session import scratch

STEP = 8                    # levels built per step: blocks of 256 nodes
SPREAD = 20                 # 2^20 rows of a group share one row of its upper proof
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NONE = "array<struct<left:string,right:string>>"


def digest(*parts) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (with a column ``g``) and ``pos``, their place from 0 in their group by
    ``order``, and ``n``, the group's size; written. Rows are range-partitioned and
    numbered inside a partition from the rows before it, so no group is in one task."""
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(leaves.repartitionByRange(parts, "g", *order)
                         .withColumn("part", F.spark_partition_id()), "merkle-ranged")
    group = Window.partitionBy("g")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("g", "part").agg(F.count(F.lit(1)).alias("own")).select(
        "g", "part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("first"), F.sum("own").over(group).alias("n"))
    inside = Window.partitionBy("g", "part").orderBy(*order)
    return materialize(ranged.withColumn("at", F.row_number().over(inside) - 1).join(sizes, ["g", "part"])
                       .withColumn("pos", F.col("first") + F.col("at")).drop("part", "first", "at"), "merkle-leaves")


def _pairs(nodes: Column) -> Column:
    """The level above: H of every two consecutive nodes, a last odd one alone."""
    return F.transform(F.sequence(F.lit(0), ((F.size(nodes) - 1) / 2).cast("int")), lambda i: F.sha2(
        F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))), 256))


def built(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The trees over ``placed`` rows: written tables of blocks, one for every STEP levels,
    with the levels of a block as ``a0`` to ``a<STEP>``; and (g, root)."""
    base, steps, roots = leaves.select("g", "n", F.col("pos").alias("idx"), F.col("leaf").alias("hash")), [], None
    while True:
        rows = base.groupBy("g", F.shiftright("idx", STEP).alias("block")).agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("rows"))
        rows = rows.select("g", "block", "n", F.transform("rows", lambda x: x["hash"]).alias("a0"))
        for j in range(STEP):           # a level above exists where more than one node is left
            rows = rows.withColumn(f"a{j + 1}", F.when(F.col("n") > 1 << j, _pairs(F.col(f"a{j}"))))
        steps.append(materialize(rows, "merkle-blocks"))
        done, more = (F.col("n") <= 1 << STEP), (F.col("n") > 1 << STEP)
        top = steps[-1].where(done).select("g", F.coalesce(
            *[F.get(f"a{j}", 0) for j in range(STEP, -1, -1)]).alias("root"))
        roots = top if roots is None else roots.unionByName(top)
        if steps[-1].where(more).isEmpty():
            return steps, roots
        base = steps[-1].where(more).select("g", F.ceil(F.col("n") / (1 << STEP)).alias("n"),
                                            F.col("block").alias("idx"), F.get(f"a{STEP}", 0).alias("hash"))


def _level(steps: list[DataFrame], level: int) -> DataFrame:
    """(g, level, idx, path) of the nodes of a level that are no roots, each with the
    sibling beside it (empty strings where there is none) as its path."""
    j = level % STEP
    nodes = (steps[level // STEP].where(F.col("n") > 1 << j)
             .select("g", "block", F.col(f"a{j}").alias("a"), F.posexplode(f"a{j}").alias("at", "hash")))
    beside = F.coalesce(F.get("a", F.col("at").bitwiseXOR(F.lit(1))), F.lit(""))
    odd = F.col("at") % 2 == 1
    return nodes.select("g", F.lit(level).alias("level"), (F.shiftleft("block", STEP - j) + F.col("at")).alias("idx"),
                        F.array(F.struct(F.when(odd, beside).otherwise("").alias("left"),
                                         F.when(odd, "").otherwise(beside).alias("right"))).alias("path"))


def _jump(near: DataFrame, far: DataFrame, span: int) -> DataFrame:
    """Each path of ``near`` led on by that of the ancestor ``span`` levels up, if any."""
    ahead = far.select(F.col("g").alias("_g"), F.col("level").alias("_level"), F.col("idx").alias("_idx"),
                       F.col("path").alias("_path"))
    found = near.join(ahead, (F.col("g") == F.col("_g")) & (F.col("level") + span == F.col("_level"))
                      & (F.shiftright("idx", span) == F.col("_idx")), "left")
    return found.withColumn("path", F.concat("path", F.coalesce("_path", F.array().cast(NONE)))) \
        .drop("_g", "_level", "_idx", "_path")


def proved(leaves: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """``placed`` rows with ``path``: the siblings up to the root, nearest first."""
    height = ((leaves.agg(F.max("n")).first()[0] or 1) - 1).bit_length()
    rows = leaves.withColumn("level", F.lit(0)).withColumn("idx", F.col("pos")) \
        .withColumn("path", F.array().cast(NONE))
    if height:
        rows = _jump(rows, _level(steps, 0), 0)
    inner = None
    for level in range(1, height):
        inner = _level(steps, level) if inner is None else inner.unionByName(_level(steps, level))
    span = 1
    while span < height:
        inner = materialize(inner, "merkle-paths")
        rows = _jump(rows, inner.where(F.col("level") == span), span)
        inner = _jump(inner.where(F.col("level") % (2 * span) == 0),
                      inner.where(F.col("level") % (2 * span) == span), span)
        span *= 2
    return rows.drop("level", "idx")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang",
             claimed: dict[str, Column] | None = None, with_proof: bool = True) -> DataFrame:
    """One row per row of ``docs``: the key, leaf, subroot, root, proof_sha256,
    folded_root, verified, and ``with_proof`` the proof: the siblings as (left, right)
    pairs from the leaf's up. The result is a written table.

    A leaf is H of ``fields``. In each group leaves ascend by key (null first), equal keys
    by leaf; equal rows are leaves each of its own. A null group is a group and comes
    first. ``claimed`` gives other values for some fields, as found in a copy of the data:
    the root is folded from the leaf of those, and ``verified`` says whether it is the
    manifest's. Null and empty fields are told apart. An empty table gives no rows.
    Other columns are ignored."""
    value = {f: F.col(f"`{f}`") for f in fields}
    other = value | (claimed or {})
    with scratch(docs.sparkSession) as own:
        leaves = docs.select(
            F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("g"),
            F.col(f"`{key}`").alias("key"), digest(*[field(value[f]) for f in fields]).alias("leaf"),
            digest(*[field(other[f]) for f in fields]).alias("claimed"))
        # hashed once: the range partitioning below reads its input twice
        leaves = placed(materialize(leaves, "merkle-hashed"), ["key", "leaf"])
        steps, subroots = built(leaves)
        sizes = leaves.groupBy("g").agg(F.max("n").alias("rows"))
        tops = placed(subroots.join(sizes, "g").select(F.lit("").alias("g"), F.col("g").alias("name"), "rows",
                                                       F.col("root").alias("leaf")), ["name"])
        upper, root = built(tops)
        tops = proved(tops, upper).join(root, "g").select(
            F.col("name").alias("g"), F.col("leaf").alias("subroot"), "root", F.col("path").alias("upper"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.shiftright(F.col("rows") - 1, SPREAD))).alias("share"))
        rows = proved(leaves, steps).withColumn("share", F.shiftright("pos", SPREAD)).join(tops, ["g", "share"])
        rows = rows.withColumn("proof", F.concat("path", "upper")) \
            .withColumn("folded_root", folded(F.col("claimed"), F.col("proof")))
        siblings = F.array_join(F.transform("proof", lambda x: F.concat(x["left"], x["right"])), "")
        out = rows.select(
            F.col("key").alias(key), "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
            "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "proof")
        return own.keep(out if with_proof else out.drop("proof"), "merkle-manifest")
