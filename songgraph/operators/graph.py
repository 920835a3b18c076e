"""Artist-similarity graph: symmetric edges, vertices, bounded multi-source BFS.

The level loop is Python control flow around DataFrame joins; each level is a
join of the frontier with the edge list, a ``distinct`` (partial aggregation
first, so duplicates die map-side), and a left-anti join that prunes pairs
already reached. Each level is checkpointed to the reliable checkpoint folder,
which cuts the lineage (the next level reads files, not the whole plan again)
and survives executor loss.

A hub (a vertex with a large share of all edges) would put its whole join
into one task. So every vertex's edges are dealt over salts in proportion to
its degree, one for each ``EDGE_BLOCK`` edges, and the join runs on
``(vertex, salt)``; frontier rows are repeated once for each salt of their
vertex. Frontier rows crowding on one vertex are left to AQE's skew join.

Pruning needs only the two previous levels: in an undirected graph a
neighbour of a level-(d-1) vertex lies at level d-2, d-1 or d, so an
anti-join with levels d-1 and d-2 removes exactly the visited pairs. The
visited set never has to be joined in full.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from songgraph.session import materialize, scratch


def symmetrize(edges: DataFrame, a: str = "target", b: str = "similar") -> DataFrame:
    """ST1, ST4, AG7: undirected edge list ``(src, dst)``, each direction once.
    Edges with a null end are dropped; self-loops are kept."""
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    fwd = e.select(F.col(a).alias("src"), F.col(b).alias("dst"))
    bwd = e.select(F.col(b).alias("src"), F.col(a).alias("dst"))
    return fwd.union(bwd).distinct()


def vertices(sym: DataFrame) -> DataFrame:
    """ST5: every vertex once. On a symmetric list the sources are all of them."""
    return sym.select(F.col("src").alias("v")).distinct()


def seeded_hash(col: str, seed: int):
    """A hash that other SQL engines have too."""
    return F.md5(F.concat(F.col(col).cast("string"), F.lit(f"-{seed}")).cast("binary"))


def _checkpoint(df: DataFrame) -> DataFrame:
    """Write a level as Parquet under the checkpoint folder and read it back:
    computed once (an eager ``Dataset.checkpoint`` runs a count and then
    recomputes the last stage to write its files), lineage cut, and later
    joins see file statistics."""
    return materialize(df, "bfs-level")


EDGE_BLOCK = 1024       # edges of one vertex that share a salt, on average


def prepare_edges(sym: DataFrame, edge_block: int = EDGE_BLOCK) -> DataFrame:
    """``(src, dst, salt, salts)``, written once and read by every level:
    ``salts`` grows with the degree of ``src``, ``salt`` is drawn from the far
    end. ``bfs`` takes such a list as it is."""
    sym = materialize(sym, "sym-edges")     # read for the degrees and for the join
    salts = sym.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / edge_block).cast("int").alias("salts"))
    return materialize(sym.join(salts, "src").select(
        "src", "dst", F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int").alias("salt"), "salts"), "edges")


def _expand(prev: DataFrame, edges: DataFrame, split: DataFrame) -> DataFrame:
    """Frontier x edges on ``(vertex, salt)``; ``split`` holds the vertices of
    more than one salt."""
    salts = F.coalesce("salts", F.lit(1))
    front = (prev.join(split, prev["v"] == split["src"], "left")
                 .select("root", "v", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")))
    ends = edges.select("src", "dst", F.col("salt").alias("_salt"))
    return (front.join(ends, (front["v"] == ends["src"]) & (front["salt"] == ends["_salt"]))
                 .select("root", F.col("dst").alias("v")))


def _levels(edges: DataFrame, roots: DataFrame, max_degree: int, mode: str,
            enough: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """The start rows and one frame per level. With ``enough``, a root that
    has reached so many vertices leaves the frontier."""
    start = (roots.select("root").where(F.col("root").isNotNull()).distinct()
                  .join(vertices(edges), F.col("root") == F.col("v"), "left_semi")
                  .select("root", F.col("root").alias("v")))
    start = _checkpoint(start)
    split = materialize(edges.where(F.col("salts") > 1).select("src", "salts").distinct(), "split")
    levels = []
    reached = None
    prev, prev2 = start, None
    for d in range(1, max_degree + 1):
        nxt = _expand(prev, edges, split).distinct()
        if mode == "bfs":
            seen = prev if prev2 is None else prev.unionByName(prev2)
            nxt = nxt.join(seen, ["root", "v"], "left_anti")
        elif d == 1:
            nxt = nxt.where(F.col("v") != F.col("root"))
        nxt = _checkpoint(nxt)
        levels.append(nxt.withColumn("degree", F.lit(d)))
        if nxt.isEmpty():
            break
        if enough is not None and d < max_degree:
            got = nxt.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
            if reached is not None:
                got = reached.unionByName(got).groupBy("root").agg(F.sum("n").alias("n"))
            reached = _checkpoint(got)              # one small row per root
            done = reached.where(F.col("n") >= enough).select("root")
            nxt = nxt.join(done, "root", "left_anti")
        prev2, prev = prev, nxt
    return start, levels


def bfs(sym: DataFrame, roots: DataFrame, max_degree: int = 3, mode: str = "bfs",
        include_root: bool = False, edge_block: int = EDGE_BLOCK) -> DataFrame:
    """GR1/GR2: bounded BFS from every row of ``roots`` (column ``root``).

    Returns ``(root, v, degree)``; ``degree`` is the hop distance (1..max).
    Roots that are not vertices of the graph give no rows (JN4 semi-join).

    ``mode="bfs"`` (default): one row per reached ``(root, v)``, root excluded.
    ``mode="walk"`` keeps the behaviour of the original cache job: at each
    level every walk end is kept (only a degree-1 self-loop back to the root
    is removed), so a vertex can appear at several degrees and the root comes
    back at degree 2.
    """
    if mode not in ("bfs", "walk"):
        raise ValueError(f"mode must be 'bfs' or 'walk', not {mode!r}")
    with scratch(sym.sparkSession) as own:
        edges = sym if "salts" in sym.columns else prepare_edges(sym, edge_block)
        start, levels = _levels(edges, roots, max_degree, mode)
        if include_root or not levels:
            root_rows = start.withColumn("degree", F.lit(0))
            levels.insert(0, root_rows if include_root else root_rows.limit(0))
        return own.keep(reduce(DataFrame.unionByName, levels), "bfs")


def nearest_bfs(sym: DataFrame, roots: DataFrame, n: int = 10, max_degree: int = 3) -> DataFrame:
    """The first ``n`` vertices by (degree, id) of every root, and no others:
    ``(root, v, degree, rank)``, the same as ``nearest(bfs(...), n)``.

    Each vertex's adjacency is cut to its first ``2n`` ids. That is exact: a
    root still in the frontier has reached fewer than ``n`` vertices, so (with
    itself) at most ``n`` of the ``2n`` ids are not new, and no id beyond them
    can enter its first ``n``; a vertex with fewer ids is not cut. So a hub
    costs a root ``2n`` rows, whatever its degree."""
    w = Window.partitionBy("src").orderBy("dst")
    cut = (sym.select("src", "dst").withColumn("_at", F.row_number().over(w))
              .where(F.col("_at") <= 2 * n)
              .select("src", "dst", F.lit(0).alias("salt"), F.lit(1).alias("salts")))
    with scratch(sym.sparkSession) as own:
        start, levels = _levels(materialize(cut, "near-edges"), roots, max_degree, "bfs", n)
        levels = levels or [start.withColumn("degree", F.lit(0)).limit(0)]
        return own.keep(nearest(reduce(DataFrame.unionByName, levels), n), "nearest")


def min_degree(paths: DataFrame) -> DataFrame:
    """AG4/AG5: shortest degree per ``(root, v)``, degree-0 rows dropped
    (FLT10). A hash aggregate with a partial step, so a vertex reached on many
    walks is combined before the shuffle."""
    return (paths.where(F.col("degree") > 0)
                 .groupBy("root", "v").agg(F.min("degree").alias("degree")))


def nearest(paths: DataFrame, n: int = 10, tie: str = "id", seed: int = 42) -> DataFrame:
    """TK5/SM2/WN1: per root the ``n`` nearest vertices, nearest degree first.

    Inside a degree the order is by id (``tie="id"``) or by a seeded hash of the
    id (``tie="hash"``, a fixed pseudo-random pick); both are the same in SQL. ``row_number() <= n`` plans as a WindowGroupLimit that keeps only
    ``n`` rows per root in every task before the shuffle, so a root that
    reaches a third of the graph still moves at most ``n`` rows per task.
    Returns ``(root, v, degree, rank)``.
    """
    order = [F.col("degree").asc(), F.col("v").asc()]
    if tie == "hash":
        order = [F.col("degree").asc(), seeded_hash("v", seed).asc(),
                 F.col("v").asc()]
    w = Window.partitionBy("root").orderBy(*order)
    return (paths.withColumn("rank", F.row_number().over(w))
                 .where(F.col("rank") <= n))


def sample_roots(verts: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """SM1: exactly ``n`` vertices (or all, if fewer), picked by a seeded hash
    of the id; the same ``n`` on every run. A top-n, so each task sends at most
    ``n`` rows."""
    return (verts.orderBy(seeded_hash("v", seed), F.col("v"))
                 .limit(n).select(F.col("v").alias("root")))


def first_vertex(verts: DataFrame) -> DataFrame:
    """The smallest vertex id as a one-row ``root`` frame (an aggregate, no
    collect)."""
    return verts.agg(F.min("v").alias("root"))
