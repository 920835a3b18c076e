"""Graph and serving-table queries.

The SQL twins unroll the three BFS levels into joins: the BFS degree of a
pair is the length of its shortest walk, so ``min(d)`` over walks of length
1..3 (root excluded) is the BFS answer, computed without any pruning.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from songgraph.operators import graph as G
from songgraph.operators import serving as S
from songgraph.plans.base import cte, register
from songgraph.session import materialize, new_folder, scratch
from songgraph.sources import adapters as A

DEPTH = 3
TOP = 10
CACHE_ROOTS = 50    # artists whose whole neighbourhoods are cached: a seeded sample


def sym_edges(spark, sf_dir):
    return G.symmetrize(A.similarity(spark, sf_dir))


def run_bfs(spark, sf_dir, roots_of, **kw):
    """BFS with the symmetric edges written once for the roots and every level."""
    with scratch(spark) as own:
        sym = G.prepare_edges(sym_edges(spark, sf_dir))
        return own.keep(G.bfs(sym, roots_of(sym), DEPTH, **kw))


def run_nearest(spark, sf_dir, roots_of, n):
    """The ``n`` nearest artists of every root, by the cut adjacency."""
    with scratch(spark) as own:
        sym = materialize(sym_edges(spark, sf_dir), "edges")
        return own.keep(G.nearest_bfs(sym, roots_of(sym), n, DEPTH))


def _all_roots(sym):
    return G.vertices(sym).select(F.col("v").alias("root"))


def _cache_roots(sym):
    """The cache job's sampled artists (SM1)."""
    return G.sample_roots(G.vertices(sym), CACHE_ROOTS)


def _first_root(sym):
    return G.first_vertex(G.vertices(sym))


_E = cte(sim=A.SQL_SIMILARITY) + """,
e AS (SELECT target AS src, "similar" AS dst FROM sim
        WHERE target IS NOT NULL AND "similar" IS NOT NULL
      UNION
      SELECT "similar" AS src, target AS dst FROM sim
        WHERE target IS NOT NULL AND "similar" IS NOT NULL)
"""

# BFS walks from a root table r(root); w_d = distinct (root, v) at walk length d
_WALKS_FROM = """,
w1 AS (SELECT DISTINCT r.root, e.dst AS v, 1 AS d FROM r JOIN e ON r.root = e.src),
w2 AS (SELECT DISTINCT w1.root, e.dst AS v, 2 AS d FROM w1 JOIN e ON w1.v = e.src),
w3 AS (SELECT DISTINCT w2.root, e.dst AS v, 3 AS d FROM w2 JOIN e ON w2.v = e.src),
bfs AS (SELECT root, v, CAST(min(d) AS INTEGER) AS degree
        FROM (SELECT * FROM w1 UNION ALL SELECT * FROM w2 UNION ALL SELECT * FROM w3)
        WHERE v <> root GROUP BY root, v)
"""

# walks as the original cache job keeps them: only the degree-1 self-loop goes
_WALK_LEVELS = """,
k1 AS (SELECT DISTINCT r.root, e.dst AS v FROM r JOIN e ON r.root = e.src WHERE e.dst <> r.root),
k2 AS (SELECT DISTINCT k1.root, e.dst AS v FROM k1 JOIN e ON k1.v = e.src),
k3 AS (SELECT DISTINCT k2.root, e.dst AS v FROM k2 JOIN e ON k2.v = e.src),
walks AS (SELECT root, v, 1 AS degree FROM k1 UNION ALL SELECT root, v, 2 FROM k2
          UNION ALL SELECT root, v, 3 FROM k3)
"""

_ALL_ROOTS = ",\nr AS (SELECT DISTINCT src AS root FROM e)\n"


def _sample_sql(n: int) -> str:
    return (f",\nr AS (SELECT root FROM (SELECT DISTINCT src AS root FROM e) "
            f"ORDER BY md5(CAST(root AS VARCHAR) || '-42'), root LIMIT {n})\n")


_CACHE_ROOTS = _sample_sql(CACHE_ROOTS)
_FIRST_ROOT = ",\nr AS (SELECT min(src) AS root FROM e)\n"


@register("edges_symmetric", _E + "SELECT src, dst FROM e")
def q_edges_symmetric(spark, sf_dir):
    """SRC3-form edge list -> ST1 ST4 AG7"""
    return sym_edges(spark, sf_dir)


@register("vertices", _E + "SELECT DISTINCT src AS v FROM e")
def q_vertices(spark, sf_dir):
    """ST5 AG7"""
    return G.vertices(sym_edges(spark, sf_dir))


@register("bfs_multi", _E + _CACHE_ROOTS + _WALKS_FROM + "SELECT root, v, degree FROM bfs")
def q_bfs_multi(spark, sf_dir):
    """GR2 JN1 JN3 JN4 AG7 FLT10 ST1 ST3: BFS to depth 3 from the sampled artists"""
    return run_bfs(spark, sf_dir, _cache_roots)


@register("bfs_single", _E + _FIRST_ROOT + _WALKS_FROM + "SELECT v, degree FROM bfs")
def q_bfs_single(spark, sf_dir):
    """GR1 JN1 JN3 FLT10: BFS from the smallest artist id"""
    return run_bfs(spark, sf_dir, _first_root).select("v", "degree")


@register("bfs_single_as_coded", _E + _FIRST_ROOT + _WALK_LEVELS + """
SELECT v, CAST(min(degree) AS INTEGER) AS degree FROM walks GROUP BY v""")
def q_bfs_single_as_coded(spark, sf_dir):
    """GR1 walk mode, AG4 AG5: the root comes back at degree 2"""
    walks = run_bfs(spark, sf_dir, _first_root, mode="walk")
    return G.min_degree(walks).select("v", "degree")


@register("bfs_walk_cache", _E + _CACHE_ROOTS + _WALK_LEVELS + "SELECT root, v, degree FROM walks")
def q_bfs_walk_cache(spark, sf_dir):
    """GR2 walk mode, ST3 as coded: a neighbour at several degrees, root inside"""
    return run_bfs(spark, sf_dir, _cache_roots, mode="walk")


@register("nearest_n", _E + _FIRST_ROOT + _WALKS_FROM + f"""
SELECT v, degree, CAST(row_number() OVER (ORDER BY degree, v) AS INTEGER) AS rank
FROM bfs QUALIFY rank <= {TOP}""")
def q_nearest_n(spark, sf_dir):
    """TK5 SM2 (id tie-break): the 10 nearest artists of one artist"""
    return run_nearest(spark, sf_dir, _first_root, TOP).select("v", "degree", "rank")


@register("nearest_n_hash", _E + _FIRST_ROOT + _WALKS_FROM + f"""
SELECT v, degree, CAST(row_number() OVER (
  ORDER BY degree, md5(CAST(v AS VARCHAR) || '-42'), v) AS INTEGER) AS rank
FROM bfs QUALIFY rank <= {TOP}""")
def q_nearest_n_hash(spark, sf_dir):
    """TK5 SM2: as nearest_n, equal degrees in seeded random order"""
    paths = run_bfs(spark, sf_dir, _first_root)
    return G.nearest(paths, TOP, tie="hash").select("v", "degree", "rank")


@register("bfs_sample", _E + _sample_sql(5) + _WALKS_FROM + "SELECT root, v, degree FROM bfs")
def q_bfs_sample(spark, sf_dir):
    """SM1 JN4 GR2: BFS from 5 artists picked by a seeded hash"""
    return run_bfs(spark, sf_dir, lambda sym: G.sample_roots(G.vertices(sym), 5))


_TOPK = _E + _ALL_ROOTS + _WALKS_FROM + f""",
topk AS (SELECT root, v, degree,
           CAST(row_number() OVER (PARTITION BY root ORDER BY degree, v) AS INTEGER) AS rank
         FROM bfs QUALIFY rank <= {TOP})
"""


@register("cache_top_k", _TOPK + "SELECT root, v, degree, rank FROM topk")
def q_cache_top_k(spark, sf_dir):
    """WN1 AG6: first 10 cached neighbours per artist, ordered (degree, id)"""
    return run_nearest(spark, sf_dir, _all_roots, TOP)


_ENTRIES = _E + _CACHE_ROOTS + _WALKS_FROM + """,
entries AS (SELECT root, v, degree,
              row_number() OVER (PARTITION BY root ORDER BY degree, v) AS pos FROM bfs)
"""


@register("cache_json", _ENTRIES + f"""
SELECT 'artist:' || CAST(root AS VARCHAR) || ':recs' AS "key",
  CAST((pos - 1) // {S.CHUNK} AS INTEGER) AS chunk_no,
  '[' || string_agg('[' || CAST(v AS VARCHAR) || ',' || CAST(degree AS VARCHAR) || ']', ','
                    ORDER BY degree, v) || ']' AS recs_json
FROM entries GROUP BY root, (pos - 1) // {S.CHUNK}""")
def q_cache_json(spark, sf_dir):
    """SC12 SC14 AG6: the whole cache value, JSON [[id, degree], ...] in chunks"""
    return S.recs_json(run_bfs(spark, sf_dir, _cache_roots))


@register("cache_json_roundtrip", _ENTRIES + """
SELECT 'artist:' || CAST(root AS VARCHAR) || ':recs' AS "key", CAST(pos AS INTEGER) AS pos,
       v, CAST(degree AS BIGINT) AS degree FROM entries""")
def q_cache_json_roundtrip(spark, sf_dir):
    """SC13: the JSON chunks decoded back into rows"""
    return S.parse_recs(S.recs_json(run_bfs(spark, sf_dir, _cache_roots)))


@register("cache_dump", _E + _CACHE_ROOTS + _WALKS_FROM + """
SELECT 'artist:' || CAST(root AS VARCHAR) || ':recs' AS "key",
       CAST(root AS VARCHAR) AS artist, v, degree FROM bfs""")
def q_cache_dump(spark, sf_dir):
    """SNK3 SRC10 SC14: write the serving table (overwrite, bucketed by
    artist), read it back, list every key with its entries"""
    path = new_folder(spark, "serving")
    with scratch(spark):
        S.write_serving_table(run_bfs(spark, sf_dir, _cache_roots), path)
    return S.dump(S.read_serving_table(spark, path))


@register("cache_lookup", _E + cte(req=A.SQL_REQUESTS).replace("WITH ", ",\n", 1) + """,
r AS (SELECT DISTINCT artist_id AS root FROM req WHERE artist_id IS NOT NULL)
""" + _WALKS_FROM + f""",
topk AS (SELECT root, v, degree,
           CAST(row_number() OVER (PARTITION BY root ORDER BY degree, v) AS INTEGER) AS rank
         FROM bfs)
SELECT req.req_id, topk.v, topk.degree, topk.rank
FROM req JOIN topk ON req.artist_id = topk.root
WHERE topk.rank <= req.top_k""")
def q_cache_lookup(spark, sf_dir):
    """SRC9 SC10 WN1 JN4: artist-anchored requests read their first top_k
    cached neighbours; BFS roots are the requested artists only"""
    req = A.requests(spark, sf_dir).where(F.col("artist_id").isNotNull())
    n = req.agg(F.max("top_k")).first()[0] or 1
    path = new_folder(spark, "serving")
    with scratch(spark):
        S.write_serving_table(run_nearest(spark, sf_dir, lambda sym: req.select(F.col("artist_id").alias("root")), n),
                              path)
    return S.lookup_many(S.read_serving_table(spark, path), req)
