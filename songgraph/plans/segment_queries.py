"""Segment-matrix statistics queries."""

from __future__ import annotations

from songgraph.operators import segments as SG
from songgraph.plans.base import cte, register
from songgraph.schema import N_DIMS, STAT_NAMES
from songgraph.session import scratch
from songgraph.sources import adapters as A

_SQL_AGG = {"mean": "avg({x})", "median": "median({x})", "min": "min({x})", "max": "max({x})",
            "std": "stddev_pop({x})", "count": "CAST(count(*) AS DOUBLE)"}


def _x(i: int) -> str:
    return f"coalesce(CAST(x{i} AS DOUBLE), 0.0)"


def _cov(i: int, j: int) -> str:
    return (f"CASE WHEN count(*) > 1 THEN covar_samp({_x(i)}, {_x(j)}) "
            f"ELSE CAST('NaN' AS DOUBLE) END")


def _stats_sql(segs_sql: str) -> str:
    parts = []
    for i in range(N_DIMS):
        vals = ", ".join(f"round({_SQL_AGG[s].format(x=_x(i))}, 6) + 0.0 AS {s}_v"
                         for s in STAT_NAMES)
        parts.append(f"SELECT song_id, {i} AS dim, {vals} FROM segs GROUP BY song_id")
    return cte(segs=segs_sql) + "\nUNION ALL\n".join(parts)


def _cov_sql(segs_sql: str) -> str:
    parts = [f"SELECT song_id, {i} AS i, {j} AS j, round({_cov(i, j)}, 6) + 0.0 AS cov "
             f"FROM segs GROUP BY song_id" for i, j in SG.PAIRS]
    return cte(segs=segs_sql) + "\nUNION ALL\n".join(parts)


def _arrays_sql(segs_sql: str, ids_sql: str) -> str:
    stats = ", ".join(_SQL_AGG[s].format(x=_x(i)) for i in range(N_DIMS) for s in STAT_NAMES)
    covs = ", ".join(_cov(i, j) for i, j in SG.PAIRS)
    zeros72 = "[" + ", ".join(["0.0"] * 72) + "]"
    zeros78 = "[" + ", ".join(["0.0"] * 78) + "]"
    return cte(segs=segs_sql, ids=ids_sql) + f""",
wide AS (SELECT song_id, [{stats}] AS stats, [{covs}] AS cov FROM segs GROUP BY song_id),
arr AS (SELECT ids.song_id, coalesce(wide.stats, {zeros72}) AS stats,
               coalesce(wide.cov, {zeros78}) AS cov
        FROM ids LEFT JOIN wide ON ids.song_id = wide.song_id)
SELECT song_id, 'stats' AS part, CAST(r.i AS INTEGER) AS pos, round(stats[r.i + 1], 6) + 0.0 AS value
FROM arr CROSS JOIN range(72) r(i)
UNION ALL
SELECT song_id, 'cov' AS part, CAST(r.i AS INTEGER) AS pos, round(cov[r.i + 1], 6) + 0.0 AS value
FROM arr CROSS JOIN range(78) r(i)
"""


@register("segment_stats", _stats_sql(A.SQL_EMBEDDING_SEGMENTS))
def q_segment_stats(spark, sf_dir):
    """AG9 AG10 AG11: six statistics per dim; embeddings grouped by label are
    the songs, each row a segment"""
    with scratch(spark) as own:
        return own.keep(SG.stats_long(A.embedding_segments(spark, sf_dir)), "segment-stats")


@register("segment_cov", _cov_sql(A.SQL_EMBEDDING_SEGMENTS))
def q_segment_cov(spark, sf_dir):
    """AG12 AG13: sample covariance, upper triangle"""
    return SG.cov_long(A.embedding_segments(spark, sf_dir))


@register("segment_arrays", _arrays_sql(A.sql_segments("timbre"),
                                        "SELECT o_orderkey AS song_id FROM orders"))
def q_segment_arrays(spark, sf_dir):
    """AG10 AG13 SC8 SC9: the 72 + 78 record arrays of every track from its
    line items; tracks without line items get zeros"""
    segs = A.segments(spark, sf_dir, "timbre")
    ids = A.tracks(spark, sf_dir).select("song_id")
    return SG.arrays_long(SG.with_empty(ids, SG.segment_arrays(segs)))
