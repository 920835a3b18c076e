"""Nostalgia recommender queries; the flagship lives here.

The SQL twins are brute force: every fallback request is matched with every
song (a nested-loop join that only a small fixture can afford), so they check
the exact cuts of the Spark plan against the plain definition.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from songgraph.functions.scalar import sql_nostalgia_score
from songgraph.operators import graph as G
from songgraph.operators import recommend as R
from songgraph.operators import years as Y
from songgraph.plans.base import cte, register
from songgraph.plans.graph_queries import _E, _WALKS_FROM, run_nearest
from songgraph.session import materialize, scratch
from songgraph.sources import adapters as A


def _score(year: str, birth: str) -> str:
    return sql_nostalgia_score(year, birth)


@register("nostalgia_scores", cte(tracks=A.SQL_TRACKS) + f"""
SELECT song_id, "year", round({_score('"year"', '1990')}, 9) AS score FROM tracks""")
def q_nostalgia_scores(spark, sf_dir):
    """SC4 SC5: the score of every song for a listener born in 1990"""
    return R.scores(A.tracks(spark, sf_dir))


_RESOLVED = f""",
anchor AS (
  SELECT q.req_id, q.song_id AS anchor_song, coalesce(q.artist_id, s.artist_id) AS anchor_artist,
         q.top_k, q.birth_year,
         CASE WHEN q.song_id IS NOT NULL AND q.artist_id IS NULL AND s.song_id IS NULL
              THEN 'unknown_song' ELSE 'ok' END AS status
  FROM req q LEFT JOIN (SELECT song_id, min(artist_id) AS artist_id FROM songs GROUP BY song_id) s
    ON q.song_id = s.song_id),
ok AS (SELECT * FROM anchor WHERE status = 'ok' AND anchor_artist IS NOT NULL AND top_k >= 1)
"""


@register("request_status", cte(songs=A.SQL_TRACKS, req=A.SQL_REQUESTS) + _RESOLVED
          .replace(",\nanchor", "\n, anchor", 1) + "SELECT req_id, status FROM anchor")
def q_request_status(spark, sf_dir):
    """RC1 FLT6 JN5: each request's anchor resolved, unknown songs reported"""
    return R.request_status(R.resolve(A.requests(spark, sf_dir), A.tracks(spark, sf_dir)))


def _rec_sql(songs: str) -> str:
    return (cte(songs=songs, req=A.SQL_REQUESTS)
            + _RESOLVED.replace(",\nanchor", "\n, anchor", 1)
            + _E.replace("WITH ", ",\n", 1)
            + ",\nr AS (SELECT DISTINCT anchor_artist AS root FROM ok)\n"
            + _WALKS_FROM + f""",
nb AS (SELECT root, v FROM bfs
       QUALIFY row_number() OVER (PARTITION BY root ORDER BY degree, v) <= {R.SIMILAR_N}),
cand AS (
  SELECT o.req_id, o.top_k, s.song_id, s.title, s.artist_name, s."year",
         {_score('s."year"', 'o.birth_year')} AS score
  FROM ok o JOIN nb ON o.anchor_artist = nb.root JOIN songs s ON s.artist_id = nb.v
  WHERE o.anchor_song IS NULL OR s.song_id <> o.anchor_song),
fbq AS (SELECT * FROM ok WHERE req_id NOT IN (SELECT req_id FROM cand)),
fb AS (
  SELECT o.req_id, o.top_k, s.song_id, s.title, s.artist_name, s."year",
         {_score('s."year"', 'o.birth_year')} AS score
  FROM fbq o JOIN songs s ON (o.anchor_song IS NULL OR s.song_id <> o.anchor_song)),
allc AS (SELECT *, 'similar' AS source FROM cand UNION ALL SELECT *, 'fallback' AS source FROM fb)
SELECT req_id, CAST(rank AS INTEGER) AS rank, song_id, title, artist_name, "year",
       round(score, 9) AS score, source
FROM (SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY score DESC, song_id) AS rank
      FROM allc)
WHERE rank <= top_k
""")


_REC_SQL = _rec_sql(A.SQL_SONGS)


def recommend_batch(spark, sf_dir, tracks=None):
    req = A.requests(spark, sf_dir)
    tracks = A.tracks(spark, sf_dir) if tracks is None else tracks
    with scratch(spark) as own:
        resolved = materialize(R.resolve(req, tracks), "requests")
        roots = resolved.where(F.col("status") == "ok").select(F.col("anchor_artist").alias("root"))
        paths = run_nearest(spark, sf_dir, lambda sym: roots, R.SIMILAR_N)
        return own.keep(R.recommend(req, tracks, paths, artists=A.artists(spark, sf_dir), resolved=resolved))


@register("recommend_batch", _REC_SQL)
def q_recommend_batch(spark, sf_dir):
    """RC1-RC5 WN2 TK6-TK8 JN5 FLT6-FLT8 SC4: every event is a request; BFS
    from the requested artists, first 10 similar artists, nostalgia top_k,
    catalogue fallback"""
    return recommend_batch(spark, sf_dir)


_IMPUTED_SONGS = f"""
SELECT s.* REPLACE (CASE WHEN s."year" IS NULL OR s."year" = 0
                         THEN CAST(round(m.m) AS INTEGER) ELSE s."year" END AS "year")
FROM ({A.SQL_SONGS}) s LEFT JOIN (
  SELECT artist_id, avg("year") AS m FROM ({A.SQL_TRACKS})
  WHERE "year" IS NOT NULL AND "year" <> 0 GROUP BY artist_id) m ON s.artist_id = m.artist_id
WHERE m.m IS NOT NULL OR (s."year" IS NOT NULL AND s."year" <> 0)"""


@register("recommend_imputed", _rec_sql(_IMPUTED_SONGS))
def q_recommend_imputed(spark, sf_dir):
    """ML5 GR2 RC1-RC5 end to end: missing years imputed (the artist's mean
    year, merged as by impute_merge), BFS, then recommendations scored on them"""
    tracks = A.tracks(spark, sf_dir)
    merged = Y.merge_predictions(tracks, Y.artist_mean_predictions(tracks))
    with scratch(spark) as own:
        return own.keep(recommend_batch(spark, sf_dir, materialize(merged, "imputed")))


_FB_ONLY = (cte(songs=A.SQL_SONGS, req=A.SQL_REQUESTS)
            + _RESOLVED.replace(",\nanchor", "\n, anchor", 1) + f""",
births AS (SELECT DISTINCT birth_year FROM ok),
pre AS (
  SELECT b.birth_year, s.song_id, s.title, s.artist_name, s."year",
         {_score('s."year"', 'b.birth_year')} AS score
  FROM births b CROSS JOIN songs s
  QUALIFY row_number() OVER (PARTITION BY b.birth_year ORDER BY score DESC, s.song_id)
          <= (SELECT max(top_k) + 1 FROM ok)),
fb AS (
  SELECT o.req_id, o.top_k, p.song_id, p.title, p.artist_name, p."year", p.score
  FROM ok o JOIN pre p ON o.birth_year = p.birth_year
  WHERE o.anchor_song IS NULL OR p.song_id <> o.anchor_song)
SELECT req_id, CAST(rank AS INTEGER) AS rank, song_id, title, artist_name, "year",
       round(score, 9) AS score, 'fallback' AS source
FROM (SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY score DESC, song_id) AS rank
      FROM fb)
WHERE rank <= top_k
""")


@register("recommend_fallback", _FB_ONLY)
def q_recommend_fallback(spark, sf_dir):
    """RC4 TK6: every request answered from the whole catalogue (an empty
    similarity cache), anchor song excluded"""
    req = A.requests(spark, sf_dir)
    tracks = A.tracks(spark, sf_dir)
    empty = spark.createDataFrame([], "root long, v long, degree int")
    return R.recommend(req, tracks, empty, artists=A.artists(spark, sf_dir))


_TYPED = """
SELECT event_id AS req_id,
  CASE WHEN event_id % 17 = 0 THEN ' Quit ' WHEN event_id % 19 = 0 THEN 'no such id'
       ELSE '  ' || CAST(event_id AS VARCHAR) || ' ' END AS song_id,
  CASE WHEN event_id % 13 = 0 THEN 'ten' ELSE ' ' || CAST(event_id % 10 AS VARCHAR) END AS top_k,
  CAST(1970 + user_id % 30 AS VARCHAR) AS birth_year
FROM events"""


@register("request_typed", cte(songs=A.SQL_TRACKS, typed=_TYPED) + """,
p AS (SELECT req_id, lower(trim(song_id)) IN ('quit', 'exit', 'q') AS quits, TRY_CAST(trim(song_id) AS BIGINT) AS song_id,
             TRY_CAST(trim(top_k) AS INTEGER) AS top_k, TRY_CAST(trim(birth_year) AS INTEGER) AS birth_year FROM typed)
SELECT req_id, p.song_id AS anchor_song, s.artist_id AS anchor_artist, top_k, birth_year,
       CASE WHEN quits THEN 'quit' WHEN p.song_id IS NULL OR top_k IS NULL OR birth_year IS NULL THEN 'invalid_input'
            WHEN s.song_id IS NULL THEN 'unknown_song' WHEN top_k < 1 THEN 'bad_top_k' ELSE 'ok' END AS status
FROM p LEFT JOIN (SELECT song_id, min(artist_id) AS artist_id FROM songs GROUP BY song_id) s ON p.song_id = s.song_id""")
def q_request_typed(spark, sf_dir):
    """RC1 SC15 FLT6: requests as typed text: padded ids, words for numbers, quit"""
    e = A.table(spark, sf_dir, "events")
    k = F.col("event_id")
    typed = e.select(
        k.alias("req_id"),
        F.when(k % 17 == 0, " Quit ").when(k % 19 == 0, "no such id")
         .otherwise(F.concat(F.lit("  "), k.cast("string"), F.lit(" "))).alias("song_id"),
        F.when(k % 13 == 0, "ten").otherwise(F.concat(F.lit(" "), (k % 10).cast("string"))).alias("top_k"),
        (1970 + F.col("user_id") % 30).cast("string").alias("birth_year"))
    tracks = A.tracks(spark, sf_dir)
    parsed = R.parse_typed(typed, tracks)
    status = F.when(F.col("typed") == "ok", F.col("status")).otherwise(F.col("typed"))
    return R.resolve(parsed, tracks).join(parsed.select("req_id", "typed"), "req_id").select(
        "req_id", "anchor_song", "anchor_artist", "top_k", "birth_year", status.alias("status"))
