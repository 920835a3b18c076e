"""Batch nostalgia recommender (RC1-RC5).

A request names an anchor song or artist, a ``top_k`` and the listener's
birth year. Songs by the anchor artist's first 10 similar artists are scored
by how close their year is to the year the listener turned 16 and the best
``top_k`` are returned; a request whose anchor artist has no similar artist,
or whose similar artists have no other song, falls back to the best songs of
the whole catalogue. A request whose anchor song is unknown gets no rows
(``request_status`` reports it).

Scale plan, all exact:

* The score depends only on ``(year, birth_year)``; ranking is by score,
  then song id. Inside one ``(artist, year)`` group all songs score the same,
  so only its first ``Kmax + 1`` song ids can ever be chosen (``+1`` leaves
  room for the excluded anchor). Songs are cut to that before any join, with a
  WindowGroupLimit that trims inside every task before the shuffle.
* The similar-artist work runs once per distinct ``(anchor artist, birth
  year)`` key, not per request: the songs of an anchor's similar artists are brought
  to it once, and a key takes only the years, best first, that hold its first
  ``Kmax + 1`` songs. A request joins only the first ``top_k + 1``
  rows of its key. A hot artist asked for by a third of all requests is one key.
* The fallback ranks the whole catalogue per distinct birth year without a
  product of requests and songs. Songs are cut to the first ``Kmax + 1`` per
  year and years are taken from the peak outwards, by equi-join, only until they
  hold ``Kmax + 1`` songs. From ``ZERO`` years on every score is exactly 0.0 in
  double arithmetic, so only ids matter there: the tail is one list of songs
  numbered by position (dated ones by id, then undated ones), and a birth year
  whose near years hold too few songs joins its positions one by one. ``Kmax + 1``
  dated and as many undated songs are enough: fewer than that of them are near ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from songgraph.functions.scalar import DEFAULT_BIRTH_YEAR, PEAK_AGE, clean_key, nostalgia_score
from songgraph.operators.graph import nearest
from songgraph.operators.ranks import positions
from songgraph.session import materialize, scratch

SIMILAR_N = 10          # similar artists read from the cache per anchor
ZERO = 194              # |year - peak| >= ZERO  ->  score == 0.0 exactly
# The words that end a typed session.
QUIT = ("quit", "exit", "q")


def parse_typed(typed: DataFrame, songs: DataFrame) -> DataFrame:
    """RC1/SC15: requests as typed by people, ``(req_id, song_id, top_k, birth_year)``
    all text, as a request table with a ``typed`` status: ids are trimmed and take the
    type of the song table's, numbers are parsed; ``quit`` (in any case) ends a session,
    and what is no number or no possible id is ``invalid_input``."""
    key = F.trim("song_id")
    kinds = {f.name: f.dataType.simpleString() for f in songs.schema.fields}
    number = {c: F.trim(c).try_cast("int") for c in ("top_k", "birth_year")}
    song = key.try_cast(kinds["song_id"])
    bad = song.isNull() | number["top_k"].isNull() | number["birth_year"].isNull()
    return typed.select(
        "req_id", song.alias("song_id"), F.lit(None).cast(kinds["artist_id"]).alias("artist_id"),
        number["top_k"].alias("top_k"), number["birth_year"].alias("birth_year"),
        F.when(F.coalesce(clean_key("song_id").isin(*QUIT), F.lit(False)), "quit")
         .when(bad, "invalid_input").otherwise("ok").alias("typed"))


def resolve(requests: DataFrame, songs: DataFrame) -> DataFrame:
    """RC1: anchor artist of each request. An explicit ``artist_id`` wins;
    otherwise the artist of ``song_id`` (the smallest one, should the song id
    repeat). Only the requested song ids are looked up (semi-join first)."""
    asked = requests.where(F.col("song_id").isNotNull()).select("song_id").distinct()
    song_artist = (songs.select("song_id", "artist_id")
                        .join(asked, "song_id", "left_semi")
                        .groupBy("song_id").agg(F.min("artist_id").alias("song_artist")))
    r = requests.join(song_artist, "song_id", "left")
    unknown = F.col("song_id").isNotNull() & F.col("song_artist").isNull() \
        & F.col("artist_id").isNull()
    return r.select(
        "req_id", F.col("song_id").alias("anchor_song"),
        F.coalesce("artist_id", "song_artist").alias("anchor_artist"),
        "top_k", F.coalesce("birth_year", F.lit(DEFAULT_BIRTH_YEAR)).alias("birth_year"),
        F.when(unknown, "unknown_song")
         .when(F.col("top_k").isNull() | (F.col("top_k") < 1), "bad_top_k")
         .otherwise("ok").alias("status"))


def request_status(resolved: DataFrame) -> DataFrame:
    return resolved.select("req_id", "status")


def _cut(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("song_id").asc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def _score(birth: str = "birth_year") -> Column:
    return nostalgia_score(F.col("year"), F.col(birth))


def _rank(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("song_id").asc())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def similar_ranked(ok: DataFrame, songs: DataFrame, paths: DataFrame, kf: int) -> DataFrame:
    """RC2 + RC3 per key ``(anchor_artist, birth_year)``: the first ``kf``
    candidates by (score desc, song id)."""
    nb = (nearest(paths, SIMILAR_N).select(F.col("root").alias("anchor_artist"), "v"))
    keys = ok.select("anchor_artist", "birth_year").distinct()
    asked = nb.join(keys, "anchor_artist", "left_semi")
    pool = songs.join(asked.select(F.col("v").alias("artist_id")).distinct(),
                      "artist_id", "left_semi")
    pool = _cut(pool, ["artist_id", "year"], kf)
    # everything below lies by anchor: its similar artists' songs move there once, whatever
    # the number of birth years that ask for them
    near = asked.join(pool, asked["v"] == pool["artist_id"]) \
        .select("anchor_artist", "song_id", "artist_id", "title", "year").repartition("anchor_artist")
    sizes = near.groupBy("anchor_artist", F.col("year").alias("at")).agg(F.least(F.count(F.lit(1)), F.lit(kf)).alias("n"))
    # years of a key by score, until they hold kf songs; equal scores go together
    key = Window.partitionBy("anchor_artist", "birth_year")
    upto = key.orderBy(F.col("score").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("anchor_artist", "birth_year", "score")
    years = (keys.repartition("anchor_artist").hint("merge").join(sizes, "anchor_artist")
                 .withColumn("score", nostalgia_score(F.col("at"), F.col("birth_year")))
                 .withColumn("_before", F.sum("n").over(upto) - F.sum("n").over(same))
                 .where(F.col("_before") < kf)
                 .select("anchor_artist", "birth_year", "at", "score"))
    # joined by anchor alone, the year as a range, so that nothing moves again
    at = (F.col("year") >= F.col("at")) & (F.col("year") <= F.col("at")) | F.col("year").isNull() & F.col("at").isNull()
    cand = (years.hint("merge").join(_cut(near, ["anchor_artist", "year"], kf), "anchor_artist").where(at)
                 .select("anchor_artist", "birth_year", "song_id", "artist_id", "title", "year", "score"))
    return _rank(cand, ["anchor_artist", "birth_year"], kf)


def fallback_ranked(birth_years: DataFrame, songs: DataFrame, kf: int) -> DataFrame:
    """RC4/TK6 per birth year: the first ``kf`` songs of the whole catalogue
    by (score desc, song id)."""
    per_year = materialize(_cut(songs.select("song_id", "artist_id", "title", "year"), ["year"], kf), "per-year")
    known = per_year.where(F.col("year").isNotNull())
    by = birth_years.select("birth_year").distinct()
    peak = F.col("birth_year").cast("long") + F.lit(PEAK_AGE)

    # years near the peak, nearest first, until they hold kf songs
    sizes = known.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    nearer = Window.partitionBy("birth_year").orderBy("far").rangeBetween(Window.unboundedPreceding, -1)
    near = (by.select("birth_year", F.explode(F.sequence(F.lit(1 - ZERO), F.lit(ZERO - 1))).alias("off"))
              .select("birth_year", F.abs("off").alias("far"), (peak + F.col("off")).alias("year"))
              .join(sizes, "year")
              .withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0))))
    near = materialize(near, "near-years")
    cols = ["birth_year", "song_id", "artist_id", "title", "year"]
    found = near.where(F.col("before") < kf).select("birth_year", "year").join(known, "year").select(*cols)

    # birth years whose near years hold fewer: positions of the tail
    have = near.groupBy("birth_year").agg(F.sum("n").alias("have"))
    short = materialize(by.join(have, "birth_year", "left").where(F.coalesce("have", F.lit(0)) < kf)
                        .select("birth_year"), "short-years")
    if not short.isEmpty():
        tail = materialize(positions(per_year.withColumn("late", F.col("year").isNull().cast("int")), ["late"], ["song_id"])
                           .where(F.col("pos") < kf), "tail")
        dated, both = tail.agg(F.count_if(F.col("late") == 0), F.count(F.lit(1))).first()
        slots = short.select("birth_year", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(both - 1).cast("long"))).alias("slot"))
        rest = (slots.join(tail.withColumn("slot", F.col("pos") + dated * F.col("late")).hint("merge"), "slot")
                .where(F.col("year").isNull() | (F.abs(F.col("year") - peak) >= ZERO)).select(*cols))
        found = found.unionByName(rest) if both else found
    return _rank(found.withColumn("score", _score()), ["birth_year"], kf)


def recommend(requests: DataFrame, songs: DataFrame, paths: DataFrame,
              artists: DataFrame | None = None, exclude_anchor_in_fallback: bool = True,
              score_digits: int | None = 9, resolved: DataFrame | None = None) -> DataFrame:
    """RC5: one plan for a whole request table.

    ``songs``: ``song_id, artist_id, title, year`` (``artist_name`` too, unless
    ``artists`` gives it). ``paths``: the similar-artist cache ``(root, v,
    degree)``. ``resolved``: ``resolve(requests, songs)`` where the caller has it.
    Returns ``(req_id, rank, song_id, title, artist_name, year,
    score, source)`` with ``source`` in {similar, fallback}, a written table; the
    tables it was made from are deleted.
    """
    with scratch(songs.sparkSession) as own:
        # resolved requests and the songs feed several branches: computed once
        if resolved is None:
            resolved = materialize(resolve(requests, songs), "requests")
        ok = resolved.where((F.col("status") == "ok") & F.col("anchor_artist").isNotNull()
                            & (F.col("top_k") >= 1))
        kmax = ok.agg(F.max("top_k")).first()[0] or 0
        kf = int(kmax) + 1
        # one row per song id (the least one), so that ids removed or named later are unique
        base = materialize(songs.groupBy("song_id").agg(F.min(F.struct("artist_id", "title", "year")).alias("_s"))
                           .select("song_id", "_s.*"), "songs")
        other = F.col("anchor_song").isNull() | (F.col("song_id") != F.col("anchor_song"))

        def answers(asks, ranked, keys, without_anchor):
            """The first ``top_k`` of each request's key, without its anchor: at most
            ``top_k + 1`` rows of the key join."""
            rows = asks.join(ranked.withColumnRenamed("rank", "_at"), keys).where(F.col("_at") <= F.col("top_k") + 1)
            return _rank(rows.where(other) if without_anchor else rows, ["req_id"], kf) \
                .where(F.col("rank") <= F.col("top_k"))

        keyed = similar_ranked(ok, base, paths, kf)
        sim = materialize(answers(ok, keyed, ["anchor_artist", "birth_year"], True)
                          .withColumn("source", F.lit("similar")), "similar")
        served = sim.select("req_id").distinct()       # top_k >= 1: a candidate -> a row

        fb_req = materialize(ok.join(served, "req_id", "left_anti"), "fallback-requests")
        fb = answers(fb_req, fallback_ranked(fb_req, base, kf), ["birth_year"], exclude_anchor_in_fallback) \
            .withColumn("source", F.lit("fallback"))

        cols = ["req_id", "rank", "song_id", "artist_id", "title", "year", "score", "source"]
        out = sim.select(*cols).unionByName(fb.select(*cols))
        if artists is not None:
            out = out.join(artists.select("artist_id", "artist_name"), "artist_id", "left")
        else:
            names = (songs.groupBy("song_id")
                          .agg(F.min_by("artist_name", F.struct("artist_id", "title", "year")).alias("artist_name")))
            out = out.join(names, "song_id", "left")
        score = F.round("score", score_digits) if score_digits is not None else F.col("score")
        return own.keep(out.select("req_id", F.col("rank").cast("int").alias("rank"), "song_id", "title",
                                   "artist_name", "year", score.alias("score"), "source"), "recommendations")


def scores(songs: DataFrame, birth_year: int = 1990, digits: int = 9) -> DataFrame:
    """SC4 over a whole song table for one birth year."""
    return songs.select("song_id", "year",
                        F.round(nostalgia_score("year", F.lit(birth_year)), digits)
                        .alias("score"))
