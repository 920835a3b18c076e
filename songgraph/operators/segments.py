"""Segment statistics of n x 12 matrices (AG9-AG13, SC8, SC9).

Input is long form, one row per segment: ``(song_id, seg, x0..x11)``; a
value missing from a short segment is 0.0, as in the original ingest. The 72
statistics (mean, median, min, max, population std, count for each dim,
array index ``dim*6 + stat``) and the 78 sample covariances of the upper
triangle (row-major) need no self-join and no pair explosion.

Songs of up to ``SONG_ROWS`` segments cross the network once, as their 12 plain values, and
nothing is written. For whole song records (``song_arrays``) they meet the rows of their
songs there, sorted by song, and stream through Arrow batches: numpy makes the statistics of
all songs of one length together. ``segment_arrays`` stays in windows over the song, whose result
is joined by song without another shuffle. Both take the products of deviations from
the means, so nothing cancels where means dwarf the spread. Longer songs are never in one task: sums, min and max
come from one hash aggregate that combines partially before the shuffle; std and
covariance from a second one over the deviations; medians from the narrow rows (song,
dim, value) by the value brackets of ``quantiles``. Values that follow from others
(pitches from timbre) are derived after the shuffle.

A song without segments gets 72 and 78 zeros; a song with one segment has
covariance NaN (0/0), as computed by the original; features fill it with 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from songgraph.operators.quantiles import exact_medians
from songgraph.schema import N_COV, N_DIMS, N_STATS, STAT_NAMES
from songgraph.session import materialize, scratch

# Segments of the longest song that one task may hold (13 MB of values at most).
SONG_ROWS = 1 << 14
# How a matrix follows from the stored one, by column prefix.
Derived = dict[str, Callable[[Column], Column]]

PAIRS = [(i, j) for i in range(N_DIMS) for j in range(i, N_DIMS)]


def explode_matrix(df: DataFrame, id_col: str, matrix_col: str) -> DataFrame:
    """Array-of-arrays form (one row per song) to long form. A null or short
    segment gives 0.0 for its missing values."""
    seg = F.posexplode(matrix_col).alias("seg", "_row")
    return (df.select(F.col(id_col).alias("song_id"), seg)
              .select("song_id", "seg",
                      *[F.coalesce(F.get("_row", i).cast("double"), F.lit(0.0)).alias(f"x{i}")
                        for i in range(N_DIMS)]))


def _xs(src: str) -> list:
    return [F.coalesce(F.col(f"{src}{i}").cast("double"), F.lit(0.0)) for i in range(N_DIMS)]


def _sums(segs: DataFrame, srcs: list[str]) -> DataFrame:
    """n, and the sum, min and max of each dim, per song."""
    out = [F.count(F.lit(1)).alias("n")]
    for src in srcs:
        for i, x in enumerate(_xs(src)):
            out += [F.sum(x).alias(f"{src}_sum{i}"), F.min(x).alias(f"{src}_min{i}"),
                    F.max(x).alias(f"{src}_max{i}")]
    return segs.groupBy("song_id").agg(*out)


def _moments(segs: DataFrame, sums: DataFrame, srcs: list[str]) -> DataFrame:
    """Sums of the products of deviations from the song's means, per song.

    Plain sums stay in generated code (``covar_samp`` keeps five buffers per
    pair and measured ~4.5x slower here). The group key is the song id in a
    struct, so the aggregate does not inherit the join's partitioning: AQE may
    split a hot song's join, and its parts combine before the next shuffle."""
    means = sums.select("song_id", *[(F.col(f"{src}_sum{i}") / F.col("n")).alias(f"_mean_{src}{i}")
                                     for src in srcs for i in range(N_DIMS)])
    dev = segs.hint("merge").join(means, "song_id").select(
        F.struct("song_id").alias("_key"),
        *[(x - F.col(f"_mean_{src}{i}")).alias(f"_{src}{i}")
          for src in srcs for i, x in enumerate(_xs(src))])
    agg = dev.groupBy("_key").agg(*[F.sum(F.col(f"_{src}{i}") * F.col(f"_{src}{j}")).alias(f"{src}_sp{i}_{j}")
                                    for src in srcs for i, j in PAIRS])
    return agg.select("_key.song_id", *[f"{src}_sp{i}_{j}" for src in srcs for i, j in PAIRS])


def _medians(segs: DataFrame, sums: DataFrame, srcs: list[str]) -> DataFrame:
    """Exact medians (mean of the middle two for an even count) per song and dim, one
    row per song."""
    cells = [F.struct(F.lit(k * N_DIMS + i).alias("d"), x.alias("x"), F.col(f"{src}_min{i}").alias("lo"),
                      F.col(f"{src}_max{i}").alias("hi"))
             for k, src in enumerate(srcs) for i, x in enumerate(_xs(src))]
    ends = sums.select("song_id", "n", *[f"{src}_{m}{i}" for src in srcs for i in range(N_DIMS) for m in ("min", "max")])
    long = (segs.hint("merge").join(ends, "song_id").select("song_id", "n", F.explode(F.array(*cells)).alias("e"))
                .select("song_id", "n", "e.*"))
    plain = F.array(*[F.struct(F.lit(k * N_DIMS + i).alias("d"), x.alias("x"))
                      for k, src in enumerate(srcs) for i, x in enumerate(_xs(src))])

    def again(still):           # the segments of songs with a dim that is open yet
        return segs.join(still.select("song_id").distinct(), "song_id", "left_semi") \
            .select("song_id", F.explode(plain).alias("e")).select("song_id", "e.*")

    med = exact_medians(long, ["song_id", "d"], "x", "m", again)
    return med.groupBy("song_id").agg(*[
        F.max(F.when(F.col("d") == k * N_DIMS + i, F.col("m"))).alias(f"{src}_med{i}")
        for k, src in enumerate(srcs) for i in range(N_DIMS)])


def _final(src: str, medians: bool = True) -> list:
    """Statistics from sums (S) and centred products (P): mean = S/n, population
    std = sqrt(P_ii / n), sample covariance = P_ij / (n - 1) (NaN for one
    segment, as 0/0 in the original)."""
    n = F.col("n").cast("double")
    out = []
    for i in range(N_DIMS):
        med = F.col(f"{src}_med{i}") if medians else F.lit(None).cast("double")
        stats = {"mean": F.col(f"{src}_sum{i}") / n, "median": med,
                 "min": F.col(f"{src}_min{i}"), "max": F.col(f"{src}_max{i}"),
                 "std": F.sqrt(F.col(f"{src}_sp{i}_{i}") / n), "count": n}
        out += [stats[s].alias(f"{src}_s{i}_{s}") for s in STAT_NAMES]
    for i, j in PAIRS:
        cov = F.col(f"{src}_sp{i}_{j}") / (n - 1)
        out.append(F.when(n > 1, cov).otherwise(F.lit(float("nan"))).alias(f"{src}_c{i}_{j}"))
    return out


def _long(segs: DataFrame, srcs: list[str], medians: bool) -> DataFrame:
    """The statistics of songs of any length, each spread over many tasks, written."""
    with scratch(segs.sparkSession) as own:
        # per-song sums feed the deviations, the brackets and the result: computed once
        sums = materialize(_sums(segs, srcs), "song-sums")
        # One row per song on every side: sort-merge joins, pinned, so AQE never
        # broadcasts a side whose compressed size looks small.
        both = sums.hint("merge").join(_moments(segs, sums, srcs), "song_id")
        if medians:
            both = both.hint("merge").join(_medians(segs, sums, srcs), "song_id")
        return own.keep(both.select("song_id", *[c for src in srcs for c in _final(src, medians)]),
                        "song-statistics")


def _short(segs: DataFrame, srcs: list[str], medians: bool) -> DataFrame:
    """The same for songs that one task can hold: windows over rows that lie together.
    Partitioned and sorted by song, so a join by song moves nothing again."""
    song = Window.partitionBy("song_id")
    xs = [f"{src}{i}" for src in srcs for i in range(N_DIMS)]
    rows = segs.select("song_id", *[x.alias(f"{src}{i}") for src in srcs for i, x in enumerate(_xs(src))]) \
        .withColumn("_at", F.row_number().over(song.orderBy(xs[0])))
    one = [F.count(F.lit(1)).over(song).alias("n")]
    for src in srcs:
        for i in range(N_DIMS):
            x = f"{src}{i}"
            one += [F.sum(x).over(song).alias(f"{src}_sum{i}"), F.min(x).over(song).alias(f"{src}_min{i}"),
                    F.max(x).over(song).alias(f"{src}_max{i}")]
            if medians:
                one.append(F.median(x).over(song).alias(f"{src}_med{i}"))
    known = rows.select("song_id", "_at", *xs, *one)
    stats = [c for c in known.columns if c not in ("song_id", "_at", *xs)]
    dev = known.select("song_id", "_at", *stats, *[(F.col(f"{src}{i}") - F.col(f"{src}_sum{i}") / F.col("n")).alias(f"_{src}{i}")
                                                   for src in srcs for i in range(N_DIMS)])
    both = dev.select("song_id", "_at", *stats, *[F.sum(F.col(f"_{src}{i}") * F.col(f"_{src}{j}")).over(song).alias(f"{src}_sp{i}_{j}")
                                                  for src in srcs for i, j in PAIRS])
    return both.where(F.col("_at") == 1).select("song_id", *[c for src in srcs for c in _final(src, medians)])


def _long_songs(segs: DataFrame) -> DataFrame:
    return materialize(segs.groupBy("song_id").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > SONG_ROWS).select("song_id"), "long-songs")


def _derive(rows: DataFrame, stored: list[str], derived: Derived | None) -> DataFrame:
    return rows.select("*", *[f(F.col(f"{stored[0]}{i}")).alias(f"{src}{i}")
                              for src, f in (derived or {}).items() for i in range(N_DIMS)])


def _wide(segs: DataFrame, srcs: list[str], medians: bool = True) -> DataFrame:
    """One row per song. Lazy but for long songs."""
    segs = segs.where(F.col("song_id").isNotNull()) \
        .select("song_id", *[f"{src}{i}" for src in srcs for i in range(N_DIMS)])
    with scratch(segs.sparkSession) as own:
        long = _long_songs(segs)
        if long.isEmpty():
            return _short(segs.repartition("song_id"), srcs, medians)
        rest = _short(segs.join(long, "song_id", "left_anti").repartition("song_id"), srcs, medians)
        spread = _long(segs.join(long, "song_id", "left_semi"), srcs, medians)
        own.keep(long)              # the lazy rest reads it
        return rest.unionByName(own.keep(spread))


def _matrix_statistics(width: int, whole: bool):
    """A function over Arrow batches of rows that lie together by song, its segments before
    the rows that ask for them: (song id, asks, ``width`` values, the row that asks). Each row that
    asks is given back with the two arrays of every 12 columns, zeros without segments; if the
    songs are the segments' own (not ``whole``), each song is given once, by its id. Songs of equal
    length are done together; the last song's segments wait for the next batch. Workers
    get the function itself, so they need not have this package."""
    dims, n_stats, n_cov = N_DIMS, N_STATS, N_COV

    def tables(rows, start, size):
        """Per matrix the (songs, 72) statistics and the (songs, 78) covariances."""
        import numpy as np
        upper = np.triu_indices(dims)
        out = [(np.zeros((len(size), n_stats)), np.zeros((len(size), n_cov))) for _ in range(width // dims)]
        for n in np.unique(size[size > 0]).tolist():
            songs = np.flatnonzero(size == n)
            own = rows[start[songs][:, None] + np.arange(n)]                # songs, segments, columns
            mean = own.sum(1) / n
            least, most = np.fmin.reduce(own, 1), own.max(1)                # NaN above every number
            order = np.sort(own, 1)
            low, high = order[:, (n - 1) // 2], order[:, n // 2]
            middle = np.where(low == high, low, 0.5 * low + 0.5 * high)
            own -= mean[:, None]
            for k, (stats, cov) in enumerate(out):
                at = slice(k * dims, (k + 1) * dims)
                products = np.matmul(own[:, :, at].transpose(0, 2, 1), own[:, :, at])
                spread = np.sqrt(products[:, np.arange(dims), np.arange(dims)] / n)
                stats[songs] = np.stack([mean[:, at], middle[:, at], least[:, at], most[:, at], spread,
                                         np.full((len(songs), dims), float(n))], 2).reshape(len(songs), n_stats)
                cov[songs] = products[:, upper[0], upper[1]] / (n - 1) if n > 1 else np.nan
        return out

    def made(ids, rows, first, asked):
        """The rows of ``asked`` (Arrow) with the arrays of the songs that start at ``first``;
        each of them has a number in ``ids``."""
        import numpy as np
        import pyarrow as pa
        some, ids = np.unique(ids, return_inverse=True)
        with np.errstate(all="ignore"):
            arrays = tables(rows, first[some], np.diff(np.r_[first, len(rows)])[some])
        cols = [asked]
        for pair in arrays:
            for cells in pair:
                ends = np.arange(len(ids) + 1, dtype=np.int32) * cells.shape[1]
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(cells[ids].ravel())))
        return pa.RecordBatch.from_arrays(cols, [f"c{n}" for n in range(len(cols))])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        held = None                         # the segments of the last song
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            key = rows.column(0).combine_chunks()
            new = pc.fill_null(pc.not_equal(key[1:], key[:-1]), pc.xor(pc.is_null(key[1:]), pc.is_null(key[:-1])))
            song = np.r_[0, np.cumsum(new.to_numpy(zero_copy_only=False))].astype(np.int64)
            asks = rows.column(1).to_numpy()
            ready = np.ones(len(song), bool) if whole else song < song[-1]
            cells = rows.column(2).combine_chunks().flatten().to_numpy().reshape(-1, width)[ready[~asks]]
            if whole:
                of, asked = song[asks], rows.column(3).filter(pa.array(asks))
            else:
                of = np.arange(song[-1])
                asked = key.take(pa.array(np.searchsorted(song, of)))
            if len(of):
                yield made(of, cells, np.searchsorted(song[~asks & ready], np.arange(song[-1] + 1)),
                           asked.combine_chunks() if isinstance(asked, pa.ChunkedArray) else asked)
            held = rows.filter(pa.array(~asks & (song == song[-1])))
        if held is not None and not whole and held.num_rows:
            cells = held.column(2).combine_chunks().flatten().to_numpy().reshape(-1, width)
            yield made(np.zeros(1, np.int64), cells, np.zeros(1, np.int64), held.column(0).combine_chunks()[:1])

    return run


def _streamed(segs: DataFrame, srcs: list[str], derived: Derived | None, songs: DataFrame | None) -> DataFrame:
    """The arrays of songs that one task can hold, ``x_stats`` and ``x_cov`` of each prefix, after
    ``song_id``, or after the columns of ``songs`` for each of its rows."""
    stored = [c for c in segs.columns if c != "song_id"]
    arrays = [f"{src}_{kind}" for src in srcs for kind in ("stats", "cov")]
    rows = segs.select("song_id", F.lit(False).alias("_asks"), *stored)
    if songs is None:
        lead = segs.schema["song_id"].dataType
    else:
        lead = T.StructType([T.StructField(f"c{n}", f.dataType) for n, f in enumerate(songs.schema)])
        row = F.struct(*[F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(songs.columns)])
        rows = rows.withColumn("_row", F.lit(None).cast(lead)).union(songs.select(
            "song_id", F.lit(True), *[F.lit(None).cast(segs.schema[c].dataType) for c in stored], row))
    rows = _derive(rows.repartition("song_id"), srcs, derived)
    # one column of values, as Spark weighs every column of a batch at every row
    values = F.when(~F.col("_asks"), F.array(*[x for src in srcs for x in _xs(src)]))
    rows = rows.sortWithinPartitions("song_id", "_asks").select(
        "song_id", "_asks", values.alias("_values"), *(["_row"] if songs is not None else []))
    cells = T.ArrayType(T.DoubleType())
    out = T.StructType([T.StructField("_lead", lead)] + [T.StructField(c, cells) for c in arrays])
    got = rows.toDF(*[f"c{n}" for n in range(len(rows.columns))]).mapInArrow(
        _matrix_statistics(N_DIMS * len(srcs), songs is not None), out)
    if songs is None:
        return got.withColumnRenamed("_lead", "song_id")
    return got.select(*[F.col(f"_lead.c{n}").alias(c) for n, c in enumerate(songs.columns)], *arrays)


def song_arrays(segs: DataFrame, kinds: dict[str, tuple[str, str]], derived: Derived | None = None,
                songs: DataFrame | None = None) -> DataFrame:
    """The rows of ``songs`` with the arrays of their segments, zeros for those without any; without
    ``songs``, (song_id, arrays) of the songs that the segments name. ``kinds`` and ``derived`` as in
    ``record_arrays``. Lazy but for long songs."""
    srcs = list(kinds)
    stored = [src for src in srcs if src not in (derived or {})]
    segs = segs.where(F.col("song_id").isNotNull()) \
        .select("song_id", *[f"{src}{i}" for src in stored for i in range(N_DIMS)])
    with scratch(segs.sparkSession) as own:
        long = _long_songs(segs)
        if long.isEmpty():
            got = _streamed(segs, srcs, derived, songs)
        else:
            got = _streamed(segs.join(long, "song_id", "left_anti"), srcs, derived,
                            None if songs is None else songs.join(long, "song_id", "left_anti").select(*songs.columns))
            asked = long if songs is None else long.join(songs, "song_id", "left_semi")
            spread = _long(_derive(segs.join(asked, "song_id", "left_semi"), stored, derived), srcs, True)
            own.keep(long)              # the lazy rest reads it
            spread = own.keep(_as_arrays(spread, srcs), "song-arrays")
            if songs is not None:
                spread = songs.join(spread.hint("merge"), "song_id").select(*songs.columns, *spread.columns[1:])
            got = got.unionByName(spread)
    lead = ["song_id"] if songs is None else songs.columns
    return got.select(*lead, *[F.col(f"{src}_{kind}").alias(name) for src, names in kinds.items()
                               for kind, name in zip(("stats", "cov"), names)])


def _as_arrays(wide: DataFrame, srcs: list[str]) -> DataFrame:
    out = []
    for src in srcs:
        out.append(F.array(*[F.col(f"{src}_s{i}_{s}") for i in range(N_DIMS) for s in STAT_NAMES]).alias(f"{src}_stats"))
        out.append(F.array(*[F.col(f"{src}_c{i}_{j}") for i, j in PAIRS]).alias(f"{src}_cov"))
    return wide.select("song_id", *out)


def segment_stats_wide(segs: DataFrame, medians: bool = True) -> DataFrame:
    """One row per song: ``x_s{dim}_{stat}`` and ``x_c{i}_{j}`` columns
    (the medians null when ``medians`` is False)."""
    return _wide(segs, ["x"], medians)


def segment_arrays(segs: DataFrame, stats_col: str = "stats", cov_col: str = "cov") -> DataFrame:
    """AG10/AG13: ``(song_id, stats[72], cov[78])`` in the record layout."""
    return _as_arrays(segment_stats_wide(segs), ["x"]).toDF("song_id", stats_col, cov_col)


def record_arrays(segs: DataFrame, kinds: dict[str, tuple[str, str]], derived: Derived | None = None,
                  wanted: DataFrame | None = None) -> DataFrame:
    """Several matrices that share their segments (e.g. timbre ``x*`` and
    pitches ``p*`` of the same rows) in ONE pass. ``kinds`` maps a column prefix
    to the (stats, cov) output names; ``derived`` tells how the columns of a prefix
    follow from those of the first; ``wanted`` (``song_id``) restricts the songs."""
    if wanted is not None:
        return song_arrays(segs.join(wanted.select("song_id").distinct(), "song_id", "left_semi"), kinds, derived)
    return song_arrays(segs, kinds, derived)


def with_empty(ids: DataFrame, arrays: DataFrame, stats_col: str = "stats",
               cov_col: str = "cov") -> DataFrame:
    """SC8: songs without segments get ``array_repeat(0.0, n)``."""
    j = ids.select("song_id").join(arrays.hint("merge"), "song_id", "left")
    return j.select("song_id", *zero_fill(stats_col, cov_col))


def zero_fill(stats_col: str, cov_col: str) -> list:
    return [F.coalesce(stats_col, F.array_repeat(F.lit(0.0), N_STATS)).alias(stats_col),
            F.coalesce(cov_col, F.array_repeat(F.lit(0.0), N_COV)).alias(cov_col)]


def _r(c, digits: int):
    """Round for comparison; ``+ 0.0`` turns a rounded -0.0 into 0.0."""
    return F.round(c, digits) + F.lit(0.0)


def stats_long(segs: DataFrame, digits: int = 6) -> DataFrame:
    """AG9/AG10/AG11 one row per (song, dim)."""
    wide = segment_stats_wide(segs)
    per_dim = F.explode(F.array(*[
        F.struct(F.lit(i).alias("dim"),
                 *[F.col(f"x_s{i}_{s}").alias(s) for s in STAT_NAMES])
        for i in range(N_DIMS)])).alias("d")
    return (wide.select("song_id", per_dim)
                .select("song_id", "d.dim",
                        *[_r(f"d.{s}", digits).alias(f"{s}_v") for s in STAT_NAMES]))


def cov_long(segs: DataFrame, digits: int = 6) -> DataFrame:
    """AG12/AG13 one row per (song, i, j), i <= j; no median pass."""
    wide = segment_stats_wide(segs, medians=False)
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"x_c{i}_{j}").alias("cov"))
        for i, j in PAIRS])).alias("c")
    return (wide.select("song_id", cells)
                .select("song_id", "c.i", "c.j", _r("c.cov", digits).alias("cov")))


def arrays_long(arrays: DataFrame, digits: int = 6,
                stats_col: str = "stats", cov_col: str = "cov") -> DataFrame:
    """The two arrays exploded with their index, for checking the layout."""
    s = arrays.select("song_id", F.lit("stats").alias("part"),
                      F.posexplode(stats_col).alias("pos", "value"))
    c = arrays.select("song_id", F.lit("cov").alias("part"),
                      F.posexplode(cov_col).alias("pos", "value"))
    return s.unionByName(c).withColumn("value", _r("value", digits))
