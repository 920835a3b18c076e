"""Operator tests on hand-made fixtures (FIXTURES.md section 2)."""

import math

import pytest
from pyspark.sql import functions as F

from songgraph.functions.scalar import nostalgia_score
from songgraph.operators import explore, graph as G, recommend as R, segments as SG
from songgraph.operators import serving as S, years as Y
from songgraph.sources import adapters as A


def _segs(spark, rows):
    """rows: (song_id, seg, [values]) -> long form with x0..x11 (short rows
    leave the rest null)."""
    data = [(sid, seg, *(vals + [None] * (12 - len(vals)))) for sid, seg, vals in rows]
    cols = ["song_id", "seg"] + [f"x{i}" for i in range(12)]
    schema = "song_id long, seg int, " + ", ".join(f"x{i} double" for i in range(12))
    return spark.createDataFrame(data, schema).toDF(*cols)


def test_vector_stats(spark):
    # dim 0 holds [1,2,3,4]; the other dims are zero-padded
    segs = _segs(spark, [(1, k, [float(v)]) for k, v in enumerate([1, 2, 3, 4])])
    row = SG.segment_arrays(segs).collect()[0]
    mean, med, lo, hi, std, cnt = row["stats"][0:6]
    assert (mean, med, lo, hi, cnt) == (2.5, 2.5, 1.0, 4.0, 4.0)
    assert std == pytest.approx(1.118033988749895, abs=1e-12)
    assert row["stats"][6:12] == [0.0, 0.0, 0.0, 0.0, 0.0, 4.0]


def test_covariance_and_single_segment(spark):
    segs = _segs(spark, [(1, 0, [1.0, 2.0]), (1, 1, [2.0, 4.0]), (1, 2, [3.0, 7.0]),
                         (2, 0, [5.0, 5.0])])
    rows = {r["song_id"]: r for r in SG.segment_arrays(segs).collect()}
    # pair (0, 1) is index 1 of the upper triangle
    assert rows[1]["cov"][1] == pytest.approx(2.5)
    assert len(rows[1]["cov"]) == 78 and len(rows[1]["stats"]) == 72
    assert math.isnan(rows[2]["cov"][0])


def test_spread_far_from_zero(spark):
    # a raw sum of squares would lose the spread entirely
    segs = _segs(spark, [(1, k, [1e8 + v, 2e8 - v]) for k, v in enumerate([1.0, 2.0, 3.0])])
    row = SG.segment_arrays(segs).first()
    assert row["stats"][4] == pytest.approx(0.816496580927726)
    assert row["cov"][0] == pytest.approx(1.0) and row["cov"][1] == pytest.approx(-1.0)


def test_empty_matrix_gives_zeros(spark):
    segs = _segs(spark, [(1, 0, [1.0])])
    ids = spark.createDataFrame([(1,), (2,)], "song_id long")
    rows = {r["song_id"]: r for r in SG.with_empty(ids, SG.segment_arrays(segs)).collect()}
    assert rows[2]["stats"] == [0.0] * 72 and rows[2]["cov"] == [0.0] * 78


def _random_segs(spark):
    import random
    rng = random.Random(3)
    return {sid: [[float(rng.randint(-9, 9)) for _ in range(12)] for _ in range(n)]
            for sid, n in [(1, 1), (2, 2), (3, 7), (4, 40), (5, 41)]}


def test_segment_statistics_whatever_the_song_length(spark, monkeypatch):
    # songs over the limit are spread over tasks, the others stay together: same numbers
    import statistics
    monkeypatch.setattr(SG, "SONG_ROWS", 10)
    songs = _random_segs(spark)
    segs = _segs(spark, [(sid, k, v) for sid, vs in songs.items() for k, v in enumerate(vs)]
                 + [(None, 0, [1.0])])
    wanted = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 9, 9)], "song_id long")
    both = SG.record_arrays(segs, {"x": ("s", "c"), "p": ("ps", "pc")}, {"p": lambda x: x % 12.0}, wanted)
    got = {r["song_id"]: r for r in both.collect()}
    assert songs.pop(5) and set(got) == set(songs)
    for sid, vs in songs.items():
        for st, cv, dims in [("s", "c", list(zip(*vs))), ("ps", "pc", [[math.fmod(v, 12) for v in d] for d in zip(*vs)])]:
            for i, d in enumerate(dims):
                want = [statistics.fmean(d), statistics.median(d), min(d), max(d), statistics.pstdev(d), len(d)]
                assert got[sid][st][6 * i:6 * i + 6] == pytest.approx(want)
            if len(vs) > 1:
                assert got[sid][cv] == pytest.approx([statistics.covariance(dims[i], dims[j]) for i, j in SG.PAIRS])


def test_segments_are_shuffled_once_and_never_by_value(spark):
    segs = _segs(spark, [(sid, k, v) for sid, vs in _random_segs(spark).items() for k, v in enumerate(vs)])
    ids = spark.createDataFrame([(1,), (9,)], "song_id long")
    plan = SG.with_empty(ids, SG.segment_arrays(segs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2         # the segments, the ids
    assert "Generate" not in plan


@pytest.mark.parametrize("limit", [1 << 14, 10])
def test_song_rows_get_the_arrays_of_their_segments(spark, monkeypatch, limit):
    # batches of three rows cut the songs; rows of songs that come twice, have no id or no segment
    import statistics
    monkeypatch.setattr(SG, "SONG_ROWS", limit)
    songs = _random_segs(spark)
    segs = _segs(spark, [(sid, k, v) for sid, vs in songs.items() for k, v in enumerate(vs)] + [(None, 0, [1.0])])
    asked = [(1, "a"), (3, "b"), (3, "b"), (4, None), (9, "c"), (None, "d"), (5, "e"), (5, "f")]
    rows = spark.createDataFrame(asked, "song_id long, `a name` string")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        out = SG.song_arrays(segs, {"x": ("s", "c"), "p": ("ps", "pc")}, {"p": lambda x: x % 12.0}, rows)
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert out.columns == ["song_id", "a name", "s", "c", "ps", "pc"]
    assert sorted(map(str, [tuple(r)[:2] for r in got])) == sorted(map(str, asked))
    for r in got:
        vs = songs.get(r["song_id"])
        if vs is None:
            assert r["s"] == [0.0] * 72 == r["ps"] and r["c"] == [0.0] * 78 == r["pc"]
            continue
        for st, cv, dims in [("s", "c", list(zip(*vs))), ("ps", "pc", [[math.fmod(v, 12) for v in d] for d in zip(*vs)])]:
            for i, d in enumerate(dims):
                want = [statistics.fmean(d), statistics.median(d), min(d), max(d), statistics.pstdev(d), len(d)]
                assert r[st][6 * i:6 * i + 6] == pytest.approx(want)
            want = [statistics.covariance(dims[i], dims[j]) if len(vs) > 1 else math.nan for i, j in SG.PAIRS]
            assert r[cv] == pytest.approx(want, nan_ok=True)


def test_record_arrays_are_never_shuffled_or_made_by_windows(spark):
    from songgraph.operators import features as FT
    plan = FT.song_records(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("REPARTITION_BY_COL") == 1
    assert plan.index("MapInArrow") < plan.index("Exchange")            # nothing moves after it


def test_feature_profile_is_that_of_plain_aggregates(spark):
    from songgraph.operators import features as FT
    nan, inf = math.nan, math.inf
    odd = [[1.0, nan, None], [None, None, None], [nan, nan, nan], [inf, -1.0, 2.5], [-0.5, None, 4.0]]
    cols = [F.lit(float(k)).alias(c) for k, c in enumerate(FT.FEATURE_COLS[5:])]
    df = spark.createDataFrame([(k, *v) for k, v in enumerate(zip(*odd))], "id int, " + ", ".join(f"{c} double" for c in FT.FEATURE_COLS[:5])) \
        .repartition(2).select("*", *cols)
    got = {r["feature"]: r for r in FT.feature_profile(df).collect()}
    assert [got[c]["idx"] for c in FT.FEATURE_COLS] == list(range(313))
    want = df.agg(*[f(c).alias(f"{c}_{k}") for c in FT.FEATURE_COLS[:8] for k, f in enumerate((F.sum, F.min, F.max))]).first()
    for c in FT.FEATURE_COLS[:8]:
        assert got[c]["n"] == 3
        assert str([got[c][x] for x in ("total", "lo", "hi")]) == str([want[f"{c}_{k}"] for k in range(3)])
    none = FT.feature_profile(df.limit(0)).collect()
    assert len(none) == 313 and {(r["n"], r["total"], r["lo"], r["hi"]) for r in none} == {(0, None, None, None)}


def test_year_model_reads_records_of_scored_songs_only(spark):
    from songgraph.operators import features as FT
    sf = "/root/testdata/sf0.001"
    songs, asked = A.songs(spark, sf), []

    def records(some):
        asked.append({r["song_id"] for r in some.select("song_id").collect()})
        return FT.song_records(spark, sf, some)

    whole = {r["song_id"]: r for r in FT.song_records(spark, sf).select("song_id", "segments_pitches", "pitch_cov").collect()}
    model = Y.train(songs, 300, records, maxIter=3, maxDepth=2)
    Y.evaluate(model, songs, records)
    Y.impute(songs, model, records)
    held = {r["song_id"] for r in Y.held_out(songs).collect()}
    missing = {r["song_id"] for r in songs.where("year is null or year = 0").collect()}
    assert asked[1:] == [held, missing] and not asked[0] & (held | missing)
    some = FT.song_records(spark, sf, songs.where("song_id < 20")).select("song_id", "segments_pitches", "pitch_cov").collect()
    assert len(some) == len([i for i in whole if i < 20])
    assert all(str(r) == str(whole[r["song_id"]]) for r in some)


def test_matrix_form_pads_short_and_null_rows(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0], None, [3.0]])],
                               "id long, m array<array<double>>")
    long = SG.explode_matrix(df, "id", "m").orderBy("seg").collect()
    assert [r["x0"] for r in long] == [1.0, 0.0, 3.0]
    assert [r["x1"] for r in long] == [2.0, 0.0, 0.0]


@pytest.mark.parametrize("year,expected", [
    (2006, 1.0), (2001, 0.6065306597), (2011, 0.6065306597), (1996, 0.1353352832),
    (0, 0.0), (None, -1e9)])
def test_nostalgia_score(spark, year, expected):
    df = spark.createDataFrame([(year,)], "year int")
    got = df.select(nostalgia_score("year", F.lit(1990)).alias("s")).first()["s"]
    assert got == pytest.approx(expected, abs=1e-10)


def test_score_underflow_band(spark):
    # the fallback relies on: |year - peak| > 200  ->  exactly 0.0
    df = spark.createDataFrame([(2006 + d,) for d in (193, 194, 201, -201)], "year int")
    got = [r["s"] for r in df.select(nostalgia_score("year", F.lit(1990)).alias("s")).collect()]
    assert got[0] > 0.0 and got[1:] == [0.0, 0.0, 0.0]


def _graph(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("a", "e"), ("e", "d"),
             ("b", "a"), ("x", "x"), ("y", "z")]   # duplicate, self-loop, island
    return G.symmetrize(spark.createDataFrame(edges, "target string, similar string"))


def _roots(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "root string")


def test_bfs_true_levels(spark):
    got = {(r["v"], r["degree"]) for r in G.bfs(_graph(spark), _roots(spark, "a"), 3).collect()}
    assert got == {("b", 1), ("e", 1), ("c", 2), ("d", 2)}


def test_bfs_single_as_coded(spark):
    walks = G.bfs(_graph(spark), _roots(spark, "a"), 3, mode="walk")
    got = {(r["v"], r["degree"]) for r in G.min_degree(walks).collect()}
    assert got == {("b", 1), ("e", 1), ("c", 2), ("d", 2), ("a", 2)}


def test_cache_as_coded(spark):
    walks = G.bfs(_graph(spark), _roots(spark, "a"), 3, mode="walk")
    got = sorted((r["degree"], r["v"]) for r in walks.collect())
    assert got == [(1, "b"), (1, "e"), (2, "a"), (2, "c"), (2, "d"),
                   (3, "b"), (3, "c"), (3, "d"), (3, "e")]


def test_nearest_ties_by_id(spark):
    paths = G.bfs(_graph(spark), _roots(spark, "a"), 3)
    got = [(r["v"], r["degree"]) for r in G.nearest(paths, 3).orderBy("rank").collect()]
    assert got == [("b", 1), ("e", 1), ("c", 2)]


def test_unknown_root_and_depth_zero(spark):
    assert G.bfs(_graph(spark), _roots(spark, "nobody"), 3).count() == 0
    assert G.bfs(_graph(spark), _roots(spark, "a"), 0).count() == 0


def test_self_loop_and_island(spark):
    got = {(r["root"], r["v"]) for r in G.bfs(_graph(spark), _roots(spark, "x", "y"), 3).collect()}
    assert got == {("y", "z")}


def test_bfs_matches_unpruned_min_degree(spark):
    """Pruning with the last two levels equals min over all walks."""
    sym = _graph(spark)
    roots = G.vertices(sym).select(F.col("v").alias("root"))
    bfs = {tuple(r) for r in G.bfs(sym, roots, 3).select("root", "v", "degree").collect()}
    walks = G.bfs(sym, roots, 3, mode="walk").where(F.col("v") != F.col("root"))
    ref = {tuple(r) for r in G.min_degree(walks).select("root", "v", "degree").collect()}
    assert bfs == ref


def test_sample_roots_exact_size_and_stable(spark):
    verts = G.vertices(_graph(spark))
    a = [r["root"] for r in G.sample_roots(verts, 3, seed=7).collect()]
    b = [r["root"] for r in G.sample_roots(verts, 3, seed=7).collect()]
    assert len(a) == 3 and a == b


def test_serving_roundtrip(spark, tmp_path):
    paths = G.bfs(_graph(spark), _roots(spark, "a", "y"), 3)
    S.write_serving_table(paths, str(tmp_path / "t"))
    t = S.read_serving_table(spark, str(tmp_path / "t"))
    got = [(r["v"], r["degree"]) for r in S.lookup(t, "a", 3).orderBy("rank").collect()]
    assert got == [("b", 1), ("e", 1), ("c", 2)]
    assert S.lookup(t, "nobody", 3).count() == 0
    js = S.recs_json(paths.where(F.col("root") == "a"), chunk=3).orderBy("chunk_no").collect()
    assert [tuple(r) for r in js] == [("artist:a:recs", 0, '[["b",1],["e",1],["c",2]]'),
                                      ("artist:a:recs", 1, '[["d",2]]')]
    back = S.parse_recs(spark.createDataFrame(js), id_type="string", chunk=3).orderBy("pos").collect()
    assert [(r["pos"], r["v"], r["degree"]) for r in back] == [(1, "b", 1), (2, "e", 1), (3, "c", 2), (4, "d", 2)]


def test_percentage_counts_null_in_denominator(spark):
    df = spark.createDataFrame([(0,), (0,), (1999,), (None,)], "year int")
    assert explore.missing_year_pct(df).first()["pct_missing"] == 50.0


def test_profile_counts(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (0.0, "b"), (None, "c")],
                               "h double, s string")
    rows = {r["column_name"]: r for r in explore.profile(df).collect()}
    assert (rows["h"]["n_null"], rows["h"]["n_nan"], rows["h"]["n_zero"]) == (1, 1, 1)
    assert rows["s"]["n_null"] == 1 and rows["s"]["n_rows"] == 4


def _songs(spark):
    # artist a1 -> similar a2 (songs), a3 (no songs); a9 isolated
    rows = [(1, "a1", "s1", 1990), (2, "a2", "s2", 2006), (3, "a2", "s3", 2001),
            (4, "a2", "s4", None), (5, "a9", "s5", 2006), (6, "a4", "s6", 0),
            (7, "a5", "s7", 2005)]
    return spark.createDataFrame(rows, "song_id long, artist_id string, title string, year int") \
        .withColumn("artist_name", F.concat(F.lit("N-"), "artist_id"))


def _paths(spark):
    sym = G.symmetrize(spark.createDataFrame(
        [("a1", "a2"), ("a1", "a3"), ("a6", "a3"), ("a5", "a4")], "target string, similar string"))
    verts = G.vertices(sym).select(F.col("v").alias("root"))
    return G.bfs(sym, verts, 3)


def _requests(spark):
    rows = [(1, 1, None, 2, 1990),      # song of a1 -> similar a2 has songs
            (2, 99, None, 2, 1990),     # unknown song
            (3, None, "a9", 1, 1990),   # artist without neighbours -> fallback
            (4, None, "a6", 3, 1990),   # neighbours (a3, a1, a2...) reach songs
            (5, 6, None, 1, 1990)]      # a4 -> a5 has one song
    return spark.createDataFrame(rows, "req_id long, song_id long, artist_id string, "
                                       "top_k int, birth_year int")


def test_recommend_paths(spark):
    out = R.recommend(_requests(spark), _songs(spark), _paths(spark))
    got = {}
    for r in out.orderBy("req_id", "rank").collect():
        got.setdefault(r["req_id"], []).append((r["song_id"], r["source"]))
    assert got[1] == [(2, "similar"), (3, "similar")]
    assert 2 not in got
    assert got[3] == [(2, "fallback")]          # best overall: year 2006, smallest id
    assert got[5] == [(7, "similar")]
    status = {r["req_id"]: r["status"] for r in
              R.request_status(R.resolve(_requests(spark), _songs(spark))).collect()}
    assert status[2] == "unknown_song" and status[1] == "ok"


def test_requests_without_birth_year_or_usable_top_k(spark):
    req = spark.createDataFrame([(1, 1, None, 2, None), (2, 1, None, 0, 1990), (3, 1, None, None, 1990),
                                 (4, 1, None, 2, 1990)],
                                "req_id long, song_id long, artist_id string, top_k int, birth_year int")
    out = [tuple(r) for r in R.recommend(req, _songs(spark), _paths(spark))
           .select("req_id", "rank", "song_id").orderBy("req_id", "rank").collect()]
    assert [r[1:] for r in out if r[0] == 1] == [r[1:] for r in out if r[0] == 4] != []
    assert {r[0] for r in out} == {1, 4}
    status = {r["req_id"]: r["status"] for r in R.resolve(req, _songs(spark)).collect()}
    assert status == {1: "ok", 2: "bad_top_k", 3: "bad_top_k", 4: "ok"}


def test_recommend_with_repeated_song_ids(spark):
    songs = _songs(spark)
    req = _requests(spark)
    once = R.recommend(req, songs, _paths(spark)).orderBy("req_id", "rank").collect()
    twice = R.recommend(req, songs.union(songs).union(songs), _paths(spark)).orderBy("req_id", "rank").collect()
    assert once == twice


def test_first_of_and_clean_key(spark):
    from songgraph.functions.scalar import clean_key, first_of
    df = spark.createDataFrame([([1.5, 2.0], 3.0, "x", "  Ab "), ([], None, "7", " ")],
                               "a array<double>, b double, c string, d string")
    got = df.select(first_of(df, "a"), first_of(df, "b"), first_of(df, "c"), clean_key("d")).collect()
    assert [tuple(r) for r in got] == [(1.5, 3.0, None, "ab"), (None, None, 7.0, None)]


def test_fallback_matches_brute_force(spark):
    songs = _songs(spark)
    by = spark.createDataFrame([(1990,), (1800,), (2400,)], "birth_year int")
    fast = {(r["birth_year"], r["rank"], r["song_id"])
            for r in R.fallback_ranked(by, songs, 4).collect()}
    brute = set()
    for b in (1990, 1800, 2400):
        sc = songs.select("song_id", nostalgia_score("year", F.lit(b)).alias("score")) \
                  .orderBy(F.col("score").desc(), "song_id").limit(4).collect()
        brute |= {(b, i + 1, r["song_id"]) for i, r in enumerate(sc)}
    assert fast == brute


def test_fallback_tail_and_large_top_k(spark):
    """Birth years far from every song, more songs asked for than there are, and a
    mixture of dated, undated and equally far songs."""
    import random
    rnd = random.Random(5)
    rows = [(i, f"a{i % 5}", f"t{i}", rnd.choice([None, 0, 1200, 1500, 1693, 1694, 1695, 1999, 2006, 2007, 2200, 2201]))
            for i in rnd.sample(range(1000), 120)]
    songs = spark.createDataFrame(rows, "song_id long, artist_id string, title string, year int")
    births = (1990, 1484, 2184, 900, 5000)
    by = spark.createDataFrame([(b,) for b in births], "birth_year int")
    score = {b: {r["song_id"]: r["score"] for r in songs.select(
        "song_id", nostalgia_score("year", F.lit(b)).alias("score")).collect()} for b in births}
    for kf in (1, 7, 60, 119, 500, 1_000_000):
        got = {}
        for r in R.fallback_ranked(by, songs, kf).collect():
            got.setdefault(r["birth_year"], {})[r["rank"]] = r["song_id"]
        for b in births:
            want = sorted(score[b], key=lambda i: (-score[b][i], i))[:kf]
            assert [got[b][k + 1] for k in range(len(got[b]))] == want, (kf, b)


def test_typed_requests(spark):
    typed = spark.createDataFrame([(1, " 1 ", "2", "1990"), (2, "QUIT", "x", None), (3, "1", "two", "1990"),
                                   (4, "song", "2", "1990"), (5, None, "2", "1990"), (6, "1", " 3", " 1985 ")],
                                  "req_id long, song_id string, top_k string, birth_year string")
    got = {r["req_id"]: r for r in R.parse_typed(typed, _songs(spark)).collect()}
    assert {k: r["typed"] for k, r in got.items()} == {1: "ok", 2: "quit", 3: "invalid_input", 4: "invalid_input",
                                                       5: "invalid_input", 6: "ok"}
    assert (got[1]["song_id"], got[6]["top_k"], got[6]["birth_year"]) == (1, 3, 1985)


def test_impute_keeps_rows_and_valid_years(spark):
    rows = [(i, "a", 1990 + i % 5 if i % 3 else 0, 200.0 + i) for i in range(30)]
    songs = spark.createDataFrame(rows, "song_id long, artist_id string, year int, duration double")
    preds = Y.artist_mean_predictions(songs)
    merged = Y.merge_predictions(songs, preds)
    assert merged.count() == 30
    before = {r["song_id"]: r["year"] for r in songs.collect() if r["year"]}
    after = {r["song_id"]: r["year"] for r in merged.collect()}
    assert all(after[k] == v for k, v in before.items())
    assert all(v != 0 for v in after.values())


def test_hash_split_stable_under_column_order(spark):
    df = spark.range(1000).withColumnRenamed("id", "song_id").withColumn("x", F.rand(1))
    a, _ = Y.hash_split(df)
    b, _ = Y.hash_split(df.select("x", "song_id"))
    assert {r[0] for r in a.select("song_id").collect()} == \
           {r[0] for r in b.select("song_id").collect()}
    assert 700 < a.count() < 900
    null = df.limit(1).withColumn("song_id", F.lit(None).cast("long"))
    parts = Y.hash_split(null)
    assert (parts[0].count(), parts[1].count()) == (0, 1)


def test_scan_dir_suffix_and_corrupt_files(spark, tmp_path):
    from songgraph.sources import files as FS
    root = tmp_path / "land"
    spark.range(10).write.parquet(str(root / "a" / "b"))
    (root / "a" / "broken.parquet").write_bytes(b"not parquet at all")
    (root / "readme.txt").write_text("x")
    df = FS.scan_dir(spark, str(root), ".parquet", schema="id long")
    assert sorted(r["id"] for r in df.collect()) == list(range(10))


def test_rejects_keep_bad_records(spark, tmp_path):
    from pyspark.sql import types as T
    from songgraph.sources import files as FS
    p = tmp_path / "r.json"
    p.write_text('{"a": 1}\n{broken\n{"a": 3}\n')
    good, bad = FS.read_with_rejects(spark, str(p), T.StructType([T.StructField("a", T.LongType())]))
    assert sorted(r["a"] for r in good.collect()) == [1, 3]
    assert [r["raw_record"] for r in bad.collect()] == ["{broken"]


def test_compact_packs_files_without_a_shuffle(spark, tmp_path):
    from songgraph.sources import files as FS
    src = str(tmp_path / "src")
    spark.range(1000).repartition(20).write.parquet(src)
    (tmp_path / "src" / "broken.parquet").write_bytes(b"not parquet at all")
    files = FS.listing(spark, src, ".parquet").collect()
    assert len(files) == 21
    total = sum(f["length"] for f in files)

    def written(**kw):
        out = str(tmp_path / f"o{len(kw)}-{kw.get('target_file_bytes', 0)}")
        n = FS.compact(spark, src, out, schema="id long", **kw).count()
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(1000))
        return n
    assert written() == 1 and written(single_file=True, target_file_bytes=1000) == 1
    assert 4 <= written(target_file_bytes=total // 4) <= 8
    assert written(target_file_bytes=1000) >= 15
    plan = FS.scan_dir(FS.packing_session(spark, total), src, ".parquet", schema="id long")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "1"      # the caller's session is as it was


def test_audit_names_every_unreadable_file(spark, tmp_path):
    from songgraph.sources import files as FS
    root = tmp_path / "la nd+1"
    spark.range(10).repartition(2).write.parquet(str(root / "a b" / "k=x%y"))
    (root / "broken.parquet").write_bytes(b"not parquet at all")
    (root / "empty.parquet").write_bytes(b"")
    good = sorted((root / "a b" / "k=x%y").glob("*.parquet"))
    cut = good[0].read_bytes()
    (root / "cut.parquet").write_bytes(cut[: len(cut) // 2])
    (root / "note.txt").write_text("no part of the scan")
    got = {r["path"].rsplit("/", 1)[-1]: r for r in FS.audit(spark, str(root), ".parquet", schema="id long").collect()}
    assert {k: r["reason"] for k, r in got.items() if r["reason"]} == {
        "broken.parquet": "no readable rows", "cut.parquet": "no readable rows"}
    assert sum(r["n_rows"] for r in got.values()) == 10 and len(got) == 2 + len(good)
    assert all(got[f.name]["length"] == f.stat().st_size and got[f.name]["checksum"] is not None for f in good)
    bad = FS.rejects(FS.audit(spark, str(root), ".parquet", schema="id long"))
    assert bad.count() == 2 and bad.columns == ["path", "length", "reason"]


def test_workspace_reads_by_extension(spark, tmp_path):
    from songgraph.operators.explore_sql import Workspace, query
    spark.range(5).selectExpr("id", "id * 1.5 as x").coalesce(1).write.option("header", "true").csv(str(tmp_path / "w" / "t.csv"))
    spark.range(5).selectExpr("id", "concat('n', id) as name").write.json(str(tmp_path / "w" / "plain"))
    spark.range(3).write.parquet(str(tmp_path / "p.parquet"))
    space = Workspace(spark, {"w": str(tmp_path / "w")}, {"w": "json"}, schemas={"w:t.csv": "id long, x double"})
    got = space.query("select name, x from {a} join {b} using (id) where id > 2", a="w:t.csv", b="w:plain")
    assert sorted(tuple(r) for r in got.collect()) == [("n3", 4.5), ("n4", 6.0)]
    assert query(spark, "select count(*) as n from {p}", p=str(tmp_path / "p.parquet")).first()["n"] == 3
    assert dict(Workspace(spark, {"w": str(tmp_path / "w")}).table("w:t.csv").dtypes) == {"id": "string", "x": "string"}
    for bad in ("w:t.hdf5", "nowhere/t"):
        with pytest.raises(ValueError, match="no format"):
            Workspace(spark, {"w": "x"}).table(bad)


def test_range_predicates_cover_every_key_once():
    import sqlite3
    from songgraph.sources.jdbc import bounds_query, literal, range_predicates
    con = sqlite3.connect(":memory:")
    keys = [f"AR{i * 37 % 101:03d}'x" for i in range(400)] + [None] * 7 + ["hot"] * 300
    con.execute("create table similarity (target text)")
    con.executemany("insert into similarity values (?)", [(k,) for k in keys])
    for parts in (1, 2, 5, 16):
        shares = con.execute("select * from " + bounds_query("similarity", "target", parts)).fetchall()
        where = range_predicates("target", [b for _, b in sorted(shares)])
        counts = [con.execute(f"select count(*) from similarity where {w}").fetchone()[0] for w in where]
        assert sum(counts) == len(keys) and len(where) <= parts
        assert max(counts) <= 300 + len(keys) // parts + 7       # a share and at most one hot key
    assert range_predicates("k", []) == ["1 = 1"] and literal("O'Neil") == "'O''Neil'" and literal(7) == "7"


def test_scratch_tables_go_and_kept_ones_stay(spark):
    import os
    from songgraph.session import ensure_checkpoint_dir, materialize, scratch
    base = ensure_checkpoint_dir(spark).replace("file:", "")

    def left():
        return {n for n in os.listdir(base) if n.split("-")[0] in ("one", "two", "three", "out")}
    before = left()
    with scratch(spark) as outer:
        with scratch(spark) as own:
            one = materialize(spark.range(3), "one")
            two = materialize(one.selectExpr("id + 1 as id"), "two")
            own.free(one)
            assert {n.split("-")[0] for n in left() - before} == {"two"}
            kept = own.keep(two)                         # handed over, not written again
            lazy = own.keep(two.where("id > 1"), "three")
        assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3] and lazy.count() == 2
        out = outer.keep(lazy.union(kept), "out")
    assert {n.split("-")[0] for n in left() - before} == {"out"} and out.count() == 5
    with pytest.raises(RuntimeError), scratch(spark):
        materialize(spark.range(3), "one")
        raise RuntimeError
    assert {n.split("-")[0] for n in left() - before} == {"out"}


def test_queries_leave_one_folder(spark):
    """Every intermediate table of a query is gone when it returns."""
    import os
    from songgraph.plans.registry import QUERIES
    from songgraph.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    for name in ("recommend_batch", "recommend_fallback", "recommend_stream", "cache_lookup", "segment_stats",
                 "compact_songs", "ingest_rejects", "bfs_multi", "sql_by_path"):
        before = set(os.listdir(base))
        QUERIES[name](spark, "/root/testdata/sf0.001").count()
        assert len(set(os.listdir(base)) - before) == 1, (name, set(os.listdir(base)) - before)


def test_readers_never_see_half_a_table(spark, tmp_path):
    import threading
    path = str(tmp_path / "served")
    spark.range(100).selectExpr("id % 7 as root", "id as v", "1 as degree").createOrReplaceTempView("first_paths")
    with pytest.raises(FileNotFoundError):
        S.read_serving_table(spark, path)
    S.write_serving_table(spark.table("first_paths"), path, n_buckets=4)
    old = S.read_serving_table(spark, path)
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            seen.add(S.read_serving_table(spark, path).count())
    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (200, 300):
            S.write_serving_table(spark.range(n).selectExpr("id % 7 as root", "id as v", "1 as degree"), path, n_buckets=4)
            if n == 200:
                assert old.count() == 100        # a reader on the version before is undisturbed
    finally:
        stop.set()
        reader.join()
    assert seen <= {100, 200, 300} and S.read_serving_table(spark, path).count() == 300
    # a writer that died: its folder is not read, and goes with the next version
    spark.range(5).selectExpr("id as root", "id as v", "1 as degree", "0 as bucket").write.parquet(f"{path}/v0000000002-dead")
    assert S.read_serving_table(spark, path).count() == 300
    S.write_serving_table(spark.table("first_paths"), path, n_buckets=4)
    S.write_serving_table(spark.table("first_paths"), path, n_buckets=4)
    left = [n.name for n in tmp_path.joinpath("served").iterdir() if n.name.startswith("v")]
    assert len(left) == 2 == len(S.versions(spark, path))


def test_read_songs_conforms_schema(spark, tmp_path):
    from songgraph.schema import SONG
    from songgraph.sources import files as FS
    spark.createDataFrame([("s1", 1999)], "song_id string, year int") \
        .write.parquet(str(tmp_path / "s"))
    df = FS.read_songs(spark, str(tmp_path / "s"))
    assert df.schema == SONG
    assert df.first()["song_id"] == "s1" and df.first()["artist_id"] is None
    # a record table that keeps its scalars as one-element arrays
    spark.createDataFrame([("s1", [1999], [121.5, 7.0], [])], "song_id string, year array<int>, tempo array<double>, "
                          "loudness array<double>").write.parquet(str(tmp_path / "r"))
    one = FS.read_songs(spark, str(tmp_path / "r"))
    assert one.schema == SONG and tuple(one.select("song_id", "year", "tempo", "loudness").first()) == ("s1", 1999, 121.5, None)


def test_model_save_load_and_impute_invariants(spark, tmp_path):
    import json
    from songgraph.functions.scalar import valid_year
    from songgraph.operators import features as FT
    recs = FT.song_records(spark, "/root/testdata/sf0.001").cache()
    model = Y.train(recs, maxIter=12, maxDepth=3, stepSize=0.3)
    path = str(tmp_path / "m")
    Y.save_model(model, path)
    loaded = Y.load_model(path)
    out = Y.impute(recs, loaded)
    assert out.count() == recs.count() and out.columns == recs.columns
    before = {r["song_id"]: r["year"] for r in recs.where(valid_year("year")).collect()}
    after = {r["song_id"]: r["year"] for r in out.collect()}
    assert all(after[k] == v for k, v in before.items())
    assert sum(1 for v in after.values() if v is None or v == 0) == 0
    # the line items' dates give the year away: far better than the mean
    m = Y.evaluate(loaded, recs).first()
    years = [r["year"] for r in Y.held_out(recs).select("year").collect()]
    mean = sum(years) / len(years)
    assert m["n"] == len(years) and m["rmse"] < 0.7 * math.sqrt(sum((y - mean) ** 2 for y in years) / len(years))
    # a manifest of another feature order is refused
    lines = [json.loads(x) for f in (tmp_path / "m" / "manifest").glob("*.json") for x in f.read_text().splitlines()]
    for r in lines:
        if r["name"] == "features":
            r["value"] = json.dumps(json.loads(r["value"])[::-1])
    spark.createDataFrame([(r["name"], r["value"]) for r in lines], "name string, value string") \
        .write.mode("overwrite").json(path + "/manifest")
    with pytest.raises(ValueError, match="features"):
        Y.load_model(path)


def test_feature_vector_equals_flattened_columns(spark):
    from songgraph.operators import features as FT
    recs = FT.song_records(spark, "/root/testdata/sf0.001").limit(40)
    odd = recs.limit(1).select("*").withColumns({
        "song_id": F.lit(-1).cast("long"), "segments_timbre": F.array(F.lit(1.0), F.lit(None).cast("double")),
        "timbre_cov": F.lit(None).cast("array<double>"), "duration": F.lit(-5.0), "tempo": F.lit(float("nan"))})
    df = recs.unionByName(odd)
    flat = {r["song_id"]: [r[c] for c in FT.FEATURE_COLS] for r in FT.flatten(df, ["song_id"]).collect()}
    vecs = {r["song_id"]: list(r["features"].toArray()) for r in FT.with_vector(df).select("song_id", "features").collect()}
    assert vecs == flat and len(vecs) == 41


def test_fitting_rows_are_thinned_by_hash(spark):
    from songgraph.operators import features as FT
    recs = FT.song_records(spark, "/root/testdata/sf0.001").cache()
    whole = {r["song_id"] for r in Y.fitting_rows(recs, None).collect()}
    some = {r["song_id"] for r in Y.fitting_rows(recs, 100).collect()}
    tests = {r["song_id"] for r in Y.held_out(recs).collect()}
    assert some < whole and 50 < len(some) < 150 and not whole & tests
    assert whole | tests == {r["song_id"] for r in Y.training_rows(recs).collect()}


def test_year_model_is_fitted_on_the_whole_training_part(spark, monkeypatch):
    from songgraph.operators import features as FT
    many = spark.range(30_000).select(F.col("id").alias("song_id"), (1970 + F.col("id") % 40).cast("int").alias("year"),
                                      F.array(F.lit(0.0)).alias("segments_timbre"), F.array(F.lit(0.0)).alias("segments_pitches"),
                                      F.array(F.lit(0.0)).alias("timbre_cov"), F.array(F.lit(0.0)).alias("pitch_cov"),
                                      F.lit(1.0).alias("duration"), F.lit(1.0).alias("tempo"))
    monkeypatch.setattr(Y, "with_vector", lambda df: df.withColumn("features", FT.array_to_vector(F.array("duration"))))
    wanted = Y.hash_split(Y.training_rows(many))[0].count()
    assert wanted > 23_000 and Y.fitting_rows(many).count() == wanted
    fitted = []
    monkeypatch.setattr(Y.GBTRegressor, "fit", lambda self, df: fitted.append(df.count()))
    Y.train(many)
    assert fitted == [wanted]


def test_fitting_partitions_do_not_outnumber_the_tasks_run_at_once():
    # each sends the histograms of all nodes in every pass, and is kept or dropped as a whole
    assert [Y.fitting_partitions(n, 6) for n in (0, 5_000, 12_000, 60_000, 290_000, 3_600_000)] == [1, 1, 3, 6, 6, 72]


def _star(spark):
    # hub h linked to 40 leaves, leaves linked in a ring, a self-loop at the hub
    edges = [("h", f"l{i}") for i in range(40)] + [(f"l{i}", f"l{(i + 1) % 40}") for i in range(40)] + [("h", "h")]
    return G.symmetrize(spark.createDataFrame(edges, "target string, similar string"))


def test_bfs_salts_grow_with_the_degree(spark):
    sym = _star(spark)
    roots = G.vertices(sym).select(F.col("v").alias("root"))
    edges = G.prepare_edges(sym, 5)
    assert edges.where("src = 'h'").select("salts").distinct().collect()[0][0] == 9
    assert edges.groupBy("src", "salt").count().agg(F.max("count")).first()[0] < 20
    plain = {tuple(r) for r in G.bfs(sym, roots, 3).select("root", "v", "degree").collect()}
    salted = {tuple(r) for r in G.bfs(edges, roots, 3).select("root", "v", "degree").collect()}
    assert plain == salted


@pytest.mark.parametrize("n", [1, 3])
def test_nearest_bfs_equals_nearest_of_whole_bfs(spark, n):
    edges = [(f"a{i}", f"a{(i * 7 + 3) % 30}") for i in range(30)] + \
            [(f"a{i}", f"a{(i + 1) % 30}") for i in range(30)]
    sym = _star(spark).union(G.symmetrize(spark.createDataFrame(edges, "target string, similar string")))
    roots = G.vertices(sym).select(F.col("v").alias("root"))
    full = sorted(tuple(r) for r in G.nearest(G.bfs(sym, roots, 3), n).select("root", "v", "degree", "rank").collect())
    cut = sorted(tuple(r) for r in G.nearest_bfs(sym, roots, n, 3).select("root", "v", "degree", "rank").collect())
    assert full == cut


def _bracketed(spark, groups):
    """(g, x) rows with the ends and size of their group, as ``exact_medians`` reads them."""
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs]
    vals = spark.createDataFrame(rows, "g long, x double").repartition(7)
    ends = vals.groupBy("g").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"))
    return vals.join(ends, "g")


def test_medians_by_brackets_equal_sorting(spark):
    import random
    import statistics
    from songgraph.operators.quantiles import exact_medians, order_statistics
    rnd = random.Random(7)
    groups = {0: [3.5], 1: [2.0, -1.0], 2: [rnd.gauss(0, 3) for _ in range(57)],
              3: [rnd.choice([1.0, 2.0, 7.0]) for _ in range(400)],
              4: [rnd.gauss(0, 1) for _ in range(5000)],
              5: [10.0 ** rnd.uniform(-300, 300) for _ in range(301)],     # far from evenly spread
              6: [1e9 + 1e-6 * i for i in range(1000)], 7: [5.0] * 999 + [6.0],
              8: [-1.7e308, 1.7e308, 1.0, 2.0], 9: [0.0, -0.0, 0.0]}
    rows = _bracketed(spark, groups)
    got = {r["g"]: r["m"] for r in exact_medians(rows, ["g"], "x", out="m").collect()}
    assert got == {g: statistics.median(xs) for g, xs in groups.items()}
    for r in (1, 2, 57, 400):
        ranks = rows.where(F.col("n") >= r).withColumns({"r": F.lit(r).cast("long"), "two": F.lit(False)})
        got = {x["g"]: x["first"] for x in order_statistics(ranks.select("g", "x", "lo", "hi", "r", "two"), ["g"], "x").collect()}
        assert got == {g: sorted(xs)[r - 1] for g, xs in groups.items() if len(xs) >= r}


def test_medians_with_infinities_and_nan(spark):
    from songgraph.operators.quantiles import exact_medians
    inf, nan = float("inf"), float("nan")
    groups = {1: [-inf, 1.0, 2.0, 3.0, inf], 2: [nan, nan, 4.0], 3: [1.0, 2.0, nan], 4: [-inf, -inf, 5.0],
              5: [float(i) for i in range(200)] + [nan, inf, -inf]}
    got = {r["g"]: r["m"] for r in exact_medians(_bracketed(spark, groups), ["g"], "x", out="m").collect()}
    assert (got[1], got[3], got[4]) == (2.0, 2.0, -inf) and math.isnan(got[2]) and got[5] == 100.0


def test_serving_hot_root_long_ids(spark, tmp_path):
    # root 7 holds 80% of the rows; ids are bigint while the asked id is a
    # Python int: the lookup must hash it as the table's type
    paths = spark.range(4000).select(
        F.when(F.col("id") % 10 < 8, F.lit(7)).otherwise(F.col("id") % 100).alias("root"),
        F.col("id").alias("v"), (F.col("id") % 3 + 1).cast("int").alias("degree"))
    out = str(tmp_path / "serve")
    S.write_serving_table(paths, out)
    t = S.read_serving_table(spark, out)
    assert t.count() == 4000
    want = sorted((r["degree"], r["v"]) for r in paths.where("root = 7").collect())[:5]
    got = [(r["degree"], r["v"]) for r in S.lookup(t, 7, 5).orderBy("rank").collect()]
    assert got == want


def test_song_medians_with_nan_and_signed_zero(spark):
    nan = float("nan")
    rows = [(1, k, [v, -0.0 if k % 2 else 0.0]) for k, v in
            enumerate([3.0, nan, 1.0, nan, 2.0, 5.0])] + \
           [(2, k, [v]) for k, v in enumerate([nan, 4.0, nan])]
    got = {(r["song_id"], r["dim"]): r["median_v"] for r in SG.stats_long(_segs(spark, rows)).collect()}
    assert got[(1, 0)] == 4.0 and got[(1, 1)] == 0.0 and math.isnan(got[(2, 0)])


def test_similar_candidates_stay_with_their_anchor(spark):
    # a key's candidates are cut by year where they lie: nothing is shuffled by birth year after the join
    rng = range(60)
    songs = spark.createDataFrame([(i, i % 5, f"t{i}", [None, 0, 1994, 1999, 2004, 2014][i % 6]) for i in rng],
                                  "song_id long, artist_id long, title string, year int")
    paths = spark.createDataFrame([(r, v, 1) for r in range(5) for v in range(5) if r != v], "root long, v long, degree int")
    ok = spark.createDataFrame([(r, b) for r in (0, 1, 1, 9) for b in (1988, 1993, 1500)], "anchor_artist long, birth_year int")
    ranked = R.similar_ranked(ok, songs, paths, 17)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in next(line for line in plan.splitlines() if "Exchange" in line)
    got = {}
    for r in ranked.orderBy("rank").collect():
        got.setdefault((r["anchor_artist"], r["birth_year"]), []).append(r["song_id"])

    def score(y, b):
        return -1e9 if y is None else math.exp(-0.5 * ((y - b - 16) / 5.0) ** 2)

    rows = [tuple(r) for r in songs.collect()]
    want = {(a, b): [i for _, i in sorted((-score(y, b), i) for i, v, _, y in rows if v != a)[:17]]
            for a in (0, 1) for b in (1988, 1993, 1500)}
    assert got == want
