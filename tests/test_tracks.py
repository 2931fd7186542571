"""Golden cases and properties of smoothing, runs, summaries, linking, wells, and fits."""

from __future__ import annotations

import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.plans import joined_rows
from trackloom import params
from trackloom.functions import hill
from trackloom.functions import linker as linker_module
from trackloom.functions.linker import Linker, Options, OversizeError
from trackloom.operators import components, dose, events, images, linking, measure, quantiles, regions, smoothing, summarize, wells
from trackloom.plans import catalogue, views


def tracks(spark, traces, movie=0):
    rows = [(movie, p, f, 101 if s == "M" else 1, float(f), 0.0, 300.0 + f) for p, t in enumerate(traces) for f, s in enumerate(t)]
    return spark.createDataFrame(rows, "movie_id long, particle long, frame long, semantic_raw long, x double, y double, area double")


def smoothed(spark, traces, **how):
    rows = smoothing.smooth(tracks(spark, traces), **how).orderBy("movie_id", "particle", "frame").collect()
    return ["".join("M" if r.semantic_smoothed else "I" for r in rows if r.particle == p) for p in range(len(traces))], rows


@pytest.mark.parametrize(("trace", "runs"), [
    ("IIIMMMMIII", [(2, 4)]), ("MMMMIIIIII", []), ("IIIIIIMMMM", [(5, 4)]), ("IIMMMIMMMI", [(1, 7)]), ("IIMMIIMMII", [(1, 6)]), ("IMMMIIIMMMI", [(0, 3), (6, 3)]), ("IIIIMIIIII", []), ("IIIIMMIIII", []),
])
def test_runs(spark, trace, runs):
    rows = smoothing.smooth(tracks(spark, ["I" * 10, trace, "I" * 10]))
    assert sorted((r.mito_start, int(r.mitosis)) for r in events.runs(rows).collect()) == runs


def test_neighbouring_tracks_touch(spark):
    traces = ["IIIIIIMMMII", "MMMIIIIIIII"]
    assert smoothed(spark, traces)[0][0].endswith("MMMMM")
    assert smoothed(spark, traces, scope="track")[0][0].endswith("MMMII")


def brute(values):
    def median(v):
        p = [0, *v, 0]
        return [sorted(p[i : i + 3])[1] for i in range(len(v))]

    level = [(s - 1) // 99 for s in median([1 if s < 100 else s for s in values])]
    near = lambda f, v: [f(v[max(0, i - 1) : i + 2]) for i in range(len(v))]
    return near(min, near(max, level))


def test_halo_equals_whole_vector(spark):
    r = np.random.default_rng(3)
    traces = ["".join(r.choice(["M", "I"], 10 + int(r.integers(6)), p=[0.4, 0.6])) for _ in range(40)]
    _, rows = smoothed(spark, traces)
    assert [r.semantic_smoothed for r in rows] == brute([101 if s == "M" else 1 for t in traces for s in t])
    with pytest.raises(ValueError):
        smoothing.smooth(tracks(spark, traces), scope="other")


def test_histogram(spark):
    peaks = spark.createDataFrame([(0, i, n) for i, n in enumerate([0, 1, 1, 13, 14, 15])], "movie_id long, particle long, n_peaks long")
    got = {r["n_peaks"]: r["track number"] for r in events.peak_histogram(peaks).collect()}
    assert got == {**dict.fromkeys(range(14), 0), 0: 1, 1: 2, 13: 2}


def test_summary_without_channels_and_with(spark):
    rows = smoothing.smooth(tracks(spark, ["I" * 10, "IIIMMMMIII"]))
    assert summarize.summary(rows).columns == ["movie_id", "particle", "track_length", "max_displacement", "mito_start", "cell_area", "mitosis"]
    with_gfp = rows.withColumn(
        "GFP", F.when(F.col("frame") == 4, None).otherwise(F.col("frame").cast("double")),
    ).withColumn("GFP_bkg_corr", F.lit(0.0)).withColumn("GFP_int_corr", F.lit(0.0))
    (r,) = summarize.summary(with_gfp).collect()
    assert r["GFP"] == pytest.approx((3 + 5 + 6) / 3) and r["GFP_bkg_corr"] == 0 and r["GFP_int_corr"] == 1
    assert r["GFP_area_mean"] == pytest.approx(300 + (3 + 4 + 5 + 6) / 4)


def plane(spark, pixels, movie=0, frame=0):
    a = np.asarray(pixels)
    return spark.createDataFrame(
        [(movie, frame, *a.shape, [float(v) for v in a.reshape(-1)])],
        "movie_id long, frame long, height int, width int, pixels array<double>",
    )


def test_touching_labels_erode_towards_the_lower(spark):
    a = np.zeros((14, 22), int)
    a[2:12, 2:11], a[2:12, 11:20] = 1, 2
    out = images.erode(a, images.disk(3))
    got = np.array(images.eroded(plane(spark, a)).first()["pixels"]).reshape(a.shape)
    assert (got == out).all() and (got[a == 2] == 1).sum() == 12 and (got == 1).sum() == 36 and (got == 2).sum() == 12


def test_kernels():
    r = np.random.default_rng(0).random((9, 7))
    assert images.zoom2(r).shape == (18, 14) and (images.block_max(images.zoom2(r)) == r).all()
    assert images.gaussian(np.full((5, 5), 2.0), 45).mean() == pytest.approx(2)
    assert images.block_max(np.arange(9.0).reshape(3, 3)).tolist() == [[4, 5], [7, 8]]
    assert len(images.disk(3)) == 29


def test_small_stacks(spark):
    stack = plane(spark, [[1, 2], [3, 4]]).withColumn("frame", F.explode(F.sequence(F.lit(0), F.lit(3))))
    assert images.projection(stack, "max").count() == 0
    assert [r.pixels for r in images.projection(stack, "average").collect()] == [[None] * 4]
    with pytest.raises(ValueError):
        images.projection(stack, "mean")
    five = stack.union(plane(spark, [[1, 2], [3, 4]], frame=4))
    (m,) = images.intensity_map(five, 1.0).collect()
    assert max(m["pixels"]) == 1.0


def test_measure(spark):
    labels = plane(spark, [[1, 0], [0, 2]])
    channel = plane(spark, np.arange(16).reshape(4, 4))
    zero = plane(spark, np.zeros((4, 4)))
    got = {r.label: r for r in measure.signals(labels, channel, zero).collect()}
    assert got[1].signal == pytest.approx((0 + 1 + 4 + 5) / 4) and got[2].signal == pytest.approx((10 + 11 + 14 + 15) / 4)
    assert got[1].bkg_corr is None and got[1].int_corr == 1.0
    rows = smoothing.smooth(tracks(spark, ["I" * 10, "IIIMMMMIII"])).withColumn("label", F.lit(1))
    assert measure.with_channel(rows, measure.signals(labels, channel), "GFP").filter("GFP is not null").count() == 2
    assert measure.chosen(rows, [1]).count() == 10 and measure.chosen(rows).count() == 10
    with pytest.raises(ValueError):
        measure.chosen(rows, 7)


def test_regions_split_label_and_filter(spark):
    got = regions.region_table(plane(spark, [[3, 0, 3], [0, 0, 0]])).first()
    assert (got.x, got.y, got.area, got.eccentricity, got["bbox-2"], got["bbox-3"]) == (0, 1, 2.0, 1.0, 1, 3)
    areas = spark.createDataFrame([(250.0,), (251.0,), (4000.0,)], "area double")
    assert [r.area for r in regions.area_filter(areas, 250, 4000).collect()] == [251.0]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(2, 8), st.integers(0, 2**31), st.sampled_from(["vanilla", "adaptive", "predictive"]))
def test_linker_follows_spaced_points(n, frames, seed, mode):
    r = np.random.default_rng(seed)
    at = np.array([(i % 4 * 100.0, i // 4 * 100.0) for i in range(n)])
    linker, ids = Linker(Options(20, mode=mode)), None
    for f in range(frames):
        now = at + r.uniform(-4, 4, at.shape)
        order = r.permutation(n)
        got = linker.step(f, [tuple(now[i]) for i in order])
        back = [got[list(order).index(i)] for i in range(n)]
        assert len(set(got)) == n and (ids is None or back == ids)
        ids = back


def test_linker_memory_and_order():
    linker = Linker(Options(5, memory=1))
    assert linker.step(0, [(0, 0), (50, 50)]) == [0, 1]
    assert linker.step(1, [(50, 51)]) == [1]
    assert linker.step(2, [(0, 1), (50, 52)]) == [0, 1]
    assert linker.step(3, []) == [] and linker.step(4, []) == []
    assert linker.step(5, [(0, 1)]) == [2]


def every_assignment(near, particles, unlinked):
    """(total, points in order of particles, none last) of each way to link."""
    dots = sorted({d for own in near.values() for d in own})

    def descend(i, used):
        if i == len(particles):
            yield 0.0, ()
            return
        own = near[particles[i]]
        for d in [d for d in dots if d in own and own[d] <= unlinked and d not in used] + [None]:
            for total, rest in descend(i + 1, used | {d} - {None}):
                yield total + (unlinked if d is None else own[d]), ((float("inf") if d is None else d), *rest)

    return descend(0, frozenset())


@pytest.mark.parametrize("whole", [True, False])
def test_assignment_equals_all_permutations(whole):
    """Totals and tie order, for costs with many ties (whole numbers) and few."""
    r = np.random.default_rng(int(whole))
    for _ in range(150):
        n, m = int(r.integers(1, 7)), int(r.integers(1, 7))
        cost = r.integers(0, 4, (n, m)).astype(float) if whole else r.random((n, m)) * 4
        near = {10 - i: {d: float(cost[i, d]) for d in range(m) if r.random() < 0.7} for i in range(n)}
        particles = sorted(near)
        total, best = min((round(t, 9), links) for t, links in every_assignment(near, particles, 3.0))
        got = {p: d for d, p in linker_module._assign(particles, near, 3.0).items()}
        assert round(sum(near[p][got[p]] if p in got else 3.0 for p in particles), 9) == total
        assert tuple(got.get(p, float("inf")) for p in particles) == best


def test_crowded_parts_are_solved_fast():
    r = np.random.default_rng(0)
    for n in (12, 25, 30):
        points = [tuple(x) for x in r.uniform(0, 6 if n == 12 else 60, (n, 2))]
        linker = Linker(Options(20 if n < 30 else 90))
        linker.step(0, points)
        began = time.perf_counter()
        linker.step(1, [tuple(x) for x in np.array(points) + r.normal(0, 8, (n, 2))])
        assert time.perf_counter() - began < 1


def test_linker_is_optimal_and_bounded():
    linker = Linker(Options(10))
    linker.step(0, [(0, 0), (4, 0)])
    assert linker.step(1, [(4, 0), (9, 0)]) == [0, 1]  # 16 + 25 beats leaving one alone
    crowd = [(float(i), 0.0) for i in range(40)]
    full = Linker(Options(3))
    full.step(0, crowd)
    with pytest.raises(OversizeError):
        full.step(1, crowd)
    shrinking = Linker(Options(3, mode="adaptive", adaptive_stop=0.5))
    shrinking.step(0, crowd)
    assert shrinking.step(1, crowd) == list(range(40))


def test_predictive_follows_fast_points():
    fast = Linker(Options(12, mode="predictive"))
    ids = [fast.step(f, [(x, 0.0), (x + 15.0, 0.0)]) for f, x in enumerate([0.0, 6.0, 14.0, 24.0, 36.0])]
    assert ids == [[0, 1]] * 5


def test_link_isolates_a_movie(spark):
    bad = [(0, f, i + 1, i, 0) for f in range(2) for i in range(40)]
    good = [(1, f, 1, f, 0) for f in range(12)]
    rows = spark.createDataFrame(bad + good, "movie_id long, frame long, label int, x int, y int")
    got = linking.link(rows, Options(3))
    assert got.filter("particle is null and link_error is not null").count() == 80
    kept = linking.stub_filter(got.filter("particle is not null"), 10)
    assert kept.count() == 12 and kept.select("particle").distinct().count() == 1
    assert linking.link(rows.filter("false"), Options(3)).count() == 0


@pytest.mark.parametrize("mode", ["vanilla", "adaptive"])
@pytest.mark.parametrize("memory", [0, 1, 2])
def test_parts_equal_whole_movies(spark, mode, memory):
    """Crowded movies of other lengths, gaps and ties; one of them can't be solved in vanilla mode. Ids are the same, too."""
    r = np.random.default_rng(memory)
    rows = []
    for movie in range(4):
        at = r.integers(0, 90, (25, 2)).astype(float)
        for f in range(45):
            at += r.integers(-2, 3, at.shape)
            rows += [(movie, 3 + f, k, float(x), float(y), "kept") for k, (x, y) in enumerate(at) if r.random() < 0.85]
    rows += [(9, f, k, float(k), 0.0, "kept") for f in (20, 21) for k in range(40)] + [(9, 0, 0, 500.0, 500.0, "kept")]
    table = spark.createDataFrame(rows, "movie_id long, frame long, label int, x double, y double, more string")
    o = Options(5, memory=memory, mode=mode, adaptive_stop=0.5)
    whole, split = (linking.link(table, o, split=s) for s in (False, True))
    assert whole.columns == split.columns == [*table.columns, "particle", "link_error"]
    whole, split = (sorted(map(tuple, df.collect()), key=repr) for df in (whole, split))
    assert whole == split and len(whole) == len(rows)
    assert any(x[-1] for x in whole) == (mode == "vanilla") and len({x[-2] for x in whole if x[0] == 0}) > 25


def test_parts_are_independent(spark):
    """A part is what possible links join over all blocks of frames, and no more."""
    near = [("m", f, 0, 3.0 * f, 0.0) for f in range(100)] + [("m", f, 1, 3.0 * f, 50.0) for f in range(0, 100, 3)] + [("n", f, 0, 0.0, 0.0) for f in (0, 2, 5, 20, 22)]
    table = spark.createDataFrame(near, "movie_id string, frame long, label long, x double, y double")
    found = {}
    for x in components.parts(table, 6.0, 1, frames=4).collect():
        found.setdefault((x.movie_id, x.part), set()).add((x.frame, x.label))
    assert sorted(map(len, found.values())) == sorted([100, *[1] * 34, 2, 1, 2])
    i, j = components.near_pairs(*(np.array(c) for c in ([0, 0, 1, 2, 3], [0.0, 5.0, 4.0, 0.0, 0.0], [0.0, 0.0, 0.0, 3.0, 0.0])), 5.0, 2)
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 2), (0, 3), (1, 2), (2, 3), (2, 4), (3, 4)]


def test_near_pairs_equal_all_pairs():
    r = np.random.default_rng(0)
    f, x, y = r.integers(-3, 6, 300), r.uniform(-40, 40, 300), r.normal(0, 1e4, 300).round(-3)
    i, j = components.near_pairs(f, x, y, 7.0, 2)
    want = {(a, b) for a in range(300) for b in range(300) if 1 <= f[b] - f[a] <= 2 and (x[a] - x[b]) ** 2 + (y[a] - y[b]) ** 2 <= 49}
    assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want
    assert components.roots(5, np.array([3, 4]), np.array([4, 1])).tolist() == [0, 1, 2, 1, 1]


def test_star_components(spark):
    edges = [("a", i, i + 1) for i in range(60)] + [("b", 7, 3), ("b", 3, 9), ("b", 5, 5), ("b", 20, 21)]
    found = components.star_components(spark.createDataFrame(edges, "k string, u long, v long"), ["k"])
    assert {(x.k, x.node, x.component) for x in found.collect()} == {("a", i, 0) for i in range(61)} | {("b", 3, 3), ("b", 7, 3), ("b", 9, 3), ("b", 20, 20), ("b", 21, 20)}
    assert components.star_components(spark.createDataFrame([], "k string, u long, v long"), ["k"]).count() == 0


def test_views_tell_the_modes_apart(spark):
    """On each mode's own view vanilla links other tracks."""
    d = "/root/testdata/sf0.001"
    p = params.for_cell_type("hela")
    for view, mode in ((views.jump, "adaptive"), (views.march, "predictive")):
        own, vanilla = (sorted((x.movie_id, x.frame, x.label, x.particle) for x in linking.link(view(spark, d), linking.options(p, m)).collect()) for m in (mode, "vanilla"))
        assert own != vanilla and len(own) == len(vanilla)


def test_chosen_tracks_of_many_movies(spark):
    rows = spark.createDataFrame([(m, p, m) for m in (0, 1) for p in (0, 1, 2)], "movie_id long, particle long, mitotic int")
    assert measure.chosen(rows).count() == 3
    pairs = spark.createDataFrame([(0, 2), (1, 0)], "movie_id long, particle long")
    assert sorted(tuple(r)[:2] for r in measure.chosen(rows, pairs).collect()) == [(0, 2), (1, 0)]
    one = rows.filter("movie_id = 1")
    assert measure.chosen(one, 2).count() == 1 and measure.chosen(one, [0, 1]).count() == 2
    for ids, table in ((7, one), ([0, 9], one), (1, rows), (spark.createDataFrame([(5, 0)], "movie_id long, particle long"), rows)):
        with pytest.raises(ValueError):
            measure.chosen(table, ids)


def test_blur_equals_a_plain_sum():
    r = np.random.default_rng(0)
    for shape, sigma in (((1, 1), 2.0), ((7, 30), 1.3), ((50, 41), 6.0)):
        plane, reach = r.normal(size=shape), int(4 * sigma + 0.5)
        taps = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
        taps /= taps.sum()
        padded = np.pad(plane, reach, mode="edge")
        want = np.array([[taps @ padded[i : i + 2 * reach + 1, j : j + 2 * reach + 1] @ taps for j in range(shape[1])] for i in range(shape[0])])
        assert np.allclose(images.gaussian(plane, sigma), want, atol=1e-12)
    assert [images._smooth_size(n) for n in (1, 2, 7, 11, 97, 2408)] == [1, 2, 8, 12, 100, 2430]


def test_wellmap(spark):
    rows = [
        ("HeLa", "plasmidA", "DMSO", "A01,A02"), ("HeLa", "plasmidA", "DMSO", "B01"), ("U2OS", "p", "d", " A01; A02  B03"),
        ("U2OS", "p", "e", None), ("U2OS", "p", "f", ""), ("U2OS", "p", None, "C01"), ("HeLa", "plasmidA", "DMSO", "A02"),
    ]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, celltype string, transfection string, drug string, well_ids string")
    got = {tuple(r[:3]): r["wells"] for r in wells.wellmap(table, "i").collect()}
    assert got == {("HeLa", "plasmidA", "DMSO"): ["A01", "A02", "B01"], ("U2OS", "p", "d"): ["A01", "A02", "B03"], ("U2OS", "p", "e"): [], ("U2OS", "p", "f"): []}
    listed = table.withColumn("well_ids", F.when(F.col("i") < 2, F.array(F.lit(" A01 "), F.lit(""), F.col("well_ids"))))
    assert {r["drug"]: r["wells"] for r in wells.wellmap(listed, "i").collect()}["DMSO"] == ["A01", "A01,A02", "B01"]
    for lacking in ("drug", "i"):
        with pytest.raises(KeyError):
            wells.wellmap(table.drop(lacking), "i")


def test_import(spark):
    groups = spark.createDataFrame(
        [("c", "t", "d", ["A01_s1", "B01"]), ("c", "t", "e", ["A01_s1"]), ("c", "t", "f", [])],
        "celltype string, transfection string, drug string, wells array<string>",
    )
    rows = spark.createDataFrame(
        [("x_A01_s1_inference", "x_A01_s1_summary.xlsx", s, m) for s, m in ((0, 3.0), (5, 4.0), (5, 5.0))] + [("x_B02_s1_inference", "f", 1, 1.0), ("x_A01_s1_other", "f", 1, 1.0)],
        "folder string, file string, mito_start long, mitosis double",
    )
    found = wells.compile_summaries(rows, groups.select(F.explode("wells").alias("well")), "/root")
    assert found.count() == 3 and {r.position for r in found.collect()} == {"s1"}
    got = wells.import_experiment(groups, found, 10, 10.0)
    assert sorted((r.code, r.mito_start, r.mitosis) for r in got.collect()) == [("c_t_d", 5, 40.0), ("c_t_e", 5, 40.0)]
    assert {r.code: r.status for r in wells.import_report(groups, got).collect()} == {"c_t_d": "loaded", "c_t_e": "loaded", "c_t_f": "skipped: no wells"}
    assert wells.union_all(spark, [], "a long").columns == ["a"]


def test_dose(spark):
    xy = spark.createDataFrame([(float(x), 1.0) for x in (1, 1.0, 3.5, 3.6, 6, 100)] + [(None, 1.0), (2.0, None)], "d double, r double")
    binned = dose.with_bin(dose.complete(xy), 2, 43)
    assert [(r.dose, r.bin) for r in binned.orderBy("dose").collect()] == [(1.0, None), (1.0, None), (3.5, 0), (3.6, 1), (6.0, 1), (100.0, None)]
    assert dose.edges(2, 43)[:2] == [1.0, 3.5] and dose.edges(2, 43)[-1] == 63.5
    assert dose.bin_stderrs(binned).count() == 1 and dose.bin_sizes(binned, 25).count() == 25


@settings(max_examples=40, deadline=None)
@given(st.floats(0.5, 3), st.floats(10, 40), st.floats(2, 7), st.floats(6, 20))
def test_fit_recovers_the_curve(base, top, exponent, ec50):
    x = np.linspace(1, 60, 25)
    y = hill.curve(x, np.array([base, top, exponent, ec50]))
    p, status = hill.fit(x, y, np.array([y.min(), y.max(), 5, 12.0]))
    assert status == "converged" and np.abs(hill.curve(x, p) - y).max() < 1e-4 * top


def test_degenerate_fits(spark):
    assert hill.fit(np.array([1.0]), np.array([1.0]), np.ones(4))[1].startswith("1 points")
    rows = [(c, float(x), 2.0 if c == "flat" else 1 + x / (x + 9.0)) for c in ("flat", "curve") for x in range(1, 60)]
    got = {r.code: r for r in dose.fit(spark.createDataFrame(rows, "code string, dose double, response double"), ["code"]).collect()}
    assert got["curve"].status == "converged" and got["flat"].status
    curve = dose.fitted_curve(
        dose.fit(spark.createDataFrame(rows, "code string, dose double, response double").filter("code = 'curve'"), ["code"]), 60,
        ["code"],
    )
    assert curve.count() == 60


def test_params():
    assert params.for_cell_type("hela").max_cell_size == 4000 and params.for_cell_type("RPE1").track_mode == "predictive"
    assert params.for_cell_type("hela").min_mitotic_frames == 3
    for bad in ("cho", 3, None):
        with pytest.raises(ValueError):
            params.for_cell_type(bad)
    with pytest.raises(ValueError):
        params.mode_or_default("fast", params.CellParams())
    assert params.mode_or_default(None, params.for_cell_type("u2os")) == "predictive"


@pytest.mark.parametrize("error", [1e-5, 0.005])
def test_percentiles_equal_numpy(spark, error):
    """With and without brackets, for groups of many ties, of few rows, and of one."""
    r = np.random.default_rng(0)
    rows = [("many", float(v)) for v in r.normal(size=6000)] + [("ties", float(v)) for v in r.integers(0, 5, 5000)] + [
        ("few", 3.0), ("few", 4.0), ("one", 7.0), ("none", None), (None, 1.0),
    ]
    table = spark.createDataFrame(rows, "g string, x double")
    fractions = (0.0, 0.025, 0.5, 0.85, 1.0)
    got = {x.g: x.q for x in quantiles.percentiles(table, ["g"], "x", fractions, error).collect()}
    for g in ("many", "ties", "few", "one"):
        assert got[g] == pytest.approx(np.quantile([v for k, v in rows if k == g], fractions), abs=1e-12)
    (all_,) = quantiles.percentiles(table, [], "x", fractions, error).collect()
    assert all_.q == pytest.approx(np.quantile([v for _, v in rows if v is not None], fractions), abs=1e-12)
    assert quantiles.percentiles(table.filter("false"), [], "x", fractions).count() == 0


def test_fits_join_a_row_per_dose(spark):
    """A code with nearly all rows: its rows must not meet its quantiles one by one in one task."""
    code = F.when(F.col("id") % 97 == 0, "B").otherwise("A")
    rows = spark.range(40_000).select((F.col("id") % 50 + 1.0).alias("dose"), (F.col("id") % 7 + 0.5).alias("response"), code.alias("code"))
    fits = dose.fit(dose.complete(rows), ["code"])
    assert {r.code for r in fits.collect()} == {"A", "B"}
    found = joined_rows(fits)
    assert found and max(found) <= 200


@pytest.mark.parametrize("name", ["hill_fit", "hill_fit_prices"])
def test_fit_queries_join_a_row_per_dose(spark, name):
    fits = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(fits.collect()) == 3
    found = joined_rows(fits)
    assert found and max(found) <= 200  # 50 quantities and 3 codes


def test_values_of_one_group_are_dealt(spark):
    """Doses that never repeat meet their group's row in many tasks when neither side may be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        values, groups = spark.range(8000).selectExpr("'A' AS g", "id / 3 AS v"), spark.createDataFrame([("A", 1), ("B", 2)], "g string, n int")
        got = quantiles.met(values, ["g"], "v", groups)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 4800 and {r.n for r in got.select("n").distinct().collect()} == {1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_projection_of_many_tasks(spark):
    r = np.random.default_rng(1)
    planes = {(m, f): r.integers(0, 100, 6).astype(float) for m in range(12) for f in range(9)}
    planes[3, 4][2] = np.nan
    rows = [(m, f, 2, 3, [None if np.isnan(v) else float(v) for v in p]) for (m, f), p in planes.items()]
    stack = spark.createDataFrame(rows, "movie_id long, frame long, height int, width int, pixels array<double>").repartition(5)
    for kind, how in (("max", np.nanmax), ("min", np.nanmin), ("average", np.nanmean)):
        got = {x.movie_id: (x.height, x.width, x.pixels) for x in images.projection(stack, kind).collect()}
        assert set(got) == set(range(12))
        for m in got:
            assert got[m][:2] == (2, 3) and got[m][2] == pytest.approx(how([planes[m, f] for f in range(2, 6)], axis=0))
