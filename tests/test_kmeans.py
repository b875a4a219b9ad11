"""Sampling, k-means and the cluster report."""

import re

import pytest

from conftest import SF_SMALL, executed_plan, raises_spark, rows
from kestrel.operators import kmeans as KM
from kestrel.operators import report, sampling

VSCHEMA = "question_id bigint, x int, y int"


def vec(spark, pts):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], VSCHEMA)


def test_nearest_tie_goes_to_lowest_index(spark):
    df = vec(spark, [(5, 0)])
    assert rows(KM.assign_nearest(df, [(10, 0), (0, 0)]), "cluster", "dist") == [(0, 25.0)]
    assert rows(KM.assign_nearest(df, [(0, 0), (10, 0)]), "cluster") == [(0,)]
    assert rows(KM.assign_nearest(df, [(9, 0), (1, 0), (5, 3)]), "cluster") == [(2,)]


def test_distance_is_squared(spark):
    assert rows(KM.distance_to(vec(spark, [(3, 4)]), (0, 0)), "dist") == [(25.0,)]


def test_integer_mean_truncates(spark):
    df = vec(spark, [(1, 1), (2, 2)]).withColumn("g", __import__("pyspark.sql.functions").sql.functions.lit(0))
    assert rows(KM.average_vectors(df, ["g"]), "x", "y", "n") == [(1, 1, 2)]
    df2 = vec(spark, [(-1, 0), (-2, 0)]).withColumn("g", __import__("pyspark.sql.functions").sql.functions.lit(0))
    assert rows(KM.average_vectors(df2, ["g"]), "x") == [(-1,)]   # toward zero, not floor


def test_empty_centre_keeps_its_value(spark):
    df = vec(spark, [(0, 0), (0, 2)])
    assert KM.lloyd_step(df, [(0, 0), (100, 100)]) == [(0, 1), (100, 100)]


def test_displacement_and_convergence():
    assert KM.center_displacement([(0, 0), (1, 1)], [(3, 4), (1, 1)]) == 25.0
    with pytest.raises(ValueError):
        KM.center_displacement([(0, 0)], [])
    assert KM.converged(19.9, 20.0) and not KM.converged(20.0, 20.0)


def test_kmeans_loop_and_trace(spark):
    df = vec(spark, [(0, 0), (0, 2), (10, 10), (10, 12)])
    res = KM.kmeans(df, [(0, 0), (10, 10)], eta=0.5, max_iter=10)
    assert res.centres == [(0, 1), (10, 11)]
    assert res.converged and res.iterations == 2
    assert len(res.trace) == 2 * 2
    capped = KM.kmeans(df, [(0, 0), (10, 10)], eta=0.0, max_iter=1)
    assert capped.iterations == 1 and not capped.converged and capped.centres == [(0, 1), (10, 11)]


def test_median_even_count(spark):
    df = vec(spark, [(0, 1), (0, 2), (0, 5), (0, 8)])
    assert rows(report.cluster_median(report.cluster_membership(df, [(0, 0)])), "median_score") == [(3,)]
    df = vec(spark, [(0, 1), (0, 2), (0, 5)])
    assert rows(report.cluster_median(report.cluster_membership(df, [(0, 0)])), "median_score") == [(2,)]


def test_dominant_percent_and_ties(spark):
    cats = ["A", "B", "C"]
    df = vec(spark, [(0, 1), (1, 1), (1, 1), (2, 1)])  # spread 1: x is the category
    got = rows(report.cluster_dominant(report.cluster_membership(df, [(1, 1)]), cats, 1),
               "label", "dominant_n", "size", "percent")
    assert got == [("B", 2, 4, 50.0)]
    df = vec(spark, [(0, 1), (2, 1), (1, 1)])   # three-way tie -> lowest category, 100*1 div 3 = 33
    assert rows(report.cluster_dominant(report.cluster_membership(df, [(1, 1)]), cats, 1),
                "label", "percent") == [("A", 33.0)]


def test_cluster_results_skip_empty_and_sort_by_median(spark):
    cats = ["A", "B"]
    df = vec(spark, [(0, 9), (0, 7), (10, 1), (10, 3)])
    res = report.cluster_results(df, [(0, 8), (10, 2), (500, 500)], cats, 10)
    assert rows(res, "cluster", "label", "size", "median_score") == [(1, "B", 2, 2), (0, "A", 2, 8)]
    lines = [line for _, line in rows(report.cluster_report_lines(res))]
    assert lines[0] == "Resulting clusters:"
    assert lines[3] == "      2  B                 (100.0%)            2"


def test_stratified_and_global_samples(spark):
    pts = [(c * 10, i) for c in range(3) for i in range(20)]
    df = vec(spark, pts)
    s = sampling.stratified_sample(df, 4)
    counts = {x: n for x, n in rows(s.groupBy("x").count())}
    assert counts == {0: 4, 10: 4, 20: 4}
    assert rows(s.orderBy("question_id")) == rows(sampling.stratified_sample(df.repartition(5), 4)
                                                  .orderBy("question_id"))
    g = sampling.global_sample(df, 7)
    assert g.count() == 7
    seeds = sampling.initial_centres(df, 6, ["a", "b", "c"], 10, min_stratified_spread=5)
    assert len(seeds) == 6 and [x for x, _ in seeds] == [0, 0, 10, 10, 20, 20]


def test_sample_preconditions(spark):
    df = vec(spark, [(0, 1), (0, 2), (10, 3)])
    with pytest.raises(ValueError):
        sampling.initial_centres(df, 5, ["a", "b"], 1000)           # not a multiple
    with pytest.raises(ValueError):
        sampling.initial_centres(df, 4, ["a", "b"], 10, min_stratified_spread=5)   # stratum 'b' too small
    chk = sampling.sample_stratum_check(df, ["a", "b", "c"], 10, 2)
    assert rows(chk.orderBy("x"), "category", "n_rows", "ok") == [("a", 2, True), ("b", 1, False), ("c", 0, False)]
    raises_spark(lambda: sampling.sample_stratum_check(df, ["a", "b"], 10, 2, strict=True).collect(),
                 "fewer than 2")


def test_pipeline_on_smoke_data(spark):
    from kestrel.plans import fixtures as FX
    from kestrel.plans.qa_clustering import qa_cluster_pipeline
    res = qa_cluster_pipeline(FX.fx_posting_lines(spark, SF_SMALL), FX.ORDER_PRIORITIES, spread=10, k=5,
                              line_col="line")
    got = rows(res.results)
    assert 1 <= len(got) <= 5
    assert sum(r[3] for r in got) == res.vectors.count()
    assert rows(res.report)[0] == (0, "Resulting clusters:")


def test_fixture_convergence_matches_the_probe(spark):
    from conftest import SF_CHECK
    from kestrel.plans import fixtures as FX
    for spread, steps, disp in ((FX.FIXTURE_SPREAD, 3, 18.0), (FX.FIXTURE_MIXED_SPREAD, 4, 10.0)):
        vectors = FX.fx_vectors(spark, SF_CHECK, spread)
        seeds = sampling.initial_centres(vectors, FX.FIXTURE_K, FX.ORDER_PRIORITIES, spread)
        res = KM.kmeans(vectors, seeds, eta=FX.FIXTURE_ETA)
        assert (res.iterations, res.displacement, res.converged) == (steps, disp, True)
        # weighted distinct points give the same centres as Lloyd steps over every vector
        centres = seeds
        for _ in range(steps):
            centres = KM.lloyd_step(vectors, centres)
        assert centres == res.centres


def test_membership_keeps_every_row_in_one_narrow_pass(spark):
    from conftest import executed_plan
    vectors = spark.createDataFrame([(1, 0, 3), (2, None, 5), (3, 50, 9)], "question_id int, x int, y int")
    members = report.cluster_membership(vectors, [(0, 0), (50, 10)])
    assert sorted(rows(members, "question_id")) == [(1,), (2,), (3,)]
    assert not re.search("Join|Exchange", executed_plan(members))


def test_seeds_are_a_bounded_collect(spark):
    from conftest import raises_spark
    wide = spark.range(200_000).selectExpr("CAST(id AS INT) AS question_id", "CAST(id AS INT) AS x", "1 AS y")
    raises_spark(lambda: sampling.initial_centres(wide, 2, ["a", "b"], 50_000), "belongs to no category")
    own = wide.selectExpr("question_id", "(question_id % 2) * 50000 AS x", "y")
    assert sampling.initial_centres(own, 4, ["a", "b"], 50_000) == [(0, 1), (0, 1), (50_000, 1), (50_000, 1)]


def test_pipelines_leave_nothing_behind(spark):
    import os
    from conftest import SF_SMALL
    from kestrel.plans import fixtures as FX
    from kestrel.plans.qa_clustering import qa_cluster_pipeline
    from kestrel.session import checkpoint_root
    folder = f"{checkpoint_root(spark)}/kestrel".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    with qa_cluster_pipeline(FX.fx_posting_lines(spark, SF_SMALL), FX.ORDER_PRIORITIES, spread=50000, k=5,
                             line_col="line") as res:
        assert res.results.count() > 0
        assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held
    assert set(os.listdir(folder)) == before


# --- the envelope search and the grid of many centres ---

def slow_nearest(points, centres):
    return [min(((float(x) - cx) ** 2 + (float(y) - cy) ** 2, i) for i, (cx, cy) in enumerate(centres))[::-1]
            for x, y in points]


def test_envelopes_give_the_nearest_centre():
    import numpy as np
    from kestrel.functions.geometry import envelope_arrays
    rnd = np.random.default_rng(7)
    for size in (2, 5, 40, 10**6):  # small coordinates: many ties, equal centres and equal cy
        for k in (1, 2, 3, 8, 33):
            cx, cy = rnd.integers(-size, size, (2, k))
            xs, ys = np.unique(rnd.integers(-size, size, 6)), rnd.integers(-2 * size, 2 * size, 40)
            begin, centre = envelope_arrays(xs, cx, cy)
            for row, x in enumerate(xs.tolist()):
                got = centre[row][np.searchsorted(begin[row], ys, "right") - 1]
                assert got.tolist() == [i for i, _ in slow_nearest([(x, y) for y in ys.tolist()], list(zip(cx.tolist(), cy.tolist())))]


def random_points(n, seed, reach=300):
    import random
    rnd = random.Random(seed)
    return [(rnd.choice([0, 50, 100, rnd.randint(-reach, reach)]), rnd.randint(-reach, reach)) for _ in range(n)]


def test_prepared_steps_equal_plain_steps_on_all_cores(spark, monkeypatch):
    from kestrel.session import Scratch
    monkeypatch.setattr(KM, "TASK_POINTS", 50)
    points = KM.weighted_points(vec(spark, random_points(3000, 1)))
    with Scratch(spark) as scratch:
        base = scratch.materialize(points, "t").coalesce(1)
        for centres in ([(0, 0)], random_points(7, 2), random_points(45, 3), [(5, 5)] * 3):
            with KM.LloydPoints(base, scratch) as ready:
                assert ready.partitions >= 8 and ready.points.rdd.getNumPartitions() == ready.partitions
                assert "nearest" not in executed_plan(ready.assigned(centres))
                new = KM.lloyd_step(base, centres, weight="w")
                assert ready.step(centres) == new
            with monkeypatch.context() as m:  # intervals as a table that meets the points by a sort-merge join
                m.setattr(KM, "SENT_ENTRIES", 0)
                m.setattr(KM, "FEW_X", 3)
                with KM.LloydPoints(base, scratch) as ready:
                    assert "BroadcastHashJoin" not in ready.assigned(centres)._jdf.queryExecution().toString()
                    assert ready.step(centres) == new


def test_prepared_steps_of_odd_tables(spark):
    from kestrel.session import Scratch
    far = 1 << 30  # squared distances that a double rounds
    tables = [[], [(None, 3, 2), (5, None, 1), (1, 1, 4)], [(far, 7, 1), (-far, far, 3), (0, 0, 1)]]
    with Scratch(spark) as scratch:
        for points in tables:
            base = spark.createDataFrame(points, "x int, y int, w bigint")
            with KM.LloydPoints(base, scratch) as ready:
                assert ready.step([(0, 0), (far - 1, 3)]) == KM.lloyd_step(base, [(0, 0), (far - 1, 3)], weight="w")


def test_cells_give_the_nearest_of_many_centres(spark):
    points = random_points(800, 4) + [(10**6, 10**6), (-10**6, 3), (2, -10**7)]
    for centres in (random_points(400, 5), random_points(300, 6, 20), [(7, y) for y in range(0, 900, 3)],
                    [(x, -2) for x in range(300)], [(3, 3)] * 300, [(-5000, -5000)] + random_points(300, 7, 5)):
        df = KM.assign_nearest(vec(spark, points), centres)
        got = {r["question_id"]: (r["cluster"], r["dist"]) for r in df.collect()}
        assert [got[i] for i in range(len(points))] == slow_nearest(points, centres)
    df = KM.assign_nearest(vec(spark, [(1, 1)]).unionAll(spark.createDataFrame([(9, None, 4)], VSCHEMA)), random_points(300, 8))
    assert {r["question_id"]: r["dist"] for r in df.collect()}[9] is None
    with pytest.raises(ValueError):
        KM.assign_by_cells(df, spark.createDataFrame([], KM.CENTRE_SCHEMA))


def test_ten_thousand_centres(spark):
    import numpy as np
    rnd = np.random.default_rng(1)
    centres = [tuple(c) for c in rnd.integers(0, 20_000, (10_000, 2)).tolist()]
    points = rnd.integers(-100, 20_100, (3_000, 2)).tolist()
    df = KM.assign_nearest(vec(spark, points), centres)
    plan = executed_plan(df)
    assert not re.search("Cartesian|NestedLoop", plan) and len(plan) < 20_000
    c = np.array(centres, float)
    got = {r["question_id"]: r["cluster"] for r in df.collect()}
    for at in range(0, len(points), 500):
        p = np.array(points[at:at + 500], float)
        want = ((p[:, None, 0] - c[:, 0]) ** 2 + (p[:, None, 1] - c[:, 1]) ** 2).argmin(1)
        assert [got[i] for i in range(at, at + len(p))] == want.tolist()
    res = KM.kmeans(vec(spark, [(x // 2000 * 2000, y) for x, y in points]), centres, max_iter=2)
    assert len(res.centres) == 10_000 and KM.trace_frame(spark, res).count() == 20_000


# --- the median by value ranges ---

def slow_median(values):
    values = sorted(values)
    total = values[(len(values) - 1) // 2] + values[len(values) // 2]
    return int(total / 2)


def test_median_of_one_cluster_with_many_values(spark):
    import random
    rnd = random.Random(2)
    ys = [rnd.choice([rnd.randint(-2**31, 2**31 - 1), rnd.randint(-9, 9), 65_536 * rnd.randint(-3, 3)]) for _ in range(4001)]
    rows_ = [(0, y) for y in ys] + [(1, y) for y in ys[:1000]] + [(2, -7), (2, -8), (3, 65_535), (3, 65_536), (4, None), (5, None), (5, 3)]
    members = spark.createDataFrame([(i, c, 0, y) for i, (c, y) in enumerate(rows_)], "question_id int, cluster int, x int, y int")
    median = report.cluster_median(members)
    assert "percentile" not in executed_plan(median)
    got = {r["cluster"]: r["median_score"] for r in median.collect()}
    assert got == {0: slow_median(ys), 1: slow_median(ys[:1000]), 2: -7, 3: 65_535, 4: None, 5: 3}


def test_dominant_category_of_any_coordinates(spark):
    members = [(0, -2**31), (0, -2**31), (0, 2**31 - 1), (0, 2**31 - 1), (1, None), (1, None), (1, 7), (2, None), (2, 7), (3, None)]
    df = spark.createDataFrame([(i, c, x, 0) for i, (c, x) in enumerate(members)], "question_id int, cluster int, x int, y int")
    dom = report._dominant(report._point_counts(df), ["a"], 1)
    assert sorted(rows(dom, "cluster", "dominant_x", "dominant_n", "size")) == [
        (0, -2**31, 2, 4), (1, None, 2, 3), (2, 7, 1, 2), (3, None, 1, 1)]
    assert "SortAggregate" not in executed_plan(dom)
