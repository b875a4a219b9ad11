"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full (``noop`` sink: every row is produced, nothing is
collected) ``BENCH_REPEAT`` times; the best time counts.  ``value`` is the sum of
the per-query times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kestrel.session import local_session, scratch_scope  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def sf_of(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)$", path)
    return float(m.group(1)) if m else path


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from kestrel.operators import kmeans as KM
    from kestrel.operators import ranking as R
    from kestrel.operators import sampling
    from kestrel.plans import fixtures as FX
    from pyspark.sql import functions as F

    from kestrel.plans.qa_clustering import cluster_vectors, qa_cluster_pipeline
    from kestrel.plans.queries import QUERIES

    ckpt = tempfile.mkdtemp(prefix="kestrel-bench-ckpt-", dir="/tmp")
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) * 2, app="kestrel-bench",
                          extra={"spark.checkpoint.dir": ckpt})
    sf = SF_DIR
    terms = FX.FIXTURE_TERMS

    def per_term_scans():
        # the original's shape: one full scan per term; kept only as a comparison point
        docs = FX.documents(spark, sf)
        for t in terms:
            R.occurrences_of_term(docs, t).collect()

    def qa_pipeline_k45():
        # the original defaults: k = 45 centres (9 per category), spread 50000
        with qa_cluster_pipeline(FX.fx_posting_lines(spark, sf), FX.ORDER_PRIORITIES, spread=50000, k=45,
                                 eta=20.0, line_col="line") as res:
            res.results.collect()

    wide: dict[str, int] = {}

    def kmeans_wide():
        # many distinct points and many steps: y is an order's whole price
        names = F.array(*[F.lit(p) for p in FX.ORDER_PRIORITIES])
        vectors = spark.read.parquet(f"{sf}/orders.parquet").select(
            F.col("o_orderkey").alias("question_id"),
            ((F.array_position(names, F.col("o_orderpriority")) - 1) * 50000).cast("int").alias("x"),
            F.col("o_totalprice").cast("int").alias("y"))
        with cluster_vectors(vectors, FX.ORDER_PRIORITIES, spread=50000, k=45, eta=20.0, max_iter=40) as res:
            res.results.collect()
            wide.update(steps=res.kmeans.iterations, distinct_points=res.points.count())

    def kmeans_raw_vectors():
        # comparison point for the original's "cached vs not cached": Lloyd steps over every
        # vector, recomputed from the tables each step (no weighted points, nothing materialised)
        vectors = FX.fx_vectors(spark, sf)
        centres = sampling.initial_centres(vectors, 45, FX.ORDER_PRIORITIES, 50000)
        for _ in range(120):
            new = KM.lloyd_step(vectors, centres)
            done = KM.converged(KM.center_displacement(centres, new), 20.0)
            centres = new
            if done:
                break

    jobs = {
        "rank_terms": lambda: run(QUERIES["rank_terms"](spark, sf)),
        "rank_terms_from_index": lambda: run(QUERIES["rank_terms_from_index"](spark, sf)),
        "rank_terms_single_pass": lambda: run(QUERIES["rank_terms_single_pass"](spark, sf)),
        "rank_per_term_scans": per_term_scans,
        "term_ranking_pipeline": lambda: run(QUERIES["term_ranking_pipeline"](spark, sf)),
        "join_questions_answers": lambda: run(QUERIES["join_questions_answers"](spark, sf)),
        "scored_postings": lambda: run(QUERIES["scored_postings"](spark, sf)),
        "qa_cluster_pipeline": lambda: run(QUERIES["qa_cluster_pipeline"](spark, sf)),
        "qa_pipeline_k45": qa_pipeline_k45,
        "kmeans_k45_raw_vectors": kmeans_raw_vectors,
        "cluster_results": lambda: run(QUERIES["cluster_results"](spark, sf)),
        "kmeans_k45_wide_y": kmeans_wide,
    }
    headline = ["rank_terms", "rank_terms_from_index", "rank_terms_single_pass", "term_ranking_pipeline",
                "join_questions_answers", "scored_postings", "qa_cluster_pipeline", "qa_pipeline_k45",
                "cluster_results", "kmeans_k45_wide_y"]

    # warm-up: JIT and file listing caches, not timed
    run(QUERIES["occurrences_of_term"](spark, sf))
    times: dict[str, float] = {}
    for name, job in jobs.items():
        best = float("inf")
        for _ in range(max(1, REPEAT) if name != "kmeans_k45_wide_y" else 1):  # 40 steps: once is enough
            t0 = time.perf_counter()
            with scratch_scope(spark):
                job()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
    n_lines = FX.fx_posting_lines(spark, sf).count()
    spark.stop()

    # the baseline's only figure is single-threaded (Q&A clustering, vectors cached:
    # ~4 min for 2,121,822 vectors): rerun the k=45 job on one thread for a rate
    single = {}
    if os.environ.get("BENCH_SINGLE_THREAD", "1") == "1":
        spark = local_session(1, shuffle_partitions=2, app="kestrel-bench-1",
                              extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="kestrel-bench-ckpt-", dir="/tmp")})
        best, n_vectors = float("inf"), 0
        for _ in range(2):
            t0 = time.perf_counter()
            with qa_cluster_pipeline(FX.fx_posting_lines(spark, sf), FX.ORDER_PRIORITIES, spread=50000, k=45,
                                     eta=20.0, line_col="line") as res:
                res.results.collect()
                best = min(best, time.perf_counter() - t0)
                n_vectors = res.vectors.count()
        spark.stop()
        single = {"qa_pipeline_k45_local1_sec": round(best, 3), "vectors": n_vectors,
                  "vectors_per_sec_1thread": round(n_vectors / best, 1),
                  "original_vectors_per_sec_1thread": round(2121822 / 240, 1)}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times[n] for n in headline), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_of(sf),
        "cpus": int(CPUS),
        "headline": headline,
        "single_thread": single,
        "kmeans_wide": wide | {"sec": times["kmeans_k45_wide_y"]},
        "posting_lines_per_sec": round(n_lines / times["qa_pipeline_k45"], 1),
    }))


if __name__ == "__main__":
    main()
