"""Command-line jobs mirroring the two original main programs.

    spark-submit --py-files kestrel.zip kestrel/__main__.py rank-terms <article-lines path>
        [--terms T ...] [--line-sep SEP]
    spark-submit --py-files kestrel.zip kestrel/__main__.py cluster <posting-lines path>
        [--k 45] [--spread 50000] [--eta 20] [--max-iter 120] [--expected N] [--categories C ...] [--debug]
    (locally: python -m kestrel ...)

The session comes from ``SparkSession.builder.getOrCreate()``, so master, memory and
``spark.checkpoint.dir`` are whatever the submitter configured.  Only bounded
results reach the driver: one row per term, one line per cluster.
"""

from __future__ import annotations

import argparse
import sys
import time
from itertools import groupby

from pyspark.sql import SparkSession

from kestrel.constants import DEFAULT_ETA, DEFAULT_K, DEFAULT_MAX_ITER, DEFAULT_SPREAD, DEFAULT_TERMS
from kestrel.operators.ranking import inverted_index, rank_terms, rank_terms_from_index, rank_terms_single_pass
from kestrel.plans.qa_clustering import qa_cluster_pipeline
from kestrel.plans.term_ranking import term_ranking_pipeline
from kestrel.session import scratch_scope
from kestrel.sources.articles import parse_article_lines
from kestrel.sources.lines import read_lines


def _rank(spark: SparkSession, args) -> None:
    lines = read_lines(spark, args.path, line_sep=args.line_sep)
    if not args.timings:  # one scan, one tokenisation for all three
        for r in term_ranking_pipeline(lines, args.terms, on_error=args.on_error).orderBy("method", "rank").collect():
            print(f"{r['method']:<12s} {r['rank']:3d}  {r['term']:<15s} {r['n']}")
        return
    articles = parse_article_lines(lines, on_error=args.on_error)
    for label, build in (("complete ranking", lambda: rank_terms(articles, args.terms)),
                         ("ranking from the inverted index",
                          lambda: rank_terms_from_index(inverted_index(articles, args.terms), args.terms)),
                         ("one-pass ranking", lambda: rank_terms_single_pass(articles, args.terms))):
        t0 = time.perf_counter()
        rows = build().collect()
        print(f"{label}: {time.perf_counter() - t0:.2f} s")
        for r in rows:
            print(f"  {r['rank']:3d}  {r['term']:<15s} {r['n']}")


def _cluster(spark: SparkSession, args) -> None:
    t0 = time.perf_counter()
    with qa_cluster_pipeline(read_lines(spark, args.path), args.categories, spread=args.spread, k=args.k,
                             eta=args.eta, max_iter=args.max_iter, expected_vectors=args.expected) as res:
        _report(res, args, t0)


def _report(res, args, t0: float) -> None:
    if args.debug:
        for it, group in groupby(res.kmeans.trace, lambda t: t[0]):
            steps = list(group)
            print(f"Iteration {it}: displacement {steps[0][7]:g} (target < {args.eta:g})")
            for _, i, ox, oy, nx, ny, d, _, _ in steps:
                print(f"  centre {i:3d}  ({ox}, {oy}) -> ({nx}, {ny})  moved {d:.0f}")
    for line in res.report.collect():
        print(line["line"])
    print(f"k-means: {res.kmeans.iterations} iterations, displacement {res.kmeans.displacement:g}, "
          f"{'converged' if res.kmeans.converged else 'iteration cap reached'}; "
          f"total {time.perf_counter() - t0:.1f} s")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="kestrel")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("rank-terms", help="rank terms by the number of articles mentioning them")
    r.add_argument("path")
    r.add_argument("--terms", nargs="+", default=DEFAULT_TERMS)
    r.add_argument("--line-sep", default=None)
    r.add_argument("--timings", action="store_true", help="three separate scans, each timed")
    r.add_argument("--on-error", choices=["raise", "drop"], default="raise")
    c = sub.add_parser("cluster", help="cluster questions by category and best answer score")
    c.add_argument("path")
    c.add_argument("--categories", nargs="+", default=DEFAULT_TERMS)
    c.add_argument("--k", type=int, default=DEFAULT_K)
    c.add_argument("--spread", type=int, default=DEFAULT_SPREAD)
    c.add_argument("--eta", type=float, default=DEFAULT_ETA)
    c.add_argument("--max-iter", type=int, default=DEFAULT_MAX_ITER)
    c.add_argument("--expected", type=int, default=None, help="fail unless exactly this many vectors")
    c.add_argument("--debug", action="store_true", help="print every k-means iteration")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"kestrel-{args.cmd}").getOrCreate()
    with scratch_scope(spark):
        (_rank if args.cmd == "rank-terms" else _cluster)(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
