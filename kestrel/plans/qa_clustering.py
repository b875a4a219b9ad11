"""Q&A clustering pipeline: posting lines -> vectors -> seeded k-means -> cluster report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from kestrel.constants import (DEFAULT_ETA, DEFAULT_K, DEFAULT_MAX_ITER, DEFAULT_SPREAD, DEFAULT_TERMS,
                               SAMPLE_SEED, STRATIFIED_MIN_SPREAD)
from kestrel.operators.checks import expect_row_count
from kestrel.operators.kmeans import KMeansResult, LloydPoints, kmeans_of, weighted_points
from kestrel.operators.qa import scored_vectors
from kestrel.operators.report import cluster_report_lines, cluster_results
from kestrel.operators.sampling import initial_centres
from kestrel.session import Scratch
from kestrel.sources.postings import parse_postings


@dataclass
class QAClusteringResult:
    """Close it (or use it as a context manager) once its frames have been read: that deletes their files."""

    vectors: DataFrame          # materialised (Parquet in the checkpoint folder), not cached
    points: DataFrame           # weighted distinct points (x, y, w), materialised
    kmeans: KMeansResult
    results: DataFrame          # (cluster, label, percent, size, median_score)
    report: DataFrame           # (line_no, line)
    scratch: Scratch

    def close(self) -> None:
        self.scratch.close()

    def __enter__(self) -> QAClusteringResult:
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def qa_vectors(lines: DataFrame, categories: Sequence[str] = DEFAULT_TERMS, spread: int = DEFAULT_SPREAD,
               *, line_col: str = "value", strict: bool = True) -> DataFrame:
    """Parse -> group/score -> ``(question_id, x, y)``; lazy."""
    postings = parse_postings(lines, line_col)
    return scored_vectors(postings, categories, spread, strict=strict)


def cluster_vectors(vectors: DataFrame, categories: Sequence[str] = DEFAULT_TERMS, *,
                    spread: int = DEFAULT_SPREAD, k: int = DEFAULT_K, eta: float = DEFAULT_ETA,
                    max_iter: int = DEFAULT_MAX_ITER, seed: int = SAMPLE_SEED,
                    expected_vectors: int | None = None) -> QAClusteringResult:
    """Seeded k-means and the cluster report over ``(question_id, x, y)`` vectors.

    The vectors are written once to the shared checkpoint folder; the count check,
    the weighted distinct points and the seed sample read that copy.
    Every k-means step and the final statistics read the (small) weighted points.
    ``expected_vectors`` fails the job early when the vector count differs.
    """
    scratch = Scratch(vectors.sparkSession)
    try:
        vectors = scratch.materialize(vectors.select("question_id", "x", "y"), "qa-vectors")
        if expected_vectors is not None:
            expect_row_count(vectors, expected_vectors, strict=True).collect()
        points = scratch.materialize(weighted_points(vectors), "qa-points")
        seeds = initial_centres(vectors, k, categories, spread, seed=seed,
                                min_stratified_spread=STRATIFIED_MIN_SPREAD)
        with LloydPoints(points, scratch) as ready:  # cached only here; the report's points are assigned once
            result = kmeans_of(ready, seeds, eta=eta, max_iter=max_iter)
            assigned = scratch.materialize(ready.assigned(result.centres), "qa-assigned")
        results = cluster_results(vectors, result.centres, categories, spread, assigned=assigned)
    except BaseException:
        scratch.close()
        raise
    return QAClusteringResult(vectors, points, result, results, cluster_report_lines(results), scratch)


def qa_cluster_pipeline(lines: DataFrame, categories: Sequence[str] = DEFAULT_TERMS, *,
                        spread: int = DEFAULT_SPREAD, k: int = DEFAULT_K, eta: float = DEFAULT_ETA,
                        max_iter: int = DEFAULT_MAX_ITER, seed: int = SAMPLE_SEED,
                        expected_vectors: int | None = None, line_col: str = "value",
                        strict: bool = True) -> QAClusteringResult:
    """The whole clustering job: posting lines -> vectors -> :func:`cluster_vectors`."""
    return cluster_vectors(qa_vectors(lines, categories, spread, line_col=line_col, strict=strict), categories,
                           spread=spread, k=k, eta=eta, max_iter=max_iter, seed=seed,
                           expected_vectors=expected_vectors)
