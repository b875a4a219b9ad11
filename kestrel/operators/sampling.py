"""Fixed-size seeded samples of vectors, used as k-means seeds.

Order-independent and reproducible: every row gets the key
``md5('<seed>:' || id)`` and a sample is "the first n rows by (key, id)".  The same
rows come out whatever the partitioning, and a plain SQL engine can reproduce them.

Per-stratum sampling is a ``row_number() <= n`` window.  Spark plans it with a
partial ``WindowGroupLimit`` *before* the shuffle, so each task sends at most n rows
per stratum: a stratum holding a third of all rows does not land in one task.
That limit needs its input sorted; the sort spills.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.constants import SAMPLE_SEED
from kestrel.functions.categories import categories_array, check_spread
from kestrel.functions.strict import check


def sample_key(id_col: str, seed: int = SAMPLE_SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col(id_col).cast("string")))


def stratified_sample(vectors: DataFrame, per_stratum: int, *, seed: int = SAMPLE_SEED,
                      stratum_col: str = "x", id_col: str = "question_id") -> DataFrame:
    """At most ``per_stratum`` rows from each stratum, without replacement.

    Adds ``sample_rank`` (1-based position inside the stratum).
    """
    if per_stratum <= 0:
        raise ValueError("per_stratum must be positive")
    w = Window.partitionBy(stratum_col).orderBy(sample_key(id_col, seed), F.col(id_col))
    return (vectors.withColumn("sample_rank", F.row_number().over(w))
            .where(F.col("sample_rank") <= per_stratum))


def global_sample(vectors: DataFrame, k: int, *, seed: int = SAMPLE_SEED,
                  id_col: str = "question_id") -> DataFrame:
    """Exactly ``min(k, #rows)`` rows of the whole set (``TakeOrderedAndProject``)."""
    if k <= 0:
        raise ValueError("k must be positive")
    return vectors.orderBy(sample_key(id_col, seed), F.col(id_col)).limit(k)


def per_stratum_size(k: int, categories: Sequence[str]) -> int:
    if k % len(categories) != 0:
        raise ValueError(f"k={k} must be a multiple of the number of categories ({len(categories)})")
    return k // len(categories)


def sample_stratum_check(vectors: DataFrame, categories: Sequence[str], spread: int, per_stratum: int,
                         *, strict: bool = False, stratum_col: str = "x") -> DataFrame:
    """Per category ``(category, x, n_rows, needed, ok)``: can it give ``per_stratum`` seeds?

    Categories without any row are listed with ``n_rows = 0``.  ``strict`` fails the
    job on the first stratum that is too small.
    """
    check_spread(spread)
    spark = vectors.sparkSession
    cats = (spark.range(1)
            .select(F.posexplode(categories_array(categories)).alias("pos", "category"))
            .select("category", (F.col("pos") * F.lit(spread)).cast("int").alias("x")))
    counts = vectors.groupBy(F.col(stratum_col).alias("x")).agg(F.count(F.lit(1)).alias("n_rows"))
    # no broadcast hint: for arbitrary input the distinct x are not bounded by the
    # category list; AQE broadcasts at run time when the measured size is small
    out = cats.join(counts, "x", "left").select(
        "category", "x", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        F.lit(per_stratum).cast("bigint").alias("needed"))
    ok = F.col("n_rows") >= F.col("needed")
    if strict:
        ok = check(ok, f"a category has fewer than {per_stratum} vectors to sample")
    return out.withColumn("ok", ok)


def initial_centres(vectors: DataFrame, k: int, categories: Sequence[str], spread: int, *,
                    seed: int = SAMPLE_SEED, min_stratified_spread: int = 500,
                    id_col: str = "question_id") -> list[tuple[int, int]]:
    """k seed centres on the driver (at most k + 1 rows are collected).

    ``spread >= min_stratified_spread``: ``k / #categories`` per category, ordered by
    (x, key, id); otherwise a global sample ordered by (key, id).  Centre i is the
    i-th seed.  Fails unless exactly k seeds were found; an x that belongs to no
    category fails the job inside the plan.
    """
    check_spread(spread)
    key = sample_key(id_col, seed)
    if spread >= min_stratified_spread:
        n = per_stratum_size(k, categories)
        known = F.col("x").isin([i * spread for i in range(len(categories))])
        own = vectors.withColumn("x", F.when(check(known, "a vector's x belongs to no category"), F.col("x")))
        sample, order = stratified_sample(own, n, seed=seed, id_col=id_col), [F.col("x"), key, F.col(id_col)]
    else:
        sample, order = global_sample(vectors, k, seed=seed, id_col=id_col), [key, F.col(id_col)]
    rows = sample.orderBy(*order).select("x", "y").limit(k + 1).collect()
    if len(rows) != k:
        raise ValueError(f"sampling gave {len(rows)} seeds, expected {k}")
    return [(int(r["x"]), int(r["y"])) for r in rows]
