"""Command-line jobs and the shared checkpoint folder."""

import os

from conftest import SF_SMALL, rows
from kestrel.plans import fixtures as FX
from kestrel.session import checkpoint_root, materialize, scratch_path
from kestrel.sources.lines import write_lines


def test_materialize_writes_below_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = materialize(spark.range(10).selectExpr("id", "id * 2 AS v"), "t-mat")
    df.unpersist()
    # the copy outlives the cache: a lost block is re-read from the files
    files = df.inputFiles()
    assert files and all(root.replace("file:", "") in f for f in files)
    assert sorted(rows(df, "v"))[-1] == (18,)


def test_cli_rank_and_cluster(spark, capsys):
    from kestrel.__main__ import main
    art = write_lines(FX.fx_article_lines(spark, SF_SMALL), "line", scratch_path(spark, "cli-art"), line_sep="\x1e")
    assert main(["rank-terms", art, "--terms", "the", "and", "zzz", "--line-sep", "\x1e"]) == 0
    out = capsys.readouterr().out
    assert "complete" in out and "single_pass" in out and "zzz" in out
    assert main(["rank-terms", art, "--terms", "the", "and", "zzz", "--line-sep", "\x1e", "--timings"]) == 0
    out = capsys.readouterr().out
    assert "complete ranking" in out and "one-pass ranking" in out and "zzz" in out
    post = write_lines(FX.fx_posting_lines(spark, SF_SMALL), "line", scratch_path(spark, "cli-post"))
    assert main(["cluster", post, "--categories", *FX.ORDER_PRIORITIES, "--k", "5", "--spread", "50000"]) == 0
    out = capsys.readouterr().out
    assert out.splitlines()[0] == "Resulting clusters:" and "k-means:" in out
    assert main(["cluster", post, "--categories", *FX.ORDER_PRIORITIES, "--k", "5", "--debug"]) == 0
    out = capsys.readouterr().out
    assert out.startswith("Iteration 1: displacement") and "Resulting clusters:" in out
    assert os.path.isdir(art.replace("file:", ""))
