"""Lifetime of the scratch folders below the shared checkpoint folder."""

import os
import subprocess
import sys

from conftest import SF_SMALL
from kestrel.session import checkpoint_root, materialize, release_scratch, scratch_path, scratch_scope


def folders(spark):
    root = f"{checkpoint_root(spark)}/kestrel".removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_no_folder_is_left_when_the_scope_closes(spark):
    import __spark_entry__ as E
    before = folders(spark)
    for name, query in E.queries().items():
        if name.startswith("op") or name == "pipeline":
            continue
        with scratch_scope(spark):
            df = query(spark, SF_SMALL)
            df.count()  # results are read inside the scope
        assert folders(spark) == before, name


def test_scopes_nest_and_close_on_failure(spark):
    before = folders(spark)
    with scratch_scope(spark):
        outer = materialize(spark.range(3), "outer")
        try:
            with scratch_scope(spark):
                materialize(spark.range(4), "inner")
                assert len(folders(spark) - before) == 2
                raise KeyError
        except KeyError:
            pass
        assert len(folders(spark) - before) == 1 and outer.count() == 3
    assert folders(spark) == before


def test_folders_without_a_scope_go_on_release(spark):
    before = folders(spark)
    df = materialize(spark.range(5), "free")
    scratch_path(spark, "never-written")
    assert df.count() == 5 and len(folders(spark) - before) == 1
    release_scratch()
    assert not folders(spark) - before


def test_folders_go_when_the_process_ends(tmp_path):
    code = ("import sys; sys.path.insert(0, sys.argv[2])\n"
            "from kestrel.session import local_session, materialize\n"
            "spark = local_session(1, 1, extra={'spark.checkpoint.dir': sys.argv[1]})\n"
            "assert materialize(spark.range(5), 'left').count() == 5\n"
            "import os; assert os.listdir(sys.argv[1] + '/kestrel')\n"
            "spark.stop()\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code, str(tmp_path), root], check=True, timeout=120)
    assert os.listdir(f"{tmp_path}/kestrel") == []
