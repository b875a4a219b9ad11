import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # tests own their session, so they set their own checkpoint folder
    ckpt = tempfile.mkdtemp(prefix="kestrel-test-ckpt-", dir="/tmp")
    s = local_session("*", shuffle_partitions=8, app="kestrel-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]


def raises_spark(fn, fragment: str):
    """Run ``fn`` and assert it fails with ``fragment`` somewhere in the error text."""
    with pytest.raises(Exception) as info:
        fn()
    assert fragment in str(info.value), str(info.value)[:500]


def executed_plan(df) -> str:
    """Run ``df``'s own QueryExecution and return its final (adaptive) physical plan."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString().split("== Initial Plan ==")[0]


class conf_override:
    """Temporarily set session confs (restored afterwards)."""

    def __init__(self, spark, **settings):
        self.spark, self.settings, self.saved = spark, settings, {}

    def __enter__(self):
        for k, v in self.settings.items():
            key = k.replace("__", ".")
            self.saved[key] = self.spark.conf.get(key, None)
            self.spark.conf.set(key, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
