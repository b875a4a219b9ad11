"""Property tests: random inputs against brute-force models of the original semantics."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from kestrel.operators import kmeans as KM
from kestrel.operators import ranking as R
from kestrel.operators import report
from kestrel.sources.local import local_articles
from kestrel.sources.postings import POSTING_COLUMNS, parse_postings

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

WORDS = ["Java", "Scala", "JavaScript", "C#", "C++", "Java,", "java", "", " ", "\n", "Java\nScala", "x"]


def java_like_tokens(text):
    # splitting on the single space; empty tokens never equal a (non-empty) term
    return text.split(" ")


@SETTINGS
@given(docs=st.lists(st.one_of(st.none(), st.lists(st.sampled_from(WORDS), max_size=8).map(" ".join)),
                     max_size=12),
       terms=st.lists(st.sampled_from(["Java", "Scala", "C#", "C++", "Perl", "JavaScript"]), min_size=1,
                      max_size=5, unique=True))
def test_rankings_match_brute_force(spark, docs, terms):
    arts = local_articles(spark, [(str(i), d) for i, d in enumerate(docs)])
    counts = {t: sum(1 for d in docs if d is not None and t in java_like_tokens(d)) for t in terms}
    expected = sorted(terms, key=lambda t: (-counts[t], terms.index(t)))
    got = rows(R.rank_terms(arts, terms), "term", "n")
    assert got == [(t, counts[t]) for t in expected]
    single = rows(R.rank_terms_single_pass(arts, terms), "term", "n")
    assert single == ([(t, counts[t]) for t in expected] if docs else [])
    idx = rows(R.rank_terms_from_index(R.inverted_index(arts, terms), terms), "term", "n")
    assert idx == [(t, counts[t]) for t in expected if counts[t] > 0]


def java_split_comma(line):
    parts = line.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


field = st.one_of(st.just(""), st.integers(min_value=-999, max_value=99999).map(str))


@SETTINGS
@given(lines=st.lists(st.tuples(st.sampled_from(["1", "2"]), st.integers(0, 10**6).map(str), field, field,
                                st.integers(-50, 50).map(str),
                                st.lists(st.sampled_from(["", "Java", "C#", "a b"]), max_size=3)),
                      min_size=1, max_size=15))
def test_posting_parser_matches_java_split(spark, lines):
    texts = [",".join([pt, i, acc, par, sc] + extra) for pt, i, acc, par, sc, extra in lines]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = rows(parse_postings(df), *POSTING_COLUMNS)
    expected = []
    for t in texts:
        a = java_split_comma(t)
        expected.append((int(a[0]), int(a[1]), int(a[2]) if a[2] else None, int(a[3]) if a[3] else None,
                         int(a[4]), a[5] if len(a) >= 6 else None))
    assert got == expected


def trunc_div(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def brute_step(points, centres):
    groups = {}
    for x, y in points:
        best = min(range(len(centres)),
                   key=lambda i: ((x - centres[i][0]) ** 2 + (y - centres[i][1]) ** 2, i))
        groups.setdefault(best, []).append((x, y))
    return [(trunc_div(sum(p[0] for p in groups[i]), len(groups[i])),
             trunc_div(sum(p[1] for p in groups[i]), len(groups[i]))) if i in groups else c
            for i, c in enumerate(centres)]


coord = st.integers(min_value=-60, max_value=60)


@SETTINGS
@given(points=st.lists(st.tuples(coord, coord), min_size=1, max_size=40),
       centres=st.lists(st.tuples(coord, coord), min_size=1, max_size=6))
def test_lloyd_step_matches_brute_force(spark, points, centres):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "question_id bigint, x int, y int")
    expected = brute_step(points, centres)
    assert KM.lloyd_step(df, centres) == expected
    # weighted distinct points give the same step
    assert KM.lloyd_step(KM.weighted_points(df), centres, weight="w") == expected


@SETTINGS
@given(points=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30)), min_size=1, max_size=40),
       seed=st.integers(0, 1000))
def test_cluster_statistics_match_brute_force(spark, points, seed):
    cats = ["A", "B", "C", "D"]
    rnd = random.Random(seed)
    centres = [(rnd.randint(0, 3), rnd.randint(0, 30)) for _ in range(3)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "question_id bigint, x int, y int")
    got = {r["cluster"]: (r["label"], r["percent"], r["size"], r["median_score"])
           for r in report.cluster_results(df, centres, cats, 1).collect()}
    members = {}
    for x, y in points:
        best = min(range(3), key=lambda i: ((x - centres[i][0]) ** 2 + (y - centres[i][1]) ** 2, i))
        members.setdefault(best, []).append((x, y))
    expected = {}
    for c, vs in members.items():
        per_x = {}
        for x, _ in vs:
            per_x[x] = per_x.get(x, 0) + 1
        dom = min(per_x, key=lambda x: (-per_x[x], x))
        ys = sorted(y for _, y in vs)
        n = len(ys)
        med = ys[n // 2] if n % 2 else (ys[n // 2] + ys[n // 2 - 1]) // 2
        expected[c] = (cats[dom], float(per_x[dom] * 100 // n), n, med)
    assert got == expected


@SETTINGS
@given(questions=st.lists(st.tuples(st.integers(1, 6), st.one_of(st.none(), st.integers(0, 3)),
                                    st.integers(-3, 3), st.sampled_from(["Java", "C#", "Scala", None])),
                          max_size=10),
       answers=st.lists(st.tuples(st.integers(1, 8), st.integers(-20, 20)), max_size=20))
def test_scoring_matches_brute_force(spark, questions, answers):
    from kestrel.operators import qa
    from kestrel.sources.postings import POSTING_SCHEMA
    rows_in = [(1, qid, acc, None, sc, tag) for qid, acc, sc, tag in questions]
    rows_in += [(2, 1000 + i, None, parent, sc, None) for i, (parent, sc) in enumerate(answers)]
    df = spark.createDataFrame(rows_in, POSTING_SCHEMA)
    got = sorted(rows(qa.scored_postings(df), "question_id", "accepted_answer", "score", "tags", "high_score"),
                 key=repr)

    expected = []
    for qid in sorted({q[0] for q in questions}):
        ans = [sc for parent, sc in answers if parent == qid]
        if not ans:
            continue
        recs = [(acc, sc, tag) for q, acc, sc, tag in questions if q == qid]
        # ascending struct order with nulls first, as Spark compares the records
        acc, sc, tag = min(recs, key=lambda r: tuple((v is not None, v if v is not None else "") for v in r))
        expected.append((qid, acc, sc, tag, max(max(ans), 0)))
    assert got == sorted(expected, key=repr)
    pairs = {r["question_id"]: r["n_pairs"] for r in qa.grouped_postings(df).collect()}
    assert pairs == {qid: sum(1 for q in questions if q[0] == qid) * sum(1 for p, _ in answers if p == qid)
                     for qid, *_ in expected}
