"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each function returns one SQL text over the driver's tables.  The k-means oracle is
an unrolled chain of ``steps`` materialised CTEs: step i assigns points to the
centres of step i-1, averages them, and freezes once the summed squared move drops
below eta, so surplus steps are no-ops.
"""

from __future__ import annotations

from collections.abc import Sequence

from kestrel.constants import REPORT_HEADER, REPORT_ROW_FORMAT
from kestrel.plans.fixtures import with_fixtures

ORACLE_STEPS = 10
#: Part sizes of the grouped queries (small, so that the tables give several parts).
MAX_PAIRS = 3
MAX_POSTINGS = 50

#: Questions and answers as sides of their own, so that a planner sees their real sizes.
QA_SIDES = [
    ("qs", "SELECT id AS question_id, accepted_answer AS q_accepted_answer, score AS q_score, tags AS q_tags "
           "FROM fx_postings WHERE posting_type = 1"),
    ("ans", "SELECT parent_id AS question_id, id AS answer_id, score AS answer_score "
            "FROM fx_postings WHERE posting_type = 2"),
]


def dealt(number: str, n_parts: str) -> str:
    """The part of an id: its place in its block of ``n_parts`` ids, turned by the block number's md5."""
    turn = f"CAST('0x' || substr(md5(CAST({number} // {n_parts} AS VARCHAR)), 1, 8) AS BIGINT)"
    return f"CAST(({number} % {n_parts} + {turn}) % {n_parts} AS INTEGER)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values: Sequence[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def terms_values(terms: Sequence[str]) -> str:
    """``(pos, term)`` rows, pos 1-based."""
    return "SELECT * FROM (VALUES " + ", ".join(f"({i + 1}, {q(t)})" for i, t in enumerate(terms)) + ") t(pos, term)"


def mentions(text: str, term_expr: str) -> str:
    return f"coalesce(list_contains(string_split({text}, ' '), {term_expr}), false)"


# ------------------------------------------------------------------ text ranking

def present_pairs(terms: Sequence[str], source: str = "documents", id_col: str = "doc_id",
                  text_col: str = "text") -> str:
    return (f"SELECT d.{id_col} AS id, t.term FROM {source} d CROSS JOIN ({terms_values(terms)}) t "
            f"WHERE {mentions('d.' + text_col, 't.term')}")


def indicator_rows(terms: Sequence[str], source: str = "documents", id_col: str = "doc_id",
                   text_col: str = "text") -> str:
    return (f"SELECT d.{id_col} AS id, t.term, CAST({mentions('d.' + text_col, 't.term')} AS INTEGER) AS hit "
            f"FROM {source} d CROSS JOIN ({terms_values(terms)}) t")


def ranked(counts_sql: str, terms: Sequence[str]) -> str:
    """Rank ``(term, n)`` rows: n desc, then term-list position."""
    return (f"SELECT CAST(row_number() OVER (ORDER BY c.n DESC, t.pos) AS INTEGER) AS rank, c.term, "
            f"CAST(c.n AS BIGINT) AS n FROM ({counts_sql}) c JOIN ({terms_values(terms)}) t USING (term)")


def rank_complete(terms: Sequence[str], **kw) -> str:
    counts = (f"SELECT t.term, coalesce(p.n, 0) AS n FROM ({terms_values(terms)}) t LEFT JOIN "
              f"(SELECT term, count(*) AS n FROM ({present_pairs(terms, **kw)}) GROUP BY term) p USING (term)")
    return ranked(counts, terms)


def rank_from_index(terms: Sequence[str], **kw) -> str:
    return ranked(f"SELECT term, count(*) AS n FROM ({present_pairs(terms, **kw)}) GROUP BY term", terms)


def rank_single_pass(terms: Sequence[str], **kw) -> str:
    return ranked(f"SELECT term, sum(hit) AS n FROM ({indicator_rows(terms, **kw)}) GROUP BY term", terms)


def parse_articles(source: str, line_col: str = "line", keep: str = "doc_id") -> str:
    pos = f"instr({line_col}, '</title><text>')"
    return (f"SELECT {keep}, substring({line_col}, 15, {pos} - 15) AS title, "
            f"substring({line_col}, {pos} + 14, length({line_col}) - 16 - ({pos} + 13)) AS text FROM {source}")


# ------------------------------------------------------------------ postings

def parse_postings(source: str, line_col: str = "line") -> str:
    return f"""SELECT CAST(f[1] AS INTEGER) AS posting_type, CAST(f[2] AS BIGINT) AS id,
               CAST(nullif(f[3], '') AS BIGINT) AS accepted_answer, CAST(nullif(f[4], '') AS BIGINT) AS parent_id,
               CAST(f[5] AS INTEGER) AS score, CASE WHEN len(f) >= 6 THEN f[6] END AS tags
        FROM (SELECT string_split(rtrim({line_col}, ','), ',') AS f FROM {source})"""


def scored(postings: str) -> str:
    return f"""SELECT q.id AS question_id, q.accepted_answer, q.score, q.tags,
               CAST(greatest(max(a.score), 0) AS INTEGER) AS high_score
        FROM {postings} q JOIN {postings} a ON a.parent_id = q.id
        WHERE q.posting_type = 1 AND a.posting_type = 2
        GROUP BY q.id, q.accepted_answer, q.score, q.tags"""


def vectors(scored_src: str, categories: Sequence[str], spread: int) -> str:
    return (f"SELECT question_id, CAST((list_position({sql_list(categories)}, tags) - 1) * {spread} AS INTEGER) AS x, "
            f"high_score AS y FROM {scored_src}")


# ------------------------------------------------------------------ sampling

def sample_key(id_col: str = "question_id", seed: int = 42) -> str:
    return f"md5(concat('{int(seed)}:', CAST({id_col} AS VARCHAR)))"


def stratified_sample(vec: str, per_stratum: int, seed: int = 42) -> str:
    return (f"SELECT question_id, x, y, sample_rank FROM (SELECT question_id, x, y, CAST(row_number() OVER "
            f"(PARTITION BY x ORDER BY {sample_key(seed=seed)}, question_id) AS INTEGER) AS sample_rank FROM {vec}) "
            f"WHERE sample_rank <= {int(per_stratum)}")


def global_sample(vec: str, k: int, seed: int = 42) -> str:
    return f"SELECT question_id, x, y FROM {vec} ORDER BY {sample_key(seed=seed)}, question_id LIMIT {int(k)}"


def seeds(vec: str, *, stratified: bool, k: int, n_categories: int, seed: int = 42) -> str:
    """``(cluster, x, y)``: centre i is the i-th seed, in the order the Spark side uses."""
    if stratified:
        body = stratified_sample(vec, k // n_categories, seed)
        order = f"x, {sample_key(seed=seed)}, question_id"
    else:
        body = global_sample(vec, k, seed)
        order = f"{sample_key(seed=seed)}, question_id"
    return f"SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS cluster, x, y FROM ({body})"


# ------------------------------------------------------------------ k-means chain

def sqdist(ax: str, ay: str, bx: str, by: str) -> str:
    return (f"((CAST({ax} AS DOUBLE) - CAST({bx} AS DOUBLE)) * (CAST({ax} AS DOUBLE) - CAST({bx} AS DOUBLE)) + "
            f"(CAST({ay} AS DOUBLE) - CAST({by} AS DOUBLE)) * (CAST({ay} AS DOUBLE) - CAST({by} AS DOUBLE)))")


def assign(vec: str, centres: str) -> str:
    return (f"SELECT p.question_id, p.x, p.y, "
            f"arg_min(c.cluster, ({sqdist('p.x', 'p.y', 'c.x', 'c.y')}, c.cluster)) AS cluster, "
            f"min({sqdist('p.x', 'p.y', 'c.x', 'c.y')}) AS dist "
            f"FROM {vec} p CROSS JOIN {centres} c GROUP BY p.question_id, p.x, p.y")


def kmeans_chain(vec: str, seeds_sql: str, *, eta: float, max_iter: int,
                 steps: int = ORACLE_STEPS) -> list[tuple[str, str]]:
    """CTEs ``c0 .. c{steps}`` (centres + done flag) and ``n{i}``/``d{i}`` (step i's new means and move)."""
    def over(i: int) -> str:
        return f"(n.was_done OR d.displacement < {float(eta)} OR {i} >= {int(max_iter)})"

    def settled(i: int) -> str:
        # the last step must have converged: the chain never stops short in silence
        x = "CASE WHEN n.was_done THEN n.old_x ELSE n.new_x END"
        return x if i < steps else f"CASE WHEN {over(i)} THEN {x} ELSE error('k-means needs more steps') END"

    ctes: list[tuple[str, str]] = [
        ("c0", f"SELECT cluster, x, y, false AS done FROM ({seeds_sql})")]
    for i in range(1, steps + 1):
        p = f"c{i - 1}"
        ctes += [
            (f"a{i}", assign(vec, p)),
            (f"m{i}", f"SELECT cluster, CAST(sum(x) // count(*) AS INTEGER) AS x, "
                      f"CAST(sum(y) // count(*) AS INTEGER) AS y FROM a{i} GROUP BY cluster"),
            (f"n{i}", f"SELECT c.cluster, c.x AS old_x, c.y AS old_y, coalesce(m.x, c.x) AS new_x, "
                      f"coalesce(m.y, c.y) AS new_y, c.done AS was_done FROM {p} c LEFT JOIN m{i} m USING (cluster)"),
            (f"d{i}", f"SELECT sum({sqdist('new_x', 'new_y', 'old_x', 'old_y')}) AS displacement FROM n{i}"),
            (f"c{i}", f"SELECT n.cluster, {settled(i)} AS x, "
                      f"CASE WHEN n.was_done THEN n.old_y ELSE n.new_y END AS y, {over(i)} AS done "
                      f"FROM n{i} n CROSS JOIN d{i} d"),
        ]
    return ctes


def trace_rows(steps: int = ORACLE_STEPS, eta: float = 20.0) -> str:
    parts = [f"SELECT CAST({i} AS INTEGER) AS iter, cluster, old_x, old_y, new_x, new_y, "
             f"{sqdist('new_x', 'new_y', 'old_x', 'old_y')} AS dist, d.displacement, "
             f"d.displacement < {float(eta)} AS converged FROM n{i} CROSS JOIN d{i} d WHERE NOT was_done"
             for i in range(1, steps + 1)]
    return " UNION ALL ".join(parts)


def with_ctes(fixtures: list[str], ctes: list[tuple[str, str]], final: str) -> str:
    return with_fixtures(fixtures, ctes, final)


# ------------------------------------------------------------------ the registry's SQL twins

def oracle_queries() -> dict[str, str]:
    from kestrel.plans import fixtures as FX

    T = FX.FIXTURE_TERMS
    P = FX.ORDER_PRIORITIES
    k, eta, spread, mixed = FX.FIXTURE_K, FX.FIXTURE_ETA, FX.FIXTURE_SPREAD, FX.FIXTURE_MIXED_SPREAD
    per = k // len(P)
    W = with_fixtures
    docs_rank = dict(source="documents", id_col="doc_id", text_col="text")

    # k-means chains
    strat_seeds = seeds("fx_vectors", stratified=True, k=k, n_categories=len(P))
    glob_seeds = seeds("fx_vectors_mixed", stratified=False, k=k, n_categories=len(P))
    chain_s = kmeans_chain("fx_vectors", "SELECT * FROM seeds_s", eta=eta, max_iter=120)
    chain_m = kmeans_chain("fx_vectors_mixed", "SELECT * FROM seeds_m", eta=eta, max_iter=120)
    last = f"c{ORACLE_STEPS}"
    S = [("seeds_s", strat_seeds)] + chain_s
    M = [("seeds_m", glob_seeds)] + chain_m
    membership_m = M + [("fa", assign("fx_vectors_mixed", last))]

    def results_ctes(assigned: str, categories, sp: int) -> list[tuple[str, str]]:
        return [
            ("cnt", f"SELECT cluster, x, count(*) AS n FROM {assigned} GROUP BY cluster, x"),
            ("dom", "SELECT cluster, arg_max(x, (n, -x)) AS dominant_x, max(n) AS dominant_n, sum(n) AS size "
                    "FROM cnt GROUP BY cluster"),
            ("med", f"SELECT cluster, CAST(trunc(quantile_cont(y, 0.5)) AS INTEGER) AS median_score "
                    f"FROM {assigned} GROUP BY cluster"),
            ("res", f"SELECT d.cluster, {sql_list(categories)}[CAST(d.dominant_x // {sp} AS INTEGER) + 1] AS label, "
                    f"CAST((d.dominant_n * 100) // d.size AS DOUBLE) AS percent, CAST(d.size AS BIGINT) AS size, "
                    f"m.median_score FROM dom d JOIN med m USING (cluster)"),
        ]

    header = ", ".join(f"({i}, {q(h)})" for i, h in enumerate(REPORT_HEADER))
    report_sql = (
        f"SELECT * FROM (VALUES {header}) h(line_no, line) UNION ALL "
        f"SELECT CAST(row_number() OVER (ORDER BY median_score, label, cluster) + {len(REPORT_HEADER) - 1} AS INTEGER) AS line_no, "
        f"printf({q(REPORT_ROW_FORMAT)}, median_score, label, percent, size) AS line FROM res")

    pipeline_ctes = [
        ("pp", parse_postings("fx_posting_lines")),
        ("ps", scored("pp")),
        ("pv", vectors("ps", P, spread)),
        ("seeds_p", seeds("pv", stratified=True, k=k, n_categories=len(P))),
    ] + kmeans_chain("pv", "SELECT * FROM seeds_p", eta=eta, max_iter=120) + [
        ("pa", assign("pv", last)),
    ] + results_ctes("pa", P, spread)

    converged_rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS iter, d.displacement, CAST({float(eta)} AS DOUBLE) AS eta, "
        f"d.displacement < {float(eta)} "
        f"AS converged FROM d{i} d WHERE NOT (SELECT bool_or(was_done) FROM n{i})"
        for i in range(1, ORACLE_STEPS + 1))

    answered = ("SELECT count(*) FROM (SELECT DISTINCT q.id FROM fx_postings q JOIN fx_postings a ON a.parent_id = q.id "
                "WHERE q.posting_type = 1 AND a.posting_type = 2)")

    out = {
        # text ranking on documents
        "mentions_term": f"SELECT doc_id, {mentions('text', q(T[0]))} AS mentions FROM documents",
        "explode_present_terms": f"SELECT id AS doc_id, term FROM ({present_pairs(T, **docs_rank)})",
        "term_indicator": f"SELECT id AS doc_id, term, hit FROM ({indicator_rows(T, **docs_rank)})",
        "occurrences_of_term": f"SELECT {q(T[0])} AS term, CAST(count(*) FILTER (WHERE {mentions('text', q(T[0]))}) "
                               f"AS BIGINT) AS n FROM documents",
        "rank_terms": rank_complete(T, **docs_rank),
        "inverted_index": f"SELECT term, id AS doc_id FROM ({present_pairs(T, **docs_rank)})",
        "inverted_index_parts": (
            f"WITH p AS ({present_pairs(T, **docs_rank)}), s AS (SELECT term, CAST(ceil(count(*) / "
            f"CAST({MAX_POSTINGS} AS DOUBLE)) AS INTEGER) AS n_parts FROM p GROUP BY term) "
            f"SELECT term, {dealt('id', 'n_parts')} AS part, n_parts, string_agg(id, ',' ORDER BY id) AS doc_ids "
            "FROM p JOIN s USING (term) GROUP BY ALL"),
        "rank_terms_from_index": rank_from_index(T, **docs_rank),
        "rank_terms_single_pass": rank_single_pass(T, **docs_rank),
        "top_term": f"SELECT * FROM ({rank_complete(T, **docs_rank)}) WHERE rank = 1",
        # article lines
        "read_article_lines": W(["fx_article_lines"], [], "SELECT line AS value FROM fx_article_lines"),
        "parse_article_lines": W(["fx_article_lines"], [], parse_articles("fx_article_lines")),
        "term_ranking_pipeline": W(["fx_article_lines"], [("arts", parse_articles("fx_article_lines"))], (
            f"SELECT 'complete' AS method, * FROM ({rank_complete(T, source='arts', id_col='title')}) UNION ALL "
            f"SELECT 'index', * FROM ({rank_from_index(T, source='arts', id_col='title')}) UNION ALL "
            f"SELECT 'single_pass', * FROM ({rank_single_pass(T, source='arts', id_col='title')})")),
        # postings
        "read_posting_lines": W(["fx_posting_lines"], [], "SELECT line AS value FROM fx_posting_lines"),
        "parse_postings": W(["fx_posting_lines"], [], parse_postings("fx_posting_lines")),
        "qa_cluster_pipeline": W(["fx_posting_lines"], pipeline_ctes,
                                 "SELECT cluster, label, percent, size, median_score FROM res"),
        "filter_questions": W(["fx_postings"], [], "SELECT * FROM fx_postings WHERE posting_type = 1"),
        "filter_answers": W(["fx_postings"], [], "SELECT * FROM fx_postings WHERE posting_type = 2"),
        "answer_keys": W(["fx_postings"], [], "SELECT parent_id AS question_id, id AS answer_id, score AS answer_score "
                                              "FROM fx_postings WHERE posting_type = 2"),
        "join_questions_answers": W(["fx_postings"], QA_SIDES, (
            "SELECT question_id, q_accepted_answer, q_score, q_tags, answer_id, answer_score FROM qs JOIN ans USING (question_id)")),
        "grouped_pair_parts": W(["fx_postings"], QA_SIDES + [
            ("sizes", "SELECT question_id, CAST(ceil(count(*) / CAST(" + str(MAX_PAIRS) + " AS DOUBLE)) AS INTEGER) AS n_parts "
                      "FROM ans GROUP BY question_id")], (
            f"SELECT question_id, {dealt('answer_id', 'n_parts')} AS part, n_parts, q_accepted_answer, q_score, q_tags, "
            "string_agg(concat_ws(':', answer_id, answer_score), ',' ORDER BY answer_id, answer_score) AS answers "
            "FROM qs JOIN ans USING (question_id) JOIN sizes USING (question_id) GROUP BY ALL")),
        "grouped_postings": W(["fx_postings"], [], (
            "SELECT q.id AS question_id, CAST(count(*) AS BIGINT) AS n_pairs "
            "FROM fx_postings q JOIN fx_postings a ON a.parent_id = q.id "
            "WHERE q.posting_type = 1 AND a.posting_type = 2 GROUP BY q.id")),
        "scored_postings": W(["fx_scored"], [], "SELECT * FROM fx_scored"),
        "category_index": W(["fx_postings"], [], (
            f"SELECT id, tags, CAST(list_position({sql_list(P)}, tags) - 1 AS INTEGER) AS category "
            f"FROM fx_postings WHERE posting_type = 1")),
        "vector_postings": W(["fx_vectors"], [], "SELECT * FROM fx_vectors"),
        # vectors
        "expect_row_count": W(["fx_vectors"], [], (
            f"SELECT n, expected, n = expected AS ok FROM (SELECT CAST(count(*) AS BIGINT) AS n, "
            f"CAST(({answered}) AS BIGINT) AS expected FROM fx_vectors)")),
        "category_label": W(["fx_vectors"], [], (
            f"SELECT question_id, x, {sql_list(P)}[CAST(x // {spread} AS INTEGER) + 1] AS label FROM fx_vectors")),
        "stratified_sample": W(["fx_vectors"], [], stratified_sample("fx_vectors", per)),
        "sample_stratum_check": W(["fx_vectors"], [], (
            f"SELECT c.term AS category, CAST((c.pos - 1) * {spread} AS INTEGER) AS x, "
            f"CAST(coalesce(n.n_rows, 0) AS BIGINT) AS n_rows, CAST({per} AS BIGINT) AS needed, "
            f"coalesce(n.n_rows, 0) >= {per} AS ok FROM ({terms_values(P)}) c LEFT JOIN "
            f"(SELECT x, count(*) AS n_rows FROM fx_vectors GROUP BY x) n "
            f"ON n.x = CAST((c.pos - 1) * {spread} AS INTEGER)")),
        "kmeans_step": W(["fx_vectors"], S, "SELECT cluster, new_x AS x, new_y AS y FROM n1"),
        "center_displacement": W(["fx_vectors"], S, "SELECT displacement FROM d1"),
        "kmeans_converged": W(["fx_vectors"], S, converged_rows),
        "kmeans_trace": W(["fx_vectors"], S, trace_rows(ORACLE_STEPS, eta)),
        "kmeans_centers": W(["fx_vectors"], S, f"SELECT cluster, x, y FROM {last}"),
        # mixed vectors
        "global_sample": W(["fx_vectors_mixed"], [], global_sample("fx_vectors_mixed", k)),
        "squared_distance": W(["fx_vectors_mixed"], [("seeds_m", glob_seeds)], (
            f"SELECT v.question_id, {sqdist('v.x', 'v.y', 's.x', 's.y')} AS dist "
            f"FROM fx_vectors_mixed v CROSS JOIN (SELECT x, y FROM seeds_m WHERE cluster = 0) s")),
        "assign_nearest": W(["fx_vectors_mixed"], [("seeds_m", glob_seeds)], (
            f"SELECT question_id, cluster, dist FROM ({assign('fx_vectors_mixed', 'seeds_m')})")),
        "average_vectors": W(["fx_vectors_mixed"], [], (
            f"SELECT CAST(x // {mixed} AS INTEGER) AS category, CAST(sum(x) // count(*) AS INTEGER) AS x, "
            f"CAST(sum(y) // count(*) AS INTEGER) AS y, CAST(count(*) AS BIGINT) AS n "
            f"FROM fx_vectors_mixed GROUP BY CAST(x // {mixed} AS INTEGER)")),
        "cluster_membership": W(["fx_vectors_mixed"], membership_m, "SELECT question_id, cluster, x, y FROM fa"),
        "cluster_dominant": W(["fx_vectors_mixed"], membership_m + results_ctes("fa", P, mixed), (
            "SELECT r.cluster, r.label, CAST(d.dominant_n AS BIGINT) AS dominant_n, r.size, r.percent "
            "FROM res r JOIN dom d USING (cluster)")),
        "cluster_size": W(["fx_vectors_mixed"], membership_m, (
            "SELECT cluster, CAST(count(*) AS BIGINT) AS size FROM fa GROUP BY cluster")),
        "cluster_median": W(["fx_vectors_mixed"], membership_m + results_ctes("fa", P, mixed),
                            "SELECT cluster, median_score FROM med"),
        "cluster_results": W(["fx_vectors_mixed"], membership_m + results_ctes("fa", P, mixed),
                             "SELECT cluster, label, percent, size, median_score FROM res"),
        "cluster_report_lines": W(["fx_vectors_mixed"], membership_m + results_ctes("fa", P, mixed), report_sql),
        # lists
        "sum_or_zero": W(["fx_numbers"], [], "SELECT CAST(coalesce(sum(v), 0) AS BIGINT) AS total FROM fx_numbers"),
        "strict_max": W(["fx_numbers"], [], "SELECT max(v) AS max_v FROM fx_numbers"),
        # checks on rankings
        "diff_rows": (
            f"SELECT 'unexpected' AS side, * FROM (SELECT term, n FROM ({rank_from_index(T, **docs_rank)}) "
            f"EXCEPT SELECT term, n FROM ({rank_complete(T, **docs_rank)})) UNION ALL "
            f"SELECT 'missing' AS side, * FROM (SELECT term, n FROM ({rank_complete(T, **docs_rank)}) "
            f"EXCEPT SELECT term, n FROM ({rank_from_index(T, **docs_rank)}))"),
        "order_violations": (
            f"WITH r AS MATERIALIZED ({rank_complete(T, **docs_rank)}), "
            f"s AS MATERIALIZED ({rank_single_pass(T, **docs_rank)}), "
            f"v AS (SELECT CAST(count(*) AS BIGINT) AS n_rows, "
            f"CAST(count(*) FILTER (WHERE n > prev_n) AS BIGINT) AS violations "
            f"FROM (SELECT n, lag(n) OVER (ORDER BY rank) AS prev_n FROM r)), "
            f"d AS (SELECT CAST(count(*) AS BIGINT) AS n_diff FROM ("
            f"(SELECT term, n FROM r EXCEPT SELECT term, n FROM s) UNION ALL "
            f"(SELECT term, n FROM s EXCEPT SELECT term, n FROM r))) "
            f"SELECT n_rows, violations, n_diff, violations = 0 AND n_diff = 0 AS ok FROM v CROSS JOIN d"),
    }
    return out
