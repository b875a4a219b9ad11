"""The registered queries of this package: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm.chat_format import OP6_SQL, op6_chat_format
from kestrel.llm.decontam import op9_decontam
from kestrel.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from kestrel.llm.line_crf import op8_line_crf
from kestrel.llm.periodic_runs import op12_periodic_runs
from kestrel.llm.pfair_mix import op1_pfair_mix
from kestrel.llm.rule_ledger import OP10_SQL, op10_rule_ledger
from kestrel.llm.secret_scan import op5_secret_scan
from kestrel.llm.simhash_dedup import op3_simhash_dedup
from kestrel.llm.substring_dedup import OP4_SQL, op4_substring_dedup
from kestrel.llm.token_records import op2_token_records
from kestrel.llm.url_filter import op7_url_filter
from kestrel.llm.warc_archive import OP13_SQL, op13_warc

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_pfair_mix, op2_token_records, op3_simhash_dedup, op4_substring_dedup, op5_secret_scan, op6_chat_format,
    op7_url_filter, op8_line_crf, op9_decontam, op10_rule_ledger, op11_hard_negatives,
    op12_periodic_runs, op13_warc)}

#: DuckDB twins where SQL can express the result; the others are tested against brute force.
LLM_SQL: dict[str, str] = {
    "op4_substring_dedup": OP4_SQL,
    "op6_chat_format": OP6_SQL,
    "op10_rule_ledger": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_warc": OP13_SQL,
}
