"""Dealing the rows of a group into a known number of parts by their ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dealt_part(number: str, n_parts: str) -> Column:
    """``part`` (int, 0-based) of a 64-bit id (columns by name): its place in its block of ``n_parts`` consecutive ids,
    turned by a hash of the block.

    Consecutive ids fill all parts evenly (each block has one id per part); ids in steps, whose plain
    remainders leave most parts empty, lie in blocks of their own and are spread by the hash, the leading
    eight hex digits of the block number's md5.  A null id counts as 0."""
    n = f"cast(`{n_parts}` as bigint)"
    own = f"coalesce(cast(`{number}` as bigint), 0L)"
    turn = f"cast(conv(substring(md5(cast({own} div {n} as string)), 1, 8), 16, 10) as bigint)"
    return F.expr(f"cast(pmod(pmod({own}, {n}) + {turn}, {n}) as int)")
