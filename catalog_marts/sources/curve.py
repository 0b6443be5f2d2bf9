"""A sort key along a space-filling curve, so that files cover small ranges of several columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6  # of a column's rank: 64 ranges of about as many rows each
SAMPLE = 20_000  # rows that the ranges are taken from; it decides on the layout alone


def _bounds(values: list, ranges: int) -> list:
    """Values that cut the sample into ranges of even size; repeated ones once."""
    values = sorted(v for v in values if v is not None)
    cuts = [values[len(values) * i // ranges] for i in range(1, ranges)] if values else []
    return list(dict.fromkeys(cuts))


def _rank(column: str, bounds: list, kind: str) -> Column:
    """How many bounds a value reaches; NULL ranks first, with the smallest values."""
    if not bounds:
        return F.lit(0)
    known = F.array(*[F.lit(b).cast(kind) for b in bounds])
    return F.coalesce(F.size(F.filter(known, lambda b: b <= F.col(column))), F.lit(0))


def curve_position(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on a Z-shaped curve through the quantile ranks of its keys.

    The bits of the ranks alternate, the first key's first. So rows that are close on the curve are
    close in every key, and a file of consecutive rows covers a small range of each. Ranks are
    those of quantiles, so a skewed key fills its ranges evenly; a value that holds many rows takes
    one rank. The driver receives a sample of bounded size (rows with the smallest hash).
    """
    if not 2 <= len(keys) <= 63 // bits:
        raise ValueError(f"a curve has 2 to {63 // bits} keys")
    names = [F.col(k) for k in keys]
    sample = df.select(*names).orderBy(F.xxhash64(*names, F.spark_partition_id(), F.monotonically_increasing_id())).limit(SAMPLE).collect()
    types, ranks = dict(df.dtypes), []
    for i, key in enumerate(keys):
        ranks.append(_rank(key, _bounds([row[i] for row in sample], 1 << bits), types[key]))
    parts = []
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(1).cast("bigint")
            parts.append(F.shiftleft(one, bit * len(keys) + len(keys) - 1 - i))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)
