"""What the joins of the marts rely on: unique keys on the right, partners for the left."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_marts.sources import scratch_copy


class Relationship(NamedTuple):
    """``left`` joins ``right`` on their keys; every left key should occur once on the right."""

    left: str
    left_key: str
    right: str
    right_key: str

    @property
    def name(self) -> str:
        return f"{self.left}.{self.left_key} -> {self.right}.{self.right_key}"


# The joins of marts and reports, and the references of the dumps to titles.
RELATIONSHIPS = (
    Relationship("principals", "name_id", "names", "name_id"),
    Relationship("titles", "title_id", "ratings", "title_id"),
    Relationship("principals", "title_id", "ratings", "title_id"),
    Relationship("ratings", "title_id", "titles", "title_id"),
    Relationship("principals", "title_id", "titles", "title_id"),
    Relationship("akas", "title_id", "titles", "title_id"),
)

FILTER_BITS = 23  # 1 MB
_PAGE_BITS = 15  # of one bitmap, as Spark's bitmap functions build them
_PROBES = 3


def _probes(key: Column, bits: int) -> tuple[Column, Column]:
    """The page of a key in a filter of ``2 ** bits`` bits, and its positions there."""
    page = F.pmod(F.xxhash64(key), F.lit(1 << bits - _PAGE_BITS)).cast("int")
    spread = F.xxhash64(F.lit(1), key)
    at = [F.pmod(F.shiftrightunsigned(spread, _PAGE_BITS * i), F.lit(1 << _PAGE_BITS)).cast("int") for i in range(_PROBES)]
    return page, F.array(*at)


def key_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter of the non-null keys: ``_page`` and ``_bits``, ``2 ** bits`` bits in all.

    Every task sets bits in bitmaps of its own, which are then combined, so what is shuffled and
    what the filter takes depends on ``bits`` alone.
    """
    if bits < _PAGE_BITS:
        raise ValueError(f"a filter has at least {_PAGE_BITS} bits as its exponent")
    page, at = _probes(F.col(key), bits)
    probes = keys.where(F.col(key).isNotNull()).select(page.alias("_page"), F.explode(at).alias("_at"))
    return probes.groupBy("_page").agg(F.bitmap_construct_agg("_at").alias("_bits"))


def may_hold(df: DataFrame, key: str, filter_: DataFrame, bits: int = FILTER_BITS, flag: str = "_may") -> DataFrame:
    """Add ``flag``: false if the filter proves that the key is not among its keys.

    The filter is broadcast; its size is fixed by ``bits`` (1 MB by default).
    """
    page, at = _probes(F.col(key), bits)
    probed = df.withColumns({"_page": page, "_at": at}).join(F.broadcast(filter_), "_page", "left")
    is_set = F.expr(
        "forall(_at, p -> (cast(conv(hex(substring(_bits, shiftright(p, 3) + 1, 1)), 16, 10) as int) & shiftleft(1, p & 7)) <> 0)"
    )
    return probed.withColumn(flag, F.coalesce(is_set, F.lit(False))).drop("_page", "_at", "_bits")


def _counted(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, NULL included. Combines before the shuffle, so a frequent key is one row per task."""
    return df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("rows"))


def orphans(left: DataFrame, right: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Keys with rows on the left and none on the right, from :func:`_counted` frames.

    The filter of the right keys proves most of them without a join. A key that it lets through may
    still have no partner; an exact anti-join decides, on frames that already lie by key.
    """
    tested = may_hold(left.where("key is not null"), "key", key_filter(right, "key", bits), bits)
    proven = tested.where(~F.col("_may")).select("key", "rows")
    rest = tested.where("_may").select("key", "rows")
    return proven.unionByName(rest.join(right.select("key"), "key", "left_anti"))


_MEASURES = ("rows", "null_rows", "keys", "orphan_keys", "orphan_rows", "right_keys", "duplicate_keys", "duplicate_rows")


def check_keys(
    tables: Mapping[str, DataFrame],
    relationships: Sequence[Relationship] = RELATIONSHIPS,
    bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Check every relationship; returns a report and the orphan keys.

    Report, a row per relationship: ``rows`` of the left table, ``null_rows`` (without a key),
    ``keys`` (different ones), ``orphan_keys`` and ``orphan_rows`` (without a partner),
    ``right_keys``, ``duplicate_keys`` (right keys in several rows) and ``duplicate_rows`` (right
    rows beyond the first of a key: what a join would multiply). NULL keys are neither orphans nor
    duplicates, as they join nothing. Second frame: ``relationship``, ``key`` (as text), ``rows``.

    Each side is counted once per key; neither a frequent key nor a large table meets in one task.
    Orphans are stored, so that both frames show the same; the rest is lazy.
    """
    reports, lost = [], []
    for rel in relationships:
        left, right = _counted(tables[rel.left], rel.left_key), _counted(tables[rel.right], rel.right_key)
        right = right.where("key is not null")
        lost.append(orphans(left, right, bits).select(F.lit(rel.name).alias("relationship"), "key", "rows"))
        one = lambda condition, value=F.lit(1): F.when(condition, value)
        reports += [
            _measured(left, rel, rows=F.col("rows"), null_rows=one(F.col("key").isNull(), F.col("rows")), keys=one(F.col("key").isNotNull())),
            _measured(
                right, rel, right_keys=F.lit(1), duplicate_keys=one(F.col("rows") > 1), duplicate_rows=F.col("rows") - 1
            ),
        ]
    stored = scratch_copy(reduce(DataFrame.unionByName, lost), "orphans")
    reports.append(_measured(stored, None, orphan_keys=F.lit(1), orphan_rows=F.col("rows")))
    names = stored.sparkSession.createDataFrame([(r.name,) for r in relationships], "relationship string")
    reports.append(_measured(names, None))
    report = reduce(DataFrame.unionByName, reports).groupBy("relationship")
    return report.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in _MEASURES]), stored


def _measured(df: DataFrame, rel: Relationship | None, **measures: Column) -> DataFrame:
    none = F.lit(None)
    name = F.col("relationship") if rel is None else F.lit(rel.name).alias("relationship")
    return df.select(name, *[measures.get(m, none).cast("bigint").alias(m) for m in _MEASURES])


def raise_on_broken_keys(report: DataFrame) -> None:
    """Fail where a join would multiply rows, naming the relationships. Orphans are no failure: a
    left join keeps them.
    """
    broken = [r["relationship"] for r in report.where("duplicate_keys > 0").orderBy("relationship").collect()]
    if broken:
        raise RuntimeError("right keys are not unique: " + ", ".join(broken))
