"""An index for case-insensitive substring search: character trigrams and where they occur.

Rows lie in chunks of some thousand. For every trigram of a chunk's lower-cased texts the index has
one posting list, the rows' numbers in the chunk as gaps. A text that contains a term contains all
trigrams of the term, so the lists of a term are intersected chunk by chunk, the shortest first, and
only what is left is compared with the term itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_marts.sources import read_table, scratch_copy, write_table

GRAM = 3  # characters; shorter terms are looked for in all texts
_POSTINGS = "gram bigint, chunk bigint, n int, gaps binary"


def grams(text: str) -> list[int]:
    """The different trigrams of a text, each as a number: three code points of 21 bits."""
    points = [ord(c) for c in text]
    return sorted({a << 42 | b << 21 | c for a, b, c in zip(points, points[1:], points[2:], strict=False)})


def _packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers as gaps, in as few bytes as the widest gap needs."""
    gaps = np.diff(numbers, prepend=0)
    size = next(k for k in (1, 2, 4) if int(gaps.max()) < 1 << 8 * k)
    return bytes([size]) + gaps.astype(f"<u{size}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64))


def _posting_lists(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """Trigrams of some texts, and the numbers of the texts that hold them."""
    texts = [t or "" for t in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    of = np.repeat(np.arange(len(texts)), lengths)
    if len(points) < GRAM:
        return
    code = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
    inside = of[:-2] == of[2:]
    code, of = code[inside], of[:-2][inside]
    order = np.lexsort((of, code))
    code, of = code[order], of[order]
    new = np.append(True, (code[1:] != code[:-1]) | (of[1:] != of[:-1]))[: len(code)]
    code, of = code[new], of[new]
    bounds = np.flatnonzero(np.append(True, code[1:] != code[:-1]))[: len(code)]
    for low, high in zip(bounds, [*bounds[1:], len(code)], strict=True):
        yield int(code[low]), of[low:high]


def build_substring_index(df: DataFrame, path: str, key: str, text: str) -> None:
    """Index the texts of ``df`` below ``path``: ``rows`` by chunk, and ``postings`` sorted by trigram.

    Keys and texts may be NULL or repeated; rows are separate. A NULL text contains nothing. Texts
    are read once; a chunk is what a task gets at a time, so no list grows with the table.
    """
    kind = df.schema[key].dataType.simpleString()
    chosen = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.lower(F.col(text).cast("string")).alias("lowered"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            rows = {
                "key": batch.column("key"), "text": batch.column("text"), "lowered": batch.column("lowered"),
                "chunk": pa.array([chunk] * n, pa.int64()), "number": pa.array(np.arange(n, dtype=np.int32)),
            }
            yield whole(rows, n)
            lists = [(code, len(found), _packed(found)) for code, found in _posting_lists(batch.column("lowered").to_pylist())]
            if lists:
                codes, sizes, gaps = zip(*lists, strict=True)
                m = len(lists)
                yield whole({
                    "gram": pa.array(codes, pa.int64()), "chunk": pa.array([chunk] * m, pa.int64()),
                    "n": pa.array(sizes, pa.int32()), "gaps": pa.array(gaps, pa.binary()),
                }, m)
            chunk += 1

    types = {"key": None, "text": pa.string(), "lowered": pa.string(), "chunk": pa.int64(), "number": pa.int32(), "gram": pa.int64(), "n": pa.int32(), "gaps": pa.binary()}
    schema = f"key {kind}, text string, lowered string, chunk long, number int, gram long, n int, gaps binary"
    arrow = _arrow_type(df.sparkSession, kind)

    def whole(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t or arrow)) for c, t in types.items()], list(types))

    stored = scratch_copy(chosen.mapInArrow(run, schema), "substrings")
    write_table(stored.where("number is not null").select("key", "text", "lowered", "chunk", "number"), f"{path}/rows", sort_by=["chunk", "number"])
    write_table(stored.where("gram is not null").select("gram", "chunk", "n", "gaps"), f"{path}/postings", sort_by=["gram", "chunk"])


def _arrow_type(spark: SparkSession, kind: str) -> pa.DataType:
    return spark.createDataFrame([], f"x {kind}").toArrow().schema.field("x").type


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows")


def candidates(spark: SparkSession, path: str, terms: Sequence[str]) -> DataFrame:
    """``term``, ``chunk`` and ``number`` of the rows that hold all trigrams of a term.

    Only the postings of these trigrams are read; they are sorted by trigram, so other files and
    row groups are skipped. A chunk without one of a term's trigrams is done with at once.
    """
    wanted = {t: grams(t.lower()) for t in terms}
    codes = sorted({c for found in wanted.values() for c in found})
    lists = read_table(spark, f"{path}/postings", _POSTINGS).where(F.col("gram").isin(codes))

    def meet(table: pa.Table) -> pa.Table:
        of = dict(zip(table["gram"].to_pylist(), zip(table["n"].to_pylist(), table["gaps"].to_pylist(), strict=True), strict=True))
        found: list[tuple[str, np.ndarray]] = []
        for term, own in wanted.items():
            if not own or any(c not in of for c in own):
                continue
            rarest = sorted((of[c] for c in own), key=lambda x: x[0])
            left = _unpacked(rarest[0][1])
            for _, gaps in rarest[1:]:
                if not len(left):
                    break
                left = np.intersect1d(left, _unpacked(gaps), assume_unique=True)
            found.append((term, left))
        chunk = table["chunk"][0].as_py()
        numbers = np.concatenate([x for _, x in found]) if found else np.empty(0, np.int64)
        names = [t for t, x in found for _ in range(len(x))]
        return pa.table({
            "term": pa.array(names, pa.string()), "chunk": pa.array([chunk] * len(names), pa.int64()),
            "number": pa.array(numbers.astype(np.int32)),
        })

    return lists.groupBy("chunk").applyInArrow(meet, "term string, chunk long, number int")


def search_substrings(spark: SparkSession, path: str, terms: Sequence[str]) -> DataFrame:
    """``term``, ``key`` and ``text`` of the rows whose text contains a term, letter case ignored.

    Exact: what the trigrams leave is compared with the term. Terms below three characters have no
    trigram and are looked for in all texts; an empty term is contained in every text that is not
    NULL. A term that is given twice is searched once.
    """
    terms = list(dict.fromkeys(terms))
    long = [t for t in terms if len(t.lower()) >= GRAM]
    short = [t for t in terms if len(t.lower()) < GRAM]
    rows, found = _rows(spark, path), []
    if long:
        near = candidates(spark, path, long).join(rows, ["chunk", "number"])
        lowered = F.create_map(*[x for t in long for x in (F.lit(t), F.lit(t.lower()))])
        found.append(near.where(F.contains("lowered", lowered[F.col("term")])).select("term", "key", "text"))
    for term in short:
        found.append(rows.where(F.col("lowered").contains(term.lower())).select(F.lit(term).alias("term"), "key", "text"))
    if not found:
        return rows.limit(0).select(F.lit("").alias("term"), "key", "text")
    return reduce(DataFrame.unionByName, found)
