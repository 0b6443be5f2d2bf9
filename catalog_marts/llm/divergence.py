"""How far the word use of sources differs, over the terms that enough documents hold.

Terms are found by iceberg prefix refinement: a prefix is counted by the documents that hold a term
beginning with it, and only prefixes that enough documents hold are extended at the next level,
until nothing is left to extend. Most rare terms share no frequent prefix, so they are never
counted one by one. Between levels the surviving prefixes travel as marks in a table of fixed size;
where two of them share a mark, a prefix too many is counted, and dropped by its exact count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_marts.llm.groups import clustered, whole_groups
from catalog_marts.llm.segments import gathered
from catalog_marts.llm.sketch import Tally, build_table, places
from catalog_marts.llm.text import mix, pieces, utf8
from catalog_marts.sources import scratch_copy

#: The same terms as a pattern, A-Z lower-cased, for SQL and for tests.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

MIN_DOCS = 30  # documents of a language that hold a kept term
TOP_TERMS = 50
SCALE, SMOOTHING = 1_000_000_000, 5
FIRST_LEVEL = 3  # bytes; every later level is twice as long
MARK_BITS = 24  # at most 16 MB of marks, however many prefixes survive
BLOCK = 4 << 20  # bytes of text counted at a time
SOURCE_BLOCK = 64  # sources compared with each other at a time
BUCKET_ROWS = 20_000  # counts that a task compares at a time, about

_IN_TERM = np.ones(256, bool)
_IN_TERM[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Terms(NamedTuple):
    """Lower-cased bytes, eight more than the texts have; begin, length and text of every term."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    text: np.ndarray

    def words(self, at: np.ndarray | slice, begin: int, length: np.ndarray) -> np.ndarray:
        """Bytes ``begin`` to ``begin + 8`` of some terms as numbers, 0 beyond ``length``."""
        eight = np.lib.stride_tricks.as_strided(self.data[:8].view("<u8"), (len(self.data) - 7,), (1,))
        return eight[self.starts[at] + begin] & _MASKS[np.clip(length - begin, 0, 8)]

    def hashes(self, length: np.ndarray) -> np.ndarray:
        """Hashes of the prefixes of these lengths."""
        value = mix(self.words(slice(None), 0, length) + length.astype(np.uint64) * _STEP)
        rest, begin = np.flatnonzero(length > 8), 8
        while len(rest):
            value[rest] = mix(value[rest] * _STEP + self.words(rest, begin, length[rest]))
            begin += 8
            rest = rest[length[rest] > begin]
        return value

    def numbered(self, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal numbers for equal prefixes of these lengths, and a term with each of the numbers.

        Bytes are compared, not hashes. No byte of a term is 0, so a number tells the length, too.
        """
        _, number = np.unique(self.words(slice(None), 0, length), return_inverse=True)
        rest, begin, size = np.flatnonzero(length > 8), 8, int(number.max()) + 1
        while len(rest):
            _, word = np.unique(self.words(rest, begin, length[rest]), return_inverse=True)
            longer, own = np.unique(number[rest] * (int(word.max()) + 1) + word, return_inverse=True)
            number[rest] = size + own
            size += len(longer)
            begin += 8
            rest = rest[length[rest] > begin]
        one = np.zeros(size, np.int64)
        one[number] = np.arange(len(number))
        return number, one


def find_terms(data: np.ndarray, offsets: np.ndarray) -> Terms:
    """Terms of the texts that :func:`catalog_marts.llm.text.utf8` returns."""
    low = np.zeros(len(data) + 8, np.uint8)
    low[: len(data)] = data
    low += ((low - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5)
    inside = _IN_TERM[low[: len(data) + 1]]  # the byte after the last is outside
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:]
    ends[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(begins)
    return Terms(low, starts, np.flatnonzero(ends) + 1 - starts, np.searchsorted(offsets, starts, "right") - 1)


def _binary(terms: Terms, at: np.ndarray, length: np.ndarray) -> pa.Array:
    ends = np.append(0, np.cumsum(length[at])).astype(np.int32)
    data = terms.data[gathered(terms.starts[at], length[at])]
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _label_hashes(labels: pa.Array) -> np.ndarray:
    data, offsets = utf8(labels)
    padded = np.append(data, np.zeros(8, np.uint8))
    every = Terms(padded, offsets[:-1], np.diff(offsets), np.arange(len(labels)))
    return every.hashes(every.lengths)


def _marked(labels: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    return mix(prefixes + labels * _STEP)


class Level(NamedTuple):
    """What a pass over the texts counts: prefixes of ``depth`` bytes and terms shorter than that,
    among the terms whose first ``before`` bytes are marked. Depth 0: whole terms that are marked.
    """

    before: int
    depth: int


def _counts(terms: Terms, level: Level, label: np.ndarray, group: np.ndarray, marks, bits: int):
    """Group, prefix, documents and occurrences of each prefix of a group of texts."""
    cut = terms.lengths if not level.depth else np.minimum(terms.lengths, level.depth)
    if marks is not None:
        tested = terms.lengths if not level.depth else np.minimum(terms.lengths, level.before)
        at = np.flatnonzero(terms.lengths >= level.before)
        terms, cut = Terms(terms.data, *(x[at] for x in terms[1:])), cut[at]
        there = marks[places(_marked(label[terms.text], terms.hashes(tested[at])), bits)] > 0
        terms, cut = Terms(terms.data, *(x[there] for x in terms[1:])), cut[there]
    if not len(cut):
        return None
    number, first = terms.numbered(cut)
    size = len(first)
    held, n = np.unique(terms.text * size + number, return_counts=True)
    key, of = np.unique(group[held // size] * size + held % size, return_inverse=True)
    prefix = first[key % size]
    docs, total = np.bincount(of), np.bincount(of, n).astype(np.int64)
    return key // size, _binary(terms, prefix, cut), docs, total


def _long_counts(data: np.ndarray, level: Level, label, group, marks, bits: int):
    """As :func:`_counts`, for a single text that is counted in parts."""
    total, low = Counter(), 0
    while low < len(data):
        high = min(low + BLOCK, len(data))
        while high < len(data) and _IN_TERM[data[high]]:  # a term is not cut
            outside = np.flatnonzero(~_IN_TERM[data[high : high + BLOCK]])
            high = min(high + (int(outside[0]) if len(outside) else BLOCK), len(data))
        found = _counts(find_terms(data[low:high], np.array([0, high - low])), level, label, group, marks, bits)
        if found:
            total.update(dict(zip(found[1].to_pylist(), found[3].tolist(), strict=True)))
        low = high
    if not total:
        return None
    ones = np.ones(len(total), np.int64)
    return group[0] * ones, pa.array(list(total), pa.binary()), ones, np.array(list(total.values()))


def _pass(docs: DataFrame, level: Level, marks: np.ndarray | None, bits: int) -> DataFrame:
    """Counts of a level, not yet summed over tasks: by language, at depth 0 by source as well."""
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", BLOCK):
                lang = part.column("lang").dictionary_encode()
                source = part.column("source").dictionary_encode()
                label = _label_hashes(lang.dictionary)[lang.indices.to_numpy()]
                sources = 1 if level.depth else len(source.dictionary)
                group = lang.indices.to_numpy().astype(np.int64)
                if not level.depth:
                    group = group * sources + source.indices.to_numpy()
                data, offsets = utf8(part.column("text"))
                if part.num_rows == 1 and len(data) > BLOCK:
                    found = _long_counts(data, level, label, group, shared.value, bits)
                else:
                    found = _counts(find_terms(data, offsets), level, label, group, shared.value, bits)
                if found is None:
                    continue
                group, prefix, held, n = found
                columns = [lang.dictionary.take(pa.array(group // sources)), prefix]
                if not level.depth:
                    columns.insert(1, source.dictionary.take(pa.array(group % sources)))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(held), pa.array(n)], names)

    by = "lang string, prefix binary" if level.depth else "lang string, source string, prefix binary"
    names = [x.split(" ")[0] for x in by.split(", ")] + ["docs", "n"]
    return docs.mapInArrow(run, f"{by}, docs long, n long")


def _marks(prefixes: DataFrame, size: int, limit: int) -> tuple[np.ndarray, int]:
    """A table in which the places of all prefixes are marked, and the bits of a place."""
    bits = min(max((16 * size).bit_length(), 16), limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(bits)
        for batch in batches:
            ends = np.append(0, np.cumsum(pc.binary_length(batch.column("prefix")).to_numpy())).astype(np.int64)
            data = np.frombuffer(b"".join(batch.column("prefix").to_pylist()) + bytes(8), np.uint8)
            every = Terms(data, ends[:-1], np.diff(ends), ends)
            tally.add(places(_marked(_label_hashes(batch.column("lang")), every.hashes(every.lengths)), bits))
        yield from tally.batches()

    return build_table(prefixes.select("lang", "prefix").mapInArrow(run, Tally.FIELDS), bits), bits


def _prepared(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    value = lambda name, alias: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(alias)
    return docs.select(value(text, "text"), value(lang, "lang"), value(source, "source"))


def frequent_terms(
    docs: DataFrame, min_docs: int = MIN_DOCS, text: str = "text", lang: str = "lang",
    first_level: int = FIRST_LEVEL, mark_bits: int = MARK_BITS,
) -> DataFrame:
    """``lang``, ``term`` (binary) and ``docs``: the terms that at least ``min_docs`` rows of a
    language hold.

    A null text or language counts as an empty one, and rows count one by one, equal ones too. One
    pass over the texts per level of 3, 6, 12, ... bytes, until no prefix of a level is frequent;
    counts are combined in the reading tasks. A text of any length is counted whole, parts of it
    at a time. Runs its jobs when called.
    """
    rows = _prepared(docs, text, lang, lang)
    level, marks, bits, kept = Level(0, first_level), None, 0, None
    while True:
        found = _pass(rows, level, marks, bits).groupBy("lang", "prefix").agg(F.sum("docs").alias("docs"))
        found = scratch_copy(found.where(F.col("docs") >= min_docs), "prefixes")
        whole = F.octet_length("prefix") < level.depth
        terms = found.where(whole).select("lang", F.col("prefix").alias("term"), "docs")
        kept = terms if kept is None else kept.unionByName(terms)
        alive = found.where(~whole)
        size = alive.count()
        if not size:
            return kept
        marks, bits = _marks(alive, size, mark_bits)
        level = Level(level.depth, 2 * level.depth)


def _share(n: Column, total: Column, terms: Column) -> Column:
    """Smoothed share in exact integers; null where a language keeps no term."""
    exact = lambda x: x.cast("decimal(38,0)")
    parts = F.nullif(exact(total) + SMOOTHING * terms, F.lit(0))
    above = exact(n + SMOOTHING) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", above, parts) + 1


def _pairs(counts: DataFrame, groups: DataFrame, block: int, bucket_rows: int) -> DataFrame:
    """Summed differences of all sources of a language from each other.

    Sources are compared block by block and terms bucket by bucket: a task holds the counts of two
    blocks of sources in one bucket as a matrix and emits one sum per pair of sources, so what it
    emits does not depend on how many sources share a term. A difference over terms that neither
    source has is the same for each of them; ``base`` stands for it and the matrix for the rest.
    """
    by_lang = Window.partitionBy("lang")
    ranked = groups.withColumn("at", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long"))
    ranked = ranked.withColumn("blocks", F.floor((F.count(F.lit(1)).over(by_lang) - 1) / block) + 1)
    sizes = counts.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    buckets = F.greatest(F.lit(1), F.ceil(F.coalesce("rows", F.lit(0)) / bucket_rows)).cast("long")
    ranked = scratch_copy(ranked.join(sizes, "lang", "left").withColumn("buckets", buckets).drop("rows"), "sources")

    own = F.floor(F.col("at") / block)
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    bases = ranked.select("lang", "at", "base", own.alias("own"), meets.alias("other"), "buckets")
    bases = bases.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"))
    bases = bases.select("lang", "own", "other", "bucket", "at", F.lit(b"").alias("term"), F.coalesce("base", F.lit(0)).alias("p"))
    placed = counts.join(ranked.select("lang", "source", "at", "blocks", "buckets"), ["lang", "source"])
    placed = placed.select("lang", own.alias("own"), meets.alias("other"), F.pmod(F.xxhash64("term"), "buckets").alias("bucket"), "at", "term", "p")
    rows = bases.unionByName(placed).select(
        "lang", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "bucket", "own", "term", "at", "p"
    )
    keys = ["lang", "left", "right", "bucket"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, keys):
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                yield _compared(table.slice(low, high - low))

    found = clustered(rows, keys, ["term", "at"]).mapInArrow(run, "lang string, a long, b long, f long")
    found = found.groupBy("lang", "a", "b").agg(F.sum("f").alias("f"))
    left = ranked.select("lang", "source", F.col("at").alias("a"), F.col("base").alias("base_a"), "terms")
    right = ranked.select("lang", F.col("source").alias("item"), F.col("at").alias("b"), F.col("base").alias("base_b"))
    apart = F.coalesce(F.col("terms") * F.abs(F.col("base_a") - F.col("base_b")), F.lit(0))
    return (
        found.join(left, ["lang", "a"]).join(right, ["lang", "b"])
        .select("lang", "source", "item", (F.col("f") + apart).cast("long").alias("value"))
    )


def _compared(table: pa.Table, rows: int = 1024) -> pa.RecordBatch:
    """One group of :func:`_pairs`: what its terms add to the difference of each pair of sources."""
    at, p, term = table["at"].to_numpy(), table["p"].to_numpy(), table["term"].combine_chunks()
    bases = int(np.count_nonzero(pc.equal(pc.binary_length(term), 0).to_numpy(zero_copy_only=False)))
    sources, base = at[:bases], p[:bases]  # sorted by source
    column, p = np.searchsorted(sources, at[bases:]), p[bases:]
    term = term.slice(bases)
    if len(term):
        new = pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)
        row = np.append(0, np.cumsum(new))
    else:
        row = np.empty(0, np.int64)
    total = np.zeros((bases, bases), np.int64)
    apart = np.abs(base[:, None] - base[None, :])
    for low in range(0, int(row[-1]) + 1 if len(row) else 0, rows):
        first, last = np.searchsorted(row, [low, low + rows])
        matrix = np.repeat(base[None, :], int(row[last - 1]) - low + 1, axis=0)
        matrix[row[first:last] - low, column[first:last]] = p[first:last]
        for k in range(bases):
            total[k] += np.abs(matrix - matrix[:, k : k + 1]).sum(axis=0) - len(matrix) * apart[k]
    own = table["own"].to_numpy()[:bases]
    chosen = own[:, None] != own[None, :]  # pairs within a block belong to the group of that block
    if table["left"][0].as_py() == table["right"][0].as_py():
        chosen = ~np.eye(bases, dtype=bool)
    a, b = np.nonzero(chosen)
    lang = pa.array([table["lang"][0].as_py()] * len(a), pa.string())
    return pa.RecordBatch.from_arrays([lang, pa.array(sources[a]), pa.array(sources[b]), pa.array(total[a, b])], ["lang", "a", "b", "f"])


def source_divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS,
    text: str = "text", lang: str = "lang", source: str = "source",
    first_level: int = FIRST_LEVEL, mark_bits: int = MARK_BITS,
    source_block: int = SOURCE_BLOCK, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """How far the sources of a language are from each other, and the terms that mark a source.

    Terms are runs of letters and characters beyond ASCII, A-Z lower-cased; a language keeps those
    that at least ``min_docs`` of its rows hold, V of them. A source, and a language as a whole,
    gives a kept term that occurs ``n`` times among its N occurrences of kept terms the share
    ``1 + floor(10**9 * (n + 5) / (N + 5 * V))``. Returns ``lang``, ``source``, ``part``, ``item``,
    ``value`` and ``rank`` (by value descending, then item, from 1):

    part ``pair``
        ``item`` is another source of the language, ``value`` the sum of the absolute differences
        of the two sources' shares over all kept terms; every pair, in both directions.
    part ``term``
        ``item`` is a kept term that occurs in the source and has a larger share there than in the
        language, ``value`` the difference; the ``top_terms`` largest.

    Null texts, languages and sources count as empty ones. A source without terms takes part; in a
    language without kept terms all values are 0. Rows count one by one, equal ones too; other
    columns are ignored whatever their names; an empty table gives an empty table. Texts of any
    length are counted whole.

    The result has a row per pair of sources, so their number per language has to be one whose
    square can be stored. No task holds more than the counts of two blocks of sources in a bucket
    of terms. Runs its jobs when called.
    """
    rows = _prepared(docs, text, lang, source)
    kept = scratch_copy(frequent_terms(rows, min_docs, "text", "lang", first_level, mark_bits), "terms")
    marks, bits = _marks(kept.select("lang", F.col("term").alias("prefix")), kept.count(), mark_bits)
    found = _pass(rows, Level(0, 0), marks, bits).groupBy("lang", "source", "prefix").agg(F.sum("n").alias("n"))
    counts = found.withColumnRenamed("prefix", "term").join(kept.select("lang", "term"), ["lang", "term"], "left_semi")
    counts = scratch_copy(counts, "counts")

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.fillna(0, ["total", "terms"])
    groups = scratch_copy(groups.withColumn("base", _share(F.lit(0), F.col("total"), F.col("terms"))), "groups")
    shares = counts.join(groups.select("lang", "source", "total", "terms"), ["lang", "source"])
    shares = shares.withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))

    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(whole, "lang")
    whole = whole.select("lang", "term", _share(F.col("n"), F.col("total"), F.col("terms")).alias("q"))
    marking = shares.join(whole, ["lang", "term"]).where(F.col("p") > F.col("q")).select(
        "lang", "source", F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    terms = marking.withColumn("rank", rank).where(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    pairs = _pairs(shares, groups, source_block, bucket_rows).withColumn("rank", rank).withColumn("part", F.lit("pair"))
    return pairs.select(columns).unionByName(terms.select(columns))
