"""Near-duplicate texts by min-max hashing of word shingles, confirmed on the full sets.

Each of 64 permutations is evaluated once per shingle and gives two signature values, the
smallest and the largest hash. Both agree between two texts with the probability of their Jaccard
similarity, so a signature of 128 values costs 64 evaluations. Bands of the signature bring
similar texts together. Within a band's group, signatures choose the pairs that are confirmed
first, a spanning forest of the most similar ones. Texts that then still have a likely partner in
another component meet again in their group with their full sets, where every such pair is tried
until its components are linked. Pairs inside one component need no confirmation, as they can't
change the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_marts.llm.components import connected_components
from catalog_marts.llm.groups import clustered, whole_groups
from catalog_marts.llm.held import release, tidied
from catalog_marts.llm.sketch import Tally, build_table, places
from catalog_marts.llm.text import hash_words, mix, pieces, utf8
from catalog_marts.sources import scratch_copy

PERMUTATIONS = 64
BAND_ROWS = 5  # 25 bands: a pair of similarity 0.8 is missed with probability 5e-5
MARGIN = 0.16  # pairs whose estimate is lower by more (about 4.5 deviations) are not confirmed
MARK_BITS = 24  # of the table that marks texts to look at again: 16 MB
CHUNK = 4096  # texts of one band's group that one task compares at a time
WHOLE = 2  # side of the texts of a group that all meet each other

_generator = np.random.default_rng(4)
_FLIP = _generator.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_FACTOR = _generator.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(column: pa.Array, words: int, lower: bool = True) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text as 64-bit hashes.

    A shingle is ``words`` consecutive words; a text with fewer words is one shingle, a text
    without words has none.
    """
    data, offsets = utf8(column)
    found = hash_words(data, offsets, lower=lower)
    hashes = found.hashes
    joined = hashes.copy()
    for k in range(1, words):
        end = max(0, len(hashes) - k)
        joined[:end] = joined[:end] * _STEP + hashes[k:]
    joined = mix(joined)
    for low, high in zip(found.bounds[:-1], found.bounds[1:], strict=True):
        if high - low >= words:
            yield np.unique(joined[low : high - words + 1])
        elif high > low:
            value = np.array([high - low], np.uint64)
            for at in range(low, high):
                value = mix(value * _STEP + hashes[at : at + 1])
            yield value
        else:
            yield np.empty(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest and largest hash under each permutation, alternating."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 2048):
        hashed = (shingles[at : at + 2048, None] ^ _FLIP) * _FACTOR
        np.minimum(low, hashed.min(0), out=low)
        np.maximum(high, hashed.max(0), out=high)
    return np.stack([low, high], 1).ravel()


def _signatures(words: int, lower: bool):
    bands = 2 * PERMUTATIONS // BAND_ROWS
    names = ["id", "n", "set1", "set2", "sketch", "bands"]

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part in pieces(batch, "text"):
                sizes, ones, twos, sketches, keys = [], [], [], [], []
                for shingles in shingle_sets(part.column("text"), words, lower):
                    values = signature(shingles)
                    sizes.append(len(shingles))
                    ones.append(mix(shingles).sum(dtype=np.uint64))  # the set itself, in 128 bits
                    twos.append(mix(shingles * _STEP + _STEP).sum(dtype=np.uint64))
                    sketches.append((mix(values) & np.uint64(255)).astype(np.uint8).tobytes())
                    grid = values[: bands * BAND_ROWS].reshape(bands, BAND_ROWS)
                    key = np.arange(bands, dtype=np.uint64)
                    for k in range(BAND_ROWS):
                        key = mix(key * _STEP + grid[:, k])
                    keys.append(key.view(np.int64) if len(shingles) else np.empty(0, np.int64))
                ends = np.cumsum([0, *map(len, keys)])
                yield pa.RecordBatch.from_arrays([
                    part.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(ones, np.uint64).view(np.int64)),
                    pa.array(np.array(twos, np.uint64).view(np.int64)),
                    pa.array(sketches, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*keys, np.empty(0, np.int64)]))),
                ], names)

    return run


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 2 * PERMUTATIONS)


def _agree(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (sketches == one).mean(1)


def _spanning_pairs(least: float):
    """Per group, the edges of a maximum spanning forest of the estimated similarities."""
    def run(batches):
        for table, bounds in whole_groups(batches, ["band", "chunk"]):
            ids, n, sketches = table["id"].to_numpy(), table["n"].to_numpy(), _sketches(table["sketch"])
            a, b = [], []
            two = np.flatnonzero(np.diff(bounds) == 2)
            at = bounds[two]
            near = (sketches[at] == sketches[at + 1]).mean(1) >= least
            a.append(ids[at[near]])
            b.append(ids[at[near] + 1])
            for g in np.flatnonzero(np.diff(bounds) > 2):
                rows = np.arange(bounds[g], bounds[g + 1])
                best, of = np.full(len(rows), -1.0), np.zeros(len(rows), np.int64)
                open_, now = np.ones(len(rows), bool), 0
                for _ in range(len(rows) - 1):  # Prim's algorithm, one row of similarities at a time
                    open_[now] = False
                    similar = _agree(sketches[rows], sketches[rows[now]])
                    better = open_ & (similar > best)
                    best[better], of[better] = similar[better], now
                    now = int(np.argmax(np.where(open_, best, -2)))
                    if best[now] >= least:
                        a.append(ids[rows[now : now + 1]])
                        b.append(ids[rows[of[now]]][None])
            yield _pairs(a, b)
    return run


def _candidates(least: float, share: float):
    """The texts of a group with a likely partner in another component, one of the two being
    outside of the group's largest component. A pair counts in the first band that it agrees in.
    Texts of sides 0 and 1 look at each other only; those of side 0 are outside.
    """
    width = 2 * PERMUTATIONS // BAND_ROWS * BAND_ROWS

    def run(batches):
        for table, bounds in whole_groups(batches, ["band", "chunk"]):
            ids, n, sketches = table["id"].to_numpy(), table["n"].to_numpy(), _sketches(table["sketch"])
            component, minor = table["component"].to_numpy(), table["minor"].to_numpy()
            number, side = table["number"].to_numpy(), table["side"].to_numpy()
            wanted = np.zeros(len(ids), bool)
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                for x in np.flatnonzero(minor[low:high] & (side[low:high] != 1)) + low:
                    rows = np.flatnonzero(_others(component, side, low, high, x)) + low
                    rows = rows[np.minimum(n[rows], n[x]) >= share * np.maximum(n[rows], n[x])]
                    same = sketches[rows] == sketches[x]
                    earlier = same[:, :width].reshape(len(rows), width // BAND_ROWS, BAND_ROWS)[:, : number[x]].all(2).any(1)
                    rows = rows[(same.mean(1) >= least) & ~earlier]
                    wanted[rows] = True
                    wanted[x] |= len(rows) > 0
            yield pa.RecordBatch.from_struct_array(
                table.select(["band", "chunk", "side", "id", "component", "minor"]).filter(pa.array(wanted)).to_struct_array().combine_chunks()
            )
    return run


def _others(component: np.ndarray, side: np.ndarray, low: int, high: int, x: int) -> np.ndarray:
    """Marks of the texts of a group that text ``x`` meets: not linked yet, and of the other side."""
    return (component[low:high] != component[x]) & ((side[low:high] != side[x]) | (side[x] == WHOLE))


def _links(percent: int):
    """Confirmed links between the components of a group: one is enough for two components."""
    def run(batches):
        for table, bounds in whole_groups(batches, ["band", "chunk"]):
            ids, minor = table["id"].to_numpy(), table["minor"].to_numpy()
            component, side = table["component"].to_numpy().copy(), table["side"].to_numpy()
            lists = table["shingles"].combine_chunks()
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            sizes, a, b = np.diff(ends), [], []
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                for x in np.flatnonzero(minor[low:high] & (side[low:high] != 1)) + low:
                    own = values[ends[x] : ends[x + 1]]
                    while True:
                        rows = np.flatnonzero(_others(component, side, low, high, x)) + low
                        rows = rows[100 * np.minimum(sizes[rows], sizes[x]) >= percent * np.maximum(sizes[rows], sizes[x])]
                        found = -1
                        for at in range(0, len(rows), 64):
                            some = rows[at : at + 64]
                            inside = [np.isin(values[ends[r] : ends[r + 1]], own, assume_unique=True).sum() for r in some]
                            inside = np.array(inside)
                            similar = 100 * inside >= percent * (sizes[some] + sizes[x] - inside)
                            if similar.any():
                                found = some[np.argmax(similar)]
                                break
                        if found < 0:
                            break
                        a.append(ids[x : x + 1])
                        b.append(ids[found : found + 1])
                        group = component[low:high]
                        group[group == component[found]] = component[x]
            yield _pairs(a, b)
    return run


def _blocks(large: DataFrame, percent: int) -> DataFrame:
    """The texts of large band groups in blocks of two chunks, ``side`` 0 and 1, or of one chunk.

    Texts lie in classes of set sizes; similar ones are of the same class or of neighbouring ones.
    Each pair of chunks of two such classes makes one block if texts outside of the group's
    largest component (``minor``) are in the first, so every pair of texts meets once.
    """
    step = float(np.log(100 / min(max(percent, 1), 95)) * (1 + 1e-6))  # rounding never skips a class
    large = large.withColumn("class", F.floor(F.log("n") / step))
    slabs = large.groupBy("band", "class", "minor").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts"))
    slabs = scratch_copy(slabs, "slabs")
    others = slabs.toDF("band", "_class", "_minor", "_parts")
    met = slabs.where("minor").join(others, "band").where("abs(class - _class) <= 1 and (not _minor or class <= _class)")
    met = met.withColumn("same", F.col("_minor") & (F.col("class") == F.col("_class")))
    met = scratch_copy(met.withColumn("name", F.xxhash64("class", "_class", "_minor")), "slabs")
    first = met.select("band", "class", "minor", "parts", "_parts", "name", "same", F.lit(0).alias("side"))
    second = met.where("not same").select(
        "band", F.col("_class").alias("class"), F.col("_minor").alias("minor"), F.col("_parts").alias("parts"),
        F.col("parts").alias("_parts"), "name", "same", F.lit(1).alias("side"),
    )
    texts = large.join(first.unionByName(second), ["band", "class", "minor"])
    texts = texts.withColumn("_own", F.pmod(F.xxhash64("id"), F.col("parts")))
    texts = texts.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    turned = F.when(F.col("same"), F.col("_own") > F.col("_other")).otherwise(F.col("side") == 1)
    block = F.xxhash64("name", F.when(turned, F.col("_other")).otherwise(F.col("_own")), F.when(turned, F.col("_own")).otherwise(F.col("_other")))
    side = F.when(F.col("same") & (F.col("_own") == F.col("_other")), WHOLE).otherwise(turned.cast("int"))
    return texts.withColumns({"chunk": block, "side": side})


def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    a, b = (np.concatenate([*x, np.empty(0, np.int64)]) for x in (a, b))
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
    percent: int = 80, lower: bool = True,
) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Texts are linked if their sets of shingles of ``words`` words have a Jaccard similarity of
    ``percent`` / 100 or more, which is confirmed on the full sets; ``component_id`` is the
    smallest key reachable and ``kept`` marks the rows whose key it is. Keys are integers.

    Texts with equal sets are one text up to here, however many they are. Null and empty texts
    and texts without words have no shingles and are linked with nothing. Rows that repeat a key
    share its component. A null key is linked with nothing: its component is null and the row is
    kept. An empty table gives an empty table. Other columns are ignored.

    Stored tables: signatures, pairs and the sets of the texts in pairs.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    signed = scratch_copy(rows.mapInArrow(
        _signatures(words, lower), "id long, n long, set1 long, set2 long, sketch binary, bands array<long>"
    ), "signatures")
    same_set = ["n", "set1", "set2"]
    texts = signed.where("id is not null and n > 0").groupBy(*same_set).agg(
        F.min("id").alias("first"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")
    )
    texts = scratch_copy(texts, "texts")
    members = texts.select(F.col("first").alias("id"), "n", "sketch", F.posexplode("bands").alias("number", "band"))
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("_size"), F.min("id").alias("_least"))
    sizes = scratch_copy(sizes.where("_size > 1"), "bands")
    members = scratch_copy(members.join(sizes, "band"), "members")

    # a group in chunks, each with the group's smallest key
    chunks = F.ceil(F.col("_size") / CHUNK)
    chunked = members.withColumn("chunk", F.explode(F.when(
        F.col("id") == F.col("_least"), F.sequence(F.lit(0).cast("long"), chunks - 1)
    ).otherwise(F.array(F.pmod(F.xxhash64("id"), chunks)))))
    least = percent / 100 - MARGIN
    pairs = clustered(chunked.select("band", "chunk", "id", "n", "sketch"), ["band", "chunk"])
    pairs = scratch_copy(pairs.mapInArrow(_spanning_pairs(least), "a long, b long").distinct(), "pairs")
    links = _confirmed(rows, pairs, words, percent, lower)
    # a key that is repeated with other texts is one id
    held = signed.where("id is not null and n > 0").join(texts.select(*same_set, "first"), same_set)
    held = held.select("id", "first").distinct()
    several = held.groupBy("id").agg(F.min("first").alias("a"), F.count(F.lit(1)).alias("_sets"))
    several = held.join(several.where("_sets > 1"), "id").select("a", F.col("first").alias("b"))
    links = links.unionByName(several)
    links = scratch_copy(links, "links")
    component = connected_components(links)

    # sketches join again where a band's group is of several components, which few are
    members = members.drop("_least", "sketch").join(component, "id", "left")
    members = scratch_copy(members.withColumn("component", F.coalesce("component", "id")), "members")
    shares = members.groupBy("band", "component").agg(F.count(F.lit(1)).alias("_c"))
    mixed = shares.groupBy("band").agg(
        F.max_by("component", F.struct("_c", "component")).alias("_main"), F.count(F.lit(1)).alias("_comps")
    )
    mixed = scratch_copy(mixed.where("_comps > 1").drop("_comps"), "mixed")
    rest = members.join(mixed, "band").withColumn("minor", F.col("component") != F.col("_main"))
    rest = rest.join(texts.select(F.col("first").alias("id"), "sketch"), "id")
    group = ["band", "chunk"]
    columns = [*group, "side", "number", "id", "n", "sketch", "component", "minor"]
    large = scratch_copy(rest.where(F.col("_size") > CHUNK), "large-bands")
    rest = rest.where(F.col("_size") <= CHUNK).withColumns({"chunk": F.lit(0).cast("long"), "side": F.lit(WHOLE)}).select(*columns)
    if not large.isEmpty():
        rest = rest.unionByName(_blocks(large, percent).select(*columns))
    rest = scratch_copy(clustered(rest, group).mapInArrow(
        _candidates(least, percent / 100), "band long, chunk long, side int, id long, component long, minor boolean"
    ), "candidates")
    rest = rest.join(_sets(rows, rest.select("id"), words, lower), "id")
    links = links.unionByName(clustered(rest, group).mapInArrow(_links(percent), "a long, b long"))
    component = connected_components(links)

    named = signed.join(texts.select(*same_set, "first"), same_set, "left")
    named = named.withColumn("_id", F.coalesce("first", "id"))
    component = component.select(F.col("id").alias("_id"), "component")
    named = named.join(component, "_id", "left")
    reached = F.when(F.col("id").isNotNull(), F.coalesce("component", "_id"))
    return named.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), reached.alias("component_id"),
        F.coalesce(F.col("id") == reached, F.lit(True)).alias("kept"),
    )


def _marked(ids: np.ndarray) -> np.ndarray:
    return places(mix(mix(ids.astype(np.uint64))), MARK_BITS)


def _sets(rows: DataFrame, ids: DataFrame, words: int, lower: bool) -> DataFrame:
    """The full sets of the texts with these ids, and of a few others; only the sets move."""

    def tally(batches):
        marks = Tally(MARK_BITS)
        for batch in batches:
            marks.add(_marked(batch.column("id").to_numpy()))
        yield from marks.batches()

    table = build_table(ids.mapInArrow(tally, Tally.FIELDS), MARK_BITS)
    marks = rows.sparkSession.sparkContext.broadcast(table)

    @tidied
    def sets(batches):
        for batch in batches:
            batch = batch.filter(pa.array(marks.value[_marked(batch.column("id").to_numpy())] > 0))
            for part in pieces(batch, "text"):
                found = [x.view(np.int64) for x in shingle_sets(part.column("text"), words, lower)]
                ends = np.cumsum([0, *map(len, found)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*found, np.empty(0, np.int64)])))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "shingles"])

    rows = rows.where("id is not null")
    return scratch_copy(rows.mapInArrow(sets, "id long, shingles array<long>"), "sets")


def _confirmed(rows: DataFrame, pairs: DataFrame, words: int, percent: int, lower: bool) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    sets = _sets(rows, ids, words, lower)
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_s"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_t"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("_s", "_t"))
    union = F.size("_s") + F.size("_t") - common
    return both.where(100 * common >= percent * union).select("a", "b")
