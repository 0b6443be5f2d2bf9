"""Linking tool calls with their results for chat formatting.

Calls and results of a conversation meet by identifier in a hash join. Calls refer to earlier ones
by identifier; their topological level is the length of the longest chain of references below
them. Arguments are validated against the tool's schema, and what belongs together is written as
canonical JSON: sorted keys, no blanks, one form for every number.
"""

from __future__ import annotations

import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_marts.llm.groups import clustered, whole_groups
from catalog_marts.sources import scratch_copy

CHUNK = 10_000  # calls of a conversation that one task levels at a time


def canonical(value) -> str:
    """JSON text with sorted keys and without blanks; whole numbers have no fraction and no exponent,
    half a surrogate pair is escaped, as it is no character.
    """
    return _storable(json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _storable(text: str) -> str:
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m.group()):04x}", text)


def _plain(value):
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value


def _refuse(text: str):
    raise ValueError(f"{text} is no JSON number")


def parse(text: str | None):
    """The value of a JSON text; raises ValueError for anything else, NaN and repeated keys included."""
    def pairs(items):
        if len(dict(items)) < len(items):
            raise ValueError("repeated key")
        return dict(items)

    if text is None:
        raise ValueError("no JSON")
    value = json.loads(text, parse_constant=_refuse, object_pairs_hook=pairs)
    canonical(value)  # numbers out of range
    return value


_KINDS = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
}


_NOTES = {"title", "description", "default", "examples", "$schema", "$id", "$comment", "deprecated", "readOnly", "writeOnly"}
_CHECKED = {
    "type", "enum", "minimum", "maximum", "minLength", "maxLength", "minItems", "maxItems", "items", "required", "properties",
    "additionalProperties",
}


def supported(schema: dict, at: str = "$") -> None:
    """Raises ValueError for a schema with anything that :func:`violations` does not check."""
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: a schema must be an object here")
    unknown = sorted(set(schema) - _CHECKED - _NOTES)
    kinds = schema.get("type", [])
    unknown += [f"type {k}" for k in ([kinds] if isinstance(kinds, str) else kinds) if k not in _KINDS]
    if not isinstance(schema.get("additionalProperties", True), bool):
        unknown.append("additionalProperties as a schema")
    if unknown:
        raise ValueError(f"{at}: {', '.join(unknown)} not supported")
    if "items" in schema:
        supported(schema["items"], f"{at}[]")
    for name, inner in schema.get("properties", {}).items():
        supported(inner, f"{at}.{name}")


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Where ``value`` breaks the schema: type, enum, bounds, lengths, required and further keys."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_KINDS[k](value) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):  # true is not 1
        found.append(f"{at}: not in enum")
    if _KINDS["number"](value):
        if value < schema.get("minimum", -math.inf):
            found.append(f"{at}: below minimum")
        if value > schema.get("maximum", math.inf):
            found.append(f"{at}: above maximum")
    if isinstance(value, (str, list)):
        name = "Length" if isinstance(value, str) else "Items"
        if len(value) < schema.get(f"min{name}", 0):
            found.append(f"{at}: too short")
        if len(value) > schema.get(f"max{name}", math.inf):
            found.append(f"{at}: too long")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += violations(item, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                found += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: not allowed")
    return found


def _checked(ids: pa.Array, names: pa.Array, arguments: pa.Array, results: pa.Array, schemas: dict) -> pa.Array:
    """Errors, and the canonical record of call and result (null where the arguments are no JSON)."""
    out = []
    for call, name, text, result in zip(*(x.to_pylist() for x in (ids, names, arguments, results)), strict=True):
        if name is None and text is None:
            out.append({"errors": [], "record": canonical({"id": call, "result": result})})
            continue
        try:
            value = parse(text)
        except (ValueError, RecursionError):
            out.append({"errors": ["$: not JSON"], "record": None})
            continue
        schema = schemas.get(name)
        errors = ["$: unknown tool"] if schema is None else [_storable(e) for e in violations(value, schema)]
        out.append({"errors": errors, "record": canonical({"arguments": value, "id": call, "name": name, "result": result})})
    return pa.array(out, pa.struct([("errors", pa.list_(pa.string())), ("record", pa.string())]))


def _levelled(batches):
    """Levels of the calls of a chunk as far as the levels below them are known."""
    for table, bounds in whole_groups(batches, ["conv", "chunk"]):
        rows = table.select(["conv", "chunk", "id", "refs", "known", "level"]).to_pylist()
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            group = {r["id"]: r for r in rows[low:high]}
            above: dict[str, list[str]] = {}
            open_, ready = {}, []
            for name, r in group.items():
                if r["level"] is not None:
                    continue
                outside = dict((x["ref"], x["level"]) for x in r["known"] or [])
                least, waits = 0, 0
                for ref in r["refs"] or []:
                    level = group[ref]["level"] if ref in group else outside.get(ref)
                    if level is None:
                        waits += 1
                        if ref in group:
                            above.setdefault(ref, []).append(name)
                    else:
                        least = max(least, level + 1)
                open_[name] = [waits, least]
                if not waits:
                    ready.append(name)
            while ready:
                name = ready.pop()
                group[name]["level"] = open_[name][1]
                for other in above.get(name, ()):
                    open_[other][0] -= 1
                    open_[other][1] = max(open_[other][1], group[name]["level"] + 1)
                    if not open_[other][0]:
                        ready.append(other)
        yield pa.RecordBatch.from_pylist(
            [{k: r[k] for k in ("conv", "chunk", "id", "refs", "level")} for r in rows], _LEVELS
        )


_LEVELS = pa.schema([("conv", pa.int64()), ("chunk", pa.string()), ("id", pa.string()), ("refs", pa.list_(pa.string())), ("level", pa.int64())])


def call_levels(calls: DataFrame) -> DataFrame:
    """``conv``, ``id`` and ``level`` of calls with ``conv``, ``id``, ``position`` and ``refs``.

    References to calls that the conversation doesn't have are left out. Calls on a cycle, or
    above one, have no level. Calls of one identifier are one, with the references of all.

    A conversation is levelled in chunks of about ``CHUNK`` calls in the order of their positions,
    each by one task; chunks that wait for others are taken up again in the next round, so an
    ordinary conversation takes one round and a huge one a round per chunk at most.
    """
    calls = calls.groupBy("conv", "id").agg(
        F.min("position").alias("position"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("refs")))).alias("refs")
    )
    calls = calls.withColumn("bucket", F.coalesce(F.floor(F.col("position") / CHUNK), F.lit(-1)))
    sizes = calls.groupBy("conv", "bucket").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("_n"))
    calls = calls.join(sizes, ["conv", "bucket"])
    calls = scratch_copy(calls.select(
        "conv", "id", "refs", F.concat_ws("-", "bucket", F.pmod(F.xxhash64("id"), F.col("_n"))).alias("chunk")
    ), "calls")
    exploded = calls.select("conv", "chunk", "id", F.explode("refs").alias("ref"))
    targets = calls.select("conv", F.col("id").alias("ref"), F.col("chunk").alias("_there"))
    edges = scratch_copy(exploded.join(targets, ["conv", "ref"]), "references")
    kept = edges.groupBy("conv", "id").agg(F.collect_set("ref").alias("refs"))
    state = calls.select("conv", "chunk", "id").join(kept, ["conv", "id"], "left")
    state = state.withColumn("level", F.lit(None).cast("long"))
    across = scratch_copy(edges.where("chunk <> _there").select("conv", "id", "ref"), "across")
    alone, before = across.isEmpty(), None
    while True:
        found = state.select("conv", F.col("id").alias("ref"), "level").where("level is not null")
        known = across.join(found, ["conv", "ref"]).groupBy("conv", "id").agg(
            F.collect_list(F.struct("ref", "level")).alias("known")
        )
        state = clustered(state.join(known, ["conv", "id"], "left"), ["conv", "chunk"])
        state = state.mapInArrow(_levelled, "conv long, chunk string, id string, refs array<string>, level long")
        state = scratch_copy(state, "levels")
        if alone:
            break
        now = state.where("level is null").count()
        if now in (0, before):
            break
        before = now
    return state.select("conv", "id", "level")


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Calls (``conv``, ``id``, ``position``, ``name``, ``arguments``, ``refs``) with their results
    (``conv``, ``id``, ``position``, ``content``).

    Returns ``conv``, ``level``, ``position``, ``id``, ``name``, ``status``, ``errors`` and
    ``record``, canonical JSON of identifier, name, arguments and result, sorted by conversation
    and level, then position and identifier, a topological order.

    ``status`` is ``ok``; or ``no call`` for a result without call, ``invalid`` for arguments that
    are no JSON or break the schema of their tool, or refer to an unknown call, ``cycle`` for a
    call without level, ``no result``; the first that applies, in this order. Of several results
    with one identifier the first by position, then content, is linked. Calls that repeat an
    identifier each link with its result. A null identifier or conversation links with nothing
    and refers to nothing: the call stands alone, at level 0. Null references are ignored; so are
    other columns. Empty tables give what the other table alone gives. A schema with a keyword that
    is not checked raises an error.
    """
    for name, schema in schemas.items():
        supported(schema, f"schema of {name}: $")
    calls = calls.select(
        F.col("conv").cast("long").alias("conv"), F.col("id").cast("string").alias("id"), F.col("position").cast("long").alias("position"),
        F.col("name").cast("string").alias("name"), F.col("arguments").cast("string").alias("arguments"),
        F.array_compact(F.coalesce("refs", F.array().cast("array<string>"))).alias("refs"), F.lit(True).alias("called"),
    )
    results = results.select(
        F.col("conv").cast("long").alias("conv"), F.col("id").cast("string").alias("id"), F.col("position").cast("long").alias("at"), "content"
    )
    nameless = results.where("id is null or conv is null")
    first = results.where("id is not null and conv is not null").groupBy("conv", "id").agg(
        F.min(F.struct("at", "content")).alias("r")
    ).select("conv", "id", "r.*")
    both = calls.join(first, ["conv", "id"], "full").unionByName(nameless, allowMissingColumns=True)
    levels = call_levels(calls.where("id is not null and conv is not null"))
    both = both.join(levels, ["conv", "id"], "left")
    refs = calls.where("id is not null and conv is not null").select("conv", "id", F.explode("refs").alias("ref")).distinct()
    there = calls.select("conv", F.col("id").alias("ref")).distinct()
    lost = refs.join(there, ["conv", "ref"], "left_anti").groupBy("conv", "id").agg(F.array_sort(F.collect_set("ref")).alias("lost"))
    both = both.join(lost, ["conv", "id"], "left")

    def check(ids: pa.Array, names: pa.Array, arguments: pa.Array, contents: pa.Array) -> pa.Array:
        return _checked(ids, names, arguments, contents, schemas)

    check = F.arrow_udf(check, "errors array<string>, record string")
    both = both.withColumn("_c", check("id", "name", "arguments", "content"))
    unknown = F.transform(F.coalesce("lost", F.array().cast("array<string>")), lambda x: F.concat(F.lit("unknown call "), x))
    called, alone = F.col("called").isNotNull(), F.col("id").isNull() | F.col("conv").isNull()
    level = F.when(called & alone, F.lit(0)).otherwise(F.col("level"))
    errors = F.concat(F.col("_c.errors"), unknown)
    status = (
        F.when(~called, "no call").when(F.size(errors) > 0, "invalid").when(level.isNull(), "cycle")
        .when(F.col("content").isNull(), "no result").otherwise("ok")
    )
    return both.select(
        "conv", level.cast("long").alias("level"), F.coalesce("position", "at").alias("position"), "id", "name",
        status.alias("status"), errors.alias("errors"), F.col("_c.record").alias("record"),
    ).orderBy("conv", "level", "position", "id")
