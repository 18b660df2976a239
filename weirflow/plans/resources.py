"""A query per FHIR resource over records whose structure differs by row, held against their text in SQL.

Each element is written full, left out, sparse (every second part of a nested element, lists with nulls) or as JSON null;
which of these is decided per row and element by the columns of a customer, and the texts are its columns.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F, types as T

from weirflow.functions.scalars import snake_name
from weirflow.operators import fhir
from weirflow.plans.registry import query, table
from weirflow.plans.texts import chosen, made, replaced
from weirflow.session import spread

#: Marks in the texts, and the column of a customer that stands in their place; ``"@N"`` is a number.
MARKS = {"@K": "c_mktsegment", "@C": "c_name", "@D": "lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0')", "@N": "CAST(c_nationkey AS VARCHAR)"}
FULL, SPARSE = "full", "sparse"
#: Per primitive what a record holds, what JSON shows of it, and what a column of its own shows.
PLAIN = {
    "double": ("@N.5", "@N.5", "@N.5"), "long": ("@N", "@N", "@N"), "boolean": (True, True, "true"),
    "time": ("2024-01-@DT05:04:05+02:00", "2024-01-@DT03:04:05.000", "2024-01-@D 03:04:05"),
}


def _put(record: dict, path: str, value) -> None:
    """Write a value at a path like ``a.b[0].c``, adding what is not there."""
    *parents, last = path.split(".")
    for p in parents:
        name, listed = p.removesuffix("[0]"), p.endswith("[0]")
        at = record.setdefault(name, [{}] if listed else {})
        record = at[0] if listed else at
    record[last] = value


def _made(kind: str, stem: str, mode: str = FULL) -> tuple:
    """(what the record holds, what JSON shows, what a column shows)."""
    name, many = kind.rstrip("*"), kind.endswith("*")
    if many:
        pair = [_made(name, stem + x, m) for x, m in (("a", mode), ("b", FULL))]
        held = [p[0] for p in pair]
        if mode == SPARSE and name not in ("string", *PLAIN):
            held.insert(1, None)
        return held, [p[1] for p in pair], None
    if name == "string":
        text = stem + ("@K" if mode == FULL else "@C")
        return text, text, text
    if name in PLAIN:
        return PLAIN[name]
    record, shown = {}, {}
    for i, (path, column, inner) in enumerate(_elements(fhir.TYPES[name])):
        if mode == SPARSE and i % 2:
            if inner.endswith("*"):
                shown[column] = []
            continue
        held, seen, _ = _made(inner, f"{stem}{i}", mode)
        _put(record, path, held)
        shown[column] = seen
    return record, shown, None


def _elements(spec: str) -> list[tuple[str, str, str]]:
    out = []
    for token in spec.split():
        head, kind = token.rsplit(":", 1)
        path, _, name = head.partition(">")
        out.append((path, name or "_".join(snake_name(p) for p in path.split(".")), kind))
    return out


def _ways(top: str, elements: list[tuple[int, str, str, str]]) -> list[tuple[str | None, str | None]]:
    """The ways an element and what lies below it is written: JSON text, and the columns that hold something."""
    out = []
    compact = lambda x: json.dumps(x, separators=(",", ":"))
    empty = ";".join(f"{column}=[]" for _, _, column, kind in elements if kind.endswith("*")) or None
    for mode in (FULL, None, SPARSE, "null"):
        if mode is None or mode == "null":
            out.append((f'"{top}":null' if mode else None, empty))
            continue
        record, parts = {}, []
        for i, path, column, kind in elements:
            held, seen, plain = _made(kind, f"e{i}", mode)
            _put(record, path, held)
            parts.append(f"{column}=" + (plain if plain is not None else compact(seen)))
        out.append((compact(record)[1:-1], ";".join(parts)))
    return out


def _way(n: int) -> str:
    """Which way element ``n`` of a row is written, from 1."""
    return f"(c_custkey + {n} * (c_custkey % 7) + {n // 4} * (c_nationkey % 5)) % 4 + 1"


def _records(customers: DataFrame, resource: str, ways: list[list[str | None]]) -> DataFrame:
    """The record of every customer; null where a column that a mark stands for is null, empty without a key.

    Texts are put together in Arrow batches, outside the generated code that reads them.
    """
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    rows = spread(customers.select(
        key.alias("key"), (key % 7).alias("by_key"), (nation % 5).alias("by_nation"), nation.cast("string").alias("@N"),
        F.col("c_mktsegment").alias("@K"), F.col("c_name").alias("@C"), F.lpad((nation + 1).cast("string"), 2, "0").alias("@D"),
    ))

    def record(row: dict) -> str | None:
        if None in (row["@N"], row["@K"], row["@C"]):
            return None
        if row["key"] is None:
            return "{}"
        parts = [f'"resourceType":"{resource}","id":"p{row["key"]}"']
        parts += [chosen(w, row["key"] + n * row["by_key"] + n // 4 * row["by_nation"]) for n, w in enumerate(ways)]
        number = {'"@N"': row["@N"], '"@N.5"': row["@N"] + ".5"}
        return replaced("{" + ",".join(p for p in parts if p is not None) + "}", number | {mark: row[mark] for mark in ("@K", "@C", "@D", "@N")})

    return made(rows, record, "raw_json")


def _register(resource: str) -> None:
    groups: dict[str, list] = {}
    for i, (path, column, kind) in enumerate(_elements(fhir.RESOURCES[resource])):
        groups.setdefault(path.split(".")[0].removesuffix("[0]"), []).append((i, path, column, kind))
    ways = [_ways(top, elements) for top, elements in groups.items()]
    names = [column for elements in groups.values() for _, _, column, _ in elements]
    quoted = lambda x: "NULL" if x is None else f"'{x}'"
    content = "concat_ws(';', " + ", ".join(f"([{', '.join(quoted(shown) for _, shown in w)}])[{_way(n)}]" for n, w in enumerate(ways)) + ")"
    for mark, value in {'"@N"': MARKS["@N"], '"@N.5"': MARKS["@N"] + " || '.5'", **MARKS}.items():
        content = f"replace({content}, '{mark}', {value})"

    @query(f"fhir_1_{snake_name(resource)}", f"SELECT 'p' || c_custkey AS id, {len(names)} AS columns, md5({content}) AS content FROM customer")
    def _(spark, sf):
        records = _records(table(spark, sf, "customer"), resource, [[text for text, _ in w] for w in ways])
        got = fhir.extract_resources(records, resource, profile="base_r4")
        nested = lambda c: isinstance(got.schema[c].dataType, (T.StructType, T.ArrayType))
        cols = [F.concat(F.lit(f"{c}="), F.to_json(c) if nested(c) else F.col(c).cast("string")) for c in names]
        return got.select("id", F.lit(len(names)).alias("columns"), F.md5(F.concat_ws(";", *cols)).alias("content"))


for _resource in fhir.RESOURCES:
    _register(_resource)
