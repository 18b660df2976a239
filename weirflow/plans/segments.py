"""A query per HL7 segment type over messages whose structure differs by row, held against their text in SQL.

Each field is written full, empty, sparse (components, repetitions or sub-components missing) or as separators alone;
which of these is decided per row and field by the columns of an order, and the texts are its columns. Some messages
hold the segment twice, some not at all.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from weirflow.operators import hl7
from weirflow.plans.registry import query, table
from weirflow.plans.texts import chosen, filler, made, replaced
from weirflow.session import spread

#: Marks in the texts, and the column of an order that stands in their place.
MARKS = {
    "@K": "CAST(o_orderkey % 10 AS VARCHAR)", "@P": "o_orderpriority", "@T": "CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)",
    "@D": "strftime(o_orderdate, '%Y%m%d')", "@W": "strftime(o_orderdate, '%Y-%m-%d')",
}
DAY, SHOWN, LATER, SHOWN_LATER = "@D", "@WT00:00:00", "@D101500", "@WT10:15:00"
FULL, SPARSE = "full", "sparse"


def _subs(stem: str, names: list[str], mode: str) -> tuple[str, dict[str, str]]:
    """Sub-components of a component (the first alone if sparse), and the named ones among them."""
    parts = [f"{stem}s{k}@P" for k in range(1, len(names) + 1)][: 1 if mode == SPARSE else None]
    return "&".join(parts), {n: p for n, p in zip(names, parts) if n}


def _composite(stem: str, kind: str, mode: str = FULL) -> tuple[str, dict]:
    """Text of a composite with all its components, every second one if sparse, and what each named part of it holds."""
    texts, out = [], {}
    for i, token in enumerate(hl7.COMPOSITES[kind].split(), 1):
        own = f"{stem}c{i}"
        if mode == SPARSE and i % 2 == 0:
            texts.append("")
        elif token.endswith("@"):
            texts.append(DAY)
            out[token[:-1]] = SHOWN
        elif "=" in token:
            name, inner = token.split("=")
            text, values = _subs(own, hl7.COMPOSITES[inner].split(), mode)
            texts.append(text)
            out[name] = values
        elif "&" in token:
            text, values = _subs(own, token.lstrip("+").split("&"), mode)
            texts.append(text)
            out |= values
        else:
            texts.append(own + "@T")
            if token != "-":
                out[token] = own + "@T"
    return "^".join(texts), out


def _field(n: int, token: str) -> list[tuple[str, list]]:
    """The ways a field is written: its text, and the values of the columns it gives."""
    kind, stem = token.split(":")[1], f"f{n}"
    base, many, none = kind.rstrip("*~"), kind.endswith("*"), [None] * len(hl7.column_names(token))
    if base in hl7.COMPOSITES:
        (one, first), (two, second), (thin, sparse) = _composite(stem, base), _composite(f"{stem}r", base), _composite(f"{stem}t", base, SPARSE)
        if many:
            return [(f"{one}~{two}", [[first, second]]), ("", none), (f"{thin}~~{two}~{thin}", [[sparse, second, sparse]]), ("~", none)]
        return [(f"{one}~{two}" if kind.endswith("~") else one, [first]), ("", none), (thin, [sparse]), ("^^", none)]
    if base == "SI":
        return [(f"{n}@K", [f"{n}@K"]), ("", none), ("n/a", none), ("@T", ["@T"])]
    if base == "NO":
        return [(f"{n}@K", [f"{n}@K"]), ("", ["1"]), ("n/a", ["1"]), ("@T", ["@T"])]
    if base == "TS" and many:
        return [(f"{DAY}~{LATER}", [[SHOWN, SHOWN_LATER]]), ("", none), (f"{LATER}~~", [[SHOWN_LATER]]), ("~", none)]
    if base == "TS":
        return [(DAY, [SHOWN]), ("", none), (LATER, [SHOWN_LATER]), (DAY, [SHOWN])]
    if base == "DR":
        return [(f"{DAY}^{LATER}", [SHOWN, SHOWN_LATER]), ("", none), (f"{LATER}^", [SHOWN_LATER, None]), (f"^{DAY}", [None, SHOWN])]
    if base in ("HDF", "MSG"):
        a, b, c = (f"{stem}c{i}@P" for i in (1, 2, 3))
        return [(f"{a}^{b}^{c}", [a, b, c]), ("", none), (f"{a}^^{c}", [a, None, c]), ("^^", none)]
    a, b, c = (f"{stem}{x}@P" for x in "abc")
    if base == "ID":
        return [(f"{a}^x~{b}^x", [[a, b]]), ("", none), (f"{a}^x~^x~{c}", [[a, c]]), ("~", none)]
    if many:
        return [(f"{a}~{b}", [[a, b]]), ("", none), (f"{a}~~{b}~{c}", [[a, b, c]]), ("~", none)]
    if kind.endswith("~"):
        return [(f"{a}~{b}", [a]), ("", none), (f"~{b}", none), (c, [c])]
    return [(a, [a]), ("", none), (b, [b]), (c, [c])]


def _shown(names: list[str], values: list) -> str | None:
    """The columns that hold something as text."""
    parts = [f"{c}=" + (v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))) for c, v in zip(names, values) if v is not None]
    return ";".join(parts) or None


def _way(n: int) -> str:
    """Which way field ``n`` of a row is written, from 1."""
    return f"(o_custkey + {n} * (o_orderkey % 7) + {n // 4} * (CAST(floor(o_totalprice) AS BIGINT) % 11) + 3 * line) % 4 + 1"


def _messages(orders: DataFrame, kind: str, ways: list[list[str]]) -> DataFrame:
    """The message of every order; null where a column that a mark stands for is null, all fields the last way without a customer.

    Texts are put together in Arrow batches, outside the generated code that reads them.
    """
    key, price = F.col("o_orderkey"), F.floor("o_totalprice")
    rows = spread(orders.select(
        key.alias("key"), F.col("o_custkey").alias("customer"), (key % 5 != 0).alias("once"), (key % 3 == 0).alias("again"), (key % 7).alias("by_key"),
        (price % 11).alias("by_price"), (key % 10).cast("string").alias("@K"), F.col("o_orderpriority").alias("@P"), price.cast("string").alias("@T"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("@D"),
    ))

    def line(customer: int | None, by_key: int, by_price: int) -> str:
        shown = [chosen(w, None if customer is None else customer + n * by_key + n // 4 * by_price) for n, w in enumerate(ways, 1)]
        return f"{kind.upper()}|{'|'.join(shown)}\r"

    marks = [mark for mark in MARKS if mark in rows.columns]
    known: dict[tuple, Callable[[dict[str, str]], str]] = {}

    def line_of(customer: int | None, by_key: int, by_price: int, values: dict[str, str]) -> str:
        """The ways go by remainders of four, so all rows share 64 lines and that without a customer; negative ones go their own way."""
        if min(customer or 0, by_key, by_price) < 0:
            return replaced(line(customer, by_key, by_price), values)
        at = (customer if customer is None else customer % 4, by_key % 4, by_price % 4)
        if at not in known:
            known[at] = filler(line(*at), marks)
        return known[at](values)

    def message(row: dict) -> str | None:
        if None in (row["key"], row["@P"], row["@T"], row["@D"]):
            return None
        c, again = row["customer"], row["again"]
        lines = [] if not row["once"] else [c, None if c is None else c + 3] if again else [c]
        head = f"MSH|^~\\&|A|B|C|D|20240101||ADT^A01|{row['key']}|P|2.5\r"
        return head + "".join(line_of(x, row["by_key"], row["by_price"], {mark: row[mark] for mark in marks}) for x in lines)

    return made(rows, message, "message")


def _register(kind: str) -> None:
    tokens = hl7.SEGMENTS[kind].split()
    ways = [_field(n, t) for n, t in enumerate(tokens, 1)]
    names = [c for t in tokens for c in hl7.column_names(t)]
    quoted = lambda x: "NULL" if x is None else f"'{x}'"
    parts = ", ".join(f"([{', '.join(quoted(_shown(hl7.column_names(t), v)) for _, v in w)}])[{_way(n)}]" for n, (t, w) in enumerate(zip(tokens, ways), 1))
    content = f"concat_ws(';', {parts})"
    for mark, value in MARKS.items():
        content = f"replace({content}, '{mark}', {value})"
    lines = "o_orderkey % 5 <> 0 AND (line = 0 OR o_orderkey % 3 = 0)"

    @query(f"hl7_4_segment_{kind}", f"SELECT CAST(o_orderkey AS VARCHAR) AS message_id, {len(names)} AS columns, md5({content}) AS content FROM orders, (VALUES (0), (1)) AS l(line) WHERE {lines}")
    def _(spark, sf):
        messages = hl7.parse_messages(_messages(table(spark, sf, "orders"), kind, [[t for t, _ in w] for w in ways]))
        got = hl7.segment_table(messages, kind, json=True)
        parts = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in names]
        return got.select("message_id", F.lit(len(names)).alias("columns"), F.md5(F.concat_ws(";", *parts)).alias("content"))


for _kind in hl7.SEGMENTS:
    if _kind != "msh":
        _register(_kind)
