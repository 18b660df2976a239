"""JSON to typed columns, strict (a bad value is an error) or lenient (a bad value is null).

Every field is taken out of the parsed JSON once, in a projection of its own; the type rules then
work on plain columns. Catalyst keeps such projections apart because their results are used more
than once. Only the elements of lists and maps are handled inside higher-order functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.functions.scalars import FALSE_TEXTS, TRUE_TEXTS, decode_binary, try_float

# Date layouts tried in this order before ISO.
DATE_LAYOUTS = ("yyyy-M-d", "M/d/yyyy", "d-M-yyyy", "yyyy/M/d")


def _whole(text: Column, kind: Column) -> Column:
    """Text with a point is cut to its whole part, other text must be a whole number."""
    cut = try_float(text)
    near = F.when(cut < 0, F.ceil(cut)).otherwise(F.floor(cut)).try_cast("bigint")
    pointed = F.contains(text, F.lit(".")) | (kind == "DOUBLE")
    flag = F.when(text == "true", F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    return F.when(kind == "BOOLEAN", flag).when(pointed, near).otherwise(F.trim(text).try_cast("bigint"))


def _real(text: Column, kind: Column) -> Column:
    return F.when(kind == "BOOLEAN", F.when(text == "true", F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(try_float(text))


def _flag(text: Column, kind: Column) -> Column:
    """The listed words; any other non-empty text is true and empty text false; numbers by zero."""
    low = F.lower(text)
    return (
        F.when(low.isin(*TRUE_TEXTS), True).when(low.isin(*FALSE_TEXTS), False)
        .when(kind == "STRING", F.length(text) > 0).otherwise(text.try_cast("double") != 0)
    )


def _day(text: Column, kind: Column) -> Column:
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), F.substring(text, 1, 10).try_cast("date"))
    tried = [F.try_to_timestamp(text, F.lit(p)).cast("date") for p in DATE_LAYOUTS]
    return F.when(kind == "STRING", F.coalesce(*tried, iso))


def _time(text: Column, kind: Column) -> Column:
    """ISO text, the two plain layouts, or a number of epoch seconds."""
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
    slashes = F.try_to_timestamp(text, F.lit("yyyy/MM/dd HH:mm:ss"))
    number = F.timestamp_micros((text.try_cast("double") * 1000000).cast("bigint"))
    return F.when(kind == "STRING", F.coalesce(iso, slashes)).when(kind != "BOOLEAN", number)


def _bytes(value: Column, text: Column, kind: Column) -> Column:
    items = F.try_variant_get(value, "$", "array<int>")
    packed = F.unhex(F.array_join(F.transform(items, lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    return F.when(kind.startswith("ARRAY"), packed).otherwise(decode_binary(text))


def _scalar(kind: T.DataType, value: Column, text: Column, shape: Column) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return _whole(text, shape).try_cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _real(text, shape).cast(kind)
    if isinstance(kind, T.DecimalType):
        return F.trim(text).try_cast(kind)
    if isinstance(kind, T.BooleanType):
        return _flag(text, shape)
    if isinstance(kind, T.DateType):
        return _day(text, shape)
    if isinstance(kind, T.TimestampType):
        return _time(text, shape)
    if isinstance(kind, T.TimestampNTZType):
        return _time(text, shape).cast("timestamp_ntz")
    if isinstance(kind, T.BinaryType):
        return _bytes(value, text, shape)
    if isinstance(kind, T.VariantType):
        return F.when(shape == "STRING", F.try_parse_json(text)).otherwise(value)
    raise TypeError(f"type {kind.simpleString()} is not supported")


def _checked(got: Column, there: Column, text: Column, kind: T.DataType, strict: bool) -> Column:
    if strict:
        words = F.concat(F.lit("cannot convert "), F.coalesce(text, F.lit("?")), F.lit(f" to {kind.simpleString()}"))
        got = F.coalesce(got, F.raise_error(words).cast(kind))
    return F.when(there, got)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once, inside a higher-order function."""
    return F.transform(F.array(value), body)[0]


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _entry(v: Column, kind: T.DataType, strict: bool) -> Column:
    """An element of a list or map."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return _bind(v, lambda x: _nested(x, kind, strict))
    facts = F.struct(v.alias("v"), _text(v).alias("t"), F.schema_of_variant(v).alias("k"))
    return _bind(facts, lambda s: _checked(_scalar(kind, s["v"], s["t"], s["k"]), s["t"].isNotNull(), s["t"], kind, strict))


def _nested(v: Column, kind: T.DataType, strict: bool) -> Column:
    there = v.isNotNull() & ~F.is_variant_null(v)
    if isinstance(kind, T.StructType):
        shape = F.schema_of_variant(v)
        filled = shape.startswith("OBJECT<") & ~shape.startswith("OBJECT<>")
        parts = {f.name: F.try_variant_get(v, f"$['{f.name}']", "variant") for f in kind.fields}
        for f in kind.fields:
            if not f.nullable:
                filled = filled & parts[f.name].isNotNull()
        got = F.when(filled, F.struct(*[_entry(parts[f.name], f.dataType, strict).alias(f.name) for f in kind.fields]))
    elif isinstance(kind, T.ArrayType):
        got = _list(v, F.try_variant_get(v, "$", "array<variant>"), kind, strict)
    else:
        got = _map(F.try_variant_get(v, "$", "map<string,variant>"), kind, strict)
    return _checked(got, there, _text(v), kind, strict)


def _list(v: Column, items: Column, kind: T.ArrayType, strict: bool) -> Column:
    """A single value counts as a list of one where the list may hold nulls."""
    many = F.transform(items, lambda x: _entry(x, kind.elementType, strict))
    one = F.array(_entry(v, kind.elementType, strict)) if kind.containsNull else F.lit(None).cast(kind)
    return F.when(items.isNotNull(), many).otherwise(one)


def _map(pairs: Column, kind: T.MapType, strict: bool) -> Column:
    got = F.transform_values(pairs, lambda _, x: _entry(x, kind.valueType, strict))
    if not isinstance(kind.keyType, T.StringType):
        got = F.transform_keys(got, lambda k, _: k.try_cast(kind.keyType))
    return got


class _Fields:
    """Numbers the fields of a schema tree and lists the columns its values are first taken into."""

    def __init__(self) -> None:
        self.values: list[Column] = []
        self.facts: list[Column] = []

    def add(self, path: str, kind: T.DataType) -> int:
        i = len(self.values)
        self.values.append(F.try_variant_get("_v", path, "variant").alias(f"_n{i}"))
        v = F.col(f"_n{i}")
        if isinstance(kind, T.StructType):
            return i
        if isinstance(kind, T.ArrayType):
            self.facts.append(F.try_variant_get(v, "$", "array<variant>").alias(f"_k{i}"))
        elif isinstance(kind, T.MapType):
            self.facts.append(F.try_variant_get(v, "$", "map<string,variant>").alias(f"_k{i}"))
        else:
            self.facts += [_text(v).alias(f"_t{i}"), F.schema_of_variant(v).alias(f"_k{i}")]
        return i

    def typed(self, path: str, kind: T.DataType, strict: bool) -> Column:
        i = self.add(path, kind)
        value, text, extra = F.col(f"_n{i}"), F.col(f"_t{i}"), F.col(f"_k{i}")
        there = value.isNotNull() & ~F.is_variant_null(value)
        if isinstance(kind, T.StructType):
            parts, found = [], F.lit(False)
            needed = F.lit(True)
            for f in kind.fields:
                first = len(self.values)
                parts.append(self.typed(f"{path}['{f.name}']", f.dataType, strict).alias(f.name))
                known = F.col(f"_n{first}").isNotNull()
                found = found | known
                if not f.nullable:
                    needed = needed & known
            # Only an object without any known field has to be looked at as a whole.
            shape = F.schema_of_variant(value)
            other = shape.startswith("OBJECT<") & ~shape.startswith("OBJECT<>")
            filled = F.when(found, True).otherwise(F.coalesce(other, F.lit(False))) & needed
            return _checked(F.when(filled, F.struct(*parts)), there, _text(value), kind, strict)
        if isinstance(kind, T.ArrayType):
            return _checked(_list(value, extra, kind, strict), there, _text(value), kind, strict)
        if isinstance(kind, T.MapType):
            return _checked(_map(extra, kind, strict), there, _text(value), kind, strict)
        return _checked(_scalar(kind, value, text, extra), text.isNotNull(), text, kind, strict)


def coerce(df: DataFrame, col: str, schema: T.StructType | str, mode: str = "lenient") -> DataFrame:
    """The JSON text in ``col`` as the columns of ``schema``, next to the other columns.

    Strict: text that is no JSON, an empty object and a value that does not fit are errors.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError("mode must be strict or lenient")
    kind = schema if isinstance(schema, T.StructType) else df.sparkSession.createDataFrame([], schema).schema
    strict = mode == "strict"
    parse = F.parse_json if strict else F.try_parse_json
    rest = [c for c in df.columns if c != col]
    fields = _Fields()
    whole = fields.typed("$", kind, strict)
    rows = df.select(*rest, parse(F.col(col)).alias("_v")).select(*rest, *fields.values)
    names = [f"_n{i}" for i in range(len(fields.values))]
    rows = rows.select(*rest, *names, *fields.facts)
    typed = rows.select(*rest, whole.alias("_typed"))
    return typed.select(*rest, *[F.col("_typed")[f.name].alias(f.name) for f in kind.fields])
