"""Projections that reshape rows: nested paths, names, blanks, properties, parent keys."""

from __future__ import annotations

import json
import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.functions.scalars import as_string_list, coerce_int, coerce_str, snake_name, try_float


# --- paths ---------------------------------------------------------------------------------


def variant_path(path: str) -> str:
    return "$" + "".join(f"['{part}']" for part in path.split("."))


def get_path(value: Column, path: str, kind: str = "string") -> Column:
    """A dotted field of a variant, null where a part is missing or no object."""
    return F.try_variant_get(value, variant_path(path), kind)


def set_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Write a dotted field of a struct column, adding parents that are not there."""
    top, *rest = path.split(".")
    if not rest:
        return df.withColumn(top, value)
    kind = df.schema[top].dataType if top in df.columns else None
    return df.withColumn(top, _with(F.col(top) if kind else None, kind, rest, value))


def _with(col: Column | None, kind: T.DataType | None, parts: Sequence[str], value: Column) -> Column:
    name, *rest = parts
    fields = {f.name: f.dataType for f in kind.fields} if isinstance(kind, T.StructType) else {}
    if rest:
        inner = col[name] if col is not None and name in fields else None
        value = _with(inner, fields.get(name), rest, value)
    if not fields:
        return F.struct(value.alias(name))
    kept = [(value if f == name else col[f]).alias(f) for f in fields]
    return F.struct(*kept, *([] if name in fields else [value.alias(name)]))


def flatten_struct(df: DataFrame, paths: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Nested paths as ``a_b_c`` columns."""
    return df.select(*keep, *[F.col(p).alias(p.replace(".", "_")) for p in paths])


# --- names and blanks ----------------------------------------------------------------------


def _renamed(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(snake_name(f.name), _renamed(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_renamed(kind.elementType), kind.containsNull)
    return kind


def snake_keys(df: DataFrame) -> DataFrame:
    """Snake case for columns and for the fields of structs and arrays of structs: names only, no copy."""
    return df.select(*[F.col(f"`{f.name}`").cast(_renamed(f.dataType)).alias(snake_name(f.name)) for f in df.schema.fields])


def _all_null(col: Column, kind: T.StructType) -> Column:
    out = F.lit(True)
    for f in kind.fields:
        out = out & col[f.name].isNull()
    return out


def nullify_empty_struct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A struct without any value becomes null."""
    return df.withColumns({c: F.when(~_all_null(F.col(c), df.schema[c].dataType), F.col(c)) for c in cols})


def _cleaned(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        inner = F.struct(*[_cleaned(col[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(col.isNotNull() & ~_all_null(inner, kind), inner)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(col, lambda x: _cleaned(x, kind.elementType))
    return col


def clean_empty_deep(df: DataFrame) -> DataFrame:
    """Empty structs become null at any depth, also inside arrays."""
    return df.select(*[_cleaned(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def blank_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in cols})


# --- JSON properties -----------------------------------------------------------------------


def split_properties(df: DataFrame, col: str, known: dict[str, str]) -> DataFrame:
    """JSON properties as a struct of the known keys plus a ``custom_properties`` map of the others."""
    pairs = F.from_json(F.col(col), "map<string,string>")
    typed = [F.try_element_at(pairs, F.lit(k)).try_cast(t).alias(k) for k, t in known.items()]
    custom = F.map_filter(pairs, lambda k, _: ~k.isin(*known))
    return df.withColumn(col, F.struct(*typed, custom.alias("custom_properties")))


def serialize_complex(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Structs, arrays and maps as JSON text."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    return df.withColumns({c: F.to_json(c) for c in (cols or nested)})


class _Number(str):
    """A number as the text has it."""


def _distinct(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("a key stands twice")
    return out


def _shown(value) -> str:
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{_shown(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_shown, value)) + "]"
    return value if isinstance(value, _Number) else json.dumps(value)


def _without_meta(value: dict) -> dict:
    out = {}
    for key, x in value.items():
        inner = isinstance(x, dict)
        if key.startswith("__") or inner and "__deferred" in x:
            continue
        out[key] = _without_meta(x) if inner and "__metadata" in x else x
    return out


#: Levels that JSON readers of Spark follow; deeper text is no JSON there.
JSON_LEVELS = 1000


def strip_meta(df: DataFrame, col: str) -> DataFrame:
    """A JSON object as a map without ``__`` keys and without deferred links; null for other text.

    Objects that carry ``__metadata`` themselves are cleaned alike, to any depth; other objects and lists stay as they
    are. One pass: texts without ``"__`` are left to the JSON reader, the others are cleaned in Arrow batches, since
    an expression cannot follow levels whose number differs by row.
    """

    @F.arrow_udf(T.StringType())
    def cleaned(texts: pa.Array) -> pa.Array:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * JSON_LEVELS))
        out = []
        for text in texts.to_pylist():
            try:
                value = json.loads(text, parse_int=_Number, parse_float=_Number, object_pairs_hook=_distinct)
                out.append(_shown(_without_meta(value)) if isinstance(value, dict) else None)
            except (ValueError, RecursionError):
                out.append(None)
        return pa.array(out, pa.string())

    marked = F.when(F.contains(F.col(col), F.lit('"__')) | F.contains(F.col(col), F.lit("\\u")), F.col(col))
    plain = F.when(marked.isNull(), F.col(col))
    text = F.coalesce(plain, cleaned(F.coalesce(marked, F.lit(""))))
    fields = F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")
    return df.withColumn(col, F.transform_values(fields, lambda _, x: F.try_variant_get(x, "$", "string")))


def inject_keys(df: DataFrame, **values) -> DataFrame:
    """Constant parent keys and lineage columns."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})


def hoist_and_derive(df: DataFrame, hoist: dict[str, str], url: Sequence[str] | None = None,
                     fallback: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Lift nested fields, build ``url`` from parts, and fill columns from the first value there is."""
    df = df.withColumns({new: F.col(path) for new, path in hoist.items()})
    if url:
        df = df.withColumn("url", F.concat_ws("/", *[F.col(p).cast("string") for p in url]))
    return df.withColumns({new: F.coalesce(*cols) for new, cols in (fallback or {}).items()})


def associations_to_ids(value: Column, kind: str) -> Column:
    """``{kind: {results: [{id}]}}`` or ``{kind: [{id}]}`` as a list of ids, empty when missing."""
    wrapped = F.try_variant_get(value, f"$['{kind}'].results", "array<variant>")
    plain = F.try_variant_get(value, f"$['{kind}']", "array<variant>")
    ids = F.transform(F.coalesce(wrapped, plain), lambda x: F.coalesce(F.try_variant_get(x, "$.id", "string"), F.try_variant_get(x, "$", "string")))
    return F.coalesce(ids, F.array().cast("array<string>"))


def first_of_fallback(record: Column, field: str) -> Column:
    """The top-level value, else its ``values`` entry: the text of an object, or the value itself.

    A response without an id of its own takes the entry ``_recordId``.
    """

    def entry(name: str) -> Column:
        path = f"$['values']['{name}']"
        is_object = F.schema_of_variant(F.try_variant_get(record, path, "variant")).startswith("OBJECT")
        return F.when(is_object, F.try_variant_get(record, f"{path}['textEntry']", "string")).otherwise(F.try_variant_get(record, path, "string"))

    found = F.coalesce(F.try_variant_get(record, f"$['{field}']", "string"), entry(field))
    return F.coalesce(F.nullif(found, F.lit("")), entry("_recordId"), found) if field == "responseId" else found


# Response fields that are no question answers.
RESPONSE_FIELDS = (
    "responseId", "surveyId", "recordedDate", "startDate", "endDate", "status", "ipAddress", "progress",
    "duration", "finished", "distributionChannel", "userLanguage", "locationLatitude", "locationLongitude", "_recordId",
)


def answers_map(values: Column) -> Column:
    """Question answers only, each as ``{choiceText, choiceId, textEntry}``; null when none is left."""
    pairs = F.map_filter(F.try_variant_get(values, "$", "map<string,variant>"), lambda k, _: ~k.isin(*RESPONSE_FIELDS))

    def answer(_: Column, v: Column) -> Column:
        is_object = F.schema_of_variant(v).startswith("OBJECT")
        part = lambda name: F.try_variant_get(v, f"$.{name}", "string")
        text = F.when(is_object, part("textEntry")).otherwise(F.try_variant_get(v, "$", "string"))
        return F.struct(part("choiceText").alias("choiceText"), part("choiceId").alias("choiceId"), text.alias("textEntry"))

    return F.when(F.size(pairs) > 0, F.transform_values(pairs, answer))


def first_where(items: Column, test) -> Column:
    """The first element that passes ``test``, or null."""
    return F.try_element_at(F.filter(items, test), F.lit(1))


def combine_singletons(parts: dict[str, DataFrame]) -> DataFrame:
    """Several one-row settings frames as one row of structs; a part without a row is null, one with more is an error."""
    out = None
    for name, df in parts.items():
        one = df.select(F.struct(*df.columns).alias("_s")).agg(F.first("_s").alias("_s"), F.count(F.lit(1)).alias("_n"))
        kind = one.schema["_s"].dataType
        many = F.raise_error(F.concat(F.lit(f"{name} has more than one row: "), F.col("_n").cast("string"))).cast(kind)
        one = one.select(F.when(F.col("_n") > 1, many).otherwise(F.col("_s")).alias(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.agg(*[F.first(name, ignorenulls=True).alias(name) for name in parts])


def keyed_singleton(df: DataFrame, known: Sequence[str], key: str = "id", value: object = 1) -> DataFrame:
    """A single settings row under a constant key, kept only if a known field has a value."""
    there = [F.col(c).cast("string") for c in known if c in df.columns]
    return df.filter(F.coalesce(*there).isNotNull()).withColumn(key, F.lit(value))


def either_shape(record: Column, fields: Sequence[str]) -> list[Column]:
    """Fields of ``{id, attributes: {...}}``, or of the record itself when it is flat already."""
    nested = F.try_variant_get(record, "$.attributes", "variant").isNotNull()
    out = [F.try_variant_get(record, "$.id", "string").alias("id")]
    for f in fields:
        out.append(F.when(nested, get_path(record, f"attributes.{f}")).otherwise(get_path(record, f)).alias(f))
    return out


# --- kind-dependent envelope ---------------------------------------------------------------

# Columns of each kind of record as (path, column, type).
KIND_COLUMNS = {
    "master-data--Wellbore": (
        ("FacilityID", "FacilityID", "text"),
        ("FacilityName", "FacilityName", "text"),
        ("FacilityTypeID", "FacilityTypeID", "text"),
        ("WellID", "WellID", "text"),
        ("KickOffWellboreID", "KickOffWellboreID", "text"),
        ("StatusSummary", "StatusSummary", "text"),
        ("TargetFormation", "TargetFormation", "text"),
        ("FacilityNameAliases", "FacilityNameAliases_json", "json"),
        ("FacilityOperators", "FacilityOperators_json", "json"),
        ("VerticalMeasurements", "VerticalMeasurements_json", "json"),
        ("SpatialLocation", "SpatialLocation_json", "json"),
        ("GeoContexts", "GeoContexts_json", "json"),
        ("DrillingReasons", "DrillingReasons_json", "json"),
        ("InitialCompletion", "InitialCompletion_json", "json"),
        ("ExtensionProperties", "ExtensionProperties_json", "json"),
    ),
    "master-data--Reservoir": (
        ("ReservoirID", "ReservoirID", "text"),
        ("ReservoirName", "ReservoirName", "text"),
        ("ReservoirType", "ReservoirType", "text"),
        ("ReservoirDescription", "ReservoirDescription", "text"),
        ("FieldID", "FieldID", "text"),
        ("BasinID", "BasinID", "text"),
        ("FormationID", "FormationID", "text"),
        ("FluidTypeID", "FluidTypeID", "text"),
        ("DepthTopMD", "DepthTopMD", "number"),
        ("DepthBaseMD", "DepthBaseMD", "number"),
        ("DepthTopTVD", "DepthTopTVD", "number"),
        ("DepthBaseTVD", "DepthBaseTVD", "number"),
        ("GrossThickness", "GrossThickness", "number"),
        ("NetPayThickness", "NetPayThickness", "number"),
        ("PorosityAverage", "PorosityAverage", "number"),
        ("WaterSaturationAverage", "WaterSaturationAverage", "number"),
        ("PermeabilityHorizontal", "PermeabilityHorizontal", "number"),
        ("PermeabilityVertical", "PermeabilityVertical", "number"),
        ("InitialReservoirPressure", "InitialReservoirPressure", "number"),
        ("ReservoirTemperature", "ReservoirTemperature", "number"),
        ("GeoContexts", "GeoContexts_json", "json"),
        ("NameAliases", "NameAliases_json", "json"),
        ("ExtensionProperties", "ExtensionProperties_json", "json"),
    ),
    "master-data--Sample": (
        ("SampleAcquisition.SampleAcquisitionJobID", "SampleAcquisitionJobID", "text"),
        ("SampleAcquisition.SampleAcquisitionTypeID", "SampleAcquisitionTypeID", "text"),
        ("SampleAcquisition.SampleAcquisitionContainerID", "SampleAcquisitionContainerID", "text"),
        ("SampleAcquisition.AcquisitionStartDate", "AcquisitionStartDate", "text"),
        ("SampleAcquisition.AcquisitionEndDate", "AcquisitionEndDate", "text"),
        ("SampleAcquisition.CollectionServiceCompanyID", "CollectionServiceCompanyID", "text"),
        ("SampleAcquisition.HandlingServiceCompanyID", "HandlingServiceCompanyID", "text"),
        ("SampleAcquisition.SampleAcquisitionDetail.WellboreID", "WellboreID", "text"),
        ("SampleAcquisition.SampleAcquisitionDetail.ToolKind", "ToolKind", "text"),
        ("SampleAcquisition.SampleAcquisitionDetail.RunNumber", "RunNumber", "text"),
        ("SampleAcquisition.SampleAcquisitionDetail.TopDepth", "TopDepth", "number"),
        ("SampleAcquisition.SampleAcquisitionDetail.BaseDepth", "BaseDepth", "number"),
        ("SampleAcquisition.SampleAcquisitionDetail.FormationCondition.Pressure", "FormationPressure", "number"),
        ("SampleAcquisition.SampleAcquisitionDetail.FormationCondition.Temperature", "FormationTemperature", "number"),
        ("SampleAcquisition", "SampleAcquisition_json", "json"),
        ("ExtensionProperties", "ExtensionProperties_json", "json"),
    ),
}


def _kind_value(data: Column, path: str, kind: str) -> Column:
    if kind == "json":
        return F.to_json(F.try_variant_get(data, variant_path(path), "variant"))
    return try_float(get_path(data, path)) if kind == "number" else coerce_str(get_path(data, path))


def kind_projection(df: DataFrame, col: str, kinds: Sequence[str] | None = None) -> DataFrame:
    """A record envelope as columns; the columns of a kind are filled only for rows of that kind."""
    raw = F.col("_raw")
    rows = df.withColumn("_raw", F.try_parse_json(F.col(col)))
    text = lambda p: get_path(raw, p)
    names = lambda p: as_string_list(F.try_variant_get(raw, variant_path(p), "variant"))
    json = lambda p: F.to_json(F.try_variant_get(raw, variant_path(p), "variant"))
    cols: dict[str, Column] = {
        "id": text("id"), "kind": text("kind"), "version": coerce_int(text("version")),
        "createTime": text("createTime"), "createUser": text("createUser"),
        "modifyTime": F.coalesce(F.nullif(text("modifyTime"), F.lit("")), text("createTime")), "modifyUser": text("modifyUser"),
        "acl_owners": names("acl.owners"), "acl_viewers": names("acl.viewers"),
        "legal_legaltags": names("legal.legaltags"), "legal_status": text("legal.status"),
        "legal_otherRelevantDataCountries": names("legal.otherRelevantDataCountries"),
        "tags_json": json("tags"), "meta_json": json("meta"), "data_json": F.coalesce(json("data"), F.lit("{}")),
    }
    data = F.try_variant_get(raw, "$.data", "variant")
    for kind in kinds or KIND_COLUMNS:
        mine = F.contains(F.coalesce(text("kind"), F.lit("")), F.lit(kind))
        for path, name, shape in KIND_COLUMNS[kind]:
            only = F.when(mine, _kind_value(data, path, shape))
            cols[name] = F.coalesce(cols[name], only) if name in cols else only
    rest = [c for c in df.columns if c != col and c not in cols]
    return rows.select(*rest, *[v.alias(k) for k, v in cols.items()])
