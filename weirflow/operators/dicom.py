"""DICOM JSON objects (hex tag to value list) as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Tags and their columns; a number type behind the colon, ``*`` keeps all values.
STUDY_TAGS = {
    "0020000D": "study_instance_uid", "00080020": "study_date", "00080030": "study_time", "00080050": "accession_number",
    "00100010": "patient_name", "00100020": "patient_id", "00081030": "study_description", "00080061": "modalities_in_study*",
    "00201206": "number_of_study_related_series:bigint", "00201208": "number_of_study_related_instances:bigint",
}
SERIES_TAGS = {
    "0020000E": "series_instance_uid", "0020000D": "study_instance_uid", "00080020": "study_date", "00200011": "series_number:bigint",
    "0008103E": "series_description", "00080060": "modality", "00180015": "body_part_examined", "00080021": "series_date",
}
INSTANCE_TAGS = {
    "00080018": "sop_instance_uid", "0020000E": "series_instance_uid", "0020000D": "study_instance_uid", "00080016": "sop_class_uid",
    "00200013": "instance_number:bigint", "00080020": "study_date", "00080023": "content_date", "00080033": "content_time",
}
PERSON_FORMS = ("Alphabetic", "Ideographic", "Phonetic")


def tag_value(obj: Column, tag: str, path: str, kind: str) -> Column:
    """A part of a tag's entry; the tag may be written in upper or lower case."""
    return F.coalesce(*[F.try_variant_get(obj, f"$['{t}'].{path}", kind) for t in dict.fromkeys((tag.upper(), tag.lower()))])


#: One parse gives every tag its kind and values; numbers and objects come as their JSON text.
ENTRIES = "map<string, struct<vr: string, Value: array<string>>>"


def _text(entry: Column) -> Column:
    """The first value; of a person name the first written form that is there."""
    first = F.get(entry["Value"], F.lit(0))
    forms = [F.nullif(F.get_json_object(first, f"$.{f}"), F.lit("")) for f in PERSON_FORMS]
    plain = F.when(~first.startswith("{"), first)
    return F.when(entry["vr"] == "PN", F.coalesce(*forms, plain)).otherwise(first)


def _column(entry: Column, name: str) -> Column:
    if name.endswith("*"):
        return entry["Value"].alias(name[:-1])
    plain, _, kind = name.partition(":")
    if kind:
        return F.floor(F.get(entry["Value"], F.lit(0)).try_cast("double")).try_cast(kind).alias(plain)
    return _text(entry).alias(plain)


def dicom_table(df: DataFrame, col: str, tags: dict[str, str]) -> DataFrame:
    """DICOM JSON text as one row of columns; a tag without value is null."""
    rest = [c for c in df.columns if c != col]
    rows = df.select(*rest, F.from_json(F.col(col), ENTRIES).alias("_v"))
    cased = lambda t: [F.try_element_at("_v", F.lit(x)) for x in dict.fromkeys((t.upper(), t.lower()))]
    rows = rows.select(*rest, *[F.coalesce(*cased(t)).alias(f"_{t}") for t in tags])
    return rows.select(*rest, *[_column(F.col(f"_{t}"), n) for t, n in tags.items()])


def where_tag(df: DataFrame, col: str, tag: str, value: str) -> DataFrame:
    """Rows whose metadata (variant) has ``value`` first in a tag."""
    return df.filter(tag_value(F.col(col), tag, "Value[0]", "string") == value)
