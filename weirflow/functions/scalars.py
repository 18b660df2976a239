"""Scalar rules as Column expressions: names, dates, numbers, text, JSON."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import lru_cache

from pyspark.sql import Column, functions as F

# Texts read as true and as false.
TRUE_TEXTS = ("true", "t", "1", "yes", "y")
FALSE_TEXTS = ("false", "f", "0", "no", "n")
# Shape of an e-mail address and its replacement.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
EMAIL_REPLACEMENT = "redacted@example.com"
# Report metric types and the numbers they hold.
WHOLE_METRICS = ("TYPE_INTEGER", "TYPE_MILLISECONDS")
REAL_METRICS = (
    "TYPE_FLOAT", "TYPE_CURRENCY", "TYPE_SECONDS", "TYPE_MINUTES", "TYPE_HOURS",
    "TYPE_FEET", "TYPE_MILES", "TYPE_METERS", "TYPE_KILOMETERS", "TYPE_STANDARD",
)


# --- names ---------------------------------------------------------------------------------


def to_snake_case(col: Column) -> Column:
    spaced = F.regexp_replace(col, r"(.)([A-Z][a-z]+)", "$1_$2")
    return F.lower(F.regexp_replace(spaced, r"([a-z0-9])([A-Z])", "$1_$2"))


def snake_name(name: str) -> str:
    """:func:`to_snake_case` for a column name at plan time."""
    spaced = re.sub(r"(.)([A-Z][a-z]+)", r"\1_\2", name)
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", spaced).lower()


def safe_column_name(col: Column, index: Column) -> Column:
    """Letters, digits and single underscores only; a blank name becomes ``_col<index>``."""
    flat = F.regexp_replace(F.trim(F.coalesce(col, F.lit(""))), "[^a-zA-Z0-9_]+", "_")
    clean = F.regexp_replace(F.regexp_replace(flat, "_+", "_"), "^_|_$", "")
    return F.when(clean == "", F.concat(F.lit("_col"), index.cast("string"))).otherwise(clean)


def safe_column_name_text(text: str | None, index: int) -> str:
    """:func:`safe_column_name` for a header cell at plan time."""
    flat = re.sub(r"_+", "_", re.sub(r"[^a-zA-Z0-9_]+", "_", (text or "").strip())).strip("_")
    return flat or f"_col{index}"


def report_header_name(text: str) -> str:
    return text.strip().lower().replace(" ", "_")


# --- time ----------------------------------------------------------------------------------


def _iso(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` of a zone-free timestamp, whole seconds."""
    return F.replace(F.date_trunc("second", ts).cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T"))


def _utc(micros: Column) -> Column:
    """Zone-free UTC timestamp of epoch microseconds, whatever the session time zone."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=micros / F.lit(1000000).cast("decimal(20,6)"))


def parse_relative_time(col: Column, now: Column) -> Column:
    """``*``, ``*-10m``, ``*-2h``, ``*-7d`` or ISO; anything else is ``now``. Zone-free UTC."""
    text = F.trim(col)
    amount = F.regexp_extract(text, r"^\*-(\d+)([mhd])$", 1).try_cast("int")
    unit = F.regexp_extract(text, r"^\*-(\d+)([mhd])$", 2)
    back = (
        F.when(unit == "m", F.make_dt_interval(mins=amount)).when(unit == "h", F.make_dt_interval(hours=amount))
        .when(unit == "d", F.make_dt_interval(days=amount))
    )
    return F.coalesce(F.when(unit != "", now - back), F.when(~text.startswith("*"), normalize_iso(text)), now)


def parse_odata_date(col: Column) -> Column:
    """``/Date(ms)/`` or ``/Date(ms+hhmm)/`` as ISO UTC seconds; other text stays as it is."""
    ms = F.regexp_extract(col, r"^/Date\((-?\d+)([+-]\d{4})?\)/", 1).try_cast("bigint")
    return F.coalesce(F.concat(_seconds_text(ms), F.lit("Z")), col)


def _seconds_text(ms: Column) -> Column:
    return F.replace(_utc(F.floor(ms / F.lit(1000)) * F.lit(1000000)).cast("string"), F.lit(" "), F.lit("T"))


def epoch_ms_to_iso(col: Column) -> Column:
    """Epoch milliseconds as ISO text with offset and, if any, six digits of a second; else null."""
    ms = col.try_cast("bigint")
    part = F.pmod(ms, F.lit(1000))
    tail = F.when(part > 0, F.concat(F.lit("."), F.lpad(part.cast("string"), 3, "0"), F.lit("000"))).otherwise(F.lit(""))
    return F.concat(_seconds_text(ms), tail, F.lit("+00:00"))


def epoch_ms_field(col: Column) -> Column:
    """Epoch milliseconds as ``yyyy-MM-ddTHH:mm:ssZ``; bad values give null."""
    return F.concat(_seconds_text(col.try_cast("bigint")), F.lit("Z"))


# Fixed value: shape of a message time, year first, two digits per further part.
DTM = r"^(?!0000)\d{4}(?:\d{2}){0,5}(?:\.\d+)?(?:[+-](?:[01]\d|2[0-3])\d{2})?$"


def parse_hl7_dtm(col: Column) -> Column:
    """A message time of any precision as ISO text in UTC; null when it is none.

    Missing parts are the first month, the first day and zero; fractions of a second are dropped.
    """
    text = F.btrim(col, F.lit(" ()"))
    # The digits are laid over the defaults of a full time.
    full = F.overlay(F.lit("00000101000000"), F.regexp_extract(text, r"^\d+", 0), F.lit(1))
    local = F.regexp_replace(full, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6").try_cast("timestamp_ntz")
    mins = F.substring(text, -4, 2).try_cast("int") * 60 + F.substring(text, -2, 2).try_cast("int")
    signed = F.when(F.substring(text, -5, 1) == "+", mins).otherwise(-mins)
    utc = F.when(text.rlike(r"[+-]\d{4}$"), local - F.make_dt_interval(mins=signed)).otherwise(local)
    return F.when(text.rlike(DTM), F.replace(utc.cast("string"), F.lit(" "), F.lit("T")))


# The same for Python: the digits, and the zone.
DTM_PARTS = re.compile(r"(?!0000)(\d{4}(?:\d{2}){0,5})(?:\.\d+)?([+-](?:[01]\d|2[0-3])\d{2})?", re.ASCII)



@lru_cache(1 << 16)
def hl7_dtm_text(text: str) -> str | None:
    """:func:`parse_hl7_dtm` for a text of one line in an Arrow batch."""
    text = text.strip(" ()")
    line = text[:-1] if text.endswith(("\x85", "\u2028", "\u2029")) else text  # ``$`` of Java stands before them too
    found = DTM_PARTS.fullmatch(line)
    if found is None or found[2] and line is not text:
        return None
    full = found[1] + "00000101000000"[len(found[1]) :]
    year, rest = int(full[:4]), [int(full[i : i + 2]) for i in range(4, 14, 2)]
    try:
        moved = datetime(year, *rest)
        if found[2]:
            turn = 400 if year < 5000 else -400  # days go by the same rule, and no time leaves the years Python knows
            zone = timedelta(hours=int(found[2][1:3]), minutes=int(found[2][3:]))
            moved = moved.replace(year + turn) + (zone if found[2][0] == "-" else -zone)
            year = moved.year - turn
    except ValueError:
        return None
    return f"{'+' if year > 9999 else ''}{year:04d}{moved:-%m-%dT%H:%M:%S}"


def yyyymmdd_to_iso(col: Column) -> Column:
    """``20240131`` as ``2024-01-31``; text that is not a date of eight digits stays as it is."""
    day = F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2))
    return F.when(col.rlike(r"^\d{8}$") & day.try_cast("date").isNotNull(), day).otherwise(col)


def normalize_iso(col: Column) -> Column:
    """ISO text with or without offset as a zone-free UTC timestamp; naive text counts as UTC."""
    text = F.trim(col)
    shaped = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text)
    zone = F.regexp_extract(shaped, r"T?\d{2}:\d{2}.*([+-]\d{2}:?\d{2})$", 1)
    bare = F.regexp_replace(F.regexp_replace(shaped, r"[Zz]$", ""), r"(\d{2}:\d{2}.*)[+-]\d{2}:?\d{2}$", "$1")
    mins = F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, -2, 2).try_cast("int")
    shift = F.when(zone.startswith("+"), mins).when(zone.startswith("-"), -mins).otherwise(F.lit(0))
    return bare.try_cast("timestamp_ntz") - F.make_dt_interval(mins=shift)


def cursor_gt(left: Column, right: Column, unordered: bool = False) -> Column:
    """``left > right`` as moments when both are times, else as numbers, else as text."""
    lt, rt = normalize_iso(left.cast("string")), normalize_iso(right.cast("string"))
    ln, rn = left.try_cast("double"), right.try_cast("double")
    by_time = F.when(lt.isNotNull() & rt.isNotNull(), lt > rt)
    by_number = F.when(ln.isNotNull() & rn.isNotNull(), ln > rn)
    mixed = (lt.isNotNull() | ln.isNotNull()) != (rt.isNotNull() | rn.isNotNull())
    by_text = F.when(~mixed, left.cast("string") > right.cast("string"))
    return F.coalesce(by_time, by_number, by_text, F.lit(unordered))


# Time layouts tried in this order.
TIME_LAYOUTS = (
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]", "yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]'Z'",
)


def parse_multi_format_ts(col: Column, strict: bool = False) -> Column:
    """The first layout that fits; without one null, or an error when ``strict``."""
    got = F.coalesce(*[F.try_to_timestamp(col, F.lit(p)) for p in TIME_LAYOUTS])
    if not strict:
        return got
    bad = col.isNotNull() & got.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("no time layout fits: "), col)).cast("timestamp")).otherwise(got)


def shift_days(col: Column, days: int, layout: str = "yyyyMMdd") -> Column:
    """A date text moved by days; text that is no date stays as it is."""
    day = F.try_to_timestamp(col, F.lit(layout)).cast("date")
    return F.coalesce(F.date_format(F.date_add(day, days), layout), col)


def shift_minutes(col: Column, minutes: int) -> Column:
    return col + F.make_dt_interval(mins=F.lit(minutes))


# --- numbers and flags ---------------------------------------------------------------------


def as_bool(col: Column, default: bool = False) -> Column:
    """Flags as they are, numbers true unless zero (NaN is true), text by the words for either; else ``default``."""
    kind, text = F.typeof(col), F.lower(F.trim(col.cast("string")))
    number = kind.isin("tinyint", "smallint", "int", "bigint", "float", "double") | kind.startswith("decimal")
    by_text = F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False).otherwise(F.lit(default))
    return F.when(col.isNull(), F.lit(default)).when(number, text.try_cast("double") != 0).otherwise(by_text)


def try_float(col: Column) -> Column:
    """Text as a double; Java's ``1d`` and ``1f`` suffixes are not numbers here."""
    text = F.trim(col.cast("string"))
    return F.when(~text.rlike(r"[0-9.][dDfF]$"), text.try_cast("double"))


def coerce_int(col: Column) -> Column:
    """Whole-number text, or a flag as 0/1; anything else is null."""
    text = F.lower(F.trim(col.cast("string")))
    flag = F.when(text == "true", F.lit(1)).when(text == "false", F.lit(0)).cast("bigint")
    return F.coalesce(flag, F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")))


def coerce_str(col: Column) -> Column:
    return col.cast("string")


def metric_value(col: Column, metric_type: str) -> Column:
    """A report metric by its type: long, double or the text itself; bad numbers are null."""
    if metric_type in WHOLE_METRICS:
        return coerce_int(col)
    if metric_type in REAL_METRICS:
        return try_float(col)
    return col.cast("string")


def metric_type_name(metric_type: str) -> str:
    if metric_type in WHOLE_METRICS:
        return "bigint"
    return "double" if metric_type in REAL_METRICS else "string"


def clamp_decimal(precision: int | None, scale: int | None) -> tuple[int, int]:
    """Precision at most 38 and scale at most the precision; 38 and 18 where not given."""
    p = min(int(precision), 38) if precision else 38
    s = int(scale) if scale is not None else 18
    return p, min(s, p)


# --- text, lists, JSON ---------------------------------------------------------------------


def as_string_list(value: Column) -> Column:
    """A variant as ``array<string>``: a list element by element, a single value as one entry."""
    items = F.try_variant_get(value, "$", "array<variant>")
    single = F.try_variant_get(value, "$", "string")
    return (
        F.when(value.isNull() | F.is_variant_null(value), F.lit(None).cast("array<string>"))
        .when(items.isNotNull(), F.transform(items, lambda x: F.try_variant_get(x, "$", "string")))
        .otherwise(F.array(single))
    )


def decode_binary(col: Column) -> Column:
    """Base64, else hex, else the UTF-8 bytes."""
    return F.coalesce(F.try_to_binary(col, F.lit("base64")), F.try_to_binary(col, F.lit("hex")), F.encode(col, "UTF-8"))


def scrub_emails(col: Column) -> Column:
    return F.regexp_replace(col, EMAIL, EMAIL_REPLACEMENT)


def body_sha256(col: Column) -> Column:
    return F.when(F.length(col) > 0, F.sha2(F.encode(col, "UTF-8"), 256))


def valid_uid(col: Column) -> Column:
    """Digits and dots of any length, no empty part."""
    return F.coalesce(col.rlike(r"^[0-9.]+$") & ~F.contains(col, F.lit("..")), F.lit(False))


def csv_to_list(col: Column) -> Column:
    """Comma-separated names, trimmed, empty ones dropped; text that starts with ``[`` is JSON."""
    plain = F.filter(F.transform(F.split(col, ","), lambda x: F.trim(x)), lambda x: x != "")
    parsed = F.from_json(col, "array<string>")
    return F.when(F.trim(col).startswith("["), parsed).otherwise(plain)


def json_text(col: Column) -> Column:
    return F.to_json(col)


def first_word_or_unknown(col: Column) -> Column:
    word = F.split_part(F.trim(F.coalesce(col, F.lit(""))), F.lit(" "), F.lit(1))
    return F.when(word == "", F.lit("Unknown")).otherwise(word)


def url_base(col: Column) -> Column:
    """Scheme, host and path."""
    return F.regexp_extract(col, r"^([^?#]*)", 1)


def url_query(col: Column) -> Column:
    """Query parameters as a map; of a repeated name the last value counts."""
    pairs = F.split(F.regexp_extract(col, r"\?([^#]*)", 1), "&")
    entries = F.transform(
        F.filter(pairs, lambda p: p != ""),
        lambda p: F.struct(F.split_part(p, F.lit("="), F.lit(1)).alias("k"), F.regexp_extract(p, r"^[^=]*=(.*)$", 1).alias("v")),
    )
    names = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    return F.map_from_entries(F.transform(
        names, lambda n: F.struct(n.alias("k"), F.element_at(F.filter(entries, lambda e: e["k"] == n), -1)["v"].alias("v"))
    ))


def shape_of(value: Column) -> Column:
    """Kind of a variant: null, bool, int, float, str, list, dict."""
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (kind == "VOID"), F.lit("null")).when(kind == "BOOLEAN", F.lit("bool"))
        .when(kind == "BIGINT", F.lit("int")).when(kind == "STRING", F.lit("str"))
        .when(kind.startswith("ARRAY"), F.lit("list")).when(kind.startswith("OBJECT"), F.lit("dict"))
        .otherwise(F.lit("float"))
    )
