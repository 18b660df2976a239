"""Table contracts and the checks on a run specification."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from typing import Any

# The four ingestion types and the history kinds a spec may name.
INGESTION_TYPES = ("snapshot", "cdc", "cdc_with_deletes", "append")
SCD_KINDS = ("SCD_TYPE_1", "SCD_TYPE_2", "APPEND_ONLY")
# Per-table settings that steer the landing and never reach a source.
RESERVED_SETTINGS = ("scd_type", "primary_keys", "sequence_by", "cluster_by")


class SpecError(ValueError):
    """A specification or option that cannot be used."""


@dataclass(frozen=True)
class TableContract:
    """What a table promises: its keys, its cursor and how its changes arrive."""

    name: str
    primary_keys: tuple[str, ...] = ()
    cursor_field: str | None = None
    ingestion_type: str = "cdc"
    namespace: tuple[str, ...] = ()
    schema: str | None = None

    def problems(self) -> list[str]:
        found = []
        if self.ingestion_type not in INGESTION_TYPES:
            found.append(f"unknown ingestion type {self.ingestion_type!r}")
            return found
        if self.ingestion_type != "append" and not self.primary_keys:
            found.append("primary_keys are required unless the table is append")
        if self.ingestion_type in ("cdc", "cdc_with_deletes") and not self.cursor_field:
            found.append("cursor_field is required for cdc")
        return found


@dataclass(frozen=True)
class TablePlan:
    """One table of a validated spec, resolved against its contract."""

    source_table: str
    destination: str
    scd_type: str = "SCD_TYPE_1"
    primary_keys: tuple[str, ...] = ()
    sequence_by: str | None = None
    cluster_by: tuple[str, ...] = ()
    options: dict[str, str] = field(default_factory=dict)
    ingestion_type: str = "cdc"


def as_name_list(value: Any) -> tuple[str, ...]:
    """A JSON array, a comma list, one name or a list of names, as names."""
    if value is None:
        return ()
    if isinstance(value, (list, tuple)):
        return tuple(str(v).strip() for v in value if str(v).strip())
    text = str(value).strip()
    if text.startswith("["):
        try:
            parsed = json.loads(text)
        except json.JSONDecodeError as err:
            raise SpecError(f"not a JSON list: {text}") from err
        if not isinstance(parsed, list):
            raise SpecError(f"not a JSON list: {text}")
        return as_name_list(parsed)
    return tuple(part.strip() for part in text.split(",") if part.strip())


def decode_option(text: str | None, kind: type, name: str = "option") -> Any:
    """A JSON list or dict option; anything that is not JSON of that kind is an error."""
    if text is None:
        return kind()
    try:
        value = json.loads(text)
    except json.JSONDecodeError as err:
        raise SpecError(f"{name} must be JSON: {err}") from err
    if not isinstance(value, kind):
        raise SpecError(f"{name} must be a JSON {kind.__name__}, got {type(value).__name__}")
    return value


def _text(value: Any) -> str:
    if isinstance(value, (dict, list)):
        return json.dumps(value)
    if isinstance(value, bool):
        return str(value).lower()
    return str(value)


def _plan_one(entry: Any) -> TablePlan:
    if not isinstance(entry, dict) or set(entry) != {"table"} or not isinstance(entry["table"], dict):
        raise SpecError("every object must be {'table': {...}}")
    table = entry["table"]
    known = {
        "source_table", "destination_catalog", "destination_schema", "destination_table", "table_configuration",
    }
    unknown = sorted(set(table) - known)
    if unknown:
        raise SpecError(f"unknown keys {unknown}")
    source = str(table.get("source_table") or "").strip()
    if not source:
        raise SpecError("source_table must not be blank")
    settings = table.get("table_configuration") or {}
    if not isinstance(settings, dict):
        raise SpecError("table_configuration must be a mapping")
    kind = settings.get("scd_type")
    if kind is not None:
        kind = str(kind).upper()
        if kind not in SCD_KINDS:
            raise SpecError(f"scd_type must be one of {SCD_KINDS}, got {kind}")
    target = table.get("destination_table") or source
    catalog, schema = table.get("destination_catalog"), table.get("destination_schema")
    sequence = settings.get("sequence_by")
    return TablePlan(
        source_table=source,
        destination=f"{catalog}.{schema}.{target}" if catalog and schema else target,
        scd_type=kind or "",
        primary_keys=as_name_list(settings.get("primary_keys")),
        sequence_by=str(sequence) if sequence else None,
        cluster_by=as_name_list(settings.get("cluster_by")),
        options={k: _text(v) for k, v in settings.items() if k not in RESERVED_SETTINGS and v is not None},
    )


def validate_spec(spec: Any) -> tuple[str, list[TablePlan]]:
    """The connection name and one plan per table object, or :class:`SpecError`."""
    if not isinstance(spec, dict):
        raise SpecError("a spec must be a mapping")
    unknown = sorted(set(spec) - {"connection_name", "objects"})
    if unknown:
        raise SpecError(f"unknown keys {unknown}")
    connection = spec.get("connection_name")
    if not isinstance(connection, str) or not connection.strip():
        raise SpecError("connection_name must not be blank")
    objects = spec.get("objects")
    if not isinstance(objects, list) or not objects:
        raise SpecError("objects must hold at least one table")
    return connection.strip(), [_plan_one(entry) for entry in objects]


def resolve(plan: TablePlan, contract: TableContract | None) -> TablePlan:
    """Fill what the spec leaves open from the contract; a table without one counts as cdc."""
    kind = contract.ingestion_type if contract else "cdc"
    keys: Sequence[str] = plan.primary_keys or (contract.primary_keys if contract else ())
    cursor = plan.sequence_by or (contract.cursor_field if contract else None)
    if plan.scd_type == "APPEND_ONLY":
        kind = "append"
    if kind != "append" and not keys:
        raise SpecError(f"{plan.source_table}: primary keys are needed for {kind}")
    if kind in ("cdc", "cdc_with_deletes") and not cursor:
        raise SpecError(f"{plan.source_table}: a sequence column is needed for {kind}")
    return replace(
        plan,
        ingestion_type=kind,
        primary_keys=tuple(keys),
        sequence_by=cursor,
        scd_type=plan.scd_type or "SCD_TYPE_1",
    )
