"""FHIR R4 resources as typed columns next to their raw JSON.

Each resource is a list of ``element:type`` entries; types name primitives or other lists here, so
nested elements are built by the same rule. A column is the element name in snake case, with the
parts of a path joined, unless ``>name`` says otherwise. ``*`` marks a list; an absent list is empty.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions.scalars import normalize_iso, snake_name
from weirflow.operators.shaping import first_where

PRIMITIVES = {"string": "string", "double": "double", "long": "bigint", "boolean": "boolean"}

# Data types and nested elements.
TYPES = {
    "Coding": "system:string code:string display:string",
    "CodeableConcept": "coding:Coding* text:string",
    "Reference": "reference:string display:string",
    "Period": "start:time end:time",
    "Identifier": "system:string value:string use:string",
    "HumanName": "family:string given:string* text:string use:string",
    "Address": "use:string line:string* city:string district:string postalCode>postalCode:string country:string",
    "ContactPoint": "system:string value:string use:string",
    "Quantity": "value:double unit:string system:string code:string",
    "Annotation": "text:string time:time",
    "Dosage": "text:string timing.code.coding[0].code>timing_code:string doseAndRate[0].doseQuantity.value>dose_value:double "
              "doseAndRate[0].doseQuantity.unit>dose_unit:string route:CodeableConcept site:CodeableConcept",
    "ObservationRange": "low.value:double low.unit:string high.value:double high.unit:string type:CodeableConcept text:string",
    "ObservationComponent": "code:CodeableConcept valueQuantity:Quantity valueString:string valueCodeableConcept:CodeableConcept "
                            "valueBoolean:boolean valueInteger:long dataAbsentReason:CodeableConcept",
    "AllergyReaction": "substance:CodeableConcept manifestation:CodeableConcept* description:string onset:time severity:string "
                       "exposureRoute:CodeableConcept",
    "EncounterParticipant": "type:CodeableConcept* period:Period individual:Reference",
    "EncounterDiagnosis": "condition:Reference use:CodeableConcept rank:long",
    "Hospitalization": "admitSource:CodeableConcept reAdmission:CodeableConcept dischargeDisposition:CodeableConcept "
                       "origin:Reference destination:Reference",
    "EncounterLocation": "location:Reference status:string physicalType:CodeableConcept period:Period",
    "ProcedurePerformer": "function:CodeableConcept actor:Reference onBehalfOf:Reference",
    "DispenseRequest": "validityPeriod:Period numberOfRepeatsAllowed:long quantity.value:double quantity.unit:string "
                       "expectedSupplyDuration.value:double expectedSupplyDuration.unit:string",
    "ImmunizationPerformer": "function:CodeableConcept actor:Reference",
    "ProtocolApplied": "series:string authority:Reference targetDisease:CodeableConcept* doseNumberPositiveInt:long "
                       "doseNumberString:string seriesDosesPositiveInt:long seriesDosesString:string",
    "CoverageClass": "type:CodeableConcept value:string name:string",
    "CarePlanActivity": "reference:Reference detail.status:string detail.code:CodeableConcept detail.description:string",
    "GoalTarget": "measure:CodeableConcept detailQuantity:Quantity detailString:string detailBoolean:boolean dueDate:string",
    "DeviceName": "name:string type:string",
    "RelatesTo": "code:string target:Reference",
    "DocumentContent": "attachment.url:string attachment.title:string attachment.contentType:string format.code:string format.system:string",
    "DocumentContext": "encounter:Reference* event:CodeableConcept* period:Period facilityType:CodeableConcept practiceSetting:CodeableConcept",
}

# The typed elements of each resource.
RESOURCES = {
    "Patient": "identifier:Identifier* active:boolean name:HumanName* telecom:ContactPoint* gender:string birthDate>birthDate:string "
               "deceasedBoolean:boolean deceasedDateTime>deceased_datetime:time address:Address* maritalStatus>maritalStatus:CodeableConcept "
               "generalPractitioner>generalPractitioner:Reference* managingOrganization>managingOrganization:Reference",
    "Observation": "status:string category:CodeableConcept* code:CodeableConcept subject:Reference encounter:Reference "
                   "effectiveDateTime>effective_datetime:time effectivePeriod:Period issued:time performer:Reference* "
                   "valueQuantity:Quantity valueCodeableConcept:CodeableConcept valueString:string valueBoolean:boolean "
                   "valueInteger:long dataAbsentReason:CodeableConcept interpretation:CodeableConcept* bodySite:CodeableConcept "
                   "method:CodeableConcept specimen:Reference device:Reference referenceRange:ObservationRange* hasMember:Reference* "
                   "derivedFrom:Reference* component:ObservationComponent*",
    "Condition": "identifier:Identifier* clinicalStatus:CodeableConcept verificationStatus:CodeableConcept category:CodeableConcept* "
                 "severity:CodeableConcept code:CodeableConcept bodySite:CodeableConcept* subject:Reference encounter:Reference "
                 "onsetDateTime>onset_datetime:time onsetPeriod:Period onsetString:string abatementDateTime>abatement_datetime:time "
                 "abatementString:string recordedDate:string recorder:Reference asserter:Reference note:Annotation*",
    "AllergyIntolerance": "identifier:Identifier* clinicalStatus:CodeableConcept verificationStatus:CodeableConcept type:string "
                          "category:string* criticality:string code:CodeableConcept patient:Reference encounter:Reference "
                          "onsetDateTime>onset_datetime:time onsetString:string recordedDate:string recorder:Reference asserter:Reference "
                          "lastOccurrence:time note:Annotation* reaction:AllergyReaction*",
    "Encounter": "identifier:Identifier* status:string class>class_coding:Coding type:CodeableConcept* serviceType:CodeableConcept "
                 "priority:CodeableConcept subject:Reference episodeOfCare:Reference* participant:EncounterParticipant* "
                 "appointment:Reference* period:Period reasonCode:CodeableConcept* reasonReference:Reference* "
                 "diagnosis:EncounterDiagnosis* hospitalization:Hospitalization location:EncounterLocation* serviceProvider:Reference "
                 "partOf:Reference",
    "Procedure": "identifier:Identifier* status:string statusReason:CodeableConcept category:CodeableConcept code:CodeableConcept "
                 "subject:Reference encounter:Reference performedDateTime>performed_datetime:time performedPeriod:Period "
                 "recorder:Reference asserter:Reference performer:ProcedurePerformer* location:Reference reasonCode:CodeableConcept* "
                 "reasonReference:Reference* bodySite:CodeableConcept* outcome:CodeableConcept report:Reference* "
                 "complication:CodeableConcept* followUp:CodeableConcept* note:Annotation*",
    "DiagnosticReport": "identifier:Identifier* basedOn:Reference* status:string category:CodeableConcept* code:CodeableConcept "
                        "subject:Reference encounter:Reference effectiveDateTime>effective_datetime:time effectivePeriod:Period "
                        "issued:time performer:Reference* resultsInterpreter:Reference* specimen:Reference* result:Reference* "
                        "conclusion:string conclusionCode:CodeableConcept*",
    "MedicationRequest": "identifier:Identifier* status:string statusReason:CodeableConcept intent:string category:CodeableConcept* "
                         "priority:string medicationCodeableConcept:CodeableConcept medicationReference:Reference subject:Reference "
                         "encounter:Reference authoredOn:string requester:Reference reasonCode:CodeableConcept* "
                         "reasonReference:Reference* note:Annotation* dosageInstruction:Dosage* dispenseRequest:DispenseRequest "
                         "substitution.allowedBoolean:boolean",
    "Immunization": "identifier:Identifier* status:string statusReason:CodeableConcept vaccineCode:CodeableConcept patient:Reference "
                    "encounter:Reference occurrenceDateTime>occurrence_datetime:time occurrenceString:string recorded:string "
                    "primarySource:boolean manufacturer:Reference lotNumber:string expirationDate:string site:CodeableConcept "
                    "route:CodeableConcept doseQuantity:Quantity performer:ImmunizationPerformer* reasonCode:CodeableConcept* "
                    "reasonReference:Reference* isSubpotent:boolean programEligibility:CodeableConcept* fundingSource:CodeableConcept "
                    "protocolApplied:ProtocolApplied*",
    "Coverage": "identifier:Identifier* status:string type:CodeableConcept policyHolder:Reference subscriber:Reference "
                "subscriberId:string beneficiary:Reference dependent:string relationship:CodeableConcept period:Period payor:Reference* "
                "class>class_coverage:CoverageClass* order:long network:string subrogation:boolean",
    "CarePlan": "identifier:Identifier* status:string intent:string category:CodeableConcept* title:string description:string "
                "subject:Reference encounter:Reference period:Period created:string author:Reference careTeam:Reference* "
                "addresses:Reference* goal:Reference* activity:CarePlanActivity* note:Annotation*",
    "Goal": "identifier:Identifier* lifecycleStatus:string achievementStatus:CodeableConcept category:CodeableConcept* "
            "priority:CodeableConcept description:CodeableConcept subject:Reference startDate:string "
            "startCodeableConcept:CodeableConcept target:GoalTarget* statusDate:string statusReason:string expressedBy:Reference "
            "addresses:Reference* note:Annotation*",
    "Device": "identifier:Identifier* status:string statusReason:CodeableConcept* manufacturer:string manufactureDate:string "
              "expirationDate:string lotNumber:string serialNumber:string deviceName:DeviceName* modelNumber:string "
              "type:CodeableConcept patient:Reference owner:Reference contact:ContactPoint* note:Annotation* safety:CodeableConcept*",
    "DocumentReference": "identifier:Identifier* status:string docStatus:string type:CodeableConcept category:CodeableConcept* "
                         "subject:Reference date:time author:Reference* authenticator:Reference custodian:Reference "
                         "relatesTo:RelatesTo* description:string securityLabel:CodeableConcept* content:DocumentContent* "
                         "context:DocumentContext",
}

# The order profiles fall back in, and the addresses of the national patient extensions.
PROFILE_CHAIN = ("uk_core", "base_r4")
NHS_NUMBER = "https://fhir.nhs.uk/Id/nhs-number"
UK_EXTENSIONS = {
    "ethnic_category": "https://fhir.hl7.org.uk/StructureDefinition/Extension-UKCore-EthnicCategory",
    "birth_sex": "https://fhir.hl7.org.uk/StructureDefinition/Extension-UKCore-BirthSex",
    "death_notification_status": "https://fhir.hl7.org.uk/StructureDefinition/Extension-UKCore-DeathNotificationStatus",
    "interpreter_required": "http://hl7.org/fhir/StructureDefinition/patient-interpreterRequired",
    "residential_status": "https://fhir.hl7.org.uk/StructureDefinition/Extension-UKCore-ResidentialStatus",
}


def _get(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, f"$.{path}", kind)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def _tokens(spec: str) -> list[tuple[str, str, str]]:
    """(path, column, kind) of every entry of a list."""
    out = []
    for token in spec.split():
        head, kind = token.rsplit(":", 1)
        path, _, name = head.partition(">")
        out.append((path, name or "_".join(snake_name(p) for p in path.split(".")), kind))
    return out


def _ddl(kind: str) -> str:
    """The type of a column of a kind."""
    name = kind.rstrip("*")
    own = (PRIMITIVES | {"time": "timestamp_ntz"}).get(name) or f"struct<{', '.join(f'`{n}`: {_ddl(k)}' for _, n, k in _tokens(TYPES[name]))}>"
    return f"array<{own}>" if kind.endswith("*") else own


def _value(value: Column, path: str, kind: str) -> Column:
    """One element of a variant as a named type."""
    many, name = kind.endswith("*"), kind.rstrip("*")
    if many and name in PRIMITIVES:
        return F.coalesce(_get(value, path, f"array<{PRIMITIVES[name]}>"), F.array().cast(f"array<{PRIMITIVES[name]}>"))
    if many:
        items = F.filter(_get(value, path, "array<variant>"), lambda x: ~F.is_variant_null(x))
        return F.coalesce(F.transform(items, lambda x: F.struct(*_elements(x, TYPES[name]))), F.array().cast(_ddl(kind)))
    if name == "time":
        return _bind(_get(value, path, "string"), normalize_iso)
    if name in PRIMITIVES:
        return _get(value, path, PRIMITIVES[name])
    return _bind(_get(value, path, "variant"), lambda x: F.when(_filled(x, TYPES[name]), F.struct(*_elements(x, TYPES[name]))))


def _filled(value: Column, spec: str) -> Column:
    """An object with at least one of the listed elements."""
    tops = dict.fromkeys(re.split(r"[.\[>:]", token)[0] for token in spec.split())
    out = F.lit(False)
    for name in tops:
        out = out | _get(value, name, "variant").isNotNull()
    return out


def _elements(value: Column, spec: str, wanted: Sequence[str] | None = None) -> list[Column]:
    return [_value(value, path, kind).alias(name) for path, name, kind in _tokens(spec) if wanted is None or name in wanted]


def bundle_entries(df: DataFrame, col: str) -> DataFrame:
    """Bundles as one row of resource JSON per entry; entries without a resource are left out."""
    rest = [c for c in df.columns if c != col]
    entries = F.try_variant_get(F.try_parse_json(F.col(col)), "$.entry", "array<variant>")
    rows = df.select(*rest, F.explode(entries).alias("_e")).withColumn("_r", F.try_variant_get("_e", "$.resource", "variant"))
    return rows.filter(F.col("_r").isNotNull() & ~F.is_variant_null("_r")).select(*rest, F.to_json("_r").alias("raw_json"))


def _uk_patient(raw: Column) -> list[Column]:
    """National additions to a patient: the health number and the listed extensions."""
    ids, exts = _get(raw, "identifier", "array<variant>"), _get(raw, "extension", "array<variant>")
    nhs = first_where(ids, lambda x: _get(x, "system", "string") == NHS_NUMBER)
    has_url = lambda u: lambda x: _get(x, "url", "string") == u
    ext = {n: first_where(exts, has_url(u)) for n, u in UK_EXTENSIONS.items()}
    out = [_get(nhs, "value", "string").alias("nhs_number")]
    for name, found in ext.items():
        if name == "interpreter_required":
            out.append(_get(found, "valueBoolean", "boolean").alias(name))
            continue
        if name == "death_notification_status":
            found = first_where(_get(found, "extension", "array<variant>"), lambda x: _get(x, "url", "string") == "deathNotificationStatus")
        out.append(_value(found, "valueCodeableConcept", "CodeableConcept").alias(name))
    return out


def profile_chain(profile: str) -> list[str]:
    """The profiles tried in turn; one that is not in the chain is tried first."""
    if profile in PROFILE_CHAIN:
        return list(PROFILE_CHAIN[PROFILE_CHAIN.index(profile):])
    return [profile, *PROFILE_CHAIN]


def typed_columns(resource: str, profile: str, raw: Column, wanted: Sequence[str] | None = None) -> list[Column]:
    """Columns of the first profile in the chain that knows the resource; none for an unknown one."""
    for name in profile_chain(profile):
        if name == "uk_core" and resource == "Patient":
            return [*_elements(raw, RESOURCES[resource], wanted), *_uk_patient(raw)]
        if name == "base_r4" and resource in RESOURCES:
            return _elements(raw, RESOURCES[resource], wanted)
    return []


def extract_resources(
    df: DataFrame, resource: str, col: str = "raw_json", profile: str = "uk_core", columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of one resource type: id, type, last update, raw JSON, extensions and the typed columns.

    ``columns`` names the typed columns wanted, which keeps the plan of a wide resource small.
    """
    rest = [c for c in df.columns if c != col]
    # The type is tested where the text is parsed: a filter above would make Catalyst parse it twice.
    mine = F.filter(
        F.array(F.try_parse_json(F.col(col))), lambda v: F.coalesce(_get(v, "resourceType", "string"), F.lit(resource)) == resource
    )
    rows = df.select(*rest, F.col(col).alias("raw_json"), F.explode(mine).alias("_v"))
    raw = F.col("_v")
    return rows.select(
        *rest, _get(raw, "id", "string").alias("id"), F.coalesce(_get(raw, "resourceType", "string"), F.lit(resource)).alias("resourceType"),
        normalize_iso(_get(raw, "meta.lastUpdated", "string")).alias("lastUpdated"), "raw_json",
        F.coalesce(F.to_json(_get(raw, "extension", "variant")), F.lit("null")).alias("extension"),
        *typed_columns(resource, profile, raw, columns),
    )
