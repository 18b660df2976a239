"""Queries over message and resource formats. The documents are built out of the given tables by Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions import schemas as sm
from weirflow.functions.coerce import coerce
from weirflow.operators import dicom, fhir, hl7, shaping as sh
from weirflow.plans.registry import query, table
from weirflow.session import fresh_path


def _s(name):
    return F.col(name).cast("string")


def _messages(spark, sf):
    """An admission message per order; pending orders name other separators."""
    day = F.date_format("o_orderdate", "yyyyMMddHHmmss")
    key, cust, prio, status, price = _s("o_orderkey"), _s("o_custkey"), F.col("o_orderpriority"), F.col("o_orderstatus"), _s("o_totalprice")
    lines = [
        F.concat(F.lit("MSH|^~\\&|HIS^1.2.3^ISO|HOSP|LAB|LAB2|"), day, F.lit("-0500||ADT^A01^ADT_A01|"), key, F.lit("|P^T|2.5.1&x|12")),
        F.concat(F.lit("EVN||"), day),
        F.concat(F.lit("PID|1||"), cust, F.lit("^^^HOSP&1.2&ISO^MR~"), key, F.lit("^9^M11^ALT~||Doe\\T\\Co^"), prio, F.lit("^^Jr||19700315|"), status,
                 F.lit("^Status^L|Al~Bo|2106-3^White~2028-9^Asian|12 Main^^Boston^MA^02101^US^^^MA01&Suffolk&FIPS|||||||||||||||US^USA~CA^Canada~")),
        F.concat(F.lit("ORC|RE|P"), key, F.lit("^EPIC^1.2.3^ISO|F"), key), F.concat(F.lit("ORC|NW|Q"), key),
        F.concat(F.lit("OBX|1|NM|PRICE^Total \\F\\ price^L||"), price, F.lit("~a\\F\\b|USD^Dollar")),
        F.concat(F.lit("OBX|0|ST|PRIO^Priority||"), prio),
        F.concat(F.lit("AL1||DA^Drug^HL70127|"), prio, F.lit("^Code||HIV^Hives~RSH^Rash|"), F.date_format("o_orderdate", "yyyyMM"), F.lit("")),
        F.concat(F.lit("ZXX|"), key, F.lit("||a^b|"), status),
    ]
    text = F.concat_ws("\r", *lines)
    other = F.translate(text, "|^~\\&", "#*!?%")
    body = F.when(status == "P", other).otherwise(text)
    return table(spark, sf, "orders").select(_s("o_orderkey").alias("source_file"), body.alias("message"))


def _parsed(spark, sf):
    return hl7.parse_messages(_messages(spark, sf))


@query("hl7_1_split_batch", """
    SELECT CAST(o_orderkey AS VARCHAR) AS source_file, 'A' || o_orderkey AS message_id, 2 AS lines FROM orders UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'B' || o_orderkey, 1 FROM orders
""")
def _(spark, sf):
    key = _s("o_orderkey")
    data = F.concat(
        F.lit("FHS|^~\\&|X\r\nBHS|^~\\&|Y\r\nMSH|^~\\&|a|b|c|d|2024||ADT|A"), key, F.lit("|P|2.5\nEVN|x\r\n\r\nmsh|^~\\&|a|b|c|d|2024||ADT|B"), key,
        F.lit("|P|2.5\nBTS|2\r\nFTS|1\r\n"),
    )
    got = hl7.parse_messages(hl7.split_batch(table(spark, sf, "orders").select(key.alias("source_file"), data.alias("data"))))
    return got.select("source_file", "message_id", F.size(F.split("message", "\r")).alias("lines"))


@query("hl7_2_parse_segments", """
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, strftime(o_orderdate, '%Y%m%d%H%M%S') || '-0500' AS message_timestamp,
           strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') AS message_datetime, CASE WHEN o_orderstatus = 'P' THEN '#' ELSE '|' END AS field_separator,
           CASE WHEN o_orderstatus = 'P' THEN '*!?%' ELSE '^~\\&' END AS encoding_characters, 'HIS' AS sending_application, '1.2.3' AS sending_application_universal_id,
           'A01' AS trigger_event, 'T' AS mode, CASE WHEN o_orderstatus = 'P' THEN '2.5.1%x' ELSE '2.5.1&x' END AS hl7_version, 12 AS sequence_number FROM orders
""".replace("\\\\", "\\"))
def _(spark, sf):
    wanted = ["message_datetime", "field_separator", "encoding_characters", "sending_application", "trigger_event", "processing_id", "sequence_number"]
    got = hl7.segment_table(_parsed(spark, sf), "msh", [*wanted, "sending_application_universal_id"])
    return got.select("message_id", "message_timestamp", "message_datetime", "field_separator", "encoding_characters", "sending_application",
                      "sending_application_universal_id", "trigger_event", F.col("processing_id.mode").alias("mode"), "hl7_version", "sequence_number")


@query("hl7_3_escapes", """
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, 'Total ' || CASE WHEN o_orderstatus = 'P' THEN '#' ELSE '|' END || ' price' AS text,
           CASE WHEN o_orderstatus = 'P' THEN 'a?F?b' ELSE 'a\\F\\b' END AS second_value FROM orders
""".replace("\\\\", "\\"))
def _(spark, sf):
    got = hl7.segment_table(_parsed(spark, sf), "obx", ["set_id", "observation_id", "observation_value"]).filter("set_id = 1")
    return got.select("message_id", F.col("observation_id.text").alias("text"), F.col("observation_value")[1].alias("second_value"))


@query("hl7_4_segment_table_obx", """
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, 1 AS set_id, 'NM' AS value_type, 'PRICE' AS code, CAST(o_totalprice AS VARCHAR) AS value, 'USD' AS unit FROM orders
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 0, 'ST', 'PRIO', o_orderpriority, NULL FROM orders
""")
def _(spark, sf):
    got = hl7.segment_table(_parsed(spark, sf), "obx", ["set_id", "value_type", "observation_id", "observation_value", "units"])
    return got.select("message_id", "set_id", "value_type", F.col("observation_id.code").alias("code"),
                      F.col("observation_value")[0].alias("value"), F.col("units.code").alias("unit"))


@query("hl7_4_segment_table_pid", """
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, '1970-03-15T00:00:00' AS date_of_birth, o_orderstatus AS sex, 'Al' AS patient_alias, 'Boston' AS city, 'Suffolk' AS county,
           2 AS ids, CAST(o_custkey AS VARCHAR) AS first_id, 'ISO' AS authority_type, CAST(o_orderkey AS VARCHAR) AS second_id, o_orderpriority AS given_name, 'Jr' AS suffix FROM orders
""")
def _(spark, sf):
    wanted = ["patient_id", "patient_names", "date_of_birth", "administrative_sex", "patient_alias", "address"]
    got = hl7.segment_table(_parsed(spark, sf), "pid", wanted)
    ids, name, home = F.col("patient_id"), F.col("patient_names")[0], F.col("address")[0]
    return got.select(
        "message_id", "date_of_birth", F.col("administrative_sex.code").alias("sex"), "patient_alias", home["city"].alias("city"),
        home["county_parish_text"].alias("county"), F.size(ids).alias("ids"), ids[0]["id"].alias("first_id"),
        ids[0]["assigning_authority_universal_id_type"].alias("authority_type"), ids[1]["id"].alias("second_id"),
        name["given_name"].alias("given_name"), name["suffix"].alias("suffix"),
    )


@query("hl7_5_composites", """
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, no AS set_id, CASE no WHEN 1 THEN 'P' ELSE 'Q' END || o_orderkey AS entity, CASE no WHEN 1 THEN 'EPIC' END AS namespace,
           CASE no WHEN 1 THEN 'F' || o_orderkey END AS filler FROM orders, (VALUES (1), (2)) t(no)
""")
def _(spark, sf):
    got = hl7.segment_table(_parsed(spark, sf), "orc", ["placer_order_number", "filler_order_number"])
    return got.select("message_id", "set_id", F.col("placer_order_number.entity_identifier").alias("entity"),
                      F.col("placer_order_number.namespace_id").alias("namespace"), F.col("filler_order_number.entity_identifier").alias("filler"))


@query("hl7_6_generic_segment", """
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, 'ZXX' AS segment_type, CAST(o_orderkey AS VARCHAR) AS field_1, CAST(NULL AS VARCHAR) AS field_2,
           CASE WHEN o_orderstatus = 'P' THEN 'a*b' ELSE 'a^b' END AS field_3, o_orderstatus AS field_4, CAST(NULL AS VARCHAR) AS field_25 FROM orders
""")
def _(spark, sf):
    got = hl7.segment_table(_parsed(spark, sf), "zxx")
    return got.select("message_id", "segment_type", "field_1", "field_2", "field_3", "field_4", "field_25")


@query("hl7_7_rep_queries", """
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, code, text, 2 AS citizenships, true AS has_race FROM orders, (VALUES ('HIV', 'Hives'), ('RSH', 'Rash')) r(code, text)
""")
def _(spark, sf):
    parsed = _parsed(spark, sf)
    reactions = hl7.segment_table(parsed, "al1").select("message_id", F.explode("allergy_reaction").alias("r")).select("message_id", "r.code", "r.text")
    people = hl7.segment_table(parsed, "pid", ["citizenship", "race"]).select(
        "message_id", F.size("citizenship").alias("citizenships"), F.exists("race", lambda r: r["code"] == "2028-9").alias("has_race")
    )
    # Spark takes what was read in Arrow batches to be a hundredth of its size: left to it, all reactions go through the driver.
    return reactions.hint("merge").join(people, "message_id")


@query("win_4_set_id", """
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, 1 AS set_id, strftime(o_orderdate, '%Y-%m-01T00:00:00') AS identification_date FROM orders
""")
def _(spark, sf):
    return hl7.segment_table(_parsed(spark, sf), "al1").select("message_id", "set_id", "identification_date")


# --- FHIR ----------------------------------------------------------------------------------


def _coded(code, text):
    return F.struct(F.array(F.struct(F.lit("http://loinc.org").alias("system"), code.alias("code"))).alias("coding"), text.alias("text"))


def _patients(spark, sf):
    nhs = F.struct(F.lit(fhir.NHS_NUMBER).alias("system"), _s("c_custkey").alias("value"))
    local = F.struct(F.lit("urn:x").alias("system"), F.col("c_name").alias("value"))
    sex = F.struct(F.lit(fhir.UK_EXTENSIONS["birth_sex"]).alias("url"), _coded(F.col("c_mktsegment"), F.lit("sex")).alias("valueCodeableConcept"), F.lit(None).cast("boolean").alias("valueBoolean"))
    interp = F.struct(F.lit(fhir.UK_EXTENSIONS["interpreter_required"]).alias("url"), F.lit(None).cast(sex_type(spark)).alias("valueCodeableConcept"), (F.col("c_acctbal") < 0).alias("valueBoolean"))
    name = F.struct(F.col("c_name").alias("family"), F.array(F.col("c_mktsegment"), F.lit("X")).alias("given"))
    body = F.struct(
        F.lit("Patient").alias("resourceType"), _s("c_custkey").alias("id"), F.struct(F.lit("2024-01-01T10:00:00+02:00").alias("lastUpdated")).alias("meta"),
        F.array(local, nhs).alias("identifier"), (F.col("c_acctbal") > 0).alias("active"), F.array(name).alias("name"),
        F.array(sex, interp).alias("extension"), F.struct(F.concat(F.lit("Organization/"), _s("c_nationkey")).alias("reference")).alias("managingOrganization"),
    )
    return table(spark, sf, "customer").select(F.to_json(body).alias("raw_json"))


def sex_type(spark):
    return "struct<coding:array<struct<system:string,code:string>>,text:string>"


@query("fhir_1_extract_patient", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, 'Patient' AS "resourceType", '2024-01-01 08:00:00' AS updated, c_acctbal > 0 AS active, c_name AS family, c_mktsegment AS first_given,
           2 AS identifiers, 0 AS telecoms, 'Organization/' || c_nationkey AS organization FROM customer
""")
def _(spark, sf):
    got = fhir.extract_resources(_patients(spark, sf), "Patient", profile="base_r4")
    return got.select("id", "resourceType", F.col("lastUpdated").cast("string").alias("updated"), "active", F.col("name")[0]["family"].alias("family"),
                      F.col("name")[0]["given"][0].alias("first_given"), F.size("identifier").alias("identifiers"), F.size("telecom").alias("telecoms"),
                      F.col("managingOrganization.reference").alias("organization"))


@query("fhir_2_profile_fallback", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS nhs_number, c_mktsegment AS birth_sex, c_acctbal < 0 AS interpreter_required, true AS no_ethnic_category FROM customer
""")
def _(spark, sf):
    got = fhir.extract_resources(_patients(spark, sf), "Patient", profile="unheard_of")
    return got.select("id", "nhs_number", F.col("birth_sex.coding")[0]["code"].alias("birth_sex"), "interpreter_required", F.col("ethnic_category").isNull().alias("no_ethnic_category"))


def _observations(spark, sf):
    part = F.struct(_coded(F.col("o_orderstatus"), F.lit("part")).alias("code"), F.struct(F.col("o_totalprice").alias("value"), F.lit("USD").alias("unit")).alias("valueQuantity"))
    text = F.struct(_coded(F.lit("prio"), F.lit("note")).alias("code"), F.lit(None).cast("struct<value:double,unit:string>").alias("valueQuantity"), F.col("o_orderpriority").alias("valueString"))
    part = F.struct(part["code"].alias("code"), part["valueQuantity"].alias("valueQuantity"), F.lit(None).cast("string").alias("valueString"))
    body = F.struct(
        F.lit("Observation").alias("resourceType"), _s("o_orderkey").alias("id"), F.lit("final").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("effectiveDateTime"), F.struct(F.concat(F.lit("Patient/"), _s("o_custkey")).alias("reference")).alias("subject"),
        F.array(part, text).alias("component"), F.array(F.struct(F.struct(F.col("o_totalprice").alias("value")).alias("low"))).alias("referenceRange"),
        F.struct(F.col("o_totalprice").alias("value"), F.lit("USD").alias("unit")).alias("valueQuantity"),
    )
    return table(spark, sf, "orders").select(F.to_json(body).alias("raw_json"), "o_orderkey")


@query("fhir_3_datatypes", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS VARCHAR) AS at, 'Patient/' || o_custkey AS subject, o_totalprice AS value, 'USD' AS unit, o_totalprice AS low, 0 AS members FROM orders
""")
def _(spark, sf):
    got = fhir.extract_resources(_observations(spark, sf), "Observation", columns=["effective_datetime", "subject", "value_quantity", "reference_range", "has_member"])
    return got.select("id", F.col("effective_datetime").cast("string").alias("at"), F.col("subject.reference").alias("subject"), F.col("value_quantity.value").alias("value"),
                      F.col("value_quantity.unit").alias("unit"), F.col("reference_range")[0]["low_value"].alias("low"), F.size("has_member").alias("members"))


@query("fhir_4_bundle_entries", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Observation' AS kind FROM orders UNION ALL SELECT 'extra', 'Patient' FROM orders
""")
def _(spark, sf):
    bundle = F.concat(F.lit('{"resourceType":"Bundle","entry":[{"resource":'), F.col("raw_json"), F.lit('},{"search":1},{"resource":{"resourceType":"Patient","id":"extra"}}]}'))
    got = fhir.bundle_entries(_observations(spark, sf).select(bundle.alias("bundle")), "bundle")
    body = got.select(F.try_parse_json("raw_json").alias("v"))
    return body.select(F.try_variant_get("v", "$.id", "string").alias("id"), F.try_variant_get("v", "$.resourceType", "string").alias("kind"))


@query("fhir_5_component_queries", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS code, o_totalprice AS value, o_orderpriority AS note FROM orders
""")
def _(spark, sf):
    got = fhir.extract_resources(_observations(spark, sf), "Observation", columns=["component"])
    rows = got.select("id", F.explode("component").alias("c"), F.element_at("component", 2)["value_string"].alias("note"))
    rows = rows.filter(F.col("c.code.text") == "part")
    return rows.select("id", F.col("c.code.coding")[0]["code"].alias("code"), F.col("c.value_quantity.value").alias("value"), "note")


# --- DICOM, wells --------------------------------------------------------------------------


def _studies(spark, sf):
    key, cust = _s("o_orderkey"), _s("o_custkey")
    body = F.concat(
        F.lit('{"0020000D":{"vr":"UI","Value":["1.2.'), key, F.lit('"]},"00080020":{"vr":"DA","Value":["'), F.date_format("o_orderdate", "yyyyMMdd"),
        F.lit('"]},"00100010":{"vr":"PN","Value":[{"Alphabetic":"","Ideographic":"P^'), cust, F.lit('"}]},"00080061":{"vr":"CS","Value":["CT","'), F.col("o_orderstatus"),
        F.lit('"]},"00201206":{"vr":"IS","Value":['), cust, F.lit(']},"00080050":{"vr":"SH"},"0008103e":{"vr":"LO","Value":["'), F.col("o_orderpriority"), F.lit('"]}}'),
    )
    return table(spark, sf, "orders").select("o_orderkey", body.alias("body"))


@query("dcm_1_dicom_json", """
    SELECT '1.2.' || o_orderkey AS study_instance_uid, strftime(o_orderdate, '%Y%m%d') AS study_date, 'P^' || o_custkey AS patient_name, 'CT,' || o_orderstatus AS modalities,
           o_custkey AS number_of_study_related_series, CAST(NULL AS VARCHAR) AS accession_number, CAST(NULL AS VARCHAR) AS patient_id FROM orders
""")
def _(spark, sf):
    got = dicom.dicom_table(_studies(spark, sf), "body", dicom.STUDY_TAGS)
    return got.select("study_instance_uid", "study_date", "patient_name", F.array_join("modalities_in_study", ",").alias("modalities"),
                      "number_of_study_related_series", "accession_number", "patient_id")


@query("dcm_2_variant_query", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS study_date FROM orders WHERE o_orderpriority = '1-URGENT'")
def _(spark, sf):
    rows = _studies(spark, sf).select("o_orderkey", F.try_parse_json("body").alias("metadata"))
    hits = dicom.where_tag(rows, "metadata", "0008103E", "1-URGENT")
    return hits.select("o_orderkey", dicom.tag_value(F.col("metadata"), "00080020", "Value[0]", "string").alias("study_date"))


@query("dcm_1_series_instances", """
    SELECT '1.2.' || l_orderkey AS study_instance_uid, '1.2.' || l_orderkey || '.' || l_suppkey AS series_instance_uid, '1.2.' || l_orderkey || '.' || l_suppkey || '.' || l_linenumber AS sop_instance_uid,
           l_linenumber AS instance_number FROM lineitem
""")
def _(spark, sf):
    study = F.concat(F.lit("1.2."), _s("l_orderkey"))
    series = F.concat_ws(".", study, _s("l_suppkey"))
    tag = lambda t, vr, v: F.concat(F.lit(f'"{t}":{{"vr":"{vr}","Value":["'), v, F.lit('"]}'))
    body = F.concat(F.lit("{"), F.concat_ws(",", tag("0020000D", "UI", study), tag("0020000E", "UI", series),
                    tag("00080018", "UI", F.concat_ws(".", series, _s("l_linenumber"))), tag("00200013", "IS", _s("l_linenumber"))), F.lit("}"))
    got = dicom.dicom_table(table(spark, sf, "lineitem").select(body.alias("body")), "body", dicom.INSTANCE_TAGS)
    return got.select("study_instance_uid", "series_instance_uid", "sop_instance_uid", "instance_number")


def _wells(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "F", "osdu:wks:master-data--Wellbore:1.0.0").when(F.col("o_orderstatus") == "O", "osdu:wks:master-data--Reservoir:1.0.0").otherwise("osdu:wks:master-data--Sample:2.0.0")
    data = F.struct(
        F.col("o_orderpriority").alias("FacilityName"), F.col("o_orderpriority").alias("ReservoirName"), _s("o_totalprice").alias("DepthTopMD"),
        F.struct(F.struct(_s("o_custkey").alias("RunNumber"), F.col("o_totalprice").alias("TopDepth"), F.struct(F.col("o_custkey").alias("Pressure")).alias("FormationCondition")).alias("SampleAcquisitionDetail")).alias("SampleAcquisition"),
    )
    body = F.to_json(F.struct(
        _s("o_orderkey").alias("id"), kind.alias("kind"), _s("o_custkey").alias("version"), F.lit("2024-01-01").alias("createTime"),
        F.struct(F.array(F.lit("own"), _s("o_custkey")).alias("owners"), F.lit("one").alias("viewers")).alias("acl"), data.alias("data"),
    ))
    return sh.kind_projection(table(spark, sf, "orders").select(body.alias("body")), "body")


@query("prj_13_kind_projection", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS version, '2024-01-01' AS "modifyTime", 'own,' || o_custkey AS owners, 'one' AS viewers,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS "FacilityName", CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS "ReservoirName" FROM orders
""")
def _(spark, sf):
    return _wells(spark, sf).select("id", "version", "modifyTime", F.array_join("acl_owners", ",").alias("owners"), F.array_join("acl_viewers", ",").alias("viewers"), "FacilityName", "ReservoirName")


@query("osdu_1_osdu_flatten", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS "DepthTopMD", CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS VARCHAR) END AS "RunNumber",
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS "TopDepth", CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS DOUBLE) END AS "FormationPressure", o_orderstatus = 'P' AS has_json FROM orders
""")
def _(spark, sf):
    return _wells(spark, sf).select("id", "DepthTopMD", "RunNumber", "TopDepth", "FormationPressure", F.col("SampleAcquisition_json").isNotNull().alias("has_json"))


# --- schemas -------------------------------------------------------------------------------


@query("sch_1_schema_from_descriptors", "SELECT event_id, user_id, event_type AS label, value AS measure FROM events")
def _(spark, sf):
    shape = sm.schema_from_descriptors([
        {"name": "event_id", "type": "integer", "nullable": False}, {"name": "user_id", "type": "long"},
        {"name": "value", "type": "struct", "fields": [{"name": "label", "type": "string"}, {"name": "measure", "type": "double"}]},
    ])
    body = F.to_json(F.struct("event_id", "user_id", F.struct(F.col("event_type").alias("label"), F.col("value").alias("measure")).alias("value")))
    got = coerce(table(spark, sf, "events").select(body.alias("b")), "b", shape)
    return got.select("event_id", "user_id", "value.label", "value.measure")


EDM_OF = {"bigint": "Edm.Int64", "int": "Edm.Int32", "double": "Edm.Double", "string": "Edm.String", "timestamp_ntz": "Edm.DateTime"}


def _edm(spark, sf, names):
    """A metadata document that describes given tables, and its properties."""
    parts = []
    for name in names:
        fields = table(spark, sf, name).schema.fields
        props = "".join(f'<Property Name="{f.name}" Type="{EDM_OF.get(f.dataType.simpleString(), "Edm.Other")}" Nullable="{str(i > 0).lower()}"/>' for i, f in enumerate(fields))
        extra = '<Property Name="lastModifiedDate" Type="Edm.DateTime"/><Property Name="lastModifiedOn"/>' if name == "orders" else ""
        parts.append(f'<EntityType Name="{name}"><Key><PropertyRef Name="{fields[0].name}"/></Key>{props}{extra}</EntityType>')
    text = f'<edmx><Schema>{"".join(parts)}</Schema></edmx>'
    path = fresh_path(spark, "edm")
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(path)
    return sm.edm_properties(spark, path)


@query("sch_2_schema_from_edm", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(spark, sf):
    shape = sm.schema_from_edm(_edm(spark, sf, ["customer"]), "customer")
    body = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in shape.fieldNames()]))
    return coerce(table(spark, sf, "customer").select(body.alias("b")), "b", shape)


@query("sch_3_schema_from_ontology", """
    SELECT s_suppkey, CAST(s_acctbal AS VARCHAR) AS balance, s_nationkey AS latitude, s_name AS first_tag FROM supplier
""")
def _(spark, sf):
    shape = sm.schema_from_ontology({"apiName": "supplier", "primaryKey": "s_suppkey", "properties": {
        "s_suppkey": {"dataType": {"type": "long"}}, "balance": {"dataType": {"type": "decimal", "precision": 50, "scale": 2}},
        "place": {"dataType": {"type": "geopoint"}}, "tags": {"dataType": {"type": "array", "itemType": {"type": "string"}}},
    }})
    place = F.struct(F.col("s_nationkey").alias("latitude"), F.lit(0).alias("longitude"))
    body = F.to_json(F.struct("s_suppkey", F.col("s_acctbal").alias("balance"), place.alias("place"), F.col("s_name").alias("tags")))
    got = coerce(table(spark, sf, "supplier").select(body.alias("b")), "b", shape)
    return got.select("s_suppkey", F.col("balance").cast("double").cast("string").alias("balance"), F.col("place.latitude").cast("int").alias("latitude"), F.col("tags")[0].alias("first_tag"))


#: Properties that stand for an order priority in the metadata of a customer.
PROPERTY_OF = {"1-URGENT": "lastModifiedOn", "2-HIGH": "lastModifiedDateTime", "3-MEDIUM": "lastModifiedDate"}


@query("sch_4_infer_contract", """
    WITH e AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n, bool_or(o_orderpriority = '1-URGENT') AS u, bool_or(o_orderpriority = '2-HIGH') AS h,
               bool_or(o_orderpriority = '3-MEDIUM') AS m FROM orders GROUP BY o_custkey)
    SELECT 'c' || o_custkey AS entity, 'k' || o_custkey AS key, CASE WHEN h THEN 'lastModifiedDateTime' WHEN m THEN 'lastModifiedDate' WHEN u THEN 'lastModifiedOn' END AS cursor_field,
           CASE WHEN h OR m OR u THEN 'cdc' ELSE 'snapshot' END AS ingestion_type, n FROM e
""")
def _(spark, sf):
    """Each customer is an entity type, with a property for every priority its orders have."""
    kinds = table(spark, sf, "orders").select("o_custkey", "o_orderpriority").distinct()
    name = F.coalesce(*[F.when(F.col("o_orderpriority") == p, F.lit(n)) for p, n in PROPERTY_OF.items()], F.col("o_orderpriority"))
    key = F.col("o_custkey").cast("string")
    found = kinds.select(F.concat(F.lit("c"), key).alias("entity"), F.array(F.concat(F.lit("k"), key)).alias("keys"), name.alias("name"))
    counts = found.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    return sm.infer_contracts(found).join(counts, "entity").select("entity", F.col("primary_keys")[0].alias("key"), "cursor_field", "ingestion_type", "n")


@query("sch_5_schema_from_properties", "SELECT CAST(c_custkey AS VARCHAR) AS id, false AS archived, CAST(c_nationkey AS VARCHAR) AS company, c_name AS name, c_custkey AS size FROM customer")
def _(spark, sf):
    shape = sm.schema_from_properties([{"name": "name", "type": "string"}, {"name": "size", "type": "number"}, {"name": "vip", "type": "bool"}], ["companies"])
    body = F.to_json(F.struct(_s("c_custkey").alias("id"), F.lit(False).alias("archived"), F.array(_s("c_nationkey")).alias("companies"),
                              F.struct(F.col("c_name").alias("name"), _s("c_custkey").alias("size")).alias("properties")))
    got = coerce(table(spark, sf, "customer").select(body.alias("b")), "b", shape)
    return got.select("id", "archived", F.col("companies")[0].alias("company"), "properties.name", "properties.size")
