"""Message and resource formats on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from weirflow.operators import dicom, fhir, hl7, quality as dq
from weirflow.operators.explode import nested_tree, tree_walk
from weirflow.operators.shaping import strip_meta

ADT = "\r".join([
    "MSH|^~\\&|HIS|GENERAL|LAB|LAB|20240115120000||ADT^A01^ADT_A01|M1|P|2.5.1",
    "EVN||20240115120000|||OP1^Smith^Jane~OP2^Brown",
    "PID|1||MRN1^^^HOSP&1.2&ISO^MR~X2^^^ALT||Doe^John^M||19700315|M^Male|||1 Main St^^Boston^MA^02101^US||(617)555-1234",
    "PV1|1|I|MED^101^A^HOSP&9||||DOC1^Smith^Robert^^^Dr",
    "NTE|1||line \\T\\ one~line two",
    "OBX|1|NM|789-8^RBC \\T\\ more^LN||4.9|10*6/uL^^UCUM||N~H",
    "OBX||ST|X||a^b",
    "TXA|1|DS",
])


def parsed(spark, text):
    return hl7.parse_messages(hl7.split_batch(spark.createDataFrame([("f", text)], "source_file string, data string")))


@pytest.mark.parametrize("end", ["\r", "\n", "\r\n"])
def test_line_ends_and_batches(spark, end):
    one = ADT.replace("\r", end)
    batch = end.join(["FHS|^~\\&|", "BHS|^~\\&|", one, one.replace("|M1|", "|M2|"), "BTS|2", "FTS|1", ""])
    got = parsed(spark, batch)
    assert sorted(r["message_id"] for r in got.collect()) == ["M1", "M2"]
    assert hl7.segment_table(got, "obx").count() == 4


def test_no_header_no_rows(spark):
    assert parsed(spark, "PID|1||x").count() == 0 and parsed(spark, "").count() == 0 and parsed(spark, "MSH").count() == 0


def test_segments(spark):
    msgs = parsed(spark, ADT)
    pid = hl7.segment_table(msgs, "pid").head()
    assert pid["set_id"] == 1 and pid["patient_id"][0]["assigning_authority_universal_id"] == "1.2" and pid["patient_id"][1]["assigning_authority"] == "ALT"
    assert pid["patient_names"][0]["given_name"] == "John" and pid["administrative_sex"]["text"] == "Male" and pid["race"] is None and pid["religion"] is None
    obx = hl7.segment_table(msgs, "obx").orderBy("raw_segment").collect()
    second, first = sorted(obx, key=lambda r: r["value_type"], reverse=True)
    assert first["observation_id"]["text"] == "RBC & more" and first["units"]["coding_system"] == "UCUM" and [c["code"] for c in first["interpretation_codes"]] == ["N", "H"]
    assert second["set_id"] == 1 and second["observation_value"] == ["a^b"]
    assert hl7.segment_table(msgs, "nte").head()["comment"] == ["line \\T\\ one", "line two"]
    pv1 = hl7.segment_table(msgs, "pv1").head()
    assert pv1["assigned_patient_location"]["facility"] == "HOSP" and pv1["attending_doctor"][0]["prefix"] == "Dr"
    assert [o["id"] for o in hl7.segment_table(msgs, "evn").head()["operator"]] == ["OP1", "OP2"]
    msh = hl7.segment_table(msgs, "msh").head()
    assert (msh["field_separator"], msh["encoding_characters"], msh["message_structure"]) == ("|", "^~\\&", "ADT_A01")


def test_every_segment_kind_has_its_columns(spark):
    lines = ["MSH|^~\\&|a|b|c|d|2024||X|M9|P|2.5"]
    lines += [f"{k.upper()}|" + "|".join(f"{i}^t{i}" for i in range(1, 60)) for k in hl7.SEGMENTS if k != "msh"]
    msgs = parsed(spark, "\r".join(lines))
    for kind in ("al1", "mrg", "nte", "txa"):
        row = hl7.segment_table(msgs, kind).head()
        assert row["message_id"] == "M9" and row["raw_segment"].startswith(kind.upper())
    for kind, layout in hl7.SEGMENTS.items():
        names = hl7.segment_table(msgs, kind).columns
        assert len(names) == len(set(names)) and names[:3] == ["source_file", "message_id", "message_timestamp"] or set(hl7.META) <= set(names)
        assert len(layout.split()) <= len(names)


def test_fhir_types_and_fallback(spark):
    body = {"resourceType": "MedicationRequest", "id": "m", "meta": {"lastUpdated": "2024-01-01T00:00:00Z"}, "status": "active",
            "dosageInstruction": [{"text": "one", "timing": {"code": {"coding": [{"code": "BID"}]}}, "doseAndRate": [{"doseQuantity": {"value": 2, "unit": "mg"}}], "route": {"text": "oral"}}],
            "dispenseRequest": {"quantity": {"value": 30}, "numberOfRepeatsAllowed": 3}, "substitution": {"allowedBoolean": True}, "subject": {}}
    df = spark.createDataFrame([(json.dumps(body),), ('{"resourceType": "Patient", "id": "p"}',)], "raw_json string")
    row = fhir.extract_resources(df, "MedicationRequest").head()
    dose = row["dosage_instruction"][0]
    assert (dose["timing_code"], dose["dose_value"], dose["route"]["text"], dose["route"]["coding"]) == ("BID", 2.0, "oral", [])
    assert row["dispense_request"]["quantity_value"] == 30 and row["substitution_allowed_boolean"] and row["subject"] is None and row["identifier"] == []
    assert fhir.extract_resources(df, "MedicationRequest").count() == 1
    assert fhir.extract_resources(df, "Unknown").columns == ["id", "resourceType", "lastUpdated", "raw_json", "extension"]
    assert fhir.profile_chain("x") == ["x", "uk_core", "base_r4"] and fhir.profile_chain("base_r4") == ["base_r4"]
    for name in fhir.RESOURCES:
        assert len(fhir.extract_resources(df, name, profile="base_r4").columns) == 5 + len(fhir.RESOURCES[name].split())


def test_dicom(spark):
    body = {"00100010": {"vr": "PN", "Value": [{"Phonetic": "pho"}]}, "00201206": {"vr": "IS", "Value": ["3"]}, "00080050": {"vr": "SH", "Value": []}, "00080061": {"vr": "CS", "Value": ["CT", "SR"]}}
    row = dicom.dicom_table(spark.createDataFrame([(json.dumps(body),)], "b string"), "b", dicom.STUDY_TAGS).head()
    assert (row["patient_name"], row["number_of_study_related_series"], row["accession_number"], row["modalities_in_study"]) == ("pho", 3, None, ["CT", "SR"])


def test_trees(spark):
    df = spark.createDataFrame([("a", ""), ("b", "a"), ("c", "b"), (None, "a"), ("lost", "zzz")], "id string, up string")
    assert {(r["id"], r["depth"], r["path"]) for r in tree_walk(df, "id", "up").collect()} == {("a", 0, "a"), ("b", 1, "a/b"), ("c", 2, "a/b/c")}
    nested = spark.createDataFrame([('{"id":"x","children":[{"id":"y"},{"children":[{"id":"z"}]}]}',)], "j string").select(F.try_parse_json("j").alias("n"))
    assert {(r["element"], r["parent"], r["depth"]) for r in nested_tree(spark, nested, "n").collect()} == {("x", "", 0), ("y", "x", 1)}


def test_tree_of_5000_levels_in_few_rounds(spark, monkeypatch):
    from weirflow.operators import explode

    rounds, cut = [], explode.cut_lineage
    monkeypatch.setattr(explode, "cut_lineage", lambda df, stem: (rounds.append(stem), cut(df, stem))[1])
    chain = [(i, None if i == 0 else i - 1) for i in range(5000)]
    # Two rows point at each other, one hangs below them, one below nothing, one is its own parent.
    lost = [(9001, 9002), (9002, 9001), (9003, 9002), (9004, 9999), (9005, 9005), (None, 3)]
    got = {r["id"]: (r["depth"], len(r["path"].split("/"))) for r in tree_walk(spark.createDataFrame(chain + lost, "id long, up long"), "id", "up").collect()}
    assert got == {i: (i, i + 1) for i in range(5000)} and len(rounds) < 20


def test_overlap_pairs_by_hierarchy(spark):
    import random
    from datetime import datetime, timedelta

    from weirflow.operators.joins import _nodes, overlap_pairs

    rng = random.Random(2)
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    some = lambda n, long: [(i, a, a + rng.choice([0, 1, 5, 200, long])) for i in range(n) for a in [rng.randrange(8000)]]
    frames, spans = some(120, 9000), some(80, 700)
    open_ = [(i, a, None if i % 9 == 0 else b) for i, a, b in frames] + [(500, -50, None), (501, 5, 4)]
    f = spark.createDataFrame([(i, at(a), None if b is None else at(b)) for i, a, b in open_], "f int, s timestamp_ntz, e timestamp_ntz")
    g = spark.createDataFrame([(i, at(a), at(b)) for i, a, b in spans], "g int, a timestamp_ntz, b timestamp_ntz")
    got = sorted((r["f"], r["g"]) for r in overlap_pairs(f, g, ("s", "e"), ("a", "b"), 3600).select("f", "g").collect())
    assert got == sorted((i, j) for i, a, b in open_ for j, c, d in spans if a <= d and (b is None or (b >= c and b >= a)))
    year = spark.range(1).select(_nodes(F.lit(3), F.lit(8763), 14).alias("n")).first()["n"]
    assert len(year) < 28
    assert sorted(k for x in year for k in range(x["node"] << x["level"], (x["node"] + 1) << x["level"])) == list(range(3, 8764))
    assert overlap_pairs(f, g.limit(0), ("s", "e"), ("a", "b"), 3600).count() == 0


def test_field_paths_of_any_depth(spark):
    from weirflow.operators.quality import field_paths

    deep = '{"a":' * 300 + "1" + "}" * 300
    rows = ['{"x":{"y":[{"z":1},[{"lost":1}],{"w":null}]},"x y":2}', "[{\"top\":{}}]", "no json", None, "7", '{"n":NaN}', deep]
    got = {r["path"] for r in field_paths(spark.createDataFrame([(r,) for r in rows], "j string"), "j").collect()}
    assert got == {"x", "x.y", "x.y.z", "x.y.w", "x y", "top"} | {".".join("a" * d) for d in range(1, 301)}


def test_marked_objects_to_any_depth(spark):
    deep, want = '{"n":1.50}', '{"n":1.50}'
    for level in range(300):
        deep = '{"__metadata":{"uri":"u"},"__x":1,"gone":{"__deferred":{}},"in":' + deep + "}"
        want = '{"in":' + want + "}"
    wide = '{"a":[{"__metadata":1,"b":12345678901234567890}],"t":"say \\"__x\\" \u00e9","\\u005f_y":1,"z":null,"f":1e3,"plain":{"__n":1}}'
    texts = [deep, wide, '{"a":1}', '{"__a":1}', "{}", "[1]", "no", '{"__a":1,"__a":2}', '{"a":NaN,"__b":1}', "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, r string").coalesce(1)
    kept = spark.createDataFrame([(want,)], "r string").select(F.try_parse_json("r").cast("string").alias("r")).first()["r"]
    got = {x["i"]: x["r"] for x in strip_meta(rows, "r").collect()}
    assert got[0] == {"in": kept[len('{"in":') : -1]}
    assert got[1] == {
        "a": '[{"__metadata":1,"b":12345678901234567890}]', "t": 'say "__x" \u00e9', "z": None, "f": got[1]["f"], "plain": '{"__n":1}',
    } and float(got[1]["f"]) == 1000
    assert [got[i] for i in range(2, 11)] == [{"a": "1"}, {}, {}, None, None, None, None, None, None]


def test_cleaning_metadata_runs_no_job_before_the_query(spark):
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    strip_meta(spark.createDataFrame([('{"__a":1}',)], "r string"), "r")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == before
