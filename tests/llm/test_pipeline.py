"""The pipeline, stage by stage, against what each stage has to do on what its predecessor kept."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_llm_contracts import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from weirflow.llm import decontaminate, quality_rules, secrets

SF = "/root/testdata/sf0.001"


def test_stages(spark, documents, tmp_path):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    docs, kept = documents.select(columns), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        kept[name] = (docs.collect(), spark.read.parquet(str(tmp_path / str(i))))
        docs = kept[name][1]
    for name in list(kept)[:-1]:
        assert kept[name][1].columns == columns
    before, after = kept["quality rules"]
    judged = quality_rules.judge(documents.select(columns)).filter("kept").select("doc.*")
    assert Counter(map(tuple, after.collect())) == Counter(map(tuple, judged.collect()))

    before, after = kept["near duplicates"]
    prints = {plain_fingerprint(r.text) for r in before}
    tops, groups = plain_components(prints), defaultdict(list)
    for r in before:
        groups[tops[plain_fingerprint(r.text)]].append(r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(min(g) for g in groups.values())

    before, after = kept["decontamination"]
    found = {r.doc_id for r in decontaminate.contaminated(kept["near duplicates"][1], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert found and sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in before if r.doc_id not in found)

    before, after = kept["secret scan"]
    assert {r.doc_id: (r.text, r.n_chars) for r in after.collect()} == {r.doc_id: (secrets.redact(r.text), len(secrets.redact(r.text))) for r in before}

    before, after = kept["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids + [2] for r in before}
    pieces = defaultdict(int)
    import zlib

    for r in after.collect():
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        pieces[r.doc_id] += r.length
    assert pieces == {d: len(i) for d, i in ids.items()}


def test_run_equals_the_stages_and_takes_nothing(spark, tmp_path):
    got = corpus_pipeline.run(spark, SF).agg(F.sum("length"), F.count_distinct("doc_id")).first()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    assert docs.agg(F.sum("length"), F.count_distinct("doc_id")).first() == got
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
        assert none.count() == 0
