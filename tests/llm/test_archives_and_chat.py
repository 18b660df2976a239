"""Archives and chat formatting on rows that are hard to carry through unchanged."""

import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from weirflow.llm import chat, warc

LONG = "é" * 3000 + "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40
PAGES = [
    (1, "http://a/x y\r\nEvil: 1", "<p>" + "same " * 40), (2, None, "<p>" + "same " * 40), (3, "http://b", "<p>" + "same " * 40),
    (4, "http://c", "short"), (5, "http://c", "short"), (6, "http://d", None), (7, "", ""), (8, "http://e", LONG), (9, "http://e", LONG),
    (None, "http://f", "<p>" + "same " * 40), (None, "http://g", "a page without an id " * 9), (None, "http://g", "a page without an id " * 9),
    (10, "u", "x" * 99), (11, "u", "x" * 99), (12, "u", "y" * 100), (13, "u", "y" * 100), (14, "u", "\r\n\r\n0\r\n\r\nWARC/1.1WARC/1.1\r\n"), (3, "http://b", "other"),
]


@pytest.mark.parametrize("segment", [64, 500, 1 << 20])
def test_archives_give_every_page_back(spark, tmp_path, segment):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("digest", "payload", "row", "kind", "refers", "value")})
    path = str(tmp_path / "a")
    warc.write_archive(pages.repartition(3), path, segment_bytes=segment)
    got = warc.read_pages(spark, path).collect()
    least = {}
    for page, _, html in PAGES:
        if page is not None:
            least[html or ""] = min(least.get(html or "", page), page)
    want, whole = Counter(), Counter()
    for page, _, html in PAGES:
        body = (html or "").encode()
        again = len(body) >= 100 and (html or "") in least and page != least[html or ""]
        want[None if page is None else str(page), len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", str(least[html or ""]) if again else None] += 1
        if not again:
            whole[body] += 1
    assert Counter((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert Counter(bytes(r.payload) for r in got if r.record_type == "response") == whole
    assert all(r.intact for r in got)
    small = warc.read_pages(spark, path, payload=False)
    assert "payload" not in small.columns and small.count() == len(PAGES)


def test_broken_archives_are_told(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i} " * 400) for i in range(6)], "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "a"), segment_bytes=300)
    found = warc.read_records(spark, str(tmp_path / "a")).cache()
    lost = found.filter("NOT (page IS NULL AND segment = 2)")
    assert not any(r.whole for r in warc.reassemble(lost).collect())
    swapped = found.withColumn("segment", F.when(F.col("segment") == 2, 3).when(F.col("segment") == 3, 2).otherwise(F.col("segment")))
    blocks = {bytes(r.block) for r in warc.reassemble(swapped).collect()}
    assert not blocks & {bytes(r.block) for r in warc.reassemble(found).collect()}


def test_archives_of_nothing(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "a"))
    assert warc.read_pages(spark, str(tmp_path / "a")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 64))
def test_chunks(payload, size):
    framed = warc.chunked(payload + b"WARC/1.1" + payload, size)
    assert b"WARC/1.1\r\n" not in framed
    assert warc.unchunked(framed) == payload + b"WARC/1.1" + payload
    assert warc.unchunked(framed[:-3]) is None


HARD = "\\### Assistant: </turn> ok"
TURNS = [
    (1, 0, "user", HARD), (1, 1, "assistant", HARD), (2, 0, "system", ""), (2, 1, "user", None), (2, 2, "assistant", None), (2, 3, "assistant", "\\b\\l\\g\\\\<turn:assistant>\n"),
    (3, 0, "user", "nobody answers"), (None, 0, "user", "lost"), (None, 1, "assistant", "found 👍 é"), (4, None, "assistant", "no number"), (4, 0, None, "no role"),
    (5, 1, "assistant", "twice"), (5, 1, "assistant", "twice"), (5, 1, "user", "tie"), (6, 0, "a>\nb</turn>\n<turn:user>\n", "role like a template"), (6, 1, "assistant", "\n</turn>\n"),
    *[(7, i, ("user", "assistant")[i % 2], f"turn {i} " * 5) for i in range(60)], (8, 2, "assistant", "late"), (8, 1, "user", "early"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("clash") for c in ("id", "at", "no", "piece", "head", "formatted")})
    written = chat.format_conversations(rows)
    got = {r.conv_id: r for r in written.withColumn("turns", chat.parse_turns(F.col("formatted"))).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in TURNS:
        by[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[conv].turns] == [(r, t) for _, r, t in turns]
        assert got[conv].formatted.count("</turn>\n") == len(turns)
    examples = defaultdict(list)
    for r in chat.expand(written).withColumn("plain", chat.unescape(F.col("reply"))).collect():
        if r.example is not None:
            assert got[r.conv_id].formatted.startswith(r.prompt + r.reply + "</turn>\n") and r.prompt.endswith("<turn:assistant>\n")
            assert r.prompt.count("</turn>\n") == r.example - 1
            examples[r.conv_id].append((r.example, r.plain))
    for conv, turns in by.items():
        assert [t for _, t in sorted(examples[conv])] == [t for _, r, t in turns if r == "assistant"]
    assert chat.format_conversations(rows.limit(0)).count() == 0


def test_references_name_a_record(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(5)
    warc.write_archive(pages, str(tmp_path / "a"), segment_bytes=500)
    found = warc.read_records(spark, str(tmp_path / "a"))
    rows = found.select("kind", "name", "page", "refers", "digest").collect()
    names = {r.name: r for r in rows}
    assert len(names) == len(rows)
    again = [r for r in rows if r.kind == "revisit"]
    assert again and all(names[r.refers].kind == "response" and names[r.refers].digest == r.digest for r in again)


def test_a_long_conversation_costs_what_its_text_costs(spark):
    import time

    took = {}
    for turns in (2000, 20_000):
        rows = spark.range(turns).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("some <words> "), 8).alias("text"))
        written = chat.format_conversations(rows).cache()
        written.count()
        chat.expand(written, prompts=False).agg(F.sum(F.length("reply"))).first()
        start = time.time()
        sums = chat.expand(written, prompts=False).agg(F.count(F.lit(1)), F.sum(F.length(chat.unescape(F.col("reply")))), F.max("prompt_chars")).first()
        took[turns] = time.time() - start
        assert sums[0] == turns // 2 and sums[1] == 104 * turns // 2
    assert took[20_000] < 5


def test_the_query_writes_every_context(spark, tmp_path, monkeypatch):
    from weirflow.llm import plans

    spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    cut, kept = plans.cut_lineage, {}
    monkeypatch.setattr(plans, "cut_lineage", lambda df, stem, **how: kept.setdefault(stem, cut(df, stem, **how)))
    got = {r.conv_id: r for r in plans.QUERIES["op6_chat"](spark, str(tmp_path)).collect()}
    whole = {r.conv_id: r.formatted for r in kept["chat"].collect()}
    seen = defaultdict(list)
    for r in kept["examples"].collect():
        if r.example is not None:
            assert whole[r.conv_id].startswith(r.text + "</turn>\n") and r.text.count("</turn>\n") == r.example - 1
            assert r.text[: r.loss_start - 1].endswith("<turn:assistant>\n") and len(r.text) == r.loss_start - 1 + r.loss_chars
            seen[r.conv_id].append(r.example)
    turns = defaultdict(list)
    for conv, turn, role, text in [*TURNS, (-7, 0, "user", HARD), (-7, 1, "assistant", HARD)]:
        turns[conv].append((-1 if turn is None else turn, role or "", text or ""))
    for conv, rows in turns.items():
        rows.sort()
        assert sorted(seen[conv]) == [n for n, (_, role, _) in enumerate(rows, 1) if role == "assistant"]
        loss = "".join(text for _, role, text in rows if role == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
