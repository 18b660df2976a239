"""The queries of these operators and, where SQL can say it, the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from weirflow.llm import chat, collocations, decontaminate, language, lm, merkle, packing, quality_rules, repair, repeats, secrets, simhash, warc
from weirflow.llm.common import remainder
from weirflow.session import cut_lineage, fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    own = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc.doc_id", *[F.col(f"m.{c}") for c in own], "base_failed", "kept", "posterior")


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    pages = _table(spark, sf_dir, "pages")
    warc.write_archive(pages, path)
    back = warc.read_pages(spark, path, payload=False)
    kind = pages.schema["page_id"].dataType
    return back.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "intact")


ORACLES["op4_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     l AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS least FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN strlen(html) >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 100 AND page_id <> least THEN least END AS refers_to, true AS intact
FROM l
"""


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens")


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    told = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda kind: F.filter("spans", lambda x: x["kind"] == kind)
    base = F.filter("spans", lambda x: x["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"),
    )


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


HARD_TURN = "\\### Assistant: </turn> ok"


@query
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, F.lit(HARD_TURN).alias("text"))
    written = cut_lineage(chat.format_conversations(turns.unionByName(extra)), "chat")
    parsed = written.withColumn("turns", chat.parse_turns(F.col("formatted"))).select(
        "conv_id", "formatted", "examples", F.size("turns").cast("long").alias("n_turns"), F.length("formatted").cast("long").alias("formatted_chars"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
    )
    # Every example is written with its whole context; the mask alone says which part of the text read back counts.
    # Contexts of a conversation repeat one another and lie together, which zstd takes out.
    examples = cut_lineage(chat.expand(parsed).select(
        "conv_id", "n_turns", "turns_sha256", "formatted_chars", "example", F.concat("prompt", "reply").alias("text"),
        (F.length("prompt") + 1).alias("loss_start"), F.length("reply").alias("loss_chars"),
    ), "examples", compression="zstd")
    told = examples.withColumn("reply", chat.unescape(F.substr("text", F.col("loss_start"), F.col("loss_chars"))))
    replies = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "reply"))), lambda e: e["reply"]), "")
    loss = told.groupBy("conv_id").agg(*[F.first(c).alias(c) for c in ("n_turns", "turns_sha256", "formatted_chars")], replies.alias("loss"))
    return loss.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


ORACLES["op6_chat"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(role) + length(regexp_replace(role, '[^<>\\]', '', 'g')) + length(text) + length(regexp_replace(text, '[^<>\\]', '', 'g')) + 16 AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "ids")
    repair.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return repair.read(spark, path).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", remainder(F.col("doc_id"), 5) == 0)
    model = language.fit(docs.filter("NOT held_out"))
    found = docs.select("doc_id", "held_out", language.identify(docs, model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


@query
def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(lm.split(_table(spark, sf_dir, "documents").select("doc_id", "text")))


CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = [F.translate("text", CAPITALS, SMALL) if f == "text" else F.col(f) for f in merkle.FIELDS]
    found = F.when(remainder(F.col("doc_id"), 3) == 0, merkle.leaf(*tampered))
    proofs = merkle.manifest(_table(spark, sf_dir, "documents"), carry={"found": found}).proofs()
    folded = merkle.fold(F.coalesce("found", "digest"), F.col("path")).alias("folded_root")
    out = proofs.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "crown.subroot", "crown.root", merkle.proof(F.col("path")).alias("proof_sha256"), folded)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _merkle_sql(deep: int = 8, high: int = 4) -> str:
    """Trees of up to 8 ** deep leaves a language and 8 ** high languages, a level at a time."""
    step = "list_reduce(list_prepend(xor(acc, b), range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    byte_list = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    crc = f"CASE WHEN doc_id IS NULL THEN 0 ELSE xor(list_reduce(list_prepend(4294967295, {byte_list}), lambda acc, b: {step}), 4294967295) END"
    part = lambda v: f"coalesce(CAST(strlen(CAST({v} AS VARCHAR)) AS VARCHAR) || ':' || CAST({v} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(text if f == "text" else f) for f in merkle.FIELDS) + ")"
    translated = f"translate(text, '{CAPITALS}', '{SMALL}')"
    parts = [
        f"d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(translated)} ELSE {leaf('text')} END AS found FROM documents)",
        "a0 AS (SELECT g, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n, doc_id, leaf, found FROM d)",
    ]

    def tree(t: str, levels: int) -> None:
        for k in range(levels):
            run = "OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN"
            parts.append(f"{t}s{k} AS (SELECT g, i, n, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {t}{k})")
            parts.append(f"{t}{k + 1} AS (SELECT g, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h, i // 8 AS i, (max(n) + 7) // 8 AS n FROM {t}{k} GROUP BY g, i // 8)")

    tree("a", deep)
    parts.append(f"b0 AS (SELECT '' AS g, g AS lang, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM a{deep})")
    tree("b", high)
    parts.append(f"f0 AS (SELECT a0.doc_id, a0.leaf, a0.g, a0.i, b0.i AS j, b0.h AS subroot, b{high}.h AS root, a0.found AS x, '' AS p FROM a0 JOIN b0 ON a0.g = b0.lang CROSS JOIN b{high})")
    at = 0
    for t, key, levels, group in (("a", "i", deep, "f.g = s.g"), ("b", "j", high, "s.g = ''")):
        for k in range(levels):
            parts.append(f"f{at + 1} AS (SELECT f.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.l || f.x || s.r) ELSE f.x END AS x, f.p || s.l || s.r AS p) FROM f{at} f JOIN {t}s{k} s ON {group} AND f.{key} // {8 ** k} = s.i)")
            at += 1
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, x AS folded_root, x = root AS verified FROM f{at}"


ORACLES["op11_merkle"] = _merkle_sql()


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


ORACLES["op13_collocations"] = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i : i + m - 1])) AS words FROM w CROSS JOIN (VALUES (1), (2), (3), (4)) s(m)),
f AS (SELECT lang, words, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(words) = 1 GROUP BY lang),
c AS (SELECT lang, words, f AS a FROM f WHERE len(words) > 1 AND f >= 30),
k AS (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM c),
cut AS (SELECT k.lang, k.words, k.a, k.k, h.f AS l, t.f AS r, CAST(CAST(2000000 AS HUGEINT) * k.a // (h.f + t.f) AS BIGINT) AS score
        FROM k JOIN f h ON h.lang = k.lang AND h.words = k.words[1 : k.k] JOIN f t ON t.lang = k.lang AND t.words = k.words[k.k + 1 :]),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inside AS (SELECT lang, words[i : i + j - 1] AS words, max(a) AS most FROM c CROSS JOIN (VALUES (1), (2), (3)) x(i) CROSS JOIN (VALUES (2), (3)) y(j)
           WHERE j < len(c.words) AND i + j - 1 <= len(c.words) GROUP BY ALL),
free AS (SELECT low.lang, array_to_string(low.words, ' ') AS phrase, a, l, r, score FROM low LEFT JOIN inside USING (lang, words) WHERE most IS NULL OR 100 * most < 80 * a)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM free JOIN n USING (lang)) WHERE rank <= 2000
"""


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = repeats.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    return told.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
