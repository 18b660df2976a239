"""Benchmark decontamination by spaced seeds, in DataFrame functions alone.

A document overlaps an item if of some ``window`` consecutive words of the item (all of it, if it is shorter)
``similarity`` are equal in place. Of n words that leaves room for m others. A mask of ones m + 1 places apart, n // (m + 1)
of them, reads the words under its ones and ignores those between; laid over n words from each of their first m + 1
places it reads all of them in m + 1 classes, of which m replaced words leave one untouched. So every overlap has a seed:
a place where the hash of what the mask reads is the same in both. Items of fewer than five words are read whole.

Hashes of all documents are joined with those of the benchmark, which is broadcast in blocks of at most ``BLOCK_SEEDS``
hashes, one pass over the documents for each. A hit lays the item along the document; hits are made distinct, and the
words of documents with hits, cut into parts of ``PART_WORDS`` and the length of an item, meet the hits of that part once.
Documents without hits are left out before by a table of bits of their keys, ``2 ** KEY_BITS`` of them at most.

Words are runs of letters and digits in lower case. Null and empty texts and items without words match nothing. Repeated
rows are one result, however often an item stands in a text. Rows with a null id are found like any other. Empty tables
give an empty result or all documents; other columns play no part.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.llm.common import fresh
from weirflow.session import cut_lineage

WINDOW, SIMILARITY = 20, 0.8
BLOCK_SEEDS = 1_000_000
PART_WORDS = 4096
KEY_BITS = 26


def terms(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    return F.transform(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def mask_for(words: int, similarity: float = SIMILARITY) -> str:
    """The mask that finds ``words`` consecutive words of which ``similarity`` are equal."""
    apart = words - ceil(round(words * similarity, 9)) + 1
    return ("1" + "0" * (apart - 1)) * (words // apart - 1) + "1"


def seeds(w: Column, mask: str) -> Column:
    """(at, seed) for every place of ``mask`` over the words."""
    ones = [i for i, c in enumerate(mask) if c == "1"]
    read = lambda at: F.struct(at.alias("at"), F.xxhash64(F.lit(mask), *[F.get(w, at + i) for i in ones]).alias("seed"))
    none = F.expr("CAST(array() AS array<struct<at: int, seed: bigint>>)")
    return F.when(F.size(w) >= len(mask), F.transform(F.sequence(F.lit(0), F.size(w) - len(mask)), read)).otherwise(none)


def _with_hits(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows of ``docs`` (column key) that may have a row in ``hits``, found without moving any."""
    entries = hits.select("key").distinct().count()
    bits = min(max((64 * entries).bit_length(), 18), KEY_BITS)
    place = F.xxhash64("key").bitwiseAND((1 << bits) - 1) + 1  # the functions count from 1
    table = hits.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.expr("CAST(at div 8 + 1 AS int)"), F.lit(1))), 16, 10).cast("int")
    # At most 2 ** (KEY_BITS - 15) rows of 4 KB.
    joined = docs.withColumn("bucket", F.bitmap_bucket_number(place)).withColumn("at", at).join(F.broadcast(table), "bucket")
    return joined.filter(F.getbit(byte, F.expr("CAST(at % 8 AS int)")) == 1).select(*docs.columns)


def overlaps(docs: DataFrame, benchmark: DataFrame, key: list[Column], item_id: str = "item_id", text: str = "text", window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """(key, item, matched, window, start) for each document and item that overlap: the best window, and where the item lies."""
    items = benchmark.select(F.col(f"`{item_id}`").alias("item"), terms(F.col(f"`{text}`")).alias("w")).filter(F.size("w") > 0).distinct()
    items = cut_lineage(items.withColumn("no", F.xxhash64("item", "w")), "items")
    # One row per length up to the window, and the longest item.
    sizes = items.groupBy(F.least(F.size("w"), F.lit(window)).alias("n")).agg(F.max(F.size("w")).alias("longest")).collect()
    by_mask: dict[str, list[int]] = {}
    for r in sizes:
        by_mask.setdefault(mask_for(r["n"], similarity), []).append(r["n"])
    none = "key struct<" + ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in docs.select(*key).schema.fields) + f">, item {items.schema['item'].dataType.simpleString()}, matched long, window long, start long"
    if not by_mask:
        return docs.sparkSession.createDataFrame([], none)
    parts = [items.filter(F.least(F.size("w"), F.lit(window)).isin(of)).select("no", F.inline(seeds(F.col("w"), m))).select("no", F.col("at").alias("item_at"), "seed") for m, of in by_mask.items()]
    index = parts[0]
    for p in parts[1:]:
        index = index.unionByName(p)
    index = cut_lineage(index, "seeds")
    blocks = max(1, -(-index.count() // BLOCK_SEEDS))
    named = docs.select(F.struct(*key).alias("key"), terms(F.col(f"`{text}`")).alias("w"))
    placed = named.select("key", F.inline(F.flatten(F.array(*[seeds(F.col("w"), m) for m in by_mask]))))

    laid = None
    for b in range(blocks):
        mine = lambda df: df if blocks == 1 else df.filter(F.pmod("no", F.lit(blocks)) == b)  # noqa: B023, E731
        hits = cut_lineage(placed.join(F.broadcast(mine(index)), "seed").select("key", "no", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "hits")
        told = hits.join(F.broadcast(mine(items).withColumnRenamed("w", "item_w")), "no").select("key", "item", "item_w", "shift")
        laid = told if laid is None else laid.unionByName(told)
    longest = max(r["longest"] for r in sizes)
    part = F.floor(F.col("shift") / PART_WORDS).cast("int")
    grouped = laid.groupBy("key", part.alias("part")).agg(F.collect_list(F.struct("item", "item_w", "shift")).alias("laid"))
    from_ = lambda p: F.greatest(p * PART_WORDS, F.lit(0))
    cut = lambda p: F.struct(p.alias("part"), F.slice("w", from_(p) + 1, F.greatest(p * PART_WORDS + PART_WORDS + longest - from_(p), F.lit(0))).alias("words"))
    pieces = _with_hits(named, laid).select("key", F.inline(F.transform(F.sequence(F.floor(F.lit(-longest / PART_WORDS)).cast("int"), F.expr(f"CAST(size(w) div {PART_WORDS} AS int)")), cut)))

    total = lambda xs: F.aggregate(xs, F.lit(0), lambda acc, x: acc + x)

    def judged(h: Column) -> Column:
        at, item_at = F.greatest(h["shift"], F.lit(0)) - from_(F.col("part")), F.greatest(-h["shift"], F.lit(0))
        size = F.least(F.size("words") - at, F.size(h["item_w"]) - item_at)
        equal = F.zip_with(F.slice("words", at + 1, size), F.slice(h["item_w"], item_at + 1, size), lambda a, b: (a == b).cast("int"))
        return F.struct(h["item"].alias("item"), h["shift"].alias("shift"), equal.alias("equal"), F.least(F.size(h["item_w"]), F.lit(window)).alias("window"))

    need = lambda h: F.ceil(F.round(h["window"] * F.lit(similarity), 9))
    starts = lambda h: F.sequence(F.lit(0), F.greatest(F.size(h["equal"]) - h["window"], F.lit(0)))
    best = lambda h: F.array_max(F.transform(starts(h), lambda i: total(F.slice(h["equal"], i + 1, h["window"]))))
    near = F.filter(F.transform("laid", judged), lambda h: total(h["equal"]) >= need(h))
    counted = F.transform(near, lambda h: F.struct(h["item"].alias("item"), h["shift"].alias("shift"), best(h).alias("matched"), h["window"].alias("window"), need(h).alias("need")))
    good = pieces.join(grouped, ["key", "part"]).select("key", F.inline(counted)).filter(F.col("matched") >= F.col("need"))
    chosen = F.max(F.struct((F.col("matched") / F.col("window")).alias("share"), "matched", "window", "shift")).alias("m")
    return good.groupBy("key", "item").agg(chosen).select("key", "item", F.col("m.matched").cast("long").alias("matched"), F.col("m.window").cast("long").alias("window"), F.col("m.shift").cast("long").alias("start"))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", **options) -> DataFrame:
    """One row per document and benchmark item that overlap."""
    found = overlaps(docs, benchmark, [F.col(f"`{doc_id}`").alias("id")], item_id, **options)
    return found.select(F.col("key.id").alias(doc_id), F.col("item").alias(item_id), "matched", "window", (F.col("matched") / F.col("window")).alias("similarity"), "start")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that overlap no item, with its columns."""
    k1, k2 = fresh(docs, "k1", "k2")
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    keyed = docs.withColumns({k1: F.xxhash64(*plain), k2: F.xxhash64(F.lit("second"), *reversed(plain))})
    found = cut_lineage(overlaps(keyed, benchmark, [F.col(k1).alias("a"), F.col(k2).alias("b")], **options).select(F.col("key.a").alias(k1), F.col("key.b").alias(k2)).distinct(), "leaks")
    return keyed.join(found, [k1, k2], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
