"""Near duplicates by SimHash and multi-index hashing.

A fingerprint is cut into segments. Two fingerprints that differ in at most d bits differ in at most
d // segments bits of some segment, so each looks up all values of a small Hamming ball around each of its
segments, and what it finds is verified over all bits. Equal fingerprints are one entry of the index, and
where a segment value is crowded its entries are linked to two of them first; only links between groups
that are still apart are looked for among all entries, so a crowd of near copies never yields all its pairs.

Null and empty texts have fingerprint zero and link like any other. Rows with a null id take part in links
but never name a component; a component without any id has a null one. Repeated rows each get a row. An
empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.llm.common import fresh
from weirflow.llm.graph import components
from weirflow.session import cut_lineage

SEED = 42
BITS = 64


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bits that more than half of the shingles' hashes have."""
    words = text.lower().split()  # on bytes: A-Z and the white space of ASCII alone
    if not words:
        return 0
    line, size, xxh = b" ".join(words), len(words), xxhash.xxh64_intdigest
    if size < shingle:
        return xxh(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, size) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: size - shingle + 1].tolist()
    count = len(starts)
    hashes = np.fromiter((xxh(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())), np.uint64, count)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """Fingerprint as a signed long, zero for null."""

    @F.arrow_udf(T.LongType())
    def run(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in texts), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return run(text.cast("string"))


def _index(fps: DataFrame, distance: int, segments: int) -> DataFrame:
    """Rows (columns of fps, segment, key, own): own entries and probes of the ball around each segment.

    Of two values in each other's ball only the one with a zero at the lowest differing bit probes.
    """
    width, places = BITS // segments, []
    for s in range(segments):
        for r in range(distance // segments + 1):
            for bits in combinations(range(width), r):
                places.append((s, sum(1 << b for b in bits), 1 << bits[0] if bits else 0))
    balls = F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), F.lit(m).cast("long").alias("mask"), F.lit(low).cast("long").alias("low")) for s, m, low in places]))
    part = F.expr(f"shiftrightunsigned(fp, cast(p.segment * {width} as int))").bitwiseAND(F.lit((1 << width) - 1))
    return fps.select("*", balls.alias("p")).withColumn("part", part).filter("part & p.low = 0").select(
        *fps.columns, F.col("p.segment").alias("segment"), F.expr("part ^ p.mask").alias("key"), (F.col("p.mask") == 0).alias("own"),
    )


def links(fps: DataFrame, distance: int = 3, segments: int = 2) -> DataFrame:
    """(fp, root) of distinct fingerprints ``fps`` (column fp) that have a neighbour within ``distance`` bits."""
    if BITS % segments:
        raise ValueError(f"{BITS} bits do not split into {segments} segments")
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance
    own = _index(fps.select("fp"), 0, segments).select("segment", "key", "fp")
    posts = own.groupBy("segment", "key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high")
    first = own.join(posts, ["segment", "key"]).select("fp", F.explode(F.array("low", "high")).alias("other")).filter(near("fp", "other") & (F.col("fp") != F.col("other")))
    early = components(first, "fp", "other")
    grouped = fps.select("fp").join(early.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    index = _index(grouped, distance, segments)
    entries = index.filter("own").select("segment", "key", F.col("fp").alias("fp2"), F.col("root").alias("root2"))
    apart = (F.col("root") != F.col("root2")) & (~F.col("own") | (F.col("fp") < F.col("fp2")))
    found = index.join(entries, ["segment", "key"]).filter(apart & near("fp", "fp2")).select("root", "root2").distinct()
    joined = components(found, "root", "root2")
    return grouped.join(joined.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("fp", F.coalesce("top", "root").alias("root"))


def linked(rows: DataFrame, distance: int = 3, segments: int = 2) -> DataFrame:
    """``rows`` (with column fp, written already) with ``root``, equal for all that are linked."""
    fps = cut_lineage(rows.select("fp").distinct(), "fingerprints")
    return rows.join(cut_lineage(links(fps, distance, segments), "links"), "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint as 16 hex digits, component_id (smallest id reachable)."""
    rows = cut_lineage(docs.select(F.col(f"`{doc_id}`").alias("id"), fingerprint_column(F.col(f"`{text}`"), shingle).alias("fp")), "simhash")
    roots = linked(rows.groupBy("fp").agg(F.min("id").alias("least")), distance)
    names = roots.join(roots.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(names, "fp").select(F.col("id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, null ids last, then by content."""
    k1, k2, fp = fresh(docs, "k1", "k2", "fp")
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    keyed = docs.withColumns({k1: F.xxhash64(*plain), k2: F.xxhash64(F.lit("second"), *reversed(plain))})
    rows = cut_lineage(keyed.select(F.col(f"`{doc_id}`").alias("id"), F.col(k1).alias("k1"), F.col(k2).alias("k2"), fingerprint_column(F.col(f"`{text}`"), shingle).alias("fp")), "simhash")
    order = F.struct(F.col("id").isNull(), "id", "k1", "k2")
    best = rows.groupBy("fp").agg(F.min(order).alias("best"))
    kept = linked(best, distance).groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.k1").alias(k1), F.col("best.k2").alias(k2))
    return keyed.join(kept, [k1, k2], "left_semi").dropDuplicates([k1, k2]).select(*[F.col(f"`{c}`") for c in docs.columns])
