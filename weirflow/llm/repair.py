"""Token-id files in a Re-Pair grammar: frequent pairs of ids become nonterminals, again and again, per shard.

Documents are laid in ascending order of their id by a range shuffle; each task cuts its share into shards of
about ``SHARD_IDS`` ids, a longer document going on in further shards. A shard holds its rules (pairs of
symbols; symbols from ``base`` on are nonterminals), the length each rule expands to, the shortened sequence,
and a directory of documents. The lengths allow decoding any range of ids without the rest. A file is Parquet
with one row per shard; all integers in its binary columns are little-endian.

Each round counts neighbouring pairs by sorting and gives the most frequent ones a nonterminal each; where pairs
overlap the left one goes first. After a round in which no frequent pair had to wait only pairs with one of its new
symbols can have become frequent, so only these are counted; the last round counts all again. Rounds go on until no
pair occurs ``LEAST`` times in the shard.

Null and empty texts are one end id. Rows with a null id come first; ties go by text. Repeated rows are stored
each. An empty table gives files without shards; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weirflow.llm.tokens import blocks, encoder

SHARD_IDS = 2 << 20
#: A pair that occurs so often gets a rule; so many rules a round at most, found through a table of 2 ** so many places.
LEAST, RULES_A_ROUND, TABLE_BITS = 8, 1 << 14, 18
#: As many rules are found by bisection, so that none has to wait.
FEW = 256


def _pairs(left: np.ndarray, right: np.ndarray, known: int) -> np.ndarray:
    """Two neighbouring symbols as one number."""
    if known <= 1 << 16:
        return left << np.uint32(16) | right
    return left.astype(np.uint64) << np.uint64(32) | right


def _apart(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of places that follow one another every second one, the left one first, so that no two pairs share a symbol; also their index."""
    run = np.concatenate((np.ones(min(1, len(hit)), bool), np.diff(hit) != 1))
    at = np.arange(len(hit))
    kept = np.flatnonzero((at - np.maximum.accumulate(np.where(run, at, 0))) % 2 == 0)
    return hit[kept], kept


def _looked_up(pairs: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``pairs`` are among ``keys``, and the index there: by a table of hashes, where keys meet in a place by bisection of all but the first."""
    bits, odd = 8 * keys.itemsize, {4: 0x9E3779B1, 8: 0x9E3779B97F4A7C15}[keys.itemsize]
    slot = lambda x: (x * keys.dtype.type(odd) >> keys.dtype.type(bits - TABLE_BITS)).astype(np.intp)
    places, at = slot(keys), slot(pairs)
    _, first = np.unique(places, return_index=True)
    late = np.setdiff1d(np.arange(len(keys)), first)
    late = late[np.argsort(keys[late])]
    held, rule, crowded = np.zeros(1 << TABLE_BITS, keys.dtype), np.full(1 << TABLE_BITS, -1, np.int32), np.zeros(1 << TABLE_BITS, bool)
    held[places[first]], rule[places[first]], crowded[places[late]] = keys[first], first, True
    is_key = held.take(at) == pairs
    some = np.flatnonzero(crowded.take(at) & ~is_key)
    near = late[np.minimum(np.searchsorted(keys[late], pairs[some]), len(late) - 1)] if len(late) else some
    some, near = (x[keys[near] == pairs[some]] for x in (some, near))
    is_key[some] = True
    on = np.flatnonzero(is_key)
    found = rule.take(at.take(on))
    is_key[:] = False
    is_key[some] = True
    found[is_key.take(on)] = near
    return on[found >= 0], found[found >= 0]


def compress(ids: np.ndarray, base: int, least: int = LEAST, most: int = RULES_A_ROUND) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules as pairs, lengths they expand to, sequence) of ``ids``, all below ``base``: no pair is left ``least`` times."""
    seq, rules, sizes = ids.astype(np.uint32), np.zeros((0, 2), np.uint32), np.zeros(0, np.uint32)
    known, newest = base, None
    while len(seq) > 1:
        where = None
        if newest is not None:
            new = seq >= newest
            new = new[:-1] | new[1:]
            if 2 * np.count_nonzero(new) < len(new):  # where most are new, counting all is cheaper
                where = np.flatnonzero(new)
        pairs = _pairs(seq[:-1], seq[1:], known) if where is None else _pairs(seq[where], seq[where + 1], known)
        ordered = np.sort(pairs)
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(starts, len(ordered)))
        often = np.flatnonzero(counts >= least)
        if not len(often):
            if newest is None:
                break
            newest = None
            continue
        placed = lambda x: x if where is None else where[x]  # noqa: B023, E731
        best = often[np.argsort(-counts[often], kind="stable")][:most]
        keys = ordered[starts[best]]
        if len(keys) <= FEW:
            keys = np.sort(keys)
            at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
            on = np.flatnonzero(keys[at] == pairs)
            found = at[on]
        else:
            on, found = _looked_up(pairs, keys)
        hit, kept = _apart(placed(on))
        found = found[kept]
        uses = np.bincount(found, minlength=len(keys))
        if uses.max() > 1:  # pairs that neighbours left a single place wait as well
            hit, found = hit[uses[found] > 1], found[uses[found] > 1]
        else:
            hit, _ = _apart(placed(np.flatnonzero(pairs == keys[0])))
            found = np.zeros(len(hit), np.int64)
        place = np.full(len(keys), -1, np.int64)  # of one occurrence of each pair that is used
        place[found] = hit
        used = np.flatnonzero(place >= 0)
        number = np.cumsum(place >= 0) - 1
        two, found = np.stack([seq[place[used]], seq[place[used] + 1]], axis=1), number[found]
        every = np.concatenate((np.ones(1, np.uint32), sizes))  # 0 stands for an id
        length = lambda x: every[np.maximum(x.astype(np.int64) - base + 1, 0)]  # noqa: B023, E731
        rules, sizes = np.concatenate((rules, two)), np.concatenate((sizes, length(two[:, 0]) + length(two[:, 1])))
        seq[hit] = known + found
        keep = np.ones(len(seq), bool)
        keep[hit + 1] = False
        newest = known if len(keys) == len(often) else None  # pairs that wait hold older symbols
        seq, known = seq[keep], known + len(used)
    return rules, sizes, seq


def _grown(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for, replaced level by level."""
    out = symbols.astype(np.uint32)
    while len(out) and (high := out >= base).any():
        to = np.where(high, 2, 1)
        end = np.cumsum(to)
        more = np.empty(end[-1], np.uint32)
        pair = rules[out[high] - base]
        more[end[~high] - 1] = out[~high]
        more[end[high] - 2], more[end[high] - 1] = pair[:, 0], pair[:, 1]
        out = more
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, base: int, sizes: np.ndarray | None = None) -> np.ndarray:
    """The ids that symbols stand for; with the ``sizes`` of all rules each rule is expanded once and copied."""
    if sizes is None or len(symbols) < len(rules):
        return _grown(symbols, rules, base)
    pool, first = _grown(np.arange(base, base + len(rules)), rules, base), np.cumsum(sizes, dtype=np.int64) - sizes
    ends, high = ends_of(symbols, sizes, base), symbols >= base
    out = np.empty(ends[-1] if len(ends) else 0, np.uint32)
    out[ends[~high] - 1] = symbols[~high]
    rule = symbols[high].astype(np.int64) - base
    each, upto = sizes[rule].astype(np.int64), ends[high]
    step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    out[np.repeat(upto - each, each) + step] = pool[np.repeat(first[rule], each) + step]
    return out


def ends_of(sequence: np.ndarray, sizes: np.ndarray, base: int) -> np.ndarray:
    """Ids up to and with each symbol of a sequence."""
    every = np.concatenate((np.ones(1, np.int64), sizes))  # 0 stands for an id
    return np.cumsum(every[np.maximum(sequence.astype(np.int64) - base + 1, 0)])


def extract(shard: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a shard; only the symbols that cover them are expanded."""
    ends = shard["ends"] if "ends" in shard else ends_of(shard["sequence"], shard["sizes"], shard["base"])
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    skip = start - (ends[a - 1] if a else 0)
    return expand(shard["sequence"][a:b], shard["rules"], shard["base"])[skip : skip + stop - start]


def unpack(row: dict) -> dict:
    """A row of the file with its binary columns as arrays, and where each symbol ends."""
    kind = np.dtype(f"<u{row['width']}")
    rules, sizes, seq = np.frombuffer(row["rules"], kind).reshape(-1, 2), np.frombuffer(row["sizes"], "<u4"), np.frombuffer(row["sequence"], kind)
    return {**row, "rules": rules, "sizes": sizes, "sequence": seq, "ends": ends_of(seq, sizes, row["base"])}


FIELDS = "part long, shard long, base long, width long, skipped long, n_ids long, rules binary, sizes binary, sequence binary, docs array<struct<id: {0}, doc_no: long, piece: long, pieces: long, first: long, n: long>>"


def write(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = 2) -> None:
    """Write the ids of all documents below ``path``."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    order = ["id", F.xxhash64("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, shard, schema = encoder(tokenizer), TaskContext.get().partitionId(), 0, None
        base, held, size, directory, number, skipped = coder.tokenizer.get_vocab_size(), [], 0, [], 0, 0

        def close() -> pa.RecordBatch:
            rules, sizes, seq = compress(np.concatenate(held), base)
            width = 2 if base + len(rules) <= 1 << 16 else 4
            row = {"part": part, "shard": shard, "base": base, "width": width, "skipped": skipped, "n_ids": size, "sizes": sizes.astype("<u4").tobytes(), "rules": rules.astype(f"<u{width}").tobytes(), "sequence": seq.astype(f"<u{width}").tobytes(), "docs": directory}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in blocks(batches, "text"):
            if schema is None:
                entry = pa.struct([("id", batch.schema.field("id").type)] + [(c, pa.int64()) for c in ("doc_no", "piece", "pieces", "first", "n")])
                schema = pa.schema([(c, pa.int64()) for c in ("part", "shard", "base", "width", "skipped", "n_ids")] + [(c, pa.binary()) for c in ("rules", "sizes", "sequence")] + [("docs", pa.list_(entry))])
            for doc, ids in zip(batch.column("id").to_pylist(), coder.encode(batch.column("text"), end)):
                pieces = max(1, -(-len(ids) // SHARD_IDS))
                for p in range(pieces):
                    part_ids = ids[p * SHARD_IDS : (p + 1) * SHARD_IDS]
                    directory.append({"id": doc, "doc_no": number, "piece": p, "pieces": pieces, "first": size, "n": len(part_ids)})
                    held.append(part_ids)
                    size += len(part_ids)
                    if size >= SHARD_IDS:
                        yield close()
                        held, size, directory, shard, skipped = [], 0, [], shard + 1, skipped + size
                number += 1
        if held:
            yield close()

    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, FIELDS.format(kind)).write.parquet(path)


def _pieces(files: DataFrame, every: bool, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """(part, id, doc_no, piece, pieces, first, n, ids) of documents in ``files``: all of a shard by expanding it, or the ``wanted`` ones by random access."""
    kind = files.schema["docs"].dataType.elementType["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.schema.field("docs").type.value_type
            schema = pa.schema([("part", pa.int64()), ("id", kinds.field("id").type)] + [(c, pa.int64()) for c in ("doc_no", "piece", "pieces", "first", "n")] + [("ids", pa.binary())])
            for i in range(batch.num_rows):
                row = unpack(batch.slice(i, 1).to_pylist()[0])
                whole = expand(row["sequence"], row["rules"], row["base"], row["sizes"]) if every else None
                docs = row["docs"]
                for at in range(0, len(docs), 1024):
                    some = docs[at : at + 1024]
                    cut = [whole[d["first"] : d["first"] + d["n"]] if every else extract(row, d["first"], d["first"] + d["n"]) for d in some]
                    columns = [[row["part"]] * len(some), *([d[c] for d in some] for c in ("id", "doc_no", "piece", "pieces")), [row["skipped"] + d["first"] for d in some], [d["n"] for d in some], [x.astype("<u4").tobytes() for x in cut]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    listed = files if every else files.withColumn("docs", F.filter("docs", wanted)).filter(F.size("docs") > 0)
    return listed.mapInArrow(run, f"part long, id {kind}, doc_no long, piece long, pieces long, first long, n long, ids binary")


def _joined(files: DataFrame, pieces: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids) of documents from their pieces."""
    # One row per writing task, so the window and the broadcast are bounded by the number of tasks.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return pieces.join(F.broadcast(before), "part").select("part", "doc_no", "id", "piece", "pieces", (F.col("before") + F.col("first")).alias("start"), F.col("n").alias("n_tokens"), "ids")


def _whole(placed: DataFrame) -> DataFrame:
    """Documents cut over several shards, in one piece."""
    ordered = F.array_sort(F.collect_list(F.struct("piece", "ids")))
    long = placed.groupBy("part", "doc_no").agg(F.first("id").alias("id"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"), ordered.alias("p"))
    return long.select("id", "start", "n_tokens", F.aggregate("p", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids) per document in the files: start counts the ids of all documents before it.

    Shards are expanded once; of documents that go on in a further shard the pieces are fetched by random access.
    """
    files = spark.read.parquet(path)
    single = _joined(files, _pieces(files, True)).filter("pieces = 1").select("id", "start", "n_tokens", "ids")
    return single.unionByName(_whole(_joined(files, _pieces(files, False, lambda d: d["pieces"] > 1))))


def fetch(spark: SparkSession, path: str, ids: list) -> DataFrame:
    """As :func:`read` for the documents of some ids: only the symbols that cover them are expanded."""
    files = spark.read.parquet(path)
    return _whole(_joined(files, _pieces(files, False, lambda d: d["id"].isin(ids))))
