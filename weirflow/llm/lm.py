"""Language-model scores from a log-frequency Bloom filter, beside exact unigram scores.

Documents are first cut into chunks of some megabytes: distinct words once, and every document as places in that
list. The filter holds every word and every pair of neighbouring words of the training rows, however rare: a count
goes in as its logarithm, an n-gram being entered once for each step up to it, so that asking step by step until one
is missing reads the count back, never too low and seldom too high.

The filter grows with the input, so it is split by hash range: every chunk sends its distinct words and pairs, packed
into one row for each part, with how often it learns from each, to the part that owns their hash. A task sums them, builds
that part with a fixed number of bits an entry, asks it, and sends one byte per n-gram and the exact count of every word
back. There are as many parts as the measured tokens need for ``PART_GRAMS`` n-grams each, so a part is bounded at any
size of the corpus and nothing of them is broadcast or brought to the driver. The parts are kept as rows, and score
further documents by themselves (``Trained``).

A text's tokens are its words and one end. Null and empty texts have the end alone. A null id counts as the empty
text in the choice of training rows, so such rows are held out. Repeated rows count each. An empty table gives an
empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from weirflow.llm.common import fresh, remainder, strings
from weirflow.session import cut_lineage

CHUNK_BYTES = 12 << 20
#: N-grams that all chunks together send to one part of the filter, about; parts at least, so that tasks are even.
PART_GRAMS, LEAST_PARTS = 2 << 20, 256
#: Steps of the quantised logarithm per doubling.
STEPS = 2
BITS_PER_ENTRY, PROBES = 16, 3
PAIR_WEIGHT = 0.5


# Chunks


CHUNK = "chunk long, doc_ids array<{0}>, held binary, n_words binary, words binary, places binary, n_train long, n_train_docs long"


def _chunk(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the words of all texts as places in that list, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = split.flatten()
    coded = pc.dictionary_encode(flat)
    real = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    upto = np.concatenate(([0], np.cumsum(real)))
    counts = np.diff(upto[split.offsets.to_numpy() - split.offsets[0].as_py()])
    words = strings(coded.dictionary)
    places = coded.indices.to_numpy(zero_copy_only=False)[real]
    if b"" in words:
        gone = words.index(b"")
        del words[gone]
        places = places - (places > gone)
    return words, places.astype("<i4"), counts.astype("<i4")


def chunks(docs: DataFrame, doc_id: str, text: str, held_out: str) -> DataFrame:
    """One row per chunk of documents."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part, held, size = 0, TaskContext.get().partitionId(), [], 0

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            words, places, counts = _chunk(table.column("text"))
            out = table.column("held").to_numpy(zero_copy_only=False)
            row = {
                "chunk": [part << 32 | number], "held": [out.astype("u1").tobytes()], "n_words": [counts.tobytes()], "words": [b" ".join(words)],
                "places": [places.tobytes()], "n_train": [int(counts[~out].sum() + (~out).sum())], "n_train_docs": [int((~out).sum())],
            }
            ids = pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), table.column("id"))
            kinds = {"chunk": pa.int64(), "n_train": pa.int64(), "n_train_docs": pa.int64()}
            own = {k: pa.array(v, kinds.get(k, pa.binary())) for k, v in row.items()}
            return pa.RecordBatch.from_arrays([own["chunk"], ids, *(own[k] for k in ("held", "n_words", "words", "places", "n_train", "n_train_docs"))], ["chunk", "doc_ids", "held", "n_words", "words", "places", "n_train", "n_train_docs"])

        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < batch.num_rows:
                before = int(sizes[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, before + max(CHUNK_BYTES - size, 0), "right")))
                held.append(batch.slice(at, to - at))
                size += int(sizes[to - 1]) - before
                at = to
                if size >= CHUNK_BYTES:
                    yield close()
                    held, size, number = [], 0, number + 1
        if held:
            yield close()

    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{held_out}`").alias("held"))
    return rows.mapInArrow(run, CHUNK.format(kind))


class _Chunk:
    """A row of ``chunks`` as arrays."""

    def __init__(self, row: dict) -> None:
        self.words = row["words"].split(b" ") if row["words"] else []
        self.places = np.frombuffer(row["places"], "<i4")
        self.n_words = np.frombuffer(row["n_words"], "<i4").astype(np.int64)
        self.held = np.frombuffer(row["held"], "u1").astype(bool)
        self.first = np.concatenate(([0], np.cumsum(self.n_words)))
        #: Of each word whether its document is learned from, and whether it is the document's first.
        self.learned = np.repeat(~self.held, self.n_words)
        self.starts = np.zeros(len(self.places), bool)
        self.starts[self.first[:-1][self.n_words > 0]] = True

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of one value per word over each document."""
        out = np.zeros(len(self.n_words), values.dtype)
        full = self.n_words > 0
        if full.any():
            out[full] = np.add.reduceat(values, self.first[:-1][full])
        return out


# The filter


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(1))


def told(steps: np.ndarray, least: int = 1) -> np.ndarray:
    """The count in the middle of each step."""
    return np.where(steps > 0, least * 2.0 ** ((steps - 0.5) / STEPS), 0.0)


class Filter:
    """Log-frequency Bloom filter: n-grams by hash, each entered at every step up to the logarithm of its count."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, least: int) -> None:
        self.least = max(1, least)
        steps = 1 + np.floor(STEPS * np.log2(np.maximum(counts, self.least) / self.least)).astype(np.int64)
        self.most = int(steps.max(initial=0))
        self.size = np.uint64(1 << max(10, int(BITS_PER_ENTRY * max(1, int(steps.sum()))).bit_length()))
        self.bits = np.zeros(int(self.size) >> 3, np.uint8)
        for step in range(1, self.most + 1):
            for at in self._places(grams[steps >= step], step):
                np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    @classmethod
    def saved(cls, bits: bytes, most: int) -> Filter:
        """The filter that was kept as ``bits`` with counts of up to ``most`` steps."""
        out = cls.__new__(cls)
        out.least, out.most, out.size, out.bits = 1, most, np.uint64(8 * len(bits)), np.frombuffer(bits, np.uint8)
        return out

    def _places(self, grams: np.ndarray, step: int) -> Iterator[np.ndarray]:
        a = mix(grams + np.uint64(step * 0x2545F4914F6CDD1D & (1 << 64) - 1))
        b = mix(a) | np.uint64(1)
        for i in range(PROBES):
            yield (a + np.uint64(i) * b) & (self.size - np.uint64(1))

    def steps(self, grams: np.ndarray) -> np.ndarray:
        """The step up to which each n-gram was entered; 0 for those not held."""
        steps, left = np.zeros(len(grams), np.int64), np.arange(len(grams))
        for step in range(1, self.most + 1):
            there = np.ones(len(left), bool)
            for at in self._places(grams[left], step):
                there &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            left = left[there]
            if not len(left):
                break
            steps[left] = step
        return steps

    def ask(self, grams: np.ndarray) -> np.ndarray:
        """The count each n-gram was entered with, to within a step; 0 for those not held."""
        return told(self.steps(grams), self.least)


# Its parts

#: Low bits of a hash that name a pair within a part, and the bytes they take; the bits above choose the part. Words keep their whole hash.
NAME_BITS, NAME_BYTES = 40, 5


#: Words that are looked at together where whole columns would take much memory.
BLOCK = 1 << 17


class _Side:
    """N-grams of a chunk by part of the filter: their order, and where each part begins in it."""

    def __init__(self, hashes: np.ndarray, n: np.ndarray, parts: int) -> None:
        part = ((hashes >> np.uint64(NAME_BITS)) * np.uint64(parts) >> np.uint64(64 - NAME_BITS)).astype(np.uint16 if parts <= 1 << 16 else np.int32)
        # By part, then by count, so that counts are long runs when compressed; stable, so that every task finds the same order.
        by = np.argsort(np.minimum(n, (1 << 16) - 1).astype(np.uint16), kind="stable").astype(np.int32)
        self.order = by[np.argsort(part[by], kind="stable")]
        self.upto = np.concatenate(([0], np.cumsum(np.bincount(part, minlength=parts))))

    def cut(self, values: np.ndarray) -> list[bytes]:
        """``values`` (one per n-gram) as bytes by part."""
        values = values[self.order]
        ends = self.upto.tolist()
        return [values[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    def back(self, parts: list[bytes], kind: str) -> np.ndarray:
        """Values by n-gram out of the bytes of all parts, in order."""
        out = np.zeros(len(self.order), kind)
        out[self.order] = np.frombuffer(b"".join(parts), kind)
        return out


class _Grams:
    """The distinct words and pairs of a chunk: hashes, times learned from, and their order by part of the filter."""

    def __init__(self, c: _Chunk, parts: int) -> None:
        self.word, self.many = hashes(c.words), max(1, len(c.words))
        #: The words that have one before them.
        self.after = (np.flatnonzero(~c.starts[1:]) + 1).astype(np.int32 if len(c.places) < 1 << 31 else np.int64) if len(c.places) else np.zeros(0, np.int32)
        keys = self.keys(c, self.after)
        keys <<= 1
        keys += c.learned[self.after]
        keys.sort()
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), (keys[1:] ^ keys[:-1]) > 1)))
        self.kinds = keys[first] >> 1
        keys &= 1
        self.n_pair = (np.add.reduceat(keys, first) if len(first) else first).astype("<u4")
        del keys, first
        self.n_word = np.bincount(c.places[c.learned], minlength=len(self.word)).astype("<u4")
        self.pair = np.zeros(len(self.kinds), np.uint64)
        for at in range(0, len(self.kinds), BLOCK):
            kinds = self.kinds[at : at + BLOCK]
            self.pair[at : at + len(kinds)] = pair_hashes(self.word[kinds // self.many], self.word[kinds % self.many])
        self.words, self.pairs = _Side(self.word, self.n_word, parts), _Side(self.pair, self.n_pair, parts)

    def keys(self, c: _Chunk, after: np.ndarray) -> np.ndarray:
        out = c.places[after - 1].astype(np.int64)
        out *= self.many
        out += c.places[after]
        return out


def _names(pairs: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(pairs.astype("<u8").view("u1").reshape(-1, 8)[:, :NAME_BYTES]).view(f"V{NAME_BYTES}").ravel()


def _wide(sent: bytes) -> np.ndarray:
    wide = np.zeros((len(sent) // NAME_BYTES, 8), "u1")
    wide[:, :NAME_BYTES] = np.frombuffer(sent, "u1").reshape(-1, NAME_BYTES)
    return wide.view("<u8").ravel()


LOW = np.uint64((1 << NAME_BITS) - 1)
SENT = "chunk long, part int, words binary, pairs binary, n_words binary, n_pairs binary"
TOLD = "chunk long, part int, counts binary, word_steps binary, pair_steps binary, n_known long, bits binary, most int"


def send(cut: DataFrame, parts: int) -> DataFrame:
    """One row for each chunk and part that owns some of its n-grams: hashes of words, names of pairs, and how often they are learned from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                g, chunk = _Grams(_Chunk(batch.slice(at, 1).to_pylist()[0]), parts), batch.column("chunk")[at].as_py()
                own = np.flatnonzero(np.diff(g.words.upto) + np.diff(g.pairs.upto))
                columns = [g.words.cut(g.word.astype("<u8")), g.pairs.cut(_names(g.pair)), g.words.cut(g.n_word), g.pairs.cut(g.n_pair)]
                del g
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), chunk, np.int64)), pa.array(own.astype(np.int32)), *(pa.array([c[i] for i in own], pa.binary()) for c in columns)], ["chunk", "part", "words", "pairs", "n_words", "n_pairs"])
                del columns
                pa.default_memory_pool().release_unused()

    return cut.select("chunk", "held", "n_words", "words", "places").mapInArrow(run, SENT)


def _cut_back(values: np.ndarray, sent: list[bytes], width: int) -> pa.Array:
    upto = np.concatenate(([0], np.cumsum([len(x) // width for x in sent]))).tolist()
    return pa.array([values[a:b].tobytes() for a, b in zip(upto, upto[1:])], pa.binary())


def learn(sent: DataFrame) -> DataFrame:
    """Each part of the filter as a row without chunk (bits, most), and what it tells each chunk: exact word counts, steps of words and pairs."""

    def run(rows: pa.Table) -> pa.Table:
        words, pairs = rows.column("words").to_pylist(), rows.column("pairs").to_pylist()
        total = lambda column, where, many: np.bincount(where, np.frombuffer(b"".join(rows.column(column).to_pylist()), "<u4"), many).astype("<u8")
        word, of_word = np.unique(np.frombuffer(b"".join(words), "<u8"), return_inverse=True)
        pair, of_pair = np.unique(_wide(b"".join(pairs)), return_inverse=True)
        c_word, c_pair = total("n_words", of_word, len(word)), total("n_pairs", of_pair, len(pair))
        grams, c = np.concatenate((word & LOW, pair)), np.concatenate((c_word, c_pair)).astype(np.int64)
        kept = Filter(grams[c > 0], c[c > 0], 1)
        steps = kept.steps(grams).astype("u1")
        none = lambda kind: pa.nulls(len(words), kind)
        told_ = pa.table({
            "chunk": rows.column("chunk"), "part": rows.column("part"), "counts": _cut_back(c_word[of_word], words, 8), "word_steps": _cut_back(steps[: len(word)][of_word], words, 8),
            "pair_steps": _cut_back(steps[len(word) :][of_pair], pairs, NAME_BYTES), "n_known": none(pa.int64()), "bits": none(pa.binary()), "most": none(pa.int32()),
        })
        part = pa.table({"chunk": pa.nulls(1, pa.int64()), "part": rows.column("part").slice(0, 1), "counts": pa.nulls(1, pa.binary()), "word_steps": pa.nulls(1, pa.binary()), "pair_steps": pa.nulls(1, pa.binary()), "n_known": [int((c_word > 0).sum())], "bits": pa.array([kept.bits.tobytes()], pa.binary()), "most": pa.array([kept.most], pa.int32())})
        return pa.concat_tables([told_.combine_chunks(), part])

    return sent.groupBy("part").applyInArrow(run, TOLD)


def ask(sent: DataFrame, kept: DataFrame) -> DataFrame:
    """What the parts in ``kept`` (part, bits, most) tell chunks that they were not built from."""

    def run(rows: pa.Table, parts: pa.Table) -> pa.Table:
        words, pairs = rows.column("words").to_pylist(), rows.column("pairs").to_pylist()
        held = Filter.saved(parts.column("bits")[0].as_py(), parts.column("most")[0].as_py()) if parts.num_rows else Filter(np.zeros(0, np.uint64), np.zeros(0, np.int64), 1)
        steps = lambda grams: held.steps(grams).astype("u1")
        return pa.table({
            "chunk": rows.column("chunk"), "part": rows.column("part"), "word_steps": _cut_back(steps(np.frombuffer(b"".join(words), "<u8") & LOW), words, 8),
            "pair_steps": _cut_back(steps(_wide(b"".join(pairs))), pairs, NAME_BYTES),
        })

    return sent.groupBy("part").cogroup(kept.select("part", "bits", "most").groupBy("part")).applyInArrow(run, "chunk long, part int, word_steps binary, pair_steps binary")


class Model:
    """Smoothed probabilities out of the counts that the filter tells."""

    def __init__(self, n: int, v: int, n_docs: int, parts: int) -> None:
        self.n, self.v, self.n_docs, self.parts = n, v, n_docs, parts

    def single(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.1) / (self.n + 0.1 * (self.v + 1))

    def score(self, c: _Chunk, g: _Grams, told_: pa.Table) -> np.ndarray:
        """log10 probability of each document: every word after the one before it, and the end; ``told_`` are the steps of the chunk's n-grams, ordered by part."""
        counts = told(np.arange(256))
        word = counts[g.words.back(told_.column("word_steps").to_pylist(), "u1")]
        pair = counts[g.pairs.back(told_.column("pair_steps").to_pylist(), "u1")]
        p = self.single(word)[c.places]
        for at in range(0, len(g.after), BLOCK):
            after = g.after[at : at + BLOCK]
            before = word[c.places[after - 1]]
            follows = np.minimum(pair[np.searchsorted(g.kinds, g.keys(c, after))] / np.maximum(before, 1), 1.0)
            p[after] = np.where(before > 0, (1 - PAIR_WEIGHT) * p[after] + PAIR_WEIGHT * follows, p[after])
        end = np.log10((self.n_docs + 0.1) / (self.n + 0.1 * (self.v + 1)))
        return c.sums(np.log10(p, out=p)) + end


# Scores


@dataclass
class Trained:
    """A model with its filter: rows (part, n_known, bits, most) in the shared folder."""

    model: Model
    kept: DataFrame

    def score(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """id, n_tokens and score of documents that need not have been seen."""
        kind, model = docs.schema[doc_id].dataType.simpleString(), self.model
        unseen = fresh(docs, "held")[0]
        cut = cut_lineage(chunks(docs.withColumn(unseen, F.lit(True)), doc_id, text, unseen), "chunks")

        def run(chunk: pa.Table, known: pa.Table) -> pa.Table:
            c = _Chunk(chunk.to_pylist()[0])
            score = model.score(c, _Grams(c, model.parts), known.sort_by("part"))
            return pa.table({"id": chunk.column("doc_ids").combine_chunks()[0].values, "n_tokens": c.n_words + 1, "score": score})

        told_ = ask(send(cut, model.parts), self.kept)
        found = cut.groupBy("chunk").cogroup(told_.groupBy("chunk")).applyInArrow(run, f"id {kind}, n_tokens long, score double")
        return found.withColumnRenamed("id", doc_id)


def _train(cut: DataFrame) -> tuple[Trained, DataFrame]:
    """The model of chunks, and what its filter tells each of them."""
    sums = cut.agg(F.coalesce(F.sum("n_train"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_train_docs"), F.lit(0)).alias("d"), F.coalesce(F.sum(F.octet_length("places")), F.lit(0)).alias("b")).first()
    # A token is four bytes of places, and one word and one pair at most.
    parts = max(LEAST_PARTS, sums["b"] // 4 * 2 // PART_GRAMS)
    told_ = cut_lineage(learn(send(cut, parts)), "filter")
    kept = told_.filter("chunk IS NULL").select("part", "n_known", "bits", "most")
    v = (kept.agg(F.sum("n_known")).first()[0] or 0) + (sums["d"] > 0)
    return Trained(Model(sums["n"], v, sums["d"], parts), kept), told_.filter("chunk IS NOT NULL").select("chunk", "part", "counts", "word_steps", "pair_steps")


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: str = "held_out") -> Trained:
    """The model of all rows of ``docs`` that are not held out."""
    return _train(cut_lineage(chunks(docs, doc_id, text, held_out), "chunks"))[0]


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: str = "held_out") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score per row of ``docs``; rows held out are not learned from."""
    kind = docs.schema[doc_id].dataType.simpleString()
    cut = cut_lineage(chunks(docs, doc_id, text, held_out), "chunks")
    trained, told_ = _train(cut)
    model = trained.model

    def run(chunk: pa.Table, known: pa.Table) -> pa.Table:
        c, known = _Chunk(chunk.to_pylist()[0]), known.sort_by("part")
        g = _Grams(c, model.parts)
        corpus = g.words.back(known.column("counts").to_pylist(), "<u8")
        scale = model.n + 0.1 * (model.v + 1)
        base = c.sums(np.log10((corpus + 0.1) / scale)[c.places]) + np.log10((model.n_docs + 0.1) / scale)
        seen = c.sums((corpus > 0).astype(np.int64)[c.places]) + (model.n_docs > 0)
        out = pa.table({"id": chunk.column("doc_ids").combine_chunks()[0].values, "held_out": c.held, "n_tokens": c.n_words + 1, "n_known": seen.astype(np.int64), "base_score": base, "score": model.score(c, g, known)})
        del c, g, corpus
        pa.default_memory_pool().release_unused()
        return out

    shape = f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    found = cut.select("chunk", "doc_ids", "held", "n_words", "words", "places").groupBy("chunk").cogroup(told_.groupBy("chunk")).applyInArrow(run, shape)
    return found.select(F.col("id").alias(doc_id), "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def split(docs: DataFrame, doc_id: str = "doc_id", divisor: int = 10) -> DataFrame:
    """``docs`` with ``held_out``, true where the id's remainder is 0."""
    return docs.withColumn("held_out", remainder(F.col(f"`{doc_id}`"), divisor) == 0)
