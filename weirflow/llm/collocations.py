"""Phrase collocations by marginalising the longest windows.

Every word starts one window: the word and those that follow it in its piece, ``LONGEST`` at most, padded with empty
strings (lead columns w1, w2, ...). Only these windows are counted. Spark's ROLLUP over the lead columns sums them over
ever shorter prefixes, which gives the count of every phrase of any length, of every word, and of all words of a
language in one aggregation; prefixes that end in padding are the shorter phrase over again and fall away.

Words are so diverse that most windows occur once. Before counting, a window is padded from the first word on that
cannot be part of a candidate there: words, pairs of words that are left, and triples of pairs that are left are counted
by a hash of ``KEY_BITS``, and what shares a hash that stays below ``least`` does so itself. Padding there changes no
count of ``least`` or more, since every word, pair and triple inside such a phrase is as frequent as the phrase. Windows
that begin with such a word are all padding and count for the language alone. What is frequent is broadcast as a table of
bits, 16 for each entry and ``2 ** TABLE_BITS`` at most; beyond that many entries it spares less, with the same results.

Text is split into pieces and words, and equal windows of some megabytes of text are summed, in tasks over Arrow
columns; equal windows of all tasks meet in a shuffle after partial sums, their prefixes in a second one, so no frequent
word or pair is ever in one place. Candidates, parts and containing phrases are joins of tables of frequent phrases.

Null and empty texts have no words. A null language counts as ``und``. Repeated rows count each. Text without any
separator is one long word. An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from weirflow.llm.common import strings
from weirflow.session import cut_lineage

LONGEST = 4
KEY_BITS, TABLE_BITS = 40, 28
BLOCK_BYTES = 4 << 20
#: Keys that a task holds before it hands out their sums.
HELD = 4 << 20

#: What a byte is: 0 of a word, 1 a blank, 2 the end of a piece.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


class Tokens:
    """Words of a block of texts: distinct ones, the places of all in that list, and whether the next word follows in the same piece."""

    def __init__(self, texts: pa.Array) -> None:
        low = pc.ascii_lower(pc.fill_null(texts, ""))
        ends = np.frombuffer(low.buffers()[1], np.int32, len(low) + 1, low.offset * 4).astype(np.int64)
        data = np.frombuffer(low.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] else np.zeros(0, np.uint8)
        ends -= ends[0]
        kind = KIND[data]
        word = kind == 0
        start = word.copy()
        start[1:] &= ~word[:-1]
        edge = ends[1:-1][ends[1:-1] < len(data)]
        start[edge] = word[edge]  # a text begins a word of its own
        first = np.flatnonzero(start)
        sizes = np.add.reduceat(word, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
        # The last word of a text must not run on into the next: reduceat stops at the next start, and blanks count nothing.
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        flat = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data[word]))
        coded = flat.dictionary_encode()
        self.words = pa.array(coded.dictionary.cast(pa.string()))
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        #: Place of the text that each word is in.
        self.text = np.searchsorted(ends[1:], first, "right")
        here = np.searchsorted(np.flatnonzero(kind == 2), first)
        self.follows = np.zeros(len(first), bool)
        if len(first):
            self.follows[:-1] = (here[1:] == here[:-1]) & (self.text[1:] == self.text[:-1])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Runs:
    """For each word of a block, a key of the phrase that begins there, one word longer each time, and whether it may be frequent."""

    def __init__(self, t: Tokens, langs: np.ndarray) -> None:
        self.word = np.fromiter((xxhash.xxh64_intdigest(w, 11) for w in strings(t.words)), np.uint64, len(t.words))[t.ids]
        self.state = langs[t.text]
        self.follows, self.size = t.follows, 0
        #: Places whose ``size`` words are in one piece and may be frequent.
        self.at = np.arange(len(t.ids), dtype=np.int32)
        self.possible = np.ones(len(t.ids), bool)

    def longer(self) -> np.ndarray:
        """Go on to phrases of one word more, whose parts without the last and without the first word are possible; their keys."""
        if self.size:
            last = self.at + (self.size - 1)
            here = self.follows[last]
            here[here] = self.possible[self.at[here] + 1]
            self.at = self.at[here]
        self.state[self.at] = _mix(self.state[self.at] * np.uint64(0x9E3779B97F4A7C15) + self.word[self.at + self.size])
        self.size += 1
        return (_mix(self.state[self.at]) >> np.uint64(64 - KEY_BITS)).astype(np.int64)

    def keep(self, key: np.ndarray, bits: np.ndarray) -> None:
        """Leave only phrases whose bit is set."""
        place = key >> KEY_BITS - (len(bits) * 8).bit_length() + 1
        good = (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
        self.at = self.at[good]
        self.possible = np.zeros(len(self.follows), bool)
        self.possible[self.at] = True


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in tables of about ``BLOCK_BYTES`` of text, one row at least."""
    held, size = [], 0
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(upto[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(upto, before + max(BLOCK_BYTES - size, 0), "right")))
            held.append(batch.slice(at, to - at))
            size += int(upto[to - 1]) - before
            at = to
            if size >= BLOCK_BYTES:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _read(block: pa.Table) -> tuple[Tokens, pa.Array, np.ndarray, np.ndarray]:
    """Tokens, the languages of the block, the place of each text's language among them, and the languages' hashes by text."""
    coded = block.column("lang").combine_chunks().dictionary_encode()
    names = coded.dictionary
    place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, 13) for x in strings(names)), np.uint64, len(names))
    return Tokens(block.column("text").combine_chunks()), names, place, hashes[place]


def _sums(keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    ordered = np.sort(np.concatenate(keys))
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1])))
    n = np.diff(np.append(first, len(ordered)))
    for at in range(0, len(first), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(ordered[first[at : at + (1 << 16)]]), pa.array(n[at : at + (1 << 16)])], ["key", "n"])


def frequent(rows: DataFrame, least: int, shorter: list[np.ndarray]) -> np.ndarray:
    """Bits by key of phrases one word longer than those of the last of ``shorter``: whether they may occur ``least`` times."""
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast(shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = []
        for block in _blocks(batches):
            t, _, _, hashes = _read(block)
            runs = Runs(t, hashes)
            for bits in held.value:
                runs.keep(runs.longer(), bits)
            waiting.append(runs.longer())
            if sum(map(len, waiting)) >= HELD:
                yield from _sums(waiting)
                waiting = []
        if waiting:
            yield from _sums(waiting)

    counts = rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    often = cut_lineage(counts.filter(F.col("n") >= least).select("key"), "frequent")
    bits = min(max((16 * often.count()).bit_length(), 18), TABLE_BITS)
    one = F.shiftright("key", KEY_BITS - bits) + 1  # the functions count from 1
    maps = often.groupBy(F.bitmap_bucket_number(one).alias("no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits"))
    table = np.zeros(1 << bits - 3, np.uint8)
    found = maps.toArrow()  # at most one row for 32,768 bits
    for no, part in zip(found.column("no").to_pylist(), found.column("bits").to_pylist()):
        table[(no - 1) * len(part) : no * len(part)] = np.frombuffer(part, np.uint8)
    return table


def windows(rows: DataFrame, shorter: list[np.ndarray]) -> DataFrame:
    """(lang, w1 ... w4, n): padded longest windows, summed within blocks of text."""
    held = rows.sparkSession.sparkContext.broadcast(shorter)
    leads = [f"w{i + 1}" for i in range(LONGEST)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            t, names, place, hashes = _read(block)
            if not len(t.ids):
                continue
            # Words count from 1; 0 is padding.
            many, runs, columns = len(t.words) + 1, Runs(t, hashes), [place[t.text]]
            for size in range(1, LONGEST + 1):
                key = runs.longer()
                if size <= len(held.value):
                    runs.keep(key, held.value[size - 1])
                lead = np.zeros(len(t.ids), np.int32)
                lead[runs.at] = t.ids[runs.at + size - 1] + 1
                columns.append(lead)
            # Windows of one word are summed by their word, the others by sorting.
            alone = columns[2] == 0
            found, single = np.unique(columns[0][alone] * many + columns[1][alone], return_counts=True)
            rows_ = [np.stack([found // many, found % many] + [np.zeros(len(found), np.int64)] * (LONGEST - 1))]
            n = [single]
            longer = np.stack([c[~alone] for c in columns])
            if longer.shape[1]:
                longer = longer[:, np.lexsort(longer[::-1])]
                first = np.flatnonzero(np.concatenate(([True], (longer[:, 1:] != longer[:, :-1]).any(axis=0))))
                rows_.append(longer[:, first])
                n.append(np.diff(np.append(first, longer.shape[1])))
            table, n = np.concatenate(rows_, axis=1), np.concatenate(n)
            padded = pa.concat_arrays([pa.array([""], pa.string()), t.words])
            for at in range(0, len(n), 1 << 16):
                part = [src.take(pa.array(c[at : at + (1 << 16)])) for src, c in zip([names] + [padded] * LONGEST, table)]
                yield pa.RecordBatch.from_arrays([*part, pa.array(n[at : at + (1 << 16)].astype(np.int64))], ["lang", *leads, "n"])

    return rows.mapInArrow(run, "lang string, " + ", ".join(f"{w} string" for w in leads) + ", n long")


def phrase_counts(counted: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """((lang, words, f) of phrases of ``least`` or more, (lang, n) of all words), by ROLLUP over the lead columns."""
    leads = [f"w{i + 1}" for i in range(LONGEST)]
    # Equal windows meet first, so that each sends its prefixes on once and not once per task.
    whole = counted.groupBy("lang", *leads).agg(F.sum("n").alias("n"))
    summed = whole.rollup("lang", *leads).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    # Bits of g are set for the columns summed over: 0 for whole windows, 2 ** LONGEST - 1 for a language.
    size = F.lit(LONGEST) - F.bit_count("g")
    kept = summed.filter((F.col("g") < (1 << LONGEST)) & ((size == 0) | ((F.col("f") >= least) & (F.element_at(F.array(*leads), F.greatest(size, F.lit(1))) != ""))))
    table = cut_lineage(kept.select("lang", F.slice(F.array(*leads), 1, size).alias("words"), "f"), "phrases")
    return table.filter(F.size("words") > 0), table.filter(F.size("words") == 0).select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` candidates of each language.

    A candidate occurs ``least`` times; cut after each word in turn, its lowest score floor(2000000 a / (l + r)) counts.
    Those inside a longer candidate of at least ``share`` per cent of their count are dropped.
    """
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    shorter: list[np.ndarray] = []
    for _ in range(1, LONGEST):
        shorter.append(frequent(rows, least, shorter))
    phrases, totals = phrase_counts(windows(rows, shorter), least)
    candidates = phrases.filter(F.size("words") > 1)
    # Each cut asks for two parts; parts of candidates are at least as frequent and therefore in the table.
    cuts = candidates.select("lang", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    rest = F.slice("words", F.col("k") + 1, F.size("words"))
    of = lambda part, name: phrases.select("lang", F.col("words").alias(part), F.col("f").alias(name))
    cut = cuts.withColumns({"head": F.slice("words", 1, F.col("k")), "tail": rest}).join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"])
    wide = lambda name: F.col(name).cast("decimal(38,0)")
    score = F.floor(F.expr("CAST((CAST(a AS DECIMAL(38,0)) * 2000000) div (CAST(l AS DECIMAL(38,0)) + r) AS BIGINT)"))
    low = cut.withColumn("score", score).groupBy("lang", "words").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("m"))

    spans = [F.slice("words", i, j) for j in range(2, LONGEST) for i in range(1, LONGEST - j + 2)]
    inside = candidates.select("lang", "words", "f", F.explode(F.array_distinct(F.array(*spans))).alias("part")).filter((F.size("part") > 1) & (F.size("part") < F.size("words")))
    # A slice that starts late enough in a short phrase is cut off at its end and so still lies in it.
    held = inside.groupBy("lang", F.col("part").alias("words")).agg(F.max("f").alias("most"))
    free = low.join(held, ["lang", "words"], "left").filter(F.col("most").isNull() | (wide("most") * 100 < F.col("m.a").cast("decimal(38,0)") * share))
    scored = free.select("lang", F.array_join("words", " ").alias("phrase"), "m.a", "m.l", "m.r", "m.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = scored.withColumn("rank", place).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
