"""Language identification by prediction by partial matching over bytes.

For each language the bytes that follow every context of up to three bytes are counted over all training
documents. A context gives a byte it has seen count / (total + kinds) and escapes with kinds / (total + kinds) to the
next shorter context, whose probabilities are spread over the bytes not seen in the longer one; below the empty
context all bytes are alike. These statistics are frozen into one table of code lengths per context, and a text
costs the sum over its bytes; the language with the shortest code wins, ties going to the first by name.

Letters are compared in lower case; runs of ASCII other than letters count as one separator. Counts are merged
per task before they are shuffled. Contexts of up to two bytes hold the counts of all bytes, summed before anything is
left out; of these triples there are at most ``KINDS`` ** 3. After contexts of three bytes only those bytes are listed
that make up ``LEAST_SHARE`` of a language's bytes, in contexts that make up ``LEAST_CONTEXT``; others are reached by the
escape. So at most 1 / ``LEAST_SHARE`` quadruples per language reach the driver, whatever the corpus holds, and a model
has the same depth at every size.

Null text and text without a letter is ``und`` with score 0, and so is everything if nothing could be learned. Rows
without a language are not learned from. Repeated rows count each. An empty table gives an empty result; other
columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weirflow.session import cut_lineage

ORDER = 3
LEAST_SHARE = 2e-6
#: Contexts of full length that are a smaller share of every language use the next shorter one.
LEAST_CONTEXT = 1e-5
KINDS = 155
BLOCK = 4 << 20

#: Separator 0, letters 1 to 26, bytes above ASCII from 27 on.
CLASSES = bytes(b - 96 if 97 <= b <= 122 else b - 101 if b >= 128 else 0 for b in range(256))


def classes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Byte classes of all texts in a row, separators merged, and where each text starts (one more at the end)."""
    raw = [t.lower().encode("utf-8", "replace").translate(CLASSES) for t in texts]
    line = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.concatenate(([0], np.cumsum([len(r) for r in raw], dtype=np.int64)))
    if not len(line):
        return line, ends
    keep = np.ones(len(line), bool)
    keep[1:] = (line[1:] != 0) | (line[:-1] != 0)
    keep[ends[:-1][ends[:-1] < len(line)]] = True
    upto = np.concatenate(([0], np.cumsum(keep)))
    return line[keep], upto[ends]


def contexts(line: np.ndarray, starts: np.ndarray, kinds: int) -> np.ndarray:
    """The three classes before each place as one number; before a text there are separators."""
    first = starts[:-1][starts[:-1] < starts[1:]]
    out, back = np.zeros(len(line), np.uint32), line.astype(np.uint32)
    for k in range(ORDER):
        back = np.concatenate((np.zeros(min(1, len(back)), np.uint32), back[:-1]))
        back[first] = 0
        out += back * np.uint32(kinds**k)
    return out


def _parts(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Some texts at a time, so that the arrays stay small."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= BLOCK):
            size += len(texts[to])
            to += 1
        yield at, texts[at:to]
        at = to


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = (np.concatenate(x) for x in zip(*parts))
    kinds, place = np.unique(codes, return_inverse=True)
    return kinds, np.bincount(place, counts, len(kinds)).astype(np.int64)


def quadruples(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, code, n): how often each four byte classes in a row occur in a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(name, []).append(t)
            for name, texts in by.items():
                for _, some in _parts(texts):
                    line, starts = classes(some)
                    code = np.sort(contexts(line, starts, KINDS) * np.uint32(KINDS) + line)
                    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(code)), bool), code[1:] != code[:-1])))
                    held.setdefault(name, []).append((code[first], np.diff(np.append(first, len(code)))))
                    if len(held[name]) >= 16:
                        held[name] = [_merged(held[name])]
        for name, parts in held.items():
            codes, counts = _merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts)], ["lang", "code", "n"])

    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _row(count: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities of all bytes after contexts (rows of ``count``), escaping to those in ``lower``."""
    total, seen = count.sum(1, keepdims=True), count > 0
    kinds = seen.sum(1, keepdims=True)
    rest = np.where(seen, 0.0, lower)
    left = rest.sum(1, keepdims=True)
    full = np.maximum(total + np.where(left > 0, kinds, 0), 1)
    known = np.where(seen, count / full, kinds / full * rest / np.where(left > 0, left, 1))
    return np.where(total > 0, known, lower)


class Model:
    """Frozen code lengths: ``state`` of a context (three classes), ``cost[state, class, language]`` in nats."""

    def __init__(self, pruned: pa.Table, triples: pa.Table) -> None:
        """Out of (lang, code, n): the quadruples that are listed, and all triples."""
        self.languages = sorted(set(triples.column("lang").to_pylist()))
        classes_of = lambda code, size: np.stack([code // KINDS**k % KINDS for k in range(size)], axis=1)
        parts = [(np.searchsorted(self.languages, t.column("lang").to_pylist()), classes_of(t.column("code").to_numpy(), size), t.column("n").to_numpy()) for t, size in ((pruned, ORDER + 1), (triples, ORDER))]
        (which, digits, n), (which3, digits3, n3) = parts
        used = np.unique(np.append(digits3.ravel(), 0))
        #: Classes never seen share the last place.
        self.kinds = len(used) + 1
        self.place = np.full(256, len(used), np.uint8)
        self.place[used] = np.arange(len(used))
        digits, digits3 = self.place[digits].astype(np.int64), self.place[digits3].astype(np.int64)
        a = self.kinds
        full = digits[:, 1] + a * digits[:, 2] + a * a * digits[:, 3]
        bytes_in = np.zeros((len(self.languages), a**3), np.int64)
        np.add.at(bytes_in, (which, full), n)
        totals = np.bincount(which3, n3, len(self.languages))
        long = np.flatnonzero((bytes_in >= LEAST_CONTEXT * totals[:, None]).any(0))
        self.state = (np.arange(a**3) % (a * a)).astype(np.int32)
        self.state[long] = a * a + np.arange(len(long))
        self.cost = np.empty((a * a + len(long), a, len(self.languages)), np.float32)
        at = np.full(a**3, -1)
        at[long] = np.arange(len(long))
        for i in range(len(self.languages)):
            table = lambda rows, byte, weight, size: np.bincount(rows * a + byte, weight, size * a).reshape(size, a)  # noqa: B023, E731
            mine = which3 == i
            byte, before, weight = digits3[mine, 0], digits3[mine, 1:], n3[mine]
            zero = _row(table(np.zeros(len(byte), np.int64), byte, weight, 1), np.full((1, a), 1 / a))
            one = _row(table(before[:, 0], byte, weight, a), np.repeat(zero, a, 0))
            two = _row(table(before[:, 0] + a * before[:, 1], byte, weight, a * a), one[np.arange(a * a) % a])
            listed = (which == i) & (at[full] >= 0)
            three = _row(table(at[full[listed]], digits[listed, 0], n[listed], len(long)), two[long % (a * a)])
            self.cost[:, :, i] = -np.log(np.concatenate((two, three)))

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Code length of each text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        flat = self.cost.reshape(-1, len(self.languages))
        for at, some in _parts(texts):
            line, starts = classes(some)
            line = self.place[line]
            there = np.flatnonzero(starts[:-1] < starts[1:])
            if len(there):
                each = flat[self.state[contexts(line, starts, self.kinds)].astype(np.int64) * self.kinds + line]
                out[at + there] = np.add.reduceat(each, starts[:-1][there], axis=0, dtype=np.float64)
        return out


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model | None:
    """A model of the languages in ``docs``; None where there is nothing to learn from."""
    counts = cut_lineage(quadruples(docs, lang, text), "quadruples")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, "lang").filter(F.col("n") >= F.col("total") * LEAST_SHARE).select("lang", "code", "n")
    triples = counts.groupBy("lang", (F.col("code") % KINDS**ORDER).alias("code")).agg(F.sum("n").alias("n")).toArrow()
    return Model(kept.toArrow(), triples) if triples.num_rows else None


def identify(docs: DataFrame, model: Model | None, text: Column) -> Column:
    """Struct (lang_pred, score) for a text; score is the winner's share of the probability of all languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def run(texts: pa.Array) -> pa.Array:
        model, given = shared.value, [t or "" for t in texts.to_pylist()]
        letters = np.array([any(map(str.isalpha, t)) for t in given], bool)
        if model is None:
            names, scores = ["und"] * len(given), np.zeros(len(given))
        else:
            cost = model.lengths(given)
            best = cost.argmin(1)
            scores = np.where(letters, 1 / np.exp(cost.min(1, keepdims=True) - cost).sum(1), 0.0)
            names = [model.languages[b] if ok else "und" for b, ok in zip(best, letters)]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], names=["lang_pred", "score"])

    return run(text.cast("string"))
