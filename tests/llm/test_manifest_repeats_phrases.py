"""The Merkle manifest, removal of long repeats and phrase collocations against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.llm import collocations, merkle, plans, repeats

CAPITALS = re.compile("[A-Z]")


def lower(text):
    return CAPITALS.sub(lambda m: m[0].lower(), text)


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves, fanout=8):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return levels


def beside(levels, i, fanout=8):
    out = []
    for level in levels[:-1]:
        first = i // fanout * fanout
        out.append((level[first:i], level[i + 1 : first + fanout]))
        i //= fanout
    return out


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    leaf = lambda r, text: H(*(field(text if f == "text" else r[f]) for f in merkle.FIELDS))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[lang] = tree([leaf(r, r["text"]) for r in groups[lang]])
    upper = tree([trees[lang][-1][0] for lang in langs])
    root = upper[-1][0] if upper[-1] else None
    out = []
    for j, lang in enumerate(langs):
        for i, r in enumerate(groups[lang]):
            path = beside(trees[lang], i) + beside(upper, j)
            doc_id, text = "" if r["doc_id"] is None else str(r["doc_id"]), r["text"]
            if text is not None and zlib.crc32(doc_id.encode()) % 3 == 0:
                text = lower(text)
            x = leaf(r, text)
            for left, right in path:
                x = H(*left, x, *right)
            out.append((r["doc_id"], trees[lang][0][i], trees[lang][-1][0], root, H(*(d for sides in path for side in sides for d in side)), x, x == root))
    return out


MERKLE = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_merkle_query_over_hard_rows(spark, documents, tmp_path):
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    got = plans.op11_merkle(spark, str(tmp_path)).select(*MERKLE).collect()
    assert Counter(map(tuple, got)) == Counter(plain_manifest([r.asDict() for r in documents.collect()]))


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [64, 65, 1, 7], [1] * 10])
def test_merkle_trees_of_every_shape(spark, tmp_path, sizes):
    rows = [(g * 1000 + i, f"Text {i}", None if g == 0 else f"l{g}", "s", 6) for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = plans.op11_merkle(spark, str(tmp_path)).select(*MERKLE).collect()
    assert Counter(map(tuple, got)) == Counter(plain_manifest([r.asDict() for r in docs.collect()]))


def test_merkle_intervals_nest(spark, documents):
    made = merkle.manifest(documents, fanout=3)
    below = {(r.label, r.lo): r.hi for r in made.leaves.collect()}
    for level in made.nodes:
        rows = level.collect()
        for r in rows:
            assert [c.lo for c in r.children] == [r.lo, *(c.hi for c in r.children[:-1])] and r.children[-1].hi == r.hi
            assert all(below[r.label, c.lo] == c.hi for c in r.children) and 1 <= len(r.children) <= 3
        below = {(r.label, r.lo): r.hi for r in rows}
    assert all(lo == 0 for _, lo in below)
    with pytest.raises(ValueError):
        merkle.manifest(documents, fanout=1)


def test_merkle_of_nothing(spark, nothing):
    assert merkle.manifest(nothing).proofs().count() == 0


def plain_repeats(texts, window):
    raw, seen = [(t or "").encode() for t in texts], Counter()
    for b in raw:
        seen.update(b[i : i + window] for i in range(len(b) - window + 1))
    out = []
    for b in raw:
        runs = []
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + window
                else:
                    runs.append([i, i + window])
        kept, at = b"", 0
        for start, end in runs:
            kept, at = kept + b[at:start], end
        out.append((runs, kept + b[at:], len(b)))
    return out


def told(rows):
    return [([[x.start, x.end] for x in r.removed], bytes(r.kept), r.n_bytes) for r in rows]


def test_repeats_of_whole_table(spark, documents):
    rows = documents.filter("length(text) < 20000 OR text IS NULL").collect()
    docs = spark.createDataFrame([(i, r.text, "clash", "clash") for i, r in enumerate(rows)], "no int, text string, _k1 string, spans string")
    got = sorted(repeats.remove_repeats(docs).collect(), key=lambda r: r.no)
    assert told(got) == plain_repeats([r.text for r in rows], 400) and got[0].spans == "clash"


@pytest.mark.parametrize("batches", [1, 2, 3, 7])
def test_repeats_at_every_edge(spark, batches):
    import random

    rng = random.Random(3)
    prose = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n))
    passage = prose(700)
    texts = [None, "", "a" * 39, "a" * 40, "a" * 41, "ab" * 300, prose(100) + "é" * 60 + prose(50)]
    for size in (36, 38, 39, 40, 41, 42, 47, 60, 61, 90, 200):  # just too short, just long enough, over one anchor and over many
        for _ in range(3):
            start = rng.randrange(600 - size)
            texts.append(prose(rng.randrange(60)) + passage[start : start + size] + prose(rng.randrange(60)))
    own = prose(80)
    texts += [own + prose(30) + own, passage, passage, passage[:300] + "X" + passage[301:], prose(1000)]
    # One passage in many surroundings: the same head everywhere, every neighbourhood different.
    texts += [prose(rng.randrange(80)) + passage[100:138] + prose(rng.randrange(80)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "no int, text string")
    got = sorted(repeats.remove_repeats(docs, window=40, head=20, batches=batches).collect(), key=lambda r: r.no)
    assert told(got) == plain_repeats(texts, 40)


def test_planted_passages_are_told_by_n_removed(spark, tmp_path):
    """Passages are caught from 400 bytes on, whatever their number of words; n_bytes is the length of the input."""
    rng = np.random.default_rng(6)
    prose = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(n))
    short, long = prose(60), prose(80)  # 359 and 479 bytes, both of over 50 words
    texts = [f"{prose(30)} {p} {prose(90)}" if p else prose(170) for p in [short, long, None] * 8]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(plans.op12_suffix_dedup(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    assert [r.n_bytes for r in got] == [len(t) for t in texts]
    assert [(r.n_removed >= 479, r.n_spans) for r in got if r.doc_id % 3 == 1] == [(True, 1)] * 8
    assert all(r.n_removed == 0 for r in got if r.doc_id % 3 != 1)


def test_family_merges_geometrically(spark):
    family = repeats.Family()
    sizes = []
    for b in range(7):
        family.add(spark.createDataFrame([(b, 1), (100 + b // 2, 1), (200 + b, 2)], "key long, n long"))
        sizes.append([s for s, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]
    assert {r.key for r in family.repeated().collect()} == {100, 101, 102, *range(200, 207)}


def test_repeats_of_nothing(nothing):
    assert repeats.remove_repeats(nothing).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(nothing, window=40, head=41).count()


def plain_collocations(rows, least, share=80, top=2000):
    counts, out = defaultdict(Counter), []
    for lang, text in rows:
        c = counts["und" if lang is None else lang]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 5):
                c.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    for lang, c in counts.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        often, most, found = {k: v for k, v in c.items() if len(k) > 1 and v >= least}, Counter(), []
        for k, v in often.items():
            for j in range(2, len(k)):
                for i in range(len(k) - j + 1):
                    most[k[i : i + j]] = max(most[k[i : i + j]], v)
        for k, a in often.items():
            if not (most[k] and 100 * most[k] >= share * a):
                score, cut = min((2000000 * a // (c[k[:j]] + c[k[j:]]), j) for j in range(1, len(k)))
                found.append((-score, -a, " ".join(k).encode(), c[k[:cut]], c[k[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return out


PHRASES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("least, top", [(30, 2000), (3, 50)])
def test_collocations(documents, least, top):
    got = collocations.collocations(documents, least=least, top=top).select(*PHRASES).collect()
    assert sorted(map(tuple, got)) == sorted(plain_collocations([(r.lang, r.text) for r in documents.collect()], least, top=top)) and got


def test_collocations_of_repetitive_and_odd_texts(spark):
    rows = [("x", "a " * 500), ("x", "a b c d e. " * 40), ("x", "a b, c d " * 40), (None, "é f g\th i " * 35), ("", "one one\none\rone " * 33), ("y", "."), ("y", None), ("z", "A-B a-b " * 31), ("x", "solo")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = collocations.collocations(docs).select(*PHRASES).collect()
    assert sorted(map(tuple, got)) == sorted(plain_collocations(rows, 30))


def test_collocations_count_whatever_the_tables_spare(spark, documents, monkeypatch):
    want = collocations.collocations(documents, least=5).select(*PHRASES).collect()
    full = lambda rows, least, shorter: __import__("numpy").full(1 << 15, 255, "u1")
    monkeypatch.setattr(collocations, "frequent", full)
    assert sorted(map(tuple, collocations.collocations(documents, least=5).select(*PHRASES).collect())) == sorted(map(tuple, want))


def test_collocations_of_nothing(nothing):
    assert collocations.collocations(nothing).count() == 0
    assert collocations.collocations(nothing.select(F.lit("en").alias("lang"), F.lit(None).cast("string").alias("text"))).count() == 0
