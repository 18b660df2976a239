"""Every operator against plain Python on the small tables and the hard rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import check
from weirflow.llm import decontaminate, language, lm, packing, plans, quality_rules, repair, secrets, simhash
from weirflow.llm.common import remainder

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def held(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n == 0


@pytest.fixture(scope="module")
def ids(rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, _ in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_equals_sql(spark, name):
    note, ok = check.compare(spark, check.connect(SF), name, plans.QUERIES[name], plans.ORACLES[name], SF)
    assert ok, note


def test_packing_cuts_every_document_without_loss_or_padding(documents, ids):
    got = packing.pack(documents, TOKENIZER).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.doc_tokens].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.length * 4 == len(r.ids)
    whole = Counter()
    for (doc, n), parts in pieces.items():
        copies, run = [], []
        for start, part in sorted(parts, key=lambda p: p[0]):
            # Repeated documents give their pieces several times over; each start occurs once per copy.
            copies.append((start, len(part)))
            run.append(part)
        whole[doc] += sum(map(len, run)) // n
        assert sum(map(len, run)) % n == 0
    assert whole == Counter(d for d, _ in ids)
    once = {d: i for d, i in ids if whole[d] == 1}
    for (doc, n), parts in pieces.items():
        if doc in once:
            assert [x for _, p in sorted(parts) for x in p] == once[doc]
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0


def test_bin_slack_finds_the_fullest_choice():
    rng = np.random.default_rng(1)
    for _ in range(50):
        sizes = rng.integers(1, 60, 9).tolist()
        room = int(rng.integers(10, 150))
        best = max(s for s in (sum(x for i, x in enumerate(sizes) if m >> i & 1) for m in range(1 << len(sizes))) if s <= room)
        taken = packing.fullest(sorted(set(sizes)), Counter(sizes), room)
        assert sum(n * k for n, k in taken.items()) == best
        assert all(k <= sizes.count(n) for n, k in taken.items())


def test_token_files_give_back_every_id(spark, documents, ids, tmp_path):
    repair.write(documents, str(tmp_path / "a"), TOKENIZER)
    got = repair.read(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert Counter((r.id, crc(i)) for r, i in ((r, np.frombuffer(r.ids, "<u4")) for r in got)) == Counter((d, crc(i)) for d, i in ids)
    keys = [(r.id is not None, r.id or 0) for r in got]
    assert keys == sorted(keys)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_token_files_with_documents_longer_than_a_shard(spark, documents, ids, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    seq = np.concatenate([rng.integers(0, 40, 900), np.zeros(301, int), np.tile([1, 2, 3], 700)])
    rules, sizes, short = repair.compress(seq, 50)
    assert len(short) < len(seq) / 2
    assert repair.expand(short, rules, 50).tolist() == seq.tolist()
    shard = {"sequence": short, "rules": rules, "sizes": sizes, "base": 50}
    for a, b in ((0, 1), (17, 401), (900, 1201), (len(seq) - 3, len(seq)), (0, len(seq))):
        assert repair.extract(shard, a, b).tolist() == seq[a:b].tolist()
    for few in ([], [7], [7, 7]):
        assert repair.expand(repair.compress(np.array(few, int), 50)[2], repair.compress(np.array(few, int), 50)[0], 50).tolist() == few


def plain_measures(text):
    words = WORD.findall(text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_verdict(spark, documents, rows):
    got = quality_rules.judge(documents, carry=["doc_id"]).select("doc.doc_id", "m.*", "base_failed", "kept").collect()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[c] for c in cols)) for r in got) == Counter((d, *plain_measures(t)) for d, t, _ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert len(quality_rules.keep_good(documents).columns) == len(documents.columns)


def test_quality_verdict_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = plans.QUERIES["op10_quality_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("NOT base_failed")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n.get((1, True), 0) >= 0.98 * (n.get((1, True), 0) + n.get((1, False), 0))
    assert n.get((0, False), 0) >= 0.8 * (n.get((0, True), 0) + n.get((0, False), 0))


def test_expectation_maximisation_equals_plain_python(spark):
    rng = np.random.default_rng(5)
    good = rng.random(400) < 0.8
    votes = np.where(rng.random((400, 3)) < np.where(good, 0.1, 0.6)[:, None], -1, np.where(rng.random((400, 3)) < 0.5, 1, 0))
    got = quality_rules.fit(spark.createDataFrame([(v.tolist(),) for v in votes], "votes array<tinyint>"), 3, rounds=5, tolerance=0)
    start = {True: [0.05, 0.35, 0.6], False: [0.4, 0.4, 0.2]}
    prior, chance = 0.8, {c: np.tile(start[c], (3, 1)) for c in start}
    for _ in range(5):
        w = np.log(chance[True] / chance[False])
        w = np.stack([np.minimum(w[:, 0], -math.log(2)), np.zeros(3), np.maximum(w[:, 2], 0)], 1)
        r = 1 / (1 + np.exp(-(math.log(prior / (1 - prior)) + w[np.arange(3), votes + 1].sum(1))))
        extra = 0.4
        prior = (r.sum() + 0.8 * extra) / (400 + extra)
        for c, share in ((True, r), (False, 1 - r)):
            hits = np.stack([(share[:, None] * (votes == v)).sum(0) for v in (-1, 0, 1)], 1)
            chance[c] = (hits + extra * np.array(start[c])) / (share.sum() + extra)
    w = np.log(chance[True] / chance[False])
    want = [math.log(prior / (1 - prior)), *np.stack([np.minimum(w[:, 0], -math.log(2)), np.zeros(3), np.maximum(w[:, 2], 0)], 1).ravel()]
    assert np.allclose(got, want)


def plain_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(prints, distance=3):
    parent = {p: p for p in prints}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    all_ = sorted(parent)
    for i, a in enumerate(all_):
        for b in all_[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                parent[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in all_}


def test_simhash_equals_all_pairs(documents, rows):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(documents).collect())
    prints = [(d, plain_fingerprint(t)) for d, t, _ in rows]
    tops = plain_components([p for _, p in prints])
    least = {}
    for d, p in prints:
        if d is not None:
            least[tops[p]] = min(least.get(tops[p], d), d)
    assert got == Counter((d, f"{p:016x}", least.get(tops[p])) for d, p in prints)
    assert simhash.keep_one(documents).count() == len(set(tops.values()))


def test_links_of_crowded_fingerprints(spark):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    found = set(base)
    for _ in range(600):
        x = base[int(rng.integers(0, 3))]
        for b in rng.integers(0, 64, int(rng.integers(1, 6))):
            x ^= 1 << int(b)
        found.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for segments in (2, 4):
        got = {r.fp: r.root for r in simhash.links(spark.createDataFrame([(signed(x),) for x in found], "fp long"), 3, segments).collect()}
        want = plain_components(found)
        assert len(got) == len(found)
        groups = lambda m: Counter(frozenset(k for k in m if m[k] == r) for r in set(m.values()))
        assert groups(got) == groups({signed(k): signed(v) for k, v in want.items()})


def test_secret_spans(documents, rows):
    def base(text):
        kinds = {"assign": re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
        out = [("assign", *m.span()) for m in kinds["assign"].finditer(text) if len(m[2]) >= 6]
        out += [("access", *m.span()) for m in kinds["access"].finditer(text) if len(m[0]) >= 20]
        out += [("hex", *m.span()) for m in kinds["hex"].finditer(text) if len(m[0]) >= 24]
        return sorted(out, key=lambda s: (s[1], list(kinds).index(s[0])))

    got = secrets.scan(documents).collect()
    want = Counter((d, tuple(base(t or ""))) for d, t, _ in rows)
    assert Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.kind in ("assign", "access", "hex"))) for r in got) == want
    clean = secrets.redacted(documents)
    assert clean.columns == documents.columns and clean.filter("text IS NULL").count() == 1
    assert secrets.scan(clean).filter(F.size("spans") > 0).count() == 0


def test_structures_are_confirmed():
    import base64
    import json

    def tlv(tag, body):
        n = len(body)
        size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
        return bytes([tag]) + size + body

    numbers = b"".join(tlv(2, b"\x01" * n) for n in (1, 64, 3, 64, 32, 32, 32, 32, 32))
    rsa = tlv(0x30, numbers)
    wrapped = tlv(0x30, tlv(2, b"\0") + tlv(0x30, tlv(6, b"\x2a\x86\x48") + b"\x05\0") + tlv(4, rsa))
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (b"p" * 51, b"s" * 136))
    b64 = lambda x: base64.b64encode(x).decode()
    url = lambda x: base64.urlsafe_b64encode(x).decode().rstrip("=")
    for key in (rsa, wrapped, ssh):
        text = f"é key {b64(key)} end"
        assert ("base64_key", 6, 6 + len(b64(key))) in [s[:3] for s in secrets.find(text)]
        assert not any(s[0] == "base64_key" for s in secrets.find(f"x {b64(key[:-1])} y"))
        lines = "\n".join(b64(key)[i : i + 64] for i in range(0, len(b64(key)), 64))
        assert any(s[0] == "pem_key" for s in secrets.find(f"-----BEGIN PRIVATE KEY-----\n{lines}\n-----END PRIVATE KEY-----"))
    assert any(s[0] == "hex_key" for s in secrets.find(f"({rsa.hex().upper()})"))
    assert not any(s[0] == "hex_key" for s in secrets.find(rsa.hex()[:-2].upper()))
    token = ".".join((url(json.dumps({"alg": "HS256"}).encode()), url(b'{"sub":1}'), url(b"s" * 32)))
    assert any(s[0] == "signed_token" for s in secrets.find(f"a {token} b"))
    for wrong in (token[:-4], token.replace("eyJ", "eyK", 1), ".".join((url(b'{"alg":["x"]}'), url(b"{}"), url(b"s" * 32)))):
        assert not any(s[0] == "signed_token" for s in secrets.find(f"a {wrong} b"))


def test_keys_are_found_whatever_stands_beside_them():
    import base64
    import json

    def tlv(tag, body):
        return bytes([tag]) + (bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")) + body

    rsa = tlv(0x30, b"".join(tlv(2, b"\x01" * n) for n in (1, 64, 3, 64, 32, 32, 32, 32, 32)))
    curve = tlv(0x30, tlv(2, b"\x01") + tlv(4, b"\x07" * 32))
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (b"p" * 51, b"\xffs" * 68))
    for key in (rsa, curve, ssh):
        for kind, body in (("base64_key", base64.b64encode(key).decode()), ("base64_key", base64.urlsafe_b64encode(key).decode().rstrip("=")), ("hex_key", key.hex()), ("hex_key", key.hex().upper())):
            for before, after in (("PRIVATE_KEY=", "\n"), ('SSH_KEY="', '"'), ("key: '", "'"), ("k:", ","), ('{"k": "\\n', '\\n"}'), ("a\\r\\n", "\\r"), ("x == ", " =="), ("", "")):
                text = before + body + after
                assert (kind, len(before), len(before) + len(body)) in [s[:3] for s in secrets.find(text)], text
                assert secrets.redact(text) == before + "[REDACTED]" + after
            assert not any(s[0] == kind for s in secrets.find(f"KEY={body[: len(body) // 2]}"))
        lines = [base64.b64encode(key).decode()[i : i + 64] for i in range(0, len(base64.b64encode(key)), 64)]
        pem = "\n".join(["-----BEGIN PRIVATE KEY-----", *lines, "-----END PRIVATE KEY-----", ""])
        for text in (json.dumps({"private_key": pem}), json.dumps(json.dumps({"private_key": pem})), json.dumps({"private_key": pem}).replace("/", "\\/"), pem.replace("\n", "\\r\\n")):
            assert any(s[0] == "pem_key" for s in secrets.find(text)), text
            assert not any(line in secrets.redact(text) for line in lines)


def test_language_counts_and_accuracy(spark, documents, rows):
    learned = documents.filter(remainder(F.col("doc_id"), 5) != 0)
    got = {(r.lang, r.code): r.n for r in language.quadruples(learned, "lang", "text").collect()}
    want = Counter()
    for d, t, name in rows:
        if not held(d, 5) and name and t is not None:
            line, last = [0, 0, 0], None
            for b in t.lower().encode():
                c = b - 96 if 97 <= b <= 122 else b - 101 if b >= 128 else 0
                if not (c == 0 and last == 0):
                    line.append(c)
                    last = c
            for i in range(3, len(line)):
                want[name, ((line[i - 3] * 155 + line[i - 2]) * 155 + line[i - 1]) * 155 + line[i]] += 1
    assert got == dict(want)
    sf = "/root/testdata/sf0.01"
    found = plans.QUERIES["op5_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").filter("held_out AND length(text) > 60")
    right, n = found.select(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert right >= 0.97 * n


def test_language_model_is_a_distribution(documents):
    model = language.fit(documents)
    total = np.exp(-model.cost).sum(1)
    assert np.allclose(total, 1, atol=1e-3)
    marks = documents.select("doc_id", language.identify(documents, model, F.col("text")).alias("p")).filter("doc_id >= 9001").collect()
    by = {r.doc_id: r.p for r in marks}
    for d in (9001, 9002, 9003, 9004):
        assert (by[d].lang_pred, by[d].score) == ("und", 0.0)


def _byte_classes(text):
    out = []
    for b in text.lower().encode():
        c = b - 96 if 97 <= b <= 122 else b - 101 if b >= 128 else 0
        if c or not out or out[-1]:
            out.append(c)
    return out


@pytest.mark.parametrize("share, context", [(2e-6, 1e-5), (0.01, 0.02)])
def test_language_code_lengths(spark, monkeypatch, share, context):
    """Code lengths by counting in plain Python; rare letters stay in the short contexts whatever is left out of the long ones."""
    monkeypatch.setattr(language, "LEAST_SHARE", share)
    monkeypatch.setattr(language, "LEAST_CONTEXT", context)
    learned = {"x": ["the cat sat on the mat", "the \u0119 cat; the hat", "", "a"], "y": ["der hund und der mund", "\u00fcber \u00f1u den rest"]}
    rows = [(name, t) for name, texts in learned.items() for t in texts] + [("y", None), (None, "zzz")]
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"))
    count = {name: Counter() for name in learned}  # by context, shortest first, then byte
    for name, texts in learned.items():
        for t in texts:
            line = [0, 0, 0, *_byte_classes(t)]
            for i in range(3, len(line)):
                count[name].update((tuple(line[i - k : i]), line[i]) for k in range(4))
    total = {name: sum(n for (c, _), n in c4.items() if not c) for name, c4 in count.items()}
    assert model.languages == sorted(learned)
    seen = {0, *(c for one in count.values() for _, c in one)}
    kinds = sorted(seen) + [-1]
    listed = {name: {(c, b): n for (c, b), n in one.items() if len(c) < 3 or n >= share * total[name]} for name, one in count.items()}
    weight = {name: Counter() for name in learned}
    for name, one in listed.items():
        for (c, _), n in one.items():
            weight[name][c] += n
    long = {c for name in learned for c, n in weight[name].items() if len(c) == 3 and n >= context * total[name]}

    def chances(name, c):
        if len(c) == 3 and c not in long:
            return chances(name, c[1:])
        lower = chances(name, c[1:]) if c else dict.fromkeys(kinds, 1 / len(kinds))
        own = {b: listed[name][c, b] for b in kinds if (c, b) in listed[name]}
        if not own:
            return lower
        rest = sum(p for b, p in lower.items() if b not in own)
        full = sum(own.values()) + (len(own) if rest > 0 else 0)
        return {b: own[b] / full if b in own else len(own) / full * p / rest for b, p in lower.items()}

    tests = ["the hund \u0119", "\u00fcber the mat", "qq \u4e2d", "", "cat"]
    got = model.lengths(tests)
    for i, t in enumerate(tests):
        line = [0, 0, 0, *[b if b in seen else -1 for b in _byte_classes(t)]]
        for j, name in enumerate(model.languages):
            want = -sum(math.log(chances(name, tuple(line[k - 3 : k]))[line[k]]) for k in range(3, len(line)))
            assert math.isclose(got[i, j], want, rel_tol=1e-4, abs_tol=1e-4), (t, name)


def test_lm_base_scores_and_counts(documents, rows):
    got = lm.score(lm.split(documents)).collect()
    tokens = lambda t: WORD.findall(lower(t or ""))
    train = [tokens(t) for d, t, _ in rows if not held(d, 10)]
    c = Counter(w for ws in train for w in ws)
    n, v = sum(c.values()) + len(train), len(c) + 1
    p = lambda k: math.log10((k + 0.1) / (n + 0.1 * (v + 1)))
    want = sorted((d is None, d or 0, held(d, 10), len(tokens(t)) + 1, sum(c[w] > 0 for w in tokens(t)) + 1, sum(p(c[w]) for w in tokens(t)) + p(len(train))) for d, t, _ in rows)
    have = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.base_score) for r in got)
    assert [x[:5] for x in have] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in have], [x[5] for x in want], rtol=1e-9)
    assert {r.train_tokens for r in got} == {n}
    assert all(-1e9 < r.score < 0 for r in got)


def test_lm_tells_rare_words_and_pairs(spark, monkeypatch):
    """A word seen twice and a pair seen once are scored as such, however many other tokens there are, and by any number of parts."""
    fill = [(i, " ".join(f"f{j}" for j in range(i % 7, 997, 2)), False) for i in range(2200)]
    rows = [*fill, (-1, "alpha beta", False), (-2, "alpha gamma", False), (-3, "alpha beta", True), (-4, "alpha delta", True), (-5, "delta alpha", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3, "doc_id")
    c, pairs = Counter(), Counter()
    for _, t, _ in [r for r in rows if not r[2]]:
        c.update(ws := t.split())
        pairs.update(zip(ws, ws[1:]))
    n, v, n_docs = sum(c.values()) + len(fill) + 2, len(c) + 1, len(fill) + 2
    assert n > 1_000_000 and c["alpha"] == 2 and pairs["alpha", "beta"] == 1
    about = lambda k: 2 ** ((math.floor(2 * math.log2(k)) + 0.5) / 2) if k else 0.0
    alone = lambda k: (k + 0.1) / (n + 0.1 * (v + 1))

    def want(ws):
        p = [alone(about(c[w])) for w in ws]
        for i in range(1, len(ws)):
            if c[ws[i - 1]]:
                p[i] = 0.5 * p[i] + 0.5 * min(about(pairs[ws[i - 1], ws[i]]) / about(c[ws[i - 1]]), 1)
        return sum(map(math.log10, p)) + math.log10(alone(n_docs))

    for least in (1, 256):
        monkeypatch.setattr(lm, "LEAST_PARTS", least)
        got = {r.doc_id: r.score for r in lm.score(docs).collect()}
        few = [r for r in rows if r[0] < 0 or r[0] % 100 == 0]
        assert all(abs(got[d] / want(t.split()) - 1) < 5e-3 for d, t, _ in few)  # now and then a step too high
        assert abs(got[-3] - want(["alpha", "beta"])) < 1e-6 and got[-3] > got[-4] + 2


def test_filter_gives_counts_back():
    rng = np.random.default_rng(4)
    grams, counts = rng.integers(0, 1 << 63, 20_000).astype(np.uint64), rng.zipf(1.4, 20_000).clip(1, 10**9) * 5
    held_ = lm.Filter(grams, counts, 5)
    told = held_.ask(grams)
    assert (told >= counts / 2**0.5 / 1.0001).all() and np.mean(told <= counts * 2**0.5) > 0.99
    assert np.mean(held_.ask(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)) > 0) < 0.02


def test_decontamination_finds_altered_passages(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").withColumn("seed", F.lit(1))
    items = [(r.item_id, r.text) for r in bench.collect()]
    planted, rng = [], np.random.default_rng(6)
    for k, (item, text) in enumerate(items[:20]):
        words = text.split()
        for i in range(3, len(words), 9):
            words[i] = f"other{k}x{i}"
        planted.append((20_000 + k, " ".join(f"w{x}" for x in rng.integers(0, 999, 30)) + " " + " ".join(words) + " tail", item, len(words)))
    docs = documents.select("doc_id", "text", "key", "seed", "at").unionByName(spark.createDataFrame([(d, t, "x", "x", "x") for d, t, _, _ in planted], "doc_id long, text string, key string, seed string, at string"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}

    def terms(t):
        return [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]

    want = set()
    sides = [(i, terms(t)) for i, t in items]
    for d, t in [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]:
        ws = terms(t)
        for i, own in sides:
            if len(set(ws) & set(own)) < 4 or len(ws) > 20_000:
                continue
            w = min(len(own), 20)
            for shift in range(-len(own) + 1, len(ws)):
                eq = [ws[p + shift] == own[p] if 0 <= p + shift < len(ws) else False for p in range(len(own))]
                if sum(eq) >= 0.8 * w and max(sum(eq[a : a + w]) for a in range(len(own) - w + 1)) >= 0.8 * w:
                    want.add((d, i))
                    break
    assert {(d, i) for d, _, i, n in planted if n >= 12} <= got
    assert got == want
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns
    assert left.count() == docs.filter(~F.col("doc_id").isin([d for d, _ in want]) | F.col("doc_id").isNull()).count()


def test_decontamination_in_blocks(spark, documents, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = Counter(map(tuple, decontaminate.contaminated(documents, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 700)
    assert Counter(map(tuple, decontaminate.contaminated(documents, bench).collect())) == want


def test_empty_tables(spark, documents, nothing, tmp_path):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert packing.pack(nothing, TOKENIZER).count() == 0
    repair.write(nothing, str(tmp_path / "none"), TOKENIZER)
    assert repair.read(spark, str(tmp_path / "none")).count() == 0
    assert quality_rules.judge(nothing).count() == 0 and quality_rules.keep_good(nothing).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0
    assert secrets.scan(nothing).count() == 0 and secrets.redacted(nothing).count() == 0
    assert language.fit(nothing) is None
    assert {r.p.lang_pred for r in documents.select(language.identify(documents, None, F.col("text")).alias("p")).collect()} == {"und"}
    assert lm.score(lm.split(nothing)).count() == 0
    assert decontaminate.contaminated(nothing, bench).count() == 0
    assert decontaminate.clean(documents, bench.limit(0)).count() == documents.count()


def test_hash_of_shingles_is_the_one_of_spark(spark):
    assert spark.sql("SELECT xxhash64('a b c') AS h").first().h & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_digest_of_no_span():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_lm_filter_scores_documents_it_has_not_seen(spark, documents):
    rows = lm.split(documents)
    trained = lm.train(rows)
    assert trained.kept.count() > 1 and trained.kept.filter("octet_length(bits) = 0").count() == 0
    want = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score) for r in lm.score(rows).collect())
    have = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score) for r in trained.score(documents).collect())
    assert have == want
    few = trained.score(documents.filter("doc_id % 7 = 0")).collect()
    assert few and all((False, r.doc_id, r.n_tokens, r.score) in want for r in few)


def plain_overlap(doc, item, window=20, similarity=0.8):
    """The most words of a window of the item that stand in place in the document, however it is laid."""
    n, best = min(len(item), window), 0
    for shift in range(-len(item) + 1, len(doc)):
        equal = [0 <= shift + i < len(doc) and doc[shift + i] == w for i, w in enumerate(item)]
        best = max([best, *(sum(equal[i : i + n]) for i in range(len(item) - n + 1))])
    return best >= math.ceil(round(n * similarity, 9)) and best


def test_decontamination_keeps_its_promise_at_every_length(spark):
    import random

    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items, docs = {}, {}
    for n in range(1, 31):
        items[n] = [f"item{n}"] + words(n - 1)
        for m in range(7):
            changed = list(items[n])
            for i in rng.sample(range(n), min(m, n)):
                changed[i] = f"x{n}y{i}"
            docs[n * 100 + m] = words(rng.randrange(30)) + changed + words(rng.randrange(30))
    docs[1] = items[30][12:]  # the item begins before the text
    docs[2] = items[7] * 300
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()] + [(None, " ".join(items[9])), (3, None), (4, "")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in decontaminate.contaminated(table, bench).collect()}
    want = {(d, i): best for d, dw in docs.items() if d != 2 for i, iw in items.items() if (best := plain_overlap(dw, iw))}
    want[None, 9] = 9
    assert {k: v for k, v in got.items() if k[0] != 2} == want and got[2, 7] == 7
    assert {r.doc_id for r in decontaminate.clean(table, bench).collect()} == {3, 4} | {d for d in docs if not any(k[0] == d for k in got)}


@pytest.mark.parametrize("part", [16, 4096])
def test_decontamination_of_a_repetitive_text(spark, monkeypatch, part):
    monkeypatch.setattr(decontaminate, "PART_WORDS", part)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    item = bench.orderBy("item_id").first()
    docs = spark.createDataFrame([(1, f"{item.text} " * 400), (2, "a " * 5000), (3, item.text)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.similarity) for r in decontaminate.contaminated(docs, bench).collect()}
    assert {(1, item.item_id, 1.0), (3, item.item_id, 1.0)} <= got and not any(d == 2 for d, _, _ in got)


def test_repair_leaves_no_frequent_pair():
    rng = np.random.default_rng(8)
    text = rng.integers(3, 5000, 3000)
    for ids in (np.concatenate([text] * 30 + [rng.integers(3, 5000, 20_000)]), np.full(5000, 9), np.tile([4, 4, 5], 900), np.arange(7), np.zeros(0, np.int64), (rng.zipf(1.3, 30_000) % 60_000)):
        for rules_a_round in (3, 1 << 14):
            rules, sizes, seq = repair.compress(ids, 60_000, most=rules_a_round)
            assert (repair.expand(seq, rules, 60_000) == ids).all() and len(rules) == len(sizes)
            assert (repair.expand(seq, rules, 60_000, sizes) == ids).all()
            _, n = np.unique(seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:], return_counts=True)
            assert not (n >= 8).any()
            for k in rng.integers(0, max(1, len(rules)), 5)[: len(rules)]:
                assert len(repair.expand(np.array([60_000 + k]), rules, 60_000)) == sizes[k]


def test_frequent_pairs_find_their_rules_in_one_round(monkeypatch):
    """Pairs that share a place of the table do not wait for a further round, which would count all pairs again."""
    rng = np.random.default_rng(4)
    for kind, high in ((np.uint32, 1 << 32), (np.uint64, 1 << 49)):
        pairs = rng.integers(0, high, 4000, kind)
        keys = np.unique(rng.choice(pairs, 900, replace=False))
        rng.shuffle(keys)
        pairs = np.concatenate((rng.choice(pairs, 20_000), np.zeros(9, kind)))
        place = {k: i for i, k in enumerate(keys.tolist())}
        for bits in (18, 6):
            monkeypatch.setattr(repair, "TABLE_BITS", bits)
            on, found = repair._looked_up(pairs, keys)
            assert list(zip(on.tolist(), found.tolist())) == [(i, place[p]) for i, p in enumerate(pairs.tolist()) if p in place]
    monkeypatch.undo()
    left, right = (rng.integers(0, 60_000, 6000) for _ in range(2))
    ids = np.tile(np.stack([left, right], axis=1).ravel(), 8)
    waited, sort = [], np.sort
    monkeypatch.setattr(np, "sort", lambda x, *a, **b: waited.append(len(x)) or sort(x, *a, **b))
    rules, sizes, seq = repair.compress(ids, 60_000)
    assert (repair.expand(seq, rules, 60_000, sizes) == ids).all()
    assert sum(n > len(ids) / 3 for n in waited) <= 2


def test_words_are_encoded_by_their_pieces(monkeypatch):
    """Ids are those of the tokenizer; words of known pieces in a new order cost it nothing."""
    from weirflow.llm.tokens import Encoder

    coder, asked = Encoder(TOKENIZER), []
    want = lambda t: [*coder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
    odd = [None, "", " ", "a", " a\x0b\x1cb\x7f", "T\u0308 t\u0308 x\u0308'S", "DON'T don't 'RE''ll", "É×é÷9Ⱥɏɐ İıſ", "中文a1 x,я Жы", "10 2.5,A-b", "<|endoftext|> A", "a\u0085b\u00a0c", "ﬁ ½ ² Ω ΑΣ \U0001f600x"]
    odd += [f"{a}{chr(c)}{b}" for c in range(0x20, 0x300) for a, b in (("", ""), ("Q", "7"), (". ", "'s"))]
    for texts in (pa.array(["é'", *odd, "x"], pa.string()).slice(1, len(odd)), pa.array(odd[::-1], pa.string())):
        assert [x.tolist() for x in coder.encode(texts, 2)] == [want(t) for t in texts.to_pylist()]
    word = Encoder.word
    monkeypatch.setattr(Encoder, "word", lambda self, raw: asked.append(raw) or word(self, raw))
    new = [f"({a}{i}{b}{j}{c}" for a in ("Qed", "rué", "zyx") for b in (",", "--") for c in ("Qed", "rué", "zyx") for i in range(5) for j in range(5)]
    assert [x.tolist() for x in coder.encode(pa.array(new))] == [want(t)[:-1] for t in new]
    assert len(asked) <= 16


def test_token_files_of_many_shards(spark, documents, ids, tmp_path, monkeypatch):
    """Documents longer than a shard go on in the next ones; single documents are fetched without the others."""
    monkeypatch.setattr(repair, "SHARD_IDS", 500)
    path = str(tmp_path / "ids")
    repair.write(documents.repartition(3), path, TOKENIZER)
    files = spark.read.parquet(path)
    assert files.count() > 20 and files.filter(F.exists("docs", lambda d: d["pieces"] > 2)).count() > 2
    got = sorted(repair.read(spark, path).collect(), key=lambda r: r.start)
    assert Counter((r.id, zlib.crc32(r.ids)) for r in got) == Counter((d, crc(i)) for d, i in ids)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    some = [9005, 9008, 3]
    assert sorted((r.id, r.start, bytes(r.ids)) for r in repair.fetch(spark, path, some).collect()) == sorted((r.id, r.start, bytes(r.ids)) for r in got if r.id in some)


def test_secrets_in_encrypted_pem_and_long_runs():
    import base64
    import os
    import time

    lines = base64.encodebytes(os.urandom(64)).decode()
    old = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{'0A' * 16}\n\n{lines}-----END RSA PRIVATE KEY-----"
    assert [s[:3] for s in secrets.find(f"x {old} y") if s[0] == "pem_key"] == [("pem_key", 2, 2 + len(old))]
    one = old.replace("\n", "\\n")
    assert [s[0] for s in secrets.find(one)] == ["pem_key"] and secrets.redact(f"x {old} y") == "x [REDACTED] y"
    for bad in (old.replace("4,ENCRYPTED", "4,CLEAR"), old.replace("0A" * 16, "0A"), old.replace(lines, lines[4:]), old.replace("DEK-Info", "Comment")):
        assert not [s for s in secrets.find(bad) if s[0] == "pem_key"]
    took = {}
    for n in (1 << 20, 1 << 22):
        run = base64.b64encode(np.random.default_rng(1).integers(0, 256, n * 3 // 4, np.uint8).tobytes()).decode()
        start = time.process_time()
        secrets.find(run)
        secrets.find("MII" * (n // 3))
        secrets.find("b3BlbnNzaC1rZXktdjEA" * (n // 20))
        took[n] = time.process_time() - start
    assert took[1 << 22] < 12 * took[1 << 20] + 1 and took[1 << 22] < 20
