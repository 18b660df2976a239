"""Token ids of whole texts, with the pieces of words that recur encoded once per worker.

White space only separates words for the tokenizers used here, so the ids of a text are those of its words in
order. Plain words fall into runs of letters, single digits and runs of other signs, which are found for a block of
texts at once; other words stay whole. Arrow finds the distinct ones of a block; those not met before go to the
tokenizer's model. Texts that may hold a special token's string go to the tokenizer whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from weirflow.llm.common import strings

#: Latin words and ASCII signs; the apostrophe is left out because some splits depend on it.
PLAIN = re.compile("[!-&(-~À-ɏ]*")
#: What a byte is: of white space, of a letter, a digit, of another plain sign, of anything else, or the first of a plain sign's two.
BLANK, LETTER, DIGIT, SIGN, ODD, PAIR = range(6)
#: Pieces and words in a generation of what a worker keeps; two generations are some 100 MB.
WORDS_KEPT = 6 << 16
BLOCK_BYTES = 6 << 20


def _byte_signs() -> dict[int, str]:
    """The printable sign that byte-level vocabularies use for each byte: itself, or the next above 255."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Kinds of the bytes, of which those above 127 that start no sign count as letters, and of the signs of two bytes after ``PAIR``."""
    one = np.full(256, ODD, np.uint8)
    one[33:127] = [SIGN if PLAIN.fullmatch(chr(c)) else ODD for c in range(33, 127)]
    one[[*b" \t\n\v\f\r"]] = BLANK
    one[[*b"0123456789"]] = DIGIT
    one[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(0x80, 0xC0)]] = LETTER
    one[0xC3:0xCA] = PAIR
    two = [(LETTER if chr(c).isalpha() else SIGN) if PLAIN.fullmatch(chr(c)) and PLAIN.fullmatch(chr(c).lower()) else ODD for c in range(0x280)]
    return one, np.array(two, np.uint8)


KINDS, KINDS_OF_PAIRS = _kinds()


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of plain words, A-Z lower-case, and the other words of all texts in order, and how many of them come before each text and before the end."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    if bounds[-1] == bounds[0]:
        return pa.array([], pa.string()), np.zeros(len(bounds), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    kind = KINDS[data]
    pair = np.flatnonzero(kind == PAIR)
    kind[pair] = kind[pair + 1] = KINDS_OF_PAIRS[(data[pair] & 31).astype(np.int64) << 6 | data[pair + 1] & 63]
    blank, odd = kind == BLANK, kind == ODD
    new = kind == DIGIT
    new[1:] |= kind[1:] != kind[:-1]
    text = bounds[:-1][bounds[:-1] < len(data)]
    new[text] = True
    lower = ((data >= ord("A")) & (data <= ord("Z"))).view(np.uint8)
    if odd.any():  # words with an odd sign stay as they are
        start = ~blank
        start[1:] &= blank[:-1]
        start[text] = ~blank[text]
        word = np.cumsum(start, dtype=np.int32)
        whole = np.zeros(word[-1] + 1, bool)
        whole[word[odd]] = True
        whole = whole[word]
        new &= start | blank | ~whole
        lower &= ~whole
    at = np.flatnonzero(new)
    shown = ~blank[at]
    ends = np.cumsum(np.append(0, np.diff(np.append(at, len(data)))[shown])).astype(np.int32)
    items = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer((data | lower << 5)[~blank]))
    return items, np.searchsorted(at[shown], bounds)


class Encoder:
    """Encodes Arrow strings with the tokenizer in file ``path`` (lower case, white space dropped, byte-level BPE)."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == array("H").itemsize else "I"
        self.signs = _byte_signs()
        self.words, self.older_words = {}, {}

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def piece(self, s: str) -> bytes:
        shown = s if s.isascii() else s.encode().decode("latin-1").translate(self.signs)
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def word(self, raw: bytes) -> bytes:
        """Ids of a piece of a plain word or of another word."""
        text = raw.decode()
        low = text.lower()
        return self.piece(low) if PLAIN.fullmatch(text) and (low == text or PLAIN.fullmatch(low)) else self.direct(text)

    def table(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all that :func:`cut` found in a row, first place and number of ids of each."""
        # A full generation becomes the older one, from which words in use move on to the next.
        if len(self.words) > WORDS_KEPT:
            self.words, self.older_words = {}, self.words
        known, older, found = self.words, self.older_words, []
        for w in strings(distinct):
            if (ids := known.get(w)) is None:
                ids = older.get(w)
                ids = known[w] = self.word(w) if ids is None else ids
            found.append(ids)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        return np.frombuffer(b"".join(found), self.kind), np.cumsum(sizes) - sizes, sizes

    def encode(self, texts: pa.Array, end: int | None = None) -> list[np.ndarray]:
        """Ids of each text, null as empty, ``end`` appended to each."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|")
        items, bounds = cut(pc.if_else(special, "", texts))
        coded = pc.dictionary_encode(items)
        pool, first, sizes = self.table(coded.dictionary)
        index = coded.indices.to_numpy(zero_copy_only=False)
        tail = np.array([] if end is None else [end], self.kind)
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):  # some documents at a time, so that the index arrays stay small
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + (1 << 18), "right")) - 1)
            part = index[bounds[at] : bounds[to]]
            each = sizes[part]
            upto = np.concatenate(([0], np.cumsum(each)))
            ids = pool[np.repeat(first[part] - upto[:-1], each) + np.arange(upto[-1])]
            cuts = upto[bounds[at : to + 1] - bounds[at]].tolist()
            out += [np.concatenate((ids[a:b], tail)) for a, b in zip(cuts, cuts[1:])]
            at = to
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)):
            out[i] = np.concatenate((np.frombuffer(self.direct(texts[int(i)].as_py()), self.kind), tail))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker, so that its words outlive a task."""
    return Encoder(path)


def blocks(batches: Iterator[pa.RecordBatch], text: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        upto = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
