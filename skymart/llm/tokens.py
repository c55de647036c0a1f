"""Token ids of whole texts, each distinct word encoded once.

The vocabulary's own splitting never joins anything across white space, takes digits one by one and
keeps letters and other signs apart. So a text's ids are those of its words, and a plain word's ids
are those of its runs. The tokenizers library encodes every distinct run or word once; a batch's ids
are then put together with numpy. Plain are ASCII and the letters U+00C0 to U+00FF; words with
anything else (other scripts, composing marks, apostrophes, ``<``, control characters) go to the
library whole and unchanged. Tests compare with whole-text encoding.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from skymart.llm import words
from skymart.llm.common import CACHES, text_buffer

#: Entries of the word cache of one Python worker before it starts anew.
CACHE_WORDS = 600_000
#: Text looked up at once. A dozen arrays of 64-bit numbers of this length, and the kept powers of
#: the hashes, are alive in every Python worker, beside what earlier steps left there.
SLICE_BYTES = 256 << 10

_LETTER, _DIGIT, _SIGN, _WHOLE = 1, 2, 3, 4
_KIND = np.full(256, _WHOLE, np.uint8)
_KIND[33:127] = _SIGN
_KIND[97:123] = _LETTER
_KIND[65:91] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[39, 60]] = _WHOLE
_KIND[words.WHITE] = 0
_LATIN = np.zeros(256, bool)  # second bytes of the letters U+00C0 to U+00FF
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False

_ENCODERS: dict[str, Encoder] = CACHES.setdefault("encoders", {})


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in byte-level vocabularies: itself if printable, else 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_SIGNS = _byte_signs()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _spelled(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kinds of the bytes, and the bytes with plain letters lower-cased."""
    kind, low = _KIND[data], words.LOWERED[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
    lead = lead[_LATIN[data[lead + 1]]]
    kind[lead] = kind[lead + 1] = _LETTER
    capital = lead[data[lead + 1] < 0x9F] + 1
    low[capital] += 0x20
    return kind, low


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self._clear()

    def _clear(self) -> None:
        """Known words by sorted hash, with a second hash; their ids lie in ``flat``."""
        self.hashes, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _ids(self, word: bytes, whole: bool) -> list[int]:
        if whole:
            return self.whole.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        text = word.decode() if word.isascii() else word.decode("latin-1").translate(_BYTE_SIGNS)
        return [t.id for t in self.model.tokenize(text)]

    def _learn(self, hashes, checks, found: list[list[int]]) -> None:
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(size.sum()))
        begin = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, flat])
        joined = np.concatenate([self.hashes, hashes])
        order = np.argsort(joined, kind="stable")
        self.hashes = joined[order]
        self.checks = np.concatenate([self.checks, checks])[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.size = np.concatenate([self.size, size])[order]

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hashes, hashes)
        if not len(self.hashes):
            return at, np.zeros(len(hashes), bool)
        at = np.minimum(at, len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def _rows_whole(self, part: words.Slice) -> tuple[np.ndarray, np.ndarray]:
        """The slow way, for a slice in which two different words have one hash."""
        ids, counts = [np.zeros(0, np.uint32)], np.zeros(part.last - part.first, np.int64)
        for a, b, row in zip(part.starts, part.ends, part.rows):
            got = self._ids(part.data[a:b].tobytes(), True)
            ids.append(np.array(got, np.uint32))
            counts[row - part.first] += len(got)
        return np.concatenate(ids), counts

    def _slice(self, part: words.Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice and how many of them belong to each of its rows."""
        n_rows = part.last - part.first
        if not len(part.starts):
            return np.zeros(0, np.uint32), np.zeros(n_rows, np.int64)
        data = part.data
        kind, low = _spelled(data)
        odd = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind == _WHOLE, out=odd[1:])
        whole = odd[part.ends] > odd[part.starts]
        depth = np.zeros(len(data) + 1, np.int8)
        depth[part.starts[whole]] += 1
        depth[part.ends[whole]] -= 1
        in_whole = np.cumsum(depth[:-1], dtype=np.int8) > 0
        cut = kind == _DIGIT
        cut[1:] |= kind[1:] != kind[:-1]
        cut &= (kind != 0) & ~in_whole
        cut[part.starts] = True
        starts = np.flatnonzero(cut)
        word = np.searchsorted(part.starts, starts, "right") - 1
        ends = np.minimum(np.append(starts[1:], len(data)), part.ends[word])
        # A whole word keeps its case: composing marks may differ between a letter and its capital.
        low[in_whole] = data[in_whole]
        h = words.span_hashes(low, starts, ends)
        checks = words.span_hashes(low, starts, ends, words.BASES[1])
        distinct, some, unit = np.unique(h, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > max(CACHE_WORDS, len(distinct)):
            self._clear()
        at, hit = self._find(distinct)
        if not hit.all():
            new = some[~hit]
            raw, slow = low.tobytes(), whole[word[new]].tolist()
            spans = zip(starts[new].tolist(), ends[new].tolist(), slow)
            self._learn(distinct[~hit], checks[new], [self._ids(raw[a:b], s) for a, b, s in spans])
            at, hit = self._find(distinct)
        if (self.checks[at][unit] != checks).any():
            return self._rows_whole(part)
        size, begin = self.size[at][unit], self.begin[at][unit]
        stop = np.cumsum(size)
        take = np.arange(stop[-1]) + np.repeat(begin - (stop - size), size)
        rows = np.bincount(part.rows[word] - part.first, weights=size, minlength=n_rows).astype(np.int64)
        return self.flat[take], rows

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and the number of ids of each. Null is empty."""
        data, offsets = text_buffer(texts)
        ids, counts = [np.zeros(0, np.uint32)], np.zeros(len(offsets) - 1, np.int64)
        for part in words.slices(data, offsets, lower=False, limit=SLICE_BYTES):
            got, rows = self._slice(part)
            ids.append(got)
            counts[part.first : part.last] += rows
        return np.concatenate(ids), counts


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Put ``end_id`` behind every text."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1
