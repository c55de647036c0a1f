"""Maximal periodic stretches of words (runs) in every text, by suffix trees of text and reversal.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
``LEAST_WORDS`` long and ``LEAST_POWER`` times its period, which no neighbouring word extends.

1. Ukkonen's algorithm builds the suffix tree of a word sequence and that of its reversal in linear
   time. An Euler tour of each makes the longest common extension of two places, rightwards or
   leftwards, the minimum of a range, answered in constant time from block minima.
2. The longest Lyndon word at each place, by the order of words and by its inverse, ends before the
   next smaller suffix, read off the leaf order. Every run has such a word as a root, so these
   2 n words, extended both ways, give all runs. Lyndon words have no border: their length is the
   smallest period.
3. All windows of ``GRAM`` words inside a run occur twice in the text. Stretches of windows that do
   hold all runs whole, and only they get trees; other texts have no run.

Texts are worked on where they lie, row by row, without a shuffle; memory follows the longest text.
Null and empty texts have no words and no runs. Null ids, repeated ids and repeated rows are texts
like any other. Words are compared as they are, byte by byte. Among equally strong runs the one that
starts first counts, then the one of the shorter period. Extra columns are ignored; empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymart.llm import words
from skymart.llm.common import rows_by_bytes, text_buffer

LEAST_WORDS, LEAST_POWER = 24, 3
#: With a length of 24 and three periods, every window of nine words has its like one period away.
GRAM = 9
SLICE_BYTES, BLOCK = 2 << 20, 16

Run = tuple[int, int, int]


class SuffixTree:
    """Ukkonen's tree of ``t``, whose symbols are above zero; zero ends it."""

    def __init__(self, t: list[int]):
        self.n = len(t)
        t = [*t, 0]
        size, k = len(t), max(t) + 1
        begin, stop, link, go = [0], [0], [0], {}
        node = edge = length = waiting = 0
        for i, c in enumerate(t):
            waiting += 1
            inner = 0
            while waiting:
                if not length:
                    edge = i
                key = node * k + t[edge]
                child = go.get(key)
                if child is None:
                    go[key] = len(begin)
                    begin.append(i)
                    stop.append(size)
                    link.append(0)
                    if inner:
                        link[inner] = node
                        inner = 0
                else:
                    at = begin[child]
                    span = stop[child] - at
                    if length >= span:
                        node, edge, length = child, edge + span, length - span
                        continue
                    if t[at + length] == c:
                        length += 1
                        if inner:
                            link[inner] = node
                        break
                    split = len(begin)
                    begin += (at, i)
                    stop += (at + length, size)
                    link += (0, 0)
                    go[key] = split
                    go[split * k + c] = split + 1
                    begin[child] = at + length
                    go[split * k + t[at + length]] = child
                    if inner:
                        link[inner] = split
                    inner = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        keys = np.fromiter(go.keys(), np.int64, len(go))
        children = np.fromiter(go.values(), np.int64, len(go))
        order = np.argsort(keys)
        parents = keys[order] // k
        self._children = children[order].tolist()
        self._ended = (keys[order] % k == 0).tolist()
        self._bounds = np.searchsorted(parents, np.arange(len(begin) + 1)).tolist()
        self._span = (np.array(stop) - np.array(begin)).tolist()
        self._tour()

    def _tour(self) -> None:
        """Depths along the Euler tour, and where each suffix's leaf stands in it."""
        children, bounds, span, size = self._children, self._bounds, self._span, self.n + 1
        depth, tour, leaf_at, leaves = [0] * len(span), [], [0] * size, []
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:
                tour.append(depth[~v])
                continue
            d = depth[v]
            a, b = bounds[v], bounds[v + 1]
            if a == b:
                leaves.append(size - d)
                leaf_at[size - d] = len(tour)
            tour.append(d)
            for child in children[a:b][::-1]:
                depth[child] = d + span[child]
                stack.append(~v)
                stack.append(child)
        self._leaf_at = np.array(leaf_at)
        self.order = np.array(leaves)
        n_blocks = -(-len(tour) // BLOCK)
        padded = np.full(n_blocks * BLOCK, size, np.int32)
        padded[: len(tour)] = tour
        blocks = padded.reshape(n_blocks, BLOCK)
        self._depths = padded
        self._to_here = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        self._from_here = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self._table = [blocks.min(axis=1)]
        while 2 << (len(self._table) - 1) <= n_blocks:
            half = 1 << (len(self._table) - 1)
            self._table.append(np.minimum(self._table[-1][:-half], self._table[-1][half:]))

    def inverse_order(self) -> np.ndarray:
        """Leaves by the inverse order of symbols, the end still being the smallest."""
        children, bounds, depth, size = self._children, self._bounds, [0] * len(self._span), self.n + 1
        span, leaves, stack = self._span, [], [0]
        while stack:
            v = stack.pop()
            a, b = bounds[v], bounds[v + 1]
            if a == b:
                leaves.append(size - depth[v])
                continue
            d = depth[v]
            row = children[a:b]
            for child in row:
                depth[child] = d + span[child]
            # The last one put on the stack comes first: the end, or else the greatest symbol.
            stack += [*row[1:], row[0]] if self._ended[a] else row
        return np.array(leaves)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j (different ones)."""
        a, b = self._leaf_at[i], self._leaf_at[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        p, q = a // BLOCK, b // BLOCK
        out = np.minimum(self._from_here[a], self._to_here[b])
        gap = q - p - 1
        level = np.zeros(len(gap), np.int64)
        some = gap > 0
        level[some] = np.log2(gap[some]).astype(np.int64)
        for at in np.unique(level[some]).tolist():
            own = np.flatnonzero(some & (level == at))
            row = self._table[at]
            inner = np.minimum(row[p[own] + 1], row[q[own] - (1 << at)])
            out[own] = np.minimum(out[own], inner)
        near = np.flatnonzero(p == q)
        for start in range(0, len(near), 1 << 16):
            own = near[start : start + (1 << 16)]
            place = a[own][:, None] + np.arange(BLOCK)
            inside = place <= b[own][:, None]
            depths = self._depths[np.minimum(place, len(self._depths) - 1)]
            out[own] = np.where(inside, depths, self.n + 1).min(axis=1)
        return out


def next_smaller(order: np.ndarray) -> np.ndarray:
    """For each suffix, where the next smaller one behind it begins. The end is the smallest."""
    n = len(order) - 1
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.arange(n + 1)
    ranks, out, stack = rank.tolist(), [n] * n, [n]
    for i in range(n - 1, -1, -1):
        r = ranks[i]
        while ranks[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(t: list[int], least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER) -> np.ndarray:
    """start, length, period of the runs of ``t``, by start and period."""
    n = len(t)
    if n < max(least_words, 2):
        return np.zeros((0, 3), np.int64)
    tree, back = SuffixTree(t), SuffixTree(t[::-1])
    found = []
    for order in (tree.order, tree.inverse_order()):
        i = np.arange(n)
        j = next_smaller(order)
        period = j - i
        some = least_power * period <= n
        i, j, period = i[some], j[some], period[some]
        right, left = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        inside = j < n
        right[inside] = tree.common(i[inside], j[inside])
        inside = i > 0
        left[inside] = back.common(n - i[inside], n - j[inside])
        start, length = i - left, j + right - i + left
        long = length >= np.maximum(least_words, least_power * period)
        found.append(np.stack([start[long], length[long], period[long]], axis=1))
    out = np.unique(np.concatenate(found), axis=0)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest length by period, exactly; then the first, then the shorter period."""

    def compare(x: Run, y: Run) -> int:
        return y[1] * x[2] - x[1] * y[2] or x[0] - y[0] or x[2] - y[2]

    return min(runs, key=cmp_to_key(compare), default=None)


def _stretches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Words of each text, and the stretches (first word, end) whose windows all occur twice in it."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part in words.slices(data, offsets, lower=False):
        hashes.append(words.span_hashes(part.data, part.starts, part.ends))
        rows.append(part.rows)
    h, row = np.concatenate(hashes), np.concatenate(rows)
    n_rows = len(offsets) - 1
    bounds = np.searchsorted(row, np.arange(n_rows + 1))
    found: list[list[tuple[int, int]]] = [[] for _ in range(n_rows)]
    if len(h) < GRAM:
        return np.diff(bounds), found
    with np.errstate(over="ignore"):
        window, width = h, 1
        while 2 * width <= GRAM:
            window = words.mix(window[:-width] * words.MIX[0] + window[width:])
            width *= 2
        for more in range(width, GRAM):
            window = words.mix(window[:-1] * words.MIX[0] + h[more:])
        window = words.mix(window + row[: len(window)].astype(np.uint64) * words.MIX[1])
    inside = row[: len(window)] == row[GRAM - 1 :]
    at = np.flatnonzero(inside)
    order = at[np.argsort(window[at])]
    same = np.flatnonzero(window[order[1:]] == window[order[:-1]])
    twice = np.zeros(len(window) + 2, bool)
    twice[order[same] + 1] = twice[order[same + 1] + 1] = True
    new_row = np.zeros(len(window) + 2, bool)
    new_row[bounds[:-1][bounds[:-1] < len(window)] + 1] = True
    begin = np.flatnonzero(twice[1:-1] & (~twice[:-2] | new_row[1:-1]))
    end = np.flatnonzero(twice[1:-1] & (~twice[2:] | new_row[2:])) + GRAM
    for a, b, r in zip(begin.tolist(), end.tolist(), row[begin].tolist()):
        if b - a >= LEAST_WORDS:
            found[r].append((a - int(bounds[r]), b - int(bounds[r])))
    return np.diff(bounds), found


def _runs_in(tokens: list[bytes], stretches: list[tuple[int, int]]) -> list[Run]:
    out: list[Run] = []
    for a, b in stretches:
        known: dict[bytes, int] = {}
        ids = [known.setdefault(token, len(known) + 1) for token in tokens[a:b]]
        out += [(a + s, length, period) for s, length, period in runs_of(ids).tolist()]
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(tokens: list[bytes], runs: list[Run]) -> bytes:
    if runs:
        gone = bytearray(len(tokens))
        for start, length, period in runs:
            gone[start + period : start + length] = b"\1" * (length - period)
        tokens = [token for token, g in zip(tokens, gone) if not g]
    return b" ".join(tokens)


SCHEMA = (
    "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
    "strongest struct<start:bigint,length:bigint,period:bigint>, collapsed string"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), the strongest one (null without), and the
    collapsed text: its words joined by one space, without those behind the first period of a run.
    """

    def named(run: Run | None) -> dict | None:
        return run and dict(zip(("start", "length", "period"), run))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, b in rows_by_bytes(offsets, SLICE_BYTES):
                part = offsets[a : b + 1] - offsets[a]
                raw = data[offsets[a] : offsets[b]]
                sizes, stretches = _stretches(raw, part)
                raw = raw.tobytes()
                runs, best, texts = [], [], []
                for i in range(b - a):
                    tokens = raw[part[i] : part[i + 1]].split()  # the same white space as the word rule
                    own = _runs_in(tokens, stretches[i])
                    runs.append([named(r) for r in own])
                    best.append(named(strongest(own)))
                    texts.append(_collapsed(tokens, own))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(sizes),
                        pa.array(runs, pa.list_(_RUN)),
                        pa.array(best, _RUN),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "strongest", "collapsed"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
