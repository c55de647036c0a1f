"""Packing of tokenized documents into sequences of one length, by best-fit decreasing.

Every task packs the rows of its own partition in blocks of a bounded number of ids, so nothing is
shuffled and a retried task packs alike. In a block, texts longer than a window give full windows
first; the rest go, longest first, to the open window with the smallest remaining room that holds
them, found in a segment tree over the capacities. What room stays at the end of a block is filled
with ids cut from its emptiest windows, so all but one are full. The last one is cut into sequences
whose lengths are powers of two, which need no padding.

Null text is an empty text (its end id alone); null ids and repeated rows are packed like any other
row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymart.llm.common import lean
from skymart.llm.tokens import default_path, encoder, with_end

WINDOW = 4096
#: Ids packed together; full windows of long texts leave before that.
BLOCK_IDS = 2_000_000

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, `offset` bigint"
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length")]
    + [("ids", pa.binary())]
    + [(n, pa.int64()) for n in ("doc_tokens", "sequence_id", "offset")]
)


class Capacities:
    """Open windows by remaining room: a segment tree of counts over the rooms 0 to ``window``."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, window: int) -> None:
        self.at[room].append(window)
        self._add(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the smallest room of at least ``need``."""
        node = need + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.count[node]:
                    node += 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.at[room].pop()


@dataclass(slots=True)
class Piece:
    doc: int
    start: int
    length: int


def best_fit(lengths: list[int], window: int) -> list[list[Piece]]:
    """Windows of pieces for texts of these lengths, by best-fit decreasing. None is over-full."""
    windows: list[list[Piece]] = []
    rest: list[Piece] = []
    for doc, length in enumerate(lengths):
        whole = length - length % window
        windows += [[Piece(doc, at, window)] for at in range(0, whole, window)]
        if length > whole:
            rest.append(Piece(doc, whole, length - whole))
    rooms = Capacities(window)
    for piece in sorted(rest, key=lambda p: (-p.length, p.doc)):
        found = rooms.tightest(piece.length)
        if found is None:
            found = window, len(windows)
            windows.append([])
        room, at = found
        windows[at].append(piece)
        if room > piece.length:
            rooms.put(room - piece.length, at)
    return windows


def fill_rooms(windows: list[list[Piece]], window: int) -> list[list[Piece]]:
    """Move ids from the emptiest windows into the rooms of the fullest, then cut the last one."""
    filled = [w for w in windows if sum(p.length for p in w) == window]
    open_ = sorted((w for w in windows if 0 < sum(p.length for p in w) < window), key=lambda w: -sum(p.length for p in w))
    low, high = 0, len(open_) - 1
    while low < high:
        target, source = open_[low], open_[high]
        room = window - sum(p.length for p in target)
        while room and source:
            piece = source[-1]
            if piece.length <= room:
                target.append(source.pop())
                room -= piece.length
            else:
                target.append(Piece(piece.doc, piece.start, room))
                source[-1] = Piece(piece.doc, piece.start + room, piece.length - room)
                room = 0
        if not room:
            low += 1
        if not source:
            high -= 1
    last = open_[low : high + 1]
    done = filled + open_[:low]
    for pieces in last:
        size = sum(p.length for p in pieces)
        while size:
            part = 1 << (size.bit_length() - 1)
            sequence, room = [], part
            while room:
                piece = pieces.pop()
                took = min(piece.length, room)
                sequence.append(Piece(piece.doc, piece.start, took))
                if took < piece.length:
                    pieces.append(Piece(piece.doc, piece.start + took, piece.length - took))
                room -= took
            done.append(sequence)
            size -= part
    return done


class _Block:
    """Rows waiting to be packed."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.next = window, first_sequence
        self._clear()

    def _clear(self) -> None:
        self.doc_ids: list[int | None] = []
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.ids.append(ids)
        self.size += len(ids)

    def pack(self) -> pa.RecordBatch:
        rows: list[tuple] = []
        for sequence in fill_rooms(best_fit([len(i) for i in self.ids], self.window), self.window):
            offset = 0
            for p in sequence:
                ids = self.ids[p.doc]
                part = ids[p.start : p.start + p.length].astype("<u4").tobytes()
                rows.append((self.doc_ids[p.doc], p.start, p.length, part, len(ids), self.next, offset))
                offset += p.length
            self.next += 1
        self._clear()
        columns = zip(*rows) if rows else [[]] * len(_ARROW)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
        )


def pack(
    docs: DataFrame, *, window: int = WINDOW, end_id: int = 2, tokenizer: str | None = None, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """One row per piece of the packed ``docs`` (doc_id, text).

    ``ids`` holds the piece's ids as little-endian 32-bit integers, ``start`` its place in the
    document's ids (the end id included), ``offset`` its place in the sequence. Sequence ids are
    unique; sequences are gapless, and shorter than ``window`` only with a power of two of ids.
    """
    path = tokenizer or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block = _Block(window, (context.partitionId() if context else 0) << 40)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, counts = with_end(*encoder(path).encode(part.column(1)), end_id)
                ends = np.cumsum(counts)
                for doc_id, a, b in zip(part.column(0).to_pylist(), ends - counts, ends):
                    block.add(doc_id, ids[a:b])
                    if block.size >= block_ids:
                        yield block.pack()
        if block.size:
            yield block.pack()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(lean(run, "encoders"), SCHEMA)
