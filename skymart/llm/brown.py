"""Language-model scores by class-based bigrams, after Brown.

P(word | before) = P(class | class before) * P(word | class). The end of a text is a token of a
class of its own, and stands before the first word as well.

Every word that training texts hold ``LEAST`` times gets its class from its own neighbours. First
come the words with at least ``SHARE`` of all training tokens (at most 1 / SHARE of them, however
large the corpus); with ``ENDINGS`` groups of all other words by their last two bytes they are units
of a distributed exchange clustering: in each round, every task moves its units one by one to the
class that gives the greatest likelihood, under its own copy of the class counts; half of the units
may move in a round. The best assignment of all rounds stays. Then each other word's neighbours are
counted by class, and it goes from its group's class to the one of greatest likelihood, all words
under the same class counts, so that it doesn't matter which task has which. The classes of words
are a table. Only words rarer than ``LEAST``, and unknown ones, stay with their group.

Class transitions and emissions are smoothed by absolute discounting: transitions fall back to the
class frequencies; what emissions give up goes to the unknown word, which counts as one more word,
as in the base score. So the probabilities of all known words and the unknown one sum to one.

Counts of all words are exact and cover all training texts. No table of all words is sent anywhere:
texts are dealt into chunks of bounded size once, each chunk's distinct words are looked up by a
join, and texts meet the counts and classes of their own chunk's words again. From there on a token
is a byte, its class and whether it is known; transitions are counted and scored on those.

Null texts are empty (one end token). Null ids are scored, not learned. Repeated rows count and are
scored each. Without training tokens everything is unknown with probability one. An empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart.llm import words
from skymart.llm.common import keep, rows_by_bytes, text_buffer

SHARE = 1e-4
#: Occurrences in training texts from which a word gets a class of its own.
LEAST = 3
ENDINGS = 512
#: At most 127, as a token's class is held in seven bits.
CLASSES = 64
ROUNDS = 8
CHUNK_BYTES = 16 << 20
#: Bytes of text whose tokens are held at once.
HELD_BYTES = 2 << 20
#: Words whose best class is looked for at once.
WORD_BLOCK = 256

#: Key of the end token; words have other 64-bit hashes as keys.
END = np.uint64(0x9B1F4E0D5C3A7E21)
SCHEMA = (
    "doc_id bigint, learned boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


def chunked(docs: DataFrame, learn: Column) -> DataFrame:
    """A written copy of the texts with a chunk number; a chunk has about ``CHUNK_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        chunk, size = (context.partitionId() if context else 0) << 32, 0
        for batch in batches:
            _, offsets = text_buffer(batch.column(2))
            for a, b in rows_by_bytes(offsets, CHUNK_BYTES):
                if size and size + offsets[b] - offsets[a] > CHUNK_BYTES:
                    chunk, size = chunk + 1, 0
                size += int(offsets[b] - offsets[a])
                part = batch.slice(a, b - a)
                number = pa.array(np.full(b - a, chunk, np.int64))
                yield pa.RecordBatch.from_arrays([number, *part.columns], names=["chunk", "doc_id", "learned", "text"])

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(learn, F.lit(False)).alias("learned"),
        F.col("text").cast("string").alias("text"),
    )
    return keep(rows.mapInArrow(run, "chunk bigint, doc_id bigint, learned boolean, text string"), "chunks")


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, ending group and row of every token of a batch, each row's end token included."""
    data, offsets = text_buffer(texts)
    n = len(offsets) - 1
    keys, endings, rows = [], [], []
    for part in words.slices(data, offsets):
        keys.append(words.span_hashes(part.data, part.starts, part.ends))
        last = part.data[part.ends - 1].astype(np.int64)
        before = np.where(part.ends - part.starts > 1, part.data[np.maximum(part.ends - 2, 0)], 0)
        endings.append((last * 31 + before) % ENDINGS)
        rows.append(part.rows)
    flat = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
    rows = flat(rows, np.int64)
    ends = np.searchsorted(rows, np.arange(n), "right")
    return (
        np.insert(flat(keys, np.uint64), ends, END),
        np.insert(flat(endings, np.int64), ends, 0),
        np.insert(rows, ends, np.arange(n)),
    )


def _distinct(texts: pa.Array, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of texts, the ending of each, and its count in the learned ones."""
    found = []
    for a, b in rows_by_bytes(text_buffer(texts)[1], HELD_BYTES):
        keys, endings, rows = tokens(texts.slice(a, b - a))
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        n = np.bincount(inverse, weights=learned[a:b][rows], minlength=len(distinct))
        found.append((distinct, endings[first], n))
    keys, endings, n = (np.concatenate(c) for c in zip(*found))
    distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return distinct, endings[first], np.bincount(inverse, weights=n, minlength=len(distinct)).astype(np.int64)


def _vocabulary(chunks: DataFrame) -> DataFrame:
    """Distinct words of each chunk's batches, with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            learned = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for number in np.unique(numbers):
                at = np.flatnonzero(numbers == number)
                distinct, endings, n = _distinct(batch.column(2).slice(int(at[0]), len(at)), learned[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(distinct), number, np.int64)),
                        pa.array(distinct.view(np.int64)),
                        pa.array(endings.astype(np.int32)),
                        pa.array(n),
                    ],
                    names=["chunk", "key", "ending", "n"],
                )

    return chunks.select("chunk", "learned", "text").mapInArrow(
        run, "chunk bigint, key bigint, ending int, n bigint"
    )


@dataclass
class Units:
    """0: the end; 1 to ENDINGS: groups of words by ending; then the frequent words."""

    keys: np.ndarray  # of the frequent words, sorted
    units: np.ndarray

    @property
    def count(self) -> int:
        return 1 + ENDINGS + len(self.keys)

    def of(self, keys: np.ndarray, endings: np.ndarray) -> np.ndarray:
        unit = np.where(keys == END, 0, 1 + endings)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            unit = np.where(self.keys[at] == keys, self.units[at], unit)
        return unit


def _pairs(chunks: DataFrame, units: Units) -> DataFrame:
    """Counts of adjacent units over all training texts."""
    sent = chunks.sparkSession.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = sent.value
        for whole in batches:
            _, offsets = text_buffer(whole.column(0))
            for a, b in rows_by_bytes(offsets, 2 * HELD_BYTES):
                keys, endings, _ = tokens(whole.column(0).slice(a, b - a))
                unit = units.of(keys, endings)
                codes, n = np.unique(np.append(0, unit[:-1]) * units.count + unit, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((codes // units.count).astype(np.int32)), pa.array((codes % units.count).astype(np.int32)), pa.array(n)],
                    names=["a", "b", "n"],
                )

    rows = chunks.filter("learned").select("text").mapInArrow(run, "a int, b int, n bigint")
    return keep(rows.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(matrix: np.ndarray) -> float:
    """Log likelihood of the classes' part of the model, but for a constant of the words."""
    return float(_phi(matrix).sum() - _phi(matrix.sum(axis=0)).sum() - _phi(matrix.sum(axis=1)).sum())


def best_class(matrix: np.ndarray, after: np.ndarray, before: np.ndarray, movable: int) -> int:
    """Class that gains most by a unit with these neighbour counts by class; the unit is taken out."""
    left, right = matrix.sum(axis=1), matrix.sum(axis=0)
    gain = (_phi(matrix + after) - _phi(matrix)).sum(axis=1)
    gain += (_phi(matrix + before[:, None]) - _phi(matrix)).sum(axis=0)
    gain -= _phi(left + after.sum()) - _phi(left) + _phi(right + before.sum()) - _phi(right)
    return int(gain[:movable].argmax())


def _matrix(pairs: DataFrame, classes: np.ndarray, width: int) -> np.ndarray:
    sent = pairs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width)
        for batch in batches:
            a, b, n = (c.to_numpy() for c in batch.columns)
            total += np.bincount(sent.value[a] * width + sent.value[b], weights=n, minlength=width * width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], names=["code", "n"])

    counts = pairs.select("a", "b", "n").mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    matrix = np.zeros(width * width)
    for row in counts.collect():  # at most width * width rows
        matrix[row.code] = row.n
    return matrix.reshape(width, width)


def cluster(pairs: DataFrame, n_units: int, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every unit by distributed exchange; the end's class is the last one."""
    entry = lambda other: F.struct(F.col(other).alias("o"), "n")
    after = pairs.groupBy(F.col("a").alias("unit")).agg(F.collect_list(entry("b")).alias("after"))
    before = pairs.groupBy(F.col("b").alias("unit")).agg(F.collect_list(entry("a")).alias("before"))
    rows = keep(after.join(before, "unit").filter("unit > 0"), "neighbours")
    width = classes + 1
    current = np.arange(n_units) % classes
    current[0] = classes
    spark = pairs.sparkSession
    best, best_value = current, None
    for round_ in range(rounds + 1):
        matrix = _matrix(pairs, current, width)
        value = likelihood(matrix)
        if best_value is None or value > best_value:
            best, best_value = current, value
        if round_ == rounds:
            return best
        sent = spark.sparkContext.broadcast((current, matrix))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            now, counts = sent.value[0].copy(), sent.value[1].copy()
            for batch in batches:
                for row in batch.to_pylist():
                    unit, sums = row["unit"], []
                    for side in ("after", "before"):
                        others = np.array([e["o"] for e in row[side]])
                        sums.append(np.bincount(now[others], weights=[e["n"] for e in row[side]], minlength=width))
                    counts[now[unit]] -= sums[0]
                    counts[:, now[unit]] -= sums[1]
                    np.maximum(counts, 0, out=counts)  # the unit's pairs with itself count twice
                    now[unit] = best_class(counts, *sums, classes)
                    counts[now[unit]] += sums[0]
                    counts[:, now[unit]] += sums[1]
                units = batch.column(0).to_numpy()
                moved = pa.array(now[units].astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), moved], names=["unit", "class"])

        moves = rows.filter(F.col("unit") % 2 == round_ % 2).select("unit", "after", "before")
        current = current.copy()
        for row in moves.mapInArrow(run, "unit int, class int").collect():  # at most one row per unit
            current[row["unit"]] = row["class"]


def best_classes(matrix: np.ndarray, own: np.ndarray, after: np.ndarray, before: np.ndarray, movable: int) -> np.ndarray:
    """``best_class`` of many words (rows), each taken out of its ``own`` class with all others in place.

    Only neighbour classes that a word has are visited.
    """
    width, n = len(matrix), np.arange(len(own))
    gain = np.zeros((len(own), width))
    for counts, across, side in ((after, before, matrix.T), (before, after, matrix)):
        # side[j]: counts of class j beside every class a word may go to.
        total = counts.sum(axis=1)
        sums = np.repeat(side.sum(axis=0)[None, :], len(own), axis=0) - across
        sums[n, own] -= total
        np.maximum(sums, 0, out=sums)
        gain -= _phi(sums + total[:, None]) - _phi(sums)
        w, j = np.nonzero(counts)
        if not len(w):
            continue
        here = side[j] - np.where((j == own[w])[:, None], across[w], 0)
        here[np.arange(len(w)), own[w]] -= counts[w, j]
        np.maximum(here, 0, out=here)  # a word's pairs with itself count twice
        part = _phi(here + counts[w, j][:, None]) - _phi(here)
        starts = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
        gain[w[starts]] += np.add.reduceat(part, starts, axis=0)
    return gain[:, :movable].argmax(axis=1)


ENTRY = np.dtype([("code", "<i2"), ("n", "<i4")])


def _contexts(chunks: DataFrame, units: Units, classes: np.ndarray, width: int) -> DataFrame:
    """key, ending and neighbour counts of words without a unit of their own, from training texts.

    ``counts`` holds entries of a code, the class before or width + the class after, and a number.
    """
    sent = chunks.sparkSession.sparkContext.broadcast((units, classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, classes = sent.value
        for whole in batches:
            _, offsets = text_buffer(whole.column(0))
            for a, b in rows_by_bytes(offsets, 2 * HELD_BYTES):
                keys, endings, _ = tokens(whole.column(0).slice(a, b - a))
                unit = units.of(keys, endings)
                class_ = classes[unit]
                # Every text ends with the end token, which has a unit.
                at = np.flatnonzero((unit > 0) & (unit <= ENDINGS))
                if not len(at):
                    continue
                earlier = np.append(classes[0], class_[:-1])
                distinct, first, word = np.unique(keys[at], return_index=True, return_inverse=True)
                code = np.concatenate([earlier[at], width + class_[at + 1]])
                codes, n = np.unique(np.tile(word, 2) * (2 * width) + code, return_counts=True)
                entries = np.zeros(len(codes), ENTRY)
                entries["code"], entries["n"] = codes % (2 * width), n
                ends = np.searchsorted(codes // (2 * width), np.arange(len(distinct) + 1)) * ENTRY.itemsize
                buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(entries.tobytes())]
                packed = pa.Array.from_buffers(pa.binary(), len(distinct), buffers)
                ending = pa.array(endings[at][first].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct.view(np.int64)), ending, packed], names=["key", "ending", "counts"]
                )

    return chunks.filter("learned").select("text").mapInArrow(run, "key bigint, ending int, counts binary")


def word_classes(contexts: DataFrame, classes: np.ndarray, matrix: np.ndarray, least: int = LEAST) -> DataFrame:
    """key and class of the words with at least ``least`` tokens; ``classes`` are those of the units."""
    width = len(matrix)
    sent = contexts.sparkSession.sparkContext.broadcast((classes, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, matrix = sent.value

        def assigned(keys: np.ndarray, endings: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            enough = counts[:, :width].sum(axis=1) >= least
            keys, endings, counts = keys[enough], endings[enough], counts[enough]
            found = [np.zeros(0, np.int64)]
            for i in range(0, len(keys), WORD_BLOCK):
                part = slice(i, i + WORD_BLOCK)
                before, after = counts[part, :width], counts[part, width:]
                found.append(best_classes(matrix, classes[1 + endings[part]], after, before, width - 1))
            moved = pa.array(np.concatenate(found).astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array(keys), moved], names=["key", "class"])

        # Rows come sorted by key; the last word of a batch may go on in the next one.
        last = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2 * width))
        for whole in batches:
            for begin in range(0, whole.num_rows, 1 << 13):
                batch = whole.slice(begin, 1 << 13)
                packed = batch.column(2).to_pylist()
                entries = np.frombuffer(b"".join(packed), ENTRY)
                keys = np.append(last[0], batch.column(0).to_numpy())
                endings = np.append(last[1], batch.column(1).to_numpy())
                starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
                row = np.repeat(word[len(last[0]) :], [len(p) // ENTRY.itemsize for p in packed])
                size = len(starts) * 2 * width
                counts = np.bincount(row * (2 * width) + entries["code"], weights=entries["n"], minlength=size)
                counts = counts.reshape(-1, 2 * width)
                counts[: len(last[0])] += last[2]
                keys, endings = keys[starts], endings[starts]
                yield assigned(keys[:-1], endings[:-1], counts[:-1])
                last = keys[-1:], endings[-1:], counts[-1:]
        yield assigned(*last)

    return contexts.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key bigint, class int")


def _coded_matrix(coded: DataFrame, width: int) -> np.ndarray:
    """Counts of adjacent classes in the training texts, from their tokens' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            codes, _ = text_buffer(batch.column(0))
            class_ = codes.astype(np.int64) >> 1
            # Every text ends with the end token, of the last class.
            before = np.append(width - 1, class_[:-1])[: len(class_)]
            total += np.bincount(before * width + class_, minlength=width * width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])

    counts = coded.filter("learned").select("codes").mapInArrow(run, "code bigint, n bigint")
    matrix = np.zeros(width * width)
    for row in counts.groupBy("code").agg(F.sum("n").alias("n")).collect():  # at most width * width rows
        matrix[row.code] = row.n
    return matrix.reshape(width, width)


@dataclass
class Model:
    tokens: int  # N
    types: int  # V
    discount: float
    classes: np.ndarray  # of the units
    size: np.ndarray  # tokens of each class
    transition: np.ndarray  # log10 P(class | class before)
    unknown: np.ndarray  # log10 P(unknown word | class before)


def model(tokens_: int, types: int, discount: float, classes, size, kinds, matrix) -> Model:
    """Smoothed probabilities from class pair counts, class sizes and word types per class."""
    width = len(size)
    rows, columns = matrix.sum(axis=1), matrix.sum(axis=0)
    low = (columns + 1) / (columns.sum() + width)
    freed = np.where(rows > 0, 0.5 * (matrix > 0).sum(axis=1) / np.maximum(rows, 1), 1.0)
    p = np.maximum(matrix - 0.5, 0) / np.maximum(rows, 1)[:, None] + freed[:, None] * low
    # A class without tokens emits the unknown word only.
    given_up = np.where(size > 0, discount * kinds / np.maximum(size, 1), 1.0)
    return Model(tokens_, types, discount, classes, size, np.log10(p), np.log10(p @ given_up))


def _sums(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)


def code_batch(m: Model, units: Units, texts: pa.Array, known_keys, known_n, known_class=None):
    """Per text n_tokens, n_known, base score and emissions; per token its code and row.

    ``known_keys`` are sorted; a code is twice the token's class, and one more if it is known.
    """
    keys, endings, rows = tokens(texts)
    n_rows = len(texts)
    class_ = m.classes[units.of(keys, endings)]
    if len(known_keys):
        at = np.minimum(np.searchsorted(known_keys, keys), len(known_keys) - 1)
        there = known_keys[at] == keys
        n = np.where(there, known_n[at], 0).astype(float)
        if known_class is not None:
            class_ = np.where(there, known_class[at], class_)
    else:
        n = np.zeros(len(keys))
    known = n > 0
    base = np.log10((n + 1) / (m.tokens + m.types + 1))
    emitted = np.log10(np.where(known, n - m.discount, 1.0) / np.where(known, np.maximum(m.size[class_], 1), 1.0))
    return (
        _sums(rows, np.ones(len(rows)), n_rows).astype(np.int64),
        _sums(rows, known.astype(float), n_rows).astype(np.int64),
        _sums(rows, base, n_rows),
        _sums(rows, emitted, n_rows),
        (class_ << 1 | known).astype(np.uint8),
        rows,
    )


def transitions(m: Model, codes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Sums over each text of the logs of its class transitions, and of its unknown words."""
    if not m.tokens:
        return np.zeros(n_rows)
    class_, known = codes.astype(np.int64) >> 1, codes & 1 == 1
    # Every text ends with the end token, so the one before a text's first word is an end, too.
    before = np.append(m.classes[0], class_[:-1])
    return _sums(rows, np.where(known, m.transition[before, class_], m.unknown[before]), n_rows)


def score_batch(m: Model, units: Units, texts: pa.Array, known_keys: np.ndarray, known_n: np.ndarray, known_class=None):
    """n_tokens, n_known, base and model scores per text; ``known_keys`` are sorted."""
    *sums, emitted, codes, rows = code_batch(m, units, texts, known_keys, known_n, known_class)
    return *sums, emitted + transitions(m, codes, rows, len(texts))


def score(docs: DataFrame, learn: Column, *, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """Learn from the rows that ``learn`` picks and score all rows; logs are base 10."""
    spark = docs.sparkSession
    chunks = chunked(docs, learn)
    vocabulary = keep(_vocabulary(chunks), "vocabulary")
    counts = keep(
        vocabulary.groupBy("key").agg(F.sum("n").alias("n"), F.max("ending").alias("ending")).filter("n > 0"), "counts"
    )
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    ).first()
    n_tokens, types, ones, twos = totals
    end = int(END.view(np.int64))
    frequent = counts.filter((F.col("n") >= SHARE * n_tokens) & (F.col("key") != end)).orderBy("key").select("key")
    keys = np.array([r.key for r in frequent.collect()], np.int64).view(np.uint64)  # at most 1 / SHARE
    order = np.argsort(keys)
    units = Units(keys[order], 1 + ENDINGS + np.arange(len(keys))[order])
    pairs = _pairs(chunks, units)
    assigned = cluster(pairs, units.count, classes, rounds)
    width = classes + 1
    contexts = _contexts(chunks, units, assigned, width)
    placed = word_classes(contexts, assigned, _matrix(pairs, assigned, width))
    own = [(end, int(assigned[0])), *zip(units.keys.view(np.int64).tolist(), assigned[units.units].tolist())]
    placed = placed.union(spark.createDataFrame(own, "key bigint, class int"))
    groups = spark.createDataFrame(list(enumerate(assigned[1 : 1 + ENDINGS].tolist())), "ending int, fallback int")
    known = keep(
        counts.join(placed, "key", "left")
        .join(F.broadcast(groups), "ending")
        .select("key", "n", F.coalesce("class", "fallback").alias("class")),
        "classes",
    )
    size, kinds = np.zeros(width), np.zeros(width)
    for row in known.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
        size[row["class"]], kinds[row["class"]] = row.n, row.kinds
    discount = ones / (ones + 2 * twos) if ones and twos else 0.5
    none = np.zeros(0)
    sent = spark.sparkContext.broadcast((Model(n_tokens, types, discount, assigned, size, none, none), units))

    def code(texts: pa.Table, known: pa.Table) -> pa.Table:
        m, units = sent.value
        keys = known.column("key").to_numpy().view(np.uint64)
        keys, first = np.unique(keys, return_index=True)
        n, class_ = known.column("n").to_numpy()[first], known.column("class").to_numpy()[first].astype(np.int64)
        sums, codes = [], []
        for batch in texts.select(["text"]).to_batches():
            column = batch.column(0)
            for a, b in rows_by_bytes(text_buffer(column)[1], HELD_BYTES):
                *found, byte, rows = code_batch(m, units, column.slice(a, b - a), keys, n, class_)
                sums.append(found)
                ends = np.searchsorted(rows, np.arange(b - a + 1)).astype(np.int32)
                buffers = [None, pa.py_buffer(ends), pa.py_buffer(byte.tobytes())]
                codes.append(pa.Array.from_buffers(pa.binary(), b - a, buffers))
        columns = [pa.array(np.concatenate(c)) for c in zip(*sums)]
        return pa.table(
            [texts["doc_id"], texts["learned"], *columns, pa.chunked_array(codes, pa.binary())],
            names=["doc_id", "learned", "n_tokens", "n_known", "base_score", "emitted", "codes"],
        )

    answers = vocabulary.select("chunk", "key").join(known, "key").select("chunk", "key", "n", "class")
    grouped = chunks.select("chunk", "doc_id", "learned", "text").groupBy("chunk").cogroup(answers.groupBy("chunk"))
    coded = keep(
        grouped.applyInArrow(
            code,
            "doc_id bigint, learned boolean, n_tokens bigint, n_known bigint, base_score double, emitted double, codes binary",
        ),
        "coded",
    )
    matrix = _coded_matrix(coded, width)
    learned = spark.sparkContext.broadcast(model(n_tokens, types, discount, assigned, size, kinds, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = learned.value
        for whole in batches:
            _, offsets = text_buffer(whole.column(6))
            for a, b in rows_by_bytes(offsets, HELD_BYTES):
                batch = whole.slice(a, b - a)
                codes, ends = text_buffer(batch.column(6))
                rows = np.repeat(np.arange(b - a), np.diff(ends))
                value = batch.column(5).to_numpy() + transitions(m, codes, rows, b - a)
                total = pa.array(np.full(b - a, m.tokens, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:4], total, batch.column(4), pa.array(value)],
                    names=["doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return coded.mapInArrow(run, SCHEMA)
