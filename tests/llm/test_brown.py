"""Class bigram scores: counts against brute force, and properties of the model."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from document_rows import documents  # noqa: F401

from skymart.llm import brown, catalog

SF = "/root/testdata/sf0.01"


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [None]


def base_scores(rows, learned):
    counts = Counter(w for i, t in rows if learned(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)))
        for i, t in rows
    }


ROWS = [(i, " ".join(["the", "cat", "Dog", f"w{i % 7}", "und", f"z{i}"][: 2 + i % 5])) for i in range(60)]
ROWS += [(100, None), (101, ""), (102, "new WORDS\tonly here"), (103, "the the the " * 9000)]


def test_base_scores(documents):
    got = brown.score(documents(ROWS).repartition(3), F.col("doc_id") % 3 != 2, classes=4, rounds=2).collect()
    wanted = base_scores(ROWS, lambda i: i % 3 != 2)
    assert len(got) == len(ROWS)
    for r in got:
        n, known, total, base = wanted[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.learned) == (n, known, total, r.doc_id % 3 != 2)
        assert r.base_score == pytest.approx(base) and r.score < 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    n_words, classes = 40, 5
    class_of = np.append(rng.integers(0, classes - 1, n_words), classes - 1)
    counts = np.append(rng.integers(1, 20, n_words), 30)
    pairs = rng.integers(0, 9, (classes, classes)).astype(float)
    size = np.bincount(class_of, weights=counts, minlength=classes)
    kinds = np.bincount(class_of, minlength=classes).astype(float)
    m = brown.model(int(counts.sum()), n_words + 1, 0.5, class_of, size, kinds, pairs)
    for before in range(classes):
        known = 10 ** m.transition[before, class_of] * (counts - 0.5) / size[class_of]
        assert known.sum() + 10 ** m.unknown[before] == pytest.approx(1)


def test_score_is_the_sum_of_its_parts():
    texts = pa.array(["a b zz a", ""])
    keys = np.unique(brown.tokens(pa.array(["a b"]))[0])
    n = np.array([7, 5, 9])
    units = brown.Units(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    classes = np.arange(1 + brown.ENDINGS) % 3
    pairs = np.array([[4.0, 2, 1], [3, 1, 0], [2, 2, 6]])
    m = brown.model(21, 3, 0.5, classes, np.array([9.0, 7, 5]), np.ones(3), pairs)
    _, known, _, value = brown.score_batch(m, units, texts, keys, n)
    ks, endings, rows = brown.tokens(texts)
    before, total = classes[0], [0.0, 0.0]
    for key, ending, row in zip(ks, endings, rows):
        c = classes[0 if key == brown.END else 1 + ending]
        if key in keys:
            count = n[np.searchsorted(keys, key)]
            total[row] += m.transition[before, c] + math.log10((count - 0.5) / m.size[c])
        else:
            total[row] += m.unknown[before]
        before = c
    assert known.tolist() == [4, 1] and value == pytest.approx(total)


def test_exchange_finds_classes(spark):
    rng = np.random.default_rng(1)
    counts = Counter()
    for _ in range(4000):  # units 1-10 are always followed by 11-20 and the other way round
        counts[int(rng.integers(1, 11)), int(rng.integers(11, 21))] += 1
        counts[int(rng.integers(11, 21)), int(rng.integers(1, 11))] += 1
    pairs = spark.createDataFrame([(a, b, n) for (a, b), n in counts.items()], "a int, b int, n bigint")
    found = brown.cluster(pairs, 21, classes=2, rounds=6)
    assert len(set(found[1:11])) == len(set(found[11:])) == 1 and found[1] != found[11]


def test_nothing_to_learn_null_ids_and_empty(spark, documents):
    docs = documents([(1, "a b"), (None, "a"), (2, "b"), (2, "b")])
    got = brown.score(docs, F.lit(False), rounds=1).collect()
    assert len(got) == 4 and {(r.train_tokens, r.base_score, r.score, r.n_known) for r in got} == {(0, 0.0, 0.0, 0)}
    assert brown.score(docs.limit(0), F.lit(True), rounds=1).count() == 0


def test_held_out_texts_are_more_likely_than_by_word_counts(spark):
    got = catalog.op3_lm_scores(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    import zlib

    wanted = base_scores([(r.doc_id, r.text) for r in docs], lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    for r in got.itertuples():
        assert (r.n_tokens, r.n_known, r.train_tokens) == wanted[r.doc_id][:3]
        assert r.base_score == pytest.approx(wanted[r.doc_id][3])
    held = got[got.held_out]
    assert held.score.sum() / held.n_tokens.sum() > held.base_score.sum() / held.n_tokens.sum() + 0.2


def test_best_classes_are_those_of_one_word_at_a_time():
    rng = np.random.default_rng(3)
    width, n = 9, 60
    matrix = rng.integers(20, 400, (width, width)).astype(float)
    own = rng.integers(0, width - 1, n)
    after, before = (rng.integers(0, 3, (n, width)) * rng.integers(0, 4, (n, width)).astype(float) for _ in range(2))
    after[0] = before[1] = 0
    wanted = []
    for c, a, b in zip(own, after, before):
        rest = matrix.copy()
        rest[c] -= a
        rest[:, c] -= b
        wanted.append(brown.best_class(np.maximum(rest, 0), a, b, width - 1))
    assert brown.best_classes(matrix, own, after, before, width - 1).tolist() == wanted


def test_infrequent_words_are_classed_by_their_neighbours(documents):
    # All words of one spelling group; half stand between a and b, half between b and a.
    ring = [f"r{i}zz" for i in range(20)]
    texts = [f"a {w} b" if i % 2 else f"b {w} a" for i, w in enumerate(ring)] * 4
    rows = list(enumerate([*texts, *["a x1 b", "b x2 a"] * 40, "a r_once_zz b"]))
    key = {w: brown.tokens(pa.array([w]))[0][0] for w in ["a", "b", "x1", "x2", *ring]}
    frequent = np.array([key[w] for w in ("a", "b", "x1", "x2")], np.uint64)
    order = np.argsort(frequent)
    units = brown.Units(frequent[order], 1 + brown.ENDINGS + np.arange(4)[order])
    # x1 is of class 2, x2 of class 3, all groups of class 4.
    classes = np.array([5, *[4] * brown.ENDINGS, 0, 1, 2, 3])
    chunks = brown.chunked(documents(rows).repartition(4), F.lit(True))
    matrix = brown._matrix(brown._pairs(chunks, units), classes, 6)
    placed = brown.word_classes(brown._contexts(chunks, units, classes, 6), classes, matrix).collect()
    wanted = {int(key[w].view(np.int64)): 2 if i % 2 else 3 for i, w in enumerate(ring)}
    assert {r["key"]: r["class"] for r in placed} == wanted and len(placed) == len(wanted)
