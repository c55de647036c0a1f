"""Near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from compare import difference, duck

from document_rows import documents  # noqa: F401

from skymart.llm import catalog, common, near_dup
from skymart.llm.components import components

SF = "/root/testdata/sf0.001"


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, percent=80):
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, s) in enumerate(sets):
        for j, t in sets[:x]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def found(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randrange(40))
    rows, n = [], 0
    for _ in range(40):
        base = [word() for _ in range(rng.choice([3, 8, 30, 120, 600]))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, len(base) // 60, len(base) // 25])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((n, rng.choice([" ", "\n", " \t "]).join(copy)))
            n += 1
    chain = [word() for _ in range(200)]
    for _ in range(25):  # neighbours are alike, ends are not
        for _ in range(3):
            chain[rng.randrange(len(chain))] = word()
        rows.append((n, " ".join(chain)))
        n += 1
    return rows


@pytest.mark.parametrize("width", [4, 5])
def test_against_brute_force(documents, width):
    rows = corpus()
    assert found(near_dup.near_duplicates(documents(rows).repartition(3), width=width)) == brute(rows, width)


def test_odd_texts(documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "É x y z w"), (7, "é x y z w")]
    rows += [(8, "w " * 30_000), (9, "w " * 30_001)]
    assert found(near_dup.near_duplicates(documents(rows))) == brute(rows, 5)


def test_null_and_repeated_ids(documents):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (2, "a b c d e f")]
    df = near_dup.near_duplicates(documents(rows))
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in df.collect()) == [
        (0, 0, True),
        (2, 2, True),
        (3, 2, False),
        (3, 2, False),
    ]


def test_empty(documents):
    assert near_dup.near_duplicates(documents([])).count() == 0


def test_estimate_is_corrected():
    rng = np.random.default_rng(5)
    for shared, own in ((0, 3000), (2000, 500), (3000, 100)):
        a, b, n = [], [], []
        for _ in range(60):
            common = rng.integers(0, 1 << 64, shared, np.uint64)
            s, t = (np.unique(np.append(common, rng.integers(0, 1 << 64, own, np.uint64))) for _ in range(2))
            a.append(near_dup.sketch(s)), b.append(near_dup.sketch(t)), n.append(float(len(s)))
        guess, count = near_dup.estimate(np.array(a), np.array(b), np.array(n), np.array(n))
        # 3,000 shingles leave a bucket empty once in 7,000 times; estimates rest on the others.
        assert (count >= near_dup.BUCKETS - 2).all()
        assert abs(guess.mean() - shared / (shared + 2 * own)) < 0.015


def near_misses(n, words, changed, seed=4):
    """Copies of one text with so many words changed that no two are similar enough."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(n):
        copy = list(base)
        for at in rng.sample(range(words), changed):
            copy[at] = f"x{i}-{at}"
        rows.append((i, " ".join(copy)))
    return rows


def test_rows_grow_with_members_not_with_pairs(spark, documents, monkeypatch):
    """A group of near copies that all just miss the threshold."""
    written = {}

    def keep(df, name):
        kept = common.keep(df, name)
        written[name] = written.get(name, 0) + kept.count()
        return kept

    monkeypatch.setattr(near_dup, "keep", keep)
    sizes = {}
    for n in (60, 180):
        written.clear()
        rows = near_misses(n, 300, 8)
        got = found(near_dup.near_duplicates(documents(rows), width=4))
        assert got == brute(rows, 4)
        sizes[n] = dict(written)
        assert written["cells"] > n  # members that must be compared with others, in several bands
        assert written["crossing"] <= n
    for name, rows in sizes[180].items():
        assert rows <= 5 * max(sizes[60][name], 10), (name, sizes)


@pytest.mark.parametrize("block,shingles", [(512, 1 << 20), (3, 1 << 20), (512, 900)])
def test_blocks_find_the_same_links(documents, monkeypatch, block, shingles):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", shingles)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):  # a hub that few are linked with, and links among the others
        copy = list(base)
        for at in rng.sample(range(400), 0 if not i else rng.choice([6, 12])):
            copy[at] = f"y{rng.randrange(3)}-{at}"
        rows.append((i, " ".join(copy)))
    assert found(near_dup.near_duplicates(documents(rows), width=4)) == brute(rows, 4)


def test_recall_of_planted_pairs(documents):
    """Pairs of a similarity of 0.80 to 0.82, each on its own."""
    rng, rows, planted = random.Random(2), [], 0
    while planted < 300:
        n = rng.randrange(60, 400)
        base = [f"p{planted}-{i}" for i in range(n)]
        copy = list(base)
        for at in rng.sample(range(n), max(round(n / 38), 1)):
            copy[at] = "z" + copy[at]
        s, t = shingles(" ".join(base), 4), shingles(" ".join(copy), 4)
        if 0.80 <= len(s & t) / len(s | t) <= 0.82:
            rows += [(2 * planted, " ".join(base)), (2 * planted + 1, " ".join(copy))]
            planted += 1
    kept = [r[3] for r in found(near_dup.near_duplicates(documents(rows), width=4))]
    assert sum(not k for k in kept) >= 0.999 * planted


def test_common_shingles():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9_000, n).astype(np.uint64)) for n in (0, 5, 900, 4_000, 8_000, 8_000)]
    left, right = np.array([0, 2, 4]), np.array([1, 3, 5])  # a set is never compared with itself
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in right] for i in left]
    assert near_dup.common_shingles(sets, left, right).tolist() == want
    assert near_dup.common_shingles(sets[:1], np.array([0]), np.array([0])).tolist() == [[0.0]]


def test_registers_hold_zeros_and_mantissa():
    h = np.array([0, 1, near_dup._FLOORS[7] + np.uint64(12345), near_dup._FLOORS[7] + np.uint64(99999)], np.uint64)
    registers = near_dup.sketch(h)
    rest = 12345 * near_dup.BUCKETS | 1
    zeros = 64 - rest.bit_length()
    assert registers[7] == (zeros << 10 | (rest << (zeros + 1) & (1 << 64) - 1) >> 54)
    assert registers[0] == 63 << 10 and (registers != near_dup.EMPTY).sum() == 2


def test_shingle_sets_of_a_batch():
    texts = ["a b c d e", None, "A  b\nc d e", "x", ""]
    sets = near_dup.shingle_sets(pa.array(texts), 4)
    assert [len(s) for s in sets] == [2, 0, 2, 1, 0] and (sets[0] == sets[2]).all()


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 102), (101, 102), (7, 7)]
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r.node, r.component) for r in rows} == {(i, 0) for i in range(61)} | {(i, 100) for i in (100, 101, 102)}


def test_query_against_sql(spark):
    result = catalog.op6_near_dup(spark, SF).toPandas()
    assert difference(result, duck(SF).execute(catalog.ORACLES["op6_near_dup"]).df()) is None


def test_recall_at_the_threshold():
    assert (1 - 0.8**near_dup.BAND_SIZE) ** near_dup.BANDS < 4e-6
    # Registers that miss the threshold by nearly five deviations of independent draws still pass.
    a = np.zeros((1, near_dup.BUCKETS), np.uint16)
    b, n = a.copy(), np.array([1e6])
    short = 4.9 * (0.8 * 0.2 / near_dup.BUCKETS) ** 0.5
    b[0, : int((0.2 + short) * near_dup.BUCKETS)] = 1
    assert near_dup.likely(a, b, n, n, 80).all()
    few = np.array([near_dup.BUCKETS * 1.0])
    random = near_dup.chance(few, few)[0]
    b[:] = 0
    b[0, : int((0.2 + short) * (1 - random) * near_dup.BUCKETS)] = 1
    assert near_dup.likely(a, b, few, few, 80).all()


def test_tables_of_bucket_counts_are_small(spark):
    """Nearly every key is held by one set: no task counts more than a part of the keys it reads."""
    rows = [(key - 7000, id_) for key in range(14_000) for id_ in ((key, key + 1) if key % 50 == 0 else (key,))]
    keys = spark.createDataFrame(rows, "key bigint, id bigint")
    found = near_dup._hubs(keys)
    assert sorted((r.key, r.hub) for r in found.collect()) == [(key - 7000, key) for key in range(0, 14_000, 50)]
    parts = found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [key")
    assert parts == near_dup.KEY_PARTS
