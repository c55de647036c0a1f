"""Phrases and scores against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from skymart.llm import collocations as c


def pieces(text):
    low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
    return [[w for w in re.split(r"[ \t]+", p) if w] for p in re.split(r"[.,;:!?\n\v\f\r]", low)]


def brute(rows, threshold, covered=100, top=2000):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und" if lang != "" else ""
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= threshold}
    gone = set()
    for (lang, long), b in found.items():
        for k in range(2, len(long)):
            for i in range(len(long) - k + 1):
                if 100 * b >= covered * f[lang, long[i : i + k]]:
                    gone.add((lang, long[i : i + k]))
    out = {}
    for (lang, w), a in found.items():
        if (lang, w) in gone:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((score, a, " ".join(w), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    result = []
    for lang, found in out.items():
        found.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        result += [(lang, i, w, a, l, r, m, s) for i, (s, a, w, l, r, m) in enumerate(found[:top], 1)]
    return sorted(result)


def table(spark, rows):
    data = [(i, t, g, 1, "x") for i, t, g in rows]
    return spark.createDataFrame(data, "doc_id bigint, text string, lang string, phrase int, rank string")


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["A", "b", "ä", "Zz", "d'e", "x1", "\x01", "日本", "é", "or"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 12)):
            if rng.random() < 0.4:
                parts.append(rng.choice(["new  York city", "of\tthe", "a b a b a b", "x1 Zz ä or é"]))
            else:
                parts.append(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))))
            parts.append(rng.choice([" ", ".", ", ", "\n", "\t", "!\r\n", ""]))
        rows.append((i, "".join(parts), rng.choice(["en", "de", None, "und", ""])))
    rows += [(None, None, "en"), (3, "", None), (3, " \n\t.", "xx"), (5, "one two three", "xx")]
    return rows + rows[:20]


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed,threshold,covered", [(1, 3, 100), (2, 8, 100), (3, 5, 60)])
def test_against_brute_force(spark, seed, threshold, covered):
    rows = corpus(seed)
    got = found(c.collocations(table(spark, rows), threshold=threshold, covered=covered, block_keys=500, partitions=7))
    assert got == brute(rows, threshold, covered)
    assert got


def test_top(spark):
    rows = corpus(4)
    assert found(c.collocations(table(spark, rows), threshold=2, top=5)) == brute(rows, 2, top=5)


def test_long_text_is_cut_without_loss(spark):
    rng = random.Random(6)
    text = " ".join(rng.choice("abcde") for _ in range(4_000)) + ". " + "f" * 500 + " g"
    rows = [(1, "a b", "en"), (2, text, "en"), (3, text[:300], "en")]
    want = brute(rows, 10)
    assert found(c.collocations(table(spark, rows), threshold=10)) == want
    data = np.frombuffer("".join(t for _, t, _ in rows).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t) for _, t, _ in rows)])
    whole, cut = (
        sorted(np.concatenate([h for p in c.parts(data, offsets, limit) for _, h in c.phrases(p, np.zeros(3, np.uint64))]).tolist())
        for limit in (1 << 20, 64)
    )
    assert whole == cut


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(3)
    keys = np.concatenate([np.repeat(np.arange(20), 60), rng.integers(100, 5_000, 30_000)]).astype(np.uint64)
    rng.shuffle(keys)
    threshold = 50
    summary = c._Summary(len(keys) // threshold + 1)
    for part in np.array_split(keys, 40):
        k, n = np.unique(part, return_counts=True)
        summary.add(k, n)
        summary.merge()
        assert len(summary.keys) <= summary.capacity
    assert 0 < summary.off < threshold
    left = set(summary.survivors(threshold).tolist())
    exact = dict(zip(*(x.tolist() for x in np.unique(keys, return_counts=True))))
    assert {k for k, n in exact.items() if n >= threshold} <= left


@pytest.mark.parametrize("partitions", [1, 7, 48, 211])
def test_partitions_are_ranges_of_keys(partitions):
    edges = c._first_keys(partitions)
    near = np.concatenate([edges[:-1], edges[1:] - np.uint64(1)])
    keys = np.sort(np.append(near, np.random.default_rng(2).integers(0, 1 << c.KEY_BITS, 5_000).astype(np.uint64)))
    assert (np.searchsorted(edges, keys, "right") - 1 == c.partition_of(keys, partitions)).all()


def test_packed_counters():
    rng = np.random.default_rng(4)
    for top in (1, 255, 256, 70_000, 1 << 47):
        values = rng.integers(0, top, 50, endpoint=True)
        assert (c._unpacked(c._packed(values), 50) == values).all()


def test_equal_keys_do_not_mix_phrases(spark, monkeypatch):
    """With a bitmap that lets everything through, phrases are still counted one by one."""
    monkeypatch.setattr(c, "_bitmap", lambda keys: (np.full(8, 255, np.uint8), 6))
    rows = corpus(7, 40)
    assert found(c.collocations(table(spark, rows), threshold=4)) == brute(rows, 4)


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    rows = [("en", "", 0, big * 9), ("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 7)]
    got = c.scored(spark.createDataFrame(rows, "lang string, phrase string, size int, f bigint")).collect()
    assert [tuple(r) for r in got] == [
        ("en", "a b", 2, big - 7, big, big - 1, big * 9, 1000 * (big - 7) * big * 9 // (big * (big - 1)))
    ]


def test_empty(spark):
    assert found(c.collocations(table(spark, []))) == []
    assert found(c.collocations(table(spark, [(1, None, "en"), (2, "a b c", None)]))) == []
