"""Runs against brute force over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from document_rows import documents  # noqa: F401

from skymart.llm import catalog, periodic_runs

SF = "/root/testdata/sf0.001"


def brute(t, least=24, power=3):
    found, n = set(), len(t)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if t[i] != t[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and t[j] == t[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, power * q):
                part = t[i : i + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.add((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequence(rng):
    out = []
    for _ in range(rng.randrange(1, 6)):
        root = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 14))]
        out += (root * rng.randrange(1, 9))[: rng.randrange(1, 60)]
        out += [rng.randrange(60) for _ in range(rng.randrange(0, 8))]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_sequences(seed):
    rng = random.Random(seed)
    for _ in range(150):
        t = sequence(rng)
        for least, power in ((24, 3), (2, 2)):
            got = [tuple(r) for r in periodic_runs.runs_of([x + 1 for x in t], least, power).tolist()]
            assert got == brute(t, least, power), t


def test_common_extensions():
    rng = random.Random(9)
    for n in (2, 17, 400):
        t = [rng.randrange(1, 3) for _ in range(n)]
        tree = periodic_runs.SuffixTree(t)
        i, j = np.array([(i, j) for i in range(n) for j in range(n) if i != j]).T
        want = []
        for a, b in zip(i.tolist(), j.tolist()):
            k = 0
            while max(a, b) + k < n and t[a + k] == t[b + k]:
                k += 1
            want.append(k)
        assert tree.common(i, j).tolist() == want
        order = sorted(range(n + 1), key=lambda s: t[s:])
        assert tree.order.tolist() == order
        inverse = sorted(range(n + 1), key=lambda s: [-x for x in t[s:]])
        assert tree.inverse_order().tolist() == inverse


def want(words):
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return runs, best, " ".join(w for i, w in enumerate(words) if i not in gone)


def check(rows, texts):
    for row, text in zip(rows, texts):
        words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").split(" ") if w]
        runs, best, collapsed = want(words)
        assert row.n_words == len(words)
        assert [tuple(r) for r in row.runs] == runs
        assert (row.strongest and tuple(row.strongest)) == best
        assert row.collapsed == collapsed


def test_texts(spark, documents):
    rng = random.Random(3)
    line = " ".join(f"w{i}" for i in range(40))
    texts = [None, "", " \n\t ", "one", "a b " * 12, "a b " * 11 + "a", "a " * 24, "a " * 23, "ä ö\tü\vß " * 9]
    texts += [line + "\n" + "x y z " * 10 + "\n" + line, f"{line}\n" * 3 + "end", "  " * 30]
    texts += [" ".join(str(x) for x in sequence(rng)) for _ in range(60)]
    texts += ["q r s " * 9_000 + " ".join(f"v{i}" for i in range(4_000))]  # long, one run
    texts += texts[3:6]
    rows = list(enumerate(texts[:-2])) + [(None, texts[-2]), (4, texts[-1])]
    got = periodic_runs.periodic_runs(documents(rows).coalesce(1)).collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    long = [i for i, t in enumerate(texts) if t and len(t) > 40_000]
    check([r for i, r in enumerate(got) if i not in long], [t for i, t in enumerate(texts) if i not in long])
    assert [tuple(r) for r in got[long[0]].runs] == [(0, 27_000, 3)]
    assert got[long[0]].collapsed.startswith("q r s v0 v1 ")


def test_runs_do_not_cross_texts(spark, documents):
    got = periodic_runs.periodic_runs(documents([(i, "a b c " * 5) for i in range(50)]).coalesce(1)).collect()
    assert all(not r.runs for r in got)


def test_empty_table(spark, documents):
    assert periodic_runs.periodic_runs(documents([(1, "a")]).filter("false")).collect() == []


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.op12_periodic_runs(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    with_runs = 0
    for row in rows:
        words = planted(row.doc_id, (docs[row.doc_id] or "").encode().split())
        words = [w.decode() for w in words]
        if len(words) > 3000:
            continue
        runs, best, collapsed = want(words)
        with_runs += bool(runs)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None, None, None))
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed.encode()).hexdigest()
    assert with_runs >= 10
