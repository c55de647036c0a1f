"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from document_rows import documents  # noqa: F401

from skymart.llm import catalog, suffix_dedup

LENGTH = suffix_dedup.LENGTH
SF = "/root/testdata/sf0.001"


def brute(rows):
    """doc_id, n_bytes, n_removed, n_spans and kept bytes by counting all windows."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + LENGTH] for _, t in texts for k in range(len(t) - LENGTH + 1))
    out = []
    for i, t in texts:
        gone, until = [], 0
        for k in range(len(t)):
            if k + LENGTH <= len(t) and seen[t[k : k + LENGTH]] > 1:
                until = k + LENGTH
            gone.append(k < until)
        spans = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i is None, i, len(t), sum(gone), spans, kept))
    return sorted(out)


def found(df):
    return sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


def corpus():
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    base, passage = text(3000), text(450)
    rows = [(0, base), (1, base), (2, None), (3, ""), (4, "x" * 399), (5, "x" * 400), (None, "y" * 2000)]
    for i in range(10, 40):
        copy = list(base)
        for _ in range(rng.choice([1, 3, 8])):
            copy[rng.randrange(len(copy))] = "Q"
        rows.append((i, "".join(copy)))
    rows += [(i, text(rng.randrange(900)) + passage + text(rng.randrange(900))) for i in range(40, 80)]
    rows += [(80, "ab" * 700), (81, base[1000:1399] + "!"), (82, base[1000:1400] + "!"), (83, text(50_000))]
    return rows


@pytest.mark.parametrize("limit", [3, 1000])
def test_against_brute_force(documents, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "ANCHOR_CONTEXTS", limit)
    rows = corpus()
    assert found(suffix_dedup.dedup(documents(rows).repartition(3))) == brute(rows)


def test_segments_of_long_texts(monkeypatch):
    from skymart.llm.common import text_buffer
    import pyarrow as pa

    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(n)) for n in (5000, 300, 400, 900)]
    whole = suffix_dedup._runs(*text_buffer(pa.array(texts)))
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    parts = suffix_dedup._runs(*text_buffer(pa.array(texts)))
    windows = lambda runs: [(r, k) for r, a, b in zip(*runs[:3]) for k in range(a, b + 1)]
    wanted = [(r, k) for r, t in enumerate(texts) for k in range(len(t) - LENGTH + 1)]
    assert windows(whole) == windows(parts) == wanted


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=6))
def test_suffix_order(contexts):
    t = np.frombuffer(b"\xff".join([*contexts, b""]), np.uint8) + np.uint8(1)
    raw = t.tobytes()
    order, _, half = suffix_dedup.suffix_order(t, 16)
    assert sorted(order.tolist()) == list(range(len(t)))
    heads = [raw[i : i + 2 * half].ljust(2 * half, b"\0") for i in order]
    assert heads == sorted(heads)
    length = 16
    marks = suffix_dedup.repeated_starts(contexts, length)
    seen = Counter(c[k : k + length] for c in contexts for k in range(len(c) - length + 1))
    assert [m.tolist() for m in marks] == [
        [seen[c[k : k + length]] > 1 for k in range(max(len(c) - length + 1, 0))] for c in contexts
    ]


def test_empty(documents):
    assert suffix_dedup.dedup(documents([])).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in catalog.op8_suffix_dedup(spark, SF).collect()}
    for _, i, n_bytes, n_removed, n_spans, kept in brute([(r.doc_id, r.text) for r in docs]):
        digest = hashlib.sha256(kept).hexdigest()
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (n_bytes, n_removed, n_spans, digest)
