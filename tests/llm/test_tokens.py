"""Token ids, packing and the token file against whole-text encoding."""

import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from document_rows import documents  # noqa: F401

from skymart.llm import catalog, packing, token_file, words
from skymart.llm.tokens import Encoder, default_path

ENCODER = Encoder(default_path())
ODD = [
    "it's <|endoftext|> x",
    "H̱b A̱ é ÉTÉ naïve straße ×÷",
    "foo bar ſK İx",
    "abc123def!!'re ''s\x00\x1c\x7f a",
    "",
    "  \n\t",
    "Σσς Σ 日本語 ok",
    None,
    "x" * 30_000,
]


def plain(text):
    return ENCODER.whole.encode(text or "", add_special_tokens=False).ids


def test_odd_texts_encode_as_whole():
    ids, counts = ENCODER.encode(pa.array(ODD))
    ends = np.cumsum(counts)
    for text, a, b in zip(ODD, ends - counts, ends):
        assert ids[a:b].tolist() == plain(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB1 '.,<|>\néÉ́ sİ")), max_size=30), max_size=4))
def test_any_text_encodes_as_whole(texts):
    ids, counts = ENCODER.encode(pa.array(texts, pa.string()))
    assert ids.tolist() == [i for t in texts for i in plain(t)]
    assert counts.tolist() == [len(plain(t)) for t in texts]


def test_long_text_in_slices(monkeypatch):
    monkeypatch.setattr("skymart.llm.tokens.SLICE_BYTES", 64)
    text = " ".join(random.Random(1).choice(["the", "and", "lé", "a1b2", "x" * 200]) for _ in range(300))
    ids, counts = ENCODER.encode(pa.array(["", text, "end"]))
    assert ids.tolist() == plain(text) + plain("end") and counts[0] == 0


def test_memory_stays_small_beside_a_batch(monkeypatch):
    monkeypatch.setattr(words, "_POWERS", {})
    texts = pa.array(["the lé a1b2 and so on " * 5_000] * 60)
    ENCODER.encode(texts.slice(0, 1))
    tracemalloc.start()
    _, counts = ENCODER.encode(texts)
    peak = tracemalloc.get_traced_memory()[1] - 4 * 2 * int(counts.sum())  # the ids, and their parts
    tracemalloc.stop()
    kept = sum(a.nbytes for known in words._POWERS.values() for a in known)
    assert peak < 64 << 20 and kept <= 32 << 20


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr("skymart.llm.tokens.CACHE_WORDS", 3)
    small = Encoder(default_path())
    for text in ("one two three", "four one two", "five six seven eight one"):
        assert small.encode(pa.array([text]))[0].tolist() == plain(text)


def slow_best_fit(lengths, window):
    """Rooms after best-fit decreasing by linear search."""
    rooms = []
    for length in sorted((n % window for n in lengths if n % window), reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(window - length)
    return sorted(rooms + [0] * sum(n // window for n in lengths))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=60), st.sampled_from([1, 7, 16, 31, 32]))
def test_best_fit_and_filling(lengths, window):
    windows = packing.best_fit(lengths, window)
    assert sorted(window - sum(p.length for p in w) for w in windows) == slow_best_fit(lengths, window)
    filled = packing.fill_rooms(windows, window)
    spans = defaultdict(list)
    for sequence in filled:
        size = sum(p.length for p in sequence)
        assert 0 < size <= window and (size == window or size & (size - 1) == 0)
        for p in sequence:
            assert p.length > 0
            spans[p.doc].append((p.start, p.start + p.length))
    assert len([1 for s in filled if sum(p.length for p in s) != window]) <= window.bit_length()
    for doc, length in enumerate(lengths):
        at = 0
        for a, b in sorted(spans[doc]):
            assert a == at
            at = b
        assert at == length


TEXTS = [(5, "the cat"), (5, "the cat"), (None, "no id"), (2, None), (3, ""), (9, "word " * 9000), (1, "It's 12 été")]


@pytest.mark.parametrize("block_ids", [50, 2_000_000])
def test_pack(documents, block_ids):
    rows = packing.pack(documents(TEXTS), block_ids=block_ids).collect()
    found, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        found[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id in {i for i, _ in TEXTS}:
        wanted = sorted(plain(t) + [2] for i, t in TEXTS if i == doc_id)
        flat = [x for _, ids, _ in sorted(found[doc_id]) for x in ids]
        assert sorted(flat) == sorted(x for w in wanted for x in w)
        if len(wanted) == 1:
            assert flat == wanted[0] and {n for _, _, n in found[doc_id]} == {len(flat)}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0)


def test_pack_empty(documents):
    assert packing.pack(documents([])).count() == 0


def test_token_file_round_trip(spark, documents, tmp_path):
    path = str(tmp_path / "ids")
    token_file.write(documents(TEXTS).repartition(3), path)
    rows = token_file.with_start(token_file.read(spark, path), path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 5, 5, 9]
    by_id = {i: plain(t) + [1] for i, t in TEXTS}
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, list(r.ids)) == (at, len(by_id[r.doc_id]), by_id[r.doc_id])
        at += r.n_tokens
    sums = token_file.checksums(token_file.with_start(token_file.read(spark, path), path)).collect()
    assert {(r.doc_id, r.ids_crc32) for r in sums} == {
        (i, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in by_id.items()
    }


def test_token_file_selective_reads(spark, documents, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "ids")
    token_file.write(documents([(i, f"text {i}") for i in range(100)]), path)
    some = token_file.read(spark, path, "doc_id between 10 and 12")
    assert sorted(r.doc_id for r in some.collect()) == [10, 11, 12]
    plan = some.select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1] and "GreaterThanOrEqual(doc_id,10)" in plan
    file = next(p for p in (tmp_path / "ids").iterdir() if p.name.endswith(".parquet"))
    column = pq.ParquetFile(file).metadata.row_group(0).column(4)
    assert "ids" in column.path_in_schema and column.has_dictionary_page and column.has_offset_index


def test_token_file_empty(spark, documents, tmp_path):
    path = str(tmp_path / "ids")
    token_file.write(documents([]), path)
    assert token_file.with_start(token_file.read(spark, path), path).count() == 0


SF = "/root/testdata/sf0.001"


def whole_ids(spark, end_id):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: np.array([*plain(r.text), end_id], "<u4") for r in docs}


def test_packing_query(spark):
    ids, pieces, sequences = whole_ids(spark, 2), defaultdict(list), defaultdict(list)
    for r in catalog.op2_packing(spark, SF).collect():
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for parts, total in [(p, len(ids[d])) for d, p in pieces.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == total if total is not None else at <= 4096
    filled = sum(len(i) for i in ids.values())
    sizes = [sum(n for _, n in s) for s in sequences.values()]
    padded = sum(n if n & (n - 1) == 0 else 4096 for n in sizes)
    assert filled == sum(sizes) and padded <= 1.01 * filled


def test_token_output_query(spark):
    ids, at, want = whole_ids(spark, 1), 0, []
    for doc_id in sorted(ids):
        want.append((doc_id, at, len(ids[doc_id]), zlib.crc32(ids[doc_id].tobytes())))
        at += len(ids[doc_id])
    got = catalog.op4_token_output(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
