"""Character models against a plain Kneser-Ney, and held-out accuracy."""

import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from document_rows import documents  # noqa: F401

from skymart.llm import catalog, common, langid, near_dup, words

SF = "/root/testdata/sf0.01"


def plain_words(text):
    """Letters of each word; every other character ends one."""
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


def plain_model(texts, alphabet):
    """P(sign | up to three before) by interpolated Kneser-Ney, straight from the definition."""
    grams = [Counter()] * 5
    grams[4] = Counter(("#" * 3 + w + "#")[i : i + 4] for t in texts for w in plain_words(t) for i in range(len(w) + 1))
    for n in (3, 2, 1):
        grams[n] = Counter(g[1:] for g in grams[n + 1])
    discount = {}
    for n in range(1, 5):
        ones, twos = (sum(c == k for c in grams[n].values()) for k in (1, 2))
        discount[n] = ones / (ones + 2 * twos) if ones and twos else 0.5

    def p(context, sign, n):
        if n == 0:
            return 1 / alphabet
        context = context[len(context) - n + 1 :]
        total = sum(c for g, c in grams[n].items() if g[:-1] == context)
        if not total:
            return p(context, sign, n - 1)
        types = sum(g[:-1] == context for g in grams[n])
        seen = grams[n][context + sign]
        return max(seen - discount[n], 0) / total + discount[n] * types / total * p(context, sign, n - 1)

    def entropy(text):
        logs = []
        for w in plain_words(text):
            s = "###" + w + "#"
            logs += [-math.log(p(s[i : i + 3], s[i + 3], 4)) for i in range(len(w) + 1)]
        return sum(logs) / len(logs) if logs else 0.0

    return entropy


LEFT = ["the cat sat on the mat", "a dog and THE cat", "that hat the then"]
RIGHT = ["der Hund und die Katze", "das ist ein Hut über", "und dann der"]


def model_of(*sides):
    counts = {}
    for lang, texts in zip(("aa", "bb"), sides):
        keys, n = np.unique(langid.four_grams(langid.signs(" ".join(texts) + " "))[1], return_counts=True)
        counts[lang] = keys, n.astype(float)
    return langid.build(sorted(counts), counts)


def test_entropies_are_those_of_plain_kneser_ney():
    model = model_of(LEFT, RIGHT)
    letters = set("".join(w for t in LEFT + RIGHT for w in plain_words(t)))
    plain = [plain_model(texts, len(letters) + 2) for texts in (LEFT, RIGHT)]
    texts = ["the cat", "und der hund", "x9y  The-THE", "zzz ñandú", "", None, "12 34", "日本 the"]
    ce, found, _ = langid.entropies(model, pa.array(texts))
    for row, text in zip(ce, texts):
        assert row == pytest.approx([p(text or "") for p in plain])
    assert found.tolist() == [sum(c.isalpha() for c in t or "") for t in texts]


def test_probabilities_sum_to_one():
    model = model_of(LEFT, RIGHT)
    signs = sorted({0} | {ord(c) for t in LEFT + RIGHT for w in plain_words(t) for c in w})
    for context in ("\0\0\0", "the", "\0\0t", "xyz", "\0de"):
        packed = 0
        for c in context:
            packed = packed << 16 | ord(c)
        keys = np.array([packed << 16 | s for s in signs] + [packed << 16 | 0xFFF0], np.uint64)
        assert np.exp(model.log_p(keys)).sum(axis=0) == pytest.approx([1, 1])


def test_odd_rows(spark):
    rows = [(i, LEFT[i % 3] * 20, "aa", "x") for i in range(30)]
    rows += [(i, RIGHT[i % 3] * 20, "bb", "x") for i in range(30, 60)]
    rows += [(100, None, None, "x"), (None, "the cat sat on that", None, None), (101, "12 !?", "aa", "x"), (102, "", "bb", "x")]
    rows += [(103, "und die katze", None, "x")] * 2 + [(104, "the cat " * 20_000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    model = langid.fit(docs, F.col("doc_id") < 60)
    got = {r.doc_id: (r.lang_pred, r.rejected, 0 <= r.score <= 1) for r in langid.predict(docs, model).collect()}
    assert got[100] == got[101] == got[102] == ("und", True, True)
    assert (got[None][0], got[103][0], got[104][0]) == ("aa", "bb", "aa")
    assert langid.predict(docs, model).filter("doc_id = 103").count() == 2
    carried = langid.predict(docs, model, ["doc_id", "text", "lang"])
    assert carried.columns[:3] == ["doc_id", "text", "lang"] and carried.count() == len(rows)


def test_nothing_to_learn_and_empty(spark, documents):
    docs = documents([(1, "the cat")]).withColumn("lang", F.lit(None).cast("string"))
    assert langid.fit(docs, F.lit(True)) is None
    assert langid.fit(docs.limit(0), F.lit(True)) is None
    assert [r.lang_pred for r in langid.predict(docs, None).collect()] == ["und"]
    model = model_of(LEFT, RIGHT)
    assert langid.predict(docs.limit(0), model).count() == 0


def test_gibberish_is_rejected_and_clean_text_is_not(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs, F.lit(True))
    junk = spark.createDataFrame([(1, "xq zjk vvw qqx " * 30, "en"), (2, "ξψ ωφ χζ " * 40, "en")], docs.schema)
    assert [r.rejected for r in langid.predict(junk, model).collect()] == [True, True]
    kept = langid.predict(docs, model).groupBy("rejected").count().collect()
    assert sum(r["count"] for r in kept if r.rejected) <= 3


def test_held_out_accuracy(spark):
    got = catalog.op9_language_id(spark, SF).filter("held_out")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = defaultdict(int)
    for r in got.join(docs, "doc_id").collect():
        right[r.lang_pred == r.lang] += 1
    assert right[True] / (right[True] + right[False]) > 0.99


def test_languages_with_few_labelled_texts_are_learned(spark):
    rows = [(i, (LEFT + RIGHT)[i % 6] * 20, f"l{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert len(langid.fit(docs, F.lit(True)).langs) == 40


def test_large_batches_take_little_memory(monkeypatch):
    """Two megabytes of text at once: arrays and kept powers are those of a small slice."""
    monkeypatch.setattr(words, "_POWERS", {})
    texts = [f"le chat {i} dort et the cat sleeps " * 30 for i in range(2000)]
    keys, counts = np.unique(langid.four_grams(langid.signs("le chat dort "))[1], return_counts=True)
    model = langid.build(["fr"], {"fr": (keys, counts.astype(float))})
    single, letters, _ = langid.entropies(model, pa.array(texts[:3]))
    batch = pa.array(texts)
    assert batch.nbytes > 2_000_000
    for run in (lambda: langid.entropies(model, batch), lambda: near_dup.shingle_sets(batch, 5)):
        tracemalloc.start()
        found = run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 25_000_000
        if isinstance(found, tuple):
            np.testing.assert_array_equal(found[0][:3], single)
            np.testing.assert_array_equal(found[1][:3], letters)
    assert sum(a.nbytes for pair in words._POWERS.values() for a in pair) < 10_000_000


def test_workers_give_back_what_other_steps_left(spark, monkeypatch):
    """Packing's tokenizer stays between its own tasks, and goes with the next task of another step."""
    kept = {}
    monkeypatch.setitem(common.CACHES, "encoders", kept)
    for run, left in ((common.lean(iter, "encoders"), ["path"]), (common.lean(iter), [])):
        kept["path"] = object()
        given = []
        monkeypatch.setattr(common, "give_back", lambda: given.append(1))
        rows = run([1, 2])
        assert next(rows) == 1 and not given
        assert list(rows) == [2] and given
        assert list(kept) == left


def test_freed_memory_of_a_task_goes_back():
    def resident():
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(line.split()[1]) for line in f if line.startswith("Anonymous:")) / 1024

    def run(batches):
        for batch in batches:
            held = [np.ones(1000) for _ in range(10_000)]
            kept.append(np.ones(1000))  # lies above what is freed
            del held
            yield batch

    kept = []
    common.give_back()
    before = resident()
    list(run([1]))
    assert resident() > before + 40
    list(common.lean(run)([1]))
    assert resident() < before + 20
