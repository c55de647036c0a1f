"""The pipeline, each stage against its brute-force version on the stage's own input."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as contaminated
from test_line_dedup import brute as lines
from test_near_dup import brute as near
from test_tokens import plain

import corpus_pipeline
from skymart.llm import langid

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def run_stages(spark, docs, tmp_path):
    """Rows before and after every stage, each written and read again."""
    steps = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        steps.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return steps


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    odd = [(9001, None, None, None, None), (9002, "", "en", "x", 0), (9003, "12 34 !", "en", "x", 7)]
    junk = [(9004, "ξψ ωφ χζ " * 60, "en", "x", 540)]
    docs = docs.union(spark.createDataFrame(odd + junk, docs.schema))
    return run_stages(spark, docs, tmp_path_factory.mktemp("stages"))


def test_stages_and_columns(steps):
    assert [name for name, *_ in steps] == [name for name, _ in corpus_pipeline.STAGES]
    assert all(columns == COLUMNS for *_, columns in steps[:-1])


def test_language_id(spark, steps):
    _, before, after, _ = steps[0]
    docs = spark.createDataFrame(before, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = langid.fit(docs, fold != 2)
    _, _, _, rejected = langid.decide(model, pa.array([r.text for r in before], pa.string()))
    assert sorted(after) == sorted(r for r, gone in zip(before, rejected) if not gone)
    assert {r.doc_id for r in before} - {r.doc_id for r in after} >= {9001, 9002, 9003, 9004}
    assert len(after) >= 0.98 * (len(before) - 4)


def test_line_dedup(steps):
    _, before, after, _ = steps[1]
    wanted = {}
    for _, i, _, repeated, similar, _, _, text in lines([(r.doc_id, r.text) for r in before], 1):
        if not repeated + similar or text.strip(" "):
            wanted[i] = text
    assert {r.doc_id: r.text for r in after} == wanted
    assert all(r.n_chars == len(r.text) for r in after)


def test_near_dedup(steps):
    _, before, after, _ = steps[2]
    kept = {i for i, _, _, keeps in near([(r.doc_id, r.text) for r in before], 5) if keeps}
    assert sorted(after) == sorted(r for r in before if r.doc_id in kept)


def test_decontamination(spark, steps):
    _, before, after, _ = steps[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {i for _, i, _, _, _, hit in contaminated([(r.doc_id, r.text) for r in before], items) if not hit}
    assert sorted(after) == sorted(r for r in before if r.doc_id in clean)


def test_packing(steps):
    _, before, after, _ = steps[4]
    pieces = defaultdict(list)
    for r in after:
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in pieces.items()} == {
        r.doc_id: plain(r.text) + [2] for r in before
    }


def test_run_gives_the_last_stage(spark, steps):
    docs = corpus_pipeline.run(spark, SF)
    assert docs.columns == steps[-1][3] and docs.count() > 0


def test_empty(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).limit(0)
    assert run_stages(spark, docs, tmp_path)[-1][2] == []


def test_near_dedup_keeps_one_of_repeated_rows_and_of_copies_without_id(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(30)) for w in "abc")
    rows = [(5, one), (5, one), (7, one), (None, two), (None, two), (None, one), (8, three), (None, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "x", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    after = corpus_pipeline.near_deduplication(spark, docs.repartition(3), SF)
    assert after.columns == COLUMNS
    wanted = [(5, one), (None, two), (8, three), (None, None), (9, "")]
    assert sorted(((r.doc_id, r.text) for r in after.collect()), key=str) == sorted(wanted, key=str)


CLASHING = "score rejected n_repeated new_text numbers gone __row row text_hash kept column_0 ids half key".split()


def test_columns_of_any_name_pass_through(spark, tmp_path):
    """Extra columns keep their values through all stages but the last, also on odd rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    long = (7001, " ".join(f"the word {i % 977} and more of it" for i in range(20_000)), "en", "x", 1)
    odd = [(7002, None, None, None, None), (None, "A line of no document.", "en", "x", 1), (7003, "", "de", "x", 0)]
    texts = docs.limit(1).collect()
    again = [tuple(r) for r in texts] + [(texts[0].doc_id, "Some other text of the same id, in a line.", "en", "x", 1)]
    docs = docs.union(spark.createDataFrame([long, *odd, *again], docs.schema))
    marked = docs.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(-1))) for c in CLASHING})
    got = marked
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        path = str(tmp_path / str(k))
        stage(spark, got, SF).write.parquet(path)
        got = spark.read.parquet(path)
        assert got.columns == marked.columns
    rows = got.collect()
    assert len(rows) > 100 and {7001} <= {r.doc_id for r in rows}
    for r in rows:
        assert all(r[c] == f"{c}{-1 if r.doc_id is None else r.doc_id}" for c in CLASHING)
    assert corpus_pipeline.STAGES[-1][1](spark, got, SF).count() > 0


def test_empty_tables_stay_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == COLUMNS and out.count() == 0


def test_workers_get_rows_in_small_batches(spark):
    def sizes(session, docs, _):
        def count(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

        return docs.mapInArrow(count, "n bigint")

    docs = spark.range(0, 3 * corpus_pipeline.BATCH_ROWS + 1, 1, 1)
    seen = [r.n for r in corpus_pipeline._stage(sizes)(spark, docs, "").collect()]
    assert sum(seen) == docs.count() and max(seen) == corpus_pipeline.BATCH_ROWS
