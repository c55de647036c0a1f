"""Benchmark windows in documents against brute force."""

import random
import re

from compare import difference, duck

from skymart.llm import catalog, decontaminate

SF = "/root/testdata/sf0.001"
UPPER = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    low = "".join(UPPER.get(c, c) for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(10, len(v))
            if item_id is None or not n:
                continue
            for s in {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}:
                for i in range(len(w) - n + 1):
                    if tuple(w[i : i + n]) == s:
                        hit |= set(range(i, i + n))
                        found.add(str(item_id))
        out.append((doc_id is None, doc_id, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out)


def judged(spark, docs, items):
    d = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id bigint, text string, n_hit int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, print string")
    rows = decontaminate.contamination(d.repartition(3), b).collect()
    return sorted((r.doc_id is None, r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in rows)


def corpus():
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "Über", "x1", "the"]) + str(rng.randrange(9))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = text(30)
    items = [(i, text(rng.randrange(8, 40))) for i in range(30)]
    items += [(50, shared), (51, "Extra " + shared), (7, "one two"), (60, ""), (61, None), (62, "?! --"), (None, "no id here")]
    items += [(63, "a a a a a a a a a a a a"), (64, "word")]
    docs = [(i, text(rng.randrange(60))) for i in range(30)]
    for i in range(30, 80):
        source = words(rng.choice(items)[1]) or ["none"]
        at, n = rng.randrange(len(source)), rng.randrange(8, 25)
        docs.append((i, text(rng.randrange(12)) + " " + ", ".join(source[at : at + n]).upper() + " " + text(5)))
    docs += [(90, None), (91, ""), (None, shared), (92, shared), (92, shared), (93, "One; TWO"), (94, "a " * 40)]
    docs += [(95, text(20_000) + " " + shared + " word"), (96, "no hit")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    assert judged(spark, docs, items) == brute(docs, items)


def test_fingerprints_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SENT_FINGERPRINTS", 0)
    docs, items = corpus()
    assert judged(spark, docs[25:60], items) == brute(docs[25:60], items)


def test_empty(spark):
    assert judged(spark, [], [(1, "a b")]) == []
    assert judged(spark, [(1, "a b")], []) == [(False, 1, 2, 0, [], False)]


def test_no_python_in_the_plan(spark):
    plan = catalog.op1_decontamination(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_against_sql(spark):
    result = catalog.op1_decontamination(spark, SF).toPandas()
    assert difference(result, duck(SF).execute(catalog.ORACLES["op1_decontamination"]).df()) is None
