"""Line deduplication against brute force."""

import random

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from document_rows import documents  # noqa: F401

from skymart.llm import catalog, line_dedup

SF = "/root/testdata/sf0.001"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, edits):
    place = {}
    for i, t in rows:
        for n, line in enumerate(t.split("\n") if t else []):
            if line.strip(" "):
                here = (i is None, i or 0, n)
                place[line] = min(place.get(line, here), here)
    near = {line: [] for line in place}
    names = [x for x in place if len(x) >= line_dedup.MIN_CHARS]
    for k, x in enumerate(names):
        for y in names[:k]:
            if abs(len(x) - len(y)) <= edits and distance(x, y) <= edits:
                near[x].append(place[y]), near[y].append(place[x])
    out = []
    for i, t in rows:
        lines, kept, counts, homes = t.split("\n") if t else [], [], [0, 0, 0], set()
        for n, line in enumerate(lines):
            here, links = (i is None, i or 0, n), near.get(line, [])
            counts[2] += len(links)
            similar = links and min(links) < place[line]
            if line in place and here != place[line]:
                counts[0] += 1
            elif similar:
                counts[1] += 1
            else:
                kept.append(line)
                continue
            homes.add(min(links)[1] if similar else place[line][1])
        text = t if t is None or not (counts[0] + counts[1]) else "\n".join(kept)
        out.append((i is None, i, len(lines), *counts, sorted(homes), text))
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    return sorted(
        ((r.doc_id is None, r.doc_id, r.n_lines, r.n_repeated, r.n_similar, r.n_links, r.homes, r.new_text) for r in rows),
        key=str,
    )


def edited(rng, line, n):
    line = list(line)
    for _ in range(n):
        at = rng.randrange(len(line))
        kind = rng.randrange(3 if len(line) > 1 else 2)  # the last character stays
        if kind == 0:
            line[at] = rng.choice("xyz é")
        elif kind == 1:
            line.insert(at, rng.choice("xyz "))
        else:
            del line[at]
    return "".join(line)


def corpus():
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abc de") for _ in range(n))
    base = [text(rng.choice([10, 23, 24, 25, 40, 41, 90])) + "." for _ in range(25)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            line = rng.choice(base)
            lines.append(edited(rng, line, rng.choice([0, 1, 1, 2, 3])) if rng.random() < 0.7 else text(30))
        rows.append((i, "\n".join(lines)))
    same = "the very same line in many of them"
    rows += [(50, None), (51, ""), (52, "\n \n"), (53, same + "\n" + same), (None, same), (54, "x" * 20_000 + "\n" + "x" * 20_001)]
    return rows + [(i, f"{same}\nSecond line no {i} is its own, is it not?") for i in range(60, 75)]


@pytest.mark.parametrize("edits", [1, 2])
def test_against_brute_force(documents, edits):
    rows = corpus()
    assert found(line_dedup.dedup(documents(rows).repartition(3), edits=edits)) == brute(rows, edits)


def test_repeated_rows_lose_the_same_lines(documents):
    rows = [(1, "a line of the first\nother"), (2, "a line of the first\nsecond"), (2, "a line of the first\nsecond")]
    texts = [r.new_text for r in line_dedup.dedup(documents(rows)).collect()]
    assert sorted(texts) == ["a line of the first\nother", "second", "second"]


def test_empty(documents):
    assert line_dedup.dedup(documents([])).count() == 0


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    pairs = [("abcd", "abcd"), ("a", "b"), ("ab", "ba"), ("x" * 9, "x" * 12), ("aéb😀", "aeb😀")]
    for _ in range(150):
        a = "".join(rng.choice("abé ") for _ in range(rng.randrange(1, 15)))
        pairs.append((a, edited(rng, a + "a", rng.randrange(5)) or "z"))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(line_dedup.within(F.col("a"), F.col("b"), edits)).collect()]
    assert got == [distance(a, b) <= edits for a, b in pairs]


def test_no_python_in_the_plan(spark):
    plan = catalog.op10_line_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_against_sql(spark):
    result = catalog.op10_line_dedup(spark, SF).toPandas()
    assert difference(result, duck(SF).execute(catalog.ORACLES["op10_line_dedup"]).df()) is None


def test_keys_are_grouped_by_hash(spark):
    """Keys are computed once a line ahead of the grouping, not sorted as arrays."""
    text = "a line of more than twenty-four characters"
    lines = spark.createDataFrame([(1, 2, text), (1, 2, text)], "h1 bigint, h2 bigint, line string")
    classes, indexed, probing = line_dedup.line_classes(lines, 1)
    assert (len(indexed), len(probing), classes.count()) == (2, 4, 1)
    plan = classes._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan
