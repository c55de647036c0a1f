"""Mixing against a schedule dealt slot by slot, and a mix put together word by word."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from skymart.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, slot int, number int, size string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, 8, "x") for i, t, s in rows], SCHEMA)


def corpus(seed=5):
    rng, rows = random.Random(seed), []
    sources = ["b", "a", None, "ä", "c c", "", "zz"]
    shares = [40, 10, 6, 3, 1, 1, 2]
    for i in range(160):
        n = rng.choice([0, 1, 5, 30, 90])
        text = None if i % 41 == 0 else rng.choice([" ", "\t", "\n\n"]).join(f"w{i}-{j}" for j in range(n))
        rows.append((None if i % 29 == 0 else i, text, rng.choices(sources, shares)[0]))
    rows += [rows[3], rows[3], (900, " ".join(f"l{j}" for j in range(4_000)), "zz")]
    return rows


def want_targets(rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    out, free, left = {}, set(names), Fraction(sum(sizes.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * unit > 3 * sizes[s]}
        if not above:
            return out | {s: weight[s] * unit for s in free}, sizes
        for s in above:
            out[s] = Fraction(3 * sizes[s])
            left -= out[s]
        free -= above
    return out, sizes


def test_points():
    k = np.arange(3000)
    points = mixing.reversed_bits(k)
    assert points[1] == 1 << (mixing.BITS - 1) and points[2] == 1 << (mixing.BITS - 2)
    rng = np.random.default_rng(1)
    for x in [0, 1, 1 << mixing.BITS, *rng.integers(0, 1 << mixing.BITS, 20)]:
        below = np.append(0, np.cumsum(points < x))[:-1]
        assert (mixing.points_below(k, np.full(len(k), x)) == below).all()
    # Few points too many or too few in any interval, at any time.
    for a, b in ((0.1, 0.13), (0.2, 0.9), (1 / 3, 2 / 3)):
        inside = np.cumsum((points >= a * 2**mixing.BITS) & (points < b * 2**mixing.BITS))
        assert np.abs(inside - (b - a) * (k + 1)).max() <= 6


def mixed(spark, rows, **how):
    pieces, documents = mixing.mix(table(spark, rows), **how)
    return pieces.collect(), documents.collect(), mixing.taken(pieces, documents).collect()


@pytest.mark.parametrize("block", [16, 100, 4096])
def test_mix(spark, block):
    rows = corpus()
    pieces, documents, taken = mixed(spark, rows, block=block)
    targets, sizes = want_targets(rows)
    assert len(documents) == len(taken) == len(rows)
    by_number = {d.number: d.source for d in documents}
    for d in documents:
        assert d.target == pytest.approx(float(targets[d.source]), abs=1e-9) and d.source_size == sizes[d.source]
    # Slots are full and gapless but for the last of each source.
    slots = defaultdict(list)
    for p in pieces:
        slots[p.slot].append(p)
    short, words = Counter(), Counter()
    for own in slots.values():
        own.sort(key=lambda p: p.offset)
        assert len({p.number for p in own}) == 1
        for p, q in zip(own, own[1:]):
            assert p.offset + p.n_words == q.offset
        n = sum(p.n_words for p in own)
        assert own[0].offset == 0 and n <= block
        short[own[0].number] += n < block
        words[by_number[own[0].number]] += n
    assert max(short.values()) <= 1
    assert words == {s: int(t) for s, t in targets.items() if t >= 1}
    # The words of a source come in rounds: none again before all others were taken.
    counts = defaultdict(Counter)
    for p in pieces:
        for w in range(p.from_word, p.from_word + p.n_words):
            counts[p.number][p.start, w] += 1
    for number, c in counts.items():
        most = max(c.values())
        assert most <= 3 and (most == 1 or (min(c.values()) >= most - 1 and len(c) == sizes[by_number[number]]))
    # Each document has what its pieces say.
    place = Counter()
    for p in pieces:
        place[p.number, p.start] += p.n_words
    ids = {(d.number, d.start): d for d in documents if d.size}
    got = sorted((str(r.doc_id), r.size, r.taken) for r in taken if r.size)
    assert got == sorted((str(d.doc_id), d.size, place[k]) for k, d in ids.items())
    assert all(r.taken <= 3 * r.size for r in taken)


def test_slots_follow_the_points(spark):
    rows = [(i, "a b c d", "xyz"[i % 3]) for i in range(3_000)]
    pieces, documents, _ = mixed(spark, rows, block=20)
    targets, _ = want_targets(rows)
    ends = np.cumsum([float(targets[s]) for s in "xyz"]) / 12_000
    by_number = {d.number: d.source for d in documents}
    got = {p.slot: by_number[p.number] for p in pieces}
    points = mixing.reversed_bits(np.arange(600)) / 2.0**mixing.BITS
    dealt = Counter()
    for slot, point in enumerate(points):
        name = "xyz"[np.searchsorted(ends, point, "right")]
        if slot in got:
            assert got[slot] == name
        else:  # left out only where the source had its words already
            assert dealt[name] * 20 >= targets[name]
        dealt[name] += 1


def test_turns_and_reruns_agree(spark):
    rows = corpus(8)
    _, sizes = mixing.laid_out(table(spark, rows))
    shares = mixing.keep(mixing.targets(sizes), "test-shares")
    whole = sorted(map(tuple, mixing.schedule(shares, block=16).collect()))
    assert whole == sorted(map(tuple, mixing.schedule(shares, block=16, sent_sources=2).collect()))
    assert len({s for s, _, _ in whole}) == len(whole) == len({(n, r) for _, n, r in whole})
    one, two = mixed(spark, rows, block=50), mixed(spark, rows[::-1], block=50)
    for a, b in zip(one, two):
        assert sorted(map(str, a)) == sorted(map(str, b))


def test_many_ranges_give_the_same_order(spark, monkeypatch):
    rows = corpus(2)
    want = sorted(map(str, mixing.laid_out(table(spark, rows))[0].collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 4)
    assert sorted(map(str, mixing.laid_out(table(spark, rows))[0].collect())) == want


def test_without_words(spark):
    assert mixed(spark, []) == ([], [], [])
    pieces, documents, taken = mixed(spark, [(1, None, "a"), (None, " \n", None)])
    assert pieces == [] and len(documents) == 2
    assert sorted((r.size, r.target, r.taken) for r in taken) == [(0, 0.0, 0)] * 2
    _, _, taken = mixed(spark, [(1, None, "a"), (2, "x y", "b")])
    assert sorted((r.doc_id, r.target, r.taken) for r in taken) == [(1, 0.0, 0), (2, 2.0, 2)]
