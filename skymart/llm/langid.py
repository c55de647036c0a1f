"""Language identification by interpolated Kneser-Ney character models, one per language.

A text is a row of words; letters count, everything else ends a word. A letter is predicted from up
to three letters before it in its word, and so is the end of the word. Per language, counts of the
four-grams give the discounted probabilities of all orders; lower orders count the contexts a letter
follows. All languages share sorted arrays of packed four-gram keys, one per order, with a column of
log probabilities per language. A text goes to the language with the lowest cross-entropy per
letter. Its score is that language's share after a softmax over the languages.

Training reads whole labelled texts, about ``PER_LANG`` per language picked by a hash of the id (all
of them where there are fewer), of at most ``MAX_LANGS`` languages, the most frequent ones. This
bound is what lets the model be sent to all tasks. Each half of the sample is judged by a model of the
other half. That calibrates the rejection: a text is rejected if its cross-entropy is nearer to that of
other languages under the chosen model than to the language's own, by more than the noise to expect
from its length. Labelled texts that are rejected that way themselves are not learned, so a few texts
with a wrong label, or of no language at all, don't pass for one later. The model learns all others.

Null texts, and texts without letters, are ``und`` with score 0, and rejected. Without any labelled
text all are. Of languages with equal cross-entropy the first by name counts. Repeated rows are predicted each; extra columns are ignored unless carried.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart.llm import words
from skymart.llm.common import keep, lean, text_buffer

PER_LANG = 1500
MAX_LANGS = 500
UNKNOWN = "und"
ORDER = 4
SIGN_BITS = 16
PRIVATE, PRIVATE_SIZE = 0xE000, 6400

COLUMNS = "lang_pred string, score double, cross_entropy double, rejected boolean"


@functools.cache
def _signs() -> np.ndarray:
    """For every code point of 16 bits itself if it is a letter, else 0, the end of a word."""
    return np.array([i if unicodedata.category(chr(i))[0] == "L" else 0 for i in range(1 << 16)], np.uint64)


def signs(text: str) -> np.ndarray:
    """Lower-cased letters as 16-bit signs (rare ones beyond that share 6,400), 0 for all else."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    out = _signs()[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    for i in high:
        letter = unicodedata.category(chr(points[i]))[0] == "L"
        out[i] = PRIVATE + points[i] % PRIVATE_SIZE if letter else 0
    return out


def four_grams(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions to predict, and the packed key of each with its three signs before."""
    zero = np.uint64(0)
    one = np.append(zero, s)[: len(s)]
    two = np.where(one != 0, np.append([zero] * 2, s)[: len(s)], zero)
    three = np.where(two != 0, np.append([zero] * 3, s)[: len(s)], zero)
    at = np.flatnonzero((s != 0) | (one != 0))
    b = np.uint64(SIGN_BITS)
    return at, (((three << b | two) << b | one) << b | s)[at]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class _Order:
    """Sorted keys of one order with log probabilities, sorted contexts with log back-off weights."""

    keys: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray
    log_backoff: np.ndarray


@dataclass
class Model:
    langs: list[str]
    orders: list[_Order]
    floor: float
    #: Per language: own cross-entropy, that of others, noise per letter.
    own: np.ndarray
    other: np.ndarray
    noise: np.ndarray

    def log_p(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of each packed four-gram's last sign, a column per language."""
        value = np.full((len(keys), len(self.langs)), self.floor)
        for n, order in enumerate(self.orders, 1):
            mask = np.uint64((1 << (SIGN_BITS * n)) - 1)
            at, known = _find(order.contexts, (keys & mask) >> np.uint64(SIGN_BITS))
            if known.any():
                value += np.where(known[:, None], order.log_backoff[at], 0.0)
            at, known = _find(order.keys, keys & mask)
            if known.any():
                seen = order.log_p[at]
                value = np.where(known[:, None] & ~np.isnan(seen), seen, value)
        return value


def kneser_ney(keys: np.ndarray, counts: np.ndarray, alphabet: int) -> list[tuple]:
    """(keys, p, contexts, backoff) per order 1 to 4 of one language, from its four-gram counts."""
    levels = [(keys, counts)]
    for n in range(ORDER - 1, 0, -1):
        mask = np.uint64((1 << (SIGN_BITS * n)) - 1)
        levels.append(np.unique(levels[-1][0] & mask, return_counts=True))
    out, lower_keys, lower_p = [], None, None
    for keys, counts in reversed(levels):
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        contexts, inverse, types = np.unique(keys >> np.uint64(SIGN_BITS), return_inverse=True, return_counts=True)
        total = np.bincount(inverse, weights=counts)
        backoff = discount * types / total
        if lower_keys is None:
            below = np.full(len(keys), 1.0 / alphabet)
        else:
            n = len(out)
            below = lower_p[np.searchsorted(lower_keys, keys & np.uint64((1 << (SIGN_BITS * n)) - 1))]
        p = (counts - discount) / total[inverse] + backoff[inverse] * below
        out.append((keys, p, contexts, backoff))
        lower_keys, lower_p = keys, p
    return out


def build(langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """A model from each language's sorted four-gram keys and counts."""
    mask = np.uint64((1 << SIGN_BITS) - 1)
    alphabet = len(np.unique(np.concatenate([np.zeros(1, np.uint64), *(k & mask for k, _ in counts.values())]))) + 1
    made = [kneser_ney(*counts[lang], alphabet) for lang in langs]
    orders = []
    for n in range(ORDER):
        keys = np.unique(np.concatenate([m[n][0] for m in made]))
        contexts = np.unique(np.concatenate([m[n][2] for m in made]))
        log_p = np.full((len(keys), len(langs)), np.nan)
        log_backoff = np.zeros((len(contexts), len(langs)))
        for i, m in enumerate(made):
            log_p[np.searchsorted(keys, m[n][0]), i] = np.log(m[n][1])
            log_backoff[np.searchsorted(contexts, m[n][2]), i] = np.log(m[n][3])
        orders.append(_Order(keys, log_p, contexts, log_backoff))
    n = len(langs)
    return Model(langs, orders, -np.log(alphabet), np.zeros(n), np.full(n, np.inf), np.zeros(n))


def entropies(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: cross-entropy under each language, number of letters, number of predictions."""
    data, offsets = text_buffer(texts)
    n = len(offsets) - 1
    sums, letters, predicted = np.zeros((n, len(model.langs))), np.zeros(n), np.zeros(n)
    for part in words.slices(data, offsets, limit=words.SMALL_SLICE_BYTES):
        if not len(part.starts):
            continue
        h = words.span_hashes(part.data, part.starts, part.ends)
        _, some, word = np.unique(h, return_index=True, return_inverse=True)
        raw = part.data.tobytes()
        spans = zip(part.starts[some].tolist(), part.ends[some].tolist())
        distinct = [raw[a:b].decode("utf-8", "replace") for a, b in spans]
        # One space in front of each word ends the one before it.
        s = signs(" ".join(distinct) + " ")
        sizes = np.array([len(w.lower()) for w in distinct]) + 1
        at, keys = four_grams(s)
        owner = np.repeat(np.arange(len(distinct)), sizes)[at]
        keys, inverse = np.unique(keys, return_inverse=True)
        value = model.log_p(keys)
        rows = part.rows - part.first
        size = part.last - part.first

        def per_row(weights, owner=owner, word=word, rows=rows, size=size, count=len(distinct)):
            per_word = np.bincount(owner, weights=weights, minlength=count)
            return np.bincount(rows, weights=per_word[word], minlength=size)

        for lang in range(len(model.langs)):
            sums[part.first : part.last, lang] += per_row(-value[inverse, lang])
        letters[part.first : part.last] += per_row((s[at] != 0).astype(float))
        predicted[part.first : part.last] += per_row(np.ones(len(at)))
    return sums / np.maximum(predicted, 1)[:, None], letters, predicted


def _chosen(docs: DataFrame, learn: Column) -> DataFrame:
    """Language and text of the sample of labelled texts, and the half each belongs to."""
    rows = docs.filter(F.coalesce(learn, F.lit(False)) & F.col("lang").isNotNull())
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    share = F.lit(None).cast("double")
    if counts:
        shares = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], min(1.0, PER_LANG / r["count"]))))
        share = F.try_element_at(shares, F.col("lang"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    half = F.pmod(F.xxhash64("doc_id", "text", F.lit("half")), F.lit(2)).cast("int")
    chosen = rows.filter(share.isNotNull() & (draw < share))
    return keep(
        chosen.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), half.alias("half")),
        "labelled",
    )


def _counts(sample: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted four-gram keys of each language and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text or "")
            for lang, texts in by_lang.items():
                keys, n = np.unique(four_grams(signs(" ".join(texts) + " "))[1], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                    names=["lang", "key", "n"],
                )

    grams = sample.select("lang", "text").mapInArrow(lean(count), "lang string, key bigint, n bigint")
    table = grams.groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    counts = {}
    for lang, rows in table.groupby("lang"):
        keys = rows["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        counts[lang] = keys[order], rows["n"].to_numpy()[order].astype(float)
    return counts


def fit(docs: DataFrame, learn: Column) -> Model | None:
    """Learn from text and lang of the rows that ``learn`` allows; None without any letter there."""
    sample = _chosen(docs, learn)
    halves = [_counts(sample.filter(F.col("half") == h)) for h in (0, 1)]
    both = [_Judge(build(sorted(c), c), 1 - h) for h, c in enumerate(halves) if c]
    if not both:
        return None
    rows = [r for judge in both for r in judge.rows(sample)]
    langs = sorted(set().union(*halves))
    limits = _calibrated(langs, rows, both[0].model.floor)
    learned = None
    for h in (0, 1):
        own = sample.filter(F.col("half") == h)
        judge = next((j for j in both if j.half == h), None)
        own = judge.kept(own, limits) if judge else own.select("lang", "text")
        learned = own if learned is None else learned.union(own)
    counts = _counts(keep(learned, "learned"))
    if not counts:
        return None
    model = build(sorted(counts), counts)
    for i, lang in enumerate(model.langs):
        model.own[i], model.other[i], model.noise[i] = limits[lang]
    return model


@dataclass
class _Judge:
    """A model of one half of the labelled texts, for those of the other ``half``."""

    model: Model
    half: int

    def rows(self, sample: DataFrame) -> list[tuple[str, dict[str, float], float]]:
        """Language, cross-entropy by language and letters of the texts with letters."""
        sent = sample.sparkSession.sparkContext.broadcast(self.model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ce, letters, _ = entropies(sent.value, batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ce.tolist(), pa.list_(pa.float64())), pa.array(letters)],
                    names=["lang", "ce", "letters"],
                )

        texts = sample.filter(F.col("half") == self.half).select("lang", "text")
        found = texts.mapInArrow(lean(run), "lang string, ce array<double>, letters double").collect()
        return [(r.lang, dict(zip(self.model.langs, r.ce)), r.letters) for r in found if r.letters > 0]

    def kept(self, texts: DataFrame, limits: dict[str, tuple[float, float, float]]) -> DataFrame:
        """Those not too unlike their language; all of a language that the model doesn't know."""
        sent = texts.sparkSession.sparkContext.broadcast(self.model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = {lang: i for i, lang in enumerate(sent.value.langs)}
            for batch in batches:
                ce, letters, _ = entropies(sent.value, batch.column(1))
                fine = []
                for i, lang in enumerate(batch.column(0).to_pylist()):
                    known = place.get(lang)
                    limit = _limit(*limits[lang], letters[i]) if lang in limits else np.inf
                    fine.append(known is None or ce[i, known] <= limit)
                yield batch.filter(pa.array(fine, pa.bool_()))

        return texts.select("lang", "text").mapInArrow(lean(run), "lang string, text string")


def _limit(own: float, other: float, noise: float, letters: float) -> float:
    """Cross-entropy above which a text is rejected."""
    return (own + other) / 2 + 4 * noise / np.sqrt(np.maximum(letters, 1))


def _calibrated(
    langs: list[str], rows: list[tuple[str, dict[str, float], float]], floor: float
) -> dict[str, tuple[float, float, float]]:
    """Own cross-entropy, that of other languages and the noise per letter of each language."""
    out = {}
    for lang in langs:
        own = np.array([(ce[lang], n) for name, ce, n in rows if name == lang and lang in ce]).reshape(-1, 2)
        others = [ce[lang] for name, ce, _ in rows if name != lang and lang in ce]
        near = np.median(own[:, 0]) if len(own) else -floor
        far = max(np.median(others) if others else -floor, near)
        noise = 1.5 * np.median(np.abs(own[:, 0] - near) * np.sqrt(own[:, 1])) if len(own) else 0.0
        out[lang] = near, far, noise
    return out


def decide(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, cross-entropy and rejection of every text."""
    ce, letters, predicted = entropies(model, texts)
    best = ce.argmin(axis=1)
    rows = np.arange(len(best))
    lead = np.exp((ce[rows, best][:, None] - ce) * np.sqrt(np.maximum(predicted, 1))[:, None])
    lowest = ce[rows, best]
    limit = _limit(model.own[best], model.other[best], model.noise[best], letters)
    none = letters == 0
    langs = [UNKNOWN if n else model.langs[b] for n, b in zip(none, best)]
    return langs, np.where(none, 0.0, 1.0 / lead.sum(axis=1)), lowest, none | (lowest > limit)


def predict(docs: DataFrame, model: Model | None, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of every row with lang_pred, score, cross_entropy and rejected."""
    fields = [docs.schema[name] for name in carry]
    text = F.col("text").cast("string").alias("__text")
    rows = docs.select(*(F.col(f.name) for f in fields), text)
    if model is None:
        return rows.drop("__text").withColumns(
            {
                "lang_pred": F.lit(UNKNOWN),
                "score": F.lit(0.0),
                "cross_entropy": F.lit(0.0),
                "rejected": F.lit(True),
            }
        )
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                langs, score, ce, rejected = decide(sent.value, batch.column(len(fields)))
                own = [pa.array(langs, pa.string()), pa.array(score), pa.array(ce), pa.array(rejected)]
                names = [*carry, "lang_pred", "score", "cross_entropy", "rejected"]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(fields)], *own], names=names)

    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return rows.mapInArrow(lean(run), types + COLUMNS)
