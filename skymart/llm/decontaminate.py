"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window is 10 consecutive words of a benchmark item; an item of fewer words, but not none, is one
window. Texts and items are fingerprinted alike: of the k-grams in a window, the smallest hash is
kept. As it depends on the window's words alone, a window that occurs in a text has left the same
fingerprint there, so no shared span of a window's length is missed. Fingerprints are joined first;
then only the windows around a hit are compared word by word and hits extended to all their words.

Null or empty texts have no words. Null ids and repeated rows are judged by their own texts. Items
without words or id have no windows. Empty tables give no rows, or no hits. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart.llm.common import keep, lower_ascii

WINDOW, GRAM = 10, 6
# Fixed value: what a word is, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fingerprints (16 bytes each) up to which the benchmark's are sent to all tasks.
SENT_FINGERPRINTS = 500_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def _indexed(count: Column, each: Callable[[Column], Column], kind: str) -> Column:
    """``each`` of 0 .. count - 1; nothing for counts below one."""
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), each)).otherwise(
        F.array().cast(f"array<{kind}>")
    )


def fingerprints(hashes: Column, length: int) -> Column:
    """The fingerprint of every window of ``length`` words, from the list of word hashes."""
    gram = min(GRAM, length)
    span = length - gram + 1
    grams = _indexed(
        F.size(hashes) - (gram - 1), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(gram))), "bigint"
    )
    if span == 1:
        return grams
    smallest = lambda g: _indexed(
        F.size(g) - (span - 1), lambda i: F.least(*(F.get(g, i + j) for j in range(span))), "bigint"
    )
    return let(grams, smallest)


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _spans(words: Column, length: int) -> Column:
    """Position, fingerprint and text of every window of ``length`` words."""
    starts = lambda prints: _indexed(
        F.size(prints),
        lambda i: F.struct(
            i.alias("at"),
            F.get(prints, i).alias("print"),
            F.array_join(F.slice(words, i + 1, length), " ").alias("window"),
        ),
        "struct<at:int,print:bigint,window:string>",
    )
    return let(_hashes(words), lambda h: let(fingerprints(h, length), starts))


def _drawn(hashes: Column, length: int) -> Column:
    """length and print of the distinct fingerprints of windows of ``length`` words."""
    prints = F.array_distinct(fingerprints(hashes, length))
    return F.transform(prints, lambda p: F.struct(F.lit(length).alias("length"), p.alias("print")))


def _near(words: Column, prints: Column, length: int) -> Column:
    """The windows of ``length`` words whose fingerprint is among ``prints``."""
    some = F.filter(_spans(words, length), lambda s: F.array_contains(prints, s["print"]))
    return F.transform(some, lambda s: F.struct(F.lit(length).alias("length"), s["at"], s["print"], s["window"]))


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """length, print, window and items (sorted ids as strings) of every distinct window."""
    words = items.filter("item_id is not null").select(
        F.col("item_id").cast("string").alias("item_id"), word_list(F.col("text")).alias("words")
    )
    words = keep(words, "items")
    n = F.size("words")
    by_length = [
        words.filter(n == length if length < window else n >= window).select(
            "item_id", F.lit(length).alias("length"), F.explode_outer(_spans(F.col("words"), length)).alias("s")
        )
        for length in range(1, window + 1)
    ]
    rows = reduce(DataFrame.union, by_length).select("item_id", "length", "s.print", "s.window")
    return rows.groupBy("length", "print", "window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, item_ids (sorted array of strings) and contaminated per row.

    ``text_hash`` is xxhash64 of the text: with doc_id it leads back to the row.
    """
    bench = keep(windows(items, window), "windows")
    lengths = sorted(r.length for r in bench.select("length").distinct().collect())  # at most ``window``
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    sized = rows.select("doc_id", "text_hash", F.size(word_list(F.col("text"))).cast("bigint").alias("n_words"))
    if not lengths:
        return sized.select(
            "*",
            F.lit(0).cast("bigint").alias("n_hit"),
            F.array().cast("array<string>").alias("item_ids"),
            F.lit(False).alias("contaminated"),
        )
    prints = bench.select("length", "print").distinct()
    few = prints.count() <= SENT_FINGERPRINTS
    # One expression from the text on, so that no list is computed anew for each of its elements; and
    # an outer explode, which the optimizer doesn't put a copy of the expression under as a filter.
    drawn = let(
        word_list(F.col("text")),
        lambda words: let(_hashes(words), lambda h: F.concat(*(_drawn(h, length) for length in lengths))),
    )
    seen = rows.select("doc_id", "text_hash", F.explode_outer(drawn).alias("f")).select(
        "doc_id", "text_hash", F.col("f.length").alias("length"), F.col("f.print").alias("print")
    )
    found = seen.join(F.broadcast(prints) if few else prints, ["length", "print"], "left_semi")
    marked = keep(found.groupBy("doc_id", "text_hash").agg(F.collect_set("print").alias("prints")), "marked")

    one, two = rows.alias("r"), marked.alias("m")
    same = F.col("r.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("r.text_hash") == F.col("m.text_hash"))
    near = one.join(two, same).select("r.doc_id", "r.text_hash", "r.text", "m.prints")
    spans = let(
        word_list(F.col("text")),
        lambda words: F.concat(*(_near(words, F.col("prints"), length) for length in lengths)),
    )
    there = near.select("doc_id", "text_hash", F.explode_outer(spans).alias("s")).select(
        "doc_id", "text_hash", *(F.col(f"s.{c}").alias(c) for c in ("length", "at", "print", "window"))
    )
    small = bench.withColumn("group", F.xxhash64(F.array_join("items", ",")))
    known = small.select("length", "print", "window", "group")
    hits = there.join(F.broadcast(known) if few else known, ["length", "print", "window"])
    # Windows of the same items form a group, so a text's items are joined once per group.
    by_doc = keep(
        hits.groupBy("doc_id", "text_hash").agg(
            F.collect_set(F.struct("at", "length")).alias("spans"), F.collect_set("group").alias("groups")
        ),
        "hits",
    )
    groups = small.groupBy("group").agg(F.first("items").alias("items"))
    item_ids = (
        by_doc.select("doc_id", "text_hash", F.explode("groups").alias("group"))
        .join(groups, "group")
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"))
    )
    covered = F.array_distinct(
        F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1)))
    )
    counted = by_doc.select("doc_id", "text_hash", F.size(covered).cast("bigint").alias("n_hit"))
    null_safe = lambda a, b: [F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")), F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash")]
    whole = counted.alias("c").join(item_ids.alias("i"), null_safe("c", "i")).select("c.*", "i.item_ids")
    judged = sized.alias("s").join(whole.alias("w"), null_safe("s", "w"), "left")
    return judged.select(
        "s.doc_id",
        "s.text_hash",
        "s.n_words",
        F.coalesce("w.n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("w.item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("w.n_hit").isNotNull().alias("contaminated"),
    )
