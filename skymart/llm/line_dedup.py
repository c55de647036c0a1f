"""Line deduplication with a segment-partition edit join, with DataFrame functions only.

Lines are what newlines separate; blank ones are left alone. Equal lines are one class, which lives
where it occurs first (by doc_id, then line number). A line is dropped if an equal line occurs
earlier, or a line that differs by at most ``edits`` characters does; the latter is looked for among
lines of ``MIN_CHARS`` or more. Whether the earlier line is dropped itself makes no difference.

The join: a line is cut into edits + 1 segments. By the pigeonhole principle, a line within that many
edits keeps one of them unchanged, moved by no more than the edits before and after it allow. So
segments of every line are indexed by (length, number, content), and every line probes the substrings
that may be such a segment of a line as long as itself or shorter. Keys carry a signature of the
line's words, of which an edit changes three bits at most; pairs that differ in more are left out in
the join itself, so lines that only share a hot segment don't become rows. The rest are verified by
a banded bit-parallel edit distance.

Null or empty texts have no lines. Null ids come last. Rows that repeat an id and text are one
document (all of them keep or lose the same lines). Empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart.llm.common import keep

EDITS = 1
MIN_CHARS = 24


def line_list(text: Column) -> Column:
    """The lines of a text; none if it is null or empty."""
    text = text.cast("string")
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def _segment(length: Column, number: int, edits: int) -> tuple[Column, Column]:
    """Start (from 1) and length of a segment of a line of this length; the last ones take the rest."""
    count = edits + 1
    base, rest = F.floor(length / count), F.pmod(length, F.lit(count))
    longer = F.greatest(F.lit(0), F.lit(number) - (F.lit(count) - rest))
    size = base + F.when(F.lit(number) >= F.lit(count) - rest, 1).otherwise(0)
    return (F.lit(number) * base + longer + 1).cast("int"), size.cast("int")


def _key(length: Column, number: int, content: Column) -> Column:
    return F.xxhash64(length.cast("int"), F.lit(number), content)


def index_keys(line: Column, edits: int) -> list[Column]:
    length = F.length(line)
    keys = []
    for number in range(edits + 1):
        start, size = _segment(length, number, edits)
        keys.append(_key(length, number, F.substring(line, start, size)))
    return keys


def probe_keys(line: Column, edits: int) -> list[Column]:
    """Keys of all substrings that may be a segment of a line of the same length or up to ``edits`` less.

    With number i of e + 1 segments and d more characters here, the substring starts within i before
    to i after the segment's start, and within e - i of the start moved by d: more edits before it,
    or behind it, would leave too few for the other side, where another segment then is unchanged.
    Lines have ``MIN_CHARS`` or more.
    """
    length, own = F.length(line), index_keys(line, edits)
    keys = []
    for fewer in range(edits + 1):
        other = length - fewer
        for number in range(edits + 1):
            start, size = _segment(other, number, edits)
            for move in range(max(-number, fewer - (edits - number)), min(number, fewer + (edits - number)) + 1):
                if not fewer and not move:  # the line's own segment
                    keys.append(own[number])
                    continue
                at = start + move
                inside = (at >= 1) & (at + size - 1 <= length) & (other >= MIN_CHARS)
                keys.append(F.when(inside, _key(other, number, F.substring(line, at, size))))
    return keys


def signature(line: Column) -> Column:
    """64 bits: parities of the line's words by hash. One edit changes at most three words."""
    # A shift counts modulo 64.
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.hash(w))
    return F.aggregate(F.split(line, " "), F.lit(0).cast("bigint"), lambda acc, w: acc.bitwiseXOR(bit(w)))


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two lines differ by at most ``edits`` insertions, deletions and substitutions.

    Bit-parallel in a band of 2 * edits + 1 diagonals: after the j-th character of ``b``, bit k of
    the e-th mask says that the first j + k - edits characters of ``a`` are at most e edits away.
    """
    band = (1 << (2 * edits + 1)) - 1
    left = lambda x: F.shiftleft(x, 1)
    both = F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b"))

    def run(chars: Column) -> Column:
        mask = lambda e: sum(1 << (edits + k) for k in range(0, e + 1))

        def step(state: Column, j: Column) -> Column:
            same = F.lit(0)
            for k in range(2 * edits + 1):
                equal = F.get(chars["a"], j + (k - edits)) == F.get(chars["b"], j)
                same = same.bitwiseOR(F.when(equal, F.lit(1 << k)).otherwise(F.lit(0)))
            out, above = [], None
            for e in range(edits + 1):
                old = F.get(state, F.lit(e))
                new = old.bitwiseAND(same)
                if e:
                    before = F.get(state, F.lit(e - 1))
                    new = new.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1)).bitwiseOR(left(above))
                above = new.bitwiseAND(F.lit(band))
                out.append(above)
            return F.array(*out)

        start = F.array(*(F.lit(mask(e)) for e in range(edits + 1)))
        end = F.aggregate(F.sequence(F.lit(0), F.size(chars["b"]) - 1), start, step)
        place = F.size(chars["a"]) - F.size(chars["b"]) + edits
        bit = F.call_function("shiftright", F.get(end, F.lit(edits)), place)
        return F.when(F.abs(F.size(chars["a"]) - F.size(chars["b"])) > edits, False).otherwise(
            bit.bitwiseAND(F.lit(1)) == 1
        )

    return F.element_at(F.transform(F.array(both), run), 1)


def _lines(docs: DataFrame) -> DataFrame:
    """Non-blank lines: place (doc_id, text_hash, number), line, and two hashes that stand for its class."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.posexplode_outer(line_list(F.col("text"))).alias("number", "line"),
    )
    return rows.filter(F.trim("line") != "").select(
        "doc_id",
        "text_hash",
        "number",
        "line",
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
    )


def _place() -> Column:
    """Order of occurrence; null ids last."""
    return F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("doc"), "number", "text_hash"
    )


def line_classes(long: DataFrame, edits: int) -> tuple[DataFrame, list[str], list[str]]:
    """Every class's keys and signature, and the names of its index keys and of its probe keys.

    They come together once, without the text: as plain numbers, which are computed ahead of the
    grouping and grouped by hash (arrays would be sorted).
    """
    indexed, probing = index_keys(F.col("line"), edits), probe_keys(F.col("line"), edits)
    names = [f"key_{n}" for n in range(len(indexed) + len(probing))]
    keys = [key.alias(name) for key, name in zip(indexed + probing, names)]
    found = long.select("h1", "h2", *keys, signature(F.col("line")).alias("sign"))
    classes = found.groupBy("h1", "h2").agg(*(F.first(name).alias(name) for name in [*names, "sign"]))
    return classes, names[: len(indexed)], names[len(indexed) :]


def similar_pairs(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """h1 of both lines of every pair of different lines within ``edits``; each pair once, a < b."""
    long = lines.filter(F.length("line") >= MIN_CHARS)
    classes, indexed, probing = line_classes(long, edits)
    entry = lambda part, id_, sign: classes.select(
        F.explode(F.array(*part)).alias("key"), F.col("h1").alias(id_), F.col("sign").alias(sign)
    ).filter("key is not null")
    index = entry(indexed, "i", "s")
    probe = entry(probing, "p", "t")
    near = F.bit_count(F.col("s").bitwiseXOR(F.col("t"))) <= 3 * edits
    met = index.join(probe, "key").filter((F.col("i") != F.col("p")) & near)
    pairs = keep(met.select(F.least("i", "p").alias("a"), F.greatest("i", "p").alias("b")).distinct(), "line-pairs")
    ids = keep(pairs.select(F.explode(F.array("a", "b")).alias("h1")).distinct(), "line-ids")
    texts = keep(long.select("h1", "h2", "line").join(ids, "h1", "left_semi").dropDuplicates(["h1", "h2"]), "line-texts")
    one = texts.select(F.col("h1").alias("a"), F.col("line").alias("x"))
    two = texts.select(F.col("h1").alias("b"), F.col("line").alias("y"))
    return keep(pairs.join(one, "a").join(two, "b").filter(within(F.col("x"), F.col("y"), edits)).select("a", "b"), "similar")


def judged(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """Lines that are dropped or have links: doc_id, text_hash, number, reason, home and links.

    reason: ``repeated``, ``similar`` or null (kept); home: doc_id of the earliest line that makes
    this one go; links: number of different lines within ``edits``.
    """
    lines = _lines(docs)
    classes = keep(
        lines.groupBy("h1", "h2").agg(F.min(_place()).alias("place"), F.count("*").alias("n")), "line-classes"
    )
    pairs = similar_pairs(lines, edits)
    both = pairs.union(pairs.select(F.col("b"), F.col("a")))
    places = classes.select(F.col("h1").alias("b"), F.col("place").alias("other"))
    partners = both.join(places, "b").groupBy(F.col("a").alias("h1")).agg(
        F.min("other").alias("other"), F.count("*").alias("links")
    )
    marked = classes.join(partners, "h1", "left").filter("n > 1 or links is not null")
    marked = keep(marked.select("h1", "h2", "place", "other", F.coalesce("links", F.lit(0)).alias("links")), "line-marks")
    found = lines.drop("line").join(marked, ["h1", "h2"])
    here = _place()
    similar = F.col("other") < F.col("place")
    reason = F.when(here != F.col("place"), "repeated").when(similar, "similar")
    home = F.when(similar, F.col("other.doc")).when(here != F.col("place"), F.col("place.doc"))
    return found.select("doc_id", "text_hash", "number", reason.alias("reason"), home.alias("home"), "links")


def dedup(docs: DataFrame, carry: list[str] | None = None, edits: int = EDITS) -> DataFrame:
    """Every row with its kept text: the columns ``carry`` (doc_id by default), then

    new_text (null where the text was), n_lines, n_repeated, n_similar, n_links, homes (sorted ids).
    """
    carry = carry or ["doc_id"]
    one = F.struct("number", "reason", "home", "links")
    marks = judged(docs, edits).groupBy("doc_id", "text_hash").agg(F.collect_set(one).alias("marks"))
    rows = docs.select(
        *(F.col(c).alias(f"own_{i}") for i, c in enumerate(carry)),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    joined = rows.alias("r").join(
        marks.alias("m"),
        F.col("r.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("r.text_hash") == F.col("m.text_hash")),
        "left",
    )
    marks_ = F.coalesce("m.marks", F.array().cast(marks.schema["marks"].dataType))
    gone = F.filter(marks_, lambda m: m["reason"].isNotNull())
    numbers = F.transform(gone, lambda m: m["number"])
    of = lambda reason: F.size(F.filter("gone", lambda m: m["reason"] == reason)).cast("bigint")
    sized = joined.select(
        *(F.col(f"own_{i}") for i in range(len(carry))),
        F.col("r.text").alias("text"),
        gone.alias("gone"),
        numbers.alias("numbers"),
        F.aggregate(marks_, F.lit(0).cast("bigint"), lambda s, m: s + m["links"]).alias("n_links"),
    )
    lines, left = line_list(F.col("text")), F.array_join(
        F.filter(line_list(F.col("text")), lambda line, i: ~F.array_contains(F.col("numbers"), i)), "\n"
    )
    return sized.select(
        *(F.col(f"own_{i}").alias(c) for i, c in enumerate(carry)),
        F.when(F.size("numbers") == 0, F.col("text")).otherwise(left).alias("new_text"),
        F.size(lines).cast("bigint").alias("n_lines"),
        of("repeated").alias("n_repeated"),
        of("similar").alias("n_similar"),
        "n_links",
        F.array_sort(F.array_distinct(F.transform("gone", lambda m: m["home"]))).alias("homes"),
    )
