"""The registered queries of the subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymart.llm import (
    brown,
    collocations,
    decontaminate,
    langid,
    line_dedup,
    mixing,
    near_dup,
    packing,
    periodic_runs,
    secrets,
    suffix_dedup,
    token_file,
    topk,
)
from skymart.llm.common import scratch, table
from skymart.llm.ship import shipped

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_file.write(table(spark, sf_dir, "documents"), path)
    return token_file.checksums(token_file.with_start(token_file.read(spark, path), path))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), scratch(spark, "ledger"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *(secrets.count(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secrets.joined(spans), 256).alias("base_sha256"),
        secrets.joined(spans).alias("spans"),
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _fold(n: int) -> Column:
    """Remainder that splits training rows from held-out ones."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = brown.score(table(spark, sf_dir, "documents"), _fold(7) != 2)
    return scored.select(
        "doc_id",
        F.coalesce(_fold(7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, _fold(4) != 2)
    return langid.predict(docs, model).select(
        "doc_id",
        F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "cross_entropy",
        "rejected",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_lines",
        "n_repeated",
        "n_similar",
        "n_links",
        F.array_join(F.transform("homes", lambda h: h.cast("string")), ",").alias("homes"),
        F.sha2(F.coalesce("new_text", F.lit("")), 256).alias("kept_sha256"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents"))
    return found.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _repeated_from(doc_id: Column, text: Column) -> Column:
    """Text with a periodic stretch set in: word i >= a is word a + (i - a) % p for a tenth of the ids."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    w = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size(w).cast("bigint")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(again, F.lit(1), (n - a).cast("int"))), " ")
    return F.when((h % 10 == 0) & (n > 0), changed).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.periodic_runs(docs.select("doc_id", _repeated_from(F.col("doc_id"), F.col("text")).alias("text")))
    listed = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, documents = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken(pieces, documents).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Query] = {
    query.__name__: shipped(query)
    for query in (
        op1_decontamination,
        op2_packing,
        op3_lm_scores,
        op4_token_output,
        op5_topk,
        op6_near_dup,
        op7_secret_scan,
        op8_suffix_dedup,
        op9_language_id,
        op10_line_dedup,
        op11_collocations,
        op12_periodic_runs,
        op13_mixing,
    )
}

OP1_SQL = """
with texts as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from documents
), items as (
    select item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from benchmark where item_id is not null
), windows as (
    select distinct item_id, n, w[i:i + n - 1] as g
    from (select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i
          from items where len(w) > 0)
), spans as (
    select doc_id, n, w[i:i + n - 1] as g, i
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
          from texts, (select distinct n from windows) where len(w) >= n)
), hits as materialized (
    select doc_id, i, n, item_id from spans join windows using (n, g)
), words as (
    select doc_id, count(distinct p) as n_hit
    from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id
), found as (
    select doc_id, count(distinct item_id) as n_items,
           sha256(string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar))) as d
    from hits group by doc_id
)
select t.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       coalesce(d, sha256('')) as items_sha256, n_hit is not null as contaminated
from texts t left join words using (doc_id) left join found using (doc_id)
"""

OP5_SQL = """
with vectors as (
    select vec_id, list_transform(embedding, lambda e: cast(floor(1024 * cast(e as double)) as bigint)) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id as vec_id,
           cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
    from vectors q join vectors c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
)
select query_id, cast(rank as int) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 10
"""

OP6_SQL = """
with recursive words as (
    select doc_id, list_filter(
        regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
    from documents
), sets as materialized (
    select doc_id, list_distinct(case
        when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: list_aggregate(w[i:i + 3], 'string_agg', ' '))
        when len(w) > 0 then [list_aggregate(w, 'string_agg', ' ')]
        else [] end) as s
    from words
), shingles as materialized (
    select doc_id, unnest(s) as g from sets
), common as (
    select a.doc_id as a, b.doc_id as b, count(*) as n
    from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id
    group by all
), links as materialized (
    select a, b from common join sets x on x.doc_id = a join sets y on y.doc_id = b
    where 100 * n >= 80 * (len(x.s) + len(y.s) - n)
), ways as materialized (
    select a, b from links union all select b, a from links
), reach(a, b) as (
    select a, b from ways union select reach.a, ways.b from reach join ways on reach.b = ways.a
), labels as (
    select a, min(b) as least from reach group by a
)
select doc_id, len(coalesce(s, [])) as n_shingles, least(doc_id, coalesce(least, doc_id)) as component_id,
       doc_id = least(doc_id, coalesce(least, doc_id)) as kept
from sets left join labels on labels.a = doc_id
"""

OP10_SQL = """
with lines as (
    select doc_id, unnest(string_split(text, chr(10))) as line,
           unnest(range(len(string_split(text, chr(10))))) as number
    from documents where text <> ''
), classes as (
    select line, min((doc_id, number)) as place from lines where trim(line) <> '' group by line
), halves as (
    select line, place, length(line) as n from classes where length(line) >= 24
), met as (
    select a.line as x, b.line as y, a.place as p, b.place as q
    from halves a join halves b
      on left(a.line, a.n // 2) = left(b.line, a.n // 2) and b.n between a.n and a.n + 1 and a.line <> b.line
    union
    select a.line, b.line, a.place, b.place
    from halves a join halves b
      on right(a.line, a.n - a.n // 2) = right(b.line, a.n - a.n // 2) and b.n between a.n and a.n + 1
         and a.line <> b.line
), near as (
    select x, y, p, q from met where levenshtein(x, y) <= 1
), links as (
    select x, y, q from near union select y, x, p from near
), partners as (
    select x as line, count(*) as links, min(q) as other from links group by x
), marks as (
    select doc_id, number, coalesce(links, 0) as links,
           case when (doc_id, number) <> place then 'repeated' when other < place then 'similar' end as reason,
           case when other < place then other[1] when (doc_id, number) <> place then place[1] end as home
    from lines join classes using (line) left join partners using (line)
), by_doc as (
    select doc_id, count(*) as n_lines,
           count(*) filter (where reason = 'repeated') as n_repeated,
           count(*) filter (where reason = 'similar') as n_similar,
           cast(sum(coalesce(m.links, 0)) as bigint) as n_links,
           list_sort(list_distinct(list(home) filter (where home is not null))) as homes,
           coalesce(string_agg(line, chr(10) order by number) filter (where reason is null), '') as kept
    from lines left join marks m using (doc_id, number) group by doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_repeated, 0) as n_repeated,
       coalesce(n_similar, 0) as n_similar, coalesce(n_links, 0) as n_links,
       coalesce(list_aggregate(list_transform(homes, lambda h: cast(h as varchar)), 'string_agg', ','), '') as homes,
       sha256(coalesce(kept, '')) as kept_sha256
from documents d left join by_doc using (doc_id)
"""

OP11_SQL = """
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents where text is not null
), words as materialized (
    select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces
), spans as (
    select lang, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') as phrase
    from (select lang, k, w, unnest(range(1, len(w) - k + 2)) as i
          from words, (select unnest(range(1, 6)) as k) where len(w) >= k)
), totals as (
    select lang, cast(sum(len(w)) as hugeint) as n from words group by lang
), counts as materialized (
    select lang, k, phrase, cast(count(*) as hugeint) as f from spans group by all having count(*) >= 100
), cuts as (
    select lang, k, phrase, f as a, string_split(phrase, ' ') as w, unnest(range(1, k)) as c from counts where k > 1
), scores as (
    select x.lang, x.k, x.phrase, a, c, p.f as l, q.f as r, n, (1000 * a * n) // (p.f * q.f) as score
    from cuts x join totals t on t.lang = x.lang
    join counts p on p.lang = x.lang and p.phrase = list_aggregate(w[1:c], 'string_agg', ' ')
    join counts q on q.lang = x.lang and q.phrase = list_aggregate(w[c + 1:], 'string_agg', ' ')
), best as (
    select * from scores qualify row_number() over (partition by lang, phrase order by score, c) = 1
), inner_spans as (
    select lang, f, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') as phrase
    from (select lang, f, w, m, unnest(range(1, k - m + 2)) as i
          from (select lang, k, f, string_split(phrase, ' ') as w, unnest(range(2, k)) as m from counts where k > 2))
), covers as (
    select lang, phrase, max(f) as most from inner_spans group by all
), kept as (
    select b.* from best b left join covers c on c.lang = b.lang and c.phrase = b.phrase
    where most is null or 100 * most < 100 * a
)
select lang, rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
       cast(n as bigint) as n, cast(score as bigint) as score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
where rank <= 2000
"""

OP13_SQL = """
with sized as (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as hugeint) as size,
           md5(concat_ws(':', coalesce(cast(doc_id as varchar), '-'), md5(coalesce(text, '')))) as shuffled
    from documents
), placed as (
    select *, coalesce(sum(size) over (partition by source order by shuffled, doc_id
                                       rows between unbounded preceding and 1 preceding), 0) as start
    from sized
), sources as (
    select source, sum(size) as s, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w
    from sized group by source
), ranked as (
    -- sources in the order in which three times their size binds
    select *, row_number() over (order by 6 * s // w, w) as i, sum(s) over () as t from sources
), steps as (
    select i, w, s, t - 3 * (sum(s) over (order by i) - s) as share, sum(w) over (order by i desc) as parts from ranked
), chosen as (
    select share, parts, i from steps where w * share <= 3 * s * parts order by i limit 1
), targets as (
    select r.source, r.s, case when r.i < c.i then cast(3 * r.s as double)
                               else cast(r.w * c.share as double) / cast(c.parts as double) end as target,
           case when r.i < c.i then 3 * r.s else (r.w * c.share) // c.parts end as take
    from ranked r, chosen c
)
select doc_id, cast(size as bigint) as size, cast(s as bigint) as source_size, target,
       cast(case when size = 0 then 0
                 else (take // s) * size + greatest(0, least(size, take % s - start)) end as bigint) as taken
from placed p join targets x on x.source is not distinct from p.source
"""

ORACLES: dict[str, str] = {
    "op13_mixing": OP13_SQL,
    "op11_collocations": OP11_SQL,
    "op10_line_dedup": OP10_SQL,
    "op1_decontamination": OP1_SQL,
    "op5_topk": OP5_SQL,
    "op6_near_dup": OP6_SQL,
}
