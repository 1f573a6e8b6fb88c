"""The queries of this subpackage: thin digests of what its operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(name: str, n: int) -> Column:
    return F.crc32(F.col(name).cast("string")) % n


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from panelmill.llm.bpe import round_trip

    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelmill.llm import language

    docs = _table(spark, sf_dir, "documents")
    held_out = _remainder("doc_id", 3) == 1
    return language.identify(docs, language.fit(docs, _remainder("doc_id", 3) != 1), held_out)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelmill.llm.mixing import taken

    return taken(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelmill.llm import quality

    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), _remainder("doc_id", 5) != 0)
    return quality.score(docs, model, _remainder("doc_id", 5) == 0)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelmill.llm.substrings import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelmill.llm.similar import linked

    return linked(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from panelmill.llm.token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_chat_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelmill.llm.threads import threads

    return threads(_table(spark, sf_dir, "conversations"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelmill.llm import rules

    docs = _table(spark, sf_dir, "documents")
    out = rules.judged(docs, rules.fit(docs, _table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def quality_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op9 counts before its list decides."""
    from panelmill.llm import rules

    out = rules.judged(_table(spark, sf_dir, "documents"), [])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelmill.llm.topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from panelmill.llm.pieces import round_trip

    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_pane_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelmill.llm.panes import revised

    clicks = _table(spark, sf_dir, "clicks").where("ts is not null and arrived_at is not null")
    day = F.unix_date(F.col("arrived_at").cast("date"))
    cents = F.col("value") * 100 + 0.5
    cents = F.when(F.abs(cents) < float(1 << 53), F.floor(cents)).otherwise(0)  # null, not finite or beyond exact integers: 0
    once = clicks.groupBy("click_id").agg(F.min(F.struct("arrived_at", "ts", "kind", "value")).alias("first"))
    rows = once.select("click_id", "first.*").withColumn("q", F.pmod(day, F.lit(10)))
    rows = rows.select(
        F.least(F.lit(9), F.col("q") + F.greatest(F.lit(0), F.crc32(F.col("click_id").cast("string")) % 30 - 23)).alias("batch"),
        F.col("click_id").alias("id"), (F.col("ts").cast("timestamp_ntz") - F.make_dt_interval(day - F.col("q"))).alias("at"), "kind", cents.alias("cents"),
    )
    return revised(rows, 10)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelmill.llm import lexical

    return lexical.search(lexical.build(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()} | {"quality_statistics": quality_statistics}


def oracle_sql() -> dict[str, str]:
    return {"op3_source_mix": MIX, "quality_statistics": STATISTICS, "op5_suffix_dedup": REPEATS, "op6_jaccard_join": LINKS, "op10_exact_topk": TOP_K, "op12_pane_revisions": PANES, "op13_lexical_search": LEXICAL}


#: All 50-byte strings with the least document that has them; the runs that later documents lose; what stays.
REPEATS = """
with d as (
  select doc_id, encode(coalesce(text, '')) as b, octet_length(encode(coalesce(text, ''))) as n from documents
), windows as (
  select doc_id, i, b[i + 1:i + 50] as w from (select doc_id, b, unnest(range(0, n - 49)) as i from d where n >= 50)
), earliest as (
  select w, min(doc_id) as least from windows group by w having min(doc_id) < max(doc_id)
), hits as (
  select doc_id, i from windows join earliest using (w) where doc_id > least
), marked as (
  select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as fresh from hits
), numbered as (
  select doc_id, i, sum(fresh) over (partition by doc_id order by i) as run from marked
), runs as (
  select doc_id, run, min(i) as low, max(i) + 50 as high from numbered group by doc_id, run
), gaps as (
  select doc_id, low, high, coalesce(lag(high) over (partition by doc_id order by low), 0) as since,
         lead(low) over (partition by doc_id order by low) is null as is_last from runs
), kept as (
  select doc_id, sum(high - low) as removed, count(*) as spans,
         string_agg(hex(b[since + 1:low]), '' order by low) || max(case when is_last then hex(b[high + 1:n]) else '' end) as rest
  from gaps join d using (doc_id) group by doc_id
)
select doc_id, cast(n as bigint) as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed, cast(coalesce(spans, 0) as bigint) as n_spans,
       sha256(case when rest is null then b else unhex(rest) end) as kept_sha256
from d left join kept using (doc_id)
"""

#: Equal sets are one class; classes that share a shingle are compared; the least reachable class is the component.
LINKS = """
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents
), s as (
  select doc_id, list_sort(list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as g from d
), classes as (
  select g, min(doc_id) as c, len(g) as n from s where len(g) > 0 group by g
), parts as (
  select c, n, unnest(g) as x from classes
), pairs as (
  select a.c as a, b.c as b from parts a join parts b on a.x = b.x and a.c <> b.c
  group by a.c, b.c, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(c, least) as (
  select c, c from classes union select pairs.b, reach.least from reach join pairs on pairs.a = reach.c
), components as (
  select c, min(least) as component_id from reach group by c
)
select doc_id, cast(len(s.g) as bigint) as n_shingles, cast(coalesce(component_id, doc_id) as bigint) as component_id
from s left join classes on s.g = classes.g left join components using (c)
"""

#: Targets under their caps by sources in the order of cap / weight; documents by the hash of id and text.
MIX = """
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(concat_ws(':', 'mix', doc_id, text)), 1, 15))::bigint as key from documents
), s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as place from d group by source
), w as (
  select *, [5.0::double, 2.0::double, 1.0::double][(place % 3 + 1)::int] as weight, 2.0::double * source_size as cap from s
), u as (
  select *, (1.5::double * (select sum(source_size) from w)::double - coalesce(sum(cap) over before, 0)) / ((select sum(weight) from w) - coalesce(sum(weight) over before, 0)) as unit
  from w window before as (order by cap / weight, place rows between unbounded preceding and 1 preceding)
), t as (
  select source, source_size, least(cap, coalesce((select arg_min(unit, struct_pack(r := cap / weight, p := place)) from u where unit * weight <= cap) * weight, cap)) as target from u
), units as (
  select doc_id, source, key, size, count(*) as n from d group by all
), m as (
  select *, coalesce(sum(size * n) over (partition by source order by key % 2147483648, key, doc_id rows between unbounded preceding and 1 preceding), 0) + size * n / 2 as middle from units
)
select doc_id, size, source_size, target, (size * ((middle <= target)::int + (middle + source_size <= target and size > 0)::int))::bigint as taken
from m join t on m.source is not distinct from t.source, lateral unnest(range(n))
"""

#: The counts of op9: words of 5-word windows that occur twice, lines equal to an earlier one.
STATISTICS = """
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents
), g as (
  select doc_id, i, array_to_string(w[i:i + 4], ' ') as g from d, lateral unnest(range(1, len(w) - 3)) as r(i)
), again as (
  select doc_id, i from g qualify count(*) over (partition by doc_id, g) > 1
), covered as (
  select doc_id, count(distinct i + k) as n from again, range(5) as r(k) group by doc_id
), lines as (
  select doc_id, count(*) - count(distinct line) as n from (select doc_id, unnest(string_split(t, chr(10))) as line from d) where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id
), c as (
  select doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols, coalesce(lines.n, 0)::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words
  from d left join lines using (doc_id) left join covered using (doc_id)
)
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from c
"""

#: Scores of each query against every other row, in integers.
TOP_K = """
with e as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, e.vec_id, cast(list_dot_product(q.v, e.v) as bigint) as score
  from e q join e on q.vec_id <> e.vec_id where q.vec_id % 50 = 0
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

#: Rows by batch with the bound of each; a pane's totals after each batch; its first batch as due, and what comes after.
PANES = """
with once as (
  select click_id, ts, arrived_at, kind, value from clicks where ts is not null and arrived_at is not null
  qualify row_number() over (partition by click_id order by arrived_at, ts, kind nulls first, value nulls first) = 1
), keyed as (
  select *, date_diff('day', date '1970-01-01', arrived_at::date) as d,
         xor(list_reduce([4294967295::bigint] || list_transform(string_split(click_id::varchar, ''), lambda c: ascii(c)::bigint),
           lambda h, x: xor(h >> 8, list_reduce([xor(h, x) & 255, 0::bigint, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))), 4294967295) as crc from once
), placed as (
  select click_id, coalesce(kind, 'none') as kind, epoch_us(ts) - (d - d % 10) * 86400000000 as us,
         least(9, d % 10 + greatest(0, crc % 30 - 23)) as batch, case when abs(100 * value + 0.5) < 9007199254740992 then floor(100 * value + 0.5)::bigint else 0 end as cents from keyed
), hours as (
  select *, (us - ((us % 3600000000) + 3600000000) % 3600000000) // 3600000000 as hour from placed
), bounds as (
  select b.batch, (select max(us) from hours where hours.batch < b.batch) as w from range(10) as b(batch)
), judged as (
  select hours.*, coalesce(w >= (hour + 49) * 3600000000, false) as is_late from hours join bounds using (batch)
), steps as (
  select kind, hour, batch, count(*) as n, sum(cents)::bigint as c from judged where not is_late group by all
), running as (
  select *, sum(n) over upto as n_all, sum(c) over upto as c_all, min(batch) over (partition by kind, hour) as since,
         (select min(batch) from bounds where w >= (hour + 13) * 3600000000) as due
  from steps window upto as (partition by kind, hour order by batch)
), sent as (
  select *, case when due is not null then greatest(since, due) end as first_sent from running
), records as (
  select batch, hour, click_id, 1 as n_rows, cents, 'late' as record, kind from judged where is_late
  union all
  select first_sent, hour, -1, max(n_all), max_by(c_all, batch), 'emit', kind from sent where batch <= first_sent group by first_sent, hour, kind
  union all
  select batch, hour, -1, n_all - n, c_all - c, 'retract', kind from sent where batch > first_sent
  union all
  select batch, hour, -1, n_all, c_all, 'replace', kind from sent where batch > first_sent
  union all
  select 9, hour, -1, sum(n), sum(c), 'final', kind from sent where due is null group by hour, kind
)
select batch::bigint as batch, hour::bigint as hour, click_id::bigint as click_id, n_rows::bigint as n_rows, cents::bigint as cents, record, kind from records
"""

#: Every term of every document against the items' terms.
LEXICAL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents
), sizes as (
  select doc_id, len(w)::bigint as n from d where len(w) > 0
), total as (
  select count(*)::bigint as docs, sum(n)::bigint as terms from sizes
), asked as (
  select item_id, term, count(*) as often from (
    select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
  ) group by all
), found as (
  select doc_id, term, count(*)::bigint as tf from (select doc_id, unnest(w) as term from d) where term in (select term from asked) group by all
), weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from found, total group by term, docs
), scored as (
  select item_id, doc_id, sum(often * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::bigint as score
  from asked join weights using (term) join found using (term) join sizes using (doc_id), total group by item_id, doc_id
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score from scored where score > 0
)
select * from ranked where rank <= 20
"""
