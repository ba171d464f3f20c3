"""op12: periodic runs of words in the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stormledger.llm.common import text_of
from stormledger.llm.runs import periodic_runs


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text with every word from a on replaced by a word of the first period, for a tenth of the documents.

    h is the crc32 of the id as text (a null id counts as empty text); other
    documents keep their text as it is.
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    period = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), planted).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = periodic_runs(docs.select("doc_id", with_planted_period(F.col("doc_id"), text_of()).alias("text")))
    # The greatest length first, then the smallest start and period.
    longest = F.try_element_at(
        F.array_sort(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period")))), F.lit(1)
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.withColumn("longest", longest).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.less")).alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(F.lit(1000) * -F.col("longest.less") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP12_SQL = r"""
with ids as (
  select doc_id, text, list_reduce(
    [4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint),
    lambda r, c: list_reduce([xor(r, c)] || [0::bigint, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))
  ) as r
  from documents
), split as (
  select doc_id, xor(r, 4294967295) as h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from ids
), placed as (
  select doc_id, h, h // 10 as g, ws, len(ws) as n, case when len(ws) > 0 then (h // 10) % len(ws) end as a from split
), planted as (
  select doc_id, n, case when h % 10 = 0 and n > 0
    then list_transform(range(n), lambda i: ws[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end])
    else ws end as ws
  from placed
), words as (
  select doc_id, unnest(range(n)) as i, unnest(ws) as w from planted
), matches as (
  select y.doc_id, y.i - x.i as d, y.i from words x join words y on x.doc_id = y.doc_id and x.w = y.w and x.i < y.i
), diagonals as (
  select doc_id, d, min(i) - d as s, max(i) + 1 as e
  from (select *, i - row_number() over (partition by doc_id, d order by i) as island from matches)
  group by doc_id, d, island having count(*) >= d and count(*) + d >= 12
), runs as (
  select doc_id, s, e - s as l, min(d) as q from diagonals group by doc_id, s, e
), told as (
  select doc_id, count(*) as n_runs, arg_min(struct_pack(s, l, q), struct_pack(o := -l, s, q)) as best,
    string_agg(s || ',' || l || ',' || q || chr(10), '' order by s, q) as lines
  from runs group by doc_id
), dropped as (
  select distinct doc_id, unnest(range(s + q, s + l)) as i from runs
), left_over as (
  select w.doc_id, string_agg(w.w, ' ' order by w.i) as body
  from words w anti join dropped x on w.doc_id = x.doc_id and w.i = x.i group by w.doc_id
)
select p.doc_id, coalesce(t.n_runs, 0) as n_runs, t.best.s as start, t.best.l as length, t.best.q as period,
  1000 * t.best.l // t.best.q as exponent_milli, sha256(coalesce(t.lines, '')) as runs_sha256,
  sha256(coalesce(b.body, '')) as collapsed_sha256
from planted p left join told t using (doc_id) left join left_over b using (doc_id)
"""
