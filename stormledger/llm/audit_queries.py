"""op11: what five filters remove from the documents, in every order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormledger.llm.filter_audit import filter_audit


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP11_SQL = r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents
), marks as (
  select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic from labels group by doc_id
), patterns as (
  select x.part,
    case when len(ws) < 50 then 'A' else '' end
    || case when 100 * len(list_distinct(ws)) < 65 * len(ws) then 'B' else '' end
    || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when x.doc_id > min(x.doc_id) over (partition by t) then 'E' else '' end as fails,
    coalesce(m.good, false) as good, coalesce(m.toxic, false) as toxic
  from texts x left join marks m on x.doc_id = m.doc_id
), counts as (
  select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from patterns group by part, fails
), l as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as x
), orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from l a, l b, l c, l d, l e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps as (
  select filter_order, step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as before
  from orders, (select unnest(range(1, 6)) as step)
), told as (
  select part, filter_order, step::int as step, any_value(own) as own,
    coalesce(sum(n) filter (translate(fails, before || own, '') = fails), 0)::bigint as kept,
    coalesce(sum(n) filter (contains(fails, own) and translate(fails, before, '') = fails), 0)::bigint as removed,
    coalesce(sum(n) filter (contains(fails, own) and translate(fails, before, '') <> fails), 0)::bigint as redundant,
    coalesce(sum(n) filter (fails = own), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (contains(fails, own) and translate(fails, before, '') = fails), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (contains(fails, own) and translate(fails, before, '') = fails), 0)::bigint as toxic_lost
  from counts, steps group by part, filter_order, step
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley
from told
"""
