"""op6: revisits among archive records that every page gives rise to.

A page is captured once in full, in order of its id. Later, or for some pages
earlier, the address is asked again under condition; what that answer carries
follows from the page's length, so all outcomes occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormledger.llm.warc import resolve


def records(pages: DataFrame) -> DataFrame:
    """Two records per page: a full response and a revisit."""
    text = lambda c: c.cast("string")
    n = F.length(F.coalesce("html", F.lit("")))
    page = pages.select("page_id", "url", n.cast("long").alias("n"), F.md5(F.coalesce("html", F.lit(""))).alias("digest"))
    taken = F.col("page_id") * 10
    tag = F.concat(F.lit('"'), F.col("digest"), F.lit('"'))
    again = F.when(F.col("n") % 7 == 0, taken - 5).otherwise(taken + 5 + 10 * (F.col("n") % 1000))
    shown = (
        F.when(F.col("n") % 5 == 1, F.concat(F.lit("W/"), tag))
        .when(F.col("n") % 5 == 2, F.concat(F.lit('"'), F.md5(F.coalesce("url", F.lit(""))), F.lit('"')))
        .when(F.col("n") % 5 > 2, tag)
    )
    named = lambda *pairs: F.map_filter(F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())
    full = named(
        ("cache-control", F.lit("max-age=60")), ("content-length", text(F.col("n"))), ("content-type", F.lit("text/html")),
        ("etag", tag), ("last-modified", text(taken)),
    )
    short = named(
        ("cache-control", F.lit("max-age=600")), ("content-length", F.lit("0")), ("date", text(again)),
        ("etag", shown), ("last-modified", F.when(F.col("n") % 10 == 0, text(taken))), ("server", F.lit("edge")),
    )
    one = lambda k, kind, time, digest, headers: F.struct(
        (F.col("page_id") * 2 + k).alias("record_id"), F.lit(kind).alias("kind"), F.col("url"), time.alias("time"),
        digest.alias("digest"), headers.alias("headers"),
    )
    both = F.array(one(0, "response", taken, F.col("digest"), full), one(1, "revisit", again, F.lit(None).cast("string"), short))
    return page.select(F.explode(both).alias("r")).select("r.*")


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve(records(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    lines = F.transform(F.array_sort(F.map_entries("merged")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select(
        "record_id",
        "address",
        "time",
        "status",
        F.col("response.record_id").alias("response_id"),
        F.when(F.col("status") == "resolved", F.col("response.digest")).alias("payload_digest"),
        F.array_join(lines, "\n").alias("headers"),
    )


OP6_SQL = r"""
with page as (
  select page_id, url, length(coalesce(html, '')) as n, md5(coalesce(html, '')) as digest, page_id * 10 as taken,
    regexp_replace(regexp_replace(url, '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') as bare
  from pages
), split as (
  select *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '') as host,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(bare, '^[^/?]*', ''),
      '([?&])(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '\1', 'g'), '&&+', '&', 'g'), '\?&+', '?', 'g') as rest
  from page
), located as (
  select *, host || regexp_replace(regexp_replace(rest, '[?&]+$', ''), '/+$', '') as address,
    '"' || digest || '"' as tag,
    case when n % 7 = 0 then taken - 5 else taken + 5 + 10 * (n % 1000) end as again,
    case when n % 5 = 1 then 'W/"' || digest || '"' when n % 5 = 2 then '"' || md5(coalesce(url, '')) || '"'
         when n % 5 > 2 then '"' || digest || '"' end as shown
  from split
), found as (
  select v.page_id * 2 + 1 as record_id, v.address, v.again as time, v.shown, v.n % 10 = 0 as dated, v.taken as own_taken,
    r.page_id * 2 as response_id, r.digest, r.tag, r.taken, r.n
  from located v asof left join located r on v.address = r.address and v.again > r.taken
), judged as (
  select *, case when response_id is null then 'no_response'
    when shown is not null then case when ltrim(shown, 'W/') = tag then 'resolved' else 'changed' end
    when dated then case when own_taken = taken then 'resolved' else 'changed' end
    else 'unchecked' end as status
  from found
)
select record_id, address, time, status, response_id,
  case when status = 'resolved' then digest end as payload_digest,
  case when status = 'resolved' then 'cache-control: max-age=600' || chr(10) || 'content-length: ' || n || chr(10)
    || 'content-type: text/html' || chr(10) || 'date: ' || time || chr(10) || 'etag: ' || coalesce(shown, tag) || chr(10)
    || 'last-modified: ' || taken end as headers
from judged
"""
