"""Not-modified revisits of a web archive, resolved to the responses they stand for.

A revisit holds no body: it says that a conditional request found the resource
unchanged. It belongs to the latest earlier full response of the same canonical
address, provided the validators agree, and updates that response's headers with
the few a not-modified answer may carry.

The as-of join sorts all records by address and time over ranges, so an address
with a third of all captures is cut along time. Inside a range a running last
value finds the response; what was last before a range is carried in from the
ranges that hold the same address, which are as few as the ranges. Bodies never
move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormledger.llm.common import kept

# Headers that a not-modified answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that only track.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def canonical_url(url: Column) -> Column:
    """Address without scheme, www, default port, fragment, tracking parameters and closing slash; host in lower case."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    rest = F.regexp_replace(bare, r"^[^/?]*", "")
    rest = F.regexp_replace(rest, rf"([?&])({TRACKING})=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, "&&+", "&"), r"\?&+", "?")
    return F.concat(host, F.regexp_replace(F.regexp_replace(rest, "[?&]+$", ""), "/+$", ""))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def with_latest_response(records: DataFrame, tie: str = "record_id") -> DataFrame:
    """``records`` with ``response``: the latest full response before each record, by address and time.

    A response of the same instant is not earlier. Of several responses of one
    instant the one with the largest id counts. A null address or time has none.
    """
    keys = ["address", "time", "full", tie]
    rows = records.withColumn("full", F.when(F.col("kind") == "response", 1).otherwise(0))
    placed = kept(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "records")
    body = F.struct("time", tie, "digest", "headers")
    whole = F.col("full") == 1
    # A range is of bounded size, and so is an address inside it. Within an instant full responses come last.
    before = Window.partitionBy("part", "address").orderBy("time", "full", tie).rowsBetween(Window.unboundedPreceding, -1)
    near = placed.withColumn("near", F.last(F.when(whole, body), ignorenulls=True).over(before))
    # Addresses that begin in one range and go on in the next: one per border at most.
    per_part = placed.groupBy("address", "part").agg(F.max(F.when(whole, body.dropFields("headers", "digest"))).alias("top"))
    spans = per_part.groupBy("address").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    earlier = Window.partitionBy("address").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_part.join(spans, "address", "left_semi").withColumn("top", F.max("top").over(earlier)).filter("top is not null")
    heads = placed.filter(whole).select(F.col("address").alias("a"), F.col("time").alias("t"), F.col(tie).alias("i"), body.alias("carried"))
    same = (F.col("address") == F.col("a")) & (F.col("top.time") == F.col("t")) & (F.col(f"top.{tie}") == F.col("i"))
    carried = carried.join(heads, same).select("address", "part", "carried").dropDuplicates(["address", "part"])
    joined = near.join(carried, ["address", "part"], "left")
    found = F.coalesce("near", "carried")
    usable = F.col("address").isNotNull() & (found["time"] < F.col("time"))
    return joined.withColumn("response", F.when(usable, found)).drop("near", "carried", "part", "full")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: the record's columns, status, response and merged headers.

    ``records`` has record_id, kind (response or revisit), url, time, digest and
    headers (lower-case names). Status is ``resolved`` when the validators agree,
    ``changed`` when they differ, ``unchecked`` when the revisit has none, and
    ``no_response`` when nothing came before. An entity tag is compared weakly
    and goes before the date of modification.
    """
    located = records.withColumn("address", canonical_url(F.col("url")))
    rows = with_latest_response(located).filter("kind = 'revisit'")
    own, stored = F.col("headers"), F.col("response.headers")
    tag, date = own["etag"], own["last-modified"]
    agrees = F.when(tag.isNotNull(), F.coalesce(_weak(tag) == _weak(stored["etag"]), F.lit(False))).when(
        date.isNotNull(), F.coalesce(date == stored["last-modified"], F.lit(False))
    )
    status = (
        F.when(F.col("response").isNull(), "no_response").when(agrees.isNull(), "unchecked").when(agrees, "resolved").otherwise("changed")
    )
    update = F.map_filter(own, lambda name, _: name.isin(*PERMITTED))
    kept_back = F.map_filter(stored, lambda name, _: ~F.array_contains(F.map_keys(update), name))
    rows = rows.withColumn("status", status)
    return rows.withColumn("merged", F.when(F.col("status") == "resolved", F.map_concat(kept_back, update)))
