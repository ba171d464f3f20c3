import random

from stormledger.llm.warc import PERMITTED, canonical_url, resolve

SCHEMA = "record_id long, kind string, url string, time long, digest string, headers map<string,string>, note string"


def slow(records):
    out = []
    for v in records:
        if v[1] != "revisit":
            continue
        best = None
        for r in records:
            if r[1] == "response" and v[2] is not None and r[2] == v[2] and r[3] is not None and v[3] is not None and r[3] < v[3]:
                if best is None or (r[3], r[0]) > (best[3], best[0]):
                    best = r
        own = v[5]
        if best is None:
            out.append((v[0], "no_response", None, None))
            continue
        if own.get("etag") is not None:
            same = own["etag"].removeprefix("W/") == (best[5].get("etag") or "?").removeprefix("W/")
        elif own.get("last-modified") is not None:
            same = own["last-modified"] == best[5].get("last-modified")
        else:
            same = None
        status = "unchecked" if same is None else "resolved" if same else "changed"
        merged = {**best[5], **{k: x for k, x in own.items() if k in PERMITTED}} if same else None
        out.append((v[0], status, best[0], merged))
    return sorted(out)


def test_equals_brute_force_over_many_ranges(spark):
    random.seed(6)
    urls = ["h.example/a"] * 12 + ["h.example/b", "h.example/c", None]
    records = []
    for i in range(500):
        full = random.random() < 0.3
        headers = {}
        if random.random() < 0.7:
            headers["etag"] = random.choice(["", "W/"]) + random.choice('"x" "y"'.split())
        if random.random() < 0.5:
            headers["last-modified"] = random.choice("12")
        headers |= {"date": str(i), "content-length": str(i), "server": "s"}
        time = random.choice([None, *range(60)]) if random.random() < 0.1 else random.randrange(60)
        records.append((i, "response" if full else "revisit", random.choice(urls), time, f"d{i}" if full else None, headers, "x"))
    df = spark.createDataFrame(records, SCHEMA).repartition(3)
    found = sorted((r.record_id, r.status, r.response.record_id if r.response else None, r.merged) for r in resolve(df).collect())
    assert found == slow(records)


def test_canonical_addresses(spark):
    same = ["http://WWW.Host.org:80/p/?utm_source=a&ref=b#top", "https://host.org/p", "host.org/p/", "https://host.org:443/p?ref=x"]
    other = ["https://host.org/P", "https://m.host.org/p", "https://host.org/p?page=2&ref=x", None, ""]
    df = spark.createDataFrame([(u,) for u in same + other], "url string").select("url", canonical_url(df_col()).alias("c"))
    got = {r.url: r.c for r in df.collect()}
    assert {got[u] for u in same} == {"host.org/p"}
    assert [got[u] for u in other] == ["host.org/P", "m.host.org/p", "host.org/p?page=2", None, ""]


def df_col():
    from pyspark.sql import functions as F

    return F.col("url")


def test_empty_table(spark):
    assert resolve(spark.createDataFrame([], SCHEMA)).count() == 0
