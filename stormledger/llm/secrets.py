"""Secret scans that link the parts of a credential.

Candidates are found where the text is read; only their places move on. Strong
ones (an access identifier, an assigned value, a long hexadecimal run) stand for
themselves. Weak ones (an identifier-like name, a high-entropy word, a service
address) mean nothing alone: they are reported when a complementary part of the
same credential lies within ``reach`` characters in the same scope, a scope
being a run of text without an empty line.

The interval join is done on places cut into buckets of ``reach`` characters.
Per document, scope, part and bucket only the least start and the greatest end
are kept, which is all a distance needs, so a document full of candidates never
forms pairs.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stormledger.llm.common import kept, ship, text_of

#: Kinds in the order spans of one place are listed.
KINDS = ("assign", "access", "hex", "identifier", "opaque", "endpoint")
#: Characters between two parts of one credential, at most.
REACH = 200
# Fixed patterns of the strong kinds.
ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# Weak kinds: one part of a credential each.
IDENTIFIER = re.compile(r"""(?:client|account|user|key)[_-]?(?:id|name)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.I | re.A)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]+")
SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")
#: Which parts complete which: an identifier goes with a secret, a secret with either of the others.
PART = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "identifier", "identifier": "identifier", "endpoint": "endpoint"}
COMPLEMENT = {"opaque": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}
MIN_ENTROPY = 3.5


def entropy(word: str) -> float:
    """Bits per character."""
    n = len(word)
    return -sum(c / n * math.log2(c / n) for c in map(word.count, set(word)))


def strong(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the strong kinds, leftmost and without overlap per kind."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def weak(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the weak kinds outside strong spans.

    Parts of a credential are different characters: a word inside an address, or
    inside the name and value of an identifier, is no candidate of its own.
    """
    found = [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)] if "://" in text else []
    found += [("identifier", *m.span()) for m in IDENTIFIER.finditer(text)] if "=" in text or ":" in text else []
    named = sorted((s, e) for _, s, e in found)
    starts = [s for s, _ in named]
    reached = list(itertools.accumulate((e for _, e in named), max))
    for m in OPAQUE.finditer(text):
        word, before = m[0], bisect.bisect_left(starts, m.end())
        if before and reached[before - 1] > m.start():
            continue
        mixed = any(c.isdigit() for c in word) and any(c.isalpha() for c in word)
        if mixed and entropy(word) >= MIN_ENTROPY:
            found.append(("opaque", *m.span()))
    free = lambda s, e: not any(a < e and s < b for _, a, b in taken)
    return [x for x in found if free(x[1], x[2])]


def parts(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, body, spans): all candidates of each document as (kind, start, end, scope); places in code points."""
    ship(docs.sparkSession)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for value in batch.column(2):
                text = value.as_py()
                found = strong(text)
                found += weak(text, found)
                cuts = [m.end() for m in SCOPE_END.finditer(text)] if found else []
                spans.append([{"kind": k, "start": s, "end": e, "scope": bisect.bisect_right(cuts, s)} for k, s, e in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(span))], ["id", "body", "spans"])

    text = text_of(text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("body"), text.alias("text")).mapInArrow(
        run, f"id {kind}, body long, spans array<struct<kind:string,start:long,end:long,scope:int>>"
    )


def linked(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak candidates with a complementary part in reach; ``spans`` is (id, body, kind, start, end, scope)."""
    role = F.create_map(*[F.lit(x) for pair in PART.items() for x in pair])
    bucket = lambda c: F.floor(c / F.lit(reach)).cast("long")
    # A part that runs over several buckets is known in each of them.
    known = spans.select(
        "id", "body", "scope", role[F.col("kind")].alias("part"), "start", "end",
        F.explode(F.sequence(bucket(F.col("start")), bucket(F.col("end") - 1))).alias("bucket"),
    )
    known = known.groupBy("id", "body", "scope", "part", "bucket").agg(F.min("start").alias("low"), F.max("end").alias("high"))
    known = known.withColumnsRenamed({"id": "kid", "body": "kbody", "scope": "kscope", "part": "kpart", "bucket": "kbucket"})
    wants = F.create_map(*[x for k, v in COMPLEMENT.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    asking = spans.filter(F.col("kind").isin(list(COMPLEMENT))).withColumn("want", F.explode(wants[F.col("kind")]))
    reached = F.sequence(bucket(F.col("start") - reach), bucket(F.col("end") - 1 + reach))
    asking = asking.withColumn("bucket", F.explode(reached))
    same = [F.col("id").eqNullSafe(F.col("kid"))] + [F.col(c) == F.col(f"k{c}") for c in ("body", "scope", "bucket")] + [F.col("want") == F.col("kpart")]
    inside = (F.col("low") <= F.col("end") + reach) & (F.col("high") >= F.col("start") - reach)
    on = inside
    for condition in same:
        on = on & condition
    return asking.join(known, on, "left_semi").select("id", "body", "kind", "start", "end").distinct()


def secrets(docs: DataFrame, reach: int = REACH, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: (id, strong, reported), arrays of (start, rank, kind, end) in order.

    ``strong`` has the strong kinds, ``reported`` these and the linked weak ones.
    Null counts as empty. Rows that repeat id and text have equal results.
    """
    found = kept(parts(docs, id_col, text_col), "secret-parts")
    opened = found.select("id", "body", F.explode("spans").alias("s")).select("id", "body", "s.*").distinct()
    added = linked(opened, reach).groupBy("id", "body").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    added = added.withColumnsRenamed({"id": "aid", "body": "abody"})
    same = F.col("id").eqNullSafe(F.col("aid")) & (F.col("body") == F.col("abody"))
    rank = lambda kind: F.array_position(F.array(*map(F.lit, KINDS)), kind)
    place = lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"))
    own = F.transform(F.filter("spans", lambda s: ~s["kind"].isin(list(COMPLEMENT))), place)
    more = F.transform(F.coalesce("added", F.expr("array()").cast("array<struct<kind:string,start:long,end:long>>")), place)
    return found.join(added, same, "left").select(
        "id", F.array_sort(own).alias("strong"), F.array_sort(F.concat(own, more)).alias("reported")
    )
