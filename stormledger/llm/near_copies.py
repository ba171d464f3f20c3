"""Near copies by the Jaccard similarity of their word shingles, checked exactly.

Texts meet where their SimHash fingerprints lie within a few bits, and where all
minima of a band of min-hashes agree, since fingerprints alone miss most pairs of
lower similarity. With 24 bands of five
a pair of similarity 0.8 meets with a probability over 0.9999. Whether two texts
that met are similar enough is decided on their whole sets of shingles. Members
of a bucket are compared with leaders, few and then more, which unites a large
group at a cost that grows with its size, as long as that saves comparisons; then
all pairs of a bucket that are not yet in one component are compared, so no link
of a bucket is left out. That happens in cells of bounded size on bit maps of the
sets, which bound the similarity from above; only pairs that may reach it become
rows, and these are checked on the whole sets.

Equal sets of shingles collapse to one node before anything is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stormledger.llm.common import deals, kept, remember, ship, text_of
from stormledger.llm.graph import components
from stormledger.llm.simhash import SEED, links, majority_bits, shingle_hashes

WORDS, SIMILARITY = 5, 0.8
#: Bits in which fingerprints that meet may differ.
RADIUS = 4
#: Bands of min-hashes and min-hashes of a band.
BANDS, PER_BAND = 24, 5
#: Turns in which a bucket is compared with one leader only, at least; pairs per member that may be left after them.
LEADERS, SPARE = 2, 1.0
#: Comparisons in a cell that a row of a turn with leaders has to save.
WORTH = 4
#: Members of a slot of a bucket, two of which meet in a cell; rows of a task of cells.
SLOT_ROWS, ROWS_PER_TASK = 2048, 4096
#: Places of a bit map for each shingle, and of the largest map.
PLACES, WIDEST = 8, 1 << 15
#: Shingles whose min-hashes are made together; bounds the memory of a long text.
CHUNK = 4096
_RNG = np.random.default_rng(SEED)
_XOR, _ODD = (_RNG.integers(0, 1 << 64, BANDS * PER_BAND, np.uint64) for _ in range(2))
_ODD = _ODD | np.uint64(1)


def bands(grams: np.ndarray) -> np.ndarray:
    """A hash of the min-hashes of each band."""
    least = np.full(BANDS * PER_BAND, np.iinfo(np.uint64).max)
    for low in range(0, len(grams), CHUNK):
        np.minimum(least, ((grams[low : low + CHUNK, None] ^ _XOR) * _ODD).min(axis=0), out=least)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(least.reshape(BANDS, PER_BAND))], np.uint64)


def sketches(docs: DataFrame, words: int = WORDS, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, body, node, size, print, bands) of every row: hashes of its text and of its set of shingles, the set's size, the SimHash."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember()
        for batch in batches:
            sets, prints = [], []
            for text in batch.column(2):
                hashes = shingle_hashes(text.as_py(), words)
                prints.append(majority_bits(hashes))
                sets.append(np.unique(hashes))
            prints = np.array(prints, np.uint64).view(np.int64)
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64)
            made = [bands(s).view(np.int64) if len(s) else None for s in sets]
            columns = [pa.array(node.view(np.int64)), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints), pa.array(made, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["id", "body", "node", "size", "print", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("body"), text_col)
    return rows.mapInArrow(run, f"id {kind}, body long, node long, size long, print long, bands array<long>")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, grams) of rows (node, text): the sorted set of shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember()
        for batch in batches:
            made = [np.unique(shingle_hashes(t.as_py(), words)).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["node", "grams"])

    return texts.mapInArrow(run, "node long, grams binary")


def _within(nodes: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that connect all nodes (node, print) whose fingerprints lie within the radius; equal ones meet their least node."""
    first = kept(nodes.groupBy("print").agg(F.min("node").alias("node")), "prints")
    equal = nodes.join(first.withColumnRenamed("node", "a"), "print").filter("a < node").select("a", F.col("node").alias("b"))
    return kept(links(first, radius).filter("a != b").unionByName(equal).distinct(), "simhash-links")


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember()
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    own = lambda node, grams: sets.select(F.col("node").alias(node), F.col("grams").alias(grams))
    joined = pairs.join(own("b", "y"), "b").join(own("a", "x"), "a").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


def bit_map(hashes: np.ndarray) -> np.ndarray:
    """A set's hashes as set bits; the number of places is a power of two that follows the set's size."""
    width = min(WIDEST, max(64, 1 << (PLACES * len(hashes) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


def _folded(words: np.ndarray, n: int) -> np.ndarray:
    """A map in n words, as if it had been made with so few places."""
    return np.bitwise_or.reduce(words.reshape(-1, n), axis=0)


def near_pairs(sizes: np.ndarray, maps: list[np.ndarray], components: np.ndarray, slots: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (a, b) of the rows of two components whose sets may have the similarity.

    A place that one map has and the other lacks is an element that only one set
    has, so what the sets share is bounded from above and no pair is lost. Rows of
    one slot are compared with each other, rows of two slots across them.
    """
    order = np.argsort(sizes, kind="stable")
    sizes, components, slots = sizes[order], components[order], slots[order]
    maps = [maps[k] for k in order]
    widths = np.array([len(m) for m in maps])
    across = len(slots) > 0 and (slots != slots[0]).any()
    # The sets that are large enough to rule a similarity out are not looked at.
    ends = np.searchsorted(sizes, sizes / similarity + 1e-6, "right") if similarity > 0 else np.full(len(sizes), len(sizes))
    left, right = [], []
    for width in np.unique(widths):
        first, last = np.searchsorted(widths, [width, width + 1])
        words = np.stack([_folded(m, width) for m in maps[first : ends[last - 1]]])
        for k in range(first, last):
            other = np.arange(k + 1, ends[k])
            other = other[(components[other] != components[k]) & ((slots[other] != slots[k]) | (not across))]
            own, theirs = words[k - first], words[other - first]
            lacked = np.bitwise_count(own & ~theirs).sum(axis=1, dtype=np.int64)
            added = np.bitwise_count(theirs & ~own).sum(axis=1, dtype=np.int64)
            both = np.minimum(sizes[k] - lacked, sizes[other] - added)
            good = other[both >= similarity * (sizes[k] + sizes[other] - both) - 1e-9]
            left.append(np.full(len(good), k))
            right.append(good)
    if not left:
        return order, order
    return order[np.concatenate(left)], order[np.concatenate(right)]


def _candidates(members: DataFrame, sets: DataFrame, similarity: float, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Pairs (a, b), a < b, of members of a bucket in two components whose sets may have the similarity."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [bit_map(np.frombuffer(g.as_py(), np.uint64)).tobytes() for g in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["node", "map"])

    own = sets.join(members.select("node").distinct(), "node", "left_semi").select("node", "grams")
    maps = kept(own.mapInArrow(mapped, "node long, map binary"), "maps")
    counts = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(slot_rows)).cast("int").alias("slots"))
    placed = members.join(counts, "bucket").withColumn("slot", F.pmod(F.xxhash64("node"), "slots").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    cell = F.xxhash64("bucket", F.least("slot", "other"), F.greatest("slot", "other"))
    cells = kept(placed.select("node", "size", "component", "slot", cell.alias("cell")), "cells")
    n = deals(cells.count(), ROWS_PER_TASK)

    def run(table: pa.Table) -> pa.Table:
        cell, slot, size, component, node = (table.column(c).to_numpy() for c in ("cell", "slot", "size", "component", "node"))
        maps = [np.frombuffer(m.as_py(), "<u8") for m in table.column("map")]
        order = np.argsort(cell, kind="stable")
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            x, y = near_pairs(size[at], [maps[k] for k in at], component[at], slot[at], similarity)
            a.append(node[at[x]])
            b.append(node[at[y]])
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    dealt = cells.join(maps, "node").withColumn("deal", F.pmod(F.xxhash64("cell"), F.lit(n)))
    return dealt.groupBy("deal").applyInArrow(run, "a long, b long").distinct()


def _open(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    split = members.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    return members.join(split.select("bucket"), "bucket", "left_semi")


def _open_pairs(members: DataFrame, each: int) -> tuple[int, int]:
    """How many pairs of a bucket lie in two components, and the rows of a turn with so many leaders a bucket."""
    per = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = per.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return tuple(buckets.agg(total((F.col("n") * F.col("n") - F.col("inside")) / 2), total(F.col("n") * F.least(F.col("n"), F.lit(each)))).first())


def _leaders(members: DataFrame, turn: int, each: int) -> DataFrame:
    """(bucket, node_a, size_a, component_a): one member of each bucket, and beyond that about ``each``.

    By one order for all buckets, so that the buckets of a group have few leaders.
    """
    row = F.struct("node", "size", "component")
    order = F.xxhash64("node", F.lit(turn))
    first = members.groupBy("bucket").agg(F.min_by(row, order).alias("l"), F.count(F.lit(1)).alias("n"))
    named = [F.col(f"l.{c}").alias(f"{c}_a") for c in ("node", "size", "component")]
    if each == 1:
        return first.select("bucket", *named)
    drawn = F.pmod(order, F.lit(1 << 30)) < F.lit(float(each << 30)) / F.col("n")
    more = members.join(first.select("bucket", "n"), "bucket").filter(drawn).select("bucket", row.alias("l"))
    return first.select("bucket", "l").union(more).distinct().select("bucket", *named)


def labels(rows: DataFrame, docs: DataFrame, words: int, similarity: float, text_col: str, leaders: int = LEADERS, spare: float = SPARE) -> DataFrame:
    """(node, component) of the nodes of ``rows`` that share a bucket with another or have a fingerprint near another's.

    Links of fingerprints come first, so that a bucket starts with the components
    they make. Members of a bucket are compared with its leaders, turn after turn, each time
    only with those of other components. From ``leaders`` turns on the number of
    leaders doubles, as long as a turn saves ``WORTH`` comparisons for each of its rows. When
    it does not, or when the pairs of two components that are left are few
    (``spare`` for each member), all of these are compared in cells.
    """
    nodes = kept(rows.groupBy("node").agg(F.min("body").alias("body"), F.first("size").alias("size"), F.min("print").alias("print"), F.first("bands").alias("bands")), "nodes")
    close = _within(nodes.select("node", "print"), RADIUS)
    opened = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    shared = opened.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    members = kept(opened.join(shared, "bucket").withColumn("component", F.col("node")), "members")
    linked = close.select(F.explode(F.array("a", "b")).alias("node"))
    label = kept(members.select("node").union(linked).distinct().withColumn("component", F.col("node")), "labels")
    wanted = nodes.join(label, "node", "left_semi").select("node", "body")
    bodies = docs.select(F.xxhash64(text_of(text_col)).alias("body"), F.col(text_col).alias("text"))
    sets = kept(_sets(bodies.join(wanted, "body").select("node", "text"), words).dropDuplicates(["node"]), "shingles")
    turn, last, many, before = 0, False, members.count(), None
    edges = kept(_similar(close, sets, similarity), "similar")
    if not edges.isEmpty():
        label = _united(label, edges)
        members = kept(_open(members.drop("component").join(label, "node")), "open-buckets")
    while not members.isEmpty():
        each = 1 << max(0, turn - leaders + 1)
        if turn >= leaders:
            left, cost = _open_pairs(members, each)
            paid = before is None or before[0] - left >= WORTH * before[1]
            last, before = left <= spare * many or left <= cost or not paid, (left, cost)
        if last:
            pairs = kept(_candidates(members, sets, similarity), "pairs")
        else:
            met = _leaders(members, turn, each).join(members, "bucket").filter("component != component_a")
            met = met.filter(F.least("size", "size_a") >= F.greatest("size", "size_a") * similarity - 1e-9)
            pairs = kept(met.select(F.col("node_a").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
        own = lambda at: label.select(F.col("node").alias(at), F.col("component").alias(f"of_{at}"))
        found = _similar(pairs, sets, similarity).join(own("a"), "a").join(own("b"), "b")
        edges = kept(found.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct(), "similar")
        if not edges.isEmpty():
            label = _united(label, edges)
            members = members if last else kept(_open(members.drop("component").join(label, "node")), "open-buckets")
        if last:
            break
        turn += 1
    return label


def _united(label: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after edges between components."""
    moved = components(edges).select(F.col("node").alias("component"), F.col("component").alias("united"))
    return kept(label.join(moved, "component", "left").select("node", F.coalesce("united", "component").alias("component")), "labels")


def one_per_group(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, id_col="doc_id", text_col="text") -> DataFrame:
    """Of each group of near copies the row of the smallest id (then the smallest text hash), all columns as they were.

    Texts that reach each other over pairs of the similarity are one group. Rows
    without words or with a null id all stay and take part in no link.
    """
    rows = kept(sketches(docs, words, id_col, text_col), "sketches").filter("size > 0 and id is not null")
    found = labels(rows, docs, words, similarity, text_col)
    grouped = rows.select("id", "body", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    grouped = kept(grouped.select("id", "body", "component"), "groups")
    first = grouped.groupBy("component").agg(F.min(F.struct("id", "body")).alias("first"))
    gone = grouped.join(first, "component").filter(F.struct("id", "body") != F.col("first"))
    gone = kept(gone.select("id", "body").distinct(), "near-copies")
    # No name of the documents may be that of a column here.
    names = [f"gone_{max(docs.columns, key=len)}_{c}" for c in ("id", "body")]
    gone = gone.toDF(*names)
    body = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(gone, (docs[id_col] == gone[names[0]]) & (body == gone[names[1]]), "left_anti")
