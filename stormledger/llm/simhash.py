"""SimHash near-duplicate groups by bit-sliced comparison.

Fingerprints are made where the text is read and only they move. Equal ones
collapse first. Two fingerprints within ``radius`` bits agree in at least one of
``radius + 1`` blocks of bits, so only fingerprints that share a block meet, and
none is lost. Buckets are counted beforehand, and a large one is cut into slots
whose pairs are compared in cells of bounded size; all comparisons are the
bit-sliced ones of ``bitslice``. A cell answers with a forest of links instead
of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stormledger.llm.bitslice import linked
from stormledger.llm.common import deals, kept, ship
from stormledger.llm.graph import components

SEED = 42
#: Fingerprints of a slot; a cell compares at most two slots.
SLOT_ROWS = 4096
#: Rows that one group of cells brings into a task.
ROWS_PER_TASK = 16384
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str | None, words_per_shingle: int) -> np.ndarray:
    """Hashes of the word shingles of a text in order; none when it has no word.

    A to Z are folded, words are runs without ASCII white space. A text of fewer
    words than a shingle is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    if len(words) <= words_per_shingle:
        return np.array([hashed(line, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - words_per_shingle + 1].tolist()
    ends = ends[words_per_shingle - 1 :].tolist()
    return np.array([hashed(line[s:e], SEED) for s, e in zip(starts, ends)], np.uint64)


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles of a text; 0 when it has no word.

    Repeats count. A bit is set when over half of the shingle hashes have it.
    """
    return majority_bits(shingle_hashes(text, words_per_shingle))


def majority_bits(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have; 0 of none."""
    if len(hashes) < 2:
        return int(hashes[0]) if len(hashes) else 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 4, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, print) of every row; the print is the fingerprint's bits as a signed long."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words_per_shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "print"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {id_type}, print long")


def _bands(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of radius + 1 blocks that cover 64 bits."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def links(nodes: DataFrame, radius: int = 4, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Edges (a, b) that connect all nodes within the radius; ``nodes`` is (node, print), prints distinct."""
    ship(nodes.sparkSession)
    keys = F.array(
        *[
            F.struct(
                F.lit(k).cast("short").alias("band"),
                F.shiftrightunsigned("print", at).bitwiseAND(F.lit((1 << width) - 1)).alias("key"),
            )
            for k, (at, width) in enumerate(_bands(radius))
        ]
    )
    banded = nodes.select("node", "print", F.explode(keys).alias("b")).select("node", "print", "b.*")
    # Bounded whatever the input: a row per value of a block of bits, 40,960 for radius 4.
    counts = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    slots = F.ceil(F.col("n") / F.lit(slot_rows)).cast("int")
    slot = F.pmod(F.xxhash64("print"), slots).cast("int")
    members = banded.join(F.broadcast(counts), ["band", "key"]).select(
        "node", "print", "band", "key", slot.alias("slot"), F.explode(F.sequence(F.lit(0), slots - 1)).alias("other")
    )
    cell = F.xxhash64("band", "key", F.least("slot", "other"), F.greatest("slot", "other"))
    total = kept(members.select("node", "print", "slot", cell.alias("cell")), "cells")
    n = deals(total.count(), ROWS_PER_TASK)

    def run(table: pa.Table) -> pa.Table:
        column = lambda name, kind: table.column(name).to_numpy().astype(kind)
        prints = column("print", np.int64).view(np.uint64)
        row, root = linked(column("cell", np.int64), column("slot", np.int64), prints, radius)
        node = table.column("node")
        return pa.table({"a": node.take(pa.array(row)), "b": node.take(pa.array(root))})

    kind = nodes.schema["node"].dataType.simpleString()
    dealt = total.withColumn("deal", F.pmod(F.xxhash64("cell"), F.lit(n)))
    return dealt.groupBy("deal").applyInArrow(run, f"a {kind}, b {kind}")


def near_groups(docs: DataFrame, words_per_shingle: int = 4, radius: int = 4, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: (id, print, component), the component being the smallest id reachable.

    Texts without words have fingerprint 0 and are linked like any other. Rows
    that repeat an id are one node. A null id takes part in no link; its row
    gets the component of its fingerprint.
    """
    prints = kept(fingerprints(docs, words_per_shingle, id_col, text_col), "prints")
    # Copies collapse: one node per fingerprint, named by its smallest id.
    nodes = kept(prints.groupBy("print").agg(F.min("id").alias("node")), "nodes")
    found = components(links(nodes.filter("node is not null"), radius))
    # An id that repeats with other texts ties its fingerprints together.
    label = nodes.join(found, "node", "left").select("print", F.coalesce("component", "node").alias("component"))
    return prints.join(label, "print", "left").select("id", "print", "component")


def one_per_group(docs: DataFrame, words_per_shingle: int = 4, radius: int = 4, id_col="doc_id", text_col="text") -> DataFrame:
    """The documents that lead their group, all columns as they were; documents without words all stay."""
    groups = near_groups(docs, words_per_shingle, radius, id_col, text_col)
    gone = kept(groups.filter("id != component and print != 0").select(F.col("id").alias("gone")).distinct(), "near-copies")
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
