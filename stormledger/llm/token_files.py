"""Token files: Huffman-coded ids in independent blocks, in ascending order of documents.

Two passes over the ids. The first encodes texts to ids, keeps them, and counts
every id. From the global counts comes one canonical length-limited Huffman
code; only its lengths are stored. The second pass codes each document where its
ids lie, so what is shuffled into order is already compressed.

A table row is one block:

    magic "SLTK", version, documents, segments, ids, first id's place, bytes of payload, crc32 of payload
    documents: identifier (64 bits), null flag (8 bits), number of ids (32 bits)
    segments:  start bit in the payload (64 bits), number of ids (16 bits)
    payload

A segment never crosses a document, holds SEGMENT ids at most and can be decoded
alone from its bit offset. Blocks hold whole documents.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stormledger.llm import huffman
from stormledger.llm.common import kept, scratch, ship
from stormledger.llm.tokens import byte_encoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Ids after which a block ends, at the next end of a document.
BLOCK_IDS = 65_536
SEGMENT = 256
#: Ids of a file, a task's share of the writing.
FILE_IDS = 8_000_000
HEADER = struct.Struct("<4sHIIQQQI")
MAGIC, VERSION = b"SLTK", 1
#: Blocks decoded together.
TOGETHER = 64


def token_ids(docs: DataFrame, tokenizer: str = TOKENIZER, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, ticket, n, low, high): ids of each document with the end id, as two byte planes.

    Planes compress better than pairs of bytes. Identifiers are read as 64-bit
    integers; ``ticket`` orders rows that repeat one.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer)
        for batch in batches:
            n, low, high = [], [], []
            for own in encoder.stream(t.as_py() for t in batch.column(1)):
                ids = np.append(own, np.uint16(END_ID)).astype("<u2")
                planes = ids.view(np.uint8).reshape(-1, 2)
                n.append(len(ids))
                low.append(planes[:, 0].tobytes())
                high.append(planes[:, 1].tobytes())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(low, pa.binary()), pa.array(high, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "low", "high"])

    rows = docs.select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(run, "id long, n long, low binary, high binary").withColumn("ticket", F.monotonically_increasing_id())


def _joined(low: bytes, high: bytes) -> np.ndarray:
    return np.stack([np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)], axis=1).reshape(-1).view("<u2")


def id_counts(ids: DataFrame) -> np.ndarray:
    """How often each id occurs in the whole corpus; 65,536 numbers whatever its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            low, high = (b"".join(batch.column(k).to_pylist()) for k in (0, 1))
            total += np.bincount(_joined(low, high), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["token", "n"])

    counted = ids.select("low", "high").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << 16, np.int64)
    for token, n in counted.collect():
        counts[token] = n
    return counts


def file_bounds(ids: DataFrame, file_ids: int = FILE_IDS) -> list[tuple[tuple, int]]:
    """((named, id, ticket), place) of the first row of each file, in order; one entry per file.

    Places are running sums in order of (id, ticket), null ids first: sums inside
    sorted ranges of bounded size, plus the totals of the ranges before.
    """
    keys = ["named", "id", "ticket"]
    small = ids.select(F.col("id").isNotNull().alias("named"), F.coalesce("id", F.lit(0)).alias("id"), "ticket", "n")
    small = kept(small.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "id-order")
    before, rows = 0, []
    for part, n in sorted(small.groupBy("part").agg(F.sum("n")).collect()):  # one row per range
        rows.append((part, before))
        before += n
    if not rows:
        return []
    ranges = ids.sparkSession.createDataFrame(rows, "part int, before long")
    inside = Window.partitionBy("part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = small.withColumn("local", F.sum("n").over(inside) - F.col("n")).join(F.broadcast(ranges), "part")
    placed = placed.withColumn("start", F.col("before") + F.col("local"))
    firsts = placed.groupBy(F.floor(F.col("start") / file_ids).alias("file")).agg(F.min(F.struct(*keys, "start")).alias("first"))
    return sorted(((f.named, f.id, f.ticket), f.start) for _, f in firsts.collect())


def coded(ids: DataFrame, lengths: np.ndarray, bounds: list[tuple[tuple, int]]) -> DataFrame:
    """(file, named, id, ticket, n, payload, starts): each document's own bits, made where its ids lie."""
    keys = [key for key, _ in bounds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = huffman.canonical_codes(lengths)
        for batch in batches:
            files, payloads, starts = [], [], []
            for named, id_, ticket, low, high in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4, 5))):
                own = _joined(low, high)
                payload, ends = huffman.pack_bits(own, codes, lengths)
                files.append(bisect.bisect_right(keys, (named, id_, ticket)) - 1)
                payloads.append(payload)
                # Where segments start, and behind them where the document ends.
                starts.append(np.r_[0, ends][: len(own) : SEGMENT].astype("<u8").tobytes() + int(ends[-1]).to_bytes(8, "little"))
            columns = [pa.array(files, pa.int32()), *batch.columns[:4], pa.array(payloads, pa.binary()), pa.array(starts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["file", "named", "id", "ticket", "n", "payload", "starts"])

    rows = ids.select(F.col("id").isNotNull().alias("named"), F.coalesce("id", F.lit(0)).alias("id"), "ticket", "n", "low", "high")
    return rows.mapInArrow(run, "file int, named boolean, id long, ticket long, n long, payload binary, starts binary")


def _block(first: int, named: list[bool], ids: list[int], ns: list[int], payloads: list[bytes], starts: list[bytes]) -> bytes:
    bits, seg_starts, seg_counts, base = [], [], [], 0
    for n, payload, raw in zip(ns, payloads, starts):
        at = np.frombuffer(raw, "<u8").astype(np.int64)
        bits.append(np.unpackbits(np.frombuffer(payload, np.uint8), count=int(at[-1])))
        seg_starts.append(at[:-1] + base)
        seg_counts.append(np.minimum(SEGMENT, n - SEGMENT * np.arange(len(at) - 1)))
        base += int(at[-1])
    payload = np.packbits(np.concatenate(bits)).tobytes()
    seg_start, seg_count = np.concatenate(seg_starts), np.concatenate(seg_counts)
    head = HEADER.pack(MAGIC, VERSION, len(ids), len(seg_start), sum(ns), first, len(payload), zlib.crc32(payload))
    documents = [np.array(ids, "<i8"), np.array([not x for x in named], "u1"), np.array(ns, "<u4")]
    return head + b"".join(a.tobytes() for a in [*documents, seg_start.astype("<u8"), seg_count.astype("<u2")]) + payload


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, file_ids: int = FILE_IDS, block_ids: int = BLOCK_IDS, id_col="doc_id", text_col="text") -> None:
    """Encode all documents and write ``path``/code and ``path``/blocks, files and blocks in ascending order of ids."""
    spark = docs.sparkSession
    ids = kept(token_ids(docs, tokenizer, id_col, text_col), "token-ids")
    lengths = huffman.code_lengths(id_counts(ids))
    bounds = file_bounds(ids, file_ids)
    places = [place for _, place in bounds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"file": None, "block": 0, "first": 0}
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            data = _block(state["first"], *map(list, zip(*held)))
            batch = pa.RecordBatch.from_pydict(
                {"file": pa.array([state["file"]], pa.int32()), "block": pa.array([state["block"]], pa.int32()), "data": pa.array([data], pa.binary())}
            )
            state["first"] += sum(x[2] for x in held)
            state["block"] += 1
            held.clear()
            return batch

        size = 0
        for batch in batches:
            for file, named, id_, n, payload, starts in zip(*(c.to_pylist() for c in batch.columns)):
                if file != state["file"]:
                    if held:
                        yield out()
                    state.update(file=file, block=0, first=places[file])
                    size = 0
                held.append((named, id_, n, payload, starts))
                size += n
                if size >= block_ids:
                    yield out()
                    size = 0
        if held:
            yield out()

    rows = coded(ids, lengths, bounds)
    # Partition k is file k: the order of the part files is that of the documents.
    placed = rows.repartitionById(max(1, len(bounds)), "file").sortWithinPartitions("file", "named", "id", "ticket")
    placed = placed.select("file", "named", "id", "n", "payload", "starts")
    blocks = placed.mapInArrow(run, "file int, block int, data binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    spark.createDataFrame([(lengths.tobytes(),)], "lengths binary").write.parquet(f"{path}/code")


def decode_blocks(blocks: list[bytes], table: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: (ids or None, places, numbers of ids, all ids); segments of all blocks are decoded together."""
    payloads, starts, counts, heads, base = [], [], [], [], 0
    for data in blocks:
        magic, version, n_docs, n_segments, n_ids, first, size, crc = HEADER.unpack_from(data)
        at = HEADER.size
        ids = np.frombuffer(data, "<i8", n_docs, at)
        nulls = np.frombuffer(data, "u1", n_docs, at + 8 * n_docs)
        ns = np.frombuffer(data, "<u4", n_docs, at + 9 * n_docs).astype(np.int64)
        at += 13 * n_docs
        start = np.frombuffer(data, "<u8", n_segments, at).astype(np.int64)
        count = np.frombuffer(data, "<u2", n_segments, at + 8 * n_segments).astype(np.int64)
        payload = data[at + 10 * n_segments :]
        if (magic, version) != (MAGIC, VERSION) or len(payload) != size or zlib.crc32(payload) != crc:
            raise ValueError("not a block of a token file, or a damaged one")
        payloads.append(payload)
        starts.append(start + 8 * base)
        counts.append(count)
        heads.append(([None if z else int(i) for i, z in zip(ids, nulls)], first, ns))
        base += size
    all_ids = huffman.unpack_segments(b"".join(payloads), np.concatenate(starts), np.concatenate(counts), table)
    at = 0
    for ids, first, ns in heads:
        own = all_ids[at : at + int(ns.sum())]
        at += len(own)
        yield ids, first + np.cumsum(ns) - ns, ns, own


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of every document, from the files alone."""
    ship(spark)
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/code").first()["lengths"]), np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decoding_table(lengths)
        for batch in batches:
            for low in range(0, batch.num_rows, TOGETHER):
                blocks = [x.as_py() for x in batch.column(0).slice(low, TOGETHER)]
                for ids, starts, ns, own in decode_blocks(blocks, table):
                    wide, ends = own.astype("<u4"), np.cumsum(ns).tolist()
                    parts = [wide[a:b].tobytes() for a, b in zip([0, *ends], ends)]
                    columns = [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(ns, pa.int64()), pa.array(map(zlib.crc32, parts), pa.int64())]
                    names = ["id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([np.frombuffer(x, "<u4") for x in parts], pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    more = ", ids array<int>" if with_ids else ""
    stored = spark.read.schema("file int, block int, data binary").parquet(f"{path}/blocks")
    return stored.select("data").mapInArrow(run, f"id long, start long, n_tokens long, ids_crc32 long{more}")


def through_files(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Write the documents as token files in shared storage and read them back.

    Null counts as empty; every document has at least its end id. Rows that
    repeat an id each have their own place. An empty table gives no row.
    """
    spark = docs.sparkSession
    path = scratch(spark, "token-files")
    write_token_files(docs, path, tokenizer)
    return read_token_files(spark, path)
