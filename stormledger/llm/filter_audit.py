"""What each filter of a cleaning chain removes, in every order of the filters.

Of every document only the pattern of failed filters matters, so the documents of
a part are a contingency tensor: one axis of two (pass, fail) per filter, holding
counts of documents, of good ones and of toxic ones. A step of an order is a
contraction of that tensor with one selector per axis: pass for the filters
before it, fail (or pass) for its own, all for those after it. One ``einsum``
gives all steps of all orders of a batch of parts.

Texts are read once, for the patterns of the filters that look at one text, and a
digest. Whether a text is a later copy is decided by the digest's smallest id,
found with partial sums before the shuffle; rows then meet it by id and digest
together, so a text that a third of all rows share is still dealt by id.

A null text counts as empty, a null part as the empty string. A null id is no
smaller than any other and has no smaller one, so its row is no later copy; rows
that repeat an id and a text count each, and neither is a copy of the other.
Labels that repeat an id mark it if any of them does. Other columns are not read.
An empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from stormledger.llm.common import kept, ship

UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: Bytes that go on with a character in UTF-8.
INNER = bytes(range(0x80, 0xC0))
SYMBOLS = b"#$%&*|"


class Facts(NamedTuple):
    words: int
    distinct: int
    characters: int
    capitals: int
    symbols: int


#: Conditions of failure that one text decides; a further filter, REPEAT, removes later copies.
FILTERS: dict[str, Callable[[Facts], bool]] = {
    "A": lambda x: x.words < 50,
    "B": lambda x: 100 * x.distinct < 65 * x.words,
    "C": lambda x: 100 * x.capitals > 5 * x.characters,
    "D": lambda x: x.symbols > 0,
}
REPEAT = "E"

#: What is counted along the axes: documents, good documents, toxic documents.
COUNTED = ("n", "good", "toxic")
#: Parts whose tensors are contracted at once.
PARTS_TOGETHER = 32

RESULT = StructType(
    [StructField("part", StringType()), StructField("filter_order", StringType()), StructField("step", IntegerType())]
    + [StructField(name, LongType()) for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
)


def facts(text: bytes) -> Facts:
    """Of a text in UTF-8; words are parted by spaces and the characters 9 to 13."""
    words = text.split()
    left = lambda gone: len(text.translate(None, gone))
    return Facts(len(words), len(set(words)), left(INNER), len(text) - left(UPPER), len(text) - left(SYMBOLS))


def failures(docs: DataFrame, filters: Mapping[str, Callable[[Facts], bool]] = FILTERS, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """One row per document: id, part, pattern (bit k: the k-th filter fails) and the text's digest."""
    ship(docs.sparkSession)
    tests = list(filters.values())

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns, digests = [], []
            for text in batch.column(2).to_pylist():
                text = text or b""
                found = facts(text)
                patterns.append(sum(1 << k for k, fails in enumerate(tests) if fails(found)))
                digests.append(hashlib.sha256(text).digest())
            arrays = [batch.column(0), batch.column(1), pa.array(patterns, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "part", "pattern", "digest"])

    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"), F.col(text_column).cast("binary").alias("body")
    )
    schema = StructType([rows.schema["id"], rows.schema["part"], StructField("pattern", IntegerType()), StructField("digest", BinaryType())])
    return rows.mapInArrow(of, schema)


def pattern_counts(marked: DataFrame, labels: DataFrame, axis: int, label_id: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """Per part and pattern, later copies included as bit ``axis``: n, good, toxic."""
    first = marked.filter("id is not null").groupBy("digest").agg(F.min("id").alias("id")).select("id", "digest", F.lit(True).alias("is_first"))
    mark = lambda column: F.max(F.coalesce(F.col(column) == 1, F.lit(False)).cast("int"))
    known = labels.filter(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("id")).agg(mark(good).alias("good"), mark(toxic).alias("toxic"))
    copy = F.col("id").isNotNull() & F.col("is_first").isNull()
    rows = marked.join(known, "id", "left").join(first, ["id", "digest"], "left")
    return rows.groupBy("part", (F.col("pattern") + F.when(copy, 1 << axis).otherwise(0)).alias("pattern")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.coalesce(name, F.lit(0))).cast("long").alias(name) for name in COUNTED[1:]]
    )


def _selectors(axes: int) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray, np.ndarray]:
    """(orders, removed, kept, own): selectors [step of an order, axis, pass or fail], and the axis of each step."""
    passes, fails, both = (1, 0), (0, 1), (1, 1)
    orders = list(permutations(range(axes)))
    removed, left, own = [], [], []
    for order in orders:
        for step, axis in enumerate(order):
            before = set(order[:step])
            removed.append([passes if k in before else fails if k == axis else both for k in range(axes)])
            left.append([passes if k in before or k == axis else both for k in range(axes)])
            own.append(axis)
    return orders, np.array(removed), np.array(left), np.array(own)


def contracted(tensors: np.ndarray, selectors: np.ndarray) -> np.ndarray:
    """[part, counted, row] from tensors [part, counted, 2, 2, ...] and selectors [row, axis, 2]."""
    axes = tensors.ndim - 2
    operands: list = [tensors, [0, 1, *range(3, 3 + axes)]]
    for k in range(axes):
        operands += [selectors[:, k], [2, 3 + k]]
    return np.einsum(*operands, [0, 1, 2], optimize=["einsum_path", (0, 1), *[(0, axes - k) for k in range(1, axes)]])


def steps(tensors: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of the result, [part, row], rows being the steps of all orders in turn."""
    axes = tensors.ndim - 2
    orders, out, stay, own = _selectors(axes)
    gone = contracted(tensors, out)
    eye = np.arange(axes)
    only = np.array([[(0, 1) if k == axis else (1, 0) for k in eye] for axis in eye])
    fails = np.array([[(0, 1) if k == axis else (1, 1) for k in eye] for axis in eye])
    counts = tensors[:, :1]
    removed = gone[:, 0]
    shapley = np.stack([removed[:, own == axis].sum(axis=1) for axis in eye], axis=1)
    return {
        "kept": contracted(counts, stay)[:, 0],
        "removed": removed,
        "redundant": contracted(counts, fails)[:, 0][:, own] - removed,
        "unique_fails": contracted(counts, only)[:, 0][:, own],
        "good_lost": gone[:, 1],
        "toxic_lost": gone[:, 2],
        "shapley": shapley[:, own],
    }


def interaction_audit(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, order and step from the counts of patterns, one letter per bit."""
    ship(counts.sparkSession)
    axes = len(letters)
    names = ["".join(letters[k] for k in order) for order in permutations(range(axes))]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS_TOGETHER):
                rows = batch.slice(at, PARTS_TOGETHER).to_pylist()
                flat = np.zeros((len(rows), len(COUNTED), 1 << axes), np.int64)
                for i, row in enumerate(rows):
                    for cell in row["cells"]:
                        flat[i, :, cell["pattern"]] = [cell[name] for name in COUNTED]
                # Bit 0 is the fastest place of a number but the first axis.
                tensors = flat.reshape(len(rows), len(COUNTED), *[2] * axes).transpose(0, 1, *range(axes + 1, 1, -1))
                columns = steps(tensors)
                many = len(rows)
                head = [
                    pa.array(np.repeat(np.array([row["part"] for row in rows], object), axes * len(names)), pa.string()),
                    pa.array(np.repeat(np.array(names, object), axes).tolist() * many, pa.string()),
                    pa.array(np.tile(np.arange(1, axes + 1, dtype=np.int32), len(names) * many)),
                ]
                yield pa.RecordBatch.from_arrays(head + [pa.array(columns[name].reshape(-1)) for name in RESULT.names[3:]], RESULT.names)

    # At most one cell per pattern, so a part is a bounded row whatever its share of the documents.
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("pattern", *COUNTED)).alias("cells"))
    return cells.mapInArrow(of, RESULT)


def filter_audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Callable[[Facts], bool]] = FILTERS, repeat: str = REPEAT, **columns: str) -> DataFrame:
    """The audit of documents by part: every order of the filters and of the removal of later copies."""
    marked = kept(failures(docs, filters, **columns), "filter-patterns")
    letters = reduce(str.__add__, filters, "") + repeat
    return interaction_audit(pattern_counts(marked, labels, len(filters)), letters)
