"""Best-fit packing of token sequences, certified by dual-feasible bounds.

Documents become pieces of at most the capacity. Pieces are dealt into groups of
bounded size and each group is packed best fit, longest first. Dual-feasible
functions turn the lengths into lower bounds on the number of bins; a group that
meets its bound is settled but for its emptiest bin, which others may fill.
Groups with a gap give up all bins with room to spare; these documents meet those
of other groups in fewer groups, and best fit runs again, until one group holds
all that is left, the given-up bins have not become fewer for two rounds, or the
rounds are used up; the last round settles all its bins.

Only (identifier, place, length, checksum) rows move, never texts or ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stormledger.llm.common import deals, kept, ship
from stormledger.llm.tokens import word_encoder

CAPACITY = 4096
END_ID = 1
#: Pieces that one group packs.
PIECES_PER_GROUP = 16384
#: Bins with more than this share of free places are given up by a group with a gap.
LOOSE = 1 / 64
#: Rounds at most, and rounds without fewer given-up bins after which packing stops; a sequence id has room for 127.
ROUNDS, IDLE = 64, 2
TOKENIZER = "word_bpe_49k.json"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, ticket): the token pieces of every document.

    Null counts as empty; the end id makes every document at least one long.
    ``ticket`` numbers the rows, so rows that repeat an id are dealt apart.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, own in enumerate(encoder.stream(t.as_py() for t in batch.column(1))):
                ids = np.append(own, np.uint16(END_ID)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    cut = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")
    return cut.withColumn("ticket", F.monotonically_increasing_id())


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    mass = count * np.arange(capacity + 1)
    best = -(-int(mass.sum()) // capacity)
    # Longer than capacity - k counts whole, shorter than k counts nothing.
    n_below, m_below = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(mass)]
    k = np.arange(1, capacity // 2 + 1)
    whole = n_below[-1] - n_below[capacity - k + 1]
    middle = m_below[capacity - k + 1] - m_below[k]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    # Lengths rounded to multiples of 1 / k, those that are such a multiple of 1 / (k + 1) kept.
    size = np.arange(capacity + 1)
    for k in range(1, 33):
        steps, rest = np.divmod(size * (k + 1), capacity)
        scaled = np.where(rest == 0, size * k, steps * capacity)
        best = max(best, -(-int((count * scaled).sum()) // (capacity * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each length and the free places of each bin; longest first."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_free, free = 0, []  # bit f of open_free: some bin has f places
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = open_free >> need
        if fitting:
            space = need + (fitting & -fitting).bit_length() - 1
            target = by_free[space].pop()
            if not by_free[space]:
                open_free &= ~(1 << space)
        else:
            target, space = len(free), capacity
            free.append(capacity)
        bins[i], offsets[i] = target, capacity - space
        left = space - need
        free[target] = left
        if left:
            by_free[left].append(target)
            open_free |= 1 << left
    return bins, offsets, np.array(free, np.int64)


def _packed_group(table: pa.Table, capacity: int, loose: float) -> pa.Table:
    """Pack one group; ``settled`` is false for the bins it gives up.

    A group with as many bins as its bound is certified: no packing of its pieces
    has fewer, so it gives up its emptiest bin at most, for others to fill.
    """
    table = table.sort_by([("length", "descending"), ("ticket", "ascending")])
    lengths = table.column("length").to_numpy()
    bins, offsets, free = best_fit(lengths, capacity)
    bound = lower_bound(lengths, capacity)
    given = (free > capacity * loose) & (len(free) > bound)
    if len(free) and free.max() > 0:
        given[int(free.argmax())] = True
    table = table.append_column("bin", pa.array(bins)).append_column("offset", pa.array(offsets))
    table = table.append_column("settled", pa.array(~given[bins]))
    for name, n in (("bins", len(free)), ("bound", bound)):
        table = table.append_column(name, pa.array(np.full(len(bins), n)))
    return table


def pack(cut: DataFrame, capacity: int = CAPACITY, per_group: int = PIECES_PER_GROUP, loose: float = LOOSE, rounds: int = ROUNDS) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; places in a sequence follow each other from 0.

    A sequence id is made of the round, the group and the bin there. Every piece
    is placed, however few the rounds. ``bins`` and ``bound`` are those of the
    group that settled the piece: where they are equal, its packing is certified.
    """
    if not 1 <= rounds <= 127:
        raise ValueError("a sequence id holds 1 to 127 rounds")
    ship(cut.sparkSession)
    todo = kept(cut, "pieces")
    columns, left, settled, fewest, idle = todo.columns, todo.count(), [], None, 0
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in todo.schema)
    schema = f"{types}, deal long, bin long, offset long, settled boolean, bins long, bound long"
    for turn in range(rounds):
        groups = deals(left, per_group)
        run = lambda table: _packed_group(table, capacity, loose)
        dealt = todo.withColumn("deal", F.pmod(F.xxhash64("ticket", F.lit(turn)), F.lit(groups)))
        done = kept(dealt.groupBy("deal").applyInArrow(run, schema), "packed")
        number = F.lit(turn << 56) + F.shiftleft("deal", 24) + F.col("bin")
        named = done.withColumn("sequence_id", number)
        loosened = done.filter("not settled")
        now = loosened.agg(F.count(F.lit(1)).alias("pieces"), F.countDistinct("deal", "bin").alias("bins")).first()
        # Each round deals anew, so the bins of a group that is not full vary although nothing is gained.
        idle = 0 if fewest is None or now.bins < fewest else idle + 1
        last = groups == 1 or not now.pieces or idle == IDLE or turn == rounds - 1
        settled.append((named if last else named.filter("settled")).select(*columns, "sequence_id", "offset", "bins", "bound"))
        if last:
            break
        fewest = now.bins if fewest is None else min(fewest, now.bins)
        left, todo = now.pieces, loosened.select(*columns)
    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    return result


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, id_col="doc_id", text_col="text") -> DataFrame:
    """Whole documents packed: (id, piece, start, length, ids_crc32, sequence_id, offset, bins, bound).

    An empty table gives no row; repeated rows are packed as often as they come.
    """
    packed = pack(pieces(docs, capacity, tokenizer, id_col, text_col), capacity)
    return packed.drop("ticket")
