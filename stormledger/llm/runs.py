"""Periodic runs of words, and texts with each run cut to its first period.

A run is a stretch of words that repeats with a period q, is at least
``max(shortest, 2 q)`` words long and cannot be made longer; q is its smallest
period. A stretch repeats with lag d where its words equal those d places
earlier, so runs are long diagonals of the matrix that compares every word with
every earlier one. Only few places of that matrix are looked at:

* Lags under ``NEAR`` are followed word by word, all words of a batch at once: a
  match adds one to the length of its lag's diagonal, a mismatch ends it, and a
  diagonal that ends long enough emits its run.
* Longer lags are taken by octaves [2^k, 2^(k+1)). A diagonal that is long enough
  there has 2^k matches, so it covers one of the blocks of 2^(k-1) words that
  start at multiples of that number. The earlier occurrences of a block at a lag
  of the octave are the places where a diagonal is picked up; its length is then
  counted on, word for word, until a mismatch ends it and it is emitted or not.

Blocks are found by a hash, but every match that counts is a comparison of words.
Repetition does not make the work quadratic: what lies inside a run whose period
divides the lag is that run, so its diagonals are not followed again, and blocks
deep inside a run are not looked up. One word repeated n times costs about n.

Null counts as an empty text: no words, no runs, an empty collapsed text. Rows
are independent, so repeated rows, repeated or null ids, other columns of any
name and an empty table need no care.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from stormledger.llm.common import ship

#: Shortest run, in words.
SHORTEST = 12
#: Lags under this are followed word by word; a power of two, over half of SHORTEST.
NEAR = 16
#: Words that are worked on together; a longer text is taken alone.
TOGETHER = 150_000

RUN = StructType([StructField(name, LongType(), False) for name in ("start", "length", "period")])

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _doubled(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the 2 ``size`` words that end at each place, from those of ``size`` words; the first places have none."""
    out = np.zeros_like(h)
    out[size:] = _mixed(h[size:] + h[:-size] * np.uint64(0x9E3779B97F4A7C15))
    return out


def _near(words: np.ndarray, shortest: int) -> list[Runs]:
    found = []
    for lag in range(1, min(NEAR, len(words))):
        match = np.zeros(len(words) - lag + 2, np.int8)
        match[1:-1] = words[lag:] == words[:-lag]
        ends = np.flatnonzero(np.diff(match))
        start, stop = ends[::2], ends[1::2]
        long = stop - start >= max(lag, shortest - lag)
        found.append((start[long], stop[long] + lag, np.full(int(long.sum()), lag)))
    return found


def _matches(words: np.ndarray, here: int, lag: int, step: int) -> int:
    """Number of words from ``here`` on, in the direction of ``step``, that equal those ``lag`` earlier."""
    done, size = 0, 32
    while True:
        if step > 0:
            now = words[here + done : here + done + size]
        else:
            now = words[max(here - done - size + 1, lag) : here - done + 1]
        if not len(now):
            return done
        at = here + done if step > 0 else here - done - len(now) + 1
        differ = now != words[at - lag : at - lag + len(now)]
        first = int((differ if step > 0 else differ[::-1]).argmax())
        if (differ if step > 0 else differ[::-1])[first]:
            return done + first
        done, size = done + len(now), size * 4


def _inside(at: np.ndarray, lag: np.ndarray, known: Runs) -> np.ndarray:
    """Whether the stretch from ``at - lag`` to ``at`` lies in a known run whose period divides the lag; ``at`` ascends."""
    out = np.zeros(len(at), bool)
    for start, stop, period in zip(*known):
        part = slice(*np.searchsorted(at, (start, stop)))
        out[part] |= (at[part] - lag[part] >= start) & (lag[part] % period == 0)
    return out


def _octave(words: np.ndarray, h: np.ndarray, places: np.ndarray, size: int, known: Runs) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """Runs with periods of 2 ``size`` to 4 ``size`` - 1, and the places whose block occurs more than once.

    ``h`` has the hash of the ``size`` words that end at each place; ``places``
    are those that may repeat.
    """
    order = places[np.argsort(h[places], kind="stable")]
    new = np.ones(len(order), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    group = np.cumsum(new) - 1
    often = np.bincount(group)[group] > 1
    order, group = order[often], group[often]
    if not len(order):
        return [], order
    low, high = 2 * size, 4 * size
    # Blocks whose whole reach lies in a run of at most half a block have no other lags than its multiples.
    deep = np.zeros(len(words) + 1, np.int64)
    start, stop, period = known
    wide = (period <= size // 2) & (stop - start >= high + size)
    np.add.at(deep, start[wide] + high + size - 2, 1)
    np.add.at(deep, stop[wide], -1)
    deep = np.cumsum(deep)
    key = group * (len(words) + 1) + order
    block = ((order + 1) % size == 0) & (deep[order] == 0)
    at, base = order[block], key[block] - order[block]
    first = np.searchsorted(key, base + np.maximum(at - high + 1, 0))
    past = np.searchsorted(key, base + np.maximum(at - low + 1, 0))
    many = past - first
    here = np.repeat(at, many)
    there = order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)]
    by_place = np.argsort(here, kind="stable")
    here, lag = here[by_place], (here - there)[by_place]
    fresh = ~_inside(here, lag, tuple(x[stop - start >= low] for x in known))
    here, lag = here[fresh], lag[fresh]
    found, last, over = [], 0, 0
    for i, d in sorted(zip(here.tolist(), lag.tolist()), key=lambda x: (x[1], x[0])):
        if d == last and i < over:
            continue
        back = _matches(words, i, d, -1)
        if back:
            last, over = d, i + _matches(words, i, d, 1)
            if over - (i - back + 1) >= d:
                found.append((i - back + 1 - d, over, d))
    return found, np.sort(order)


def find_runs(words: np.ndarray, shortest: int = SHORTEST) -> Runs:
    """(start, stop, period) of all runs, by start, then period.

    ``words`` are numbers, equal where words are; several texts may follow each
    other if no two of them share a number.
    """
    if not 1 <= shortest <= NEAR:
        raise ValueError(f"shortest run must be 1 to {NEAR} words")
    parts = _near(words, shortest)
    h, size = _mixed(words.astype(np.uint64) + np.uint64(1)), 1
    while size < NEAR // 2:
        h, size = _doubled(h, size), 2 * size
    places = np.arange(size - 1, len(words))
    while len(places):
        known = tuple(map(np.concatenate, zip(*parts))) if parts else (places[:0],) * 3
        found, places = _octave(words, h, places, size, known)
        if found:
            parts.append(tuple(map(np.array, zip(*found))))
        # A block of twice the size can only occur again where both its halves do.
        may = np.zeros(len(words), bool)
        may[places] = True
        places = places[places >= 2 * size - 1]
        places = places[may[places - size]]
        h, size = _doubled(h, size), 2 * size
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    start, stop, period = map(np.concatenate, zip(*parts))
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    # The same stretch under a multiple of its period is the same run.
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[first], stop[first], period[first]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def _texts(texts: list[bytes | None], shortest: int) -> Iterator[tuple[int, list[dict], bytes]]:
    """Words, runs and collapsed text of each text."""
    numbers, lists = [], []
    for text in texts:
        words = (text or b"").split()
        # A word's number is the place where its text has it first: no two texts share one.
        offset = len(numbers)
        numbers.extend(map({}.setdefault, words, range(offset, offset + len(words))))
        lists.append(words)
    start, stop, period = find_runs(np.array(numbers, np.int64), shortest)
    cut = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(cut, start + period, 1)
    np.add.at(cut, stop, -1)
    keep = np.cumsum(cut) == 0
    length = stop - start
    offset = 0
    for words in lists:
        a, b = np.searchsorted(start, (offset, offset + len(words)))
        if a < b:
            runs = [dict(zip(RUN.names, x)) for x in zip((start[a:b] - offset).tolist(), length[a:b].tolist(), period[a:b].tolist())]
            left = [w for w, k in zip(words, keep[offset : offset + len(words)].tolist()) if k]
        else:
            runs, left = [], words
        yield len(words), runs, b" ".join(left)
        offset += len(words)


def _together(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """Parts of a batch with about ``TOGETHER`` words each; a word is two bytes at least, with its gap."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text or b"") > 6 * TOGETHER:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text or b"")
    if part:
        yield part


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """One row per document: id, n_words, runs and the collapsed text.

    ``runs`` is an array of (start, length, period) in words, by start, then
    period. In ``collapsed`` a word is left out if some run has it after that
    run's first period; the rest is joined by single spaces.
    """
    ship(docs.sparkSession)
    run = pa.list_(pa.struct([pa.field(name, pa.int64(), False) for name in RUN.names]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _together(batch.column(1).to_pylist()):
                n, runs, left = zip(*_texts(part, shortest))
                arrays = [batch.column(0).slice(at, len(part)), pa.array(n, pa.int64()), pa.array(runs, run), pa.array(left, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "runs", "collapsed"])
                at += len(part)

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("body"))
    schema = StructType([StructField("id", rows.schema["id"].dataType), StructField("n_words", LongType()), StructField("runs", ArrayType(RUN, False)), StructField("collapsed", BinaryType())])
    return rows.mapInArrow(of, schema).withColumn("collapsed", F.col("collapsed").cast("string"))
