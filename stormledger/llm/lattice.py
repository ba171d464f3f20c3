"""Marginal probability of texts over all ways to cut their words into pieces.

The pieces and their first weights are those of a vocabulary file; the file is
never trained. Weights are fitted to the corpus by expectation maximisation over
the distinct words of the training documents. A word is its leading space and
its bytes; every piece that matches somewhere is an edge of a lattice over the
places between bytes, and single bytes are pieces too, so every word has a path.
A forward recursion in log space sums over all paths. A first piece is chosen
among those that begin with the space, each later one, or the word's end, among
the rest, so the probabilities of all words add up to 1.

A word of the training documents has one edge more, from its first to its last
place: its own count, less a discount. What the discounts free is spread by the
pieces. No piece crosses a gap between words, so the sum over all segmentations
of a document is the product over its words, and a word is scored once however
often it occurs.

Spark counts all words, deals the distinct words for fitting and scoring, and
joins the scores back. Words that have at least ``1 / HEAD`` of all tokens, no
more than ``HEAD`` of them and ``WHOLE`` bytes each, are sent to every task, so
no word that is shuffled by is a large share of the rows. Longer words are keyed
by their digest.

A null text counts as empty: its one token is the end. A null id counts as the
empty text where the fold is taken. Rows are told apart by their place in the
input, so repeated rows and ids are scored each; other columns are not read. An
empty table gives no rows. Without training documents the vocabulary's own
weights score.
"""

from __future__ import annotations

import hashlib
import math
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from stormledger.llm.common import crc32_mod, kept, ship

#: The end of a document as a token: no word has a space.
END = b" "
#: Words sent to every task have at least 1 / HEAD of all tokens and at most WHOLE bytes.
HEAD, WHOLE = 1_000_000, 64
#: Words of documents, and bytes of distinct words, that are worked on together.
TOGETHER, BYTES = 150_000, 60_000
#: Rounds of expectation maximisation; pseudo-counts that the vocabulary's weights have; share of them for the end of a word.
ROUNDS, PRIOR, STOP = 2, 1000.0, 0.3
#: Longer words are fitted in stretches of so many bytes; they are scored whole.
STRETCH = 4096
#: Added to each count by the base score.
ADDED = 0.1


# The vocabulary and its lattice.


class Pieces:
    """Pieces of a vocabulary file as bytes, a leading space for the mark of a word's begin, and their trie."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        weights: dict[bytes, float] = {bytes([b]): 1 / (size + 2) for b in range(256)}
        for i in range(size):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in piece[1:]:
                # A score is the piece's rank, negated.
                weights[piece] = max(weights.get(piece, 0.0), 1 / (2 - model.get_score(i)))
        self.pieces = sorted(weights)
        self.longest = max(map(len, self.pieces))
        self.first = np.array([p[:1] == END for p in self.pieces])
        self.weights = np.array([weights[p] for p in self.pieces])
        nodes: dict[bytes, int] = {b"": 0}
        for piece in self.pieces:
            for n in range(1, len(piece) + 1):
                nodes.setdefault(piece[:n], len(nodes))
        edges = sorted((nodes[x[:-1]] * 256 + x[-1], node) for x, node in nodes.items() if x)
        self.keys, self.child = (np.array(x, np.int32) for x in zip(*edges))
        self.piece = np.full(len(nodes), -1, np.int32)
        self.piece[[nodes[p] for p in self.pieces]] = np.arange(len(self.pieces))

    def matches(self, flat: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, piece) of all pieces in ``flat``; a piece at a place has at most ``left`` bytes there."""
        at, node, found = np.arange(len(flat)), np.zeros(len(flat), np.int32), []
        for length in range(1, self.longest + 1):
            on = left[at] >= length
            at, node = at[on], node[on]
            key = node * np.int32(256) + flat[at + length - 1]
            where = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[where] == key
            at, node = at[on], self.child[where[on]]
            piece = self.piece[node]
            is_piece = piece >= 0
            found.append((at[is_piece], np.full(int(is_piece.sum()), length), piece[is_piece]))
            if not len(at):
                break
        return tuple(map(np.concatenate, zip(*found)))

    def prior(self) -> Weights:
        rest = ~self.first
        p = self.weights.copy()
        p[self.first] /= p[self.first].sum()
        p[rest] *= (1 - STOP) / p[rest].sum()
        return Weights(np.log(p), math.log(STOP))

    def fitted(self, expected: np.ndarray, words: float) -> Weights:
        """Weights from expected counts of the pieces and the number of words."""
        prior = self.prior()
        counts, stop = expected + PRIOR * np.exp(prior.pieces), words + PRIOR * STOP
        total = np.where(self.first, counts[self.first].sum(), counts[~self.first].sum() + stop)
        return Weights(np.log(counts / total), math.log(stop / (counts[~self.first].sum() + stop)))


@dataclass(frozen=True)
class Weights:
    """Natural logarithms of the probabilities of the pieces and of a word's end."""

    pieces: np.ndarray
    stop: float


@lru_cache(maxsize=4)
def vocabulary(name: str) -> Pieces:
    path = name
    if not os.path.exists(path):
        import public_tokenizers

        path = public_tokenizers.path(name)
    return Pieces(path)


def _sum(x: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials along the last axis; some entry of each row is finite."""
    top = x.max(axis=-1, keepdims=True)
    return top[..., 0] + np.log(np.exp(x - top).sum(axis=-1))


class Lattice:
    """The lattices of some byte strings, longest first; the places of each follow each other, from 0 to its length."""

    def __init__(self, pieces: Pieces, weights: Weights, strings: list[bytes]):
        self.wide = pieces.longest
        self.sizes = np.array([len(s) for s in strings])
        if (np.diff(self.sizes) > 0).any():
            raise ValueError("strings must come longest first")
        flat = np.frombuffer(b"".join(strings), np.uint8)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        at, length, self.used = pieces.matches(flat, np.repeat(self.sizes, self.sizes) - place)
        # A string has one place more than bytes; WIDE places before the first keep the indices valid.
        row = np.repeat(np.arange(len(strings)), self.sizes)
        self.row = row[at]
        self.start = at + self.row + self.wide
        self.end = self.start + length
        self.base = np.cumsum(self.sizes + 1) - self.sizes - 1 + self.wide
        self.places = len(flat) + len(strings) + 2 * self.wide
        self.length, self.weight = length, weights.pieces[self.used]

    def _recursion(self, here: np.ndarray, levels: Iterable[int], step: int, start: np.ndarray) -> np.ndarray:
        """Log sums over paths; edges lead to ``here`` from the places ``length`` back (step -1) or on (step 1)."""
        dense = np.full((self.places, self.wide), -np.inf)
        dense[here, self.length - 1] = self.weight
        total = np.full(self.places, -np.inf)
        total[start] = 0.0
        reach = step * np.arange(1, self.wide + 1)
        for level in levels:
            many = int(np.searchsorted(-self.sizes, -level, side="right"))
            at = self.base[:many] + (level if step < 0 else self.sizes[:many] - level)
            most = min(level, self.wide)
            total[at] = _sum(dense[at, :most] + total[at[:, None] + reach[:most]])
        return total

    def forward(self) -> np.ndarray:
        longest = int(self.sizes.max(initial=0))
        return self._recursion(self.end, range(1, longest + 1), -1, self.base)

    def backward(self) -> np.ndarray:
        longest = int(self.sizes.max(initial=0))
        return self._recursion(self.start, range(1, longest + 1), 1, self.base + self.sizes)

    def totals(self) -> np.ndarray:
        """Log probability of each string's pieces over all paths."""
        return self.forward()[self.base + self.sizes]

    def expected(self, pieces: int) -> np.ndarray:
        """How often each piece is used, by the paths' probabilities."""
        forward, backward = self.forward(), self.backward()
        whole = forward[self.base + self.sizes]
        share = np.exp(forward[self.start] + self.weight + backward[self.end] - whole[self.row])
        return np.bincount(self.used, share, pieces)


def long_total(pieces: Pieces, weights: Weights, string: bytes, block: int = BYTES) -> float:
    """As ``Lattice.totals`` for one string of any length, in blocks that hand on the last places."""
    wide, flat = pieces.longest, np.frombuffer(string, np.uint8)
    total = np.full(wide, -np.inf)  # of the places a - wide + 1 to a
    total[-1] = 0.0
    for a in range(0, len(flat), block):
        b, low = min(a + block, len(flat)), max(a - wide, 0)
        part = flat[low:b]
        at, length, used = pieces.matches(part, len(part) - np.arange(len(part)))
        end = at + low + length - a  # places after a
        on = end > 0
        dense = np.full((b - a + 1, wide), -np.inf)
        dense[end[on], length[on] - 1] = weights.pieces[used[on]]
        total = np.concatenate([total[-wide:], np.full(b - a, -np.inf)])
        for n in range(1, b - a + 1):
            total[wide - 1 + n] = _sum(dense[n] + total[n - 1 : n - 1 + wide][::-1])
    return float(total[-1])


def _parts(words: Iterable[bytes], limit: int = BYTES) -> Iterator[list[int]]:
    """Numbers of words that are worked on together: similar lengths, about ``limit`` bytes."""
    words = list(words)
    part, size = [], 0
    for i in sorted(range(len(words)), key=lambda i: -len(words[i])):
        if part and size + len(words[i]) > limit:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(words[i])
    if part:
        yield part


def spelled(pieces: Pieces, weights: Weights, words: list[bytes]) -> np.ndarray:
    """Log probability of each word by its pieces and its end."""
    out = np.empty(len(words))
    for part in _parts(words):
        if len(words[part[0]]) >= BYTES:
            out[part] = [long_total(pieces, weights, END + words[i]) for i in part]
        else:
            out[part] = Lattice(pieces, weights, [END + words[i] for i in part]).totals()
    return out + weights.stop


# Counting, fitting and scoring on Spark.


@dataclass(frozen=True)
class Model:
    """Totals of the training tokens, the discount of a word's count, and the pieces' weights."""

    vocabulary: str
    tokens: int
    distinct: int
    ends: int
    discount: float
    weights: Weights

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 probability of a token with that count, ADDED for each of the distinct tokens and one more."""
        return np.log10((count + ADDED) / (self.tokens + ADDED * (self.distinct + 1)))

    def token(self, count: np.ndarray, spelling: np.ndarray) -> np.ndarray:
        """log10 probability of words from their counts and log probabilities by pieces.

        Two tokens are added to the total: one for words that the corpus lacks, one for the end.
        """
        words = self.distinct - (self.ends > 0)
        whole = np.maximum(count - self.discount, 0.0)
        with np.errstate(divide="ignore"):
            return (np.logaddexp(np.log(whole), math.log(self.discount * words + 1) + spelling) - math.log(self.tokens + 2)) / math.log(10)

    def end(self) -> float:
        return math.log10((self.ends + 1) / (self.tokens + 2))


def _numbered(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """Parts of a batch: (texts in it, distinct words, word number of each token, text of each token)."""
    at = 0
    while at < len(texts):
        known: dict[bytes, int] = {}
        numbers: list[int] = []
        sizes: list[int] = []
        while at < len(texts) and (not sizes or len(numbers) < TOGETHER):
            words = (texts[at] or b"").lower().split()
            offset = len(numbers)
            numbers.extend(map(known.setdefault, words, range(offset, offset + len(words))))
            sizes.append(len(words))
            at += 1
        distinct = list(known)
        number = np.zeros(len(numbers), np.int64)
        number[list(known.values())] = np.arange(len(known))
        yield len(sizes), distinct, number[np.array(numbers, np.int64)], np.repeat(np.arange(len(sizes)), sizes)


def word_counts(docs: DataFrame, training: Column, text_column: str = "text") -> DataFrame:
    """One row per distinct word in lower case, and one for END: trained (tokens in training documents), n (all tokens)."""
    ship(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train, at = np.array(batch.column(0).to_pylist(), bool), 0
            for many, words, number, text in _numbered(batch.column(1).to_pylist()):
                own = train[at : at + many]
                trained = np.bincount(number[own[text]], minlength=len(words))
                every = np.bincount(number, minlength=len(words))
                arrays = [pa.array([*words, END], pa.binary()), pa.array(np.append(trained, own.sum())), pa.array(np.append(every, many))]
                yield pa.RecordBatch.from_arrays(arrays, ["word", "trained", "n"])
                at += many

    rows = docs.select(training.alias("train"), F.col(text_column).cast("binary").alias("body"))
    return rows.mapInArrow(of, "word binary, trained long, n long").groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("n").alias("n"))


def fit(words: DataFrame, name: str = "piece_bpe_32k.model", rounds: int = ROUNDS) -> Model:
    """The model from ``word_counts``. The driver gets totals and a number per piece of the vocabulary."""
    pieces = vocabulary(name)
    is_word = F.col("word") != F.lit(END)
    seen = lambda *at: F.count(F.when(is_word & F.col("trained").isin(*at), 1))
    total = words.agg(
        F.coalesce(F.sum("trained"), F.lit(0)).alias("tokens"),
        F.count(F.when(F.col("trained") > 0, 1)).alias("distinct"),
        F.coalesce(F.sum(F.when(~is_word, F.col("trained"))), F.lit(0)).alias("ends"),
        seen(1).alias("once"),
        seen(2).alias("twice"),
    ).first()
    # The usual estimate of an absolute discount from counts of counts.
    discount = total.once / (total.once + 2 * total.twice) if total.once and total.twice else 0.5
    model = Model(name, total.tokens, total.distinct, total.ends, discount, pieces.prior())
    types = total.distinct - (total.ends > 0)
    for _ in range(rounds if types else 0):
        weights = model.weights

        def of(batches: Iterator[pa.RecordBatch], weights: Weights = weights) -> Iterator[pa.RecordBatch]:
            pieces = vocabulary(name)
            expected = np.zeros(len(pieces.pieces))
            for batch in batches:
                strings = [(END + w)[at : at + STRETCH] for w in batch.column(0).to_pylist() for at in range(0, len(w) + 1, STRETCH)]
                for part in _parts(strings):
                    expected += Lattice(pieces, weights, [strings[i] for i in part]).expected(len(expected))
            used = np.flatnonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(expected[used])], ["piece", "expected"])

        rows = words.filter(is_word & (F.col("trained") > 0)).select("word").mapInArrow(of, "piece int, expected double")
        expected = np.zeros(len(pieces.pieces))
        for row in rows.groupBy("piece").agg(F.sum("expected").alias("expected")).collect():
            expected[row.piece] = row.expected
        model = replace(model, weights=pieces.fitted(expected, types))
    return model


def word_scores(words: DataFrame, model: Model) -> DataFrame:
    """``word_counts`` with base and score, the log10 probabilities of each word by the two models, and its key."""
    ship(words.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spelling = batch.column(0).to_pylist()
            count = batch.column(1).to_numpy()
            score = model.token(count, spelled(vocabulary(model.vocabulary), model.weights, spelling))
            arrays = [pa.array(map(key_of, spelling), pa.binary()), batch.column(1), batch.column(2), pa.array(model.base(count)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "trained", "n", "base", "score"])

    rows = words.filter(F.col("word") != F.lit(END)).select("word", "trained", "n")
    return rows.mapInArrow(of, "key binary, trained long, n long, base double, score double")


def key_of(word: bytes) -> bytes:
    """The word, or where it is longer than WHOLE a space and its digest."""
    return word if len(word) <= WHOLE else END + hashlib.sha256(word).digest()


def _head(scores: DataFrame) -> list:
    """Keys and numbers of the words that have 1 / HEAD of the tokens; at most HEAD rows of WHOLE bytes and three numbers."""
    total = scores.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    table = scores.filter((F.col("n") * HEAD >= total) & (F.length("key") <= WHOLE)).select("key", "trained", "base", "score").toArrow()
    trained = table.column("trained").to_numpy() > 0
    return [table.column("key").to_pylist(), np.stack([table.column("base").to_numpy(), table.column("score").to_numpy(), trained.astype(float)])]


def document_scores(docs: DataFrame, scores: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, n_known, base, score."""
    ship(docs.sparkSession)
    head = docs.sparkSession.sparkContext.broadcast(_head(scores))
    end = (float(model.base(np.array(model.ends))), model.end(), int(model.ends > 0))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers = head.value
        known = dict(zip(keys, range(len(keys))))
        # The place of a row in the input: tasks are numbered alike in every attempt.
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = 0
            for many, words, number, text in _numbered(batch.column(1).to_pylist()):
                found = np.array(list(map(known.get, words, repeat(-1))), np.int64)[number]
                here = found >= 0
                base, score, seen = (np.bincount(text[here], x[found[here]], many) for x in numbers)
                n = np.bincount(text, minlength=many) + 1
                pair, times = np.unique(text[~here] * (len(words) or 1) + number[~here], return_counts=True)
                own, word = np.divmod(pair, len(words) or 1)
                tail = pa.array(list(map(key_of, words)), pa.binary()).take(pa.array(word))
                # A document's own row meets no word: its key is one that no word has.
                alone = pa.array([END + (row + i).to_bytes(8, "big") for i in range(many)], pa.binary())
                first, rest = np.arange(row, row + many), len(pair)
                columns = {
                    "row": pa.array(np.concatenate([first, row + own])),
                    "key": pa.concat_arrays([alone, tail]),
                    "times": pa.array(np.concatenate([np.ones(many, np.int64), times])),
                    "id": pa.concat_arrays([batch.column(0).slice(at, many), pa.nulls(rest, batch.column(0).type)]),
                    "n_tokens": pa.concat_arrays([pa.array(n), pa.nulls(rest, pa.int64())]),
                    "n_known": pa.concat_arrays([pa.array(seen.astype(np.int64) + end[2]), pa.nulls(rest, pa.int64())]),
                    "own_base": pa.concat_arrays([pa.array(base + end[0]), pa.nulls(rest, pa.float64())]),
                    "own_score": pa.concat_arrays([pa.array(score + end[1]), pa.nulls(rest, pa.float64())]),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
                row, at = row + many, at + many

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("body"))
    schema = StructType(
        [StructField("row", LongType()), StructField("key", scores.schema["key"].dataType), StructField("times", LongType()), rows.schema["id"]]
        + [StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("own_base", DoubleType()), StructField("own_score", DoubleType())]
    )
    joined = rows.mapInArrow(of, schema).join(scores.select("key", "trained", "base", "score"), "key", "left")
    value = lambda own, word: F.coalesce(own, F.col("times") * word)
    return joined.groupBy("row").agg(
        F.max("id").alias("id"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(value(F.col("n_known"), (F.col("trained") > 0).cast("long"))).alias("n_known"),
        F.sum(value(F.col("own_base"), F.col("base"))).alias("base"),
        F.sum(value(F.col("own_score"), F.col("score"))).alias("score"),
    ).drop("row")


def held_out(id_column: str = "doc_id", folds: int = 10) -> Column:
    return crc32_mod(id_column, folds) == 0


def lattice_scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", name: str = "piece_bpe_32k.model") -> tuple[DataFrame, Model]:
    """Scores of all documents by a model of those that are not held out, and the model."""
    words = kept(word_counts(docs, ~held_out(id_column), text_column), "words")
    model = fit(words, name)
    scores = kept(word_scores(words, model), "word-scores")
    return document_scores(docs, scores, model, id_column, text_column), model
