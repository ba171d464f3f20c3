"""Toxicity by class-conditional Kneser-Ney models.

Two models of spelling, one of toxic and one of ordinary documents, give every
word a log-likelihood ratio. What a document's ratios exceed two margins by,
summed and divided by its length, is its evidence: margins keep the many small
ratios of ordinary words, which differ by language, from outweighing a few
plain ones. The highest order counts per class with an absolute discount; what
is discounted is spread over shorter contexts by continuation counts that both
classes share, so an expression that is rare in either is judged by how widely
its pieces occur in both.

All labelled rows of folds 1 to 3 are counted, over whole texts; fold 4 only calibrates: first words, where the
text lies, then the n-grams of distinct words. Counts are exact:
tables have a row per n-gram or context, found by its full 64-bit hash, and grow
with the n-grams that the labelled words have. A held-in part of the labelled rows
turns the evidence into a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stormledger.llm.common import crc32_mod, kept, ship

ORDER = 5
DISCOUNT = 0.75
ALPHABET = 256
WORD = re.compile(r"[^\W\d_]+")
#: Documents whose words are looked up together, and words a worker remembers.
TOGETHER, REMEMBERED = 256, 300_000
#: Labelled rows that calibrate the score, chosen by a hash of their id.
CALIBRATION_ROWS = 20_000
#: Ratios count as far as they are over these; with what is added before a logarithm.
MARGINS, LIFT = (1.0, 3.0), (0.01, 0.003)
TABLES = ("top_toxic", "top_plain", "sum_toxic", "sum_plain", "spare_toxic", "spare_plain", "cont", "cont_sum", "cont_kinds")
MARK = "\x02"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def word_grams(words: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grams, depth, word): hashes [k - 1, place] of the k characters that end at a place.

    A word stands between marks, which count as characters; depth is the number
    of characters up to a place, ``order`` at most, and word its number.
    Places of the first mark of a word have depth 1.
    """
    spelled = "".join(f"{MARK}{w}{MARK}" for w in words)
    chars = np.frombuffer(spelled.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), sizes)
    inside = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    depth = np.minimum(inside + 1, order)
    grams = np.zeros((order, len(chars)), np.uint64)
    grams[0] = _mix(chars + np.uint64(1))
    for k in range(1, order):
        grams[k, k:] = _mix(grams[k - 1, k:] * np.uint64(31) + chars[:-k] + np.uint64(k << 32))
    return grams, depth, word


def distinct_grams(words: DataFrame) -> DataFrame:
    """(gram, top, context, suffix, suffix_context, toxic, plain) of every distinct n-gram of two characters or more.

    ``words`` is (word, toxic, plain). A gram is a top one where nothing longer
    ends at its place: it has ``ORDER`` characters or begins with the first mark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, depth, word = word_grams(batch.column(0).to_pylist())
            counts = [batch.column(c).to_numpy()[word] for c in (1, 2)]
            for k in range(2, ORDER + 1):
                own = np.flatnonzero(depth >= k)
                gram = grams[k - 1, own]
                _, first, group = np.unique(gram, return_index=True, return_inverse=True)
                own, sums = own[first], [np.bincount(group, c[own], len(first)).astype(np.int64) for c in counts]
                behind = grams[k - 3, own - 1] if k > 2 else np.zeros(len(own), np.uint64)
                hashes = [grams[k - 2, own - 1], grams[k - 2, own], behind]
                signed = [pa.array(x.view(np.int64)) for x in (grams[k - 1, own], *hashes)]
                columns = [signed[0], pa.array(depth[own] == k), *signed[1:], *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "top", "context", "suffix", "suffix_context", "toxic", "plain"])

    found = words.mapInArrow(run, "gram long, top boolean, context long, suffix long, suffix_context long, toxic long, plain long")
    same = [F.first(c).alias(c) for c in ("top", "context", "suffix", "suffix_context")]
    return found.groupBy("gram").agg(*same, F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, toxic, plain) over all labelled rows (text, toxic), counted where the text lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                seen[toxic == 1].update(WORD.findall((text.as_py() or "").lower()))
            if len(seen[0]) + len(seen[1]) > REMEMBERED:
                yield out(seen)
                seen = (Counter(), Counter())
        yield out(seen)

    def out(seen: tuple[Counter, Counter]) -> pa.RecordBatch:
        words = list(seen[0].keys() | seen[1].keys())
        columns = [pa.array(words, pa.string())] + [pa.array([seen[c][w] for w in words], pa.int64()) for c in (1, 0)]
        return pa.RecordBatch.from_arrays(columns, ["word", "toxic", "plain"])

    counted = labelled.mapInArrow(run, "word string, toxic long, plain long")
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))


def tables(grams: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(keys, [table, row]): the counts of all n-grams and contexts, by hash in ascending order.

    The larger class counts as if thinned to the size of the smaller one, or its
    richer counts alone would tell the classes apart. ``spare`` is what the
    discount takes from the grams of a context.

    Summed in Spark; what comes to the driver is a row per distinct n-gram of up
    to ``ORDER`` characters, never one per word or document.
    """
    size = grams.filter("top").agg(*[F.sum(c).cast("double").alias(c) for c in ("toxic", "plain")]).first()
    least = min(size.toxic or 0, size.plain or 0)
    count = {c: F.col(c) * F.lit(least / size[c] if least else 1.0) for c in ("toxic", "plain")}
    spare = lambda c: F.least(count[c], F.lit(DISCOUNT))

    def entries(df: DataFrame, at: str, **values: Column) -> DataFrame:
        own = [F.sum(values.get(t, F.lit(0.0))).cast("double").alias(t) for t in TABLES]
        return df.groupBy(F.col(at).alias("key")).agg(*own)

    top = grams.filter("top")
    follows = grams.groupBy("suffix").agg(F.count(F.lit(1)).alias("n"), F.first("suffix_context").alias("context"))
    rows = [
        entries(top, "gram", top_toxic=count["toxic"], top_plain=count["plain"]),
        entries(top, "context", sum_toxic=count["toxic"], sum_plain=count["plain"], spare_toxic=spare("toxic"), spare_plain=spare("plain")),
        # Each distinct gram is one continuation of what is left without its first character.
        entries(follows, "suffix", cont=F.col("n")),
        entries(follows, "context", cont_sum=F.col("n"), cont_kinds=F.lit(1)),
    ]
    summed = rows[0].union(rows[1]).union(rows[2]).union(rows[3]).groupBy("key").agg(*[F.sum(t).cast("float").alias(t) for t in TABLES])
    table = summed.toArrow()
    keys = table.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([table.column(t).to_numpy()[order] for t in TABLES], np.float32).reshape(len(TABLES), -1)


def _design(evidence: np.ndarray) -> np.ndarray:
    """Logarithms of the evidence, and a column of ones."""
    logs = np.log(evidence + np.array(LIFT))
    return np.column_stack([logs, np.ones(len(logs))])


class Model:
    """Tables of both classes with their keys, and the weights of the evidence.

    Weights that nothing calibrated ask for about a tenth of a unit per word.
    """

    def __init__(self, tables: tuple[np.ndarray, np.ndarray], weights: np.ndarray | None = None):
        self.keys, counts = tables
        # One row more, of zeros, stands for all n-grams that were not counted.
        self.tables = dict(zip(TABLES, np.pad(counts, ((0, 0), (0, 1)))))
        self.weights = np.array([1.0, 0.0, 2.0]) if weights is None else weights

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(evidence) @ self.weights, -30, 30)))

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash in the tables."""
        at = np.searchsorted(self.keys, hashes)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == hashes[known]
        return np.where(known, at, len(self.keys))

    def ratios(self, words: list[str]) -> np.ndarray:
        """Log-likelihood ratio of each word, toxic over ordinary."""
        grams, depth, word = word_grams(words)
        at = np.flatnonzero(depth > 1)
        t = self.tables
        shared = np.full(len(at), 1.0 / ALPHABET)
        result = np.zeros(len(at))
        for k in range(1, ORDER + 1):
            gram = self.rows(grams[k - 1, at])
            context = self.rows(grams[k - 2, at - 1] if k > 1 else np.zeros(len(at), np.uint64))
            last = depth[at] == k
            if last.any():
                own = np.flatnonzero(last)
                logs = []
                for c in ("toxic", "plain"):
                    total = t[f"sum_{c}"][context[own]].astype(float)
                    safe = np.where(total > 0, total, 1)
                    p = np.maximum(t[f"top_{c}"][gram[own]] - DISCOUNT, 0) / safe
                    p += t[f"spare_{c}"][context[own]] / safe * shared[own]
                    logs.append(np.log(np.where(total > 0, np.clip(p, 1e-12, 1), shared[own])))
                result[own] = logs[0] - logs[1]
            total = t["cont_sum"][context].astype(float)
            safe = np.maximum(total, 1)
            p = np.maximum(t["cont"][gram] - DISCOUNT, 0) / safe + DISCOUNT * t["cont_kinds"][context] / safe * shared
            shared = np.where((total > 0) & ~last, np.clip(p, 1e-12, 1), shared)
        return np.bincount(word[at], result, len(words))


class Scorer(dict):
    """Ratios of documents; remembers those of the words it has met."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def documents(self, texts: list[str | None]) -> np.ndarray:
        """[text, margin]: length-normalised ratios over each margin; 0 without words."""
        words = [WORD.findall((t or "").lower()) for t in texts]
        if len(self) > REMEMBERED:
            self.clear()
        new = list(set().union(*words).difference(self))
        if new:
            self.update(zip(new, self.model.ratios(new).tolist()))
        out = np.zeros((len(texts), len(MARGINS)))
        for k, own in enumerate(words):
            if own:
                ratios = np.fromiter(map(self.__getitem__, own), float, len(own))
                out[k] = [np.maximum(ratios - margin, 0).mean() for margin in MARGINS]
        return out


def _evidence(rows: DataFrame, model: Model, schema: str, finish) -> DataFrame:
    """The other columns and what ``finish`` makes of the evidence; the text is the last column."""
    shared, others = rows.sparkSession.sparkContext.broadcast(model), len(rows.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(low, TOGETHER)
                made = finish(shared.value, scorer.documents(part.column(others).to_pylist()))
                names = [*part.schema.names[:-1], *made]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, made.values())], names)

    types = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in rows.columns[:-1])
    return rows.mapInArrow(run, types + schema)


def _logistic(design: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve by Newton's steps, lightly held to 0."""
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(len(beta))
        step = np.linalg.solve(hessian, design.T @ (y - p) - 1e-2 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, fold, text, toxic) of the rows a fit may learn from: fold 1 to 4 of 5, label 0 or 1."""
    fold = crc32_mod("id", 5).cast("int")
    known = labels.filter(F.col("toxic").isin(0, 1)).select(F.col(id_col).alias("lid"), F.col("toxic").cast("int").alias("toxic")).distinct()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("fold", fold).filter("fold != 0")
    # Labels grow with the documents: one plan at every size, which moves the texts that have a label once.
    return rows.join(known.hint("merge"), F.col("id") == F.col("lid")).select("id", "fold", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text") -> Model:
    """Counts from folds 1 to 3, calibration on a bounded sample of fold 4.

    Without calibration rows of both classes the given weights decide. An empty
    table of labels gives a model without evidence.
    """
    ship(docs.sparkSession)
    rows = labelled_rows(docs, labels, id_col, text_col)
    counted = kept(word_counts(rows.filter("fold < 4").select("text", "toxic")), "toxic-words")
    model = Model(tables(kept(distinct_grams(counted), "toxic-grams")))
    held = rows.filter("fold = 4")
    total = labels.count()
    share = min(1.0, 5 * CALIBRATION_ROWS / max(total, 1))
    chosen = held.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    split = lambda _, evidence: {f"e{k}": evidence[:, k] for k in range(len(MARGINS))}
    table = _evidence(chosen.select("toxic", "text"), model, "e0 double, e1 double", split).toArrow()  # about CALIBRATION_ROWS rows
    y = table.column("toxic").to_numpy().astype(float)
    evidence = np.column_stack([table.column(f"e{k}").to_numpy() for k in range(len(MARGINS))])
    if 0 < y.sum() < len(y):
        model.weights = _logistic(_design(evidence), y)
    return model


def toxicity(docs: DataFrame, model: Model, text_col="text") -> DataFrame:
    """All columns of ``docs`` but the text, then score (0 to 1), which replaces a column of that name.

    Null counts as empty, which has no evidence.
    """
    ship(docs.sparkSession)
    rows = docs.select(*[c for c in docs.columns if c not in (text_col, "score")], text_col)
    return _evidence(rows, model, "score double", lambda model, evidence: {"score": model.probability(evidence)})
