"""Language identification: known words first, then ever shorter character n-grams.

The classifier is fitted on a bounded sample of labelled rows. A word that the
sample knows is scored by its log frequency per language. A word that it does
not know is covered from left to right by the longest known n-gram at each
place, down to single characters. Both kinds of evidence are shares among the
languages, so neither outweighs the other by its scale.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stormledger.llm.common import crc32_mod, remember, ship

#: Labelled rows per language that the fit uses, chosen by a hash of their id.
SAMPLE_PER_LANGUAGE = 3000
MAX_GRAM = 4
#: Occurrences in the sample from which on a word or n-gram is known.
MIN_COUNT = 3
#: Least log share that one word, or one word by its n-grams, gives a language.
FLOOR, GRAM_FLOOR = -8.0, -4.0
#: Words after which more of the same evidence no longer raises the score.
ENOUGH_WORDS = 20
#: Scores that a worker remembers before it starts anew.
REMEMBERED = 200_000
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def sample(docs: DataFrame, training: Column, per_language: int = SAMPLE_PER_LANGUAGE, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """(lang, text) of at most about ``per_language`` labelled training rows each."""
    labelled = docs.filter(training & F.col(lang_col).isNotNull())
    counts = labelled.groupBy(lang_col).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per language
    share = F.create_map(*[x for lang, n in counts for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))]) if counts else None
    if share is None:
        return labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    chance = F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) / F.lit(1 << 20)
    return labelled.filter(chance < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))


def grams_of(word: str, longest: int = MAX_GRAM) -> Iterator[str]:
    """N-grams of a word between boundary marks; they start with their length's digit, which no word does."""
    marked = f" {word} "
    for n in range(1, longest + 1):
        for i in range(len(marked) - n + 1):
            yield f"{n}{marked[i : i + n]}"


def feature_counts(rows: DataFrame) -> DataFrame:
    """(lang, feature, n) over whole texts: words, and the n-grams of all their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words.setdefault(lang, Counter()).update(WORD.findall((text.as_py() or "").lower()))
        langs, features, counts = [], [], []
        for lang, own in words.items():
            total = Counter(own)
            for word, n in own.items():
                for gram in grams_of(word):
                    total[gram] += n
            langs += [lang] * len(total)
            features += total.keys()
            counts += total.values()
        columns = [pa.array(langs, pa.string()), pa.array(features, pa.string()), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "feature", "n"])

    counted = rows.mapInArrow(run, "lang string, feature string, n long")
    return counted.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


class Model:
    """Languages, and a row of log shares per known word or n-gram."""

    def __init__(self, langs: list[str], features: dict[str, int], rows: np.ndarray):
        self.langs, self.features, self.rows = langs, features, rows

    @classmethod
    def fit(cls, counted: DataFrame, min_count: int = MIN_COUNT) -> Model:
        """From (lang, feature, n) of the sample; bounded as the sample is."""
        known = counted.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("n"), F.sum("n").alias("total"))
        table = known.filter(F.col("total") >= min_count).select("feature", "n").collect()
        langs = sorted({lang for _, n in table for lang in n})
        at = {lang: k for k, lang in enumerate(langs)}
        counts = np.zeros((len(table), len(langs)))
        for row, (_, n) in enumerate(table):
            for lang, value in n.items():
                counts[row, at[lang]] = value
        # Frequencies among features of one kind: words, or n-grams of one length.
        kind = np.array([int(f[0]) if f[0].isdigit() else 0 for f, _ in table], int) if table else np.zeros(0, int)
        logs = np.zeros_like(counts)
        for k in np.unique(kind):
            own = counts[kind == k] + 0.5
            logs[kind == k] = np.log(own) - np.log(own.sum(axis=0))
        peak = logs.max(axis=1, keepdims=True) if len(langs) else logs
        logs = logs - peak - np.log(np.exp(logs - peak).sum(axis=1, keepdims=True))
        return cls(langs, {f: k for k, (f, _) in enumerate(table)}, np.maximum(logs, FLOOR).astype(np.float32))

    def word(self, word: str) -> np.ndarray:
        """Log shares of a word, by itself or by the n-grams that cover it."""
        row = self.features.get(word)
        if row is not None:
            return self.rows[row]
        marked, at, parts = f" {word} ", 0, []
        while at < len(marked):
            for n in range(min(MAX_GRAM, len(marked) - at), 0, -1):
                row = self.features.get(f"{n}{marked[at : at + n]}")
                if row is not None:
                    parts.append(self.rows[row])
                    break
            at += n if row is not None else 1
        if not parts:
            return np.full(len(self.langs), -np.log(len(self.langs)), np.float32)
        return np.maximum(np.sum(parts, axis=0), GRAM_FLOOR)


class Scorer(dict):
    """Predicts with a model; remembers the words it has met."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.table, self.used = model, np.zeros((1024, len(model.langs)), np.float32), 0

    def __missing__(self, word: str) -> int:
        if self.used == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[self.used] = self.model.word(word)
        self[word] = self.used
        self.used += 1
        return self.used - 1

    def predict(self, text: str | None) -> tuple[str, float]:
        words = WORD.findall((text or "").lower())
        if not words or not self.model.langs or not any(map(str.isalpha, words)) and not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        if self.used > REMEMBERED:
            self.clear()
            self.used = 0
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        seen = self.table[rows]
        evidence = seen.mean(axis=0, dtype=np.float64) * min(len(words), ENOUGH_WORDS)
        share = np.exp(evidence - evidence.max())
        share /= share.sum()
        best = int(share.argmax())
        return self.model.langs[best], float(share[best])


def fit(docs: DataFrame, training: Column, per_language: int = SAMPLE_PER_LANGUAGE, id_col="doc_id", text_col="text", lang_col="lang") -> Model:
    ship(docs.sparkSession)
    return Model.fit(feature_counts(sample(docs, training, per_language, id_col, text_col, lang_col)))


def identify(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """All columns of ``docs`` but the text, then lang_pred and score, which replace columns of that name.

    ``und`` with score 0 for a null text, one without letters, or a model without languages.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember()
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.predict(text.as_py()) for text in batch.column(len(others))]
            columns = batch.columns[: len(others)] + [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*others, "lang_pred", "score"])

    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.select(*others, text_col).mapInArrow(run, f"{types}, lang_pred string, score double")


def in_known_language(docs: DataFrame, model: Model, min_score: float = 0.3, id_col="doc_id", text_col="text") -> DataFrame:
    """The documents that are not rejected, all columns as they were.

    Rejected are texts without a letter and those in which no language has
    ``min_score`` of the evidence.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember()
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.predict(text.as_py()) for text in batch.column(at)]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in found]))

    return docs.mapInArrow(run, docs.schema)


def training_rows(id_col="doc_id") -> Column:
    """Rows a fit may learn from; the others are held out."""
    return crc32_mod(id_col, 5) != 0
