"""Benchmark decontamination by canonical templates, in built-in expressions only.

Texts are cut into word and number tokens. Numbers, names (capitalised words
inside a sentence) and units (after a number) become typed placeholders, so a
question that was asked again with other values keeps its template. Windows of
canonical tokens are hashed; the hashes of the benchmark meet those of the
documents in one hash join. Per occurrence the values in the slots are compared:
a value of the item must always have become the same value in the document.

The documents are read once and never shuffled: windows are opened up in the
scan's own stage and only those the benchmark knows go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stormledger.llm.common import kept, text_of

WINDOW = 8
#: Literal tokens a template needs; windows with fewer have to be found word for word.
MIN_LITERALS = 4
#: Share of an item's windows that must be found.
COVERAGE = 0.5
#: Rows of benchmark windows (some 250 bytes each) up to which they are sent to all executors;
#: beyond, windows of documents and benchmark meet in a shuffled hash join.
BROADCAST_ROWS = 400_000
# Names of units, singular and plural.
UNITS = (
    "percent cm mm m km inch inches foot feet yard yards mile miles g kg mg lb lbs pound pounds ounce ounces ton tons "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month "
    "months year years dollar dollars cent cents euro euros degree degrees meter meters metre metres gram grams "
    "kilogram kilograms kilometer kilometers kilometre kilometres watt watts volt volts joule joules mph kmh"
).split()
NAME_MARK = "\ue001"  # private use: no text word starts with it by accident
NUMBER, NAME, UNIT = 1, 2, 3


def tokens(text: Column) -> Column:
    """Lower-case word and number tokens in order; names carry a mark in front."""
    marked = F.regexp_replace(text, r"(?<=[\p{Ll},;]\x20)(?=\p{Lu}\p{Ll})", NAME_MARK)
    pattern = rf"{NAME_MARK}?\p{{L}}++|\p{{N}}++(?:[.,]\p{{N}}++)*+"
    return F.regexp_extract_all(F.lower(marked), F.lit(pattern), F.lit(0))


def canonical(words: Column) -> Column:
    """A number per token: its hash, or the type of its placeholder."""
    is_number = lambda w: (w >= "0") & (w < ":")  # noqa: E731  first character is a digit

    def code(word: Column, i: Column) -> Column:
        after_number = (i > 0) & is_number(F.get(words, i - 1))
        return (
            F.when(is_number(word), F.lit(NUMBER).cast("long"))
            .when(word.startswith(NAME_MARK), F.lit(NAME).cast("long"))
            .when(word.isin(UNITS) & after_number, F.lit(UNIT).cast("long"))
            .otherwise(F.xxhash64(word))
        )

    return F.transform(words, code)


def windows(codes: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` codes, by start."""
    starts = F.sequence(F.lit(0), F.size(codes) - size)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(codes, i + k) for k in range(size)]))
    return F.when(F.size(codes) >= size, hashed).otherwise(F.array().cast("array<long>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, size, item_at, item_words, weak, slots, hash, all_windows, strong_windows) of all windows.

    A weak window has too few literals for its template to say anything. An item shorter than a window is one window of its own length.
    """
    # A first word counts as a name or not by what stands before it in a document: both forms are known.
    inside = tokens(F.concat(F.lit("x "), text_of()))
    t = benchmark.select("item_id", tokens(text_of()).alias("words")).union(
        benchmark.select("item_id", F.slice(inside, 2, F.greatest(F.size(inside) - 1, F.lit(0))))
    )
    t = t.withColumn("codes", canonical(F.col("words"))).filter(F.size("words") > 0)
    t = t.withColumn("size", F.least(F.size("words"), F.lit(window)))
    starts = F.sequence(F.lit(0), F.size("words") - F.col("size"))
    t = t.withColumn("item_at", F.explode(starts))
    part = lambda name: F.slice(name, F.col("item_at") + 1, F.col("size"))
    t = t.withColumn("item_words", part("words")).withColumn("item_codes", part("codes"))
    literals = F.size(F.filter("item_codes", lambda c: ~c.isin(NUMBER, NAME, UNIT)))
    t = t.withColumn("weak", literals < F.least(F.lit(MIN_LITERALS), F.col("size")))
    slots = F.filter(F.sequence(F.lit(0), F.col("size") - 1), lambda k: F.get("item_codes", k).isin(NUMBER, NAME, UNIT))
    of_size = [
        F.when(F.col("size") == k, F.xxhash64(*[F.get("item_codes", F.lit(i)) for i in range(k)])) for k in range(1, window + 1)
    ]
    t = t.select("item_id", "size", "item_at", "item_words", "weak", slots.alias("slots"), F.coalesce(*of_size).alias("hash")).distinct()
    totals = t.groupBy("item_id").agg(
        F.countDistinct("item_at").alias("all_windows"), F.countDistinct(F.when(~F.col("weak"), F.col("item_at"))).alias("strong_windows")
    )
    return t.join(totals, "item_id")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document and item that share templates.

    (id, body, item_id, item_windows, found, coverage, slots, changed_slots);
    ``body`` is a hash of the text, so rows that repeat an id stay apart.
    ``found`` counts the item's windows in occurrences whose slots are consistent,
    of all windows or of those that are not weak, whichever covers more.
    """
    known = kept(benchmark_windows(benchmark, window), "benchmark-windows")
    sizes = [r["size"] for r in known.select("size").distinct().collect()]  # at most ``window`` values
    text = text_of(text_col)
    t = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("body"), tokens(text).alias("words"))
    t = t.withColumn("codes", canonical(F.col("words")))
    small = known.count() <= BROADCAST_ROWS
    found = None
    for size in sorted(sizes):
        opened = t.select("id", "body", "words", F.posexplode(windows(F.col("codes"), size)).alias("doc_at", "hash"))
        index = known.filter(F.col("size") == size)
        same = F.slice("words", F.col("doc_at") + 1, size) == F.col("item_words")
        index = index.withColumnRenamed("hash", "item_hash")
        on = (F.col("hash") == F.col("item_hash")) & (~F.col("weak") | same)
        hit = opened.join(F.broadcast(index) if small else index, on)
        pairs = F.transform(
            "slots",
            lambda k: F.struct(F.get("item_words", k).alias("i"), F.get("words", F.col("doc_at") + k).alias("d")),
        )
        hit = hit.select(
            "id", "body", "item_id", "all_windows", "strong_windows", "weak", "item_at", (F.col("doc_at") - F.col("item_at")).alias("shift"), pairs.alias("pairs")
        )
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        found = t.select(
            "id", "body", F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"), *[F.lit(0).cast("long").alias(f"{k}_windows") for k in ("all", "strong")],
            F.lit(False).alias("weak"), F.lit(0).alias("item_at"), F.lit(0).alias("shift"), F.expr("array() as pairs").cast("array<struct<i:string,d:string>>").alias("pairs"),
        ).filter(F.lit(False))
    # The list is bounded by the item: one entry per window of it.
    item = ["id", "body", "item_id", "all_windows", "strong_windows"]
    placed = found.groupBy(*item, "shift").agg(F.collect_set(F.struct("item_at", "weak", "pairs")).alias("hits"))
    placed = placed.withColumn("pairs", F.array_distinct(F.flatten(F.transform("hits", lambda h: h["pairs"]))))
    values = F.array_distinct(F.transform("pairs", lambda p: p["i"]))
    placed = placed.filter(F.size(values) == F.size("pairs"))
    at = lambda hits: F.transform(hits, lambda h: h["item_at"])
    changed = F.size(F.filter("pairs", lambda p: p["i"] != p["d"]))
    union = lambda name: F.size(F.array_distinct(F.flatten(F.collect_set(name)))).cast("long")
    best = placed.withColumn("at", at("hits")).withColumn("strong_at", at(F.filter("hits", lambda h: ~h["weak"]))).groupBy(*item).agg(
        union("at").alias("all_found"), union("strong_at").alias("strong_found"),
        F.max(F.size("pairs")).alias("slots"), F.max(changed).alias("changed_slots"),
    )
    # Templates alone may be covered better where the values of weak windows are new.
    strong = F.col("strong_found") * F.col("all_windows") > F.col("all_found") * F.col("strong_windows")
    best = best.select(
        "id", "body", "item_id", F.when(strong, F.col("strong_windows")).otherwise(F.col("all_windows")).alias("item_windows"),
        F.when(strong, F.col("strong_found")).otherwise(F.col("all_found")).alias("found"), "slots", "changed_slots",
    )
    return best.withColumn("coverage", F.col("found") / F.col("item_windows"))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, window: int = WINDOW, id_col="doc_id", text_col="text") -> DataFrame:
    """Matches that cover enough of an item.

    Null and empty texts and items match nothing. Rows that repeat id and text
    give one row; items that repeat an id count together.
    """
    return matches(docs, benchmark, window, id_col, text_col).filter(F.col("coverage") >= coverage)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, window: int = WINDOW, id_col="doc_id", text_col="text") -> DataFrame:
    """The documents less those that hold an item, all columns as they were."""
    bad = contaminated(docs, benchmark, coverage, window, id_col, text_col)
    bad = kept(bad.select(F.col("id").alias("bad"), "body").distinct(), "contaminated")
    on = docs[id_col].eqNullSafe(bad["bad"]) & (F.xxhash64(text_of(text_col)) == bad["body"])
    return docs.join(bad, on, "left_anti")
