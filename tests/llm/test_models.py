import random

import numpy as np

from stormledger.llm import language, toxicity
from stormledger.llm.toxicity_queries import op7_toxicity
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, language.training_rows())
    rows = language.identify(docs.filter(~language.training_rows()), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_words_come_before_grams_and_grams_get_shorter():
    features = {"casa": 0, "4 cas": 1, "1x": 2, "2xy": 3}
    rows = np.array([[0, -8], [-1, -0.5], [-0.1, -3], [-2, -0.2]], np.float32)
    model = language.Model(["a", "b"], features, rows)
    assert model.word("casa").tolist() == [0, -8]
    assert model.word("casual").tolist() == [-1, -0.5]
    assert np.allclose(model.word("xyx"), [-2.1, -3.2])
    assert np.allclose(model.word("q"), np.log([0.5, 0.5]))


def test_language_of_awkward_rows(spark, tmp_path):
    docs = cases.docs(spark, tmp_path)
    train = spark.createDataFrame([(i, "the river and the stone", "en") for i in range(40)] + [(i, "der Fluss und der Stein", "de") for i in range(40)], "doc_id long, text string, lang string")
    model = language.fit(train, language.training_rows())
    rows = language.identify(docs, model).collect()
    assert len(rows) == len(cases.rows())
    without = {r[0] for r in cases.rows() if not any(c.isalpha() for c in r[1] or "")} - {None}
    assert {r.doc_id for r in rows if r.lang_pred == "und" and r.doc_id is not None} == without
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    kept = language.in_known_language(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} & without == set()
    assert language.identify(cases.empty(spark, tmp_path), model).count() == 0


def test_no_labelled_rows_give_no_language(spark, tmp_path):
    docs = cases.docs(spark, tmp_path)
    model = language.fit(docs.filter("false"), language.training_rows())
    assert {r.lang_pred for r in language.identify(docs, model).collect()} == {"und"}


def labelled(spark, tmp_path):
    random.seed(4)
    words = "river stone light house market winter garden letter signal copper".split()
    rude = "grumblekin grumblesnort grumblefat".split()
    texts, labels = [], []
    for i in range(900):
        bad = i % 3 == 0
        own = [random.choice(words) for _ in range(30)] + ([random.choice(rude) for _ in range(2)] if bad else [])
        random.shuffle(own)
        texts.append((i, " ".join(own)))
        labels.append((i, 1, int(bad)))
    folder = str(tmp_path / "tox")
    more = [(r[0] + 5000 if r[0] is not None else None, r[1]) for r in cases.rows()]
    spark.createDataFrame(texts + more, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels + [(3, 1, 1), (None, 1, 1), (5010, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, len(texts) + len(more)


def test_toxic_spellings_are_told_apart_also_unseen_ones(spark, tmp_path):
    folder, n = labelled(spark, tmp_path)
    rows = op7_toxicity(spark, folder).collect()
    assert len(rows) == n and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert np.mean([(r.doc_id % 3 == 0) == bool(r.predicted) for r in held]) > 0.97
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    new = spark.createDataFrame([(1, "river grumbleworth stone light house market", 9.0), (2, "river stone light house market winter", 9.0), (3, None, 9.0)], "doc_id long, text string, score double")
    score = {r.doc_id: r.score for r in toxicity.toxicity(new, model).collect()}
    assert score[1] > 0.5 > max(score[2], score[3])


def test_counts_equal_a_plain_count(spark):
    rows = spark.createDataFrame([("abab b", 1), ("abc", 0), (None, 0), ("ABAB", 0)], "text string, toxic int")
    counted = toxicity.word_counts(rows)
    assert {tuple(r) for r in counted.collect()} == {("abab", 1, 1), ("b", 1, 0), ("abc", 0, 1)}
    grams = toxicity.distinct_grams(counted).collect()
    want = set()
    for word in ("abab", "b", "abc"):
        marked = f"^{word}^"
        want |= {marked[i : i + k] for k in range(2, 6) for i in range(len(marked) - k + 1)}
    assert len(grams) == len(want)
    top = {g for g in want if len(g) == 5 or g.startswith("^")}
    assert sum(g.top for g in grams) == len(top)


def test_ratio_follows_the_formula_by_hand(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), ("b", 0)], "text string, toxic int")
    model = toxicity.Model(toxicity.tables(toxicity.distinct_grams(toxicity.word_counts(rows))))
    d = toxicity.DISCOUNT
    # "^a": each class gives its own letter 2 of 2, the other letter what the discount frees.
    shared = lambda c: (1 - d) / 4 + d * 3 / 4 / 256 if c else None
    first = np.log(((2 - d) / 2 + d / 2 * shared("a")) / (d / 2 * shared("a")))
    ratio = model.ratios(["a"])[0]
    assert ratio > 0 and abs(ratio - first) < 1.0


def test_tables_keep_every_gram_apart(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    random.seed(7)
    rows = [("".join(random.choice(letters) for _ in range(40)), i % 2) for i in range(4000)]
    grams = toxicity.distinct_grams(toxicity.word_counts(spark.createDataFrame(rows, "text string, toxic int"))).cache()
    model = toxicity.Model(toxicity.tables(grams))
    top = grams.filter("top").select("gram", "toxic", "plain").toPandas()
    size = top[["toxic", "plain"]].sum()
    at = model.rows(top["gram"].to_numpy().view(np.uint64))
    for c in ("toxic", "plain"):
        assert np.allclose(model.tables[f"top_{c}"][at], top[c] * (size.min() / size[c]))
    assert model.tables["cont"][:-1].sum() == grams.count()
    grams.unpersist()


def test_toxicity_without_labels(spark, tmp_path):
    docs = cases.docs(spark, tmp_path)
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    rows = toxicity.toxicity(docs, model).collect()
    assert len(rows) == len(cases.rows()) and all(r.score < 0.5 for r in rows)
    assert toxicity.toxicity(cases.empty(spark, tmp_path), model).count() == 0
