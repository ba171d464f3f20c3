"""Periodic runs against a restatement that tries every lag and every place."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from stormledger.llm import runs
from stormledger.llm.run_queries import op12_periodic_runs
from tests.llm import cases


def brute(words, shortest=12):
    """All maximal stretches of each lag; a stretch keeps its smallest period."""
    found = {}
    for q in range(1, len(words)):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                found.setdefault((i - q, j), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def fast(words, shortest=12):
    number = {}
    start, stop, period = runs.find_runs(np.array([number.setdefault(w, len(number)) for w in words], np.int64), shortest)
    return list(zip(start.tolist(), (stop - start).tolist(), period.tolist()))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 9)), max_size=6), st.integers(1, 16))
def test_equals_brute_force(parts, shortest):
    words = [w for block, times in parts for w in block * times]
    assert fast(words, shortest) == brute(words, shortest)


@pytest.mark.parametrize("seed", range(6))
def test_long_periods(seed):
    r = random.Random(seed)
    block = lambda n, kinds: [r.randrange(kinds) for _ in range(n)]
    words = block(50, 99) + block(70, 5) * 3 + block(17, 99) * 4 + (block(33, 3) * 3 + block(2, 99)) * 3 + block(200, 99) * 2 + block(16, 2) * 2 + block(31, 2) * 5
    assert fast(words) == brute(words)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def test_words_that_repeat_everywhere():
    for words in (fibonacci(3000), list("ab" * 700 + "a" * 900), (["a"] * 120 + ["b"]) * 12, list("aab" * 40 + "aabaab" * 9 + "b" * 30) * 4):
        assert fast(words) == brute(words)


@pytest.mark.parametrize("words", [["a"] * 400_000, (["a"] * 1000 + ["b"]) * 200, fibonacci(200_000)], ids=["one word", "blocks", "fibonacci"])
def test_dense_texts_do_not_cost_the_square(words):
    began = time.time()
    found = fast(words)
    assert time.time() - began < 60 and found
    if len(set(words)) == 1:
        assert found == [(0, 400_000, 1)]


def planted(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    found = brute(words) if len(words) < 5000 else fast(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    milli = best[1] and 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def shape(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is None, str(x)) for x in r])


def write(spark, path, rows):
    spark.createDataFrame(rows, cases.SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")


def test_query_equals_brute_force(spark, tmp_path):
    r = random.Random(5)
    rows = cases.rows()
    # Ids of both kinds, texts that are periodic by themselves and texts that become so.
    for i in range(100, 240):
        text = " ".join(r.choice(["x", "y", "zz"]) for _ in range(r.randrange(1, 40))) if i % 3 else " ".join(str(r.randrange(300)) for _ in range(150))
        rows.append((i, f" {text}\t" * (1 + i % 4), "en", "s", 1, i, "", "", 0.0, 0, ""))
    assert any(zlib.crc32(str(x[0]).encode()) % 10 == 0 for x in rows)
    write(spark, tmp_path, rows)
    got = op12_periodic_runs(spark, str(tmp_path)).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert shape(got.collect()) == shape(expected(x[0], x[1]) for x in rows)


def test_operator_has_its_own_interface(spark):
    docs = spark.createDataFrame([("k", "a b " * 9 + "c", 1, 2), ("l", None, 3, 4)], "runs string, body string, collapsed int, n_words int")
    rows = {x.id: x for x in runs.periodic_runs(docs, "runs", "body").collect()}
    assert [tuple(x) for x in rows["k"].runs] == [(0, 18, 2)] and rows["k"].collapsed == "a b c" and rows["k"].n_words == 19
    assert rows["l"].runs == [] and rows["l"].collapsed == "" and rows["l"].n_words == 0


def test_empty_table(spark, tmp_path):
    write(spark, tmp_path, [])
    assert op12_periodic_runs(spark, str(tmp_path)).count() == 0
