"""The lattice against every segmentation written out, the model against a plain restatement."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from stormledger.llm import lattice
from stormledger.llm.lattice_queries import op13_lattice_scores
from tests.llm import cases

NAME = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def pieces():
    return lattice.vocabulary(NAME)


def segmentations(text, known):
    if not text:
        yield []
    for n in range(1, len(text) + 1):
        if text[:n] in known:
            for rest in segmentations(text[n:], known):
                yield [text[:n], *rest]


WORDS = [b"the", b"thing", b"x", "naïve".encode(), "日".encode(), b"\x00\xff", b"storms"]


def test_sum_over_all_segmentations(pieces):
    weights = pieces.prior()
    log = dict(zip(pieces.pieces, weights.pieces.tolist()))
    got = lattice.spelled(pieces, weights, WORDS)
    for word, found in zip(WORDS, got):
        paths = [sum(log[p] for p in path) for path in segmentations(b" " + word, log)]
        assert len(paths) >= 1
        assert found == pytest.approx(math.log(math.fsum(map(math.exp, paths))) + weights.stop, abs=1e-9)


def test_expected_counts_over_all_segmentations(pieces):
    weights = pieces.prior()
    log = dict(zip(pieces.pieces, weights.pieces.tolist()))
    want = Counter()
    for word in WORDS:
        paths = list(segmentations(b" " + word, log))
        chance = [math.exp(sum(log[p] for p in path)) for path in paths]
        for path, c in zip(paths, chance):
            for p in path:
                want[p] += c / sum(chance)
    strings = sorted((b" " + w for w in WORDS), key=len, reverse=True)
    got = lattice.Lattice(pieces, weights, strings).expected(len(pieces.pieces))
    for p, x in zip(pieces.pieces, got):
        assert x == pytest.approx(want[p], abs=1e-9)


def test_long_words_in_blocks(pieces):
    weights = pieces.prior()
    word = b" " + bytes(random.Random(1).choices(b"thestorms", k=900))
    whole = lattice.Lattice(pieces, weights, [word]).totals()[0]
    for block in (1, 7, 64, 900, 5000):
        assert lattice.long_total(pieces, weights, word, block) == pytest.approx(whole, abs=1e-8)
    big = b"ab" * 100_000
    assert math.isfinite(lattice.spelled(pieces, weights, [b"x", big])[1])


def test_first_and_later_pieces_are_distributions(pieces):
    for weights in (pieces.prior(), pieces.fitted(np.arange(len(pieces.pieces)) % 7.0, 50.0)):
        p = np.exp(weights.pieces)
        assert p[pieces.first].sum() == pytest.approx(1) and p[~pieces.first].sum() + math.exp(weights.stop) == pytest.approx(1)


def test_fitting_raises_the_likelihood(pieces):
    words = sorted({w.encode() for w in "storm stormy storms stormed ledger ledgers ledgered onset onsets onsetting".split()}, key=len, reverse=True)
    weights, seen = pieces.prior(), []
    for _ in range(4):
        seen.append(lattice.spelled(pieces, weights, words).sum())
        weights = pieces.fitted(1000 * lattice.Lattice(pieces, weights, [b" " + w for w in words]).expected(len(pieces.pieces)), 1000.0 * len(words))
    assert seen == sorted(seen) and seen[-1] > seen[0]


def restated(rows, pieces, rounds=lattice.ROUNDS):
    """(base and model score of each row) by dictionaries and plain sums."""
    low = lambda t: [w.lower() for w in (t or "").encode().split()]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    count = Counter()
    for i, t in rows:
        if not held(i):
            count.update([*low(t), None])
    n, v = sum(count.values()), len(count)
    base = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    types = sorted((w for w in count if w is not None), key=lambda w: -len(w))
    weights = pieces.prior()
    for _ in range(rounds if types else 0):
        weights = pieces.fitted(lattice.Lattice(pieces, weights, [b" " + w for w in types]).expected(len(pieces.pieces)), len(types))
    once, twice = (sum(c == k and w is not None for w, c in count.items()) for k in (1, 2))
    d = once / (once + 2 * twice) if once and twice else 0.5
    spell = {}
    for w in {w for _, t in rows for w in low(t)}:
        spell[w] = math.exp(lattice.spelled(pieces, weights, [w])[0])
    score = lambda w: math.log10((max(count[w] - d, 0) + (d * len(types) + 1) * spell[w]) / (n + 2))
    end = math.log10((count[None] + 1) / (n + 2))
    for i, t in rows:
        words = low(t)
        known = sum(count[w] > 0 for w in [*words, None])
        yield i, held(i), len(words) + 1, known, n, math.fsum(map(base, [count[w] for w in [*words, None]])), end + math.fsum(map(score, words))


def close(got, want):
    key = lambda r: (r[0] is None, str(r[0]), r[2], round(r[5], 3))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def write(spark, path, rows):
    spark.createDataFrame(rows, cases.SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_query_equals_restatement(spark, tmp_path, pieces, monkeypatch):
    # A small head, so that most words go by the shuffle, long ones by their digest.
    monkeypatch.setattr(lattice, "HEAD", 30)
    rows = cases.rows() + [(i, f"word{i % 40} {'long' * (i % 50)} Of tail{i}", *cases.rows()[0][2:]) for i in range(200, 400)]
    got = op13_lattice_scores(spark, write(spark, tmp_path, rows))
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    close(got.collect(), restated([x[:2] for x in rows], pieces))


def test_other_names_and_no_training_rows(spark, tmp_path, pieces):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs = spark.createDataFrame([(i, "some words", 0, "x") for i in held], "row int, key string, score int, word string")
    scores, model = lattice.lattice_scores(docs, "row", "key")
    rows = scores.collect()
    assert len(rows) == len(held) and model.tokens == 0 and all(math.isfinite(x.score) and x.n_known == 0 and x.n_tokens == 3 for x in rows)
    (want,) = {round(x[6], 9) for x in restated([(i, "some words") for i in held], pieces)}
    assert {round(x.score, 9) for x in rows} == {want}


def test_empty_table(spark, tmp_path):
    assert op13_lattice_scores(spark, write(spark, tmp_path, [])).count() == 0


def test_unseen_texts_are_likelier_than_with_their_letters_shuffled(spark):
    r, rows = random.Random(4), []
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    unused = (i for i in range(10**6, 10**7) if zlib.crc32(str(i).encode()) % 10 == 0)
    pairs = []
    for d in docs:
        rows.append((d.doc_id, d.text))
        if zlib.crc32(str(d.doc_id).encode()) % 10 == 0 and d.text and len(d.text) > 200:
            other = next(unused)
            pairs.append((d.doc_id, other))
            rows.append((other, " ".join("".join(r.sample(w, len(w))) for w in d.text.split())))
    scores, _ = lattice.lattice_scores(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x.id: x for x in scores.collect()}
    assert len(pairs) >= 5 and all(got[a].score > got[b].score and got[a].n_tokens == got[b].n_tokens for a, b in pairs)
