"""The audit against a restatement that runs every order of the filters document by document."""

import math
import random
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest

from stormledger.llm import filter_audit as audit
from stormledger.llm.audit_queries import OP11_SQL, op11_filter_audit
from tests.compare import differences
from tests.llm import cases

LABELS = "doc_id long, quality int, toxic int, id int, part string"


def failed(rows):
    """Per row the set of failed filters, word for word as the contract has them."""
    smallest = {}
    for x in rows:
        if x[0] is not None:
            smallest[x[1] or ""] = min(smallest.get(x[1] or "", x[0]), x[0])
    for x in rows:
        text = x[1] or ""
        words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
        out = set()
        out |= {"A"} if len(words) < 50 else set()
        out |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        out |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else set()
        out |= {"D"} if any(c in "#$%&*|" for c in text) else set()
        out |= {"E"} if x[0] is not None and x[0] > smallest[text] else set()
        yield out


def expected(rows, labels):
    good = {x[0] for x in labels if x[1] == 1 and x[0] is not None}
    toxic = {x[0] for x in labels if x[2] == 1 and x[0] is not None}
    parts = {}
    for x, out in zip(rows, failed(rows)):
        parts.setdefault(x[3] or "", []).append((x[0], out))
    found = []
    for part, docs in parts.items():
        told, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, own in enumerate(order):
                gone = [d for d in left if own in d[1]]
                left = [d for d in left if own not in d[1]]
                shapley[own] += len(gone)
                fails = sum(own in d[1] for d in docs)
                told.append((part, "".join(order), step + 1, len(left), len(gone), fails - len(gone), sum(d[1] == {own} for d in docs), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), own))
        found += [(*x[:-1], shapley[x[-1]]) for x in told]
    return sorted(found)


def tables(spark, path, rows, labels):
    spark.createDataFrame(rows, cases.SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return str(path)


def sample():
    r = random.Random(2)
    rows = cases.rows()
    rows = [(*x[:3], None if i % 7 == 0 else "" if i % 7 == 1 else f"p{i % 3}", *x[4:]) for i, x in enumerate(rows)]
    for i in range(300, 500):
        text = " ".join(r.choice(["a", "B", "Cd", "e#", "f", "ü", f"w{r.randrange(99)}"]) for _ in range(r.randrange(1, 90)))
        for copy in range(r.choice([1, 1, 1, 3])):
            rows.append((i * 10 + 9 - copy, text, "en", r.choice(["p0", "p1", None]), 0, 0, "", "", 0.0, 0, ""))
    r.shuffle(rows)
    labels = [(x[0], r.choice([0, 1, None]), r.choice([0, 1]), 0, "") for x in rows if r.random() < 0.7]
    return rows, labels + [(None, 1, 1, 0, "")]


def test_equals_brute_force_and_sql(spark, tmp_path):
    rows, labels = sample()
    path = tables(spark, tmp_path, rows, labels)
    got = op11_filter_audit(spark, path)
    want = expected(rows, labels)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 600 * len({x[3] or "" for x in rows})
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"create view {table} as from '{path}/{table}.parquet/*.parquet'")
    assert differences(got.toPandas(), con.sql(OP11_SQL).df()) is None


def test_empty_tables(spark, tmp_path):
    assert op11_filter_audit(spark, tables(spark, tmp_path, [], [])).count() == 0


def test_documents_without_labels(spark, tmp_path):
    rows, _ = sample()
    got = op11_filter_audit(spark, tables(spark, tmp_path, rows, []))
    assert sorted(map(tuple, got.collect())) == expected(rows, [])


@pytest.mark.parametrize("axes", [1, 2, 3])
def test_other_numbers_of_filters(axes):
    tensors = np.random.default_rng(axes).integers(0, 9, (2, 3, *[2] * axes))
    got = audit.steps(tensors)
    row = 0
    for order in permutations(range(axes)):
        for step, own in enumerate(order):
            for part in range(2):
                cells = [(p, tensors[part, :, *p]) for p in np.ndindex(*[2] * axes)]
                reach = [(p, n) for p, n in cells if not any(p[k] for k in order[:step])]
                assert got["removed"][part, row] == sum(n[0] for p, n in reach if p[own])
                assert got["kept"][part, row] == sum(n[0] for p, n in reach if not p[own])
                assert got["toxic_lost"][part, row] == sum(n[2] for p, n in reach if p[own])
                assert got["unique_fails"][part, row] == tensors[part, 0, *[int(k == own) for k in range(axes)]]
            row += 1
    assert (got["shapley"].sum(axis=1) == math.factorial(axes) * got["removed"].sum(axis=1)).all()


def test_own_filters(spark):
    docs = spark.createDataFrame([("k", "a a a", "x", 1), ("l", "b", "x", 2), ("m", "b", "y", 3)], "pattern string, digest string, n string, good int")
    labels = spark.createDataFrame([("l", 1, 0)], "doc_id string, quality int, toxic int")
    got = audit.filter_audit(docs, labels, {"W": lambda f: f.words > 2}, "R", id_column="pattern", text_column="digest", part_column="n")
    assert sorted(tuple(x)[:5] for x in got.collect()) == [("x", "RW", 1, 2, 0), ("x", "RW", 2, 1, 1), ("x", "WR", 1, 1, 1), ("x", "WR", 2, 1, 0), ("y", "RW", 1, 0, 1), ("y", "RW", 2, 0, 0), ("y", "WR", 1, 1, 0), ("y", "WR", 2, 0, 1)]
