import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stormledger.llm import simhash
from stormledger.llm.bitslice import linked
from stormledger.llm.graph import components
from tests.llm import cases


def slow_print(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, radius=4):
    prints = [slow_print(r[1]) for r in rows]
    parent = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            near = bin(prints[i] ^ prints[j]).count("1") <= radius
            if near and (rows[i][0] is not None or prints[i] == prints[j]):
                a, b = cases.find(parent, i), cases.find(parent, j)
                parent[a] = b
            if rows[i][0] is not None and rows[i][0] == rows[j][0]:
                parent[cases.find(parent, i)] = cases.find(parent, j)
    least = {}
    for i, r in enumerate(rows):
        root = cases.find(parent, i)
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    return sorted((str(r[0]), prints[i], str(least.get(cases.find(parent, i)))) for i, r in enumerate(rows))


def test_fingerprints_and_groups_equal_brute_force(spark, tmp_path):
    found = simhash.near_groups(cases.docs(spark, tmp_path)).collect()
    got = sorted((str(r.id), r.print % (1 << 64), str(r.component)) for r in found)
    assert got == slow_groups(cases.rows())


def test_groups_on_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted((str(r.id), r.print % (1 << 64), str(r.component)) for r in simhash.near_groups(docs).collect())
    assert got == slow_groups([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_slots_lose_no_link(spark):
    random.seed(5)
    base = [random.getrandbits(63) for _ in range(20)]
    prints = list({b ^ sum(1 << k for k in random.sample(range(63), random.randrange(4))) for b in base for _ in range(60)})
    nodes = spark.createDataFrame(list(enumerate(prints)), "node long, print long")
    one = components(simhash.links(nodes, slot_rows=1 << 20)).collect()
    many = components(simhash.links(nodes, slot_rows=7)).collect()
    parent = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                a, b = cases.find(parent, i), cases.find(parent, j)
                parent[max(a, b)] = min(a, b)
    want = {(i, cases.find(parent, i)) for i in range(len(prints))}
    assert {tuple(r) for r in one} <= want and {tuple(r) for r in many} <= want
    alone = {(i, r) for i, r in want if sum(1 for _, x in want if x == r) == 1}
    assert {tuple(r) for r in one} == {tuple(r) for r in many} == want - alone


@pytest.mark.parametrize("radius", [0, 1, 4, 6])
def test_bit_planes_equal_popcounts(radius):
    rng = np.random.default_rng(radius)
    prints = rng.integers(0, 2**63, 150, dtype=np.uint64)
    prints[75:] = prints[:75] ^ (np.uint64(1) << rng.integers(0, 64, 75).astype(np.uint64))
    row, root = linked(np.zeros(150, int), np.zeros(150, int), prints, radius)
    pairs = {(i, j) for i in range(150) for j in range(i) if bin(int(prints[i] ^ prints[j])).count("1") <= radius}
    assert len(row) == len(pairs)  # links here are pairs of two
    with pytest.raises(ValueError):
        linked(np.zeros(2, int), np.zeros(2, int), prints[:2], 7)


def test_components_of_a_chain_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += edges[:5] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200 + i: 200 for i in range(9)}


def test_empty_table_and_stage(spark, tmp_path):
    assert simhash.near_groups(cases.empty(spark, tmp_path)).count() == 0
    docs = cases.docs(spark, tmp_path)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    groups = {r[0]: r[2] for r in slow_groups(cases.rows())}
    have = {str(r.doc_id) for r in kept.collect()}
    assert have == {i for i, c in groups.items() if i == "None" or i == c or slow_print(dict((str(r[0]), r[1]) for r in cases.rows())[i]) == 0}
    assert kept.filter(F.col("text") == "").count() == 1
