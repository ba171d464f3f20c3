import random

import corpus_pipeline
from tests.llm import cases


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()  # no other white space in these texts
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def left(rows):
    """Ids that stay, by all pairs."""
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and sets[j] and both >= 0.8 * (len(x) + len(sets[j]) - both) - 1e-9:
                parent[cases.find(parent, i)] = cases.find(parent, j)
    first = {}
    for k, (i, _) in enumerate(rows):
        root = cases.find(parent, k)
        first[root] = min(first.get(root, i), i)
    return sorted(i for k, (i, _) in enumerate(rows) if not sets[k] or first[cases.find(parent, k)] == i)


def test_every_pair_of_the_similarity_is_reduced(spark):
    random.seed(6)
    words = "the of and river stone light house market winter garden letter signal copper silver".split()
    rows = [(0, ""), (1, None), (2, "one two"), (3, "One  two")]
    for base in range(12):
        own = [random.choice(words) + str(random.randrange(9)) for _ in range(random.choice((40, 200, 900)))]
        rows.append((len(rows), " ".join(own)))
        for _ in range(8):  # each differs from the last in up to 3 in 100 words: chains, and pairs on either side of 0.8
            own = list(own)
            for _ in range(random.randint(1, max(1, len(own) * 3 // 100))):
                own[random.randrange(len(own))] = "other" + str(random.randrange(99))
            rows.append((len(rows), " ".join(own)))
    random.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == left(rows)
    assert len(left(rows)) < 70


def test_awkward_rows(spark, tmp_path):
    docs = cases.docs(spark, tmp_path)
    have = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, "").collect()]
    assert sum(i is None for i, _ in have) == 2 and {10, 11, 12} <= {i for i, _ in have}
    assert (17, "another text under a known id") in have and 18 not in {i for i, _ in have}
    assert corpus_pipeline.near_copies(spark, cases.empty(spark, tmp_path), "").count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("not text rlike '[\\\\x0b\\\\x0c\\\\x1c-\\\\x1f\\\\x85\\\\xa0]'")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == left(rows)


def test_a_large_bucket_of_many_clusters(spark, monkeypatch):
    """All texts share one bucket; what is joined follows the members, not their pairs."""
    from stormledger.llm import near_copies

    random.seed(9)
    # Texts of a cluster differ in one of 60 words, texts of two clusters in half of them.
    common = [f"c{i}" for i in range(30)]
    rows = []
    for cluster in range(40):
        own = [f"k{cluster}x{i}" for i in range(30)]
        for copy in range(20):
            words = common + own
            words[30 + copy % 3] = f"v{copy}"
            rows.append((len(rows), " ".join(words)))
    sketches = near_copies.sketches
    one = near_copies.F.array(near_copies.F.lit(1).cast("long"))
    monkeypatch.setattr(near_copies, "sketches", lambda *args: sketches(*args).withColumn("bands", one))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked, similar = [], near_copies._similar
    monkeypatch.setattr(near_copies, "_similar", lambda pairs, *rest: asked.append(pairs.count()) or similar(pairs, *rest))
    stay = sorted(r.doc_id for r in near_copies.one_per_group(docs).collect())
    assert stay == left(rows) and 40 <= len(stay) < 200
    # Clusters that are no copies of each other are told apart by their pairs, each met once.
    assert len(asked) > 3 and sum(asked[:-1]) < 12 * len(rows) and asked[-1] < len(rows) ** 2 / 2


def test_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, 7, 8, 9), (2, text + " more", 7, 8, 9), (3, "other words", 7, 8, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int, own int, body int")
    kept = corpus_pipeline.near_copies(spark, docs, "")
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_fingerprints_link_texts_that_share_no_bucket(spark, monkeypatch):
    """SimHash is a step of its own: it finds near copies that no band brings together, and each link is checked."""
    from stormledger.llm import near_copies, simhash

    words = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "more"])), (3, " ".join(f"x{i}" for i in range(3000))), (4, " ".join([*words, "more"] * 2))]
    prints = [simhash.fingerprint(text, 5) for _, text in rows]
    assert (prints[0] ^ prints[1]).bit_count() <= 4 and (prints[0] ^ prints[2]).bit_count() > 4
    sketches = near_copies.sketches
    alone = near_copies.F.array("node")
    monkeypatch.setattr(near_copies, "sketches", lambda *args: sketches(*args).withColumn("bands", alone))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == left(rows) == [1, 3]
    assert sorted(r.doc_id for r in near_copies.one_per_group(docs, similarity=1.0).collect()) == [1, 2, 3, 4]


def test_a_large_group_with_many_outliers_makes_no_row_per_pair(spark, monkeypatch):
    """Members of one group and texts that only share buckets with them: no pair of them becomes a row."""
    from stormledger.llm import near_copies

    random.seed(3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(500):
        words = list(base)
        for i in range(1 if k % 5 < 3 else 8):  # one change of a word leaves 0.93, eight leave about 0.6
            words[random.randrange(150)] = f"v{k}x{i}"
        rows.append((k, " ".join(words)))
    asked, similar = [], near_copies._similar
    monkeypatch.setattr(near_copies, "_similar", lambda pairs, *rest: asked.append(pairs.count()) or similar(pairs, *rest))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stay = sorted(r.doc_id for r in near_copies.one_per_group(docs).collect())
    assert stay == left(rows) and 150 < len(stay) <= 201
    assert max(asked) < 20 * len(rows), asked


def test_bit_maps_lose_no_pair():
    import numpy as np

    from stormledger.llm import near_copies

    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 64, n, np.uint64)) for n in (1, 2, 7, 60, 64, 300, 5000)]
    for whole in list(sets):
        for part in (0.05, 0.15, 0.21, 0.4):  # of a set goes, and once as much comes
            cut = whole[rng.random(len(whole)) >= part]
            sets += [x for x in (cut, np.unique(np.r_[cut, rng.integers(0, 1 << 64, len(whole) - len(cut), np.uint64)])) if len(x)]
    n = len(sets)
    maps = [near_copies.bit_map(s) for s in sets]
    component, slot = np.arange(n) // 2, np.arange(n) % 2
    for similarity in (0.3, 0.8, 1.0):
        for slots in (np.zeros(n, int), slot):
            a, b = near_copies.near_pairs(np.array([len(s) for s in sets]), maps, component, slots, similarity)
            have = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
            assert len(have) == len(a)
            may = {(x, y) for x in range(n) for y in range(x + 1, n) if component[x] != component[y] and (slots[x] != slots[y] or not slots.any())}
            alike = lambda x, y: len(np.intersect1d(sets[x], sets[y])) / len(np.union1d(sets[x], sets[y]))
            assert {p for p in may if alike(*p) >= similarity} <= have <= may and len(have) < len(may) / 2
    none = np.zeros(0, int)
    assert not len(near_copies.near_pairs(none, [], none, none, 0.8)[0])


def test_slots_of_a_bucket_meet(spark):
    from stormledger.llm import near_copies

    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base[: k % 50], f"v{k}", *base[k % 50 + 1 :]]) for k in range(90)]
    members = spark.createDataFrame([(k, 56, 7, k) for k in range(90)], "node long, size long, bucket long, component long")
    sets = near_copies._sets(spark.createDataFrame(list(enumerate(texts)), "node long, text string"), 5)
    one, many = ({tuple(r) for r in near_copies._candidates(members, sets, 0.8, slots).collect()} for slots in (2048, 7))
    sets = [shingles(t) for t in texts]
    alike = {(x, y) for x in range(90) for y in range(x + 1, 90) if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])}
    assert one == many and len(alike) > 100 and alike <= one and len(one) < 90 * 89 / 4
