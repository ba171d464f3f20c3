import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from stormledger.llm import exact_dedup as dedup
from tests.llm import cases


def body(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[body(r[1])].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        seen = False
        for i in ids:
            kept = i == keep and not seen
            seen |= kept
            out[(i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


def found(df):
    rows = df.select("id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))).collect()
    return Counter(tuple(r) for r in rows)


def test_equals_brute_force_with_one_file_per_batch(spark, tmp_path):
    docs = cases.docs(spark, tmp_path)
    assert found(dedup.exact_dedup(docs, files_per_batch=1)) == expected(cases.rows())


def test_empty_table(spark, tmp_path):
    assert dedup.exact_dedup(cases.empty(spark, tmp_path)).count() == 0


def test_full_bytes_tell_equal_digests_apart(spark, tmp_path):
    docs = cases.docs(spark, tmp_path)
    weak = lambda text: F.unhex(F.substring(F.sha2(text, 256), 1, 1).cast("string"))  # noqa: E731  16 digests at most
    rows = dedup.exact_dedup(docs, digest=weak).select("id", "keep_id", "group_size", "kept").collect()
    assert Counter(tuple(r) for r in rows) == Counter({k[:4]: 0 for k in []}) + Counter(
        x for k, n in expected(cases.rows()).items() for x in [k[:4]] * n
    )


def test_state_goes_on_over_runs(spark, tmp_path):
    folders = dedup.Folders.below(str(tmp_path / "state"))
    schema = "doc_id long, text string"
    for part in ([(5, "a b"), (6, "c")], [(2, "a  b"), (7, "c")], [(9, "a\tb")]):
        spark.createDataFrame(part, schema).write.mode("overwrite").parquet(str(tmp_path / "part"))
        dedup.land(spark.read.parquet(str(tmp_path / "part")), folders)
        dedup.advance(spark, folders)
    groups = dedup.groups(spark, folders).select("first.id", "n").collect()
    assert sorted(map(tuple, groups)) == [(2, 3), (6, 2)]


def test_stage_keeps_one_of_each(spark, tmp_path):
    docs = cases.docs(spark, tmp_path)
    kept = dedup.without_copies(docs)
    assert kept.columns == docs.columns
    texts = Counter(body(r.text) for r in kept.collect())
    assert set(texts.values()) == {1} and set(texts) == {body(r[1]) for r in cases.rows()}


def test_columns_of_any_name_stay_as_they_are(spark):
    rows = [(1, "a b", "mine", "x"), (1, "a  b", "mine", "x"), (2, "a b", "mine", "x"), (3, "c", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_sha256 string, digest string")
    stay = dedup.without_copies(docs)
    assert stay.dtypes == docs.dtypes
    assert sorted((r.doc_id, r.text_sha256) for r in stay.collect()) == [(1, "mine"), (3, None)]
