import corpus_pipeline
import pytest

import __spark_entry__ as entry
from stormledger.llm import queries
from tests.compare import connect, differences
from tests.llm import cases

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.CHECKS))
def test_query_equals_its_sql(spark, name):
    found = queries.QUERIES[name](spark, SF).toPandas()
    assert differences(found, connect(SF).sql(queries.CHECKS[name]).df()) is None


def test_every_query_is_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 11))


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = cases.docs(spark, tmp_path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        after.write.parquet(str(tmp_path / name))
        before, docs = docs.count(), spark.read.parquet(str(tmp_path / name))
        assert docs.count() <= before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_run_equals_its_stages_on_given_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = corpus_pipeline.run(spark, SF).collect()
    left = {r.doc_id for r in rows}
    normal = lambda t: " ".join(t.replace("\x0b", " ").split())
    assert len({normal(docs[i]) for i in left}) == len(left)
    assert not any(item in docs[i] for i in left for item in items)
    gone = {normal(docs[i]) for i in docs if i not in left} - {normal(docs[i]) for i in left}
    assert len(gone) <= len(docs) * 0.1
    bins = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert bins.get(r.sequence_id, 0) == r.offset
        bins[r.sequence_id] = r.offset + r.length
