"""The stages of the pipeline on odd tables: nothing crashes, nothing clean is lost, columns stay."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import documents, edge_rows

ITEM = "what is the capital of the country that lies north of the great lake and its river"


@pytest.fixture(scope="module")
def tables(session, tmp_path_factory):
    """A folder of small tables whose columns clash with names that the operators use."""
    folder = str(tmp_path_factory.mktemp("tables"))
    vile = "you vile stupid scum, "
    rows = [(100 + i, f"clean text number {i} tells of things and places " * 4) for i in range(90)]
    rows += [(200 + i, vile * 6 + f"number {i}") for i in range(30)]
    rows += [(300, "a passage before. " + ITEM + " and after"), (None, None)]
    documents(session, rows + edge_rows()).write.parquet(f"{folder}/documents.parquet")
    labels = [(100 + i, 1, 0) for i in range(90)] + [(200 + i, 0, 1) for i in range(30)] + [(None, None, None), (100, 1, 0)]
    session.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn(
        "text", F.lit("clash")).write.parquet(f"{folder}/labels.parquet")
    session.createDataFrame([(1, ITEM), (2, None), (None, "x")], "item_id long, text string").withColumn(
        "doc_id", F.lit("clash")).write.parquet(f"{folder}/benchmark.parquet")
    return folder


def ids(df):
    return sorted((x.doc_id is not None, x.doc_id or 0) for x in df.select("doc_id").collect())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1], ids=lambda x: x if isinstance(x, str) else "")
def test_stages_on_odd_rows(session, tables, name, stage):
    docs = session.read.parquet(f"{tables}/documents.parquet")
    left = stage(session, docs, tables)
    assert left.columns == docs.columns
    assert [f.dataType for f in left.schema] == [f.dataType for f in docs.schema]
    found = ids(left)
    # Null, empty and blank texts, rows without an id, and one of each long text stay.
    for known, doc in [(True, 1), (True, 2), (True, 3), (True, 5), (False, 0)]:
        assert (known, doc) in found, doc
    gone = {doc for known, doc in ids(docs) if known} - {doc for known, doc in found if known}
    if name == "toxicity":
        assert gone and all(200 <= doc < 230 for doc in gone)
    if name == "near_duplicates":
        assert 6 in gone and 5 not in gone
    if name == "decontamination":
        assert gone == {300}
    # An empty table stays empty.
    assert stage(session, docs.limit(0), tables).count() == 0


def test_last_stage_on_odd_rows(session, tables):
    docs = session.read.parquet(f"{tables}/documents.parquet")
    packed = corpus_pipeline.STAGES[-1][1](session, docs, tables)
    assert {x.doc_id for x in packed.select("doc_id").collect()} >= {1, 2, 3, 5, 6, 300}
    assert corpus_pipeline.STAGES[-1][1](session, docs.limit(0), tables).count() == 0


def test_whole_pipeline_on_odd_rows(session, tables):
    kept = {x.doc_id for x in corpus_pipeline.run(session, tables).select("doc_id").collect()}
    assert 5 in kept and not kept & {6, 300}
