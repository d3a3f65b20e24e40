"""The registered queries and the pipeline on the smallest tables."""

import re

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from cambio.llm.common import id_sketch, maybe_in, written
from cambio.llm.queries import ORACLE_SQL, QUERIES, op2_language, op3_toxicity
from checks.compare import _bag, connect
from tests.llm.helpers import HAVE_TABLES, SF_DIR
from tests.llm.test_minhash import brute
from tests.llm.test_packing import check_pieces
from tests.llm.test_pii import base_spans

needs_tables = pytest.mark.skipif(not HAVE_TABLES, reason="no driver tables")


def test_everything_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    answer = connect(SF_DIR).execute(ORACLE_SQL[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert _bag(frame.columns, frame.collect()) == _bag(columns, answer.fetchall())


@needs_tables
def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    """Each stage against what the operator's own query, or brute force, says about the stage's input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(str(tmp_path / "t/labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        folder = str(tmp_path / "t")
        docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
        if name == "toxicity":
            wanted = {r.doc_id for r in op3_toxicity(spark, folder).where("predicted = 0").collect()}
        elif name == "language":
            least = corpus_pipeline.LEAST_LANGUAGE_SCORE
            found = op2_language(spark, folder).where(f"lang_pred <> 'und' AND score >= {least}")
            wanted = {r.doc_id for r in found.collect()}
        elif name == "near-duplicates":
            wanted = {i for i, (_, component) in brute(list(before.items())).items() if i == component}
        else:
            wanted = set(before)
        docs = written(stage(spark, docs, SF_DIR), "test-stage")
        after = docs.collect()
        assert docs.columns == columns and len(after) == len(wanted)
        assert {r.doc_id for r in after} == wanted
        if name == "personal-data":
            assert not any(base_spans(r.text) for r in after)
            assert all(r.n_chars == len(r.text) for r in after)
            assert all(r.text == before[r.doc_id] for r in after if not base_spans(before[r.doc_id]))
        else:
            assert all(r.text == before[r.doc_id] for r in after)
    check_pieces(corpus_pipeline.run(spark, SF_DIR).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_sketch(spark):
    ids = spark.range(0, 4000, 3)
    maybe = spark.range(0, 4000).where(maybe_in(spark, id_sketch(ids, "id"), "id"))
    assert ids.join(maybe, "id", "left_anti").count() == 0 and maybe.count() < 1400
    none = id_sketch(ids.where("false"), "id")
    assert spark.range(0, 100).where(maybe_in(spark, none, "id")).count() == 0
    assert spark.sql("SELECT cast(null AS bigint) AS id").where(maybe_in(spark, none, "id")).count() == 0
