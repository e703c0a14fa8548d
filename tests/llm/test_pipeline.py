import os
from collections import Counter

import pytest

from odd_rows import no_docs, odd_docs  # noqa: F401
import corpus_pipeline
from statforge.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not on this machine")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    cursor = connection.execute(ORACLE[name])
    columns = sorted(d[0] for d in cursor.description)
    assert columns == sorted(df.columns)
    theirs = [dict(zip((d[0] for d in cursor.description), row, strict=True)) for row in cursor.fetchall()]
    assert Counter(tuple(str(r[c]) for c in columns) for r in df.collect()) == Counter(tuple(str(r[c]) for c in columns) for r in theirs)


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages_work_on_what_is_kept(spark):
    docs = before = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.checkpointed(stage(spark, docs, SF_DIR), name)
        if name not in ("mixing", "packing"):
            assert after.count() <= docs.count() and after.exceptAll(docs).count() == 0
        if name != "packing":
            assert after.columns == before.columns and after.select("doc_id").exceptAll(after.select("doc_id").join(docs.select("doc_id").distinct(), "doc_id")).count() == 0
        if name == "exact_dedup":
            assert after.selectExpr("lower(text)").distinct().count() == after.count()
        docs = after
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(docs.columns)
    sums = docs.groupBy("sequence_id").sum("length").collect()
    assert all(r["sum(length)"] <= 2048 for r in sums)


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF_DIR).write.format("noop").mode("overwrite").save()


def test_mixing_keeps_columns_named_like_its_own(spark):
    docs = spark.createDataFrame([(i, "x" * 9, "s", f"mine{i}", 0.5, i) for i in range(200)], "doc_id bigint, text string, source string, copy string, rate double, shuffle_key int")
    out = dict(corpus_pipeline.STAGES)["mixing"](spark, docs, SF_DIR)
    assert out.dtypes == docs.dtypes
    rows = out.collect()
    assert 100 < len(rows) and all((r.copy, r.rate, r.shuffle_key) == (f"mine{r.doc_id}", 0.5, r.doc_id) for r in rows)
