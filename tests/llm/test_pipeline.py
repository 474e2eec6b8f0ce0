"""Every registered query of the text operators, and the pipeline, on the smallest tables."""

import math
import os

import duckdb
import pytest

import corpus_pipeline
from monthmart.llm.queries import ORACLE, QUERIES

TABLE = {"op3_extraction": "pages", "op4_packing": None, "op6_chat": None, "op8_nearest": None, "op10_decontamination": None}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    table = TABLE.get(name, "documents")
    if name in ORACLE:
        con = duckdb.connect()
        for file in os.listdir(sf_dir):
            con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
        columns = sorted(rows.columns)
        expected = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
        assert sorted(map(repr, map(tuple, rows.select(*columns).collect()))) == sorted(map(repr, expected)) and expected
    elif table:
        assert rows.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    else:
        assert rows.count() > 0


def test_stages_keep_columns_and_shrink(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "stage")
        after = docs.count()
        assert docs.columns == columns and 0 < after <= before
        before = after
    packed = corpus_pipeline.packing_stage(spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.select("doc_id").collect()}
    used = len({r.sequence_id for r in packed})
    assert used <= math.ceil(sum(r.length for r in packed) / 2048) + 1
