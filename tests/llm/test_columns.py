"""Columns of the caller that are named like the operators' own are kept."""

from pyspark.sql import functions as F

import corpus_pipeline
from digestloom.llm import columns, decontaminate, line_dedup, toxicity
from digestloom.llm.queries import ship, table

SF = "/root/testdata/sf0.001"
OWN = ["_dl_text", "_dl_removed", "_dl_lines", "_dl_spans", "_dl_items", "own_dl_text"]


def with_clashes(spark):
    ship(spark)
    docs = table(spark, SF, "documents").limit(60)
    return docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in OWN})


def check(df, docs):
    assert df.columns[: len(docs.columns)] == docs.columns
    rows = df.collect()
    assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in OWN)


def test_operators_keep_columns_of_the_caller(spark):
    docs = with_clashes(spark)
    check(toxicity.drop_toxic(docs, table(spark, SF, "labels")), docs)
    check(decontaminate.decontaminate(docs, table(spark, SF, "benchmark")), docs)
    kept = line_dedup.remove_repeated_lines(docs)
    check(kept, docs)
    assert kept.columns[-2:] == ["_dl_lines_", "_dl_removed_"]


def test_a_stage_keeps_columns_of_the_caller(spark):
    docs = with_clashes(spark)
    stage = corpus_pipeline.drop_repeated_lines(spark, docs, SF)
    check(stage, docs)
    assert stage.columns == docs.columns


def test_names_are_found_again(spark):
    docs = spark.createDataFrame([(1, 2, 3)], "_dl_a int, own_dl_a int, b int")
    aside, back = columns.set_aside(docs)
    assert aside.columns == ["own_dl_a_", "own_dl_a", "b"] and aside.withColumnsRenamed(back).columns == docs.columns
    assert columns.renamed("_dl_a", back) == "own_dl_a_" and columns.renamed("b", back) == "b"
