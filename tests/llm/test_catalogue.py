"""Queries of the training-data operators against their SQL, and the pipeline stage by stage."""

import subprocess
import sys
import zlib

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from digestloom.llm.oracle import ORACLE
from digestloom.llm.queries import QUERIES, table
from tests.llm import brute
from tests.parity import compare, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLE[name]) == []


def test_pipeline_stage_by_stage(spark):
    """Every stage but the first does what plain Python does with the same input."""
    docs = table(spark, SF, "documents")
    columns = docs.columns
    items = [(r[0], r[1]) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        pairs = [(d, r["text"]) for d, r in before.items()]
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), "stage")
        rows = docs.collect()
        if name == "best-fit packing":
            assert {r["doc_id"] for r in rows} == set(before)
            continue
        assert docs.columns == columns
        after = {r["doc_id"]: r for r in rows}
        assert len(after) == len(rows)
        if name == "toxicity":
            mild = {d for d, t in pairs if not set(brute.words(t)) & {"idiot", "moron", "scum", "worthless"}}
            # A text labelled toxic may hold other marks than these four words.
            mild -= {r[0] for r in table(spark, SF, "labels").filter("toxic = 1").select("doc_id").collect()}
            assert mild <= set(after) and len(after) < len(before)
        elif name == "line dedup":
            kept, removed = brute.kept_lines(pairs)
            expected = {d: k for (d, _), k, n in zip(pairs, kept, removed) if k.strip() or not n}
            assert {d: r["text"] for d, r in after.items()} == expected
            assert all(r["n_chars"] == len(r["text"]) for d, r in after.items() if r["text"] != before[d]["text"])
        elif name == "n-gram Jaccard join":
            assert set(after) == {c for _, _, c in brute.components(pairs)}
        else:
            assert set(after) == {d for d, *_, hit in brute.contamination(pairs, items) if not hit}


def test_whole_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert rows and max(ends.values()) <= 4096


def test_one_of_repeated_rows_stays(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text), (3, text), (3, text), (None, text), (None, "alone"), (7, None), (8, "")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_chars long")
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(["3", "None", "None", "7", "8"])
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_the_rest_works_without_this_package():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'digestloom.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']\n"
        "assert e.queries() and set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True)


def test_checksums_are_those_of_zlib(spark):
    assert spark.range(1).selectExpr("crc32('17')").first()[0] == zlib.crc32(b"17")
