"""The pipeline's stages against plain Python on the small tables."""

import os
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tablelog.llm.queries import tokenizer_path
from tests.llm.conftest import ODD
from tests.llm.test_decontaminate import expected
from tests.llm.test_mixing import SIZE
from tests.llm.test_near_join import groups, shingles

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")

tokenizers = pytest.importorskip("tokenizers")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, SF)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        out.append(rows)
        if len(out) <= len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    return out


def test_quality(spark, stages):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[1]}
    known = [r["doc_id"] for r in stages[0] if r["doc_id"] in label]
    assert np.mean([(i in kept) == (label[i] == 1) for i in known]) > 0.9


def test_near_copies(stages):
    """One of each group by five words and 0.8."""
    want = groups({r["doc_id"]: shingles(r["text"], 5) for r in stages[1]}, 80)
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(set(want.values()))


def test_benchmark(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r["doc_id"] for r in stages[2] if not expected(r["text"], items)[1]]
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(clean)


def test_mix(stages):
    size = lambda rows: sum(len(SIZE.findall(r["text"] or "")) for r in rows)
    assert {r["doc_id"] for r in stages[4]} <= {r["doc_id"] for r in stages[3]}
    assert 1.3 * size(stages[3]) < size(stages[4]) < 1.7 * size(stages[3])


def test_tokens(stages):
    reference = tokenizers.Tokenizer.from_file(tokenizer_path())
    at, want = 0, []
    for r in sorted(stages[4], key=lambda r: r["doc_id"]):
        ids = [*reference.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in stages[5]) == want


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.select(*stages[5][0].asDict()).collect())) == sorted(map(tuple, stages[5]))
    assert re.fullmatch("doc_id,start,n_tokens,ids_crc32", ",".join(got.columns))


def test_odd_tables(spark, documents):
    """NULLs, empty and very long texts, equal rows, extra columns and empty tables, through every stage."""
    long = "word " * 30_000 + "end"
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    docs = documents([*rows, *rows[:5], *ODD, (None, None, None), (7000, long, "a")])
    for table in (docs, docs.filter("doc_id is null"), docs.filter("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SF)
            assert out.columns == table.columns, name
            out = spark.createDataFrame(out.collect(), out.schema)
            given = {(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()}
            assert {(r["doc_id"], r["text"]) for r in out.collect()} <= given
            table = out
        tokens = corpus_pipeline.STAGES[-1][1](spark, table, SF)
        assert tokens.count() == table.count()
