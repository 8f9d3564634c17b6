"""Registered queries against SQL, and the stages of the pipeline."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from heightline.llm import queries

from .. import oracle
from .test_dedup import brute_fingerprint, brute_lines, classes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, duck, name):
    got = oracle.spark_rows(queries.QUERIES[name](spark, SF))
    assert got == oracle.duck_rows(duck, queries.ORACLE[name])
    assert got[1]


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted({int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()}) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").persist()
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    good = stages["quality rules"](spark, docs, SF).persist()
    verdicts = queries.QUERIES["op6_quality"](spark, SF).where("kept")
    assert good.columns == columns
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in verdicts.collect())

    cleaned = stages["line dedup"](spark, good, SF).persist()
    assert cleaned.columns == columns
    want = brute_lines([(r.doc_id, r.text) for r in good.collect()], 20, 2)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in cleaned.collect()) == sorted(
        (d, t, len(t)) for d, t in want if t.strip())

    single = stages["near dedup"](spark, cleaned, SF).persist()
    rows = cleaned.collect()
    marks = [brute_fingerprint(r.text) for r in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if bin(marks[a] ^ marks[b]).count("1") <= 2]
    group = classes(near, range(len(rows)))
    firsts = {}
    for i, r in enumerate(rows):
        firsts[group[i]] = min(firsts.get(group[i], r.doc_id), r.doc_id)
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(firsts.values())

    mixed = stages["mix sources"](spark, single, SF).persist()
    assert mixed.columns == columns and mixed.count() > 0

    packed = stages["pack sequences"](spark, mixed, SF)
    tokens = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("each")).collect()
    copies = Counter(r.doc_id for r in mixed.collect())
    assert {r.doc_id: r.n for r in tokens} == {r.doc_id: copies[r.doc_id] * r.each for r in tokens}
    assert set(copies) == {r.doc_id for r in tokens}
    # Where documents are cut depends on the tasks, what they hold does not.
    whole = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("each"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, tokens))
