"""The line classifier: its messages against enumeration, and its accuracy on documents held out."""

import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from heightline.llm import crf, queries

SF = "/root/testdata/sf0.01"
GOOD = "The committee met in March, and it agreed on the plan.\nMembers will report to the board before summer."
BAD = "BUY!! NOW!! BUY!! NOW!! BUY!! NOW!!\n$$$ ### %%% $$$ ### %%%"


def enumerated(weights, lines):
    """Marginals and log likelihoods by summing over all labellings of one document."""
    index = crf._index(lines)
    node = weights[: crf._NODE][index].sum(axis=1)
    step, start = weights[crf._NODE : crf._NODE + 4].reshape(2, 2), weights[crf._NODE + 4 :]
    own = [np.log([1 - p, p]) for p in 1 / (1 + np.exp(-node))]
    scores = {}
    for path in product((0, 1), repeat=len(node)):
        scores[path] = start[path[0]] + sum(o[y] for o, y in zip(own, path)) + sum(step[a, b] for a, b in zip(path, path[1:]))
    total = np.logaddexp.reduce(list(scores.values()))
    chance = [sum(np.exp(s - total) for p, s in scores.items() if p[t]) for t in range(len(node))]
    return np.array(chance), {p: s - total for p, s in scores.items()}


def test_messages_equal_enumeration():
    rng = np.random.default_rng(3)
    weights = rng.normal(0, 0.7, crf._SIZE)
    texts = [GOOD, "", BAD + "\n\n" + GOOD + "\nOne, two.\nOne, two.", "a\nb\nc"]
    together = crf.lines_of(texts)
    marginal, _ = crf.decode(weights, together)
    for text, a, b in zip(texts, together.starts[:-1], together.starts[1:]):
        lines = crf.lines_of([text])
        chance, logs = enumerated(weights, lines)
        assert np.allclose(crf.decode(weights, lines)[0][:, 1], chance)
        assert np.allclose(marginal[a:b, 1], chance)
        path = tuple(int(x) for x in rng.integers(0, 2, len(chance)))
        assert np.isclose(crf.likelihood(weights, lines, np.array(path) == 1)[0], logs[path])


def test_gradient():
    rng = np.random.default_rng(4)
    lines = crf.lines_of([GOOD, BAD, GOOD + "\n" + BAD])
    label = rng.random(len(lines.bins)) < 0.5
    at = rng.normal(0, 0.3, crf._SIZE)
    slope = crf.likelihood(at, lines, label)[1]
    for i in [*np.flatnonzero(slope)[:20], *range(crf._NODE, crf._SIZE)]:
        step = np.zeros(crf._SIZE)
        step[i] = 1e-5
        numeric = (crf.likelihood(at + step, lines, label)[0] - crf.likelihood(at - step, lines, label)[0]) / 2e-5
        assert abs(numeric - slope[i]) < 1e-5


def test_long_texts_are_measured_in_pieces(monkeypatch):
    text = "\n".join(f"{GOOD} {i % 7}" for i in range(400))
    whole = crf.lines_of([text, BAD])
    monkeypatch.setattr(crf, "PIECE", 1000)
    pieces = crf.lines_of([text, BAD])
    assert (whole.bins == pieces.bins).all() and (whole.weight == pieces.weight).all()
    assert list(whole.starts) == [0, 800, 802]


def test_lines_by_features():
    lines = crf.lines_of(["one two two.\n\none two two."])
    by_name = {n: lines.bins[:, i].tolist() for i, n in enumerate(crf.FEATURES)}
    assert by_name["times_in_document"] == [2, 0, 2]
    assert by_name["words"] == [2, 0, 2]
    assert by_name["last_kind"][0] == crf.STOP
    assert lines.weight.tolist() == [13, 1, 13]


@pytest.fixture(scope="module")
def small_model(spark):
    rows = [(i, f"{GOOD}\nNumber {i} is fine, too." if i % 2 else f"{BAD} {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    return crf.learn(docs, labels)


def test_scores_of_odd_rows(spark, small_model):
    long = "\n".join([GOOD] * 3000)
    rows = [(1, GOOD), (2, BAD), (3, None), (4, ""), (5, long), (1, GOOD), (None, BAD)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    got = df.select("doc_id", "text", crf.score(F.col("text"), small_model).alias("s")).collect()
    assert len(got) == 7 and all(0 <= r.s <= 1 for r in got)
    by = {(r.doc_id, r.text): r.s for r in got}
    assert by[1, GOOD] > 0.3 > by[2, BAD] and by[5, long] > 0.3
    assert by[2, BAD] == pytest.approx(by[None, BAD]) and by[3, None] == pytest.approx(by[4, ""])
    assert df.limit(0).select(crf.score(F.col("text"), small_model)).collect() == []


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, GOOD)], "doc_id long, text string")
    for rows in ([], [(1, 1)]):
        model = crf.learn(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert docs.select(crf.score(F.col("text"), model)).first()[0] == pytest.approx(0.5)


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op11_line_crf"](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out for r in held)
    # Some 300 labelled rows to learn from; a dozen bad ones are held out.
    for value, least in ((0, 0.8), (1, 0.97)):
        mine = [got[r.doc_id].predicted == value for r in held if r.quality == value]
        assert sum(mine) >= least * len(mine)


def test_lines_of_one_document_are_told_apart(spark):
    got = crf.learn(
        spark.createDataFrame([(i, GOOD if i % 3 else f"{GOOD}\n{BAD}\n{BAD}\n{BAD}") for i in range(90)], "doc_id long, text string"),
        spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(90)], "doc_id long, quality int"),
    )
    chance = crf.decode(got.weights, crf.lines_of([f"{GOOD}\n{BAD}"]))[0][:, 1]
    assert chance[0] > 0.5 > chance[2]
