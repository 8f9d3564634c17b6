"""The manifest against a plain recursion over lists."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from heightline.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves, fanout):
    """(root, proof of each leaf) with proofs as (before, after) pairs."""
    proofs, place, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for i, p in enumerate(place):
            run, at = runs[p // fanout], p % fanout
            proofs[i].append(("".join(run[:at]), "".join(run[at + 1 :])))
            place[i] = p // fanout
        nodes = [h(*run) for run in runs]
    return nodes[0], proofs


def brute(rows, fanout):
    def leaf(r):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    trees = defaultdict(list)
    for r in rows:
        trees[r[1]].append(((r[0] is not None, r[0] or 0, leaf(r)), r[0], leaf(r)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    low = {s: brute_tree([x[2] for x in sorted(trees[s])], fanout) for s in order}
    root, high = brute_tree([low[s][0] for s in order], fanout)
    out = []
    for s, upper in zip(order, high):
        for (_, id_, own), proof in zip(sorted(trees[s]), low[s][1]):
            out.append((id_, s, own, low[s][0], root, proof + upper))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        ((r.doc_id, r.source, r.leaf, r.subroot, r.root, [(p.before, p.after) for p in r.proof]) for r in df.collect()), key=repr
    )


def corpus(sizes, seed=1):
    rng = random.Random(seed)
    rows = [(i, s, rng.choice(["en", None]), rng.randrange(99), f"text {i}\nß") for s, n in sizes.items() for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("fanout,levels", [(3, 1), (3, 2), (2, 1), (3, 7)])
def test_equals_recursion(spark, fanout, levels):
    # One leaf, whole blocks, blocks and one leaf more, and lengths with several short last subtrees.
    rows = corpus({"a": 1, None: 9, "b": 10, "ä": 28, "z": 82, "": 4, "c": 3})
    df = merkle.manifest(spark.createDataFrame(rows, SCHEMA), COLUMNS, fanout=fanout, levels=levels)
    assert found(df) == brute(rows, fanout)


def test_proofs_fold_to_the_root_and_find_tampering(spark):
    rows = corpus({"a": 30, "b": 7})
    df = spark.createDataFrame(rows, SCHEMA).withColumn("other", merkle.leaf_digest(*(F.upper(c) if c == "text" else F.col(c) for c in COLUMNS)))
    got = merkle.manifest(df, COLUMNS, carry=["other"], levels=1).select(
        "root", merkle.fold(F.col("leaf"), F.col("proof")).alias("mine"), merkle.fold(F.col("other"), F.col("proof")).alias("other")
    )
    assert all(r.root == r.mine != r.other for r in got.collect())


def test_nulls_repeats_long_texts_and_clashing_names(spark):
    rows = [(1, "a", "en", 3, "x")] * 5 + [(None, "a", None, None, None), (None, None, None, None, ""), (2, None, "de", 9, "y" * 3_000_000)]
    rows += [(1, "a", "en", 3, "other")]
    df = spark.createDataFrame(rows, SCHEMA)
    odd = df.select("*", *(F.lit(7).alias(c) for c in ("tree", "node", "block", "position", "root", "proof", "c0", "by")))
    assert found(merkle.manifest(odd, COLUMNS, levels=1)) == brute(rows, 3)


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(empty, COLUMNS).collect() == []
    rows = [(1, "a", "en", 1, "x")]
    (got,) = merkle.manifest(spark.createDataFrame(rows, SCHEMA), COLUMNS).collect()
    assert got.leaf == got.subroot == got.root and got.proof == []


def test_no_task_holds_a_source(spark):
    rows = corpus({"hot": 2000, "b": 5})
    df = merkle.manifest(spark.createDataFrame(rows, SCHEMA), COLUMNS, levels=2)
    assert found(df) == brute(rows, 3)
