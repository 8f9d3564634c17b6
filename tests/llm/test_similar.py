"""Near copies by 5-word Jaccard similarity against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from heightline.llm import components, passages, similar, words

from .test_dedup import classes, docs_of


def prose(rng, n):
    return [rng.choice("bcdfghklmn") + rng.choice("aeiou") + str(rng.randrange(10**6)) for _ in range(n)]


def edited(rng, words, changes):
    words = list(words)
    for at in rng.sample(range(len(words)), changes):
        words[at] = "edit" + str(rng.randrange(10**6))
    return words


def brute_groups(texts):
    sets = [similar.shingles_of(similar.words_in(t)) for t in texts]
    near = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2)
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return classes(near, range(len(texts))), near


def test_pipeline_drops_near_copies_at_four_fifths(spark):
    rng = random.Random(20)
    texts = []
    for k in range(40):
        base = prose(rng, 300)
        texts += [" ".join(base), *(" ".join(edited(rng, base, n)) for n in (1, 3, 6, 6, 40))]
    # A chain: neighbours are similar, its ends are not.
    link = prose(rng, 200)
    for _ in range(8):
        link = link[8:] + prose(rng, 8)
        texts.append(" ".join(link))
    # Ten different texts with a frequent passage.
    passage = prose(rng, 60)
    texts += [" ".join(prose(rng, 100) + passage) for _ in range(10)]
    texts += ["", None, " \n", "a b", "A  b", "a b c", "x " * 100_000, "x " * 50_000]
    group, near = brute_groups(texts)
    assert len(near) > 200
    df = docs_of(spark, list(enumerate(texts)))
    found = {r.doc_id: r.component_id for r in similar.near_copies(df).collect()}
    assert found == group
    assert {r.doc_id: r.component_id for r in similar.near_copies(df, most=0).collect()} == group
    left = corpus_pipeline.near_dedup(spark, df, "")
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(group.values()))
    assert corpus_pipeline.near_dedup(spark, df.limit(0), "").count() == 0


def test_links_beside_the_smallest_of_a_key(spark):
    """B and C are similar, A shares their key, is the smallest and near neither."""
    rng = random.Random(21)
    bodies, members = [], []
    for key in range(30):
        a, b = prose(rng, 60), prose(rng, 60)
        c = edited(rng, b, 1)
        for node, words in zip((-3 * key - 3, 3 * key + 1, 3 * key + 2), (a, b, c)):
            bodies.append((node, bytearray(" ".join(words).encode())))
            members.append((key, node, 56))
    found = similar.linked(
        spark.createDataFrame(members, "key long, node long, size long"),
        spark.createDataFrame(bodies, "node long, words binary"),
    ).collect()
    roots = {r.node: r.root for r in found}
    assert set(roots) == {n for k in range(30) for n in (3 * k + 1, 3 * k + 2)}
    assert all(roots[3 * k + 1] == roots[3 * k + 2] for k in range(30)) and len(set(roots.values())) == 30


def test_rows_alike_and_null_ids(spark):
    rows = [(1, "a b c d e"), (2, "a b  C d e"), (2, "a b  C d e"), (None, "a b c d e"), (None, "only here"), (6, None), (7, "")]
    left = similar.drop_near_copies(docs_of(spark, rows)).select(F.col("doc_id")).collect()
    assert sorted(map(repr, (r.doc_id for r in left))) == ["1", "6", "None"]


def test_estimated_sizes_stay_small_over_many_rounds(spark, capsys):
    """A path takes many rounds; the sizes estimated for its joins must not multiply from round to round."""
    order = random.Random(22).sample(range(1000), 400)
    path = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    found = components.components(path)
    found.explain("cost")
    sizes = re.findall(r"sizeInBytes=([^,)]*)", capsys.readouterr().out)
    assert sizes and max(int(m[1]) for m in [re.search(r"E\+(\d+)", s) or (0, 0) for s in sizes]) < 200
    rows = found.collect()
    assert sorted(r.node for r in rows) == sorted(order) and len({r.root for r in rows}) == 1


def test_bands_of_many_texts_are_those_of_each():
    rng = random.Random(23)
    texts = [[rng.choice("abcdef").encode() for _ in range(n)] for n in (5, 6, 16, 40, 5, 300)] + [[b"x"] * 50]
    hashes = np.array([xxhash.xxh64_intdigest(w) for t in texts for w in t], np.uint64)
    keys, sizes = similar.bands_of(hashes, np.array([len(t) for t in texts]), 8, 2)
    for t, k, n in zip(texts, keys, sizes):
        own, size = similar.band_keys(t, 8, 2)
        assert k.tolist() == own.tolist() and n == size == len(similar.shingles_of(t))
    assert similar.bands_of(hashes[:0], np.empty(0, np.int64), 8, 2)[0].shape == (0, 8)


def test_texts_are_split_alike_in_any_portion(monkeypatch):
    rng = random.Random(24)
    texts = [None, "", "\n", " \n\t", "a b", "X" * 9 + "\n" + " ".join(prose(rng, 40)) + "\n\n" + "\n".join(" ".join(prose(rng, n)) for n in (3, 15, 16, 17)), "caf\u00e9 \u00a0 x"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(range(7)), pa.array(texts)], names=["id", "doc", "text"])
    whole = pa.Table.from_batches(passages._split(16)(iter([batch]))).to_pylist()
    monkeypatch.setattr(passages, "PORTION", 1)
    parts = list(passages._split(16)(iter([batch, batch.slice(0, 0)])))
    assert len(parts) > 1 and pa.Table.from_batches(parts).to_pylist() == whole
    for row, text in zip(whole, texts):
        words = similar.words_in(text)
        lines = [similar.words_in(x) for x in (text or "").split("\n")]
        assert row["words"] == [len(x) for x in lines if len(x) >= 16]
        assert [words[s : s + n] for s, n in zip(row["starts"], row["words"])] == [x for x in lines if len(x) >= 16]
        assert row["paragraphs"] == passages.Paragraphs(words).whole.view(np.int64).tolist()
        assert row["borders"] == passages.Paragraphs(words).borders.tolist()
        assert row["keys"] == [k for x in lines if len(x) >= 16 for k in similar.band_keys(x, 8, 2)[0].view(np.int64).tolist()]


def test_lines_that_share_a_frequent_passage_are_no_candidates(spark):
    """300 nodes of one key: a phrase in all, and a near copy of every tenth. The pairs looked at are those near copies."""
    rng = random.Random(25)
    phrase = prose(rng, 20)
    lines = [phrase + prose(rng, 40) for _ in range(270)]
    near = [edited(rng, line, 1) for line in lines[::9]]
    sets = [sorted(similar._shingle_set([w.encode() for w in line]).view(np.int64).tolist()) for line in lines + near]
    rest = spark.createDataFrame([(0, i, len(s), i) for i, s in enumerate(sets)], "key long, node long, size long, root long")
    held = spark.createDataFrame(list(enumerate(sets)), "node long, shingles array<long>")
    found = sorted(map(tuple, similar._candidates(rest, held, 0.8).collect()))
    assert found == [(9 * i, 270 + i) for i in range(30)]
    assert sorted(map(tuple, similar._verified(similar._candidates(rest, held, 0.8), held, 0.8).collect())) == found


def test_candidates_hold_all_similar_pairs(spark):
    """A large group of copies with 0 to 8 edits, whose first lies far from the others, against all pairs."""
    rng = random.Random(26)
    base = prose(rng, 60)
    texts = [" ".join(edited(rng, base, rng.randrange(9))) for _ in range(120)]
    sets = [similar._shingle_set(t.encode().split()).view(np.int64).tolist() for t in texts]
    rest = spark.createDataFrame([(k, i, len(s), i) for i, s in enumerate(sets) for k in (0, 1)], "key long, node long, size long, root long")
    held = spark.createDataFrame(list(enumerate(sets)), "node long, shingles array<long>")
    found = [tuple(r) for r in similar._candidates(rest, held, 0.8).collect()]
    assert len(found) == len(set(found)) < 120 * 119 // 2
    assert {tuple(r) for r in similar._verified(similar._candidates(rest, held, 0.8), held, 0.8).collect()} == set(brute_groups(texts)[1])


def test_words_are_split_and_hashed_as_bytes_are():
    rng = random.Random(27)
    values = [bytes(rng.randrange(256) for _ in range(n)) for n in range(70)] * 3
    assert words.hashed(pa.array(values, pa.binary()).slice(1)).tolist() == [xxhash.xxh64_intdigest(v) for v in values[1:]]
    assert words.hashed(pa.array([], pa.string())).tolist() == []
    texts = [None, "", " ", "a", "  A b\x0b\x0cC\r\n d ", "cafÉ   x\x1cy  z", "\t" * 5, "X" * 99 + " y"]
    found, counts = words.words_at(words.lowered(pa.array(texts)))
    want = [similar.words_in(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want] and found.cast(pa.binary()).to_pylist() == [x for w in want for x in w]


def test_paragraphs_of_many_texts_are_those_of_each():
    rng = random.Random(28)
    texts = [[rng.choice("abcdefgh").encode() for _ in range(n)] for n in (0, 1, 4, 5, 6, 7, 0, 0, 300, 12)] + [[b"x"] * 40, []]
    each = [passages.Paragraphs(t) for t in texts]
    hashes = np.concatenate([p.hashes for p in each])
    found = passages.Paragraphs(hashes, np.array([len(t) for t in texts]))
    assert found.borders.tolist() == [b for p in each for b in p.borders.tolist()]
    assert found.whole.tolist() == [w for p in each for w in p.whole.tolist()]
    assert found.counts.tolist() == [len(p.whole) for p in each] and max(found.counts) > 20
