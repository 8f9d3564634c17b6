"""Passages with edits, at their ends, and beside a frequent phrase."""

import random

from heightline.llm import passages

from .test_similar import brute_groups, edited, prose


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def words_by_doc(found, removed=None):
    """Places of the reported words of each document."""
    out = {}
    for r in found:
        if removed is None or r.removed == removed:
            out.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.n_words))
    return out


def test_edited_lines_are_reported_whole(spark):
    rng = random.Random(30)
    rows, want = [], {}
    for k in range(40):
        line = prose(rng, 60)
        near = list(line)
        near[30] = "changed"
        for copy, words in enumerate((line, near)):
            before = prose(rng, rng.randrange(0, 50))
            rows.append((2 * k + copy, "\n".join(map(" ".join, (before, words, prose(rng, 30))))))
            want[2 * k + copy] = set(range(len(before), len(before) + 60))
    found = passages.repeated_passages(docs_of(spark, rows)).collect()
    assert words_by_doc(found) == want
    assert words_by_doc(found, True) == {d: w for d, w in want.items() if d % 2}
    assert len(found) == 80


def test_equal_runs_are_found_to_their_ends(spark):
    rng = random.Random(31)
    rows, want = [], {}
    for k in range(60):
        passage = prose(rng, 51 if k < 40 else 100)
        other = list(passage)
        if k >= 40:
            other[33] = other[66] = "changed"
        for copy, words in enumerate((passage, other)):
            before = prose(rng, rng.randrange(0, 60))
            rows.append((2 * k + copy, " ".join(before + words + prose(rng, rng.randrange(0, 60)))))
            want[2 * k + copy] = {len(before) + i for i in range(len(words)) if passage[i] == other[i]}
    found = passages.repeated_passages(docs_of(spark, rows)).collect()
    got = words_by_doc(found)
    assert all(got.get(d, set()) <= w for d, w in want.items())
    assert sum(map(len, got.values())) >= 0.99 * sum(map(len, want.values()))
    # The first copy stays, the later one goes.
    assert all(r.removed == (r.doc_id % 2 == 1) for r in found)


def test_near_lines_beside_a_frequent_phrase(spark):
    rng = random.Random(32)
    phrase = prose(rng, 12)
    lines = []
    for _ in range(150):
        line = prose(rng, 10) + phrase + prose(rng, 60)
        lines += [" ".join(line), " ".join(edited(rng, line[-50:], 0)), " ".join(line[:76] + prose(rng, 6))]
    group, near = brute_groups(lines)
    assert len(near) == 150
    found = passages.line_hits(
        docs_of(spark, list(enumerate(lines))).selectExpr("doc_id AS id", "xxhash64(text) AS doc", "text"), 0.8, 16, 1000
    ).collect()
    sizes = {}
    for g in group.values():
        sizes[g] = sizes.get(g, 0) + 1
    assert {r.id for r in found} == {i for i, g in group.items() if sizes[g] > 1}
    assert {r.id for r in found if not r.removed} == {g for g, n in sizes.items() if n > 1}
