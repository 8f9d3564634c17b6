"""SimHash, exact and line duplicates against brute force."""

import hashlib
import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from heightline.llm import components, exact, lines, simhash

DOCS = "doc_id long, text string, mark string, _id string"


def docs_of(spark, rows):
    """Documents with columns named like those the operators add."""
    return spark.createDataFrame([(i, t, "m", "x") for i, t in rows], DOCS)


def brute_fingerprint(text):
    words = [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m.group().lower(), w)
             for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    loose = [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(150)]
    pairs = chain + star + loose + [(7, 7), (8, 9)]
    found = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = classes(pairs, {n for p in pairs for n in p})
    by_root = {}
    for r in found:
        by_root.setdefault(r.root, set()).add(want[r.node])
    assert all(len(v) == 1 for v in by_root.values())
    assert len(by_root) == len({want[r.node] for r in found})
    assert {r.node for r in found} == {n for a, b in pairs if a != b for n in (a, b)}


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_links_are_all_pairs_within_the_distance(spark, distance):
    rng = random.Random(distance)
    marks = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        marks.add(base)
        for _ in range(8):
            marks.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4))))
    signed = [(m - (1 << 64) if m >> 63 else m,) for m in marks]
    found = simhash.links(spark.createDataFrame(signed, "mark long"), distance).collect()
    want = {(min(a, b), max(a, b)) for (a,), (b,) in itertools.combinations(signed, 2)
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance}
    assert {(r.a, r.b) for r in found} == want and len(found) == len(want)


def test_simhash_brute_force(spark):
    rng = random.Random(1)
    vocabulary = ["The", "of", "and", "ÉTÉ", "b", "ß", "run", "tree", "Stone", "sea"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 40, 300]))) for _ in range(40)]
    texts += [t.replace(" ", "\n", 1) for t in texts[:10]] + [t + " tail" for t in texts if len(t) > 900]
    texts += ["", None, " \t\r\n", "word", "WORD", "x " * 300_000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4]), (None, "alone in the world")]
    got = simhash.near_duplicates(docs_of(spark, rows)).select(
        "doc_id", simhash.fingerprint_hex(F.col("mark")).alias("fingerprint"), "component_id").collect()
    marks = [brute_fingerprint(t) for _, t in rows]
    near = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2)
            if bin(marks[a] ^ marks[b]).count("1") <= 2]
    group = classes(near, range(len(rows)))
    want = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if group[k] == group[i] and rows[k][0] is not None]
        want.append((doc, f"{marks[i]:016x}", min(ids) if ids else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d"), (2, "a b  c d"), (2, "a b  c d"), (None, "a b c d"), (5, "other words here"), (6, None), (7, "")]
    df = docs_of(spark, rows)
    left = simhash.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 5, 6]
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [0, exact.SMALL_ROWS])
def test_exact_brute_force(spark, most):
    rng = random.Random(2)
    base = ["".join(rng.choices("abé \n\t", k=rng.choice([0, 3, 70, 400]))) for _ in range(30)]
    spaced = [" ".join(t) for t in base[:15]]
    lookalike = ["x" * 100 + c for c in "aabc"]
    texts = base + spaced + lookalike + [None, "", " \r\x0b\x0c", "y" * 2_000_000, "y" * 2_000_000]
    rows = list(enumerate(texts)) + [(4, texts[4]), (4, texts[4]), (None, texts[4]), (None, "z")]
    df = docs_of(spark, rows).withColumn("keep_id", F.lit("clash"))
    got = exact.exact_duplicates(df, most=most).collect()
    assert len(got) == len(rows)
    groups = {}
    for doc, text in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(key, []).append((-len(text or ""), doc is None, doc or 0, doc))
    want = []
    for key, members in groups.items():
        best = min(members)
        want += [(m[3], best[3], len(members)) for m in members]
    assert sorted(map(repr, ((r.doc_id, r.keep_id, r.group_size) for r in got))) == sorted(map(repr, want))
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact.exact_duplicates(df.limit(0), most=most).count() == 0


def test_normalised_digest(spark):
    df = docs_of(spark, [(1, "a\n b\té"), (2, None)])
    got = [r[0] for r in df.select(F.sha2(exact.normalised(F.col("text")), 256)).collect()]
    assert got == [hashlib.sha256("abé".encode()).hexdigest(), hashlib.sha256(b"").hexdigest()]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(rows, least, limit):
    """Cleaned texts, for documents with ids."""
    first = {}
    for doc, text in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        for at, line in enumerate(text.split("\n")):
            if len(line) >= least and line.strip():
                first.setdefault(line, (doc, at))
    order = sorted(first, key=first.get)
    near = {b for i, b in enumerate(order) for a in order[:i]
            if abs(len(a) - len(b)) <= limit and edits(a, b) <= limit}
    out = []
    for doc, text in rows:
        if text is None:
            out.append((doc, None))
            continue
        kept = [line for at, line in enumerate(text.split("\n"))
                if line not in first or (line not in near and first[line] == (doc, at))]
        out.append((doc, "\n".join(kept)))
    return out


@pytest.mark.parametrize("limit, most", [(0, 10), (1, 1000), (2, 0), (2, 1000), (3, 1000)])
def test_lines_brute_force(spark, limit, most):
    rng = random.Random(limit)
    pool = ["".join(rng.choices("abcdé ", k=rng.randrange(18, 34))) for _ in range(40)]

    def changed(line):
        line = list(line)
        for _ in range(rng.randrange(0, limit + 2)):
            at = rng.randrange(len(line))
            what = rng.randrange(3)
            line[at : at + (what != 0)] = rng.choice("xyz") if what < 2 else ""
        return "".join(line)

    rows = [(i, "\n".join(changed(rng.choice(pool)) if rng.random() < 0.7 else rng.choice(pool)
                           for _ in range(rng.randrange(0, 6)))) for i in range(40)]
    rows += [(90, None), (91, ""), (92, "\n\n"), (93, "short\nshort\n" + " " * 30)]
    df = docs_of(spark, rows).withColumn("lines_removed", F.lit("clash"))
    got = lines.drop_repeated_lines(df, edits=limit, most=most)
    assert got.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), "lines_removed"]
    assert sorted((r.doc_id, r.text) for r in got.collect() if r.text is not None) == sorted(
        r for r in brute_lines(rows, lines.LEAST_POINTS, limit) if r[1] is not None)


def test_line_cases(spark):
    long = "one line that stands in many documents"
    rows = [(None, long), (2, long), (2, long), (3, f"{long}\n{long}s\nnew line of document three"), (4, "x" * 500_000)]
    df = docs_of(spark, rows)
    got = sorted((repr(r.doc_id), r.text, r.lines_removed) for r in lines.drop_repeated_lines(df).collect())
    assert got == sorted([("None", "", 1), ("2", long, 0), ("2", long, 0), ("3", "new line of document three", 2), ("4", "x" * 500_000, 0)])
    assert lines.drop_repeated_lines(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        lines.repeated_lines(df, least=4)
