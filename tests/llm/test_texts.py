"""Mixing, packing, scores, languages, passages and chat."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from heightline.llm import chat, language, mixing, packing, passages, quality, queries, toxicity
from heightline.llm.tokens import BYTE_BPE, ByteBpe

SF = "/root/testdata/sf0.01"


# --- mixing --------------------------------------------------------------------


def poisson_inverse(rate, at):
    k, log_p, below = 0, -rate, math.exp(-rate)
    while below <= at:
        k += 1
        log_p += math.log(rate / k)
        below += math.exp(log_p)
    return k


def test_mixing_brute_force(spark):
    sizes = {"hot": 900, "mid": 90, None: 9, "tiny": 1}
    rows = [(i, s, f"t{i}", "c") for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame([*rows, (None, "mid", "t", "c")], "doc_id long, source string, text string, copy string")
    sizes["mid"] += 1
    got = mixing.mix(df)
    total, weights = 1001, {s: math.sqrt(n) for s, n in sizes.items()}
    want = Counter()
    for doc, source, text, _ in [*rows, (None, "mid", "t", "c")]:
        key = "" if doc is None else str(doc)
        at = int(hashlib.md5(f"mix:{key}".encode()).hexdigest()[:13], 16) / 2**52
        rate = weights[source] / sum(weights.values()) * total / sizes[source]
        for copy in range(1, poisson_inverse(rate, at) + 1):
            want[(doc, source, text, copy)] += 1
    assert Counter((r.doc_id, r.source, r.text, r["copy"]) for r in got.collect()) == want
    by_source = Counter(s for _, s, _, _ in want.elements())
    for source, weight in weights.items():
        mean = total * weight / sum(weights.values())
        assert abs(by_source[source] - mean) < 6 * math.sqrt(mean * max(1, mean / sizes[source]))


def test_mixing_by_name_and_empty(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(400)], "doc_id long, source string")
    counts = Counter(r.source for r in mixing.mix(df, weights={"a": 3.0, "c": 1.0}).collect())
    assert set(counts) == {"a"} and 300 < counts["a"] < 500
    few = mixing.mix(df.where("doc_id < 20"), weights={"a": 1.0}, epochs=200.0)
    assert 3000 < few.count() < 5000
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df, weights={"z": 1.0}).count() == 0


# --- packing -------------------------------------------------------------------


def test_packing_is_a_partition_of_all_tokens(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["the", "sea", "été", "Größe", "\n", "<|endoftext|>", "123"], k=rng.choice([1, 60, 900, 5000]))) for _ in range(80)]
    texts += [None, "", "x" * 5000, "word " * 300_000, "two  spaces \n\n end "]
    rows = list(enumerate(texts)) + [(None, "no id"), (5, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).repartition(3)
    got = packing.pack(df).collect()
    full = ByteBpe().full
    want = Counter()
    for doc, text in rows:
        ids = np.array([*full.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want[(doc, len(ids), ids.tobytes())] += 1
    pieces = defaultdict(list)
    for r in got:
        pieces[(r.doc_id, r.doc_tokens)].append(r)
    found = Counter()
    for (doc, total), parts in pieces.items():
        parts.sort(key=lambda r: r.start)
        copies = sum(1 for p in parts if p.start == 0)
        covered = np.zeros(total, dtype=int)
        ids = np.zeros(total, dtype="<u4")
        for p in parts:
            covered[p.start : p.start + p.length] += 1
            ids[p.start : p.start + p.length] = np.frombuffer(p.ids, "<u4")
        # Rows that share an id are alike here, but may be cut differently.
        assert (covered == copies).all()
        found[(doc, total, ids.tobytes())] += copies
    assert found == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = tokens = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
        tokens += end
        padding += 0 if end & (end - 1) == 0 else 1024 - end
    assert padding < 0.005 * tokens
    assert packing.pack(df.limit(0)).count() == 0


def test_ranks_give_the_ids_of_the_tokenizer(spark):
    coder = ByteBpe(BYTE_BPE)
    for row in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 20 = 3").collect():
        assert coder.encode(row.text).tolist() == coder.full.encode(row.text, add_special_tokens=False).ids
    said = "a <|endoftext|> b"
    assert coder.encode(said).tolist() == coder.full.encode(said, add_special_tokens=False).ids
    assert coder.decode(coder.encode_ordinary(said)) == said


# --- toxicity ------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    scored = queries.QUERIES["op5_toxicity"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = scored.where("held_out").collect()
    right = sum((r.toxic == 1) == (r.predicted == 1) for r in rows)
    assert right / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot": 9.0, "mor*": 4.0}, frozenset({"village idiot"}))
    matcher = lexicon.matcher()
    for text in ("an IDIOT", "an 1d1ot here", "an id​iot", "an іdiot", "an idi0t."):
        assert matcher.measure(text)[0] == 9.0, text
    assert matcher.measure("the village idiot spoke")[0] == 0.0
    assert matcher.measure("morbid idiotic 1984 10")[0] == 4.0
    assert matcher.measure("idiot idiot")[0] == 18.0
    assert matcher.measure(None) == (0.0, 0)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert [r[0] < 0.7 for r in docs.select(toxicity.score(F.col("text"), lexicon)).collect()] == [True, True]
    assert docs.limit(0).select(toxicity.score(F.col("text"), lexicon)).count() == 0


# --- quality -------------------------------------------------------------------


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {p + k for at in windows.values() if len(at) > 1 for p in at for k in range(3)}
    kept = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(kept) - len(set(kept)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_quality_base_and_verdict(spark):
    rng = random.Random(4)
    prose = [" ".join(rng.choices(["the", "of", "Tree", "stone.", "a", "river", "and"], k=80)) for _ in range(20)]
    odd = ["", None, " \n\t", "one", "a b", "é" * 100, "the " * 60, "x\nx\n \n x\nx", "w " * 200_000, "# " * 70 + "a b"]
    rows = [(i, t, "en") for i, t in enumerate(prose + odd)] + [(None, prose[0], None), (0, prose[0], "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("words", F.lit("clash"))
    known = quality.references(df)
    assert [r.language for r in known] == ["en"]
    got = quality.assess(df, known).collect()
    want = Counter((r[0], *brute_base(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    left = quality.drop_low_quality(df)
    assert left.columns == df.columns
    assert left.count() == sum(r.kept for r in got)
    assert not any(r.kept for r in got if r.base_failed)
    assert quality.assess(df, []).where("character_distance IS NOT NULL").count() == 0
    assert quality.drop_low_quality(df.limit(0)).count() == 0


def test_quality_keeps_clean_documents(spark):
    judged = queries.QUERIES["op6_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    sound = judged.where("NOT base_failed")
    assert sound.where("quality = 1 AND NOT kept").count() == 0
    junk = sound.where("quality = 0")
    assert junk.where("kept").count() <= 0.5 * junk.count()


# --- passages ------------------------------------------------------------------


def test_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(6)

    def prose(n):
        return [rng.choice("bcdfghklmn") + rng.choice("aeiou") + str(rng.randrange(10**6)) for _ in range(n)]

    shared = [prose(rng.randrange(51, 80)) for _ in range(40)]
    rows, planted = [], set()
    for k, passage in enumerate(shared):
        for copy in range(3):
            doc = 10 * k + copy
            before = prose(rng.randrange(0, 90))
            rows.append((doc, " ".join(before) + "\n" * copy + " " + " ".join(passage) + " " + " ".join(prose(40))))
            planted.add(doc)
    rows += [(1000 + i, " ".join(prose(200))) for i in range(60)]
    rows += [(2000, None), (2001, ""), (None, "tiny text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("root", F.lit("clash"))
    found = passages.repeated_passages(df).collect()
    assert len({r.doc_id for r in found}) >= 0.97 * len(planted)
    assert {r.doc_id for r in found} <= planted
    texts = {d: (t or "").split() for d, t in rows}
    for r in found:
        own = texts[r.doc_id][r.start : r.start + r.n_words]
        # Paragraphs at the ends may hold a few words more: they are similar, not equal.
        assert len(set(own) & set(shared[r.doc_id // 10])) >= 0.7 * len(own)
        # A border word differs with the words around, so a later copy can be the first with some paragraph.
        assert not (r.removed and r.doc_id % 10 == 0)
    assert sum(r.n_words for r in found if r.removed) > 1.5 * sum(r.n_words for r in found if not r.removed)
    again = passages.repeated_passages(df, most=0).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))
    assert passages.repeated_passages(df.limit(0)).count() == 0


def test_near_copies_of_paragraphs_are_linked(spark):
    a = [f"w{i}" for i in range(9)]
    p = passages.Paragraphs([w.encode() for w in a])
    assert p.borders[0] == 0 and p.borders[-1] == 9
    assert passages.jaccard([b"a"] * 9, [b"a"] * 5) == 1.0
    assert passages.jaccard(*[[w.encode() for w in x] for x in (a, a[:-1])]) == 0.8


# --- language ------------------------------------------------------------------


def test_language_on_held_out_rows(spark):
    found = queries.QUERIES["op8_language"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_language_cases(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([
        ("the sea and the stone", "en"), ("der See und der Stein", "de"), ("the tree", "en"), ("und die", "de"),
        ("the end", None), (None, "en"), ("", None), ("12 !?", None), ("Ж", None), ("the and " * 300_000, None)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language.learn(df)
    assert profiles.languages == ["de", "en"]
    got = [r.f.lang for r in df.select(language.identify(F.col("text"), profiles).alias("f")).collect()]
    assert got[4] == "en" and got[5:8] == ["und"] * 3 and got[8] in ("de", "en") and got[9] == "en"
    nothing = language.learn(df.limit(0))
    assert nothing.nearest("the sea") == ("und", 0.0)
    keys, counts = language.grams("ab ab")
    assert dict(zip(keys.tolist(), counts.tolist()))[ord("a")] == 2


# --- chat ----------------------------------------------------------------------


def test_chat_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "\\\\", "####", "a: b", "<|endoftext|>", "", "é\n\n###", "\\:", "</turn"]
    rows = [(c, t, r, nasty[(c + t) % len(nasty)]) for c in range(9) for t, r in enumerate(["system", "user", "assistant", "assistant"])]
    rows += [(50, 0, None, None), (50, 1, "user: ### x\\", "q"), (50, 1, "user: ### x\\", "q"), (None, 0, "assistant", "lost"),
             (51, None, "assistant", "first"), (51, 0, "assistant", "second")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit("clash"))
    got = {r.id: r for r in chat.digest(chat.format_turns(df)).collect()}
    by_conv = defaultdict(list)
    for c, t, r, x in rows:
        by_conv[c].append((t is not None, t or 0, r or "", x or ""))
    assert set(got) == set(by_conv)
    for c, turns in by_conv.items():
        turns.sort()
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        learned = "".join(x for _, _, r, x in turns if r == "assistant")
        form = "".join("### " + chat.escape_role(r) + ": " + chat.escape(x) + "</turn>\n" for _, _, r, x in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert tuple(got[c])[1:] == (len(turns), sha(whole), len(learned), sha(learned), len(form)), c
    assert chat.digest(chat.format_turns(df.limit(0))).count() == 0


@pytest.mark.parametrize("text", ["\\### Assistant: </turn> ok", "\\\\###", "", "plain"])
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape(chat.escape_role(text)) == text
