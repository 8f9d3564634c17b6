"""Documents of rare languages."""

import random

from heightline.llm import quality


def test_rare_languages_are_held_against_themselves_or_stay(spark):
    rng = random.Random(40)

    def texts(common, n, words):
        own = [rng.choice("bcdfgk") + rng.choice("aeiou") + f"{rng.choice('lmnr')}amen" for _ in range(60)]
        return [" ".join(rng.choice(common) if rng.random() < 0.33 else rng.choice(own) for _ in range(words)) for _ in range(n)]

    common = {"aa": ["the", "of", "and", "to"], "bb": ["uno", "dos", "el", "la"], "cc": ["ja", "nej", "og", "er"]}
    rows = [(t, "aa") for t in texts(common["aa"], 1200, 60)]
    # Under one document in a hundred: with enough words for a reference, and without.
    rows += [(t, "bb") for t in texts(common["bb"], 10, 300)] + [(t, "cc") for t in texts(common["cc"], 3, 60)]
    # Noise goes where there is a reference.
    rows += [("# $ % & " * 20 + " ".join(str(rng.random()) for _ in range(80)), lang) for lang in ("aa", "bb")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    assert [r.language for r in quality.references(df)] == ["aa", "bb"]
    left = {r.doc_id for r in quality.drop_low_quality(df).collect()}
    assert left == set(range(len(rows) - 2))


def test_many_small_languages_have_references(spark):
    rows = [(10 * i + k, f"w{i} the of sea and tree " * 60, f"l{i}") for i in range(102) for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(quality.references(df)) == 102
