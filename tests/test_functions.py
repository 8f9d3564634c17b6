import random

from pyspark.sql import functions as F

from heightline.functions import bigints, hexes, ids


def each(spark, values, sql, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    return [r.o for r in df.select("i", F.expr(sql("s")).alias("o")).orderBy("i").collect()]


def each_column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.o for r in df.select("i", fn(F.col("s")).alias("o")).orderBy("i").collect()]


def test_trim_0x(spark):
    values = [" 0XAbC ", "0x", "abc", "\t0x0x1\n", "", None, "0x " + "ff"]
    assert each(spark, values, hexes.trim_0x) == ["abc", "", "abc", "0x1", "", None, " ff"]


def test_hex_bytes(spark):
    values = ["0x0aFF", "abc", "zz", "", "0x", None, " ff ", "0X00", "0x f"]
    want = [b"\x0a\xff", None, None, None, None, None, b"\xff", b"\x00", None]
    got = each(spark, values, hexes.hex_bytes)
    assert [None if b is None else bytes(b) for b in got] == want


def test_clean_hex_of_long_text(spark):
    long = "AB" * 300_000
    assert each(spark, [f"0X{long}", long + "z"], hexes.clean_hex) == ["0x" + long.lower(), None]


def test_bytes_hex(spark):
    got = each(spark, [bytearray(b"\x00\xAB"), bytearray(), None], hexes.bytes_hex, "binary")
    assert got == ["0x00ab", None, None]


def test_fixed_width_values(spark):
    pad = lambda h: "0x" + h.rjust(64, "0")
    values = ["0xabc", "AB" * 40, None, "", "zz", "12zz", "1zz", "0X" + "F" * 64, "0xg"]
    want = [pad("abc"), pad("ab" * 32), pad(""), pad(""), pad(""), pad("12"), pad("01"),
            pad("f" * 64), pad("")]
    assert each(spark, values, hexes.hash32) == want
    assert each(spark, ["0x1", "ab" * 30], hexes.address20) == [
        "0x" + "1".rjust(40, "0"), "0x" + "ab" * 20]
    assert each(spark, ["0x12", "ff" * 9, None, "1", "zz"], hexes.nonce8) == [
        "0x1200000000000000", "0x" + "ff" * 8] + [hexes.ZERO_NONCE] * 3
    bloom = "Ab" * 256
    assert each(spark, [bloom, bloom + "00", "0x12", None], hexes.bloom256) == [
        "0x" + bloom.lower()] + [hexes.ZERO_BLOOM] * 3


def test_big_numbers_as_written(spark):
    values = ["10", "0x10", "ff", "abc", "0x", "", "  ", None, "-5", "+0005", "-0", "000", "1_0",
              " 0X0f ", "12.5", "0xzz", "0" * 40 + "7", "9" * 78]
    want = ["10", "16", "255", None, "0", None, None, None, "-5", "5", "0", "0", None,
            "15", None, None, "7", "9" * 78]
    assert each(spark, values, bigints.parse_big) == want


def test_wide_hex_is_exact(spark):
    rng = random.Random(7)
    digits = ["f" * 16, "1" + "0" * 15, "f" * 32, "0" * 30 + "ff", "1" + "0" * 63, "f" * 64]
    digits += [f"{rng.getrandbits(4 * n):0{n}x}" for n in range(2, 200, 6)]
    texts = ["0x" + d for d in digits]
    assert each(spark, texts, bigints.parse_big) == [str(int(d, 16)) for d in digits]


def test_big_decimal(spark):
    got = each(spark, ["9" * 38, "9" * 39, "-1", None], bigints.big_decimal)
    assert [None if g is None else int(g) for g in got] == [10**38 - 1, None, -1, None]


def test_uint64(spark):
    values = ["0", "18446744073709551615", "18446744073709551616", "-1", "x", "", " 7 ", "007",
              "0" * 30 + "1", "1.0", None]
    got = each_column(spark, values, ids.parse_uint64)
    assert [None if g is None else int(g) for g in got] == [
        0, 2**64 - 1, None, None, None, None, None, 7, 1, None, None]


def test_stream_ids(spark):
    values = ["123-0", "123", "-0", "abc-0", "1-2-3", "99999999999999999999-0", None]
    assert each_column(spark, values, ids.stream_id_millis) == [123, None, None, None, 1, None, None]


def test_scanned_at_and_latency(spark):
    assert each_column(spark, ["12", " 7 ", "", None, "x"], ids.scanned_at_millis) == [
        12, None, None, None, None]
    df = spark.createDataFrame([(5,), (20,), (None,)], "s long")
    got = [r[0] for r in df.select(ids.latency_millis(F.col("s"), 12)).collect()]
    assert got == [7, 0, None]


def test_hash_tag_and_keys(spark):
    values = ["{abc}:stream", "x{abc}y:stream", "stream:key", "{}:k", "{open", "a}b{c}", "x{}{d}"]
    assert each_column(spark, values, ids.hash_tag) == [
        "abc", "abc", "stream:key", "{}:k", "{open", "c", "x{}{d}"]
    made = each_column(spark, ["0x1"], lambda c: ids.scoped_key(F.lit("{b}:s"), "block", c))
    assert made == ["{b}:block:0x1"]
