import hashlib

from echowire.functions.texts import combine_text, content_hash, normalize_text


def test_normalized_forms(spark):
    rows = [
        ("Hello, World!", "hello world"),
        ("A  b", "a b"),
        (None, ""),
        ("Привет 世界", ""),
        ("Straße", "stra e"),
        (" x Y\x1c", "x y"),
        ("--", ""),
        ("naïve 3.14", "na ve 3 14"),
    ]
    df = spark.createDataFrame(rows, "t string, e string")
    for row in df.select("t", "e", normalize_text("t").alias("n")).collect():
        assert row.n == row.e, row.t


def test_hash_joins_headline_and_text(spark):
    rows = [
        ("Hello, World!", "A  b", "hello world|||a b"),
        (None, None, "|||"),
        ("Привет", "世界", "|||"),
        ("a", "", "a|||"),
        ("", "a", "|||a"),
    ]
    df = spark.createDataFrame(rows, "h string, t string, joined string")
    for row in df.withColumn("hash", content_hash("h", "t")).collect():
        assert row["hash"] == hashlib.sha256(row.joined.encode()).hexdigest()


def test_combined_text(spark):
    rows = [
        (" H ", "T\n", "H. T"), ("H", None, "H"), (None, "　T", "T"), ("", " ", ""), (None, None, ""),
    ]
    df = spark.createDataFrame(rows, "h string, t string, e string")
    for row in df.withColumn("c", combine_text("h", "t")).collect():
        assert row.c == row.e
