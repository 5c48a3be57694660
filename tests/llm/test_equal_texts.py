"""Two texts made to collide in Spark's 64-bit hash of a text are not taken for equal."""

from pyspark.sql import functions as F

from basketry.llm import substring_dedup

P1, P2, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
MASK = 2**64 - 1


def turned(x, bits):
    return (x << bits | x >> (64 - bits)) & MASK


def of_word(k):
    return turned(k * P2 & MASK, 31) * P1 & MASK


def collision(first, second, other):
    """The second word with which `other` begins a text of the same hash as `first` and `second`."""
    after = [(turned((42 + P5 + 16) & MASK ^ of_word(k), 27) * P1 + P4) & MASK for k in (first, other)]
    wanted = after[0] ^ of_word(second) ^ after[1]
    return turned(wanted * pow(P1, -1, 2**64) & MASK, 33) * pow(P2, -1, 2**64) & MASK


def test_a_collision_is_no_equal_text(spark):
    words = [int.from_bytes(w, "little") for w in (b"one text", b" or more", b"other te")]
    texts = [b"".join(w.to_bytes(8, "little") for w in pair) for pair in (words[:2], (words[2], collision(*words)))]
    rows = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate([*texts, b"equal", b"equal"])], "doc_id long, bytes binary")
    rows = rows.withColumn("text", F.col("bytes").cast("string")).withColumn("print", F.xxhash64("text"))
    assert rows.select("print").distinct().count() == 2
    assert {r["doc_id"] for r in substring_dedup._roles(rows).select("doc_id").collect()} == {2, 3}
