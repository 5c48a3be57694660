"""Restaurants reach the parts of the model in few rows, with the same values."""

from pyspark.sql import functions as F

from basketry.llm import language_model


def test_many_restaurants_travel_in_one_row(spark):
    rows = spark.range(6_000, numPartitions=2).select(
        (F.col("id") % 3).alias("part"), (-1 - F.col("id")).alias("context"), (1 / (F.col("id") + 5)).alias("scale"), F.array(F.col("id") / 2, F.col("id") / 3).alias("back")
    )
    packed = language_model._packed(rows)
    assert packed.count() == 6
    each = packed.select("part", F.explode(F.arrays_zip("context", "own", F.expr("transform(sequence(0, size(context) - 1), i -> slice(parent, 2 * i + 1, 2))").alias("back"))).alias("x"))
    each = each.select("part", "x.context", F.col("x.own").alias("scale"), "x.back")
    wanted = rows.withColumn("scale", F.col("scale").cast("float"))
    assert each.exceptAll(wanted).isEmpty() and wanted.exceptAll(each).isEmpty()
    assert language_model._packed(rows.limit(0)).isEmpty()


def test_the_score_sends_each_part_few_rows_of_restaurants(spark, monkeypatch):
    sent, repartition = [], type(spark.range(0)).repartition

    def seen(frame, *how):
        if "kind" in frame.columns:
            sent.append(frame.where("kind = 0").count())
        return repartition(frame, *how)

    monkeypatch.setattr(type(spark.range(0)), "repartition", seen)
    table = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k * k) % 900}" for k in range(40))) for i in range(300)], "doc_id long, text string")
    assert language_model.score(table).count() == 300
    assert sent and sent[0] <= 8 * 8
