from pyspark.sql import functions as F

from sensorium.llm import common as C
from sensorium.streaming.batchlog import exists


def test_written_tables_are_released_but_for_those_still_read(spark):
    before = spark.conf.get(C._BATCH_ROWS)
    a = C.materialise(spark.range(5), "a")
    b = C.materialise(a.select((F.col("id") + 1).alias("id")), "b")
    path_a, path_b = C.written(spark)[-2:]
    assert spark.conf.get(C._BATCH_ROWS) == before
    C.release(spark, [path_a, path_b], keep=b)
    assert not exists(spark, path_a) and exists(spark, path_b)
    assert sorted(r.id for r in b.collect()) == [1, 2, 3, 4, 5]
    C.release(spark, [path_b])
    assert not exists(spark, path_b) and path_b not in C.written(spark)


def test_checked_broadcast(spark):
    df = spark.range(10)
    small, hinted = C.broadcast_checked(df, 10)
    assert hinted and "broadcast" in small._jdf.queryExecution().logical().toString()
    large, hinted = C.broadcast_checked(df, 9)
    assert not hinted and large is df


def test_words(spark):
    df = spark.createDataFrame([(None,), ("",), (" a\tb\n\x0b\x0c\rc ",), ("é ü x",)], "t string")
    assert [r[0] for r in df.select(C.words(F.col("t"))).collect()] == [[], [], ["a", "b", "c"], ["é ü", "x"]]


def test_whole_row_with_odd_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, `_id` int, `x``y` int")
    back = df.select(C.whole_row(df).alias("row")).select("row.*")
    assert back.columns == df.columns and tuple(back.first()) == (1, 2, 3)
