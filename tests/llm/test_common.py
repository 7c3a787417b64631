from pyspark.sql import functions as F

from placeflow.llm import common


def test_samples_are_bounded_and_repeat(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"))
    drawn = lambda d, n: d.filter(common.least(d, "doc_id", n))
    one, two = ({r.doc_id for r in drawn(d, 500).collect()} for d in (df, df.repartition(9)))
    assert one == two and len(one) == 500
    twice = drawn(df.union(df), 500)
    assert twice.count() == 2 * twice.distinct().count() <= 1000 and {r.doc_id for r in twice.collect()} <= one
    assert drawn(df.limit(30), 500).count() == 30 and drawn(df.limit(0), 5).count() == 0


def test_commonest_match_a_full_sort(spark):
    df = spark.range(1, 3000).select(F.col("id").cast("string").alias("w"), (F.col("id") % 37 * F.col("id") % 11 + 1).cast("bigint").alias("n"))
    for k in (1, 10, 500, 5000):
        want = [r.w for r in df.orderBy(F.desc("n"), "w").limit(k).collect()]
        assert [r.w for r in common.commonest(df, "w", k).collect()] == want
    assert common.commonest(df.limit(0), "w", 3).count() == 0


def test_missing_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id int, extra string")
    got = common.columns(df, "doc_id", "text")
    assert got.dtypes == [("doc_id", "bigint"), ("text", "string")] and got.first().text is None


def test_written_tables_are_read_back(spark):
    df = spark.range(5).withColumn("a", F.array(F.col("id")))
    assert common.written(df).exceptAll(df).isEmpty() and common.checkpointed(df).count() == 5


def test_tables_that_nothing_reads_go(spark):
    df = common.written(spark.range(5))
    files = df.inputFiles()
    assert files
    common.discarded(df)
    assert not spark.sparkContext._jvm.java.io.File(files[0].replace("file://", "").replace("file:", "")).exists()
