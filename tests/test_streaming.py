from pyspark.sql import functions as F

from lociframe.streaming import incremental


def test_finished_work_is_skipped(spark, tmp_path):
    path, calls = str(tmp_path / "results"), []

    def compute(todo):
        calls.append(todo.count())
        return todo.withColumn("beta", F.lit(len(calls)))

    work = spark.createDataFrame([("21", 0, 50), ("21", 1, 50), ("X", 0, 7)], incremental.WORK_SCHEMA)
    incremental.run_pending(spark, work, path, compute)
    incremental.run_pending(spark, work, path, compute)
    more = work.unionByName(spark.createDataFrame([("22", 0, 50)], incremental.WORK_SCHEMA))
    assert [tuple(r) for r in incremental.run_pending(spark, more, path, compute).collect()] == [("22", 0, 50)]
    assert calls == [3, 1]
    assert sorted(r.beta for r in spark.read.parquet(path).collect()) == [1, 1, 1, 2]


def test_uncommitted_and_empty_work(spark, tmp_path):
    path, asked = str(tmp_path / "results"), []
    work = spark.createDataFrame([("21", 0, 50), ("21", 1, 50)], incremental.WORK_SCHEMA)

    def compute(todo):
        asked.append(todo.count())
        return todo.filter("batch_index = 0").withColumn("beta", F.lit(len(asked)))  # batch 1 has too few cases

    # A run that was ended after it wrote files and before it logged them.
    incremental.write_results(work.withColumn("beta", F.lit(-1)), path)
    assert incremental.stored_work(spark, path).count() == 2 and incremental.finished_work(spark, path).count() == 0
    assert incremental.run_pending(spark, work.filter("batch_index = 0"), path, compute, "min=100").count() == 1
    assert sorted(r.beta for r in spark.read.parquet(path).collect()) == [-1, 1]
    fresh = str(tmp_path / "fresh")
    assert incremental.run_pending(spark, work, fresh, compute, "min=100").count() == 2
    assert incremental.run_pending(spark, work, fresh, compute, "min=100").count() == 0  # not tried again
    assert [r.batch_index for r in incremental.run_pending(spark, work, fresh, compute, "min=5").collect()] == [1]
    assert asked == [1, 2, 1]


def test_arriving_files_are_taken_in_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def run():
        incremental.ingest_new_files(spark, source, spark.range(1).schema, state, sink).awaitTermination()
        return spark.read.parquet(out).count()

    spark.range(5).write.mode("append").parquet(source)
    assert run() == 5 and run() == 5
    spark.range(3).write.mode("append").parquet(source)
    assert run() == 8
