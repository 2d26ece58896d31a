"""Incremental crawls: only new files are opened, and the table is there at every moment."""

from pyspark.sql import functions as F

from sparklake.session import scratch_path
from sparklake.sources import catalog as cat


def test_second_crawl_opens_only_new_files(spark):
    root = scratch_path(spark, "crawl_test")
    db = cat.create_layers(spark, root, layers=("x",), prefix="crawl" + root[-6:] + "_")[0]
    path, log = f"{root}/data", f"{root}/log"
    rows = lambda a, b, **more: spark.range(a, b).select("id", *[F.lit(v).alias(k) for k, v in more.items()])
    try:
        rows(0, 10, day="2024-01-01", part="a'b/c").coalesce(1).write.partitionBy("day", "part").parquet(path)
        assert cat.crawl(spark, db, "t", path, log) == {"files": 1, "folders": 1, "full": True}
        assert cat.crawl(spark, db, "t", path, log) == {"files": 0, "folders": 0, "full": False}
        seen = spark.read.parquet(log).first()
        assert seen["length"] > 0 and seen["file"].startswith(seen["folder"])
        rows(10, 15, day="2024-01-02", part="d'e:f", extra="new").coalesce(1).write.mode("append").partitionBy("day", "part").parquet(path)
        opened = []
        merge, cat._merge_folders = cat._merge_folders, lambda *a: opened.append(a[5]) or merge(*a)
        try:
            assert cat.crawl(spark, db, "t", path, log) == {"files": 1, "folders": 1, "full": False}
        finally:
            cat._merge_folders = merge
        assert len(opened[0]) == 1 and "2024-01-02" in opened[0][0]
        got = {(r["day"], r["part"], r["extra"], r["count"]) for r in spark.table(f"{db}.t").groupBy(
            F.col("day").cast("string").alias("day"), "part", "extra").count().collect()}
        assert got == {("2024-01-01", "a'b/c", None, 10), ("2024-01-02", "d'e:f", "new", 5)}
        # a part without a value
        rows(15, 16, day="2024-01-03", part=None).withColumn("part", F.lit(None).cast("string")).coalesce(1).write.mode(
            "append").partitionBy("day", "part").parquet(path)
        assert not cat.crawl(spark, db, "t", path, log)["full"] and spark.table(f"{db}.t").count() == 16
        # a column that changed its type makes it a full crawl
        spark.sql("SELECT 'text' AS id, 'p' AS part, '2024-01-04' AS day").coalesce(1).write.mode("append").partitionBy("day", "part").parquet(f"{root}/other")
        assert cat.crawl(spark, db, "u", f"{root}/other", f"{root}/log_u")["full"]
        spark.range(3).withColumns({"day": F.lit("2024-01-05"), "part": F.lit("p")}).write.mode("overwrite").partitionBy("day", "part").parquet(f"{root}/other")
        assert cat.crawl(spark, db, "u", f"{root}/other", f"{root}/log_u")["full"]
        assert spark.table(f"{db}.u").count() == 3
    finally:
        cat.drop_layers(spark, [db])
