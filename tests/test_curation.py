from pyspark.sql import functions as F

from sieveyard.operators import curation as C


def test_prompt_variants_stay_together(spark):
    rows = spark.createDataFrame([(f"hash-{i // 2}", f"prompt-{i % 2}", i) for i in range(24)], "content_hash string, prompt string, seq int")
    for compat in (None, "mt"):
        out = C.split_by_hash(rows, "content_hash", "seq", 0.25, 0.25, 7, compat)
        report = C.integrity_report(out, "content_hash").first().asDict(True)
        assert report["leakage_count"] == 0 and report["duplicate_hashes_across_splits"] == {}
        assert {k: (v["examples"], v["unique_hashes"]) for k, v in report["split_statistics"].items()} == {"test": (6, 3), "validation": (6, 3), "train": (12, 6)}
        assert out.groupBy("content_hash").agg(F.countDistinct("split").alias("s"), F.count("*").alias("n")).filter("s <> 1 or n <> 2").count() == 0
    members = {s: {r.content_hash for r in out.filter(F.col("split") == s).collect()} for s in C.SPLITS}
    assert members["test"] == {"hash-5", "hash-9", "hash-11"} and members["validation"] == {"hash-8", "hash-6", "hash-2"}


def test_rows_without_hash_are_groups_of_their_own(spark):
    rows = spark.createDataFrame([(None, i) if i % 2 else ("", i) for i in range(20)], "content_hash string, seq int")
    out = C.split_by_hash(rows, "content_hash", "seq", 0.25, 0.25)
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"test": 5, "validation": 5, "train": 10}
    assert C.split_statistics(out, "content_hash").agg(F.sum("unique_hashes")).first()[0] == 0


def test_global_rank_is_the_sorted_place(spark):
    rows = spark.range(5000).withColumn("h", F.sha2(F.col("id").cast("string"), 256))
    got = C.global_rank(rows, "h", ["id"]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))
    assert [r.h for r in got] == sorted(r.h for r in got)


def test_cut_truncates_doubles(spark):
    out = C.split_rows(spark.range(200).withColumnRenamed("id", "k"), "k", 0.0, 0.29, 1)
    assert out.filter("split = 'test'").count() == int(200 * 0.29) == 57


def test_keep_first_and_leaks(spark):
    rows = spark.createDataFrame([("a", "p", 3, "x"), ("a", "p", 1, "y"), ("a", "q", 2, "x"), (None, "p", 5, "x"), (None, "p", 4, "y"), ("b", "p", 0, "x")], "h string, p string, seq int, split string")
    kept = C.keep_first(rows, ["h", "p"], ["seq"])
    assert sorted(r.seq for r in kept.collect()) == [0, 1, 2, 4]
    assert [(r.content_hash, r.places) for r in C.leaking_hashes(rows, "h").collect()] == [("a", ["x", "y"])]


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "h string, p string, seq int")
    out = C.split_by_hash(rows, "h", "seq")
    assert out.count() == 0 and C.integrity_report(out, "h").first().leakage_count == 0


def test_union_keeps_order_and_head(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "v int"), spark.createDataFrame([(3,)], "v int")
    out = C.union_sources([("train", "s1", a), ("train", "s2", b), ("test", "s1", a)])
    assert [(r.split, r.model_ready_source, r.v) for r in C.head(out, 4, ["part", "v"]).collect()] == [("train", "s1", 1), ("train", "s1", 2), ("train", "s2", 3), ("test", "s1", 1)]
