from rillweave.operators.distinct import PRECISION, distinct_estimates, distinct_sketches


def test_united_sketches_stay_within_the_stated_error(spark, tmp_path):
    # Two sources and three days with overlapping values; sketches are written by day and united later.
    days = [
        spark.range(d * 20_000, d * 20_000 + 60_000).selectExpr(
            "if(id % 3 = 0, 'a', 'b') source_system", f"{d} day", "concat('e', id) email", "id % 7 grade", "cast(null as string) void"
        )
        for d in range(3)
    ]
    columns = ["email", "grade", "void"]
    for day in days:
        distinct_sketches(day, columns, ("source_system", "day")).write.mode("append").parquet(f"{tmp_path}/sketches")
    kept = spark.read.parquet(f"{tmp_path}/sketches")
    assert kept.count() == 6
    bound = 3 * 1.04 / 2 ** (PRECISION / 2)
    whole = distinct_estimates(kept, columns).first()
    assert abs(whole.email - 100_000) <= bound * 100_000 and (whole.grade, whole.void) == (7, 0)
    by_source = {r.source_system: r.email for r in distinct_estimates(kept, columns, ["source_system"]).collect()}
    assert abs(by_source["a"] - 33_334) <= bound * 33_334 and abs(by_source["b"] - 66_666) <= bound * 66_666


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "source_system string, email string")
    sketches = distinct_sketches(empty, ["email"])
    assert sketches.count() == 0
    assert distinct_estimates(sketches, ["email"]).first().email == 0
