from pyspark.sql import functions as F

from patchloom.operators import rules
from patchloom.streaming import incremental


def test_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(20).selectExpr("id", "id % 5 AS n").repartition(3).write.parquet(source)
    ruled = [(rules.REJ, "rejected_zero", F.col("n") == 0), (rules.MAN, "manual_review_even", F.col("n") % 2 == 0)]
    stream = spark.readStream.schema("id long, n long").parquet(source)
    query = incremental.write_by_status(incremental.classify(stream, ruled), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(60)
    got = {(r.id, r.status, tuple(r.reason_codes)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.id, r.status, tuple(r.reason_codes)) for r in rules.apply_rules(spark.read.parquet(source), ruled).collect()}
    assert got == want and len(got) == 20
