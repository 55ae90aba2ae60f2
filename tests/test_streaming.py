"""The scoring chain runs unchanged on a streaming DataFrame."""

from pyspark.sql import functions as F

from attrition.plans import catalog
from attrition.plans.jobs import params_for
from attrition.plans.models import fit_base, prepare
from attrition.plans.ensemble import MLScoreModel
from attrition.plans.score import score_customers
from attrition.streaming.scoring import read_customer_stream, start_scoring
from conftest import SF0001


def test_stream_scoring_equals_batch(spark, tmp_path):
    p = params_for("class_weight")
    data = prepare(catalog.raw(spark, SF0001), p)
    model = MLScoreModel("lr", fit_base("logistic_regression", data.train_fit, p))
    src = str(tmp_path / "in")
    catalog.raw(spark, SF0001).repartition(3).write.parquet(src)
    q = start_scoring(read_customer_stream(spark, src), model, data.prep, str(tmp_path / "out"),
                      name=f"t{abs(hash(str(tmp_path)))}", trigger_once=True)
    q.awaitTermination(300)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = score_customers(spark.read.parquet(src), model, data.prep)
    assert streamed.count() == batch.count() == 150
    diff = streamed.join(batch.select("customer_id", F.col("churn_probability").alias("b")), "customer_id") \
        .where(F.col("churn_probability") != F.col("b")).count()
    assert diff == 0
