"""Rendered mails: only what is read is made, and tasks do not grow with the input."""

from pyspark.sql import functions as F

from fixtures.render import render_emails
from tillroll.operators import extract
from tillroll.operators.model import _dealt
from tillroll.plans.rule import all_rules
from tillroll.session import SPREAD_ROWS, spread


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bodies_are_made_for_those_who_read_them(spark, sf):
    mails = render_emails(spark, sf)
    assert "</body></html>" in optimized(mails)
    assert "</body></html>" not in optimized(mails.select("message_id", "subject", "from_domain"))


def test_claims_are_decided_before_bodies_are_made(spark, sf):
    own = [r for r in all_rules() if r.provider == "gofood"]
    plan = optimized(extract.extract_transactions(render_emails(spark, sf), own)).split("\n")
    line = lambda *words: next(i for i, text in enumerate(plan) if all(w in text for w in words))
    assert line("</body></html>") < line("Filter", "size(") < line("Repartition")  # from the last step to the first


def test_large_inputs_are_dealt_over_more_tasks(spark):
    few = spark.range(10)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(few, 50 * SPREAD_ROWS).rdd.getNumPartitions() == 50


def test_training_rows_are_dealt_by_their_dense_size(spark):
    rows = spark.range(1000).select(F.col("id").alias("label"))
    assert _dealt(rows, 10).rdd.getNumPartitions() == rows.rdd.getNumPartitions()
    assert _dealt(rows, 1 << 20).rdd.getNumPartitions() == 63  # 8 GB
