from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tests.conftest import mail
from tillroll.streaming.ingest import fullest, fullest_stream, stream_extract

WHOLE = (
    "<p>Transaction Date : 3 Nov 2024 17:52:19</p><p>Beneficiary Name : Shop</p>"
    "<p>Target Amount : IDR 1,000.00</p><p>Remarks : -</p><p>Reference No. : X{key}</p>"
)
POOR = WHOLE.replace("Target Amount", "Something")
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def receipts(spark, *rows):
    """Mails from (id, key, body)."""
    return mail(spark, *((m, "Internet Transaction Journal", "bca@bca.co.id", body.format(key=key), None) for m, key, body in rows))


def files(folder, ending):
    return [p for p in (folder / "state").rglob(f"*{ending}") if not p.name.startswith(".")]


def run(spark, root, *rows):
    receipts(spark, *rows).coalesce(1).write.mode("append").parquet(str(root / "in"))
    known = dict(sink=str(root / "out"), checkpoint=str(root / "ck"), keep="fullest")
    stream_extract(spark, str(root / "in"), **known).awaitTermination()
    return sorted(r.message_id for r in spark.read.parquet(known["sink"]).collect())


def test_state_of_the_fullest_is_on_disk_and_settings_stay(spark, tmp_path):
    """In the executors' heaps it ran out of memory."""
    assert spark.conf.get(PROVIDER, None) is None
    assert run(spark, tmp_path, ("m2", 1, POOR), ("m3", 2, WHOLE)) == ["m2", "m3"]
    assert files(tmp_path / "ck", ".zip") and not files(tmp_path / "ck", ".delta")
    assert spark.conf.get(PROVIDER, None) is None
    # what is in the state is known after a restart: a fuller copy is written, a poorer one and a larger id are not
    assert run(spark, tmp_path, ("m1", 2, POOR), ("m4", 1, WHOLE), ("m5", 2, WHOLE)) == ["m2", "m3", "m4"]
    assert sorted(r.message_id for r in fullest(spark, str(tmp_path / "out")).collect()) == ["m3", "m4"]


def test_a_begun_stream_keeps_its_store_and_a_caller_may_choose_it(spark, tmp_path):
    in_memory = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(PROVIDER, in_memory)
    try:
        run(spark, tmp_path, ("m2", 1, POOR))
        assert files(tmp_path / "ck", ".delta") and spark.conf.get(PROVIDER) == in_memory
    finally:
        spark.conf.unset(PROVIDER)
    assert run(spark, tmp_path, ("m1", 1, WHOLE), ("m3", 1, WHOLE)) == ["m1", "m2"]
    assert not files(tmp_path / "ck", ".zip")


def test_a_copy_is_remembered_for_the_delay_wherever_its_window_begins(spark):
    """Every copy has one window that decides; one that comes within the delay after a better one is not shown."""
    start, day = datetime(2026, 1, 1, tzinfo=timezone.utc), timedelta(days=1)
    at = {(f"a{n:03}", n, WHOLE): n for n in range(0, 130, 3)} | {(f"b{n:03}", n, POOR): n + 29.9 for n in range(0, 130, 3)}
    at |= {(f"c{n:03}", n + 1000, POOR): n for n in range(0, 130, 3)} | {(f"d{n:03}", n + 1000, WHOLE): n + 400 for n in range(0, 130, 3)}
    when = spark.createDataFrame([(row[0], start + day * days) for row, days in at.items()], "message_id string, ingest_ts timestamp")
    found = fullest_stream(receipts(spark, *at).join(when, "message_id"))
    got = [r.message_id for r in found.collect()]
    assert sorted(got) == sorted(m for m, _, _ in at if m[0] != "b")


def test_a_copy_seldom_counts_twice(spark):
    """Over time three windows in two copies; it was two in one."""
    start = datetime(2026, 1, 1, tzinfo=timezone.utc)
    rows = [(f"m{n}", n, POOR) for n in range(120)]
    when = spark.createDataFrame([(f"m{n}", start + timedelta(days=n)) for n in range(120)], "message_id string, ingest_ts timestamp")
    state = fullest_stream(receipts(spark, *rows).join(when, "message_id"))._jdf.queryExecution().analyzed()
    while state.nodeName() != "Aggregate":
        state = state.children().apply(0)
    from pyspark.sql import classic

    known = classic.dataframe.DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, state), spark)
    assert known.agg(F.count("*").alias("n")).first().n == 180
