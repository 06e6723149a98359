"""Incremental extraction: new mail files in, new transactions out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.operators.extract import parse_receipts
from tillroll.operators.route import PLACEHOLDER_IDS, dedup_transactions
from tillroll.plans.rule import Rule, all_rules
from tillroll.schemas import TRANSACTIONS
from tillroll.sources.mail import stream_emails, stream_eml


def dedup_key(rules: Sequence[Rule]):
    """The transaction id, or a digest of the content where the id does not identify."""
    weak_rules = [f"{r.provider}.{r.variant}" for r in rules if r.weak_id]
    weak = F.col("trx_id").isNull() | F.col("trx_id").isin(*PLACEHOLDER_IDS)
    if weak_rules:
        weak = weak | F.concat_ws(".", "provider", "variant").isin(*weak_rules)
    content = F.concat_ws("\u0001", "trx_id", "date", "amount", "merchant", "description")
    return F.when(weak, F.concat(F.lit("#"), F.sha2(content, 256))).otherwise(F.col("trx_id"))


def extract_stream(emails: DataFrame, rules: Sequence[Rule] | None = None, delay: str = "30 days") -> DataFrame:
    """Transactions of a mail stream that carries ``ingest_ts``, each once.

    The watermark runs on arrival time: a receipt's own date would make an old mailbox late. State is
    one row per key of the last ``delay``.
    """
    rules = tuple(rules or all_rules())
    return (
        parse_receipts(emails, rules, keep=("ingest_ts",), outer=False)
        .withColumn("dedup_key", dedup_key(rules))
        .withWatermark("ingest_ts", delay)
        .dropDuplicatesWithinWatermark(["provider", "dedup_key"])
    )


#: Fields whose absence makes a copy less complete, as in ``dedup_transactions``.
_WANTED = ("trx_id", "date", "merchant", "amount", "currency")


def fullest_stream(emails: DataFrame, rules: Sequence[Rule] | None = None, delay: str = "30 days") -> DataFrame:
    """Transactions of a mail stream that carries ``ingest_ts``: the first copy of each, and any later one that is more
    complete, or as complete with a smaller message id. To be written in update mode.

    The state of a key is its best copy, remembered for at least ``delay`` after a copy arrived. So the sink holds the fullest
    copy whatever the order of arrival, and few others; :func:`fullest` reads it. Windows of three times the delay begin every
    second delay; the one that reaches back from a copy's arrival for a delay says whether it is the best. Every second delay
    copies count in two windows, else in one: longer windows hold their copies longer, shorter ones hold more of them twice.

    State has as many rows as there are keys: have it kept on disk, as :func:`stream_extract` does.
    """
    rules = tuple(rules or all_rules())
    lacks = sum((F.col(c).isNull().cast("int") for c in _WANTED), F.lit(0))
    found = parse_receipts(emails, rules, keep=("ingest_ts",), outer=False)
    # the time of the batch tells copies that arrive now from those in the state
    found = found.withColumns({"dedup_key": dedup_key(rules), "lacks": lacks, "seen": F.current_timestamp()}).withWatermark("ingest_ts", delay)
    names = TRANSACTIONS.fieldNames()
    length = found.sparkSession.sql(f"SELECT unix_micros(to_timestamp('1970-01-01T00:00:00Z') + INTERVAL {delay})").first()[0]
    back = F.window("ingest_ts", f"{3 * length} microseconds", f"{2 * length} microseconds")
    rest = [c for c in names if c != "message_id"]
    best = F.min(F.struct("lacks", "message_id", "seen", F.col("ingest_ts").cast("timestamp").alias("arrived"), *rest))
    known = found.groupBy("provider", "dedup_key", back.alias("back")).agg(best.alias("best"))
    late = F.unix_micros("best.arrived") - F.unix_micros("back.start") >= length
    return known.where((F.col("best.seen") == F.current_timestamp()) & late).select(*(F.col(f"best.{c}").alias(c) for c in names))


#: The state of the fullest copies is on the executors' disks, with bounded memory; it would outgrow their heaps. Counting its
#: rows would look up each a second time.
_STORE = "spark.sql.streaming.stateStore."
_ON_DISK = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """For queries started within; what the caller has set stays, and a begun stream goes on with the store it began with."""
    own = {k: v for k, v in _ON_DISK.items() if spark.conf.get(k, None) is None}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in own:
            spark.conf.unset(k)


def fullest(spark: SparkSession, sink: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The most complete copy of each transaction that a stream with ``keep="fullest"`` has written."""
    return dedup_transactions(spark.read.parquet(sink), rules=rules)


def stream_extract(
    spark: SparkSession,
    path: str,
    rules: Sequence[Rule] | None = None,
    *,
    checkpoint: str,
    sink: str,
    fmt: str = "parquet",
    files_per_trigger: int = 500,
    delay: str = "30 days",
    keep: str = "first",
) -> StreamingQuery:
    """Read what is new under ``path``, extract it, append it to the Parquet folder ``sink``, stop.

    ``keep`` says which copy of a transaction is kept: the ``first`` to arrive, one row each, or the ``fullest``, which
    :func:`fullest` reads from the sink as ``dedup_transactions`` would choose it. For the latter a batch that is done again
    after a failure may append its rows again, which :func:`fullest` reads through, and state is kept on disk.

    ``fmt`` is ``parquet`` (EMAILS files) or ``eml``. Each stream has a ``checkpoint`` folder of its own; run
    again with the same one to go on.
    """
    read = {"parquet": stream_emails, "eml": stream_eml}[fmt]
    kept = {"first": extract_stream, "fullest": fullest_stream}[keep]
    found = kept(read(spark, path, files_per_trigger), rules, delay).select(*TRANSACTIONS.fieldNames())
    stream = found.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if keep == "fullest":
        with _state_on_disk(spark):
            return stream.foreachBatch(lambda batch, _: batch.write.mode("append").parquet(sink)).outputMode("update").start()
    return stream.format("parquet").option("path", sink).outputMode("append").start()
