"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Receipts are rendered once into a scratch folder first, so that the timings are those of the engine
and not of the fixture. Every query writes to a noop sink; the value is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import functions as F

from fixtures.render import render_emails
from suite import columns, features
from tillroll.operators import extract, route
from tillroll.operators.titles import weak_label
from tillroll.functions import text
from tillroll.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    spark = local_session(CPUS, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    mails = tempfile.mkdtemp(prefix="tillroll-bench-") + "/emails"
    t0 = time.perf_counter()
    render_emails(spark, SF_DIR).write.parquet(mails)
    rendered = time.perf_counter() - t0
    emails = spark.read.parquet(mails)
    n_mails = emails.count()

    def monthly():
        tx = extract.extract_transactions(emails)
        return (
            route.is_proper(tx)
            .where("proper")
            .groupBy("currency", F.year("date"), F.month("date"))
            .agg(F.sum("amount"), F.count("*"))
        )

    queries = {
        "match_providers": lambda: extract.match_providers(emails).select("message_id", "providers"),
        "extract_transactions": lambda: extract.extract_transactions(emails),
        "extract_monthly": monthly,
        "route": lambda: route.route(extract.gate(emails)),
        "dedup": lambda: route.dedup_transactions(extract.extract_transactions(emails)),
        "weak_label": lambda: weak_label(
            emails.select(
                "message_id", text.title_key(F.col("subject"), F.col("from_domain")).alias("title")
            )
        ),
    }
    shared = {
        **{n: columns.QUERIES[n] for n in ("tokenize", "parse_money", "parse_dates", "datetime_features")},
        **{
            n: features.QUERIES[n]
            for n in (
                "term_stats",
                "build_vocab",
                "text_to_sequence",
                "tfidf_count_log",
                "tfidf_smooth",
                "encode_category",
                "standard_scale",
                "class_weights",
                "split_stratified",
                "augment_synonyms",
            )
        },
    }
    queries.update({n: (lambda q=q: q(spark, SF_DIR)) for n, q in shared.items()})

    def once(build) -> float:
        t = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    times = {}
    for name, build in queries.items():
        once(build)  # warm-up
        times[name] = round(statistics.median(once(build) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": int(CPUS),
                "mails": n_mails,
                "mails_per_second": round(n_mails / times["extract_transactions"]),
                "render_seconds": round(rendered, 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
