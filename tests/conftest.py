import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, app="tests", memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def emails(spark, sf, tmp_path_factory):
    from fixtures.render import render_emails

    path = str(tmp_path_factory.mktemp("mails") / "emails")
    render_emails(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def mail(spark, *rows):
    """EMAILS rows from (id, subject, from, html, text)."""
    from pyspark.sql import functions as F

    from tillroll.functions.text import extract_domain, parse_addr

    raw = spark.createDataFrame(
        [tuple(r) for r in rows],
        "message_id string, subject string, from_header string, body_html string, body_text string",
    )
    return raw.select(
        "message_id",
        "subject",
        "from_header",
        parse_addr(F.col("from_header")).alias("from_addr"),
        extract_domain(F.col("from_header")).alias("from_domain"),
        "body_html",
        "body_text",
    )
