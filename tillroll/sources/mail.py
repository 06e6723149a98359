"""Mail files as DataFrames.

MIME is parsed by the standard library inside Arrow-batched functions. Headers come first and are
cheap; bodies are parsed only for the mails that are left after the header filter, and the raw bytes
never travel back from Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.text import bind, extract_domain, parse_addr
from tillroll.operators.extract import match_providers
from tillroll.operators.outcome import fault
from tillroll.plans.rule import Rule
from tillroll.schemas import BINARY_FILES, EMAILS, FAULT

_FAULTS = [FAULT["error"], FAULT["detail"]]
_HEAD = T.StructType([EMAILS["subject"], EMAILS["from_header"], *_FAULTS])
_BODY = T.StructType([EMAILS["body_html"], EMAILS["body_text"], *_FAULTS])
_NO_SUBJECT = "Unknown Subject"
_NO_SENDER = "Unknown Sender <unknown@unknown.com>"

# The functions that run on the executors are made inside others: those travel with the task, so executors need no copy
# of this package.


@lru_cache(maxsize=1)
def _heads():
    no_subject, no_sender = _NO_SUBJECT, _NO_SENDER

    def read(raw: bytes | None) -> tuple[str, str, str | None, str | None]:
        import email
        import email.policy

        if not raw:
            return no_subject, no_sender, "EmptyMessage", None
        try:
            m = email.message_from_bytes(raw)
            if not m.keys():
                return no_subject, no_sender, "NoHeaders", None
            found = [m.get("subject"), m.get("from")]
            if any(not isinstance(v, str) or not v.isascii() or "=?" in v for v in found if v is not None):
                # encoded words: the full header parser, some ten times slower
                m = email.message_from_bytes(raw, policy=email.policy.default)
                found = [m.get("subject"), m.get("from")]
            subject, sender = ("".join(str(v).splitlines()) if v is not None else None for v in found)
            return no_subject if subject is None else subject, no_sender if sender is None else sender, None, None
        except Exception as e:  # a broken message must not stop the others
            return no_subject, no_sender, type(e).__name__, str(e)

    def heads(content):
        return pd.DataFrame([read(c) for c in content], columns=["subject", "from_header", "error", "detail"])

    heads.__annotations__ = {"content": pd.Series, "return": pd.DataFrame}
    # nondeterministic, so that the filter on the result does not run the function twice
    return F.pandas_udf(heads, _HEAD).asNondeterministic()


@lru_cache(maxsize=1)
def _bodies():
    import re

    kinds = re.compile(r"text/(html|plain)(?:; ?charset=(?:([A-Za-z0-9._-]+)|\"([A-Za-z0-9._-]+)\"))?")
    codings = (None, "7bit", "8bit", "binary", "quoted-printable", "base64")

    def plain(raw: bytes) -> tuple[str | None, str | None, str | None, str | None] | None:
        """A mail that is one text with plainly written headers, without the full header parser, which takes some twenty
        times as long; None for any other mail."""
        import email

        m = email.message_from_bytes(raw)
        kind, coding = m.get_all("content-type", []), m.get_all("content-transfer-encoding", [None])
        if m.is_multipart() or len(kind) != 1 or len(coding) != 1 or "content-disposition" in m or coding[0] not in codings:
            return None
        found = kinds.fullmatch(kind[0]) if isinstance(kind[0], str) else None
        if found is None:
            return None
        content = m.get_payload(decode=True).decode(found[2] or found[3] or "ASCII", errors="replace")
        return (content, None, None, None) if found[1] == "html" else (None, content, None, None)

    def full(raw: bytes) -> tuple[str | None, str | None, str | None, str | None]:
        import email
        import email.policy

        m = email.message_from_bytes(raw, policy=email.policy.default)
        part = m.get_body()
        if part is None:
            return None, None, "NoBody", m.get_content_type()
        content = str(part.get_content())
        return (content, None, None, None) if part.get_content_subtype() == "html" else (None, content, None, None)

    def read(raw: bytes | None) -> tuple[str | None, str | None, str | None, str | None]:
        try:
            return plain(raw or b"") or full(raw or b"")
        except Exception as e:
            return None, None, type(e).__name__, str(e)

    def bodies(content):
        return pd.DataFrame([read(c) for c in content], columns=["body_html", "body_text", "error", "detail"])

    bodies.__annotations__ = {"content": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(bodies, _BODY)


def header_block(content: Column) -> Column:
    """A message up to its first empty line, or all of it where there is none: bodies do not go to Python for this."""

    def end(text: Column) -> Column:
        breaks = (F.nullif(F.locate(mark, text), F.lit(0)) for mark in ("\r\n\r\n", "\n\n"))
        return F.coalesce(F.least(*breaks) + 3, F.length(text))

    # one character per byte
    return F.substring(content, F.lit(1), bind(F.decode(content, "ISO-8859-1"), end))


def decode_raw(c: Column) -> Column:
    """URL-safe base64, as mail services hand messages out, to bytes."""
    missing = F.pmod(-F.length(c), F.lit(4)).cast("int")
    return bind(
        F.translate(c, "-_", "+/"), lambda t: F.unbase64(F.concat(t, F.repeat(F.lit("="), missing)))
    )


def parse_messages(
    raw: DataFrame,
    id: str = "message_id",
    content: str = "content",
    claimed_only: bool = False,
    rules: Sequence[Rule] | None = None,
    keep: Sequence[str] = (),
    faults: bool = False,
) -> DataFrame:
    """Raw messages to the EMAILS columns; ``claimed_only`` drops mails no rule is for unparsed.

    With ``faults`` a column ``fault`` says why a message could not be read: its stage (``headers`` or ``body``), the
    error (``EmptyMessage``, ``NoHeaders``, ``NoBody`` or the class of an exception) and its detail. Messages with a
    fault in their headers then stay, as no rule could be asked about them. Without it they are mails without a body.
    """
    headed = raw.select(F.col(id).alias("message_id"), content, *keep, _heads()(header_block(F.col(content))).alias("_h")).select(
        "message_id",
        content,
        *keep,
        F.col("_h.subject").alias("subject"),
        F.col("_h.from_header").alias("from_header"),
        parse_addr(F.col("_h.from_header")).alias("from_addr"),
        extract_domain(F.col("_h.from_header")).alias("from_domain"),
        F.when(F.col("_h.error").isNotNull(), fault("headers", F.col("_h.error"), F.col("_h.detail"))).alias("_f"),
    )
    if claimed_only:
        wanted = F.size("providers") > 0
        headed = match_providers(headed, rules).where(wanted | F.col("_f").isNotNull() if faults else wanted).drop("providers")
    of_body = F.when(F.col("_b.error").isNotNull(), fault("body", F.col("_b.error"), F.col("_b.detail")))
    return headed.withColumn("_b", _bodies()(F.col(content))).select(
        "message_id",
        "subject",
        "from_header",
        "from_addr",
        "from_domain",
        F.col("_b.body_html").alias("body_html"),
        F.col("_b.body_text").alias("body_text"),
        *keep,
        *([F.coalesce("_f", of_body).alias("fault")] if faults else []),
    )


def _from_files(files: DataFrame, **options) -> DataFrame:
    named = files.withColumn("message_id", F.regexp_extract("path", r"([^/]+?)(?:\.eml)?$", 1))
    return parse_messages(named, **options)


def scan_eml(
    spark: SparkSession, path: str, claimed_only: bool = False, rules: Sequence[Rule] | None = None, faults: bool = False
) -> DataFrame:
    """All ``.eml`` files under a folder, or one file. The message id is the file name."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.eml")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )
    return _from_files(files, claimed_only=claimed_only, rules=rules, faults=faults)


def stream_eml(spark: SparkSession, path: str, files_per_trigger: int = 500) -> DataFrame:
    """The same as a stream, with ``ingest_ts`` = the file's modification time."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILES)
        .option("pathGlobFilter", "*.eml")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
        .select("path", "content", F.col("modificationTime").alias("ingest_ts"))
    )
    return _from_files(files, claimed_only=True, keep=("ingest_ts",))


def stream_emails(spark: SparkSession, path: str, files_per_trigger: int = 500) -> DataFrame:
    """A folder of EMAILS Parquet files as a stream, with ``ingest_ts``."""
    return (
        spark.readStream.schema(EMAILS)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
        .withColumn("ingest_ts", F.col("_metadata.file_modification_time"))
    )


def take_messages(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` messages, as a run with a message limit reads: those of the smallest hashes of their id."""
    return df.orderBy(F.xxhash64("message_id"), "message_id").limit(n)
