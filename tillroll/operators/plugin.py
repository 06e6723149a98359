"""Extractors written in Python: functions of Arrow batches, or table functions called for every mail."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import FAULT

#: Takes mails (``subject``, ``from_addr``, ``body``), gives a list of rows for each: an Arrow list array of structs, or
#: what makes one (``None`` or ``[]``: nothing found).
Extractor = Callable[[pa.RecordBatch], object]

_REGISTERED: dict[tuple[SparkSession, str], tuple[Extractor, T.StructType]] = {}


def register_extractor(spark: SparkSession, name: str, extractor, returns: T.StructType | str | None = None) -> None:
    """Register an extractor of the caller's own under a name.

    With ``returns``, the fields of a row, it is a function of a batch of mails. Without, it is a UDTF
    ``(subject, from_addr, body) -> transaction fields``, called for every mail.
    """
    if returns is None:
        _REGISTERED.pop((spark, name), None)
        spark.udtf.register(name, extractor)
    else:
        fields = T.StructType.fromDDL(returns) if isinstance(returns, str) else returns
        _REGISTERED[spark, name] = extractor, fields


def extract_batches(
    emails: DataFrame, extractor: Extractor, returns: T.StructType, body: str = "body_text", keep: Sequence[str] = ()
) -> DataFrame:
    """``(message_id, *keep, rows, fault)``: what the extractor finds in each mail, or why it failed.

    A narrow job over Arrow batches. A batch that raises, or gives no list for each of its mails, is halved until the
    mail that is at fault stands alone: that one gets a fault of stage ``plugin`` with the class of the error, all others
    their rows. After a call that went well the next one takes twice as many mails. One bad mail among n costs some log n
    calls, and where one in k is bad each mail is read some few times, however large the batch, as long as the extractor
    keeps nothing between calls.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = pa.list_(to_arrow_type(returns))
    fault_kind = to_arrow_type(FAULT)
    kept = [c for c in dict.fromkeys(("message_id", *keep))]

    def read(mails: pa.RecordBatch) -> pa.Array:
        found = extractor(mails)
        found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
        found = found.cast(kind) if isinstance(found, pa.Array) else pa.array(list(found), kind)
        if len(found) != mails.num_rows:
            raise ValueError(f"{len(found)} lists for {mails.num_rows} mails")
        return found

    def safe(mails: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[dict | None]]]:
        at, size = 0, mails.num_rows
        while at < mails.num_rows:
            some = mails.slice(at, size)
            try:
                found, faults = read(some), [None] * some.num_rows
            except Exception as e:
                if some.num_rows > 1:
                    size = some.num_rows // 2
                    continue
                found, faults = pa.array([None], kind), [{"stage": "plugin", "error": type(e).__name__, "detail": str(e)}]
            yield found, faults
            at, size = at + some.num_rows, 2 * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            mails = pa.RecordBatch.from_arrays([batch.column(c) for c in ("_subject", "_from", "_body")], names=["subject", "from_addr", "body"])
            parts = list(safe(mails))
            rows = pa.concat_arrays([p[0] for p in parts])
            faults = pa.array([f for p in parts for f in p[1]], fault_kind)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), rows, faults], names=[*kept, "rows", "fault"])

    schema = T.StructType([*(emails.schema[c] for c in kept), T.StructField("rows", T.ArrayType(returns)), T.StructField("fault", FAULT)])
    columns = {"_subject": "subject", "_from": "from_addr", "_body": body}
    return emails.select(*kept, *(F.col(c).alias(n) for n, c in columns.items())).mapInArrow(run, schema)


def outcomes_with(emails: DataFrame, name: str, body: str = "body_text", keep: Sequence[str] = ()) -> DataFrame:
    """``(message_id, *keep, rows, fault)`` of a registered batch extractor; ``outcome.quarantine`` reads the faults."""
    extractor, returns = _REGISTERED[emails.sparkSession, name]
    return extract_batches(emails, extractor, returns, body, keep)


def extract_with(emails: DataFrame, name: str, body: str = "body_text") -> DataFrame:
    """``message_id`` with the rows the registered extractor yields for each mail. Mails at which a batch extractor
    fails have none; see :func:`outcomes_with` for them."""
    if (emails.sparkSession, name) in _REGISTERED:
        return outcomes_with(emails, name, body).select("message_id", F.inline("rows"))
    return emails.sparkSession.sql(
        f"SELECT e.message_id, t.* FROM {{emails}} e, LATERAL {name}(e.subject, e.from_addr, e.{body}) t",
        emails=emails,
    )
