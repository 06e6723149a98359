"""Fitted tables on disk: vocabularies, weights, labels, categories and scalers, saved and loaded with their kind.

An artefact is a folder with the table (``table``) and a description (``about``), which is written last: a folder without
it was never finished. The description holds the version of the form, the kind, the columns, the caller's parameters and
a fingerprint of the rows that does not depend on their order, so a table that was changed, cut short or mixed up is
refused when it is loaded.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = 1

#: Columns that a kind has at least. A scaler has one column for each that was scaled.
KINDS = {
    "vocabulary": "token string, idx int, tf bigint",
    "idf": "term string, tf bigint, df bigint, idf double",
    "labels": "label string, idx int",
    "categories": "col string, value string, n bigint, idx int",
    "scaler": None,
    "features": None,
    "classes": "label string, idx int",
}
_MOMENTS = "struct<mean:double,std:double>"


class Artefact(NamedTuple):
    kind: str
    table: DataFrame
    params: dict


def _columns(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema}


def _check(kind: str, columns: dict[str, str]) -> None:
    if kind not in KINDS:
        raise ValueError(f"unknown kind of artefact: {kind}")
    if kind == "scaler":
        wrong = [c for c, t in columns.items() if t != _MOMENTS]
    else:
        want = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(KINDS[kind] or "")}
        wrong = [c for c, t in want.items() if columns.get(c) != t]
    if wrong:
        raise ValueError(f"columns of {kind}: {wrong} among {columns}")


def fingerprint(df: DataFrame) -> str:
    """Number of rows and the sum of their digests: the same in any order, of any partitioning."""
    digest = F.xxhash64(*(F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in sorted(df.columns)))
    found = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(digest.cast("decimal(38,0)")), F.lit(0)).alias("sum")).first()
    return f"{found.n}:{int(found.sum)}"


def save(df: DataFrame, path: str, kind: str, **params) -> None:
    """Write a fitted table under ``path``; ``params`` are values that JSON can hold (a mode, a length, a name).

    What was there is replaced. NULLs and repeated rows are kept as they are; an empty table is one.
    """
    _check(kind, _columns(df))
    df.write.mode("overwrite").parquet(f"{path}/table")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/table")
    about = [(VERSION, kind, json.dumps(_columns(df)), json.dumps(params), fingerprint(written))]
    schema = "version int, kind string, columns string, params string, fingerprint string"
    df.sparkSession.createDataFrame(about, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def load(spark: SparkSession, path: str, kind: str, verify: bool = True) -> Artefact:
    """The artefact under ``path``. Another kind, version or columns than expected are an error, and so are rows that do
    not have the fingerprint they were saved with (``verify`` reads them for that)."""
    about = spark.read.parquet(f"{path}/about").first()
    if about.version != VERSION:
        raise ValueError(f"{path}: version {about.version} of the form, not {VERSION}")
    if about.kind != kind:
        raise ValueError(f"{path} is a {about.kind}, not a {kind}")
    columns = json.loads(about.columns)
    _check(kind, columns)
    schema = T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in columns.items()))
    table = spark.read.schema(schema).parquet(f"{path}/table")
    if verify and fingerprint(table) != about.fingerprint:
        raise ValueError(f"{path}: the table is not the one that was saved")
    return Artefact(about.kind, table, json.loads(about.params))
