"""Explicit schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

S, B = T.StringType(), T.BooleanType()
MONEY = T.DecimalType(18, 2)
NTZ = T.TimestampNTZType()


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in cols.items()])


BINARY_FILES = _schema(
    path=S, modificationTime=T.TimestampType(), length=T.LongType(), content=T.BinaryType()
)

EMAILS = _schema(
    message_id=S, subject=S, from_header=S, from_addr=S, from_domain=S, body_html=S, body_text=S
)

TRANSACTIONS = _schema(
    message_id=S,
    provider=S,
    variant=S,
    trx_id=S,
    date=NTZ,
    merchant=S,
    amount=MONEY,
    fees=MONEY,
    currency=S,
    payment_method=S,
    is_incoming=B,
    description=S,
)

# Why a mail, or a row of it, could not be used.
FAULT = _schema(stage=S, error=S, detail=S)

TITLES = _schema(title=S, is_transaction=B)

LABELLED_TX = _schema(
    tx_id=T.LongType(),
    datetime=NTZ,
    merchant=S,
    notes=S,
    amount=T.DoubleType(),
    payment_method=S,
    transaction_type=S,
    sub_category=S,
    category=S,
)

# The closed set of spending categories.
CATEGORIES = (
    "FOOD",
    "HEALTH",
    "DRINKS",
    "HOUSEHOLD",
    "TRANSPORTATION",
    "GROCERIES",
    "FAMILY",
    "SUBSCRIPTION",
    "APPAREL",
    "EDUCATION",
    "ENTERTAINMENT",
    "UTILITIES",
    "BEAUTY",
    "OTHER",
)
