"""SQL for what the rendered receipts must yield, computed from the order tables alone."""

from __future__ import annotations

# layout -> (provider, variant, precision of the date, fee shown, incoming)
_LAYOUTS = [
    ("mybca", "receipt", "s", 1, 0),
    ("bri", "ewallet", "s", 1, 0),
    ("bri", "briva", "m", 1, 0),
    ("bri", "bpjs", "s", 1, 0),
    ("bri", "qris", "s", 1, 0),
    ("bri", "electricity", "m", 1, 0),
    ("bri", "credit", "s", 1, 0),
    ("bri", "transfer", "s", 1, 0),
    ("epic", "receipt", "d", 0, 0),
    ("gofood", "receipt", "g", 0, 0),
    ("google_play", "receipt", "s", 0, 0),
    ("grab", "car", "d", 0, 0),
    ("grabfood", "receipt", "y", 0, 0),
    ("gotagihan", "receipt", "m", 0, 0),
    ("itemku", "receipt", "s", 0, 0),
    ("jago", "receipt", "m", 0, 0),
    ("livin", "transfer", "s", 0, 0),
    ("livin", "topup", "s", 0, 0),
    ("livin", "payment", "s", 0, 0),
    ("mobapay", "receipt", "s", 0, 0),
    ("ocbc", "transfer", "s", 0, 1),
    ("ocbc", "qr_en", "d", 1, 0),
    ("ocbc", "qr_id", "d", 1, 0),
    ("ocbc", "funds", "s", 0, 0),
    ("ocbc", "topup", "s", 0, 0),
    ("ovo", "receipt", "y", 1, 0),
    ("paypal", "sent", "d", 0, 0),
    ("paypal", "payment", "d", 0, 0),
    ("paypal", "received", "d", 0, 1),
    ("seabank", "instant", "m", 0, 0),
    ("seabank", "transfer", "m", 0, 0),
    ("steam", "receipt", "m", 0, 0),
    ("tokopedia", "receipt", "m", 0, 0),
    ("unipin", "receipt", "m", 0, 0),
    ("xsolla", "receipt", "d", 1, 0),
]
_VALUES = ", ".join(
    f"({i}, '{p}', '{v}', '{d}', {f}, {inc})" for i, (p, v, d, f, inc) in enumerate(_LAYOUTS)
)

_NAMED_REGION = (
    "CASE r_name WHEN 'MIDDLE EAST' THEN 'Middle East' "
    "ELSE upper(left(r_name, 1)) || lower(substr(r_name, 2)) END"
)

BASE = f"""
layouts(vi, provider, variant, prec, has_fee, inc) AS (VALUES {_VALUES}),
base AS (
  SELECT o_orderkey AS k, o_orderkey % 35 AS vi, CAST(floor(o_totalprice) AS BIGINT) AS amt,
    (o_orderkey % 5) * 500 AS fee,
    o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS ts,
    upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS seg,
    upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' ' || {_NAMED_REGION} AS merchant,
    lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS id, lpad(CAST(o_orderkey AS VARCHAR), 17, '0') AS id17
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
msgs AS (
  SELECT *, CAST(k AS VARCHAR) AS message_id FROM base
  UNION ALL SELECT *, CAST(k AS VARCHAR) || '-2' AS message_id FROM base WHERE k % 19 = 0)
"""

_TRX_ID = """CASE
  WHEN vi = 0 THEN 'C' || id
  WHEN vi = 6 THEN substr(id, 1, 4) || ' ' || substr(id, 5, 4) || ' ' || substr(id, 9, 4)
  WHEN vi = 8 THEN 'A' || id
  WHEN vi = 9 THEN 'F-' || k
  WHEN vi = 10 THEN 'GPA.' || substr(id17, 1, 4) || '-' || substr(id17, 5, 4) || '-'
    || substr(id17, 9, 4) || '-' || substr(id17, 13, 5)
  WHEN vi = 11 THEN 'A-' || id
  WHEN vi = 12 THEN 'IN-' || id
  WHEN vi = 13 THEN id || '-GOBILLS'
  WHEN vi = 14 THEN 'TR' || id
  WHEN vi = 15 THEN strftime(ts, '%Y%m%d%H%M')
  WHEN vi = 19 THEN 'MP' || id
  WHEN vi = 20 THEN '-'
  WHEN vi IN (21, 22, 23, 24) THEN 'MB' || id
  WHEN vi = 25 THEN 'r' || id
  WHEN vi IN (26, 27, 28) THEN 'PP' || id
  WHEN vi = 32 THEN 'INV/' || k || '/MPL'
  WHEN vi = 33 THEN 'U' || id
  ELSE id END"""

_DATE = """CASE prec
  WHEN 's' THEN date_trunc('second', ts)
  WHEN 'm' THEN date_trunc('minute', ts)
  WHEN 'd' THEN date_trunc('day', ts)
  WHEN 'g' THEN CASE WHEN k % 2 = 0 THEN date_trunc('day', ts) ELSE date_trunc('minute', ts) END
  ELSE date_trunc('minute', ts) + CASE WHEN year(ts) < 2000 THEN INTERVAL 100 YEAR ELSE INTERVAL 0 YEAR END
  END"""

_MERCHANT = """CASE
  WHEN vi = 1 THEN CASE k % 4 WHEN 0 THEN 'ShopeePay' WHEN 1 THEN 'DANA' WHEN 2 THEN 'GoPay' ELSE 'OVO' END
  WHEN vi = 3 THEN 'BPJS Kesehatan'
  WHEN vi = 5 THEN 'PT. PLN INDONESIA'
  WHEN vi = 11 THEN 'Grab'
  WHEN vi = 14 THEN 'Itemku'
  WHEN vi = 19 THEN 'Mobapay'
  WHEN vi = 23 THEN 'Penerima Uang ' || merchant
  WHEN vi = 30 THEN 'JAGO ' || merchant || ' ' || k
  WHEN vi = 31 THEN 'Steam'
  WHEN vi = 33 THEN 'UniPin'
  WHEN vi = 34 THEN merchant || ' Inc.'
  ELSE merchant END"""

_CURRENCY = """CASE
  WHEN vi IN (10, 12, 13, 14, 15, 16, 17, 18, 26, 27, 28, 31, 32) AND k % 17 = 0 THEN NULL
  WHEN vi = 13 THEN 'Rp'
  WHEN vi IN (26, 27, 28) THEN 'USD'
  ELSE 'IDR' END"""

_METHOD = """CASE
  WHEN vi = 0 THEN 'myBCA'
  WHEN vi = 2 THEN 'BRIVA'
  WHEN vi IN (4, 5) THEN 'BRI'
  WHEN vi IN (1, 3, 6, 7) THEN 'BRImo'
  WHEN vi = 8 THEN 'GOPAY'
  WHEN vi = 9 THEN CASE WHEN k % 3 = 0 THEN 'GoPay + Cash' ELSE 'GoPay' END
  WHEN vi = 10 THEN 'ShopeePay'
  WHEN vi = 11 THEN 'OVO'
  WHEN vi = 12 THEN 'Cash'
  WHEN vi IN (13, 32) THEN 'GoPay'
  WHEN vi IN (14, 19, 33) THEN 'QRIS'
  WHEN vi = 15 THEN 'Jago'
  WHEN vi IN (16, 17, 18) THEN 'Livin'' by Mandiri'
  WHEN vi = 20 THEN 'BANK SATU'
  WHEN vi = 23 THEN 'TANDA'
  WHEN vi IN (21, 22, 24) THEN 'OCBC'
  WHEN vi = 25 THEN 'OVO Cash'
  WHEN vi IN (26, 27, 28) THEN 'Paypal'
  WHEN vi IN (29, 30) THEN 'SeaBank'
  WHEN vi = 31 THEN 'Visa'
  ELSE 'Xsolla' END"""

_DESCRIPTION = """CASE
  WHEN vi IN (0, 26) THEN 'Order ' || k
  WHEN vi = 1 THEN 'Top-up e-wallet'
  WHEN vi = 2 THEN 'BRIVA Payment'
  WHEN vi = 3 THEN 'Pembayaran BPJS'
  WHEN vi = 4 THEN 'Pembelian QRIS ' || merchant
  WHEN vi = 5 THEN 'R1/900 VA'
  WHEN vi = 6 THEN 'Pulsa 50'
  WHEN vi = 7 THEN 'Transfer BI-FAST'
  WHEN vi = 8 THEN CASE WHEN k % 17 = 0 THEN NULL ELSE 'Star Quest ' || merchant END
  WHEN vi = 11 THEN 'GrabCar Trip'
  WHEN vi = 12 THEN 'GrabFood Order'
  WHEN vi = 14 THEN 'Akun game ' || k
  WHEN vi IN (16, 17, 18, 23, 24) THEN '-'
  WHEN vi IN (19, 33) THEN 'Gems ' || k
  WHEN vi = 20 THEN 'Transfer BI-Fast'
  WHEN vi = 21 THEN 'QR Payment Merchant PAN 9360001430019008'
  WHEN vi = 22 THEN 'Pembayaran QR PAN Merchant 9360001430019008'
  WHEN vi = 25 THEN 'OVO'
  WHEN vi = 29 THEN 'Note of ' || seg
  WHEN vi = 30 THEN 'Rent and food'
  WHEN vi = 32 THEN 'Tokopedia'
  WHEN vi = 34 THEN 'Coins ' || k
  ELSE '' END"""

# One row per claimed mail, in the library's column names; the date is text for an exact compare.
EXPECTED = f"""{BASE},
tx AS (
  SELECT message_id, k, vi, provider, variant, {_TRX_ID} AS trx_id,
    {_DATE} AS ts_out, {_MERCHANT} AS merchant,
    CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(amt AS DOUBLE) END AS amount,
    CAST(CASE WHEN has_fee = 1 THEN fee ELSE 0 END AS DOUBLE) AS fees,
    {_CURRENCY} AS currency, {_METHOD} AS payment_method, inc = 1 AS is_incoming,
    {_DESCRIPTION} AS description
  FROM msgs JOIN layouts USING (vi)
  WHERE k % 23 <> 0 OR vi = 13)
"""

TX_COLUMNS = """message_id, provider, variant, trx_id, strftime(ts_out, '%Y-%m-%d %H:%M:%S') AS date,
  merchant, amount, fees, currency, payment_method, is_incoming, description"""


def with_expected(select: str) -> str:
    return f"WITH {EXPECTED} {select}"


def with_base(select: str) -> str:
    return f"WITH {BASE} {select}"
