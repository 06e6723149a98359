"""Queries over receipts rendered from the order tables: match, extract, route, de-duplicate."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from fixtures.render import render_emails
from suite.expected import TX_COLUMNS, with_base, with_expected
from tillroll.functions import html, text
from tillroll.operators import extract, outcome, plugin, route
from tillroll.operators.titles import label_batches, score_titles, train_title_model, weak_label
from tillroll.plans import rule
from tillroll.plans.rule import all_rules
from tillroll.schemas import TRANSACTIONS
from tillroll.session import checkpoint_root
from tillroll.sources import mail, tables
from tillroll.streaming.ingest import fullest, stream_extract

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        name = fn.__name__
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def shown(tx: DataFrame) -> DataFrame:
    """Transactions with plain types, so that engines can be compared."""
    return tx.withColumns(
        {
            "date": F.date_format("date", "yyyy-MM-dd HH:mm:ss"),
            "amount": F.col("amount").cast("double"),
            "fees": F.col("fees").cast("double"),
        }
    )


@query(with_expected("""
SELECT currency, CAST(year(ts_out) AS INTEGER) AS year, CAST(month(ts_out) AS INTEGER) AS month,
  sum(amount) AS total, count(*) AS n
FROM tx WHERE amount IS NOT NULL GROUP BY ALL"""))
def receipts_monthly(spark, sf):
    tx = extract.extract_transactions(render_emails(spark, sf))
    return (
        route.is_proper(tx)
        .where("proper")
        .groupBy("currency", F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(F.sum("amount").cast("double").alias("total"), F.count("*").alias("n"))
    )


@query(with_expected(f"SELECT {TX_COLUMNS} FROM tx"))
def extract_transactions(spark, sf):
    return shown(extract.extract_transactions(render_emails(spark, sf)))


def _one_provider(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rules = [r for r in all_rules() if r.provider == name]
        return shown(extract.extract_transactions(render_emails(spark, sf), rules))

    return run


for _p in dict.fromkeys(r.provider for r in all_rules()):
    QUERIES[f"extract_{_p}"] = _one_provider(_p)
    ORACLES[f"extract_{_p}"] = with_expected(f"SELECT {TX_COLUMNS} FROM tx WHERE provider = '{_p}'")


@query(with_expected("""
SELECT provider, variant, count(*) AS n, count(amount) AS with_amount, sum(fees) AS fees
FROM tx GROUP BY ALL"""))
def variant_dispatch(spark, sf):
    return (
        extract.extract_transactions(render_emails(spark, sf))
        .groupBy("provider", "variant")
        .agg(
            F.count("*").alias("n"),
            F.count("amount").alias("with_amount"),
            F.sum("fees").cast("double").alias("fees"),
        )
    )


_CLAIMS = """CASE WHEN k % 23 = 0 AND vi <> 13 THEN '' WHEN vi IN (11, 12) THEN 'grab+grabfood'
  ELSE provider END"""


@query(with_base(f"SELECT message_id, {_CLAIMS} AS claims FROM msgs JOIN layouts USING (vi)"))
def match_providers(spark, sf):
    found = extract.match_providers(render_emails(spark, sf))
    return found.select("message_id", F.array_join(F.array_sort("providers"), "+").alias("claims"))


@query(with_base(f"""
SELECT claims, n_providers, count(*) AS n FROM (
  SELECT CASE WHEN c = '' THEN 0 WHEN c LIKE '%+%' THEN 2 ELSE 1 END AS n_providers, c AS claims
  FROM (SELECT {_CLAIMS} AS c FROM msgs JOIN layouts USING (vi)))
GROUP BY ALL"""))
def fan_out(spark, sf):
    slots = extract.parse_receipts(render_emails(spark, sf))
    return (
        slots.groupBy("message_id", "n_providers")
        .agg(F.array_join(F.array_sort(F.collect_list("provider")), "+").alias("claims"))
        .groupBy("claims", "n_providers")
        .agg(F.count("*").alias("n"))
    )


def _scores(emails: DataFrame) -> DataFrame:
    """A stand-in for title scores: the message number's last digit over ten."""
    number = F.regexp_extract("message_id", "^([0-9]+)", 1).cast("bigint")
    return emails.select("message_id", ((number % 10) / 10).alias("score"))


@query(with_base("""
SELECT message_id FROM msgs WHERE k % 23 <> 0 OR vi = 13 OR (k % 10) / 10.0 > 0.5"""))
def gate(spark, sf):
    emails = render_emails(spark, sf)
    return extract.gate(emails, _scores(emails), 0.5).select("message_id")


@query(with_expected("""
SELECT provider, variant, amount IS NOT NULL AS proper, count(*) AS n FROM tx GROUP BY ALL"""))
def is_proper(spark, sf):
    tx = extract.extract_transactions(render_emails(spark, sf))
    return route.is_proper(tx).groupBy("provider", "variant", "proper").agg(F.count("*").alias("n"))


@query(ORACLES["gate"])
def gate_inline(spark, sf):
    """The score on the mails themselves: a filter, no join."""
    emails = render_emails(spark, sf)
    number = F.regexp_extract("message_id", "^([0-9]+)", 1).cast("bigint")
    return extract.gate(emails.withColumn("score", (number % 10) / 10), threshold=0.5).select("message_id")


_SENDERS = {
    "bca.co.id": "0", "bri.co.id": "1, 2, 3, 4, 5, 6, 7", "accts.epicgames.com": "8",
    "invoicing.gojek.com": "9", "google.com": "10", "grab.com": "11, 12",
    "gotagihan.gojek.com": "13", "itemku.com": "14", "jago.com": "15",
    "bankmandiri.co.id": "16, 17, 18", "mail.mobapay.com": "19", "ocbc.id": "20, 21, 22, 23, 24",
    "ovo.co.id": "25", "intl.paypal.com": "26, 27, 28", "seabank.co.id": "29, 30",
    "steampowered.com": "31", "tokopedia.com": "32", "unipin.com": "33", "xsolla.com": "34",
}
_DOMAIN = "CASE " + " ".join(f"WHEN vi IN ({v}) THEN '{d}'" for d, v in _SENDERS.items()) + " END"


@query(with_base(f"""
SELECT message_id, {_DOMAIN} AS from_domain,
  CASE WHEN k % 23 = 0 AND vi <> 13 THEN 'unparsed' WHEN k % 17 = 0 THEN 'improper' ELSE 'proper' END
    AS status,
  CAST(CASE WHEN k % 23 = 0 AND vi <> 13 THEN 0 ELSE 1 END AS BIGINT) AS n_rows,
  CAST(CASE WHEN (k % 23 = 0 AND vi <> 13) OR k % 17 = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_proper
FROM msgs WHERE k % 23 <> 0 OR vi = 13 OR (k % 10) / 10.0 > 0.5"""))
def route_messages(spark, sf):
    emails = render_emails(spark, sf)
    number = F.regexp_extract("message_id", "^([0-9]+)", 1).cast("bigint")
    return route.route(extract.gate(emails.withColumn("score", (number % 10) / 10), threshold=0.5))


@query(with_base(f"""
SELECT message_id, {_DOMAIN} AS from_domain FROM msgs
WHERE (k % 23 <> 0 OR vi = 13 OR (k % 10) / 10.0 > 0.5)
  AND ((k % 23 = 0 AND vi <> 13) OR k % 17 = 0)"""))
def unparsed_messages(spark, sf):
    emails = render_emails(spark, sf)
    gated = extract.gate(emails, _scores(emails), 0.5)
    return route.unparsed(gated).select("message_id", "from_domain")


@query(with_expected(f"""
SELECT {TX_COLUMNS} FROM tx WHERE message_id NOT LIKE '%-2'"""))
def dedup_transactions(spark, sf):
    return shown(route.dedup_transactions(extract.extract_transactions(render_emails(spark, sf))))


@query(with_expected("""
SELECT strftime(ts_out, '%Y-%m-%d %H:%M:%S') AS "Datetime", merchant AS "Merchant Name",
  CAST(NULL AS VARCHAR) AS "Sub Category", CAST(NULL AS VARCHAR) AS "Category",
  amount AS "Amount", currency AS "Currency",
  CASE WHEN is_incoming THEN 'INCOME' ELSE 'EXPENSE' END AS "Transaction Type",
  payment_method AS "Payment Method", trx_id AS "Transaction ID", description AS "Notes"
FROM tx WHERE amount IS NOT NULL"""))
def format_report(spark, sf):
    tx = extract.extract_transactions(render_emails(spark, sf))
    report = route.format_report(route.is_proper(tx).where("proper"))
    return report.withColumns(
        {
            "Datetime": F.date_format("Datetime", "yyyy-MM-dd HH:mm:ss"),
            "Amount": F.col("Amount").cast("double"),
        }
    )


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


@query(with_expected("""
SELECT provider, "Currency" AS currency, count(*) AS n, sum(amount) AS total
FROM (SELECT provider, currency AS "Currency", amount FROM tx WHERE amount IS NOT NULL)
GROUP BY ALL"""))
def report_files(spark, sf):
    """The report written as CSV and read back; the provider is found again by the payment method."""
    tx = extract.extract_transactions(render_emails(spark, sf))
    path = _scratch(spark, "report")
    # stored, so that the mails are not read again for the providers
    route.is_proper(tx).where("proper").write.parquet(path + "/proper")
    proper = spark.read.parquet(path + "/proper")
    tables.write_report(proper.drop("proper"), path + "/csv")
    back = spark.read.option("header", True).option("escape", '"').csv(path + "/csv")
    named = proper.select(
        F.concat_ws("|", text.to_ascii(F.col("trx_id")), "payment_method").alias("_key"), "provider"
    ).distinct()
    return (
        back.withColumn("_key", F.concat_ws("|", "Transaction ID", "Payment Method"))
        .join(named, "_key")
        .groupBy("provider", F.col("Currency").alias("currency"))
        .agg(F.count("*").alias("n"), F.sum(F.col("Amount").cast("double")).alias("total"))
    )


@query(with_base(f"""
SELECT message_id, subject || ' from:' || dom AS title, dom AS from_domain, addr AS from_addr FROM (
  SELECT message_id, {_DOMAIN} AS dom,
    CASE WHEN k % 2 = 0 THEN 'Notifier' ELSE '' END AS shown_name,
    CASE WHEN vi = 0 THEN 'bca@bca.co.id' WHEN vi BETWEEN 1 AND 7 THEN 'BankBRI@bri.co.id'
      WHEN vi = 8 THEN 'help@accts.epicgames.com' WHEN vi = 9 THEN 'no-reply@invoicing.gojek.com'
      WHEN vi = 10 THEN 'googleplay-noreply@google.com' WHEN vi IN (11, 12) THEN 'no-reply@grab.com'
      WHEN vi = 13 THEN 'receipts@gotagihan.gojek.com' WHEN vi = 14 THEN 'no-reply@itemku.com'
      WHEN vi = 15 THEN 'noreply@jago.com' WHEN vi BETWEEN 16 AND 18 THEN 'noreply.livin@bankmandiri.co.id'
      WHEN vi = 19 THEN 'mobapay@mail.mobapay.com' WHEN vi = 20 THEN 'notifikasi@ocbc.id'
      WHEN vi BETWEEN 21 AND 24 THEN 'onlinetransaction@ocbc.id' WHEN vi = 25 THEN 'noreply@ovo.co.id'
      WHEN vi BETWEEN 26 AND 28 THEN 'service@intl.paypal.com'
      WHEN vi IN (29, 30) THEN 'alerts@seabank.co.id' WHEN vi = 31 THEN 'noreply@steampowered.com'
      WHEN vi = 32 THEN 'noreply@tokopedia.com' WHEN vi = 33 THEN 'do_not_reply@unipin.com'
      ELSE 'mailer@xsolla.com' END AS addr,
    CASE WHEN k % 23 = 0 THEN 'Weekly newsletter'
      WHEN vi = 0 THEN 'Internet Transaction Journal' WHEN vi = 1 THEN 'Top Up'
      WHEN vi IN (2, 3, 5) THEN 'Pembayaran' WHEN vi IN (4, 6) THEN 'Pembelian' WHEN vi = 7 THEN 'Pemindahan'
      WHEN vi = 8 THEN 'Your Epic Games Receipt A' || id WHEN vi = 9 THEN 'Your food order with Gojek'
      WHEN vi = 10 THEN 'Your Google Play Order Receipt' WHEN vi IN (11, 12) THEN 'Your Grab E-Receipt'
      WHEN vi = 13 THEN 'Tagihan lunas' WHEN vi = 14 THEN 'Pembayaran pesanan ' || k || ' telah kami terima'
      WHEN vi = 15 THEN 'Kamu telah membayar ' || merchant WHEN vi = 16 THEN 'Transfer Berhasil'
      WHEN vi = 17 THEN 'Top-up Berhasil' WHEN vi = 18 THEN 'Pembayaran Berhasil'
      WHEN vi = 19 THEN 'Payment Successful' WHEN vi = 20 THEN 'Notifikasi Transfer Dana Masuk'
      WHEN vi = 21 THEN 'Successful QR Payment ' || id WHEN vi = 22 THEN 'Pembayaran QR Berhasil ' || id
      WHEN vi = 23 THEN 'Successful Funds Transfer ' || id WHEN vi = 24 THEN 'Successful Payment ' || id
      WHEN vi = 25 THEN 'OVO QR Payment Receipt' WHEN vi = 26 THEN 'You sent a payment'
      WHEN vi = 27 THEN 'Receipt for your payment to ' || merchant
      WHEN vi = 28 THEN 'You''ve received a payment' WHEN vi = 29 THEN 'Notifikasi Transaksi SeaBank'
      WHEN vi = 30 THEN 'Notifikasi Transfer SeaBank' WHEN vi = 31 THEN 'Thank you for your Steam purchase!'
      WHEN vi = 32 THEN 'Checkout Pesanan dengan GoPay'
      WHEN vi = 33 THEN 'UniPin :: Success Flash Top Up Transaction'
      ELSE 'Your receipt No. ' || id END AS subject
  FROM msgs)"""))
def headers(spark, sf):
    """Header lookup, address and domain of the sender, and the classifier's key."""
    mails = render_emails(spark, sf).select(
        "message_id",
        F.array(
            F.struct(F.lit("Received").alias("name"), F.lit("x").alias("value")),
            F.struct(F.lit("Subject").alias("name"), F.col("subject").alias("value")),
            F.struct(F.lit("From").alias("name"), F.col("from_header").alias("value")),
            F.struct(F.lit("Subject").alias("name"), F.lit("second").alias("value")),
        ).alias("headers"),
    )
    read = mails.select(
        "message_id",
        text.header_value(F.col("headers"), "Subject").alias("subject"),
        text.header_value(F.col("headers"), "From").alias("sender"),
    )
    domain = text.extract_domain(F.col("sender"))
    return read.select(
        "message_id",
        text.title_key(F.col("subject"), domain).alias("title"),
        domain.alias("from_domain"),
        text.parse_addr(F.col("sender")).alias("from_addr"),
    )


def _raw_messages(spark: SparkSession, sf: str) -> DataFrame:
    """RFC-822 messages in URL-safe base64, as a mail service hands them out."""
    mails = render_emails(spark, sf)
    raw = F.concat(
        F.lit("Subject: "), F.col("subject"), F.lit("\r\nFrom: "), F.col("from_header"),
        F.lit("\r\nMIME-Version: 1.0\r\nContent-Type: text/html; charset=utf-8\r\n"
              "Content-Transfer-Encoding: 8bit\r\n\r\n"),
        F.col("body_html"),
    )
    coded = F.rtrim(F.translate(F.base64(F.encode(raw, "UTF-8")), "+/\r\n", "-_"), F.lit("="))
    return mails.select("message_id", coded.alias("raw"))


@query(with_expected(f"SELECT {TX_COLUMNS} FROM tx"))
def parse_messages(spark, sf):
    raw = _raw_messages(spark, sf).select("message_id", mail.decode_raw(F.col("raw")).alias("content"))
    return shown(extract.extract_transactions(mail.parse_messages(raw, claimed_only=True)))


#: What is broken, by the order number: stage, how the error is named, its detail.
_BROKEN = [
    ("headers", "EmptyMessage", None),
    ("headers", "NoHeaders", None),
    ("body", "LookupError", "unknown encoding: x-none"),
    ("body", "NoBody", "application/pdf"),
]
_WAYS = ", ".join(f"({i}, '{stage}', '{error}', {'NULL' if detail is None else repr(detail)})" for i, (stage, error, detail) in enumerate(_BROKEN))


def _with_broken(spark: SparkSession, sf: str) -> DataFrame:
    """Raw messages of which every 29th is broken in one of some ways."""
    k = F.regexp_extract("message_id", "^([0-9]+)", 1).cast("bigint")
    raw = _raw_messages(spark, sf).select("message_id", mail.decode_raw(F.col("raw")).alias("content"), (k % 29 == 0).alias("bad"), (k % 4).alias("way"))
    text = F.decode("content", "UTF-8")
    odd = F.encode(F.replace(text, F.lit("charset=utf-8"), F.lit("charset=x-none")), "UTF-8")
    pdf = F.encode(F.replace(text, F.lit("text/html; charset=utf-8"), F.lit("application/pdf")), "UTF-8")
    way = F.col("way")
    broken = F.when(way == 1, F.lit(b"\xff\xfe not a mail")).when(way == 2, odd).when(way == 3, pdf)
    return raw.select("message_id", F.when(F.col("bad"), broken).otherwise(F.col("content")).alias("content"))


@query(with_base(f"""
SELECT message_id, coalesce(b.status, m.status) AS status,
  CAST(CASE WHEN b.status IS NULL AND m.status = 'proper' THEN 1 ELSE 0 END AS BIGINT) AS n_proper,
  coalesce(stage, CASE m.status WHEN 'improper' THEN 'fields' WHEN 'unparsed' THEN 'match' END) AS stage,
  coalesce(error, CASE m.status WHEN 'improper' THEN 'MissingField' WHEN 'unparsed' THEN 'NoProvider' END) AS error,
  CASE WHEN b.status IS NOT NULL THEN detail WHEN m.status = 'improper' THEN lacks END AS detail
FROM (SELECT message_id, k, CASE WHEN k % 23 = 0 AND vi <> 13 THEN 'unparsed' WHEN k % 17 = 0 THEN 'improper' ELSE 'proper' END AS status,
  CASE WHEN vi IN (10, 12, 13, 14, 15, 16, 17, 18, 26, 27, 28, 31, 32) THEN 'amount,currency' WHEN vi = 8 THEN 'amount,description' ELSE 'amount' END AS lacks FROM msgs) m
LEFT JOIN (SELECT 'broken' AS status, * FROM (VALUES {_WAYS}) v(way, stage, error, detail)) b ON k % 29 = 0 AND k % 4 = way"""))
def quarantine(spark, sf):
    """Every mail with what became of it: planted broken ones have their reason, the others are as they were."""
    path = _scratch(spark, "quarantine")
    found = outcome.outcomes(mail.parse_messages(_with_broken(spark, sf), faults=True))
    found.select("message_id", "status", "n_proper", "fault").write.parquet(path + "/all")
    kept = spark.read.parquet(path + "/all")
    tables.write_quarantine(outcome.quarantine(kept), path + "/faults")
    return kept.drop("fault").join(tables.read_quarantine(spark, path + "/faults"), "message_id", "left")


@query(with_base(f"""
SELECT from_domain, count(*) AS n FROM (SELECT {_DOMAIN} AS from_domain, * FROM msgs)
WHERE (k % 23 <> 0 OR vi = 13 OR (k % 10) / 10.0 > 0.5) AND ((k % 23 = 0 AND vi <> 13) OR k % 17 = 0) GROUP BY ALL"""))
def unparsed_files(spark, sf):
    """The unparsed sink, written by sender domain and read back."""
    path = _scratch(spark, "unparsed")
    emails = render_emails(spark, sf)
    number = F.regexp_extract("message_id", "^([0-9]+)", 1).cast("bigint")
    tables.write_unparsed(route.unparsed(extract.gate(emails.withColumn("score", (number % 10) / 10), threshold=0.5)), path)
    return spark.read.parquet(path).where("body_html IS NOT NULL").groupBy("from_domain").agg(F.count("*").alias("n"))


@query("SELECT least(count(*) + count(*) FILTER (WHERE o_orderkey % 19 = 0), 10000) AS n FROM orders")
def take_messages(spark, sf):
    return mail.take_messages(render_emails(spark, sf), 10_000).agg(F.count("*").alias("n"))


@query(with_expected(f"SELECT {TX_COLUMNS} FROM tx WHERE message_id NOT LIKE '%-2'"))
def stream_extraction(spark, sf):
    """The stream over a folder of mails, run until all files are read."""
    root = _scratch(spark, "stream")
    # in arrival order of the copies, so that the first copy is the one that is kept
    mails = render_emails(spark, sf)
    first = ~F.col("message_id").endswith("-2")
    mails.where(first).write.parquet(root + "/in")
    stream_extract(
        spark, root + "/in", sink=root + "/out", checkpoint=root + "/state"
    ).awaitTermination()
    mails.where(~first).write.mode("append").parquet(root + "/in")
    stream_extract(
        spark, root + "/in", sink=root + "/out", checkpoint=root + "/state"
    ).awaitTermination()
    return shown(spark.read.parquet(root + "/out"))


@query(with_expected(f"SELECT {TX_COLUMNS} FROM tx WHERE message_id NOT LIKE '%-2'"))
def stream_fullest(spark, sf):
    """Copies that lack fields, and copies of larger ids, arrive before the ones to keep."""
    root = _scratch(spark, "fullest")
    mails = render_emails(spark, sf)
    second = F.col("message_id").endswith("-2")
    known = {"sink": root + "/out", "checkpoint": root + "/state", "keep": "fullest"}
    mails.where(second).write.parquet(root + "/in")
    stream_extract(spark, root + "/in", **known).awaitTermination()
    mails.where(~second).write.mode("append").parquet(root + "/in")
    stream_extract(spark, root + "/in", **known).awaitTermination()
    return shown(fullest(spark, root + "/out"))


@query("""
SELECT p_partkey, '#### ' || p_name || chr(10) || chr(10) || p_brand || ' & ' || p_type || ' <b>'
  || chr(10) || 'size: ' || p_size || chr(10) || chr(10) || 'a b' || chr(10) || chr(10) || '* x' AS text FROM part""")
def html_to_text(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    body = F.concat(
        F.lit("<html><head><title>t</title></head><body><!-- <p>no</p> -->\n<h4>"), F.col("p_name"),
        F.lit("</h4> <p>"), F.col("p_brand"), F.lit(" &amp; <i>"), F.col("p_type"),
        F.lit("</i>\r\n &lt;b&gt;<br/>size:&nbsp;"), F.col("p_size").cast("string"),
        F.lit("</p><script>var x = '<p>';</script><div>a&#32;b</div><ul><li>x</li></ul></body></html>"),
    )
    return part.select("p_partkey", html.html_to_text(body).alias("text"))


@query()
def page_text(spark, sf):
    """Whole pages as text; no SQL twin, the forms are covered by tests."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return pages.select("page_id", html.html_to_text(F.col("html")).alias("text"))


@query("""
SELECT o_orderkey, t AS table_idx, r AS row_idx, c AS col_idx, text FROM (
  SELECT o_orderkey, 0 AS t, 0 AS r, 0 AS c, 'Order' AS text FROM orders
  UNION ALL SELECT o_orderkey, 0, 0, 1, CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT o_orderkey, 0, 1, 0, 'State ' || o_orderstatus FROM orders
  UNION ALL SELECT o_orderkey, 1, 0, 0, 'State' FROM orders
  UNION ALL SELECT o_orderkey, 1, 0, 1, o_orderstatus FROM orders
  UNION ALL SELECT o_orderkey, 2, 0, 0, o_orderpriority FROM orders)""")
def html_tables(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    page = F.concat(
        F.lit("<p>x</p><table><tr><th>Order</th><td>"), F.col("o_orderkey").cast("string"),
        F.lit("</td></tr><tr><td><TABLE><tr><td>State</td> <td>"), F.col("o_orderstatus"),
        F.lit("</td></tr></TABLE></td></tr></table><table><tbody><tr><td>"), F.col("o_orderpriority"),
        F.lit("</td></tr></tbody></table>"),
    )
    return html.html_tables(orders.select("o_orderkey", page.alias("html")), "o_orderkey", "html")


@udtf(returnType=T.StructType([TRANSACTIONS["trx_id"], TRANSACTIONS["merchant"]]))
class _SubjectReceipt:
    """A caller's own extractor: reads the receipt number from the title."""

    def eval(self, subject: str, from_addr: str, body: str):
        if subject and subject.startswith("Your receipt No. "):
            yield subject[17:], from_addr.split("@")[1]


def _subject_receipts():
    """The same for batches of mails. It fails at titles of one provider."""

    def read(mails):
        rows = []
        for subject, sender in zip(mails.column("subject").to_pylist(), mails.column("from_addr").to_pylist()):
            if subject.startswith("UniPin"):
                raise ValueError("no receipt number in " + subject)
            mine = subject.startswith("Your receipt No. ")
            rows.append([{"trx_id": subject[17:], "merchant": sender.split("@")[1]}] if mine else [])
        return rows

    return read


_RECEIPT = "trx_id string, merchant string"


@query(with_base("""
SELECT message_id, id AS trx_id, 'xsolla.com' AS merchant FROM msgs WHERE vi = 34 AND k % 23 <> 0"""))
def register_extractor(spark, sf):
    plugin.register_extractor(spark, "subject_receipts", _subject_receipts(), _RECEIPT)
    return plugin.extract_with(render_emails(spark, sf), "subject_receipts", body="body_html")


@query(ORACLES["register_extractor"])
def register_extractor_rows(spark, sf):
    """The extractor as a table function, called for every mail."""
    plugin.register_extractor(spark, "subject_receipt", _SubjectReceipt)
    return plugin.extract_with(render_emails(spark, sf), "subject_receipt", body="body_html")


@query(with_base("""
SELECT message_id, 'plugin' AS stage, 'ValueError' AS error,
  'no receipt number in UniPin :: Success Flash Top Up Transaction' AS detail
FROM msgs WHERE vi = 33 AND k % 23 <> 0"""))
def extractor_faults(spark, sf):
    """Mails at which a batch extractor fails; all others of their batches are extracted."""
    plugin.register_extractor(spark, "subject_receipts", _subject_receipts(), _RECEIPT)
    return outcome.quarantine(plugin.outcomes_with(render_emails(spark, sf), "subject_receipts", body="body_html"))


@query(with_base("""
SELECT message_id, id AS trx_id, CAST(amt AS DOUBLE) AS amount FROM msgs WHERE vi = 34 AND k % 23 <> 0 AND k % 17 <> 0"""))
def register_rule(spark, sf):
    """A layout of the caller's own, for mails that a built-in one is for too."""
    known = next(r for r in all_rules() if r.provider == "xsolla")
    own = replace(known, provider="own", variant="kept")
    rule.register_rule(own)
    try:
        tx = extract.extract_transactions(render_emails(spark, sf)).where("provider = 'own' AND amount IS NOT NULL")
    finally:
        rule.unregister_rule("own", "kept")
    return tx.select("message_id", "trx_id", F.col("amount").cast("double").alias("amount"))


def _titles(spark: SparkSession, sf: str) -> DataFrame:
    mails = render_emails(spark, sf)
    return mails.select(
        "message_id", text.title_key(F.col("subject"), F.col("from_domain")).alias("title")
    )


@query(with_base("""
SELECT message_id, k % 23 <> 0 AS is_transaction FROM msgs"""))
def weak_labels(spark, sf):
    return weak_label(_titles(spark, sf)).select("message_id", F.col("is_transaction").alias("is_transaction"))


@query(with_base("SELECT message_id, k % 23 = 0 AS is_transaction FROM msgs"))
def label_in_batches(spark, sf):
    """A caller's batch labeller; this one looks for newsletters."""
    marked = label_batches(_titles(spark, sf), lambda titles: ["newsletter" in t for t in titles])
    return marked.select("message_id", "is_transaction")


@query()
def title_model(spark, sf):
    """Weak labels, 80/20 split by key, fit, score the rest."""
    from tillroll.operators.split import split_frac

    titles = split_frac(weak_label(_titles(spark, sf)), "message_id", 0.8)
    model = train_title_model(titles.where("is_train"))
    return score_titles(model, titles.where("NOT is_train").drop("is_transaction", "votes"))


@query(with_base("SELECT count(*) AS n, count(*) FILTER (WHERE k % 23 <> 0) AS positive FROM msgs"))
def title_files(spark, sf):
    """Titles written as CSV with their labels and read back."""
    path = _scratch(spark, "titles")
    tables.write_titles(weak_label(_titles(spark, sf)).select("title", "is_transaction"), path)
    return tables.read_titles(spark, path).agg(
        F.count("*").alias("n"), F.count_if("is_transaction").alias("positive")
    )
