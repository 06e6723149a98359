"""Work that is done once, or without an interpreted comparison, whatever the size of the input."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite import receipts
from tests.conftest import mail
from tillroll.functions.html import html_cells, html_to_text
from tillroll.operators import titles, vocab

_BODY = (
    "<p>Order No.: MP{0}</p><p>Payment Time: 2024-03-0{0} 10:11:12 (UTC)</p><p>Item Name: Gems</p><p>Currency: IDR</p>"
    "<p>Price: 1,{0}00</p><p>Payment Methods: QRIS</p><p>Subtotal: -</p>"
)


def test_report_files_reads_each_mail_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    def seen(body):
        read.add(1)
        return body

    counted = F.udf(seen, T.StringType()).asNondeterministic()
    mails = mail(spark, *((str(n), "Payment Successful", "mobapay@mail.mobapay.com", _BODY.format(n), None) for n in range(1, 6)))
    monkeypatch.setattr(receipts, "render_emails", lambda *_: mails.withColumn("body_html", counted("body_html")))
    rows = receipts.report_files(spark, "").collect()
    assert [(r.provider, r.currency, r.n, r.total) for r in rows] == [("mobapay", "IDR", 5, 6500.0)]
    assert read.value == 5


def test_terms_are_sorted_without_a_lambda(spark):
    d = spark.createDataFrame([(1, ["b", "a", None, "b"]), (2, []), (3, None), (4, ["a"])], "id int, t array<string>")
    stats = vocab.term_stats(d, "id", "t", unique=True)
    assert "array_sort" not in stats._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in stats.collect()} == {("a", 2, 2), ("b", 2, 1)}


def test_flat_and_nested_tables(spark):
    rows = [
        ("<p>x</p><table><tr><td>a&nbsp;b</td></tr></table> y <TABLE b='1'><tr><td>c</td><td>d</td></tr></TABLE>", [[["a b"]], [["c", "d"]]]),
        ("<table><tr><td>a<table><tr><td>b</td></tr></table></td></tr></table><table><tr><td>c</td></tr></table>", [[["a b"]], [["b"]], [["c"]]]),
        ("x</table>y", []),
        ("<table><tr><td>open", [[["open"]]]),
        ("", []),
        (None, None),
    ]
    d = spark.createDataFrame(rows, "html string, want array<array<array<string>>>")
    got = d.select("want", html_cells("html").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_references_around_a_space(spark):
    d = spark.createDataFrame([("a&nbsp;b&amp;nbsp;&#38;nbsp;&nbsp &am&nbsp;p;",)], "html string")
    assert d.select(html_to_text(F.col("html"))).first()[0] == "a b&nbsp;&nbsp;&nbsp &am p;"


def test_title_model_reads_each_title_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(title):
        read.add(1)
        return title

    counted = F.udf(seen, T.StringType()).asNondeterministic()
    rows = [(n, "weekly newsletter" if n % 4 == 0 else f"your receipt {n}", n % 4 != 0) for n in range(40)]
    d = spark.createDataFrame(rows, "message_id int, title string, is_transaction boolean")
    model = titles.train_title_model(d.withColumn("title", counted("title")))
    assert read.value == 40
    found = titles.score_titles(model, d.drop("is_transaction")).collect()
    assert {r.message_id for r in found if r.is_transaction} == {n for n in range(40) if n % 4}
