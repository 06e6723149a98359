from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.functions import dates, html, money, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_rx_null_empty_and_first(spark):
    assert one(spark, text.rx(F.lit("a=1"), r"a=(\d)")) == "1"
    assert one(spark, text.rx(F.lit("b"), r"a=(\d)")) is None
    assert one(spark, text.rx(F.lit("a="), r"a=(\d*)")) == ""
    assert one(spark, text.rx_first(F.lit("b=2 a=1"), [r"x=(\d)", r"a=(\d)", r"b=(\d)"])) == "1"
    assert one(spark, text.rx_all(F.lit("x1 x2 x3"), r"x(\d)")) == "1 + 2 + 3"
    assert one(spark, text.rx_all(F.lit("none"), r"x(\d)")) == ""
    assert one(spark, text.between(F.lit("Item: Big \n Box Price 3"), "Item:", "Price")) is None
    assert one(spark, text.between(F.lit("Item:  Big Box  Price 3"), "Item:", "Price")) == "Big Box"


def test_unicode_space_and_line_ends(spark):
    assert one(spark, text.rx(F.lit("Total  Rp5"), r"Total\s*Rp(\d)")) == "5"
    assert one(spark, text.collapse_ws(F.lit("a \r\n\t b"))) == "a b"
    # a dot stops at a line feed only
    assert one(spark, text.rx(F.lit("a: x\ry\nz"), r"a: (.+)")) == "x\ry"


def test_words_headers_addresses(spark):
    assert one(spark, text.translate_terms(F.lit("Sept September"), {"Sept": "Sep"})) == "Sep September"
    assert one(spark, text.parse_addr(F.lit('"Shop, Inc" <a.b@shop.co>'))) == "a.b@shop.co"
    assert one(spark, text.parse_addr(F.lit(" a@b.co "))) == "a@b.co"
    assert one(spark, text.extract_domain(F.lit("X <a@mail.b-c.co.id>"))) == "mail.b-c.co.id"
    assert one(spark, text.extract_domain(F.lit("nobody"))) is None
    assert one(spark, text.title_key(F.lit("Hi"), F.lit(None).cast("string"))) == "Hi from:None"
    assert one(spark, text.to_ascii(F.lit("Café €5"))) == "Caf 5"
    assert one(spark, text.to_ascii(F.lit(None).cast("string"))) is None
    assert one(spark, text.clean_text(F.lit(None).cast("string"))) == ""
    headers = F.array(F.struct(F.lit("To").alias("name"), F.lit("x").alias("value")))
    assert one(spark, text.header_value(headers, "Subject")) == ""


def test_tokens(spark):
    assert one(spark, text.tokenize(F.lit("Hello, World! it's a-b  "))) == ["hello", "world", "its", "ab"]
    assert one(spark, text.tokenize(F.lit(" .. "))) == []
    assert one(spark, text.word_tokens(F.lit("a Bc, déjà_vu x1"))) == ["bc", "déjà_vu", "x1"]
    words = F.array(*map(F.lit, "abc"))
    assert one(spark, text.ngrams(words, 1, 2)) == ["a", "b", "c", "a b", "b c"]
    assert one(spark, text.ngrams(F.array(F.lit("a")), 2, 3)) == []


@pytest.mark.parametrize(
    ("written", "style", "value"),
    [
        ("1,000,000.00", "M1", "1000000.00"),
        ("200.406,75", "M2", "200406.75"),
        ("200.000", "M3", "200000"),
        ("1.500", "M4", "1500"),
        ("1,500", "M4", "1500"),
        ("2,00", "M5", "2.00"),
        ("103 254.00", "M6", "103254.00"),
        ("103 254.00", "M6", "103254.00"),
        ("2,50", "M7", "2.50"),
        ("2.50", "M7", "2.50"),
        ("1.234,50", "M7", "1234.50"),
        ("1.234,56", "M5", "1234.56"),
        ("", "M1", None),
        ("Rp", "M3", None),
        ("1" * 30, "M1", None),
    ],
)
def test_money_styles(spark, written, style, value):
    got = one(spark, money.parse_money(F.lit(written), style))
    assert got == (None if value is None else Decimal(value))


def test_money_round_trip(spark):
    n = F.col("id") * 7919 % 1_000_000_007
    grouped = F.format_number(n, 2)
    swapped = F.translate(grouped, ",.", ".,")
    df = spark.range(2000).select(
        n.cast("decimal(18,2)").alias("n"),
        money.parse_money(grouped, "M1").alias("m1"),
        money.parse_money(swapped, "M2").alias("m2"),
        money.parse_money(F.translate(F.format_number(n, 0), ",", "."), "M3").alias("m3"),
        money.parse_money(F.translate(grouped, ",", " "), "M6").alias("m6"),
    )
    assert df.where("NOT (n <=> m1 AND n <=> m2 AND n <=> m3 AND n <=> m6)").count() == 0


def test_money_whole_and_codes(spark):
    assert one(spark, money.parse_money(F.lit("41.090,99"), "M2", whole=True)) == Decimal("41090.00")
    assert one(spark, money.currency_code(F.lit("Rp."))) == "IDR"
    assert one(spark, money.currency_code(F.lit("USD"))) == "USD"


@pytest.mark.parametrize(
    ("written", "formats", "value"),
    [
        ("19 Nov 2024 17:52:19", ["d MMM yyyy H:mm:ss"], "2024-11-19 17:52:19"),
        ("Rabu, 2 Agustus 2023, 10:07 WIB", ["d MMMM yyyy, H:mm"], "2023-08-02 10:07:00"),
        ("2 Sept 2024 18:20:35 GMT+7", ["d MMM yyyy H:mm:ss"], "2024-09-02 18:20:35"),
        ("9 September 2024", ["d MMMM yyyy"], "2024-09-09 00:00:00"),
        ("17 Apr, 2024 8:58pm", ["d MMM, yyyy h:mma"], "2024-04-17 20:58:00"),
        ("1 Agu 2024 07:42:38", ["d MMM yyyy H:mm:ss"], "2024-08-01 07:42:38"),
        ("2023-02-04 09:42:51 (UTC)", ["yyyy-MM-dd H:mm:ss"], "2023-02-04 09:42:51"),
        ("4 Mei 2024", ["d MMMM yyyy", "d MMM yyyy"], "2024-05-04 00:00:00"),
        ("4 Foo 2024", ["d MMMM yyyy", "d MMM yyyy"], None),
        ("31 Feb 2024", ["d MMM yyyy"], None),
        ("", ["d MMM yyyy"], None),
    ],
)
def test_dates(spark, written, formats, value):
    got = one(spark, dates.parse_local_ts(F.lit(written), *formats))
    assert (None if got is None else str(got)) == value


def test_calendar(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-12-30 01:00:00' AS t UNION ALL SELECT timestamp_ntz'2024-12-29 01:00:00'")
    rows = {r.day_of_month: r for r in dates.datetime_features(df, "t").collect()}
    assert (rows[30].day_of_week, rows[30].week_of_year, rows[30].is_weekend) == (0, 1, 0)
    assert (rows[29].day_of_week, rows[29].week_of_year, rows[29].is_weekend) == (6, 52, 1)


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<p>a</p><p>b<br>c</p>", "a\n\nb\nc"),
        ("<h4>Big</h4>x", "#### Big\n\nx"),
        ("<h1 class='t'>Big</h1>", "# Big"),
        ("<table><tr><td>Tanggal</td><td>1 Agu</td></tr><tr><td>Jam</td></tr></table>", "Tanggal1 Agu\nJam"),
        ("<tr><td>a</td>\n  <td>b</td></tr>", "a b"),
        ("a&nbsp;b&amp;lt;c &#82;p &euro;", "a b&lt;c Rp €"),
        ("<style>x{}</style><script>var a='<p>';</script><!-- <p>n</p> -->ok", "ok"),
        ("<a href='u'>link</a> <b>bold</b> <img src='x'>", "link bold"),
        ("x < y and 3 <4", "x < y and 3 <4"),
        ("", ""),
    ],
)
def test_html_to_text(spark, source, want):
    assert one(spark, html.html_to_text(F.lit(source))) == want


def test_html_cells(spark):
    nested = (
        "<table><tr><th>k</th><td>v &amp; w</td></tr><tr><td>out<TABLE><tr><td>in1</td><td>in2</td></tr></TABLE>"
        "</td></tr></table>x<table><tbody><tr><td>open<td>cells</tr></tbody></table>"
    )
    df = spark.createDataFrame([(nested,), ("no tables",), (None,)], "h string")
    got = [r.c for r in df.select(html.html_cells("h").alias("c")).collect()]
    assert got == [
        [[["k", "v & w"], ["out in1 in2"]], [["in1", "in2"]], [["open", "cells"]]],
        [],
        None,
    ]
