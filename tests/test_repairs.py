"""Character references, grouped amounts, NULL classes and copies that lack a field."""

from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.functions.html import html_to_text, unescape
from tillroll.functions.money import parse_money
from tillroll.operators.route import dedup_transactions
from tillroll.operators.split import split_stratified
from tillroll.schemas import TRANSACTIONS


def test_references(spark):
    cases = {
        "&#x27;a&raquo;": "'a»",
        "&#9999999;|&#55357;|&#0;": "�|�|�",
        "&#55357;&#56832; &#xD83D;&#xDE00;": "😀 😀",
        "&amp;lt; &lt; &amp;amp;": "&lt; < &amp;",
        "&nope; & &Omega;&#00065;&#99999999999999999999;": "&nope; & ΩA�",
        "&rsquo;&mdash;": "'--",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.u for r in df.select("t", unescape(F.col("t")).alias("u")).collect()} == cases


def test_one_bad_mail_costs_only_itself(spark):
    df = spark.createDataFrame([(1, "<p>&#9999999;</p>"), (2, "<p>fine &euro;</p>")], "id int, h string")
    got = {r.id: r.t for r in df.select("id", html_to_text(F.col("h")).alias("t")).collect()}
    assert got == {1: "�", 2: "fine €"}


def test_grouped_amounts(spark):
    cases = {
        "1,234.56": "1234.56", "1.234,56": "1234.56", "2,50": "2.50", "2.50": "2.50", "1,234,567.89": "1234567.89",
        "1,234": "1234.00", "1.234": "1234.00", "1,234,567": "1234567.00", "1.234.567": "1234567.00", "12.345.678,9": "12345678.90",
        "1234": "1234.00", "1234,567": "1234.57", "0,125": "0.13", "0.5": "0.50", ",50": "0.50", "999,999": "999999.00",
        "12,3456": "12.35", "": None, "x": None, None: None, "1,2.3,4": "123.40",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    for style in ("M5", "M7"):
        got = {r.t: r.v for r in df.select("t", parse_money(F.col("t"), style).alias("v")).collect()}
        assert got == {k: v and Decimal(v) for k, v in cases.items()}
    # a dinar has a thousand parts
    coins = spark.createDataFrame([("1,234", "KWD"), ("1.234", "kwd"), ("1,234", "USD"), ("1,234", None), ("1,234,567", "BHD")], "t string, c string")
    got = [r.v for r in coins.select(parse_money(F.col("t"), "M5", currency=F.col("c")).alias("v")).collect()]
    assert got == [Decimal(v) for v in ("1.23", "1.23", "1234.00", "1234.00", "1234567.00")]


def test_null_is_a_class(spark):
    df = spark.createDataFrame([(i, None if i < 10 else "") for i in range(20)], "id int, c string")
    held = split_stratified(df, "id", "c", 0.5).where("is_held").groupBy("c").count().collect()
    assert {r.c: r["count"] for r in held} == {None: 5, "": 5}


def test_complete_copy_stays(spark):
    base = {f.name: None for f in TRANSACTIONS.fields}
    rows = [
        {**base, "message_id": m, "provider": "p", "variant": "v", "trx_id": "1", "amount": a, "currency": "IDR"}
        for m, a in (("a", None), ("b", Decimal("5.00")), ("c", Decimal("5.00")))
    ]
    df = spark.createDataFrame([tuple(r[f.name] for f in TRANSACTIONS.fields) for r in rows], TRANSACTIONS)
    assert [r.message_id for r in dedup_transactions(df).collect()] == ["b"]


def test_header_block(spark):
    from tillroll.sources.mail import header_block

    cases = [b"A: 1\r\nB: \xff\r\n\r\nbody\n\nmore", b"A: 1\n\nbody\r\n\r\n", b"A: no body", b"", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, content binary")
    got = [r.h for r in df.select("i", header_block(F.col("content")).alias("h")).orderBy("i").collect()]
    assert [None if g is None else bytes(g).strip() for g in got[:-1]] == [b"A: 1\r\nB: \xff", b"A: 1\n\nbo", b"A: no body", b""]
    assert got[-1] is None


def test_many_tables(spark):
    """More tables than are gone through at a time; nested ones over the boundaries; ends without a begin."""
    from tillroll.functions.html import html_cells

    n = 400
    one = "<p>x</p><table><tr><td>{0}</td><td><TABLE class=a><tr><td>in {0}</td></tr></table></td></tr></table>"
    bodies = {
        1: "".join(one.format(i) for i in range(n)),
        2: "<table><tr><td>out " + "".join(f"<table><tr><td>{i}</td></tr></table>" for i in range(n)) + "</td></tr></table>",
        3: "<table><tr><td>a" * 40 + "</td></tr></table>" * 60 + "<table><tr><td>z</td></tr></table>",
        4: "no table",
        5: "",
        6: None,
        7: "</table><table><tr><td>q</td></tr>",
    }
    df = spark.createDataFrame(list(bodies.items()), "id int, h string")
    got = {r.id: r.c for r in df.select("id", html_cells("h").alias("c")).collect()}
    assert got[1] == [t for i in range(n) for t in ([[str(i), f"in {i}"]], [[f"in {i}"]])]
    assert got[2][0] == [["out " + " ".join(map(str, range(n)))]] and got[2][1:] == [[[str(i)]] for i in range(n)]
    assert [t[0][0].split() for t in got[3]] == [["a"] * (40 - i) for i in range(40)] + [["z"]]
    assert got[4] == got[5] == [] and got[6] is None and got[7] == [[["q"]]]
