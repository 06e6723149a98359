import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tests.conftest import mail

from tillroll.operators import extract, route
from tillroll.plans.rule import Rule, all_rules, const, equals, find, register_rule, unregister_rule

# Shapes of real receipts with invented values: sender, title, text body, expected fields.
CASES = [
    (
        "bca@bca.co.id",
        "Internet Transaction Journal",
        "Status : Successful\nTransaction Date : 19 Nov 2024 17:52:19\nBeneficiary Name : ANI WIJAYA\n"
        "Target Amount : IDR 1,250,000.00\nRemarks : rent\nReference No. : C11-22-BE\n",
        ("mybca", "2024-11-19 17:52:19", "ANI WIJAYA", "1250000.00", "IDR", "myBCA", "C11-22-BE", "rent"),
    ),
    (
        "Jago <tanya@jago.com>",
        "Kamu telah membayar ke TOKO",
        "Dari           MA 1039\nKe             TOKO ABC\nJumlah        Rp25.000\n"
        "Tanggal transaksi 23 February 2024 14:40 WIB\n",
        ("jago", "2024-02-23 14:40:00", "TOKO ABC", "25000.00", "IDR", "Jago", "202402231440", ""),
    ),
    (
        "alerts@seabank.co.id",
        "Notifikasi Transfer SeaBank",
        "Waktu Transaksi\r\n22 Nov 2024 18:48\r\nJenis Transaksi\r\nReal Time (BI-FAST)\r\n"
        "Rekening Tujuan\r\nJAGO-XXX1\r\nJumlah\r\nRp200.000\r\nNo. Referensi\r\n20241122\r\n",
        ("seabank", "2024-11-22 18:48:00", "JAGO-XXX1", "200000.00", "IDR", "SeaBank", "20241122", ""),
    ),
    (
        "BankBRI@bri.co.id",
        "Pemindahan Dana",
        "Tanggal 22 November 2024 , 20:06:34 WIB Nomor Referensi 764780384974 Jenis Transaksi Transfer BI-FAST "
        "Bank Tujuan BANK SATU Nomor Tujuan 6120 Catatan - Nominal Rp35.000 Biaya Admin Rp2.500",
        ("bri", "2024-11-22 20:06:34", "BANK SATU", "35000.00", "IDR", "BRImo", "764780384974", "Transfer BI-FAST"),
    ),
    (
        "googleplay-noreply@google.com",
        "Your Google Play Order Receipt from Dec 2, 2024",
        "You bought it from Some Studio on Google Play.\nOrder number: GPA.3335-0097-8360-50910\n"
        "Order date: 2 Dec 2024 18:20:35 GMT+7\nTax: Rp 2.090,00\nTotal: Rp 41.090,55/month\n"
        "Payment method: ShopeePay: **** 1\n",
        ("google_play", "2024-12-02 18:20:35", "Some Studio", "41090.00", "IDR", "ShopeePay",
         "GPA.3335-0097-8360-50910", ""),
    ),
    (
        "service@intl.paypal.com",
        "Anda mengirim pembayaran",
        "Anda mengirim uang\nAnda membayar $2,00 USD\n\nTanggal transaksi\n\n4 Mei 2024 10.11.12 WIB\n\n"
        "ID transaksi\n\nAB12\n\nCATATAN ANDA UNTUK Budi\n\nmakasih ya\n\nselesai\n",
        ("paypal", "2024-05-04 00:00:00", "Paypal", "2.00", "USD", "Paypal", "AB12", "makasih ya"),
    ),
    (
        "noreply@steampowered.com",
        "Thank you for your Steam purchase!",
        "Invoice: 38692\nDate issued: 17 Apr, 2024 @ 8:58pm WIB\n"
        "Your total for this transaction: Rp 238,440\nPayment method: Visa\n",
        ("steam", "2024-04-17 20:58:00", "Steam", "238440.00", "IDR", "Visa", "38692", ""),
    ),
    (
        "onlinetransaction@ocbc.id",
        "Successful QR Payment 1",
        "QR Payment\nReference No.: MB1\nPayment Date: 19/11/2024\nMerchant PAN 9360001430019008 TOKO ROTI BU ANI\n"
        "Amount Pay IDR 12,500.00\nTip IDR 0.00\n",
        ("ocbc", "2024-11-19 00:00:00", "TOKO ROTI BU ANI", "12500.00", "IDR", "OCBC", "MB1", None),
    ),
    (
        "alerts@seabank.co.id",
        "Notifikasi Transaksi SeaBank",
        "Waktu Transaksi\n22 Nov 2024 18:48\nJenis Transaksi\nSeaBank Bayar Instan\nNama Merchant\nToko Roti Ani\n"
        "Jumlah\nRp20.000\nNo. Referensi\n2024\nCatatan\nroti dan kopi\n",
        ("seabank", "2024-11-22 18:48:00", "Toko Roti Ani", "20000.00", "IDR", "SeaBank", "2024", "roti dan kopi"),
    ),
    (
        "service@intl.paypal.com",
        "You sent a payment",
        "You sent a payment\nYou paid $1,234 USD\n\nTransaction date\n\n4 May 2024\n\nTransaction ID\n\nAB13\n\n",
        ("paypal", "2024-05-04 00:00:00", "Paypal", "1234.00", "USD", "Paypal", "AB13", ""),
    ),
    (
        "noreply@ovo.co.id",
        "OVO QR Payment Receipt",
        "16 Nov 24, 10:11 Nama Toko : TEH Lokasi : KOTA No. Resi (Kode Transaksi) 072bb OVO Points "
        "Tip Rp1,000 Pembayaran Rp6.000",
        ("ovo", "2024-11-16 10:11:00", ": TEH", "6000.00", "IDR", "OVO Points", "072bb", "OVO"),
    ),
]


@pytest.mark.parametrize(("sender", "title", "body", "want"), CASES)
def test_receipt_texts(spark, sender, title, body, want):
    rows = extract.extract_transactions(mail(spark, ("1", title, sender, None, body))).collect()
    assert len(rows) == 1
    r = rows[0]
    got = (
        r.provider, str(r.date), r.merchant, str(r.amount), r.currency, r.payment_method, r.trx_id, r.description,
    )
    assert got == want


def test_rule_inventory():
    rules = all_rules()
    assert len(rules) == 35
    assert len({r.provider for r in rules}) == 20
    assert len({(r.provider, r.variant) for r in rules}) == 35


def test_match_uses_parsed_address_and_header_kinds(spark):
    df = mail(
        spark,
        ("1", "Internet Transaction Journal", '"BCA" <bca@bca.co.id>', None, "x"),
        ("2", "Internet Transaction Journal", "x@bca.co.id", None, "x"),
        ("3", "anything", "receipts@gotagihan.gojek.com", None, "x"),
        ("4", "Your Grab E-Receipt", "no-reply@grab.com", None, "x"),
        ("5", "Your Grab E-Receipt", "other@x.com", None, "x"),
        ("6", "STEAM PURCHASE", "NoReply@SteamPowered.com", None, "x"),
        ("7", "Fwd: OVO QR Payment Receipt", "noreply@ovo.co.id", None, "x"),
        ("8", None, None, None, "x"),
        ("9", "Top Up", "someone@else.com", None, "x"),
        ("10", "Info Transfer Dana Masuk", "notifikasi@ocbcnisp.com", None, "x"),
    )
    got = {r.message_id: sorted(r.providers) for r in extract.match_providers(df).collect()}
    assert got == {
        "1": ["mybca"], "2": [], "3": ["gotagihan"], "4": ["grab", "grabfood"], "5": ["grab"],
        "6": ["steam"], "7": [], "8": [], "9": [], "10": ["ocbc"],
    }


def test_broken_values_lose_only_themselves(spark):
    body = (
        "Transaction Date : 31 Foo 2024\nBeneficiary Name : A\nTarget Amount : IDR ,.\n"
        "Remarks : -\nReference No. : C1\n"
    )
    df = mail(
        spark,
        ("1", "Internet Transaction Journal", "bca@bca.co.id", None, body),
        ("2", "Internet Transaction Journal", "bca@bca.co.id", None, None),
        ("3", "Notifikasi Transfer SeaBank", "alerts@seabank.co.id", None, "no known layout"),
    )
    rows = {r.message_id: r for r in extract.extract_transactions(df).collect()}
    assert rows["1"].date is None and rows["1"].amount is None and rows["1"].trx_id == "C1"
    assert "3" not in rows  # claimed, but none of its layouts fits
    status = {r.message_id: r.status for r in route.route(extract.gate(df)).collect()}
    assert status == {"1": "improper", "2": "improper", "3": "unparsed"}
    assert {r.message_id for r in route.unparsed(extract.gate(df)).collect()} == {"1", "2", "3"}


def test_nullable_fields(spark):
    body = "Order ID: F-1\nTotal payment Rp57.000\nPaid with GoPay Rp50.000\nPaid with Cash Rp7.000\n"
    df = mail(spark, ("1", "Your food order with Gojek", "no-reply@invoicing.gojek.com", None, body))
    row = route.is_proper(extract.extract_transactions(df)).first()
    assert row.merchant is None and row.date is None and row.proper
    assert row.payment_method == "GoPay + Cash" and row.amount == Decimal("57000.00")


def test_every_mail_gets_one_status(emails):
    gated = extract.gate(emails)
    routed = route.route(gated)
    assert routed.count() == gated.count() == routed.select("message_id").distinct().count()
    counts = {r.status: r["count"] for r in routed.groupBy("status").count().collect()}
    assert set(counts) == {"proper", "improper"}
    lost = {r.message_id for r in route.unparsed(gated).collect()}
    assert lost == {r.message_id for r in routed.where("status <> 'proper'").collect()}


def test_dedup_keeps_what_has_no_id(spark):
    jago = "Ke X{}\nJumlah Rp{}.000\nTanggal transaksi 23 February 2024 14:40 WIB\n"
    title, sender = "Kamu telah membayar", "noreply@jago.com"
    df = mail(
        spark,
        ("1", title, sender, None, jago.format("a", 1)),
        ("2", title, sender, None, jago.format("b", 1)),
        ("3", title, sender, None, jago.format("a", 1)),
        ("4", title, sender, None, jago.format("a", 2)),
    )
    kept = route.dedup_transactions(extract.extract_transactions(df))
    assert sorted(r.message_id for r in kept.collect()) == ["1", "2", "4"]
    again = route.dedup_transactions(kept)
    assert again.exceptAll(kept).count() == 0 and again.count() == 3


def test_own_rule(spark):
    rule = Rule(
        provider="kiosk",
        variant="receipt",
        title=equals("Kiosk"),
        sender=None,
        dates=("yyyy-MM-dd",),
        texts={
            "trx_id": find(r"id (\w+)"),
            "date": find(r"on (\S+)"),
            "merchant": const("Kiosk"),
            "amount": find(r"paid ([\d.,]+)"),
            "currency": const("EUR"),
            "payment_method": find(r"by (\w+)", default="cash"),
            "description": const("-"),
        },
    )
    register_rule(rule)
    try:
        with pytest.raises(ValueError):
            register_rule(rule)
        df = mail(spark, ("1", "Kiosk", "a@b.co", None, "id k1 on 2024-02-03 paid 1,200.50"))
        r = extract.extract_transactions(df).first()
        assert (r.trx_id, r.amount, r.payment_method) == ("k1", Decimal("1200.50"), "cash")
    finally:
        unregister_rule("kiosk", "receipt")
    assert extract.extract_transactions(df).count() == 0
    with pytest.raises(ValueError):
        Rule("a", "b", None, None, {"colour": const("x")}, ())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_extraction_plan_is_one_narrow_job(emails):
    plan = plan_of(extract.extract_transactions(emails))
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("!--.*?--|(script") == 1  # the body is turned to text once
    assert plan.count("GPA") == 1  # and searched once per field
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "from_header" not in read and "from_domain" not in read


def test_match_reads_headers_only(emails):
    plan = plan_of(extract.match_providers(emails).select("message_id", F.size("providers")))
    assert "body_html" not in plan.split("ReadSchema")[-1]


def test_dedup_shuffles_once(emails):
    plan = plan_of(route.dedup_transactions(extract.extract_transactions(emails)))
    assert plan.count("Exchange") == 1
    assert plan.count("partial_min") >= 1


def test_gate_with_scores(emails):
    plain = extract.gate(emails)
    ids = emails.select("message_id")
    inline = extract.gate(emails.withColumn("score", F.lit(0.9)))
    assert inline.count() == emails.count() > plain.count()
    assert "Exchange" not in plan_of(inline)
    low = extract.gate(emails, ids.withColumn("score", F.lit(0.5)))
    assert low.count() == plain.count()  # strictly above the threshold
    high = extract.gate(emails, ids.withColumn("score", F.lit(0.51)))
    assert high.count() == emails.count()
