import base64
from email.message import EmailMessage

from pyspark.sql import functions as F

from tillroll.operators import extract, plugin, route
from tillroll.sources import mail as mails
from tillroll.sources import tables
from tillroll.streaming.ingest import fullest, stream_extract
from suite.receipts import _SubjectReceipt

BODY = (
    "<p>Transaction Date : {d} Nov 2024 17:52:19</p><p>Beneficiary Name : Café {d}</p>"
    "<p>Target Amount : IDR 1,000.00</p><p>Remarks : -</p><p>Reference No. : R{d}</p>"
)


def message(day: int, subject="Internet Transaction Journal", sender='"Bé" <bca@bca.co.id>', html=True):
    m = EmailMessage()
    m["Subject"], m["From"] = subject, sender
    m.set_content("plain part")
    if html:
        m.add_alternative(BODY.format(d=day), subtype="html")
    return m.as_bytes()


def write_all(folder):
    folder.mkdir()
    for day in range(1, 6):
        (folder / f"m{day}.eml").write_bytes(message(day))
    (folder / "again.eml").write_bytes(message(5))
    (folder / "news.eml").write_bytes(message(9, subject="Kabar für dich", html=False))
    (folder / "broken.eml").write_bytes(b"\xff\xfe not a mail")
    (folder / "notes.txt").write_text("ignored")
    return str(folder)


def test_scan_eml(spark, tmp_path):
    path = write_all(tmp_path / "in")
    rows = {r.message_id: r for r in mails.scan_eml(spark, path).collect()}
    assert len(rows) == 8
    assert rows["m1"].from_addr == "bca@bca.co.id" and rows["m1"].from_domain == "bca.co.id"
    assert "Café 1" in rows["m1"].body_html and rows["m1"].body_text is None
    assert rows["news"].subject == "Kabar für dich" and rows["news"].body_text.strip() == "plain part"
    assert rows["broken"].subject == "Unknown Subject"
    single = mails.scan_eml(spark, path + "/m2.eml").collect()
    assert [r.message_id for r in single] == ["m2"]
    claimed = mails.scan_eml(spark, path, claimed_only=True)
    assert {r.message_id for r in claimed.collect()} == {"m1", "m2", "m3", "m4", "m5", "again"}
    assert extract.extract_transactions(claimed).where("merchant = 'Café 3'").count() == 1


def test_decode_raw(spark):
    for raw in (b"a", b"ab", b"abc", b"\xfb\xff\xfe>>>", b""):
        coded = base64.urlsafe_b64encode(raw).decode()
        for text in (coded, coded.rstrip("=")):
            assert bytes(spark.range(1).select(mails.decode_raw(F.lit(text)).alias("b")).first().b) == raw


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    path = write_all(tmp_path / "in")
    options = dict(sink=str(tmp_path / "out"), checkpoint=str(tmp_path / "state"), fmt="eml")
    stream_extract(spark, path, **options).awaitTermination()
    batch = route.dedup_transactions(extract.extract_transactions(mails.scan_eml(spark, path)))
    want = sorted(r.trx_id for r in batch.collect())
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.trx_id for r in got.collect()) == want == ["R1", "R2", "R3", "R4", "R5"]
    (tmp_path / "in" / "late.eml").write_bytes(message(7))
    (tmp_path / "in" / "copy.eml").write_bytes(message(1))
    stream_extract(spark, path, **options).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.trx_id for r in got.collect()) == [*want, "R7"]


def test_fullest_copy_of_a_stream_is_that_of_the_batch(spark, tmp_path):
    """Copies without an amount or a date come first, last or between, also in one batch."""
    whole = BODY.replace("R{d}", "X{d}")
    forms = {"whole": whole, "poor": whole.replace("Target Amount", "Something"), "poorer": whole.replace("Target Amount", "a").replace("Transaction Date", "b")}
    orders = [("poor", "whole"), ("whole", "poor"), ("poorer", "poor", "whole"), ("poor", "poor"), ("whole", "whole", "poorer"), ("poorer",)]
    rows = [(step, f"m{9 - step}-{key}", forms[form].format(d=key + 10)) for key, order in enumerate(orders) for step, form in enumerate(order)]
    columns = "message_id string, subject string, from_header string, from_addr string, from_domain string, body_html string, body_text string"
    known = dict(sink=str(tmp_path / "out"), checkpoint=str(tmp_path / "state"), keep="fullest")
    every = None
    for step in range(3):
        now = [(m, "Internet Transaction Journal", "x", "bca@bca.co.id", "bca.co.id", body, None) for s, m, body in rows if s == step]
        now += now[:1]  # the same mail twice
        df = spark.createDataFrame(now, columns)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        every = df if every is None else every.union(df)
        stream_extract(spark, str(tmp_path / "in"), **known).awaitTermination()
        got = fullest(spark, known["sink"])
        want = route.dedup_transactions(extract.extract_transactions(every)).select(*got.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    written = spark.read.parquet(known["sink"])
    assert written.count() < every.count()
    assert {r.trx_id: r.n for r in written.groupBy("trx_id").agg(F.count("*").alias("n")).collect()}["X11"] == 1  # the first was the best


def test_report_and_unparsed_files(spark, emails, tmp_path):
    tx = extract.extract_transactions(emails)
    proper = route.is_proper(tx).where("proper").drop("proper")
    tables.write_report(proper, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert tuple(back.columns) == route.REPORT_COLUMNS and back.count() == proper.count()
    lost = route.unparsed(extract.gate(emails))
    tables.write_unparsed(lost, str(tmp_path / "lost"))
    again = spark.read.parquet(str(tmp_path / "lost"))
    assert again.count() == lost.count() > 0 and again.where("body_html IS NULL").count() == 0


def test_read_labelled_and_titles(spark, tmp_path):
    (tmp_path / "old.csv").write_text(
        "Date,Noted,Location,Amount,Category\n2024-02-03 10:00:00,lunch,Cafe,12.5,FOOD\nbad,,,x,\n"
    )
    rows = tables.read_labelled(spark, str(tmp_path / "old.csv")).collect()
    assert (rows[0].notes, rows[0].merchant, rows[0].amount, rows[0].category) == ("lunch", "Cafe", 12.5, "FOOD")
    assert rows[1].datetime is None and rows[1].amount is None and rows[0].tx_id is None
    folder = tmp_path / "titles"
    folder.mkdir()
    (folder / "a.csv").write_text(',title,is_transaction\n0,"Hi, you from:x.co",True\n')
    (folder / "b.csv").write_text(",title,is_transaction\n0,News from:y.co,False\n")
    got = sorted((r.title, r.is_transaction) for r in tables.read_titles(spark, str(folder)).collect())
    assert got == [("Hi, you from:x.co", True), ("News from:y.co", False)]


def test_own_extractor(spark, emails):
    plugin.register_extractor(spark, "own_receipt", _SubjectReceipt)
    got = plugin.extract_with(emails, "own_receipt", body="body_html")
    assert got.count() > 0 and got.where("merchant <> 'xsolla.com'").count() == 0


def test_plain_mails_need_no_full_header_parser(monkeypatch):
    """They give what the full parser gives; it is left to mails with parts, attachments or headers written otherwise."""
    import email.message

    import pandas as pd

    heads = ["text/html; charset=utf-8", 'text/plain; charset="iso-8859-1"', "text/html", "text/html; charset=x-none", "text/html; charset=utf-8; format=flowed", "application/pdf", "TEXT/HTML"]
    codings = ["", "Content-Transfer-Encoding: 8bit\r\n", "Content-Transfer-Encoding: base64\r\n", "Content-Transfer-Encoding: Quoted-Printable\r\n", "Content-Disposition: attachment\r\n"]
    raw = [f"Subject: s\r\nContent-Type: {h}\r\n{c}\r\n".encode() + b for h in heads for c in codings for b in (b"", "<p>hé</p>\r\n".encode(), b"YQ==", b"\xff=3D")]
    got = mails._bodies().func(pd.Series(raw)).where(lambda d: d.notna(), None).values.tolist()

    def full(content):
        try:
            part = email.message_from_bytes(content, policy=email.policy.default).get_body()
            if part is None:
                return [None, None, "NoBody", email.message_from_bytes(content).get_content_type()]
            text = part.get_content()
            return [text, None, None, None] if part.get_content_subtype() == "html" else [None, text, None, None]
        except Exception as e:
            return [None, None, type(e).__name__, str(e)]

    assert got == [full(r) for r in raw]
    monkeypatch.setattr(email.message.MIMEPart, "get_body", None)
    assert mails._bodies().func(pd.Series(raw[5:6])).error[0] is None


def test_fullest_stream_keeps_its_state_in_the_engine(spark, tmp_path):
    """A function call for every transaction took longer than the extraction itself."""
    from tillroll.streaming.ingest import fullest_stream

    (tmp_path / "in").mkdir()
    plan = fullest_stream(mails.stream_emails(spark, str(tmp_path / "in")))._jdf.queryExecution().analyzed().toString()
    assert "InPandas" not in plan and "Aggregate" in plan
