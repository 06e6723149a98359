"""Outcomes of mails, their faults, and extractors over batches."""


import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import mail
from tests.test_extract import plan_of
from tests.test_sources import BODY, message
from tillroll.operators import extract, outcome, plugin, route
from tillroll.schemas import EMAILS, FAULT
from tillroll.sources import mail as mails
from tillroll.sources import tables

TITLE, SENDER = "Internet Transaction Journal", "bca@bca.co.id"


def faults_of(df, *keep):
    return {r.message_id: tuple(r)[1:] for r in outcome.quarantine(df, keep).collect()}


def test_routing_is_one_narrow_job(emails):
    for df in (route.route(extract.gate(emails)), route.unparsed(extract.gate(emails)), outcome.quarantine(outcome.outcomes(emails))):
        plan = plan_of(df)
        assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
        assert plan.count("!--.*?--|(script") == 1  # the body is turned to text once
        assert plan.count("GPA") == 1  # and searched once per field


def test_rows_of_outcomes_are_the_transactions(emails):
    found = outcome.outcomes(emails)
    want = route.is_proper(extract.extract_transactions(emails))
    got = outcome.transactions(found).select(*want.columns)
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert found.count() == emails.count()


def test_each_fault_has_its_reason(spark):
    good = BODY.format(d=19)
    df = mail(
        spark,
        ("good", TITLE, SENDER, good, None),
        ("news", "Weekly news", "a@b.co", good, None),
        ("layout", "Notifikasi Transfer SeaBank", "alerts@seabank.co.id", None, "no known layout"),
        ("fields", TITLE, SENDER, good.replace("Nov", "Foo").replace("1,000.00", ",."), None),
        ("missing", TITLE, SENDER, good.replace("Target Amount", "Something"), None),
        ("nothing", TITLE, SENDER, None, None),
        ("two", "Your Grab E-Receipt", "no-reply@grab.com", None, "no known layout"),
        (None, None, None, None, None),
    )
    found = outcome.outcomes(df)
    assert {r.message_id: r.status for r in found.collect()} == {
        "good": "proper", "news": "unparsed", "layout": "unparsed", "fields": "improper", "missing": "improper",
        "nothing": "improper", "two": "unparsed", None: "unparsed",
    }
    got = faults_of(found)
    assert got["news"] == got[None] == ("match", "NoProvider", None)
    assert got["layout"] == ("layout", "NoLayout", "seabank")
    assert got["fields"] == ("fields", "UnreadableField", "amount,date")
    assert got["missing"] == ("fields", "MissingField", "amount,currency")
    assert got["two"] == ("layout", "NoLayout", "grab,grabfood")
    assert got["nothing"][:2] == ("fields", "MissingField") and "good" not in got
    empty = outcome.outcomes(df.limit(0))
    assert empty.count() == 0 and empty.schema["fault"].dataType == FAULT


def test_repeated_mails_and_clashing_columns(spark):
    df = mail(spark, *[("1", TITLE, SENDER, BODY.format(d=19), None)] * 3).withColumns({c: F.lit(1) for c in ("claims", "_text", "f", "v", "rule")})
    found = outcome.outcomes(df, keep=("claims", "_text", "f", "v", "rule", "from_domain"))
    rows = found.collect()
    assert len(rows) == 3 and all((r.claims, r["_text"], r.f, r.v, r.rule, r.status, r.n_rows) == (1, 1, 1, 1, 1, "proper", 1) for r in rows)


def test_broken_messages_keep_their_reason(spark, tmp_path):
    whole = message(1).replace(b"utf-8", b"x-none")
    deep = b"Subject: x\nFrom: a@b.co\nContent-Type: application/pdf\n\n%PDF"
    raw = [("good", message(3)), ("none", None), ("empty", b""), ("junk", b"\xff\xfe not a mail"), ("charset", whole), ("pdf", deep), ("news", message(9, subject="Kabar"))]
    df = spark.createDataFrame(raw, "message_id string, content binary")
    parsed = mails.parse_messages(df, faults=True)
    assert parsed.columns == [*EMAILS.fieldNames(), "fault"]
    found = outcome.outcomes(parsed)
    assert {r.message_id: r.status for r in found.collect()} == {
        "good": "proper", "none": "broken", "empty": "broken", "junk": "broken", "charset": "broken", "pdf": "broken", "news": "unparsed",
    }
    got = faults_of(found)
    assert got["none"] == got["empty"] == ("headers", "EmptyMessage", None)
    assert got["junk"] == ("headers", "NoHeaders", None)
    assert got["charset"][:2] == ("body", "LookupError") and "x-none" in got["charset"][2]
    assert got["pdf"] == ("body", "NoBody", "application/pdf")
    claimed = mails.parse_messages(df, faults=True, claimed_only=True)
    assert {r.message_id for r in claimed.collect()} == {"good", "none", "empty", "junk", "charset"}
    assert {r.message_id for r in mails.parse_messages(df, claimed_only=True).collect()} == {"good", "charset"}
    tables.write_quarantine(outcome.quarantine(found), str(tmp_path / "q"))
    back = tables.read_quarantine(spark, str(tmp_path / "q"))
    assert {r.message_id: (r.stage, r.error, r.detail) for r in back.collect()} == got
    tables.write_quarantine(outcome.quarantine(found, ["from_domain"]), str(tmp_path / "q"), append=True)
    assert tables.read_quarantine(spark, str(tmp_path / "q")).count() == 2 * len(got)


def _numbers():
    def read(mails):
        out = []
        for body in mails.column("body").to_pylist():
            if body == "none":
                out.append(None)
            else:
                out.append([{"n": int(x)} for x in body.split()])  # raises at what is no number, and at NULL
        return out

    return read


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_one_bad_mail_costs_only_itself(spark, size):
    bodies = {str(i): f"{i} {i + 1}" for i in range(100)} | {"13": "x", "14": None, "77": "none", "78": "", "99": "1 y"}
    df = mail(spark, *[(k, "s", "a@b.co", None, b) for k, b in bodies.items()])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        plugin.register_extractor(spark, "numbers", _numbers(), "n long")
        found = plugin.outcomes_with(df, "numbers", keep=["subject"])
        assert found.columns == ["message_id", "subject", "rows", "fault"] and found.count() == 100
        got = faults_of(found, "subject")
        assert {k: v[:3] for k, v in got.items()} == {"13": ("s", "plugin", "ValueError"), "14": ("s", "plugin", "AttributeError"), "99": ("s", "plugin", "ValueError")}
        rows = plugin.extract_with(df, "numbers")
        want = sorted((k, int(n)) for k, b in bodies.items() if k not in got and b not in ("none", None) for n in b.split())
        assert sorted(map(tuple, rows.collect())) == want
        assert plugin.extract_with(df.limit(0), "numbers").count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_batch_extractors_may_give_arrow_and_must_give_each_mail_a_list(spark):
    df = mail(spark, *[(str(i), f"s{i}", "a@b.co", None, "x") for i in range(5)])

    def arrow(mails):
        n = pa.array([len(s) for s in mails.column("subject").to_pylist()], pa.int32())  # cast to what was asked for
        return pa.ListArray.from_arrays(pa.array(range(len(n) + 1), pa.int32()), pa.StructArray.from_arrays([n], names=["n"]))

    def short(mails):
        return [[]] * (mails.num_rows + 1)

    plugin.register_extractor(spark, "arrow", arrow, "n long")
    assert sorted(map(tuple, plugin.extract_with(df, "arrow").collect())) == [(str(i), 2) for i in range(5)]
    plugin.register_extractor(spark, "short", short, "n long")
    assert {v[1] for v in faults_of(plugin.outcomes_with(df, "short")).values()} == {"ValueError"}
    with pytest.raises(KeyError):
        plugin.outcomes_with(df, "unknown")
