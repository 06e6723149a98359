"""Steps that are left out where their result is settled already."""

import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import mail
from tillroll.functions.html import html_to_text
from tillroll.functions.text import switch
from tillroll.operators import extract, plugin
from tillroll.plans.rule import all_rules


def test_titles_are_asked_for_only_of_known_senders(spark):
    jago = [r for r in all_rules() if r.provider == "jago"]
    d = mail(
        spark,
        ("1", "Kamu telah membayar A", "noreply@jago.com", None, None),
        ("2", "Kamu telah membayar A", "noreply@ovo.co.id", None, None),
        ("3", "Kamu telah membayar A", None, None, None),
        ("4", None, "TANYA@jago.com", None, None),
        ("5", "Newsletter", '"Jago" <noreply@jago.com>', None, None),
    )
    claims = extract.match_providers(d, jago)
    assert {r.message_id: r.providers for r in claims.collect()} == {"1": ["jago"], "2": [], "3": [], "4": [], "5": []}
    plan = claims._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("noreply@jago.com") < plan.index("kamu telah membayar")


def test_a_case_is_found_by_halving(spark):
    cases = {i: F.lit(f"case {i}") for i in range(35)}
    keys = spark.createDataFrame([(i,) for i in (*range(-1, 36), None)], "k int")
    got = {r.k: r.c for r in keys.select("k", switch(F.col("k"), cases).alias("c")).collect()}
    assert got == {k: f"case {k}" if k in cases else None for k in (*range(-1, 36), None)}
    names = spark.createDataFrame([("a",), ("b",), ("é",), ("",), (None,)], "k string")
    got = {r.k: r.c for r in names.select("k", switch(F.col("k"), {n: F.lit(n) for n in ("é", "b", "a")}).alias("c")).collect()}
    assert got == {"a": "a", "b": "b", "é": "é", "": None, None: None}


def test_blocks_and_line_ends(spark):
    rows = [
        ("<pre>a</pre><prex>b</prex>", "a\n\nb"),
        ("a <br> b <br> c", "a\nb\nc"),
        ("x<ADDRESS>a</Article>b<form x>c</footer>d<font>e", "x\n\na\n\nb\n\nc\n\nde"),
        ("<ul>a</ol>b<dl>c<section>d<blockquote>e<body>f<header>g", "a\n\nb\n\nc\n\nd\n\ne\n\nf\n\ng"),
        ("a&nbsp;&amp;nbsp;&#38;b", "a &nbsp;&b"),
    ]
    d = spark.createDataFrame(rows, "html string, want string")
    plan = d.select(html_to_text(F.col("html")))._jdf.queryExecution().optimizedPlan().toString()
    assert all(f"contains(namedlambdavariable(), {c}) THEN replace(" in plan for c in ("&nbsp;", "\u00a0"))
    assert [r.got for r in d.select(html_to_text(F.col("html")).alias("got")).collect()] == [w for _, w in rows]


def test_batches_with_many_faults_are_not_read_again_and_again(spark):
    """Of 4,096 mails every 32nd is bad: each is read a few times, not once for every halving of the batch."""
    read = spark.sparkContext.accumulator(0)

    def extractor(mails: pa.RecordBatch):
        read.add(mails.num_rows)
        titles = mails.column("subject").to_pylist()
        if any(t.endswith("bad") for t in titles):
            raise ValueError([t for t in titles if t.endswith("bad")][0])
        return [[{"trx_id": t}] for t in titles]

    title = F.concat(F.col("id").cast("string"), F.when(F.col("id") % 32 == 31, "bad").otherwise(""))
    mails = spark.range(0, 4096, 1, 1).select(F.col("id").cast("string").alias("message_id"), title.alias("subject"), F.lit("a@b").alias("from_addr"), F.lit("").alias("body_text"))
    plugin.register_extractor(spark, "least", extractor, "trx_id string")
    rows = plugin.outcomes_with(mails, "least").collect()
    assert [r.message_id for r in rows] == [str(i) for i in range(4096)]
    for i, r in enumerate(rows):
        if i % 32 == 31:
            assert r.rows is None and (r.fault.stage, r.fault.error, r.fault.detail) == ("plugin", "ValueError", f"{i}bad")
        else:
            assert r.fault is None and [x.trx_id for x in r.rows] == [str(i)]
    assert read.value <= 8 * 4096
