"""Queries for the text, money and date functions, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import dates, money, text
from tillroll.session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf}/{name}.parquet"))


# RE2 has no Unicode shorthand classes, so the twins spell them out.
_SPACE = r"\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


@query(r"""
SELECT doc_id, nullif(regexp_extract(text, '([a-z0-9]+\.[0-9]+)@', 1), '') AS mailbox FROM documents""")
def rx(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", text.rx(F.col("text"), r"([a-z0-9]+\.[0-9]+)@").alias("mailbox"))


@query(r"""
SELECT doc_id, coalesce(nullif(regexp_extract(text, '@([a-z0-9]+\.[a-z]+)', 1), ''),
  nullif(regexp_extract(text, '([0-9]{3})', 1), ''), nullif(regexp_extract(text, '([A-Z][a-z]+)', 1), ''))
  AS found FROM documents""")
def rx_first(spark, sf):
    d = read(spark, sf, "documents")
    patterns = [r"@([a-z0-9]+\.[a-z]+)", r"([0-9]{3})", r"([A-Z][a-z]+)"]
    return d.select("doc_id", text.rx_first(F.col("text"), patterns).alias("found"))


@query(r"""
SELECT doc_id, array_to_string(regexp_extract_all(text, '(\d{2,})[^0-9]', 1), ' + ') AS numbers
FROM documents""")
def rx_all(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", text.rx_all(F.col("text"), r"([0-9]{2,})[^0-9]").alias("numbers"))


@query(r"""
SELECT page_id, nullif(trim(regexp_extract(html, '(?s)<title>[ \t\r\n]*(.*?)[ \t\r\n]*</title>', 1)), '')
  AS title FROM pages""")
def between(spark, sf):
    p = read(spark, sf, "pages")
    found = text.between(F.col("html"), "(?s)<title>", "</title>")
    return p.select("page_id", F.nullif(found, F.lit("")).alias("title"))


@query(rf"SELECT doc_id, regexp_replace(text, '[{_SPACE}]+', ' ', 'g') AS text FROM documents")
def collapse_ws(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", text.collapse_ws(F.col("text")).alias("text"))


@query(r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7f]', '', 'g') AS text FROM documents")
def to_ascii(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", text.to_ascii(F.col("text")).alias("text"))


@query("""
SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), '') AS quality, length(coalesce(text, '')) AS chars
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def clean_text(spark, sf):
    d, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    return d.join(labels, "doc_id", "left").select(
        "doc_id",
        text.clean_text(F.col("quality")).alias("quality"),
        F.length(text.clean_text(F.col("text"))).cast("bigint").alias("chars"),
    )


@query(r"""
SELECT doc_id, nullif(regexp_extract(text, '@([\w.\-]+)', 1), '') AS domain,
  coalesce(nullif(regexp_extract(text, '<([^<>]+)>', 1), ''), NULL) AS bracketed
FROM documents""")
def sender_domain(spark, sf):
    d = read(spark, sf, "documents")
    return d.select(
        "doc_id",
        text.rx(F.col("text"), r"@([A-Za-z0-9_.\-]+)").alias("domain"),
        text.rx(F.col("text"), "<([^<>]+)>").alias("bracketed"),
    )


@query("""
SELECT p_partkey, replace(replace(replace(p_name, 'small', 'kecil'), 'large', 'besar'), 'ring', 'cincin')
  AS name FROM part""")
def translate_terms(spark, sf):
    p = read(spark, sf, "part")
    words = {"small": "kecil", "large": "besar", "ring": "cincin"}
    return p.select("p_partkey", text.translate_terms(F.col("p_name"), words).alias("name"))


_PUNCT = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~'']"""


def tokens_sql(col: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(regexp_replace(lower({col}), '{_PUNCT}', '', 'g'), "
        r"'[ \t\r\n\f\x0b]+'), lambda x: x <> '')"
    )


def words_sql(col: str) -> str:
    return f"regexp_extract_all(lower({col}), '[\\pL\\pN_]{{2,}}')"


@query(f"SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS tokens FROM documents")
def tokenize(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", F.array_join(text.tokenize(F.col("text")), " ").alias("tokens"))


@query(f"SELECT doc_id, array_to_string({words_sql('text')}, ' ') AS words FROM documents")
def word_tokens(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", F.array_join(text.word_tokens(F.col("text")), " ").alias("words"))


@query(f"""
SELECT conv_id, turn, array_to_string(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))]), '|')
  AS grams FROM (SELECT conv_id, turn, {words_sql('text')} AS w FROM conversations)""")
def ngrams(spark, sf):
    c = read(spark, sf, "conversations")
    words = c.select("conv_id", "turn", text.word_tokens(F.col("text")).alias("w"))
    return words.select(
        "conv_id", "turn", F.array_join(text.ngrams(F.col("w"), 1, 2), "|").alias("grams")
    )


@query("""
SELECT o_orderkey, a AS m1, a AS m2, a AS m2_whole, a AS m3, a AS m4, a AS m5, a AS m6, a AS m7, a AS m7_point,
  CAST(NULL AS DOUBLE) AS broken, 'IDR' AS code, '$' AS other, 'Rp' AS sign, a AS number, a AS digits
FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS DOUBLE) AS a FROM orders)""")
def parse_money(spark, sf):
    """Every style: the amount of each order written in that style and read back."""
    amount = F.floor("o_totalprice")
    grouped = F.format_number(amount, 0)
    dotted = F.translate(grouped, ",", ".")
    plain = amount.cast("string")
    texts = read(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(grouped, F.lit(".00")).alias("m1"),
        F.concat(dotted, F.lit(",00")).alias("m2"),
        F.concat(dotted, F.lit(",99")).alias("m2_whole"),
        dotted.alias("m3"),
        F.when(F.col("o_orderkey") % 2 == 0, grouped).otherwise(dotted).alias("m4"),
        F.concat(plain, F.lit(",00")).alias("m5"),
        F.concat(F.translate(grouped, ",", " "), F.lit(".00")).alias("m6"),
        F.concat(dotted, F.lit(",00")).alias("m7"),
        F.concat(plain, F.lit(".00")).alias("m7_point"),
        F.concat(plain, F.lit("x")).alias("broken"),
        F.concat(F.lit("Rp"), plain).alias("signed"),
        F.concat(F.lit("Rp "), plain, F.lit("/month")).alias("noisy"),
    )
    styles = {"m1": "M1", "m2": "M2", "m3": "M3", "m4": "M4", "m5": "M5", "m6": "M6", "m7": "M7"}
    styles |= {"m7_point": "M7", "broken": "M1"}
    sign, number = money.split_at_digit(F.col("signed"))
    return texts.select(
        "o_orderkey",
        *(money.parse_money(F.col(c), s).cast("double").alias(c) for c, s in styles.items()),
        money.parse_money(F.col("m2_whole"), "M2", whole=True).cast("double").alias("m2_whole"),
        money.currency_code(F.lit("Rp.")).alias("code"),
        money.currency_code(F.lit("$")).alias("other"),
        sign.alias("sign"),
        money.parse_money(number, "M4").cast("double").alias("number"),
        money.parse_money(money.keep_number(F.col("noisy")), "M1").cast("double").alias("digits"),
    )


_TS = "o_orderdate + to_seconds(o_orderkey * 37 % 86400)"


@query(f"""
SELECT o_orderkey, s AS d1, m AS d2, m AS d3, m AS d4, d AS d5, d AS d6, s AS d7, d AS d8, m AS d9, y AS d10,
  m AS d11, d AS d12, d AS d13, s AS d14, s AS id_month, s AS id_short, CAST(NULL AS VARCHAR) AS broken, stamp
FROM (SELECT o_orderkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS s,
    strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS m,
    strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS d,
    strftime(date_trunc('minute', ts + CASE WHEN year(ts) < 2000 THEN INTERVAL 100 YEAR
      ELSE INTERVAL 0 YEAR END), '%Y-%m-%d %H:%M:%S') AS y,
    strftime(ts, '%Y%m%d%H%M') AS stamp
  FROM (SELECT o_orderkey, {_TS} AS ts FROM orders))""")
def parse_dates(spark, sf):
    """Every date shape: the time of each order written that way and read back."""
    base = read(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") * 37 % 86400)).alias("ts"),
    )
    local = {en: idn for idn, en in dates.INDONESIAN_MONTHS.items()}
    short = {en: idn for idn, en in reversed(dates.INDONESIAN_SHORT_MONTHS.items())}
    days = {en: idn for idn, en in dates.INDONESIAN_WEEKDAYS.items()}

    def put(fmt: str) -> F.Column:
        return F.date_format("ts", fmt)

    def swap(c, mapping):
        return F.create_map(*(F.lit(x) for p in mapping.items() for x in p))[c]

    month, mon, weekday = put("MMMM"), put("MMM"), put("EEEE")
    shapes = {
        "d1": (put("d MMM yyyy HH:mm:ss"), ("d MMM yyyy H:mm:ss",)),
        "d2": (put("dd MMM yyyy HH:mm"), ("d MMM yyyy H:mm",)),
        "d3": (put("d MMMM yyyy HH:mm"), ("d MMMM yyyy H:mm",)),
        "d4": (F.lower(put("d MMM, yyyy h:mma")), ("d MMM, yyyy h:mma",)),
        "d5": (put("MM/dd/yyyy"), ("MM/dd/yyyy",)),
        "d6": (put("MMMM d, yyyy"), ("MMMM d, yyyy",)),
        "d7": (F.concat(put("yyyy-MM-dd HH:mm:ss"), F.lit(" (UTC)")), ("yyyy-MM-dd H:mm:ss",)),
        "d8": (put("dd/MM/yyyy"), ("dd/MM/yyyy",)),
        "d9": (put("d MMM yyyy, HH:mm"), ("d MMM yyyy, H:mm",)),
        "d10": (put("dd MMM yy HH:mm"), ("d MMM yy H:mm",)),
        "d11": (
            F.concat(swap(weekday, days), F.lit(", "), put("d "), swap(month, local), put(" yyyy, HH:mm"), F.lit(" WIB")),
            ("d MMMM yyyy, H:mm",),
        ),
        "d12": (put("d MMMM yyyy"), ("d MMMM yyyy",)),
        "d13": (
            F.when(F.col("o_orderkey") % 2 == 0, put("d MMM yyyy")).otherwise(put("d MMMM yyyy")),
            ("d MMMM yyyy", "d MMM yyyy"),
        ),
        "d14": (F.concat_ws(" ", put("yyyy-MM-dd"), put("HH:mm:ss")), ("yyyy-MM-dd H:mm:ss",)),
        "id_month": (
            F.concat(put("d "), swap(month, local), put(" yyyy HH:mm:ss"), F.lit(" WIB")),
            ("d MMMM yyyy H:mm:ss",),
        ),
        "id_short": (
            F.concat(put("d "), swap(mon, short), put(" yyyy HH:mm:ss"), F.lit(" GMT+7")),
            ("d MMM yyyy H:mm:ss",),
        ),
        "broken": (put("d 'Foo' yyyy"), ("d MMM yyyy",)),
    }
    written = base.select("o_orderkey", "ts", *(c.alias(n) for n, (c, _) in shapes.items()))
    return written.select(
        "o_orderkey",
        *(
            F.date_format(dates.parse_local_ts(F.col(n), *fmts), "yyyy-MM-dd HH:mm:ss").alias(n)
            for n, (_, fmts) in shapes.items()
        ),
        dates.timestamp_id(F.col("ts")).alias("stamp"),
    )


@query("""
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(day(ts) AS INTEGER) AS day_of_month,
  CAST(week(ts) AS INTEGER) AS week_of_year, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM events""")
def datetime_features(spark, sf):
    e = read(spark, sf, "events").select("event_id", "ts")
    return dates.datetime_features(e, "ts").drop("ts")
