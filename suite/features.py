"""Queries for vocabularies, encoders, statistics, splits and models, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.columns import read, tokens_sql, words_sql
from tillroll.functions import text
from tillroll.operators import aggregates, artefact, encode, model, split, vocab
from tillroll.session import checkpoint_root
from tillroll.sources import tables

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


def rounded(c: str, digits: int = 6) -> F.Column:
    return F.round(F.col(c), digits).alias(c)


# ---- terms -------------------------------------------------------------------------------------

_DOC_TOKENS = f"SELECT doc_id, unnest({tokens_sql('text')}) AS term FROM documents"


def _documents(spark, sf) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", text.tokenize(F.col("text")).alias("tokens"))


@query(f"SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM ({_DOC_TOKENS}) GROUP BY term")
def term_stats(spark, sf):
    return vocab.term_stats(_documents(spark, sf), "doc_id", "tokens", unique=True)


@query(f"""
SELECT term, count(*) AS tf, count(DISTINCT conv_id) AS df
FROM (SELECT conv_id, unnest({tokens_sql('text')}) AS term FROM conversations) GROUP BY term""")
def term_stats_grouped(spark, sf):
    """Documents made of several rows: the turns of a conversation count once per term."""
    c = read(spark, sf, "conversations").select("conv_id", text.tokenize(F.col("text")).alias("tokens"))
    return vocab.term_stats(c, "conv_id", "tokens")


_VOCAB = f"""
SELECT term AS token, CAST(row_number() OVER (ORDER BY tf DESC, term DESC) + 1 AS INTEGER) AS idx, tf
FROM (SELECT term, count(*) AS tf FROM ({_DOC_TOKENS}) GROUP BY term)
QUALIFY idx <= 1023"""


@query(_VOCAB)
def build_vocab(spark, sf):
    return vocab.build_vocab(_documents(spark, sf), "tokens", 1024)


@query(f"""
WITH v AS ({_VOCAB}),
t AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, {tokens_sql('text')} AS w FROM documents)),
f AS (SELECT doc_id, string_agg(CAST(coalesce(idx, 1) AS VARCHAR), ' ' ORDER BY pos) AS s, count(*) AS n
  FROM t LEFT JOIN v ON token = term WHERE pos <= 24 GROUP BY doc_id)
SELECT d.doc_id, trim(coalesce(s, '') || repeat(' 0', CAST(24 - coalesce(n, 0) AS INTEGER))) AS sequence
FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id""")
def text_to_sequence(spark, sf):
    d = _documents(spark, sf)
    out = vocab.text_to_sequence(d, "doc_id", "tokens", vocab.build_vocab(d, "tokens", 1024), 24)
    return out.select("doc_id", F.array_join(F.col("sequence").cast("array<string>"), " ").alias("sequence"))


def _tfidf_sql(terms: str, k: int, idf: str, normed: bool) -> str:
    value = "value / sqrt(sum(value * value) OVER (PARTITION BY doc_id))" if normed else "value"
    return f"""
WITH t AS ({terms}),
n AS (SELECT count(*) AS n FROM documents),
s AS (SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM t GROUP BY term),
v AS (SELECT term, {idf} AS idf FROM s, n ORDER BY tf DESC, term DESC LIMIT {k}),
w AS (SELECT doc_id, term, count(*) * any_value(idf) AS value FROM t JOIN v USING (term) GROUP BY ALL)
SELECT doc_id, term, round({value}, 6) AS value FROM w"""


_DOC_WORDS = f"SELECT doc_id, unnest({words_sql('text')}) AS term FROM documents"
_DOC_GRAMS = f"""
SELECT doc_id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) AS term
FROM (SELECT doc_id, {words_sql('text')} AS w FROM documents)"""
_LOG_IDF = "ln(1 + n / (1 + df))"
_SMOOTH_IDF = "ln((1 + n) / (1 + df)) + 1"


@query(_tfidf_sql(_DOC_TOKENS, 150, _LOG_IDF, False))
def tfidf_count_log(spark, sf):
    out = vocab.tfidf(_documents(spark, sf), "doc_id", "tokens", 150, "count_log")
    return out.select("doc_id", "term", rounded("value"))


@query(_tfidf_sql(_DOC_WORDS, 300, _SMOOTH_IDF, True))
def tfidf_smooth(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", text.word_tokens(F.col("text")).alias("tokens"))
    return vocab.tfidf(d, "doc_id", "tokens", 300, "smooth_l2").select("doc_id", "term", rounded("value"))


@query(_tfidf_sql(_DOC_GRAMS, 150, _SMOOTH_IDF, True))
def tfidf_bigrams(spark, sf):
    words = read(spark, sf, "documents").select("doc_id", text.word_tokens(F.col("text")).alias("w"))
    d = words.select("doc_id", text.ngrams(F.col("w"), 1, 2).alias("tokens"))
    return vocab.tfidf(d, "doc_id", "tokens", 150, "smooth_l2").select("doc_id", "term", rounded("value"))


# ---- encoders ----------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority_idx
FROM orders""")
def encode_label(spark, sf):
    o = read(spark, sf, "orders")
    return encode.encode_label(o, "o_orderpriority").select("o_orderkey", "o_orderpriority_idx")


@query("""
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS c_mktsegment_idx,
  CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS c_name_idx FROM customer""")
def encode_all_labels(spark, sf):
    c = read(spark, sf, "customer")
    out = encode.encode_label(c, "c_mktsegment", "c_name")
    return out.select("c_custkey", "c_mktsegment_idx", "c_name_idx")


@query("SELECT o_orderkey, o_orderpriority AS o_orderpriority_idx_label FROM orders")
def decode_label(spark, sf):
    o = read(spark, sf, "orders")
    labels = encode.fit_labels(o, "o_orderpriority")
    ids = encode.encode_label(o, "o_orderpriority", labels={"o_orderpriority": labels})
    return encode.decode_label(ids, "o_orderpriority_idx", labels).select(
        "o_orderkey", "o_orderpriority_idx_label"
    )


@query("""
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best FROM embeddings""")
def argmax(spark, sf):
    e = read(spark, sf, "embeddings")
    return e.select("vec_id", encode.argmax(F.col("embedding")).alias("best"))


@query("""
WITH p AS (SELECT o_orderpriority AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority DESC)
    AS INTEGER) AS i FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
s AS (SELECT o_orderstatus AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderstatus DESC)
    AS INTEGER) AS i FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT o_orderkey, coalesce(p.i, 0) AS o_orderpriority_id, coalesce(s.i, 0) AS o_orderstatus_id
FROM orders LEFT JOIN p ON o_orderpriority = p.v LEFT JOIN s ON o_orderstatus = s.v""")
def encode_category(spark, sf):
    """Fitted without one order state, which is then unknown (0) everywhere."""
    o = read(spark, sf, "orders")
    cols = ["o_orderpriority", "o_orderstatus"]
    fitted = encode.fit_categories(o.where("o_orderstatus <> 'P'"), cols)
    out = encode.encode_category(o, cols, fitted)
    return out.select("o_orderkey", "o_orderpriority_id", "o_orderstatus_id")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS "o_orderstatus_F",
  CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS "o_orderstatus_O" FROM orders""")
def one_hot(spark, sf):
    """A value outside the domain gives only zeros."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return encode.one_hot(o, "o_orderstatus", ["F", "O"]).drop("o_orderstatus")


_SIDES = ("train", "test")


@query("""
SELECT side, CAST(sum("F") AS BIGINT) AS "F", CAST(sum("O") AS BIGINT) AS "O",
  CAST(sum("P") AS BIGINT) AS "P" FROM (
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'test' ELSE 'train' END AS side,
    CAST(o_orderstatus = 'F' AS INTEGER) AS "F", CAST(o_orderstatus = 'O' AS INTEGER) AS "O",
    CAST(o_orderstatus = 'P' AS INTEGER) AS "P" FROM orders) GROUP BY side""")
def one_hot_aligned(spark, sf):
    """Frames with different values get the same columns."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sides = o.where("o_orderstatus <> 'P'"), o.where("o_orderstatus = 'P'")
    states = [r.value for r in encode.dummy_domain(sides, "o_orderstatus").collect()]
    both = encode.one_hot_aligned(*sides, {"o_orderstatus": states})
    frames = [f.withColumn("side", F.lit(side)) for f, side in zip(both, _SIDES, strict=True)]
    sums = [F.sum(f"o_orderstatus_{v}").alias(v) for v in ("F", "O", "P")]
    return frames[0].unionByName(frames[1]).groupBy("side").agg(*sums)


@query("""
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d, avg(o_custkey) AS cm,
  stddev_pop(o_custkey) AS cd FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS o_totalprice_scaled,
  round((o_custkey - cm) / cd, 6) AS o_custkey_scaled, CAST(0 AS DOUBLE) AS one_scaled FROM orders, s""")
def standard_scale(spark, sf):
    o = read(spark, sf, "orders").withColumn("one", F.lit(1.0))
    out = encode.standard_scale(o, ["o_totalprice", "o_custkey", "one"])
    return out.select(
        "o_orderkey", rounded("o_totalprice_scaled"), rounded("o_custkey_scaled"), "one_scaled"
    )


@query("""
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS o_totalprice_scaled FROM orders, s""")
def scale_with_fitted(spark, sf):
    """Statistics from one frame, applied to another."""
    o = read(spark, sf, "orders")
    stats = encode.fit_scaler(o.where("o_orderstatus = 'F'"), ["o_totalprice"])
    out = encode.standard_scale(o, ["o_totalprice"], stats)
    return out.select("o_orderkey", rounded("o_totalprice_scaled"))


@query("SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS o_totalprice_log FROM orders")
def amount_log(spark, sf):
    o = read(spark, sf, "orders")
    return encode.amount_log(o, "o_totalprice").select("o_orderkey", rounded("o_totalprice_log"))


@query("""
SELECT d.doc_id, source || ' - ' || CAST(quality AS VARCHAR) AS label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def flat_label(spark, sf):
    d = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id", "left")
    named = d.select("doc_id", F.col("source").alias("category"), F.col("quality").cast("string").alias("sub_category"))
    return encode.flat_label(named).select("doc_id", "label")


@query("SELECT o_orderkey, round(o_totalprice + o_custkey, 4) AS total FROM orders")
def assemble(spark, sf):
    o = read(spark, sf, "orders")
    v = vector_to_array(F.col("features"))
    out = model.assemble(o, ["o_totalprice", "o_custkey"])
    return out.select("o_orderkey", F.round(v[0] + v[1], 4).alias("total"))


# ---- statistics --------------------------------------------------------------------------------


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def category_counts(spark, sf):
    return aggregates.category_counts(read(spark, sf, "events"), "event_type")


@query("""
SELECT source, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 9) AS weight
FROM documents WHERE source IS NOT NULL GROUP BY source""")
def class_weights(spark, sf):
    out = aggregates.class_weights(read(spark, sf, "documents"), "source")
    return out.select("source", "n", rounded("weight", 9))


@query("""
SELECT count(*) AS n, round(avg(CAST(quality = toxic AS INTEGER)), 9) AS accuracy,
  round(avg(-ln(greatest(CASE WHEN quality = 1 THEN 0.8 ELSE 0.25 END, 1e-15))), 6) AS log_loss
FROM labels WHERE quality IS NOT NULL""")
def evaluate(spark, sf):
    scored = read(spark, sf, "labels").withColumn("p", F.when(F.col("quality") == 1, 0.8).otherwise(0.25))
    out = aggregates.evaluate(scored, "quality", "toxic", "p")
    return out.select("n", rounded("accuracy", 9), rounded("log_loss"))


# ---- splits and augmentation -------------------------------------------------------------------

_MD5 = "md5(concat_ws(':', CAST({0} AS VARCHAR), '42'))"
_PICK = "CAST(('0x' || substr(md5(concat_ws(':', CAST({0} AS VARCHAR), '{1}', '42')), 1, 8)) AS BIGINT)"


@query(f"""
SELECT o_orderkey, CAST(('0x' || substr({_MD5.format('o_orderkey')}, 1, 8)) AS BIGINT) % 1000000 < 800000
  AS is_train FROM orders""")
def split_frac(spark, sf):
    return split.split_frac(read(spark, sf, "orders"), "o_orderkey", 0.8).select("o_orderkey", "is_train")


@query(f"""
SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_MD5.format('o_orderkey')}, o_orderkey)
  <= round(count(*) OVER (PARTITION BY o_orderpriority) * 0.15) AS is_held FROM orders""")
def split_stratified(spark, sf):
    out = split.split_stratified(read(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 0.15)
    return out.select("o_orderkey", "is_held")


@query("SELECT doc_id, source FROM documents")
def shuffled(spark, sf):
    """All rows, reordered; the order itself is checked in the tests."""
    return split.shuffled(read(spark, sf, "documents").select("doc_id", "source"), "doc_id")


_SYNONYMS = {"ring": "band", "widget": "gadget", "small": "little", "large": "big", "plate": "dish", "band": "hoop"}
_SYN_SQL = ", ".join(f"('{w}', '{s}')" for w, s in _SYNONYMS.items())


def _round_sql(source: str, i: int) -> str:
    return f"""
SELECT a.p_partkey, list_transform(w, lambda x, j: CASE WHEN j - 1 = spot THEN coalesce(s, x) ELSE x END) AS w
FROM (SELECT p_partkey, w, {_PICK.format('p_partkey', i)} % len(w) AS spot FROM {source}) a
LEFT JOIN syn ON a.w[a.spot + 1] = syn.word"""


@query(f"""
WITH syn(word, s) AS (VALUES {_SYN_SQL}),
r0 AS (SELECT p_partkey, regexp_split_to_array(p_name, '\\s+') AS w FROM part),
r1 AS ({_round_sql('r0', 0)}), r2 AS ({_round_sql('r1', 1)})
SELECT p_partkey, array_to_string(w, ' ') AS p_name FROM r2""")
def augment_synonyms(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_name")
    table = spark.createDataFrame(list(_SYNONYMS.items()), "word string, synonym string")
    return split.augment_synonyms(p, "p_partkey", "p_name", table, n=2)


@query(f"""
WITH syn(word, s) AS (VALUES {_SYN_SQL}),
r0 AS (SELECT p_partkey, regexp_split_to_array(p_name, '\\s+') AS w FROM part), r1 AS ({_round_sql('r0', 0)})
SELECT p_name, count(*) AS n FROM (
  SELECT p_name FROM part UNION ALL SELECT array_to_string(w, ' ') AS p_name FROM r1) GROUP BY p_name""")
def augment_union(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_name")
    table = spark.createDataFrame(list(_SYNONYMS.items()), "word string, synonym string")
    more = split.augment_synonyms(p, "p_partkey", "p_name", table, n=1)
    return split.augment_union(p, more).groupBy("p_name").agg(F.count("*").alias("n"))


# ---- models and files --------------------------------------------------------------------------


def labelled_orders(spark, sf) -> DataFrame:
    """Orders with their customer as labelled transactions; the segment is the category."""
    o = read(spark, sf, "orders").join(
        spark.read.parquet(f"{sf}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey")
    )
    hint = F.concat_ws(" ", F.lower("c_mktsegment"), F.lit("shop"), F.pmod("o_custkey", F.lit(97)).cast("string"))
    return o.select(
        F.col("o_orderkey").alias("tx_id"),
        F.col("o_orderdate").alias("datetime"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("unknown shop")).otherwise(hint).alias("merchant"),
        F.concat_ws(" ", F.lit("order"), F.col("o_orderpriority")).alias("notes"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("payment_method"),
        F.lit("EXPENSE").alias("transaction_type"),
        F.lit(None).cast("string").alias("sub_category"),
        F.col("c_mktsegment").alias("category"),
    )


_GROUPS = model.FeatureGroups(categorical=("payment_method",))


def _feature_sql() -> str:
    """The vectors' length and sum, from the orders: scaled numbers, one dummy, weights of the terms of two texts."""
    numbers = {
        "year": "year(datetime)", "month": "month(datetime)", "dow": "isodow(datetime) - 1", "dom": "day(datetime)",
        "week": "week(datetime)", "weekend": "CASE WHEN isodow(datetime) >= 6 THEN 1 ELSE 0 END", "amount": "amount", "log": "ln(1 + amount)",
    }
    scaled = " + ".join(f"CASE WHEN d_{n} = 0 THEN 0 ELSE ({n} - m_{n}) / d_{n} END" for n in numbers)
    terms = "\nUNION ALL ".join(
        f"SELECT tx_id, '{c}' AS c, unnest({words_sql(c)}) AS term FROM l" for c in ("notes", "merchant")
    )
    return f"""
WITH l AS ({_LABELLED_SQL}),
x AS (SELECT tx_id, {", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in numbers.items())} FROM l),
m AS (SELECT {", ".join(f"avg({n}) AS m_{n}, stddev_pop({n}) AS d_{n}" for n in numbers)} FROM x),
t AS ({terms}),
n AS (SELECT count(*) AS n FROM l),
v AS (SELECT c, term, ln(1 + any_value(n.n) / (1 + count(DISTINCT tx_id))) AS idf FROM t, n GROUP BY c, term
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, term DESC) <= 150),
w AS (SELECT tx_id, sum(idf) AS w FROM t JOIN v USING (c, term) GROUP BY tx_id)
SELECT x.tx_id, CAST({len(numbers)} + (SELECT count(*) FROM v) + (SELECT count(DISTINCT payment_method) FROM l) AS INTEGER) AS width,
  round({scaled} + 1 + coalesce(w, 0), 4) AS total
FROM x CROSS JOIN m LEFT JOIN w USING (tx_id)"""


_LABELLED_SQL = """SELECT o_orderkey AS tx_id, o_orderdate AS datetime, o_totalprice AS amount, o_orderstatus AS payment_method,
  CASE WHEN o_orderkey % 5 = 0 THEN 'unknown shop' ELSE lower(c_mktsegment) || ' shop ' || CAST(o_custkey % 97 AS VARCHAR) END AS merchant,
  'order ' || o_orderpriority AS notes FROM orders JOIN customer ON o_custkey = c_custkey"""


def _vector_sums(features: model.Features, d: DataFrame) -> DataFrame:
    v = vector_to_array(F.col("features"))
    out = features.transform(d).select("tx_id", v.alias("v"))
    return out.select("tx_id", F.size("v").alias("width"), F.round(F.reduce("v", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query(_feature_sql())
def feature_vectors(spark, sf):
    d = labelled_orders(spark, sf)
    return _vector_sums(model.fit_features(d, _GROUPS), d)


def _saved(spark: SparkSession, table: DataFrame, kind: str, **params) -> artefact.Artefact:
    path = f"{checkpoint_root(spark)}/{kind}-{uuid.uuid4().hex}"
    artefact.save(table, path, kind, **params)
    return artefact.load(spark, path, kind)


@query(ORACLES["feature_vectors"])
def saved_features(spark, sf):
    """Fitted features written to files and read back."""
    d = labelled_orders(spark, sf)
    path = f"{checkpoint_root(spark)}/features-{uuid.uuid4().hex}"
    model.fit_features(d, _GROUPS).save(path)
    return _vector_sums(model.Features.load(spark, path), d)


@query(ORACLES["text_to_sequence"])
def saved_vocabulary(spark, sf):
    d = _documents(spark, sf)
    kept = _saved(spark, vocab.build_vocab(d, "tokens", 1024), "vocabulary", length=24)
    out = vocab.text_to_sequence(d, "doc_id", "tokens", kept.table, kept.params["length"])
    return out.select("doc_id", F.array_join(F.col("sequence").cast("array<string>"), " ").alias("sequence"))


@query(ORACLES["tfidf_smooth"])
def saved_idf(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", text.word_tokens(F.col("text")).alias("tokens"))
    kept = _saved(spark, vocab.idf_table(d, "doc_id", "tokens", 300, "smooth_l2"), "idf", mode="smooth_l2")
    out = vocab.tfidf(d, "doc_id", "tokens", 300, kept.params["mode"], fitted=kept.table)
    return out.select("doc_id", "term", rounded("value"))


@query(ORACLES["encode_all_labels"])
def saved_labels(spark, sf):
    c = read(spark, sf, "customer")
    fitted = encode.fit_all_labels(c, ["c_mktsegment", "c_name"])
    kept = {name: _saved(spark, table, "labels", column=name).table for name, table in fitted.items()}
    out = encode.encode_label(c, "c_mktsegment", "c_name", labels=kept)
    return out.select("c_custkey", "c_mktsegment_idx", "c_name_idx")


@query(ORACLES["encode_category"])
def saved_categories(spark, sf):
    o = read(spark, sf, "orders")
    cols = ["o_orderpriority", "o_orderstatus"]
    fitted = encode.fit_categories(o.where("o_orderstatus <> 'P'"), cols).select("col", "value", "n", "idx")
    out = encode.encode_category(o, cols, _saved(spark, fitted, "categories", columns=cols).table)
    return out.select("o_orderkey", "o_orderpriority_id", "o_orderstatus_id")


@query(ORACLES["scale_with_fitted"])
def saved_scaler(spark, sf):
    o = read(spark, sf, "orders")
    kept = _saved(spark, encode.fit_scaler(o.where("o_orderstatus = 'F'"), ["o_totalprice"]), "scaler")
    out = encode.standard_scale(o, ["o_totalprice"], kept.table)
    return out.select("o_orderkey", rounded("o_totalprice_scaled"))


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("""
SELECT c_mktsegment AS category, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY 1""")
def unknown_categories(spark, sf):
    """Labels outside the closed domain of spending categories, which has one of the segments."""
    return model.unknown_categories(labelled_orders(spark, sf))


def _category_run(spark, sf, **options) -> DataFrame:
    d = split.split_frac(labelled_orders(spark, sf), "tx_id", 0.8)
    fitted = model.train_category_model(d.where("is_train"), groups=_GROUPS, domain=_SEGMENTS, **options)
    path = f"{checkpoint_root(spark)}/model-{uuid.uuid4().hex}"
    fitted.save(path)
    held = model.predict_category(model.CategoryModel.load(spark, path), d.where("NOT is_train"))
    return aggregates.evaluate(held, "category", "predicted_category").drop("log_loss")


@query()
def category_logistic(spark, sf):
    """Train, save, load and score on held-out orders."""
    return _category_run(spark, sf, kind="logistic", max_iter=20)


@query()
def category_validated(spark, sf):
    """The regularisation picked on a share of the training rows."""
    return _category_run(spark, sf, kind="logistic", max_iter=10, validate=0.2)


@query()
def category_network(spark, sf):
    return _category_run(spark, sf, kind="mlp", hidden=(32,), max_iter=20)


@query("""
SELECT o_orderkey AS tx_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS datetime,
  CASE WHEN o_orderkey % 5 = 0 THEN 'unknown shop'
    ELSE lower(c_mktsegment) || ' shop ' || CAST(o_custkey % 97 AS VARCHAR) END AS merchant,
  'order ' || o_orderpriority AS notes, o_totalprice AS amount, o_orderstatus AS payment_method,
  'EXPENSE' AS transaction_type, CAST(NULL AS VARCHAR) AS sub_category, c_mktsegment AS category
FROM orders JOIN customer ON o_custkey = c_custkey""")
def labelled_files(spark, sf):
    """A labelled table written with the training files' column names and read back."""
    path = f"{checkpoint_root(spark)}/labelled-{uuid.uuid4().hex}"
    names = {"datetime": "Datetime", "merchant": "Merchant Name", "notes": "Notes", "amount": "Amount",
             "payment_method": "Payment Method", "transaction_type": "Transaction Type",
             "category": "Category", "tx_id": "Transaction ID"}
    d = labelled_orders(spark, sf).drop("sub_category").withColumnsRenamed(names)
    stamped = d.withColumn("Datetime", F.date_format("Datetime", "yyyy-MM-dd HH:mm:ss"))
    stamped.write.option("header", True).csv(path)
    back = tables.read_labelled(spark, path)
    return back.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
