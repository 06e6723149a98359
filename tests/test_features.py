import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from suite.features import _GROUPS, _SEGMENTS, labelled_orders
from tillroll.operators import aggregates, encode, model, split, titles, vocab


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    out = [(i, rng.choices(words, k=rng.randint(0, 60), weights=range(1, 41))) for i in range(50)]
    return [*out, (50, []), (51, ["w1"])]


@pytest.fixture(scope="module")
def frame(spark, docs):
    return spark.createDataFrame(docs, "id long, tokens array<string>").repartition(3)


def ranked(docs):
    tf = Counter(t for _, ts in docs for t in ts)
    return sorted(tf.items(), key=lambda p: (p[1], p[0]), reverse=True)


def test_term_stats_and_vocab(frame, docs):
    tf = Counter(t for _, ts in docs for t in ts)
    df = Counter(t for _, ts in docs for t in set(ts))
    for unique in (True, False):
        got = {r.term: (r.tf, r.df) for r in vocab.term_stats(frame, "id", "tokens", unique).collect()}
        assert got == {t: (tf[t], df[t]) for t in tf}
    got = [(r.token, r.idx) for r in vocab.build_vocab(frame, "tokens", 12).orderBy("idx").collect()]
    assert got == [(t, i + 2) for i, (t, _) in enumerate(ranked(docs)[:10])]


def test_sequences(frame, docs):
    v = vocab.build_vocab(frame, "tokens", 12)
    ids = {t: i + 2 for i, (t, _) in enumerate(ranked(docs)[:10])}
    got = {r.id: r.sequence for r in vocab.text_to_sequence(frame, "id", "tokens", v, 24).collect()}
    assert got == {i: ([ids.get(t, 1) for t in ts] + [0] * 24)[:24] for i, ts in docs}


@pytest.mark.parametrize("mode", ["count_log", "smooth_l2"])
def test_tfidf(frame, docs, mode):
    n, df = len(docs), Counter(t for _, ts in docs for t in set(ts))
    top = [t for t, _ in ranked(docs)[:15]]
    idf = {
        t: math.log(1 + n / (1 + df[t])) if mode == "count_log" else math.log((1 + n) / (1 + df[t])) + 1
        for t in top
    }
    want = {}
    for i, ts in docs:
        values = {t: c * idf[t] for t, c in Counter(ts).items() if t in idf}
        norm = math.sqrt(sum(v * v for v in values.values())) if mode == "smooth_l2" else 1
        want.update({(i, t): v / norm for t, v in values.items()})
    got = {(r.id, r.term): r.value for r in vocab.tfidf(frame, "id", "tokens", 15, mode).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_tfidf_fitted_on_train(frame, docs):
    table = vocab.idf_table(frame.where("id < 20"), "id", "tokens", 15, "count_log")
    got = vocab.tfidf(frame.where("id >= 20"), "id", "tokens", 15, "count_log", fitted=table)
    train = [d for d in docs if d[0] < 20]
    assert {r.term for r in got.collect()} <= {t for t, _ in ranked(train)[:15]}


def test_applying_a_vocabulary_does_not_shuffle(spark, frame, tmp_path):
    frame.write.parquet(str(tmp_path / "d"))
    vocab.build_vocab(frame, "tokens", 12).write.parquet(str(tmp_path / "v"))
    d, v = spark.read.parquet(str(tmp_path / "d")), spark.read.parquet(str(tmp_path / "v"))
    out = vocab.text_to_sequence(d, "id", "tokens", v)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


def test_encoders(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("b", 5.0), (None, 7.0)], "c string, x double")
    test = spark.createDataFrame([("c", 1.0), ("b", 3.0)], "c string, x double")
    labels = encode.fit_labels(train, "c")
    got = {r.c: r.c_idx for r in encode.encode_label(train, "c", labels={"c": labels}).collect()}
    assert got == {"a": 0, "b": 1, None: None}
    fitted = encode.fit_categories(train, ["c"])
    assert {r.c: r.c_id for r in encode.encode_category(test, ["c"], fitted).collect()} == {"c": 0, "b": 1}
    domain = [r.value for r in encode.dummy_domain((train, test), "c").collect()]
    left, right = encode.one_hot_aligned(train, test, {"c": domain})
    long = encode.one_hot_long(train, "x", ["c"]).orderBy("x").collect()
    assert [(r.x, r.column) for r in long] == [(1.0, "c_b"), (3.0, "c_a"), (5.0, "c_b")]
    assert left.columns[2:] == right.columns[2:] == ["c_a", "c_b", "c_c"]
    stats = encode.fit_scaler(train, ["x"])
    scaled = [r.x_scaled for r in encode.standard_scale(test, ["x"], stats).orderBy("x").collect()]
    assert scaled == pytest.approx([-3 / math.sqrt(5), -1 / math.sqrt(5)])
    flat = encode.standard_scale(train.withColumn("k", F.lit(2.0)), ["k"])
    assert {r.k_scaled for r in flat.collect()} == {0.0}
    p = spark.createDataFrame([([0.1, 0.7, 0.2],)], "p array<double>")
    assert p.select(encode.argmax(F.col("p")).alias("i")).first().i == 1


def test_class_statistics(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2 + [(None,)], "c string")
    assert [(r.c, r.n) for r in aggregates.category_counts(df, "c").collect()] == [("a", 6), ("b", 2)]
    got = {r.c: r.weight for r in aggregates.class_weights(df, "c").collect()}
    assert got == pytest.approx({"a": 8 / 12, "b": 8 / 4})
    scored = spark.createDataFrame([("a", "a", 0.5), ("b", "a", 0.25)], "l string, p string, q double")
    r = aggregates.evaluate(scored, "l", "p", "q").first()
    assert (r.n, r.accuracy) == (2, 0.5) and r.log_loss == pytest.approx(-(math.log(0.5) + math.log(0.25)) / 2)


def test_stratified_is_exact_with_a_hot_class(spark):
    label = F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "mid").otherwise("rare")
    df = spark.range(30_000).select("id", label.alias("c")).union(
        spark.createDataFrame([(-1, "single"), (-2, None)], "id long, c string")
    )
    out = split.split_stratified(df, "id", "c", 0.15)
    got = {r.c: (r.n, r.h) for r in out.groupBy("c").agg(F.count("*").alias("n"), F.count_if("is_held").alias("h")).collect()}
    assert got == {"hot": (21000, 3150), "mid": (6000, 900), "rare": (3000, 450), "single": (1, 0), None: (1, 0)}
    again = split.split_stratified(df.repartition(7), "id", "c", 0.15)
    assert again.exceptAll(out).count() == 0


@pytest.mark.parametrize("ranked", [1, 40, 20_000])
def test_quotas_are_refined(spark, ranked):
    """The same rows whatever is left to rank, also of ids that repeat."""
    label = F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 < 9, "mid").otherwise(None)
    df = spark.range(40_000).select("id", label.alias("c"))
    out = split.split_stratified(df, "id", "c", 0.15, ranked=ranked)
    digests = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i in range(40_000) if i % 10 < 8)
    assert {r.id for r in out.where("is_held AND c = 'hot'").collect()} == {i for _, i in digests[:4800]}
    assert out.where("is_held").count() == 4800 + 600 + 600 and out.count() == 40_000
    twice = df.union(df.limit(500)).union(spark.createDataFrame([(7, "rep")] * 300, "id long, c string"))
    held = split.split_stratified(twice, "id", "c", 0.5, ranked=ranked).where("c = 'rep'")
    assert held.where("is_held").count() == 150 and held.count() == 300
    for frac, n in ((0.0, 0), (1.0, 40_000)):
        assert split.split_stratified(df, "id", "c", frac, ranked=ranked).where("is_held").count() == n
    assert split.split_stratified(df.limit(0), "id", "c", 0.5, ranked=ranked).count() == 0


def test_split_and_shuffle(spark):
    df = spark.range(20_000)
    out = split.split_frac(df, "id", 0.8)
    assert abs(out.where("is_train").count() / 20_000 - 0.8) < 0.01
    assert split.split_frac(df.repartition(9), "id", 0.8).exceptAll(out).count() == 0
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    order = [r.id for r in split.shuffled(df, "id").collect()]
    assert sorted(order) == list(range(20_000)) and order != sorted(order)
    assert order == [r.id for r in split.shuffled(df.repartition(5), "id").collect()]


def test_synonyms(spark):
    df = spark.createDataFrame([(1, "big  red dog"), (2, ""), (3, None), (4, "cat")], "id long, t string")
    table = spark.createDataFrame([("cat", "feline"), ("feline", "felid"), ("cat", "zcat")], "word string, synonym string")
    got = {r.id: r.t for r in split.augment_synonyms(df, "id", "t", table, n=2).collect()}
    assert got == {1: "big red dog", 2: "", 3: "", 4: "felid"}
    both = split.augment_union(df, split.augment_synonyms(df, "id", "t", table))
    assert both.count() == 8


TITLES = [
    ("Internet Transaction Journal from:bca.co.id", True),
    ("Your Grab E-Receipt from:grab.com", True),
    ("OVO QR Payment Receipt from:ovo.co.id", True),
    ("Fwd: OVO QR Payment Receipt from:ovo.co.id", False),
    ("Market news of the day from:stocks.com", False),
    ("How to write better invoices (4/5) from:mail.x.com", False),
    ("Sari, here's your PIN 123 from:network.com", False),
    ("three favourite prompts for you from:y.com", False),
    ("New device accessing your account from:bca.co.id", False),
    ("Promo: 50% off receipt printers from:shop.com", False),
    ("Pesanan selesai: Transfer berhasil from:shop.com", False),
]


def test_weak_labels(spark):
    df = spark.createDataFrame(TITLES, "title string, want boolean")
    assert titles.weak_label(df).where("want <> is_transaction").count() == 0


def test_batches_have_the_asked_size(spark):
    df = spark.range(1000, numPartitions=2).select(F.col("id").cast("string").alias("title"))

    def label(batch):
        assert len(batch) <= 300
        return [len(batch) == 300] * len(batch)

    got = titles.label_batches(df, label)
    assert got.count() == 1000 and got.where("is_transaction").count() == 600


def test_title_model_beats_majority(spark, emails, tmp_path):
    from tillroll.functions.text import title_key

    df = titles.weak_label(
        emails.select("message_id", title_key(F.col("subject"), F.col("from_domain")).alias("title"))
    )
    fitted = titles.train_title_model(df)
    model.save_model(fitted, str(tmp_path / "m"))
    scored = titles.score_titles(
        model.load_model(str(tmp_path / "m")), df.withColumnRenamed("is_transaction", "want")
    )
    right = scored.where("want = is_transaction").count() / scored.count()
    assert right > 0.97


@pytest.mark.parametrize("kind", ["logistic", "mlp"])
def test_category_model_beats_majority(spark, sf, kind):
    df = labelled_orders(spark, sf).cache()
    fitted = model.train_category_model(
        df, kind=kind, groups=_GROUPS, domain=_SEGMENTS, hidden=(16,), max_iter=15, validate=0.2 if kind == "logistic" else 0.0
    )
    r = aggregates.evaluate(model.predict_category(fitted, df), "category", "predicted_category").first()
    most = df.groupBy("category").count().agg(F.max("count")).first()[0] / df.count()
    assert r.accuracy > most + 0.3
