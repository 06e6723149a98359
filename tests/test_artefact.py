"""Saved fitted tables, feature vectors and the closed domain of categories."""

import math
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillroll.operators import artefact, encode, model, vocab
from tillroll.schemas import CATEGORIES


def test_saved_is_loaded(spark, tmp_path):
    table = spark.createDataFrame([("a", 2, 5), ("b", 3, None), (None, 4, 1), ("b", 3, None)], "token string, idx int, tf bigint")
    path = str(tmp_path / "v")
    artefact.save(table.repartition(3), path, "vocabulary", length=24, note="é")
    kind, got, params = artefact.load(spark, path, "vocabulary")
    assert (kind, params) == ("vocabulary", {"length": 24, "note": "é"}) and got.schema == table.schema
    assert sorted(map(repr, got.collect())) == sorted(map(repr, table.collect()))
    artefact.save(table.limit(0), path, "vocabulary")  # replaces
    assert artefact.load(spark, path, "vocabulary").table.count() == 0


def test_what_is_not_the_artefact_is_refused(spark, tmp_path):
    table = spark.createDataFrame([("a", 1)], "label string, idx int")
    path = str(tmp_path / "l")
    artefact.save(table, path, "labels")
    with pytest.raises(ValueError, match="is a labels, not a idf"):
        artefact.load(spark, path, "idf")
    with pytest.raises(ValueError, match="unknown kind"):
        artefact.save(table, path + "x", "colours")
    with pytest.raises(ValueError, match="columns of vocabulary"):
        artefact.save(table, path + "x", "vocabulary")
    with pytest.raises(ValueError, match="columns of scaler"):
        artefact.save(table, path + "x", "scaler")
    table.union(table).write.mode("overwrite").parquet(path + "/table")
    with pytest.raises(ValueError, match="not the one"):
        artefact.load(spark, path, "labels")
    assert artefact.load(spark, path, "labels", verify=False).table.count() == 2
    spark.read.parquet(path + "/about").withColumn("version", F.lit(99)).write.parquet(path + "/other")
    spark.read.parquet(path + "/other").write.mode("overwrite").parquet(path + "/about")
    with pytest.raises(ValueError, match="version 99"):
        artefact.load(spark, path, "labels")
    table.write.parquet(str(tmp_path / "half") + "/table")  # a run that ended before the description
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        artefact.load(spark, str(tmp_path / "half"), "labels")


def test_fingerprints_follow_the_rows(spark):
    rows = [("a", 1, 0.5), ("b", None, None), (None, 2, float("nan"))]
    df = spark.createDataFrame(rows, "x string, y int, z double")
    same = spark.createDataFrame(rows[::-1], df.schema).repartition(3).select("z", "x", "y")
    assert artefact.fingerprint(df) == artefact.fingerprint(same)
    for other in (df.union(df.limit(1)), df.limit(2), df.withColumn("y", F.col("y") + 1), df.select("x", F.col("z").alias("y"), F.col("y").alias("z"))):
        assert artefact.fingerprint(df) != artefact.fingerprint(other)
    assert artefact.fingerprint(df.limit(0)) == "0:0"


@pytest.mark.parametrize("mode", ["count_log", "smooth_l2"])
def test_vectors_are_tfidf(spark, mode):
    docs = [(0, ["a", "b", "a"]), (1, []), (2, None), (3, ["c", "zz"]), (4, ["b", "c", "c", "c"]), (5, ["zz"])]
    df = spark.createDataFrame(docs, "id int, tokens array<string>")
    table = vocab.idf_table(df.where("id <> 5"), "id", "tokens", 3, mode)
    place = {r.term: r.pos for r in vocab.positions(table).collect()}
    assert place == {"c": 0, "b": 1, "a": 2}
    got = {r.id: r.v for r in vocab.tfidf_vector(df, F.col("tokens"), table, mode, "v").collect()}
    want = {i: [0.0] * 3 for i, _ in docs}
    for r in vocab.tfidf(df, "id", "tokens", 3, mode, fitted=table).collect():
        want[r.id][place[r.term]] = r.value
    assert {k: pytest.approx(v) for k, v in want.items()} == got
    none = vocab.idf_table(df.where("id = 1"), "id", "tokens", 3, mode)
    assert vocab.tfidf_vector(df, F.col("tokens"), none, mode, "v").first().v == []


def test_large_tables_of_terms_have_small_buckets(spark):
    words = spark.range(5000).select(F.concat(F.lit("w"), "id").alias("token"), F.col("id").cast("int").alias("idx"))
    df = spark.createDataFrame([(1, ["w17", "w4999", "nope", "w0"])], "id int, tokens array<string>")
    assert vocab.text_to_sequence(df, "id", "tokens", words, 5).first().sequence == [17, 4999, 1, 0, 0]
    sizes = df.withColumn("t", vocab._table(words, "token", "idx")).select(F.transform("t", F.size).alias("n")).first().n
    assert len(sizes) == 1250 and sum(sizes) == 5000 and max(sizes) < 20
    counts = Counter(t for _, ts in [(0, ["a", "b", "a"])] for t in ts)
    found = vocab.term_stats(spark.createDataFrame([(0, ["a", "b", "a", None])], "id int, tokens array<string>"), "id", "tokens", unique=True)
    assert {r.term: r.tf for r in found.collect()} == counts


GROUPS = model.FeatureGroups(categorical=("kind",), texts=("notes",), vocabulary=4)
ROWS = [
    ("2024-02-03 10:00:00", 10.0, "x", "red dog red", "FOOD"),
    ("2024-07-05 23:00:00", 0.0, "y", "red cat", "HEALTH"),
    (None, None, None, None, "FOOD"),
    ("2023-12-31 00:00:00", 5.5, "x", "", "FOOD"),
]


def labelled(spark, rows=ROWS):
    return spark.createDataFrame(rows, "t string, amount double, kind string, notes string, category string").withColumn("datetime", F.to_timestamp_ntz("t"))


def test_features_are_exact_and_persist(spark, tmp_path):
    df = labelled(spark)
    fitted = model.fit_features(df, GROUPS)
    fitted.save(str(tmp_path / "f"))
    again = model.Features.load(spark, str(tmp_path / "f"))
    assert again.groups == GROUPS and again.width == fitted.width == 8 + 3 + 3
    new = labelled(spark, [*ROWS, ("2024-01-01 00:00:00", 1.0, "unseen", "cat cat bird", None)]).withColumns({c: F.lit("clash") for c in ("f_stats", "f_domain", "f_value", "idx")})
    v = vector_to_array("features").alias("v")
    rows = [r.v for r in fitted.transform(new).select(v).collect()]
    assert rows == [r.v for r in again.transform(new).select(v).collect()]
    amounts = [10.0, 0.0, 0.0, 5.5]
    mean = sum(amounts) / 4
    std = math.sqrt(sum((a - mean) ** 2 for a in amounts) / 4)
    assert [r[6] for r in rows[:4]] == pytest.approx([(a - mean) / std for a in amounts])
    assert [r[8:11] for r in rows] == [[1, 0, 0], [0, 1, 0], [0, 0, 1], [1, 0, 0], [0, 0, 0]]  # x, then y before nan by name
    idf = {"red": math.log(1 + 4 / 3), "dog": math.log(1 + 4 / 2), "cat": math.log(1 + 4 / 2)}
    assert rows[0][11:] == pytest.approx([2 * idf["red"], idf["dog"], 0]) and rows[4][11:] == pytest.approx([0, 0, 2 * idf["cat"]])
    assert fitted.transform(df.limit(0)).count() == 0
    plan = fitted.transform(df)._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in plan


def test_labels_outside_the_domain_are_named(spark, tmp_path):
    df = labelled(spark, [*ROWS, (None, 1.0, "x", "a", "RENT"), (None, 1.0, "x", "a", "RENT"), (None, 1.0, "x", "a", None)])
    assert [(r.category, r.n) for r in model.unknown_categories(df).collect()] == [("RENT", 2)]
    with pytest.raises(ValueError, match=r"RENT \(2\)"):
        model.train_category_model(df, groups=GROUPS)
    fitted = model.train_category_model(labelled(spark), groups=GROUPS, max_iter=5)
    assert fitted.domain == tuple(sorted(CATEGORIES))
    fitted.save(str(tmp_path / "m"))
    again = model.CategoryModel.load(spark, str(tmp_path / "m"))
    out = model.predict_category(again, labelled(spark).withColumn("label", F.lit("clash")))
    assert {r.predicted_category for r in out.collect()} <= set(CATEGORIES) and out.columns[-2:] == ["probability", "predicted_category"]
    assert {r.label for r in out.collect()} == {"clash"}
    with pytest.raises(ValueError, match="unknown kind"):
        model.train_category_model(df, kind="tree")


def test_scalers_and_categories_by_file_are_their_twins(spark, tmp_path):
    df = labelled(spark)
    artefact.save(encode.fit_scaler(df, ["amount"]), str(tmp_path / "s"), "scaler")
    kept = artefact.load(spark, str(tmp_path / "s"), "scaler").table
    assert encode.standard_scale(df, ["amount"], kept).collect() == encode.standard_scale(df, ["amount"]).collect()
    cats = encode.fit_categories(df, ["kind", "category"]).select("col", "value", "n", "idx")
    artefact.save(cats, str(tmp_path / "c"), "categories")
    kept = artefact.load(spark, str(tmp_path / "c"), "categories").table
    assert encode.encode_category(df, ["kind", "category"], kept).collect() == encode.encode_category(df, ["kind", "category"], cats).collect()
