"""Tables beyond the broadcast bounds give the same rows as those within, and no key is dealt to one task."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import encode, lookup, split, vocab


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def both(monkeypatch):
    """Runs a step within the bounds and beyond them."""

    def run(step):
        with monkeypatch.context() as m:
            small = rows(step())
            m.setattr(lookup, "BROADCAST_ROWS", 1)
            return small, rows(step())

    return run


DOCS = [(1, ["a", "b", "a"]), (1, ["a", "b", "a"]), (1, ["c"]), (2, []), (3, None), (4, ["b", "z", "b", "c", "a"])]


def test_large_tables_give_the_same(spark, both):
    df = spark.createDataFrame([(i, "hot" if i % 3 else None if i % 2 else f"v{i}", i) for i in range(60)], "id int, c string, c_idx int")
    steps = [
        lambda: encode.encode_label(df, "c"),
        lambda: encode.encode_category(df, ["c"]),
        lambda: encode.decode_label(df, "c_idx", encode.fit_labels(df, "c")),
        lambda: split.split_stratified(df, "id", "c", 0.5),
        lambda: split.augment_synonyms(df, "id", "c", spark.createDataFrame([("hot", "warm"), ("v6", "six")], "word string, synonym string")),
    ]
    for step in steps:
        small, large = both(step)
        assert small == large and len(small) == 60


def test_large_vocabularies_give_the_same(spark, both):
    docs = spark.createDataFrame(DOCS, "id int, tokens array<string>")
    v = vocab.build_vocab(docs, "tokens", 5)
    small, large = both(lambda: vocab.text_to_sequence(docs, "id", "tokens", v, 4))
    assert small == large and len(small) == 6
    for mode in ("count_log", "smooth_l2"):
        small, large = both(lambda mode=mode: vocab.tfidf(docs, "id", "tokens", 3, mode).withColumn("value", F.round("value", 9)))
        assert small == large and len(small) == 8
    # more terms than fit into one value
    wide = spark.range(120_000).select("id", F.array(F.concat(F.lit("t"), "id")).alias("tokens"))
    out = vocab.text_to_sequence(wide, "id", "tokens", vocab.build_vocab(wide, "tokens", 130_000), 2)
    assert out.select(F.col("sequence")[0]).distinct().count() == 120_000


def test_rows_stay_where_they_are(spark, tmp_path):
    df = spark.range(100).select("id", F.lit("x").alias("c"))
    df.write.parquet(str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d"))
    labels = encode.fit_labels(read, "c")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = encode.encode_label(read, "c", labels={"c": labels})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_a_repeated_table_is_never_broadcast(spark, monkeypatch):
    """Before it is repeated it looks small enough for Spark to send it to every task by way of the driver."""
    df = spark.createDataFrame([(i, f"v{i % 7}") for i in range(60)], "id int, c string")
    table = spark.createDataFrame([(f"v{i}", i) for i in range(5)], "label string, idx int")
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 1)
    out = lookup.lookup(df, F.col("c"), table, "label", {"c_idx": "idx"})
    assert sorted((r.id, r.c_idx) for r in out.collect()) == [(i, i % 7 if i % 7 < 5 else None) for i in range(60)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
