"""The registered corpus queries at the smallest scale, against their SQL or a brute-force version."""

import hashlib
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import check
import corpus_pipeline
from tests.llm.test_operators import brute_lines, classes
from tillroll.llm import langid, suite


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(suite.ORACLES))
def test_query(spark, sf, db, name):
    df = suite.QUERIES[name](spark, sf)
    got = check.rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = db.execute(suite.ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == check.rows_of(columns, res.fetchall())


@pytest.fixture(scope="module")
def documents(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_op1(spark, sf, documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(suite.vocabulary_path("byte_bpe_50k.json"))
    rows = suite.op1_bpe(spark, sf).collect()
    assert len(rows) == len(documents)
    for r in rows:
        ids = t.encode(documents[r.doc_id].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(documents[r.doc_id].text.encode()).hexdigest()


def test_op4(spark, sf, documents):
    want = classes([(d, r.text) for d, r in documents.items()])
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in suite.op4_ngram_join(spark, sf).collect()} == want


def test_op7(spark, sf, documents):
    rows = suite.op7_language(spark, sf).collect()
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == documents[r.doc_id].lang for r in held) >= 0.95 * len(held)


def test_op9(spark, sf, documents):
    rows = suite.op9_line_dedup(spark, sf).collect()
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r.doc_id].text
        assert r.n_lines == len(text.split("\n"))
        assert (r.n_deleted > 0) or r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    want = brute_lines([(i, d.text) for i, d in documents.items()])
    assert {r.doc_id: (r.text_sha256, r.n_deleted) for r in rows} == {i: (hashlib.sha256(t.encode()).hexdigest(), n) for i, (t, n) in want.items()}


def test_op10(spark, sf, documents):
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=suite.vocabulary_path("piece_bpe_32k.model"))
    for r in suite.op10_token_counts(spark, sf).collect():
        text = documents[r.doc_id].text
        n = len(p.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)


def test_pipeline(spark, sf, documents):
    """Each stage against a plain version of it, on what the stage before kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = stage(spark, docs, sf).cache()
        after = Counter(r.doc_id for r in docs.collect())
        ids = Counter(r["doc_id"] for r in before)
        if name == "language ID":
            assert after == Counter({r["doc_id"]: 1 for r in before if any(c.isalpha() for c in r["text"] or "")})
        elif name == "exact dedup":
            last = {}
            for r in before:
                last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
            assert after == Counter(last.values())
        elif name == "n-gram Jaccard join":
            assert set(after) == {c for _, _, c in classes([(r["doc_id"], r["text"]) for r in before])} and max(after.values()) == 1
        elif name == "mixing sources":
            assert set(after) <= set(ids) and max(after.values()) <= 3
            words = sum(len(documents[d].text.split()) for d in ids)
            assert sum(n * len(documents[d].text.split()) for d, n in after.items()) == pytest.approx(words, rel=0.1)
        else:
            assert after == ids and "ids_sha256" in docs.columns
            break
        assert docs.columns == columns


def test_pipeline_on_odd_rows(spark, sf, tmp_path):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "the thing is that", "en", "a"), (4, "the thing is that", "en", None), (5, "7", None, "b")]
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text").cast("long")).write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {3, 4}
    empty = tmp_path / "empty"
    spark.createDataFrame([], schema).withColumn("n_chars", F.length("text").cast("long")).write.parquet(str(empty / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_registered():
    assert [q.split("_")[0] for q in suite.QUERIES] == [*(f"op{n}" for n in range(1, 14)), "pipeline"]
    assert langid.UNKNOWN == "und"
