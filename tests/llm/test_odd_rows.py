"""Awkward rows of the earlier operators: huge components, hot lengths, long texts, repeated rows, clashing names."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import BYTE_BPE, LONG, PIECE_BPE, classes, frame, sha
from tillroll.llm import bpe, exact, jaccard, langid, mixing, tokens, topk


def test_top_k_of_huge_components(spark):
    """Exact, or brought into 64 bits; what has no 64-bit form takes no part."""
    r = random.Random(6)
    size = lambda: 10.0 ** r.choice([0, 0, 0, 0, 3, 6, 9, 12])
    rows = [(i, [r.uniform(-1, 1) * size() for _ in range(3)]) for i in range(300)]
    rows += [(400, [1e300, 1.0, 1.0]), (401, [1.0, float("inf"), 0.0]), (402, [1.0, None, 2.0]), (403, None), (404, [1e16, -1e16, 0.0]), (450, [1e16, 0.0, 1.0])]
    rows += [(50, rows[50][1]), (51, rows[51][1])]
    df = frame(spark, rows, "vec_id long, embedding array<double>")
    got = [(x.query_id, x["rank"], x.vec_id, x.score) for x in topk.top_k(df, 5, F.col("vec_id") % 50 == 0).collect()]
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows if v and None not in v and all(abs(256 * x) < 2**63 for x in v)}
    assert 404 in whole and 400 not in whole and 401 not in whole
    want = []
    for q in sorted(i for i in whole if i % 50 == 0):
        score = lambda v: max(min(sum(a * b for a, b in zip(whole[q], v)), 2**63 - 1), -(2**63))  # noqa: E731, B023
        scores = sorted((-score(v), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert sorted(got) == want


def test_exact_dedup_of_a_hot_length(spark):
    """All texts of one length, some of one prefix; long ones, null ids, repeated rows, clashing names."""
    r = random.Random(2)
    texts = [f"{r.randrange(40):064d}{r.randrange(3)}" for _ in range(600)] + [LONG, LONG, LONG[:-1] + "x", None, "", None]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(5, texts[5])] * 3 + [(None, LONG)]
    df = frame(spark, rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("size", "head", "n", "alike", "whole", "kept")})
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    want = []
    for ids in groups.values():
        keep = max((d for d in ids if d is not None), default=None)
        seen = False
        for d in sorted(ids, key=lambda d: (d is None, d)):
            kept = d == keep and not seen
            seen = seen or kept
            want.append((d, keep, len(ids), kept))
    out = exact.exact_duplicates(df).collect()
    assert sorted(((x.doc_id, x.keep_id, x.group_size, x.kept) for x in out), key=repr) == sorted(want, key=repr)
    left = exact.drop_exact_duplicates(df)
    assert left.columns == df.columns and left.count() == len(groups)


def test_documents_of_common_passages_stay_apart(spark):
    """Hundreds of documents that are a common passage and own words, or two of a few passages: few of them link."""
    r = random.Random(4)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    passages = [words(60) for _ in range(6)]
    rows = []
    for _ in range(250):
        rows.append(" ".join(passages[0] + words(r.randint(0, 24))))
    for _ in range(250):
        a, b = r.sample(passages, 2)
        rows.append(" ".join(a + b + words(r.randint(0, 10))))
    rows = list(enumerate(rows))
    out = jaccard.near_duplicates(frame(spark, rows, "doc_id long, text string"))
    assert {(x.doc_id, x.n_shingles, x.component_id) for x in out.collect()} == classes(rows)


def test_sketches_bound_from_below():
    r = np.random.default_rng(3)
    for _ in range(300):
        one, a, b = (r.integers(0, 1 << 63, size=n, dtype=np.uint64) for n in r.integers(0, 900, size=3))
        x, y = np.unique(np.concatenate((one, a))), np.unique(np.concatenate((one, b)))
        bits = [np.unpackbits(np.frombuffer(jaccard._sketch(s), np.uint8)) for s in (x, y)]
        assert (bits[0] ^ bits[1]).sum() <= len(np.setxor1d(x, y))


@pytest.fixture(scope="module")
def docs_of(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by = {r.lang: r.text for r in docs.where("length(text) > 2000").orderBy("doc_id").dropDuplicates(["lang"]).collect()}
    short = [r.text for r in docs.where("length(text) between 20 and 400").orderBy("doc_id").limit(12).collect()]
    mixed = [by["de"][:500] + " " + by["fr"][:300], by["en"][:100] + " " + by["es"][:600]]
    return langid.learn(docs, 9), [t[:600] for t in by.values()] + mixed + short


def slow_share(text, model, used):
    """Expectation-maximisation as the books have it, one document and one distribution at a time."""
    c = langid.counts([text.encode()])[0].astype(float)
    at = np.flatnonzero(c)
    share = {j: 1 / len(used) for j in used}
    for _ in range(2000):
        new = dict.fromkeys(used, 0.0)
        for b in at:
            mixed = sum(share[j] * model.theta[j, b] for j in used)
            for j in used:
                new[j] += c[b] * share[j] * model.theta[j, b] / mixed
        new = {j: v / c.sum() for j, v in new.items()}
        done = max(abs(new[j] - share[j]) for j in used) < 1e-7
        share = new
        if done:
            break
    return share, sum(c[b] * math.log(sum(share[j] * model.theta[j, b] for j in used)) for b in at)


def slow_choice(text, model):
    """Backward elimination by the penalised likelihood."""
    used = list(range(len(model.theta)))
    share, fit = slow_share(text, model, used)
    n = langid.counts([text.encode()])[0].sum()
    while len(used) > 1:
        fewer = [j for j in used if j != min(used, key=lambda j: share[j])]
        s, f = slow_share(text, model, fewer)
        if f + 0.5 * math.log(max(n, 2)) < fit:
            break
        used, share, fit = fewer, s, f
    return share


def test_language_choice_is_brute_force(docs_of):
    model, texts = docs_of
    got = langid.proportions(langid.counts([t.encode() for t in texts]), model)
    for t, share in zip(texts, got):
        want = slow_choice(t, model)
        best = max(want, key=want.get)
        assert int(share.argmax()) == best and abs(share[best] - want[best]) < 0.02


def test_languages_to_keep(spark, sf, docs_of):
    model, texts = docs_of
    df = frame(spark, [(i, t, "xx", None) for i, t in enumerate([*texts, texts[0], None, "", "12"])]).withColumns({c: F.lit("clash") for c in ("other", "lang_pred", "score")})
    every = langid.keep_languages(df, model, into="lang")
    assert every.columns == df.columns and every.count() == len(texts) + 1
    found = {r.doc_id: r.lang for r in every.collect()}
    assert found[0] == found[len(texts)] and set(found.values()) <= set(model.labels) and {r.other for r in every.collect()} == {"clash"}
    some = langid.keep_languages(df, model, wanted=["de", "fr"])
    assert {r.doc_id for r in some.collect()} == {d for d, l in found.items() if l in ("de", "fr")} and {r.lang for r in some.collect()} <= {"xx"}


def test_round_trip_and_token_counts_of_odd_rows(spark):
    from tokenizers import Tokenizer

    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "é"), (4, LONG)]
    df = frame(spark, rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("n_tokens", "ids_sha256", "n_bytes")})
    library = Tokenizer.from_file(BYTE_BPE)
    out = bpe.round_trip(df, BYTE_BPE)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in out.collect():
        ids = library.encode(r.text or "").ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(r.text or ""))
    assert bpe.round_trip(df.limit(0), BYTE_BPE).count() == tokens.token_counts(df.limit(0), PIECE_BPE).count() == 0
    counted = tokens.token_counts(df, PIECE_BPE).collect()
    assert len(counted) == len(rows) and len({(r.n_bytes, r.n_tokens) for r in counted if r.doc_id == 3}) == 1


def test_mixture_of_repeated_ids(spark):
    rows = [(1, "a b c", "x", "s"), (1, "a b c", "x", "s"), (2, "d e", "x", "s"), (2, "f g h i", "x", "t"), (None, "j", "x", None)]
    got = mixing.mix_sources(frame(spark, rows)).collect()
    assert sorted((r.size, r.source_size) for r in got) == [(1, 1), (2, 8), (3, 8), (3, 8), (4, 4)]
    assert all(r.taken <= 3 * r.size and r.taken % r.size == 0 for r in got)
    assert len({r.taken for r in got if r.size == 3}) == 1


def test_pipeline_with_repeated_rows_and_clashing_columns(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    more = docs.union(docs.limit(40)).withColumns({c: F.lit("clash") for c in ("size", "node", "g", "other", "taken", "row", "component_id")})
    more.write.parquet(str(tmp_path / "documents.parquet"))
    once = {r.doc_id for r in corpus_pipeline.near_copies(spark, corpus_pipeline.exact_copies(spark, docs, sf), sf).collect()}
    step = more
    for name, stage in corpus_pipeline.STAGES[:3]:
        step = stage(spark, step, sf)
        assert step.columns == more.columns, name
    ids = [r.doc_id for r in step.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == once
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
