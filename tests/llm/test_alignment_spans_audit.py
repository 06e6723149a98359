"""Operators 11 to 13 against brute force, with nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing names."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import BYTE_BPE, LONG, PIECE_BPE, WORD, frame, odd_texts, sha
from tillroll.llm import align, audit, bpe, substrings, suite

# --- 11: alignment ---


def _ends(r, n):
    return np.array(sorted({n} | {r.randint(1, n) for _ in range(r.randint(0, 20))}))


def test_merge_path_is_brute_force():
    r = random.Random(1)
    for _ in range(400):
        n = r.randint(1, 40)
        a, b = _ends(r, n), _ends(r, n)
        spans = [[(s, e) for s, e in zip([0, *x.tolist()], x.tolist())] for x in (a, b)]
        want = {(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if max(x[0], y[0]) < min(x[1], y[1])}
        common = [(a.tolist().index(v), b.tolist().index(v)) for v in sorted({*a.tolist()} & {*b.tolist()})]
        for size in (1, 2, 3, 7, 100):
            i, j, x, y = align.merge(a, b, size)
            assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want
            assert list(zip(x.tolist(), y.tolist())) == common
    assert all(len(x) == 0 for x in align.merge(a[:0], b[:0]))


def test_pieces_are_of_equal_work():
    r = random.Random(2)
    a, b = _ends(r, 10_000), np.arange(1, 10_001)
    total = len(a) + len(b)
    at = np.append(np.arange(0, total, 64), total)
    i = align.diagonals(a, b, at)
    assert i[0] == 0 and i[-1] == len(a) and (np.diff(i) >= 0).all() and (np.diff(at - i) >= 0).all()
    merged = sorted([(v, 0) for v in a.tolist()] + [(v, 1) for v in b.tolist()])
    assert [sum(k == 0 for _, k in merged[:d]) for d in at.tolist()] == i.tolist()


def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    one.encode_special_tokens = True
    letters = bpe._byte_letters()
    raw_a = lambda i: bytes(letters[c] for c in one.id_to_token(i))
    raw_b = lambda i: bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
    out, held = [], Counter()
    for t in texts:
        a, b = (one.encode(" " + t, add_special_tokens=False).ids, two.encode(t)) if t else ([], [])
        x, y = [raw_a(i) for i in a], [raw_b(i) for i in b]
        if b"".join(x) != (" " + (t or "")).encode() or b"".join(y) != b"".join(x):
            out.append(([], [], [], ""))
            continue
        groups, links, i, j, p, q, begin = [], [], 0, 0, 0, 0, (0, 0)
        while i < len(a):
            links.append((a[i], b[j]))
            ends = p + len(x[i]), q + len(y[j])
            if ends[0] <= ends[1]:
                p, i = ends[0], i + 1
            if ends[1] <= ends[0]:
                q, j = ends[1], j + 1
            if p == q:
                groups.append((a[begin[0] : i], b[begin[1] : j]))
                begin = (i, j)
        written = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        out.append((a, b, links, written))
        held.update(set(links))
    top = defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    return [
        (len(a), len(b), written.count(";") + 1 if a else 0, len(links), sum(held[k] == top[k[0]] for k in links), sum(held[k] for k in links), written)
        for a, b, links, written in out
    ]


_COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("hot", [align.HOT, 60])
def test_alignment_is_brute_force(spark, hot):
    """Also where most pairs are joined and not broadcast."""
    texts = [None, *odd_texts(), "a▁b", "<s> [INST] </s>", "  two  spaces ", LONG[:3000], LONG[:3000]]
    df = frame(spark, list(enumerate(texts)), "doc_id long, text string").withColumn("row", F.lit("clash")).withColumn("pairs", F.lit(1)).withColumn("n_a", F.lit("clash"))
    out = align.align(df.repartition(3), BYTE_BPE, PIECE_BPE, hot=hot)
    assert out.columns == ["doc_id", "text", "row", "pairs", "n_a", "n_b", "n_groups", "n_links", "groups", "count_sum", "n_best"]
    rows = sorted(out.collect())
    assert [tuple(r[c] for c in _COLUMNS) for r in rows] == brute_alignment(texts)
    assert all((r.row, r.pairs) == ("clash", 1) for r in rows)
    assert rows[0].groups == rows[-4 - 1].groups == "" and rows[-5].text == "a▁b"


def test_op11(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = brute_alignment([d.text for d in docs])
    got = {r.doc_id: r for r in suite.op11_align(spark, sf).collect()}
    assert len(got) == len(docs)
    for d, w in zip(docs, want):
        r = got[d.doc_id]
        assert tuple(r[c] for c in _COLUMNS[:-1]) == w[:-1]
        assert r.groups_sha256 == (sha(w[-1]) if w[-1] else "")


def test_the_faster_library_is_the_same():
    both = align.vocabularies(BYTE_BPE, PIECE_BPE)
    old = [chr(c) for c in range(0x250) if align._OLD.fullmatch(chr(c))]
    texts = [t for c in old for t in (c, f"a{c}b", f" {c} ", f"{c}{c}1", f"1{c} x", f"!{c}", f"{c}'s", f"'{c}")] + ["x" * 50_000, " " * 50_000]
    want = both.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
    assert [both.a_fast.encode_ordinary(" " + t) for t in texts] == [w.ids for w in want]


def test_alignment_of_nothing(spark):
    assert align.align(frame(spark, [], "doc_id long, text string"), BYTE_BPE, PIECE_BPE, digest=True).count() == 0
    rows = align.align(frame(spark, [(None, None), (None, ""), (1, "▁")], "doc_id long, text string"), BYTE_BPE, PIECE_BPE, digest=True).collect()
    assert {tuple(r[c] for c in _COLUMNS) for r in rows} == {(0, 0, 0, 0, 0, 0, "")} and len(rows) == 3


# --- 12: spans ---


def brute_spans(rows, span):
    first = {}
    words = [WORD.findall(t or "") for _, t in rows]
    for (d, t), w in zip(rows, words):
        if d is not None and t is not None:
            for i in range(len(w) - span + 1):
                k = tuple(w[i : i + span])
                first[k] = min(first.get(k, d), d)
    out = []
    for (d, t), w in zip(rows, words):
        gone = {i + j for i in range(len(w) - span + 1) if d is not None and first[tuple(w[i : i + span])] < d for j in range(span)}
        out.append((d, None if t is None else " ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return sorted(out, key=repr)


def spans_of(df, span):
    return sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in substrings.drop_repeated_spans(df, span).collect()), key=repr)


@pytest.mark.parametrize("span,kinds,shard,words", [(6, 256, 1 << 15, 6), (6, 1, 50, 3), (50, 3, 400, 400), (1, 256, 1 << 15, 30), (12, 2, 1 << 15, 2)])
def test_spans_are_brute_force(spark, monkeypatch, span, kinds, shard, words):
    """Overlapping windows, periodic texts, passages in many contexts, whatever goes through automata or by windows."""
    monkeypatch.setattr(substrings, "KINDS", kinds)
    monkeypatch.setattr(substrings, "SHARD", shard)
    r = random.Random(span * 7 + words)
    text = lambda n: [f"W{r.randrange(words)}" for _ in range(n)]
    passages = [text(n) for n in (span, span + 1, 3 * span, 2 * span, 200)]
    rows = []
    for d in range(120):
        w = text(r.randint(0, 2 * span))
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            cut = r.randint(0, 3)
            w += p[cut : len(p) - r.randint(0, 3)] + text(r.randint(0, span))
        rows.append((d, r.choice([" ", "\n", " \t "]).join(w)))
    rows += [(200, " ".join(["w0"] * 300)), (201, " ".join(["w0"] * 120)), (202, " ".join(["w0", "w1"] * 90)), (203, " ".join(["w1", "w0"] * 70))]
    rows += [(7, rows[3][1]), (3, rows[3][1]), (3, rows[9][1]), (300, None), (301, ""), (302, " \n"), (None, rows[5][1]), (None, None), (-5, rows[50][1])]
    rows += [(400, " ".join(w.upper() for w in rows[0][1].split()))]
    df = frame(spark, rows, "doc_id long, text string").withColumn("n_words", F.lit("clash")).withColumn("begin", F.lit("clash")).withColumn("spans", F.lit(0))
    assert spans_of(df, span) == brute_spans(rows, span)
    out = substrings.drop_repeated_spans(df, span)
    assert out.columns == ["doc_id", "text", "begin", "spans", "n_words", "n_removed"]
    assert spans_of(df.limit(0), span) == []


def test_spans_of_long_texts_and_other_ids(spark):
    r = random.Random(8)
    long = " ".join(f"x{r.randrange(10**6)}" for _ in range(60_000))
    rows = [("b", long), ("a", "own " * 3 + long[:20_000].rsplit(" ", 1)[0] + " end"), ("c", long[5000:])]
    got = {x.doc_id: (x.n_words, x.n_removed) for x in substrings.drop_repeated_spans(frame(spark, rows, "doc_id string, text string")).collect()}
    n = len(long[:20_000].rsplit(" ", 1)[0].split())
    assert got == {"a": (n + 4, 0), "b": (60_000, n), "c": (len(long[5000:].split()), len(long[5000:].split()) - (0 if long[4999] == " " or long[5000] == " " else 1))}


def test_automaton_is_brute_force():
    r = random.Random(5)
    for _ in range(200):
        rows = sorted((r.randrange(5), [r.randrange(3) for _ in range(r.randint(0, 12))]) for _ in range(r.randint(1, 6)))
        machine = substrings.Automaton()
        for owner, s in rows:
            machine.add(s, owner)
        machine.close()
        query, most = [r.randrange(4) for _ in range(20)], r.randint(1, 6)
        for end, (n, owner) in enumerate(machine.statistics(query, most), 1):
            found = [(k, o) for o, s in rows for k in range(1, most + 1) if k <= end and any(s[i : i + k] == query[end - k : end] for i in range(len(s) - k + 1))]
            assert n == max([k for k, _ in found], default=0)
            if n:
                assert owner == min(o for k, o in found if k == n)


# --- 13: audit ---


def brute_audit(rows, documents=10, shown=10):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        found = term.findall((text or "").translate(low))
        groups.add((lang or "", source or ""))
        n[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, d in docs[lang].items() if d >= documents)
        mine = {s: n[g, s] for g, s in groups if g == lang}
        size = {s: sum(c[t] for t in kept) for s, c in mine.items()}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (size[s] + 2 * len(kept)) for t in kept} for s, c in mine.items()}
        every = {t: sum(c[t] for c in mine.values()) for t in kept}
        q = {t: 1 + 10**9 * (every[t] + 2) // (sum(every.values()) + 2 * len(kept)) for t in kept}
        apart = lambda a, b: (a - b) ** 2 // (a + b)
        for s in mine:
            pairs = [(-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in mine if o != s]
            over = [(-apart(p[s][t], q[t]), t.encode(), t) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", over, shown)):
                out += [(lang, s, part, item, -v, rank) for rank, (v, _, item) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("block,tile", [(audit.BLOCK, audit.TILE), (3, 2), (16, 1)])
def test_audit_is_brute_force(spark, block, tile):
    r = random.Random(3)
    words = ["the", "The", "é", "中文", "naïve", "a_b", "x9y", "ÀÀ", "😀", "w"] + [f"t{chr(97 + i)}" for i in range(26)]
    rows = [(" ".join(r.choice(words) for _ in range(r.randint(0, 15))), r.choice(["en", "de"]), r.choice(["a", "b", "c", "B", "ß"])) for _ in range(300)]
    rows += [(None, "en", None), ("junk 12", None, None), ("", "fr", "only"), ("the the", "fr", "two"), ("x", "fr", "two"), (LONG[:5000], "en", "a")]
    rows += rows[:20]
    df = frame(spark, rows, "text string, lang string, source string").withColumn("term", F.lit("clash")).withColumn("value", F.lit(0))
    out = audit.audit(df.repartition(4), documents=4, block=block, tile=tile)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, out.collect())) == brute_audit(rows, 4)
    assert audit.audit(df.limit(0)).count() == 0


def test_shares_beyond_64_bits():
    values = np.array([0, 5, 3 * 10**12])
    assert audit.shares(values, 4 * 10**12, 7).tolist() == [1 + 10**9 * (v + 2) // (4 * 10**12 + 14) for v in values.tolist()]
    assert audit.shares(values[:2], 9, 7).tolist() == [1 + 10**9 * (v + 2) // 23 for v in (0, 5)]


def test_trees_share_nodes():
    counts = np.zeros((40, 1000), dtype=np.int64)
    counts[:, -3:] = np.arange(120).reshape(40, 3)
    trees = audit.Trees(counts)
    # besides what holds the last leaves of a group, each level has a node of zeros and maybe one of padding
    assert all(len(left) <= 40 * 2 + 3 for left, _ in trees.nodes)
    at, x, y, times = trees.pairs(0, np.arange(1, 40))
    assert len(at) <= 39 * 4 and times.sum() == 39 * 1000
    for h in range(1, 40):
        found = Counter()
        for a, i, j, n in zip(at.tolist(), x.tolist(), y.tolist(), times.tolist()):
            if a == h - 1:
                found[int(trees.values[i]), int(trees.values[j])] += n
        assert found == Counter(zip(counts[0].tolist(), counts[h].tolist()))


def test_terms():
    text = "The QUICK_brown9fox É\x7fß@[naïve]{中文} x"
    want = [t.translate(str.maketrans("TQUICK", "tquick")) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
    assert [t.decode() for t in audit.terms(text.encode())] == want
