"""Vocabularies, token sequences and TF-IDF.

Fitting shuffles terms. A vocabulary that is counted and small travels to the tasks as one value, and each document is
encoded where it is read, without a shuffle. A larger one is joined to the terms of the documents, with the same results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.functions.text import bind
from tillroll.operators.lookup import lookup, small
from tillroll.session import reliable_checkpoint

PAD, UNKNOWN = 0, 1


def _terms(tokens: str) -> Column:
    """One row per token. For a bare column Spark would infer a filter and tokenise every text twice."""
    return F.explode(F.filter(tokens, lambda t: t.isNotNull()))


def term_stats(df: DataFrame, id: str, tokens: str, unique: bool = False) -> DataFrame:
    """``(term, tf, df)``: occurrences, and documents with the term.

    ``unique`` says that every row is a document of its own. Then a document gives a row for each of its distinct terms,
    and one shuffle on the term is enough, which carries one row per task and term.
    """
    if unique:
        counted = F.filter(_runs(F.filter(tokens, lambda t: t.isNotNull())), lambda r: r["tf"] > 0)
        return df.select(F.inline(counted)).groupBy(F.col("value").alias("term")).agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    return (
        df.select(id, _terms(tokens).alias("term"))
        .groupBy(id, "term")
        .agg(F.count("*").alias("n"))
        .groupBy("term")
        .agg(F.sum("n").alias("tf"), F.count("*").alias("df"))
    )


def top_terms(stats: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent terms, ties to the later term. Each task keeps only its own best k."""
    return stats.orderBy(F.desc("tf"), F.desc("term")).limit(k)


def build_vocab(df: DataFrame, tokens: str, k: int = 1024, reserved: int = 2) -> DataFrame:
    """``(token, idx, tf)`` by falling frequency; ids below ``reserved`` stay free.

    ``k`` counts the reserved ids (padding and unknown), as the size of an embedding would.
    """
    counts = df.select(_terms(tokens).alias("term")).groupBy("term").agg(F.count("*").alias("tf"))
    best = reliable_checkpoint(top_terms(counts, k - reserved))
    # the window sees at most k rows
    rank = F.row_number().over(W.orderBy(F.desc("tf"), F.desc("term")))
    return best.select(
        F.col("term").alias("token"), (rank + F.lit(reserved - 1)).cast("int").alias("idx"), "tf"
    )


def _table(vocab: DataFrame, token: str, *values: str) -> Column:
    """A vocabulary as one value: hash buckets of small maps, as many as keep some four entries in each."""
    buckets = max(1, vocab.count() // 4)
    entry = F.struct(F.col(token), F.struct(*values))
    rows = (
        vocab.groupBy(F.pmod(F.hash(token), F.lit(buckets)).alias("b"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("m"))
        .agg(F.sort_array(F.collect_list(F.struct("b", F.map_entries("m").alias("m")))).alias("all"))
    )
    # buckets without an entry are empty, so that a bucket's number is its place
    empty = F.slice(F.element_at("all", 1)["m"], 1, 0)
    placed = F.reduce(
        "all",
        F.array().cast(rows.select(F.array(F.element_at("all", 1)["m"]).alias("x")).schema["x"].dataType),
        lambda acc, x: F.concat(acc, F.array_repeat(empty, x["b"] - F.size(acc)), F.array(x["m"])),
    )
    padded = F.concat(placed, F.array_repeat(empty, F.lit(buckets) - F.size(placed)))
    return rows.select(F.transform(padded, F.map_from_entries)).scalar()


def _entry(table: Column, term: Column) -> Column:
    """Values of a term in a table; NULL when it is not in the vocabulary."""
    return F.try_element_at(F.get(table, F.pmod(F.hash(term), F.size(table))), term)


def text_to_sequence(
    df: DataFrame, id: str, tokens: str, vocab: DataFrame, length: int = 24
) -> DataFrame:
    """``(id, sequence)``: token ids, 1 for unknown tokens, cut or padded with 0 to ``length``."""
    if not small(vocab.select("token", "idx")):
        return _joined_sequence(df.select(id, F.slice(tokens, 1, length).alias("_t")), id, vocab, length)
    held = df.select(id, F.slice(tokens, 1, length).alias("_t"), _table(vocab, "token", "idx").alias("_v"))
    ids = F.transform("_t", lambda t: F.coalesce(_entry(F.col("_v"), t)["idx"], F.lit(UNKNOWN)))
    padded = F.concat(ids, F.array_repeat(F.lit(PAD), length))
    return held.select(id, F.slice(padded, 1, length).alias("sequence"))


def _joined_sequence(heads: DataFrame, id: str, vocab: DataFrame, length: int) -> DataFrame:
    """Sequences by a join on the tokens. Equal rows are looked up once and given out as often as they occur."""
    once = heads.groupBy(id, "_t").agg(F.count("*").alias("_n"))
    each = once.select(id, "_t", "_n", F.posexplode_outer("_t").alias("_pos", "_term"))
    known = lookup(each, F.col("_term"), vocab, "token", {"_idx": "idx"})
    place = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("_idx", F.lit(UNKNOWN)).alias("_idx")))
    # at most ``length`` entries in a group
    back = known.groupBy(id, "_t", "_n").agg(F.array_sort(F.collect_list(place)).alias("_ids"))
    padded = F.concat(F.transform("_ids", lambda e: e["_idx"]), F.array_repeat(F.lit(PAD), length))
    sequence = F.when(F.col("_t").isNotNull(), F.slice(padded, 1, length))
    return back.select(id, sequence.alias("sequence"), F.explode(F.sequence(F.lit(1), "_n"))).drop("col")


def _runs(values: Column) -> Column:
    """Distinct values of an array without NULLs, with their counts, in time linear in its sorted length."""

    def counted(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1), lambda p: (p == 0) | (F.get(s, p) != F.get(s, p - 1))
        )
        return bind(
            starts,
            lambda at: F.transform(
                at,
                lambda p, j: F.struct(
                    F.get(s, p).alias("value"),
                    (F.coalesce(F.get(at, j + 1), F.size(s)) - p).alias("tf"),
                ),
            ),
        )

    # array_sort would compare by a lambda, which is most of the time
    return F.when(F.size(values) > 0, bind(F.sort_array(values), counted))


def idf_table(df: DataFrame, id: str, tokens: str, k: int, mode: str) -> DataFrame:
    """``(term, tf, df, idf)`` of the ``k`` most frequent terms."""
    n = df.agg(F.count("*")).scalar()
    docs = F.col("df")
    if mode == "count_log":
        idf = F.log1p(n / (docs + 1))
    elif mode == "smooth_l2":
        idf = F.log((n + 1) / (docs + 1)) + 1
    else:
        raise ValueError(f"unknown mode {mode}")
    best = top_terms(term_stats(df, id, tokens, unique=True), k)
    return reliable_checkpoint(best.withColumn("idf", idf))


def _joined_tfidf(df: DataFrame, id: str, tokens: str, table: DataFrame, mode: str) -> DataFrame:
    """TF-IDF by a join on the distinct terms of each document. Equal documents are weighed once."""
    runs = _runs(F.filter(tokens, lambda t: t.isNotNull()))
    terms = df.select(id, F.sha2(F.to_json(tokens), 256).alias("_doc"), F.inline(runs))
    once = terms.groupBy(id, "_doc", "value", "tf").agg(F.count("*").alias("_n"))
    known = lookup(once, F.col("value"), table, "term", {"_idf": "idf"}).where(F.col("_idf").isNotNull())
    weight = F.col("tf") * F.col("_idf")
    if mode == "smooth_l2":
        weight = weight / F.sqrt(F.sum(weight * weight).over(W.partitionBy(id, "_doc")))  # terms of one text
    out = known.withColumn("_w", weight)
    return out.select(
        id, F.col("value").alias("term"), F.col("_w").alias("value"), F.explode(F.sequence(F.lit(1), "_n"))
    ).drop("col")


def tfidf(
    df: DataFrame, id: str, tokens: str, k: int, mode: str = "count_log", fitted: DataFrame | None = None
) -> DataFrame:
    """Sparse ``(id, term, value)``; every row of ``df`` is one document.

    ``count_log``: count x ln(1 + N / (1 + df)). ``smooth_l2``: count x (ln((1+N)/(1+df)) + 1), each
    document scaled to length 1. Pass the :func:`idf_table` of a training frame as ``fitted`` to apply
    it to another frame.
    """
    table = fitted if fitted is not None else idf_table(df, id, tokens, k, mode)
    if not small(table.select("term", "idf")):
        return _joined_tfidf(df, id, tokens, table, mode)
    held = df.select(id, F.col(tokens).alias("_t"), _table(table, "term", "idf").alias("_v"))

    # Every array below is bound before a lambda uses it: an expression named inside a lambda would be
    # computed again for each element. The table is named once, so that it stays one constant and is
    # not copied into every row.
    def weigh(runs: Column) -> Column:
        return F.transform(
            runs,
            lambda r: F.struct(
                r["value"]["term"].alias("term"), (r["tf"] * r["value"]["idf"]).alias("value")
            ),
        )

    def scale(weighted: Column) -> Column:
        norm = F.sqrt(F.reduce(weighted, F.lit(0.0), lambda acc, w: acc + w["value"] * w["value"]))
        return bind(
            norm,
            lambda n: F.transform(
                weighted, lambda w: F.struct(w["term"].alias("term"), (w["value"] / n).alias("value"))
            ),
        )

    found = F.transform(
        "_t", lambda t: F.struct(t.alias("term"), _entry(F.col("_v"), t)["idf"].alias("idf"))
    )
    weighted = weigh(bind(F.filter(found, lambda f: f["idf"].isNotNull()), _runs))
    if mode == "smooth_l2":
        weighted = bind(weighted, scale)
    rows = held.select(id, weighted.alias("_w"))
    # a computed generator input: Spark would add a filter on a bare column and compute it twice
    return rows.select(id, F.inline(F.filter("_w", lambda w: w["value"].isNotNull())))


def positions(fitted: DataFrame) -> DataFrame:
    """``(term, pos, idf)``: an idf table with the place of each term in a vector, the most frequent one first."""
    rank = F.row_number().over(W.orderBy(F.desc("tf"), F.desc("term")))  # as many rows as a vector is long
    return fitted.select("term", (rank - 1).alias("pos"), "idf")


def tfidf_vector(df: DataFrame, tokens: Column, fitted: DataFrame, mode: str, out: str) -> DataFrame:
    """Add ``out``, the weights of a row's terms as an ``array<double>`` with a place for each term of ``fitted``.

    The same values as :func:`tfidf`, beside the row they belong to: no shuffle and no id is needed. NULL tokens and rows
    without a known term give zeros.
    """
    table = positions(fitted)
    k = table.count()
    if not k:
        return df.withColumn(out, F.array().cast("array<double>"))
    if not small(table):
        raise ValueError(f"{k} terms are too many for a vector; tfidf has them as rows")
    held = df.withColumns({"_tokens": F.coalesce(tokens, F.array().cast("array<string>")), "_terms": _table(table, "term", "pos", "idf")})
    found = F.filter(F.transform("_tokens", lambda t: _entry(F.col("_terms"), t)), lambda e: e.isNotNull())
    weights = bind(found, lambda f: F.transform(_runs(f), lambda r: F.struct(r["value"]["pos"].alias("pos"), (r["tf"] * r["value"]["idf"]).alias("w"))))
    if mode == "smooth_l2":

        def scale(ws: Column) -> Column:
            norm = F.sqrt(F.reduce(ws, F.lit(0.0), lambda acc, w: acc + w["w"] * w["w"]))
            return bind(norm, lambda n: F.transform(ws, lambda w: F.struct(w["pos"].alias("pos"), (w["w"] / n).alias("w"))))

        weights = bind(weights, scale)
    none = F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<double>"))
    placed = F.coalesce(F.map_from_entries(weights), none)
    dense = bind(placed, lambda m: F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.try_element_at(m, i), F.lit(0.0))))
    return held.withColumn(out, dense).drop("_tokens", "_terms")
