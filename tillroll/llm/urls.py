"""URL filters by a sort-merge range join.

The labels of a host, last first, are its canonical key: a rule for a host and all its subdomains is then an
interval of keys, and intervals nest or lie apart. Rules and pages are dealt to ranges of keys, a rule to each
range that it reaches into, and sorted; one sweep over a range keeps the stack of rules that are open. A page is
held against the open rules only, and the longest whose path begins the page's path decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import ship

#: Keys that the bounds of the ranges are read off: those of the smallest hashes. They affect balance only.
SAMPLE = 20_000
_END = "\x02"  # ends a host's key; a label's end is \x01, so a host stands before its subdomains


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where it is null or has no ``://``.

    The host goes from the first ``://`` to the next ``/``, ``?``, ``#`` or the end, the path on to ``?`` or ``#``.
    """
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return _lower(host), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from last to first, each ended by a character that sorts before all others of a host."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\x01"), F.lit("\x01"))


def apply_rules(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to each row; columns of these names are replaced.

    ``rules`` has ``(host, path, verdict)``. A rule fits its host and all subdomains if the url's path begins with
    the rule's. The rule of the most characters (host and path) wins, then the one of the longer host, then the
    smaller text; ``rule`` is its host and path, null where none fits, and ``verdict`` then ``default``.

    A url that is null or has no ``://`` has an empty host and path and fits only rules for the empty host. Rules
    with a null host or path are left out; of rules for one host and path the smallest verdict counts. Repeated
    rows are judged each. A frequent host is dealt to several ranges.
    """
    spark = df.sparkSession
    ship(spark)
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    new = ("host", "path", "rule", "verdict")
    kept = [c for c in df.columns if c not in new]
    host, path = host_path(F.col(url))
    pages = df.select(F.struct(*kept).alias("row"), host.alias("host"), path.alias("path")).withColumn("key", host_key(F.col("host")))

    some = pages.select("key", F.xxhash64("row").alias("h")).orderBy("h", "key").limit(SAMPLE).select("key").toArrow()
    keys = np.sort(np.array([k.encode() for k in some.column(0).to_pylist()], dtype=object))
    bounds = [keys[i * len(keys) // parts] for i in range(1, parts)] if len(keys) else []

    rules = rules.where("host is not null and path is not null").groupBy(_lower(F.col("host")).alias("host"), "path").agg(F.min("verdict").alias("verdict"))
    rules = rules.withColumn("key", host_key(F.col("host")))
    none = F.lit(None)
    events = pages.select("row", "host", "path", none.cast("string").alias("verdict"), "key", F.xxhash64("row").alias("h"))
    events = events.unionByName(rules.select(none.cast(pages.schema["row"].dataType).alias("row"), "host", "path", "verdict", "key", F.lit(None).cast("long").alias("h")))
    dealt = events.mapInArrow(lambda b: _deal(b, bounds), T.StructType([*events.schema.fields, T.StructField("part", T.IntegerType())]))
    # rules sort before pages of the same key: their h is null
    swept = dealt.repartition(parts, "part").sortWithinPartitions("part", "key", F.col("h").asc_nulls_first())
    schema = T.StructType([*pages.schema.fields[:3], T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    out = swept.mapInArrow(lambda b: _sweep(b, default), schema)
    return out.select("row.*", "host", "path", "rule", "verdict")


def _deal(batches: Iterator[pa.RecordBatch], bounds: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Add the range of each row. A page whose key is a bound, or several, goes to one of the ranges there by its
    hash; a rule goes to every range that its interval reaches."""
    limits = np.array(bounds, dtype=object)
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [k.encode() for k in batch.column("key").to_pylist()]
        h = batch.column("h")
        low = np.searchsorted(limits, np.array(keys, dtype=object), side="left")
        high = np.searchsorted(limits, np.array(keys, dtype=object), side="right")
        take, part = [], []
        for i, (hash, a, b) in enumerate(zip(h.to_pylist(), low.tolist(), high.tolist())):
            if hash is None:
                b = int(np.searchsorted(limits, keys[i][:-1] + _END.encode(), side="right"))
                take += [i] * (b - a + 1)
                part += range(a, b + 1)
            else:
                take.append(i)
                part.append(a + hash % (b - a + 1))
        rows = batch.take(pa.array(take))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(part, pa.int32())], names=[*rows.schema.names, "part"])


def _sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and key: a rule opens at its own key and closes at the first key outside it."""
    stack: list[tuple[str, list[tuple[str, str, str]]]] = []  # (key, rules: path, text, verdict), outermost first
    at = None
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in ("host", "path", "verdict", "key", "part")}
        is_rule = batch.column("h").is_null().to_pylist()
        found: list[tuple[str | None, str]] = []
        pages = []
        for i, (part, key) in enumerate(zip(columns["part"], columns["key"])):
            if part != at:
                stack, at = [], part
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            host, path = columns["host"][i], columns["path"][i]
            if is_rule[i]:
                if not stack or stack[-1][0] != key:
                    stack.append((key, []))
                stack[-1][1].append((path, host + path, columns["verdict"][i]))
                continue
            fits = [(-len(text), -len(k), text, verdict) for k, rules in stack for p, text, verdict in rules if path.startswith(p)]
            best = min(fits, default=None)
            found.append((best[2], best[3]) if best else (None, default))
            pages.append(i)
        if pages:
            rows = batch.select(["row", "host", "path"]).take(pa.array(pages))
            new = [pa.array([f[k] for f in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *new], names=["row", "host", "path", "rule", "verdict"])
