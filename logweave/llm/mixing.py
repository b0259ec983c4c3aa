"""Mixing sources to target weights by weighted fair queueing.

Each source gets a target by its weight; what exceeds ``max_epochs`` times a
source's size is reshared among the others.  The documents of a source stand in
shuffled order (hash of id and text, so that repeated or null ids spread too).  A
document's virtual finish time is the source's cumulative words up to and including
it divided by the source's target, later epochs following on.  The copies of all sources are merged in the
order of virtual finish time.  The quota of a source makes the cut: its document
in service at virtual time 1 is cut to what the source has left.  The quotas sum to
the total budget at most, so truncating the stream there removes nothing more.

All steps are DataFrame operations.  Running sums never gather a source in one
task: rows are dealt into hash buckets, summed per bucket, and only the
bucket sums are accumulated.

Defined cases: a null text has size 0 and takes nothing; a null source is the
last source; repeated rows are documents of their own; an empty table or one
without words gives target and taken 0; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweave.llm.common import numbered, staged, words

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
ROWS_PER_BUCKET = 10_000
_BIG = "decimal(38,0)"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> tuple[DataFrame, int]:
    """(source, size) rows -> one row per source: source, source_size, target
    (double), quota (whole words); and the budget, which is all words.

    Sources in code-point order, null last, take ``weights`` in turn.  One row
    per source is all that the ranking window holds."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (rank % len(weights)).cast("int") + 1)
    per = staged(per.select("source", "source_size", weight.cast("bigint").alias("weight")),
                 "mix-sources")
    cap = max_epochs * F.col("source_size")
    whole, all_weight = _sums(per.agg(F.sum("source_size"), F.sum("weight")))
    rest, total = whole, max(all_weight, 1)
    while True:     # one scalar aggregate per round; capped sources leave the sharing
        over = (F.lit(rest).cast(_BIG) * F.col("weight")) > cap.cast(_BIG) * F.lit(total)
        used, capped = _sums(per.filter(over).agg(F.sum(cap), F.sum("weight")))
        if (whole - used, max(all_weight - capped, 1)) == (rest, total):
            break
        rest, total = whole - used, max(all_weight - capped, 1)
    share = F.lit(rest).cast("bigint") * F.col("weight")
    target = F.when(over, cap.cast("double")).otherwise(
        share.cast("double") / F.lit(float(total)))
    quota = F.when(over, cap).otherwise(F.expr(f"({rest}L * weight) div {total}L"))
    return per.select("source", "source_size", target.alias("target"),
                      quota.cast("bigint").alias("quota")), whole


def _sums(df: DataFrame) -> tuple[int, int]:
    row = df.first()
    return int(row[0] or 0), int(row[1] or 0)


def _running(df: DataFrame, group: list[str], bucket: str, order: list, value: str,
             out: str) -> DataFrame:
    """Inclusive running sum of ``value`` in ``group`` by (bucket, order): one
    window per bucket plus the accumulated sums of the buckets before it."""
    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("_s"))
    before = (Window.partitionBy(*group) if group else Window).orderBy(bucket) \
        .rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col(bucket).alias("_b"),
                       F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base"))
    cond = F.col(bucket) == F.col("_b")
    for c in group:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    local = F.sum(value).over(Window.partitionBy(*group, bucket).orderBy(*order)
                              .rowsBetween(Window.unboundedPreceding, 0))
    return (df.withColumn("_local", local).join(base, cond)
            .withColumn(out, F.col("_local") + F.col("_base"))
            .drop("_local", "_base", "_b", *[f"_g_{c}" for c in group]))


def mix_stream(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
               max_epochs: int = MAX_EPOCHS) -> tuple[DataFrame, DataFrame]:
    """(rows, stream): ``rows`` has rid, doc_id, source, size, source_size,
    target per document; ``stream`` has rid, epoch, finish (virtual finish
    time), words (taken by this copy) and total (running words of the mix)."""
    docs = numbered(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("bigint").alias("size"),
        F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                       F.coalesce(F.col(text_col), F.lit(""))).cast("binary")).alias("key")),
        "mix-docs")
    targets, budget = source_targets(docs.select("source", "size"), weights, max_epochs)
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target", "quota")
    n = docs.count()
    digits = max(1, math.ceil(math.log(max(n, 1) / ROWS_PER_BUCKET + 1, 16)))
    placed = _running(docs.withColumn("bucket", F.substring("key", 1, digits)), ["source"],
                      "bucket", ["key", "size", "rid"], "size", "cum")
    placed = placed.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    rows = docs.join(t, F.col("source").eqNullSafe(F.col("t_source"))) \
        .select("rid", "doc_id", "source", "size", "source_size", "target")
    epochs = F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))
    served = placed.filter("size > 0").withColumn("epoch", epochs)
    start = F.col("epoch") * F.col("source_size") + F.col("cum") - F.col("size")
    served = served.withColumn("words", F.least("size", F.col("quota") - start)) \
        .filter("words > 0") \
        .withColumn("finish", (start + F.col("size")).cast("double") / F.col("target"))
    slots = max(1, n // ROWS_PER_BUCKET * max_epochs)
    served = served.select("rid", "epoch", "finish", "words", "key",
                           F.least(F.lit(2 * slots), F.floor(F.col("finish") * slots))
                           .cast("bigint").alias("slot"))
    stream = _running(served, [], "slot", ["finish", "key", "epoch", "rid"], "words", "total")
    left = F.lit(budget) - (F.col("total") - F.col("words"))
    stream = stream.filter(left > 0).withColumn("words", F.least("words", left))
    return rows, stream.select("rid", "epoch", "finish", "words", "total")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
                max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: the words that the mix
    takes of each document, repeats counted."""
    rows, stream = mix_stream(docs, id_col, text_col, source_col, weights, max_epochs)
    taken = stream.groupBy("rid").agg(F.sum("words").alias("taken"))
    return rows.join(taken, "rid", "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
