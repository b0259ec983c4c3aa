"""Delivery, latency and throughput metrics (AG6-AG10, SNK8).

Percentiles use the reference's nearest-rank rule: the value at index
``rint(p / 100 * (n - 1))`` (half-even) of the sorted values, 0.0 when empty.
The rank of every row inside its group comes from
:func:`logweave.operators.scan.prefix_sums`: a range shuffle on
``(group, value)`` splits even a single huge group over many tasks, so no
task sorts a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions.numeric import ratio_round, round_dp
from logweave.operators.scan import prefix_sums

MIB = 1024 * 1024


def outcome_counts(df: DataFrame, outcome_col: str) -> DataFrame:
    """Counter per outcome label (AG6)."""
    return df.groupBy(outcome_col).agg(F.count(F.lit(1)).alias("n"))


def delivery_metrics(df: DataFrame, group_cols: Sequence[str] = ("config",),
                     ok_col: str = "ok", bytes_col: str = "n_bytes",
                     time_col: str = "sent_epoch") -> DataFrame:
    """Producer delivery metrics per group (AG7): produced, delivered, failed,
    bytes_sent (delivered bytes), error_rate = failed / (delivered + failed)
    (4 dp), elapsed_s, throughput_msg_s (1 dp) and throughput_mb_s (3 dp,
    MiB); rates are 0.0 when no time elapsed."""
    ok = F.col(ok_col)
    agg = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("produced"),
        F.count_if(ok).alias("delivered"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok, F.col(bytes_col))), F.lit(0)).cast("bigint")
        .alias("bytes_sent"),
        (F.max(time_col) - F.min(time_col)).cast("bigint").alias("elapsed_s"))
    return agg.select(
        *group_cols, "produced", "delivered", "failed", "bytes_sent",
        ratio_round("failed", F.col("delivered") + F.col("failed"), 4).alias("error_rate"),
        "elapsed_s",
        ratio_round("delivered", "elapsed_s", 1).alias("throughput_msg_s"),
        ratio_round("bytes_sent", F.col("elapsed_s") * MIB, 3).alias("throughput_mb_s"))


def nearest_rank_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                             pcts: Sequence[float] = (50, 95, 99)) -> DataFrame:
    """Per group: n and the nearest-rank percentile values (AG8).

    Output: group columns, ``measured``, one ``p{p}`` column per percentile
    (raw values), ``max``.
    """
    g = list(group_cols)
    # One row per (group, value): a value that most rows share is collapsed
    # map-side, and only distinct values are ordered.
    counts = df.filter(F.col(value_col).isNotNull()).groupBy(*g, value_col) \
        .agg(F.count(F.lit(1)).alias("_n"))
    run = prefix_sums(counts.select(*g, value_col, "_n", F.lit(True).alias("_emit"),
                                    F.col("_n").alias("_upto")),
                      [*g, value_col], ["_upto"], "_emit", [*g, value_col, "_n"])
    # A group's values are contiguous in the global order.
    targets = run.groupBy(*g).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("measured"), F.max(value_col).alias("max"),
        F.min(F.col("_upto") - F.col("_n")).alias("_start"))
    wanted = targets.select(*g, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_i"),
                 (F.col("_start") + F.rint(F.lit(p / 100.0) * (F.col("measured") - 1))
                  .cast("bigint")).alias("_rank"))
        for i, p in enumerate(pcts)])).alias("_w")).select(*g, "_w._i", "_w._rank")
    hit = (F.col("_rank") >= F.col("_upto") - F.col("_n")) & (F.col("_rank") < F.col("_upto"))
    if not g:       # no rows: one row of zeros
        zero = F.lit(0).cast(df.schema[value_col].dataType)
        picked = run.join(F.broadcast(wanted), hit)      # len(pcts) rows
        found = picked.agg(*[F.coalesce(F.max(F.when(F.col("_i") == i, F.col(value_col))), zero)
                             .alias(f"p{_name(p)}") for i, p in enumerate(pcts)])
        return targets.select("measured", F.coalesce("max", zero).alias("max")).crossJoin(found)
    r, w = run.alias("r"), wanted.alias("w")
    same = hit
    for c in g:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"w.{c}"))
    found = r.join(w, same).groupBy(*[F.col(f"w.{c}").alias(f"_g_{c}") for c in g]).agg(
        *[F.max(F.when(F.col("_i") == i, F.col(f"r.{value_col}"))).alias(f"p{_name(p)}")
          for i, p in enumerate(pcts)])
    on = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in g]
    return targets.select(*g, "measured", "max").join(found, on).drop(*[f"_g_{c}" for c in g])


def _name(p: float) -> str:
    return str(int(p)) if float(p).is_integer() else str(p).replace(".", "_")


def latency_report(df: DataFrame, group_cols: Sequence[str] = ("config",),
                   value_col: str = "latency_ms") -> DataFrame:
    """measured, p50_ms, p95_ms, p99_ms, max_ms (3 dp) per group (AG9)."""
    r = nearest_rank_percentiles(df, group_cols, value_col, (50, 95, 99))
    return r.select(*group_cols, "measured",
                    *[round_dp(f"p{p}", 3).alias(f"p{p}_ms") for p in (50, 95, 99)],
                    round_dp("max", 3).alias("max_ms"))


def throughput_summary(df: DataFrame, group_cols: Sequence[str] = ("config",),
                       time_col: str = "sent_epoch", bytes_col: str = "n_bytes") -> DataFrame:
    """count, elapsed_s, msg_per_s (1 dp) and mb_per_s (2 dp) per group
    (AG10); zero-guarded like the reference."""
    agg = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("count"),
        (F.max(time_col) - F.min(time_col)).cast("bigint").alias("_el"),
        F.sum(bytes_col).cast("bigint").alias("_bytes"))
    return agg.select(*group_cols, "count", F.col("_el").cast("double").alias("elapsed_s"),
                      ratio_round("count", "_el", 1).alias("msg_per_s"),
                      ratio_round("_bytes", F.col("_el") * MIB, 2).alias("mb_per_s"))


def _fmt_int(c: Column) -> Column:
    return F.format_number(c.cast("bigint"), 0)


def bench_report(throughput: DataFrame, config_col: str = "config") -> DataFrame:
    """Markdown table rows of a throughput summary (SNK8):
    ``| config | count | elapsed | msg/s | MB/s |``."""
    return throughput.select(
        config_col,
        F.concat(F.lit("| "), F.col(config_col), F.lit(" | "), _fmt_int(F.col("count")),
                 F.lit(" | "), F.format_number(F.col("elapsed_s").cast("decimal(38,3)"), 3), F.lit(" | "),
                 _fmt_int(F.round(F.col("msg_per_s").cast("decimal(38,1)"), 0)),
                 F.lit(" | "), F.format_number(F.col("mb_per_s").cast("decimal(38,2)"), 2),
                 F.lit(" |")).alias("line"))


# The members of the result files.
THROUGHPUT_RESULT = ("config string, count bigint, elapsed_s double, msg_per_s double, "
                     "mb_per_s double")
LATENCY_RESULT = ("measured bigint, p50_ms double, p95_ms double, p99_ms double, max_ms double")


def _result_text(spark: SparkSession, path: str) -> Column:
    """The text of a result file as a scalar; null if it is absent."""
    try:
        found = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], "value string")
    return found.select(F.max("value")).scalar()


def report_document(spark: SparkSession, throughput_path: str, latency_path: str) -> DataFrame:
    """The benchmark report as an ordered document (SNK8): line_no, line.

    ``throughput_path`` is a JSON array with one object per configuration, ``latency_path``
    one JSON object.  A file that is absent, empty, no JSON or of the other kind makes its
    section say that there are no results; a missing member counts as 0, a missing
    configuration name as ``?``."""
    n = lambda c, kind: F.coalesce(c, F.lit(0).cast(kind))
    text = F.col("throughput")
    rows = F.when(F.json_array_length(text) > 0, F.from_json(text, f"array<struct<{_fields(THROUGHPUT_RESULT)}>>"))
    sweep = F.transform(rows, lambda r: F.concat(
        F.lit("| "), F.coalesce(r["config"], F.lit("?")), F.lit(" | "),
        F.format_number(n(r["count"], "bigint"), 0), F.lit(" | "),
        _plain(n(r["elapsed_s"], "double")), F.lit(" | "),
        F.format_number(F.bround(n(r["msg_per_s"], "double").cast("decimal(38,6)"), 0), 0), F.lit(" | "),
        n(r["mb_per_s"], "double").cast("decimal(38,2)").cast("string"), F.lit(" |")))
    first = _section("## Producer throughput (sweep)", F.concat(_lines(
        "| Config | Messages | Elapsed (s) | msg/s | MB/s |", "|---|---:|---:|---:|---:|"), sweep),
        "_No throughput results._")
    text = F.col("latency")
    one = F.when(F.json_object_keys(text).isNotNull(), F.from_json(text, LATENCY_RESULT))
    values = F.array(*[F.concat(F.lit(f"| {label} | "), n(one[c], kind).cast("string") if kind == "bigint"
                                else _plain(n(one[c], kind)), F.lit(" |"))
                       for label, c, kind in (("measured", "measured", "bigint"), ("P50", "p50_ms", "double"),
                                              ("P95", "p95_ms", "double"), ("P99", "p99_ms", "double"),
                                              ("max", "max_ms", "double"))])
    second = _section("## End-to-end latency", F.when(one.isNotNull(), F.concat(
        _lines("| Metric | Value (ms) |", "|---|---:|"), values)), "_No latency results._")
    texts = spark.range(1).select(_result_text(spark, throughput_path).alias("throughput"),
                                  _result_text(spark, latency_path).alias("latency"))
    return texts.select(F.posexplode(F.concat(_lines("# Benchmark Report", ""), first, second))
                        .alias("pos", "line")) \
        .select((F.col("pos") + 1).cast("bigint").alias("line_no"), "line")


def _fields(ddl: str) -> str:
    return ddl.replace(" ", ":").replace(",:", ",")


def _plain(c: Column) -> Column:
    """A DOUBLE as text with at least one and at most six places, never with an exponent."""
    text = F.regexp_replace(c.cast("decimal(38,6)").cast("string"), "0+$", "")
    return F.regexp_replace(text, r"\.$", ".0")


def _lines(*lines: str) -> Column:
    return F.array(*[F.lit(x) for x in lines])


def _section(title: str, body: Column, none: str) -> Column:
    return F.concat(_lines(title, ""), F.coalesce(body, _lines(none)), _lines(""))
