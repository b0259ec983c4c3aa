"""Quality rules: per-document base rules, then cross-document line frequency.

Lines are normalised (lower case, white space collapsed) and hashed; for each
host (``source``) the distinct documents that hold a line are counted, exact
copies of a text being one document.  A line above the host's limit is
boilerplate and is removed; a document that keeps too small a share of its
words is depleted and rejected.

Everything is a DataFrame expression.  The per-text figures are computed inside
the row (arrays bounded by the text); only line hashes are shuffled.

Defined cases: a null text has no words and fails the base rules; a null source
is a host of its own; repeated rows each give a row; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.materialize import computed
from logweave.llm.common import SPACE, numbered, words

NGRAM = 5
#: A line is boilerplate when more distinct documents of its host hold it than
#: the larger of MIN_DOCS and HOST_SHARE of the host's distinct documents.
MIN_DOCS = 20
HOST_SHARE = 0.01
#: A document is depleted when fewer than this share of its words is left.
MIN_LEFT = 0.5


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def base_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source") -> DataFrame:
    """One row per document with the base figures and ``lines``, the distinct
    normalised lines as (hash, words over all its occurrences)."""
    t = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = computed(t, {"w": words(F.col("text")),
                     "ls": F.filter(F.split("text", "\n"),
                                    lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    grams = F.when(
        F.size("w") >= NGRAM,
        F.transform(F.sequence(F.lit(0), F.size("w") - NGRAM),
                    lambda i: F.xxhash64(*[F.get(F.col("w"), i + k) for k in range(NGRAM)]))
    ).otherwise(F.array().cast("array<bigint>"))
    t = computed(t, {"h": grams, "n_words": F.size("w").cast("bigint"),
                     "word_chars": F.length(F.array_join("w", "")).cast("bigint"),
                     "nl": F.transform("ls", lambda x: normal_line(x))})
    # Positions of repeated windows: sort (hash, position), keep equal neighbours.
    pairs = F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(
        F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    t = computed(t, {"hp": pairs, "dl": F.array_distinct("nl")})
    same = F.filter("hp", lambda x, i: (x["h"] == F.get(F.col("hp"), i - 1)["h"])
                    | (x["h"] == F.get(F.col("hp"), i + 1)["h"]))
    t = computed(t, {"p": F.sort_array(F.transform(same, lambda x: x["i"])),
                     "lw": F.transform("nl", lambda x: F.struct(
                         F.xxhash64(x).alias("h"), F.size(F.split(x, " ")).alias("n")))})
    covered = F.aggregate(
        F.transform("p", lambda x, i: F.least(F.lit(NGRAM), F.coalesce(
            F.get(F.col("p"), i + 1) - x, F.lit(NGRAM)))),
        F.lit(0).cast("bigint"), lambda a, x: a + x)
    return t.select(
        "doc_id", "source", "n_words", "word_chars",
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), F.xxhash64("text", F.length("text")).alias("tkey"), "lw")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", min_docs: int = MIN_DOCS,
                  host_share: float = HOST_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_boilerplate_words (words on removed lines), base_failed, kept."""
    base = numbered(base_columns(docs, id_col, text_col, source_col), "quality")
    lines = base.select("rid", "source", "tkey", F.inline("lw"))
    freq = lines.groupBy("source", "h").agg(F.count_distinct("tkey").alias("n_docs"))
    hosts = base.groupBy("source").agg(F.count_distinct("tkey").alias("host_docs"))
    s, h = freq.alias("s"), hosts.alias("h")
    common = (s.filter(F.col("n_docs") > min_docs)
              .join(h, F.col("s.source").eqNullSafe(F.col("h.source")))
              .filter(F.col("n_docs") > host_share * F.col("host_docs"))
              .select(F.col("s.source").alias("c_source"), F.col("s.h").alias("c_h")))
    lost = (lines.join(common, F.col("source").eqNullSafe(F.col("c_source"))
                       & (F.col("h") == F.col("c_h")))
            .groupBy("rid").agg(F.sum("n").alias("lost")))
    gone = F.coalesce("lost", F.lit(0)).cast("bigint")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (base.join(lost, "rid", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", gone.alias("n_boilerplate_words"),
                    failed.alias("base_failed"),
                    (~failed & ((F.col("n_words") - gone) >= min_left * F.col("n_words")))
                    .alias("kept")))
