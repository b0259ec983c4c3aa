"""Exact token-length histogram.

Documents are encoded with a public byte-pair vocabulary and only their number by
encoded length is kept.  Running sums over the lengths then answer, for every
length L as a context limit: documents and tokens up to L and beyond it, the
quantile of L, and the tokens left if each document is truncated to L.

The vocabulary file is a parameter: a path on the driver, or a URL that Spark reads; its
bytes are sent to the tasks.  Running sums are two-level (blocks of lengths, then inside
a block): no task holds the whole histogram.

The splitting pattern ends in ``\\s+(?!\\S)|\\s+``, which takes a run of white space less its
last character as one piece, or the whole run at the end of a text.  The pattern
engine cannot do that for runs of millions, so runs over ``LONG_RUN`` are cut out first and
encoded as that one piece; the tokens are the same.

Defined cases: a null or empty text has length 0; repeated rows count each; an
empty table gives an empty histogram; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweave.llm.common import small_batches, staged

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the splitting pattern that the vocabulary was made with.
PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
MAX_VOCABULARY_BYTES = 16 << 20
BLOCK = 1024
#: White space runs longer than this are encoded apart.
LONG_RUN = 1000
_RUN_RULE = r"\s+(?!\S)|\s+"
#: The characters that the pattern's \s stands for.
_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def vocabulary(spark, path: str = VOCABULARY) -> bytes:
    """The vocabulary file's bytes, at most MAX_VOCABULARY_BYTES."""
    if "://" in path:
        row = spark.read.format("binaryFile").load(path).select("length", "content").first()
        size, read = row.length, lambda: bytes(row.content)
    else:
        size, read = os.path.getsize(path), lambda: open(path, "rb").read()
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary of {size} bytes")
    return read()


def encoder(content: bytes, pattern: str = PATTERN) -> Callable[[str], list[int]]:
    """text -> token ids, for texts with white space runs of any length."""
    import tiktoken
    ranks = {base64.b64decode(t): int(r) for t, r in
             (line.split() for line in content.splitlines() if line)}
    enc, whole = (tiktoken.Encoding("vocabulary", pat_str=p, mergeable_ranks=ranks, special_tokens={})
                  for p in (pattern, r"(?s).+"))
    if not pattern.endswith(_RUN_RULE):
        return enc.encode_ordinary

    def encode(text: str) -> list[int]:
        if len(text) <= LONG_RUN:
            return enc.encode_ordinary(text)
        out: list[int] = []
        at = 0
        for m in _WHITE.finditer(text):
            if m.end() - m.start() > LONG_RUN:
                stop = m.end() - (m.end() < len(text))
                if at < m.start():
                    out += enc.encode_ordinary(text[at:m.start()])
                out += whole.encode_ordinary(text[m.start():stop])
                at = stop
        return out + enc.encode_ordinary(text[at:]) if at < len(text) else out
    return encode


def token_lengths(docs: DataFrame, text_col: str = "text", path: str = VOCABULARY,
                  pattern: str = PATTERN) -> DataFrame:
    """length (tokens of the whole text), one row per input row."""
    spark = docs.sparkSession
    small_batches(spark)
    content = spark.sparkContext.broadcast(vocabulary(spark, path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(content.value, pattern)
        for pdf in batches:
            yield pd.DataFrame({"length": [len(encode(t)) if t else 0 for t in pdf["text"]]})

    return docs.select(F.col(text_col).alias("text")).mapInPandas(run, "length bigint")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """length, n_docs, n_tokens of that length, and for it as a limit: docs_up_to,
    tokens_up_to, docs_beyond, tokens_beyond, truncated_tokens (all documents cut
    to the limit), quantile (share of documents up to it)."""
    h = staged(lengths.groupBy("length").agg(F.count("*").alias("n_docs"))
               .withColumns({"n_tokens": F.col("length") * F.col("n_docs"),
                             "block": F.floor(F.col("length") / BLOCK)}), "token-lengths")
    b = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("n_tokens").alias("bt"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    b = b.select("block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_after")
                            for c in ("bd", "bt")])
    whole = h.agg(F.sum("n_docs"), F.sum("n_tokens")).first()
    all_docs, all_tokens = F.lit(whole[0] or 0), F.lit(whole[1] or 0)
    after = Window.partitionBy("block").orderBy(F.desc("length")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    t = h.join(b, "block").withColumns({
        "docs_beyond": F.coalesce(F.sum("n_docs").over(after), F.lit(0)) + F.col("bd_after"),
        "tokens_beyond": F.coalesce(F.sum("n_tokens").over(after), F.lit(0)) + F.col("bt_after")})
    up_d = all_docs - F.col("docs_beyond")
    up_t = all_tokens - F.col("tokens_beyond")
    return t.select("length", "n_docs", "n_tokens", up_d.alias("docs_up_to"),
                    up_t.alias("tokens_up_to"), "docs_beyond", "tokens_beyond",
                    (up_t + F.col("length") * F.col("docs_beyond")).alias("truncated_tokens"),
                    (up_d / all_docs).alias("quantile"))


def token_counts(docs: DataFrame, text_col: str = "text", path: str = VOCABULARY,
                 pattern: str = PATTERN) -> DataFrame:
    return length_histogram(token_lengths(docs, text_col, path, pattern))
