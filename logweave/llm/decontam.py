"""Benchmark decontamination: prefix-filtered containment join of item windows.

Every benchmark item is cut into windows of ``WINDOW`` consecutive words (one
window if it has fewer).  A window's tokens are its word shingles.  Shingles are
ordered by rarity, that is by how often the documents hold them; as a window
must be contained whole, a prefix of one token, its rarest, is all that the join
needs.  A joined position is kept only if the window fits into the document
there (positional and length bound), and is verified by the window's first and
last shingle, which cover it, compared as text at their exact places.

Documents are scanned once for benchmark shingles, whose number is counted first.  Up to
``INDEX_LIMIT`` distinct shingles the scan holds them in the task, up to ``HASH_LIMIT`` their
64-bit hashes, sorted (8 bytes each); beyond it the scan is a shuffle join.  A shingle that
only shares a hash joins no window, so all three give the same matches.

Defined cases: a null text has no words; a null item text gives no windows; an item
without id counts for the words hit, but has no id to list; repeated document rows each
give a row, repeated items count once; an empty benchmark leaves all documents clean;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweave.llm.common import numbered, small_batches, spare, staged

WINDOW = 10
SHINGLE = 5
INDEX_LIMIT = 200_000
HASH_LIMIT = 4_000_000
#: Fixed by the word definition.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MATCH = "array<struct<s:string,p:int>>"


def bench_words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(low, SEPARATORS), "")


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """item_id, w (the window's words), one row per item and distinct window."""
    t = items.select(F.col(item_col).alias("item_id"), bench_words(F.col(text_col)).alias("ws")) \
        .filter(F.size("ws") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - window + 1, F.lit(1)))
    return t.select("item_id", F.explode(F.transform(
        starts, lambda i: F.slice("ws", i, window))).alias("w")).distinct()


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Distinct windows with their shingles: win (text), len, k (shingle
    length), sh (array of shingle texts by offset)."""
    t = windows.select("w").distinct().select(
        "w", F.array_join("w", " ").alias("win"), F.size("w").alias("len"))
    t = t.withColumn("k", F.least("len", F.lit(shingle)))
    return t.select("win", "len", "k", F.transform(
        F.sequence(F.lit(1), F.col("len") - F.col("k") + 1),
        lambda i: F.array_join(F.slice("w", i, F.col("k")), " ")).alias("sh"))


#: The words of a text as bytes: fixed by the word definition.
_KEEP = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
              else (c + 32 if 0x41 <= c <= 0x5A else 0x20) for c in range(256))


def _mix(cols) -> np.ndarray:
    h = np.zeros(len(cols[0]), dtype=np.uint64)
    for c in cols:
        h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class _Names(dict):
    """Word -> 64-bit name, for the words last seen."""
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        v = self[word] = xxhash.xxh64_intdigest(word)
        return v


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas body: s, k (shingles) -> k, h (their hashes)."""
    for pdf in batches:
        for k, part in pdf.groupby("k"):
            ws = [s.encode().split(b" ") for s in part["s"]]
            cols = [np.array([xxhash.xxh64_intdigest(w[j]) for w in ws], np.uint64) for j in range(k)]
            yield pd.DataFrame({"k": np.int32(k), "h": _mix(cols).view(np.int64)})


def _hash_scanner(index: dict[int, np.ndarray]):
    """Like ``_scanner``, by sorted hashes of the shingles of each length."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = _Names()
        for pdf in batches:
            n_words, found = [], []
            for text in pdf["text"]:
                ws = text.encode("utf-8", "surrogatepass").translate(_KEEP).split() if text else []
                n_words.append(len(ws))
                ids = np.fromiter((names[w] for w in ws), dtype=np.uint64, count=len(ws))
                hit: list = []
                for k, hashes in index.items():
                    if len(ids) >= k:
                        h = _mix([ids[j:len(ids) - k + 1 + j] for j in range(k)])
                        slot = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                        hit += [{"s": b" ".join(ws[p:p + k]).decode("utf-8", "surrogatepass"), "p": p}
                                for p in np.flatnonzero(hashes[slot] == h).tolist()]
                found.append(hit)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": np.array(n_words, np.int64),
                                "m": found})
    return scan


def _scanner(shingles: list[str]):
    """mapInPandas body: doc_id, text -> doc_id, n_words, m (benchmark shingles
    with their positions)."""
    vocab: dict[bytes, int] = {}
    by_len: dict[int, set] = {}
    for s in shingles:
        ws = s.encode().split(b" ")
        for w in ws:
            vocab.setdefault(w, len(vocab) + 1)
        by_len.setdefault(len(ws), set()).add(tuple(vocab[w] for w in ws))
    names = [b""] + list(vocab)
    index = {}
    for k, keys in by_len.items():
        arr = np.array(sorted(keys), dtype=np.uint64).reshape(len(keys), k)
        index[k] = np.sort(_mix([arr[:, j] for j in range(k)]))
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = vocab.get
        for pdf in batches:
            n_words, found = [], []
            for text in pdf["text"]:
                ws = text.encode("utf-8", "surrogatepass").translate(_KEEP).split() if text else []
                n_words.append(len(ws))
                ids = np.fromiter((get(w, 0) for w in ws), dtype=np.uint64, count=len(ws))
                hit: list = []
                for k, hashes in index.items():
                    if len(ids) < k:
                        continue
                    known = np.ones(len(ids) - k + 1, dtype=bool)
                    for j in range(k):
                        known &= ids[j:len(ids) - k + 1 + j] > 0
                    at = np.flatnonzero(known)
                    if not len(at):
                        continue
                    h = _mix([ids[at + j] for j in range(k)])
                    slot = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                    for p in at[hashes[slot] == h].tolist():
                        key = tuple(ids[p:p + k].tolist())
                        if key in by_len[k]:
                            hit.append({"s": b" ".join(names[i] for i in key).decode(), "p": p})
                found.append(hit)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": np.array(n_words, np.int64),
                                "m": found})

    return scan


def benchmark_matches(docs: DataFrame, tokens: DataFrame, index_limit: int = INDEX_LIMIT,
                      hash_limit: int = HASH_LIMIT) -> DataFrame:
    """docs (doc_id, text) x tokens (s, k) -> rid, doc_id, n_words, m."""
    spark = docs.sparkSession
    small_batches(spark)
    n = tokens.count()
    scanner = None
    if n <= index_limit:
        scanner = _scanner([r.s for r in tokens.select("s").collect()])
    elif n <= hash_limit:
        got = tokens.select("s", "k").mapInPandas(_hashes, "k int, h bigint").toPandas()
        scanner = _hash_scanner({int(k): np.sort(x["h"].to_numpy().view(np.uint64))
                                 for k, x in got.groupby("k")})
    if scanner:
        id_type = docs.schema["doc_id"].dataType.simpleString()
        return numbered(docs.mapInPandas(
            scanner, f"doc_id {id_type}, n_words bigint, m {_MATCH}"), "decon-docs")
    base = numbered(docs.select("doc_id", "text"), "decon-text")
    ws = base.select("rid", "doc_id", bench_words(F.col("text")).alias("ws"))
    lens = [r.k for r in tokens.select("k").distinct().collect()]     # at most SHINGLE values

    def shingled(k: int) -> DataFrame:
        at = F.sequence(F.lit(1), F.size("ws") - k + 1)
        return ws.filter(F.size("ws") >= k).select("rid", F.posexplode(F.transform(
            at, lambda i: F.array_join(F.slice("ws", i, k), " "))).alias("p", "s"))

    parts = [shingled(k) for k in [*lens, *[SHINGLE] * (not lens)]]
    at = parts[0]
    for x in parts[1:]:
        at = at.unionByName(x)
    m = at.join(tokens.select("s").distinct(), "s", "left_semi").groupBy("rid").agg(
        F.collect_list(F.struct("s", "p")).alias("m"))
    return ws.select("rid", "doc_id", F.size("ws").cast("bigint").alias("n_words")) \
        .join(m, "rid", "left").select(
            "rid", "doc_id", "n_words", F.coalesce("m", F.array().cast(_MATCH)).alias("m"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, shingle: int = SHINGLE,
                  index_limit: int = INDEX_LIMIT, hash_limit: int = HASH_LIMIT) -> DataFrame:
    """rid, doc_id, n_words, n_hit (words inside an occurring window), items
    (sorted ids, as strings, of the items with occurring windows)."""
    if 2 * shingle < window:
        raise ValueError("two shingles must cover a window")
    pairs = staged(item_windows(items, item_col, item_text, window), "decon-windows")
    wins = window_shingles(pairs, shingle)
    tokens = wins.select(F.explode("sh").alias("s"), "k").distinct()
    found = benchmark_matches(docs.select(F.col(id_col).alias("doc_id"),
                                          F.col(text_col).alias("text")), tokens, index_limit,
                              hash_limit)
    at = found.select("rid", "n_words", F.inline("m"))
    rarity = at.groupBy("s").agg(F.count("*").alias("freq"))
    toks = wins.select("win", "len", F.posexplode("sh").alias("off", "s"))
    # Rarest shingle of a window; one that no document holds ends the window.
    prefix = (toks.join(rarity, "s", "left").groupBy("win").agg(
        F.min_by(F.struct("s", "off"), F.struct(F.coalesce("freq", F.lit(0)), "off")).alias("t"),
        F.min(F.coalesce("freq", F.lit(0))).alias("freq"))
        .filter("freq > 0").select("win", "t.s", "t.off"))
    ends = wins.select("win", "len", "k", F.get("sh", F.lit(0)).alias("s0"),
                       F.get("sh", F.size("sh") - 1).alias("s1"))
    cand = (at.join(prefix.join(ends, "win"), "s")
            .withColumn("start", F.col("p") - F.col("off"))
            .filter((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words"))))
    first = at.select("rid", F.col("p").alias("start"), F.col("s").alias("s0"))
    last = at.select("rid", F.col("p").alias("p1"), F.col("s").alias("s1"))
    occ = (cand.select("rid", "win", "len", "start", "s0", "s1",
                       (F.col("start") + F.col("len") - F.col("k")).alias("p1"))
           .join(first, ["rid", "start", "s0"], "left_semi")
           .join(last, ["rid", "p1", "s1"], "left_semi"))
    occ = staged(occ.select("rid", "win", "start", (F.col("start") + F.col("len")).alias("end")),
                 "decon-hits")
    before = F.max("end").over(Window.partitionBy("rid").orderBy("start", "end")
                               .rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))))
    hits = occ.withColumn("fresh", fresh).groupBy("rid").agg(
        F.sum("fresh").cast("bigint").alias("n_hit"))
    whose = pairs.select("item_id", F.array_join("w", " ").alias("win"))
    ids = occ.select("rid", "win").distinct().join(whose, "win").groupBy("rid").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return (found.select("rid", "doc_id", "n_words").join(hits, "rid", "left")
            .join(ids, "rid", "left").select(
                "rid", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def keep_uncontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                        shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` (text and whatever else) without a window of an item."""
    key = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    found = decontaminate(docs.select("text", key.alias("k")), items, id_col="k",
                          window=window, shingle=shingle)
    k_row, k_bad = spare(docs, "k_row", "k_bad")
    bad = found.filter("n_hit > 0").select(F.col("doc_id").alias(k_bad)).distinct()
    return docs.withColumn(k_row, key).join(bad, F.col(k_row) == F.col(k_bad),
                                            "left_anti").drop(k_row)
