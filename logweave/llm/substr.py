"""Substring dedup by recompression.

Every text, read as a sequence of word names, goes through ``ROUNDS`` rounds.  In
a round a hash splits the names into left and right ones, and each left name
followed by a right one becomes a pair with a new name, the hash of (round, left,
right): the same everywhere without an exchange, so equal substrings get equal
interior names.  Runs of one name stay runs (a pair needs two different names), so
a window that starts inside a run still sees the same names.

A round can disturb one name at each end of a substring, at most 1 + 2 + 4 = 7
words in three rounds.  Inside a window of 35 words the names that cover its
middle words are thus equal wherever the window stands.  Of the groups of names (at
least ``GROUP`` words) that start there the one with the smallest hash is the
window's anchor: equal windows have equal anchors, and about one word in nine
starts one.  Windows that follow each other with one anchor name (runs too) make
one row.

Anchors that occur once are dropped (a pre-aggregated count over all texts); the
windows of the others are verified by a second hash of all their words, compared
among equal anchors, which makes 128 bits in all.

Defined cases: a null text has no words; texts with equal words are one text that
stands in several documents; repeated rows each give a row; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweave.llm.common import numbered, small_batches, spare, staged, words

WINDOW = 35
ROUNDS = 3
GROUP = 8
#: An anchor name with more rows than this is verified by a salted plan.
HOT_ROWS = 100_000
_CACHE = 500_000
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


class _Names(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE:
            self.clear()
        v = self[word] = xxhash.xxh64_intdigest(word)
        return v


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MUL
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, modulo 2**64."""
    def row(b: int) -> np.ndarray:
        p = np.full(n + 1, b, np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)
    return row(_BASE), row(pow(_BASE, -1, 1 << 64))


def _range_hash(names: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of names[lo:hi] for arrays of bounds, from one running sum."""
    up, down = _powers(len(names))
    q = np.r_[np.uint64(0), np.cumsum(_mix(names) * up[:-1], dtype=np.uint64)]
    return _mix((q[hi] - q[lo]) * down[lo])


def compress(names: np.ndarray, ends: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Rounds of pair naming over concatenated texts; ``ends[i]`` is the end of the
    text that word i is in.  Returns (names, first word of each)."""
    start = np.arange(len(names))
    for r in range(rounds):
        if len(names) < 2:
            break
        right = (_mix(names + np.uint64(r + 1)) >> np.uint64(33)) & np.uint64(1) == 1
        pair = ~right[:-1] & right[1:] & (start[1:] < ends[start[:-1]])
        at = np.flatnonzero(pair)
        new = names.copy()
        new[at] = _mix(names[at] * _MUL + _mix(names[at + 1] + np.uint64(r + 1)))
        keep = np.ones(len(names), bool)
        keep[at + 1] = False
        names, start = new[keep], start[keep]
    return names, start


def _least(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Place of the smallest key in [lo, hi], the last one of equals."""
    deep = int((hi - lo + 1).max()).bit_length()
    tops = [np.arange(len(key))]
    for k in range(deep - 1):
        a = tops[-1]
        b = np.r_[a[1 << k:], np.full(min(1 << k, len(a)), a[-1])]
        tops.append(np.where(key[b] <= key[a], b, a))
    tab = np.stack(tops)
    k = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    a, b = tab[k, lo], tab[k, hi - (1 << k) + 1]
    return np.where(key[b] <= key[a], b, a)


def anchors(names: np.ndarray, lengths: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS,
            group: int = GROUP) -> tuple[np.ndarray, ...]:
    """Word names of concatenated texts -> (text, anchor name, first, last window
    start, places of the anchor) rows that cover every window of every text once."""
    none = np.zeros(0, np.int64)
    stop = np.cumsum(lengths)
    first = stop - lengths
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    ends = stop[text_of] if len(text_of) else none
    begin = np.arange(len(names))
    begin = begin[begin + window <= ends]
    if not len(begin):
        return none, none.astype(np.uint64), none, none, none
    margin = (1 << rounds) - 1
    sym, start = compress(names, ends, rounds)
    after = np.searchsorted(start, start + group)
    key = _range_hash(sym, np.arange(len(sym)), np.minimum(after, len(sym)))
    at = np.zeros(len(names), np.int64)
    at[start] = 1
    at = np.cumsum(at) - 1                           # name that covers each word
    lo, hi = at[begin + margin], at[begin + window - 1 - margin - (group - 1)]
    fresh = np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
    best = _least(key, lo[fresh], hi[fresh])
    place = best[np.cumsum(fresh) - 1]
    name = key[place]
    t = text_of[begin]
    turn = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (t[1:] != t[:-1])])
    last = np.r_[turn[1:], len(begin)] - 1
    moves = np.cumsum(np.r_[True, place[1:] != place[:-1]])
    return (t[turn], name[turn], begin[turn] - first[t[turn]], begin[last] - first[t[turn]],
            moves[last] - moves[turn] + 1)


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _lists(counts: np.ndarray, values: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()),
                                    pa.array(values, kind))


def _scan(window: int):
    """mapInArrow body: documents -> id, n_words, sha (of all words), anchors; a
    text met before in the same task has none again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, seen = _Names(), set()
        for b in batches:
            n_words, sha, new, lengths = [], [], [], []
            for text in b.column(1).to_pylist():
                ws = _words(text)
                d = hashlib.sha256(b" ".join(ws))
                n_words.append(len(ws))
                sha.append(d.hexdigest())
                use = len(ws) >= window and d.digest()[:16] not in seen
                if use:
                    seen.add(d.digest()[:16])
                    new.append(np.fromiter(map(names.__getitem__, ws), np.uint64, len(ws)))
                lengths.append(len(ws) if use else 0)
            all_names = np.concatenate([*new, np.zeros(0, np.uint64)])
            t, k, lo, hi, m = anchors(all_names, np.array(lengths, np.int64), window)
            per = np.bincount(t, minlength=len(sha)) if len(sha) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(sha, pa.string()),
                 _lists(per, k.view(np.int64), pa.int64()), _lists(per, lo, pa.int32()),
                 _lists(per, hi, pa.int32()), _lists(per, m, pa.int32())],
                ["doc_id", "n_words", "sha", "ak", "alo", "ahi", "am"])

    return run


def _packed(window: int):
    """mapInArrow body: text -> t (identity), z (compressed words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen = zstandard.ZstdCompressor(level=1).compress, set()
        for b in batches:
            ts, zs = [], []
            for text in b.column(0).to_pylist():
                ws = _words(text)
                if len(ws) < window:
                    continue
                joined = b" ".join(ws)
                t = hashlib.sha256(joined).digest()[:16]
                if t not in seen:
                    seen.add(t)
                    ts.append(t)
                    zs.append(pack(joined))
            yield pa.RecordBatch.from_arrays([pa.array(ts, pa.binary()), pa.array(zs, pa.binary())],
                                             ["t", "z"])

    return run


def _window_hashes(window: int):
    """mapInArrow body: rid, z, r (anchor rows) -> key, rid, lo, hot, hs (hash of each
    window from lo on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, names = zstandard.ZstdDecompressor().decompress, _Names()
        for b in batches:
            ts, parts, keys, los, lens, hots = [], [], [], [], [], []
            rows = b.column(2)
            for i in range(b.num_rows):
                ws = unpack(b.column(1)[i].as_py()).split(b" ")
                h = np.fromiter(map(names.__getitem__, ws), np.uint64, len(ws))
                at = np.arange(len(ws) - window + 1)
                h = _range_hash(h, at, at + window)
                r = rows[i].values
                k, lo, hi = (r.field(j).to_numpy() for j in range(3))
                n = hi - lo + 1
                off = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                parts.append(h[off])
                keys.append(k)
                los.append(lo)
                lens.append(n)
                hots.append(r.field(3).to_numpy(zero_copy_only=False))
                ts.append(np.full(len(k), i))
            z = np.zeros(0, np.int64)
            which = np.concatenate([*ts, z]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*keys, z]).astype(np.int64)),
                 b.column(0).take(pa.array(which)),
                 pa.array(np.concatenate([*los, z]).astype(np.int32)),
                 pa.array(np.concatenate([*hots, z]).astype(bool)),
                 _lists(np.concatenate([*lens, z]),
                        np.concatenate([*parts, z.astype(np.uint64)]).view(np.int64), pa.int64())],
                ["key", "rid", "lo", "hot", "hs"])

    return run


def _covered(ws: list[bytes], p: np.ndarray, window: int) -> tuple[bytes, int]:
    """(what is left, words removed) without the windows that start at ``p``."""
    edge = np.zeros(len(ws) + 1, np.int64)
    edge[p] += 1
    edge[p + window] -= 1
    out = np.cumsum(edge[:-1]) > 0
    return b" ".join([w for w, x in zip(ws, out.tolist()) if not x]), int(out.sum())


def _kept(window: int):
    """mapInArrow body: t, z, p (starts of repeated windows) -> t, n_removed, kept_sha."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            got = [_covered(unpack(b.column(1)[i].as_py()).split(b" "),
                            b.column(2)[i].values.to_numpy(), window) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string())],
                ["t", "n_removed", "kept_sha"])

    return run


def _repeated(rows: DataFrame) -> DataFrame:
    """key, rid, lo, hs -> rid, p: the windows whose hash stands at two places.  Equal
    anchors meet in one partition; a group has at most HOT_ROWS rows."""
    wins = rows.repartition("key").select("key", "rid", "lo", F.posexplode("hs").alias("i", "h"))
    n = F.count("*").over(Window.partitionBy("key", "h"))
    return wins.withColumn("n", n).filter("n > 1").select(
        "rid", (F.col("lo") + F.col("i")).alias("p"))


def _repeated_hot(rows: DataFrame) -> DataFrame:
    """The same for anchors of any number: windows are counted map-side first and
    joined back by a join that Spark can split."""
    wins = rows.select("key", "rid", "lo", F.posexplode("hs").alias("i", "h"))
    twice = wins.groupBy("key", "h").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return wins.join(twice, ["key", "h"], "left_semi").select(
        "rid", (F.col("lo") + F.col("i")).alias("p"))


def _sources(docs: DataFrame, window: int, id_col: str, text_col: str):
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    base = numbered(src.mapInArrow(
        _scan(window), f"doc_id {kind}, n_words bigint, sha string, ak array<bigint>, "
                       "alo array<int>, ahi array<int>, am array<int>"), "substr-base")
    texts = src.select("text").mapInArrow(_packed(window), "t binary, z binary") \
        .dropDuplicates(["t"])
    return base, texts


def repeated_places(base: DataFrame, texts: DataFrame, window: int = WINDOW,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """t, p: the starts of the windows of each distinct text that stand elsewhere too,
    in it or in another text."""
    rows = base.select("rid", F.inline(F.arrays_zip("ak", "alo", "ahi", "am"))
                       .alias("key", "lo", "hi", "m"))
    names = staged(rows.groupBy("key").agg(F.sum("m").alias("n")).filter("n > 1"), "substr-names")
    hot = F.col("n") > hot_rows
    per = (rows.drop("m").join(names.select("key", hot.alias("hot")), "key").groupBy("rid")
           .agg(F.collect_list(F.struct("key", "lo", "hi", "hot")).alias("r")))
    ids = base.select("rid", F.unhex(F.substring("sha", 1, 32)).alias("t"))
    cand = staged(per.join(ids, "rid").dropDuplicates(["t"]), "substr-cand")
    wins = texts.join(cand, "t").select("rid", "z", "r").mapInArrow(
        _window_hashes(window), "key bigint, rid bigint, lo int, hot boolean, hs array<bigint>")
    if names.filter(hot).limit(1).count():
        wins = staged(wins, "substr-windows")
        found = _repeated(wins.filter("not hot")).unionByName(_repeated_hot(wins.filter("hot")))
    else:
        found = _repeated(wins)
    places = staged(found.groupBy("rid").agg(F.collect_list("p").alias("p")), "substr-places")
    return places.join(cand.select("rid", "t"), "rid").select("t", "p")


def _check(window: int) -> None:
    if window < 2 * ((1 << ROUNDS) - 1) + GROUP:
        raise ValueError("window too short for the rounds")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     window: int = WINDOW, hot_rows: int = HOT_ROWS) -> DataFrame:
    """rid, doc_id, n_words, n_removed, kept_sha256; one row per input row."""
    _check(window)
    small_batches(docs.sparkSession)
    base, texts = _sources(docs, window, id_col, text_col)
    places = repeated_places(base, texts, window, hot_rows)
    done = texts.join(places, "t").mapInArrow(
        _kept(window), "t binary, n_removed bigint, kept_sha string")
    copies = base.groupBy("sha").agg(F.count("*").alias("copies")).filter("copies > 1")
    all_gone = F.col("copies").isNotNull() & (F.col("n_words") >= window)
    out = base.select("rid", "doc_id", "n_words", "sha").join(copies, "sha", "left") \
        .withColumn("t", F.unhex(F.substring("sha", 1, 32))).join(done, "t", "left")
    return out.select(
        "rid", "doc_id", "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
        .cast("bigint").alias("n_removed"),
        F.when(all_gone, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"))


def remove_substrings(docs: DataFrame, window: int = WINDOW, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``docs`` (doc_id, text, n_chars and whatever else) with the words of repeated
    windows taken out of ``text`` (what is left joined by one space) and ``n_chars``
    counted anew; texts without any are unchanged."""
    _check(window)
    small_batches(docs.sparkSession)
    base, texts = _sources(docs, window, "doc_id", "text")
    places = repeated_places(base, texts, window, hot_rows)
    copies = base.groupBy("sha").agg(F.count("*").alias("c"), F.max("n_words").alias("w")) \
        .filter((F.col("c") > 1) & (F.col("w") >= window)) \
        .select(F.unhex(F.substring("sha", 1, 32)).alias("t"), F.lit(True).alias("gone"))
    h_own, h_t, h_p, h_gone = spare(docs, "h_own", "h_t", "h_p", "h_gone")
    hit = places.join(copies, "t", "full").select(
        F.col("t").alias(h_t), F.when(F.col("gone"), F.array().cast("array<int>"))
        .otherwise(F.col("p")).alias(h_p), F.coalesce("gone", F.lit(False)).alias(h_gone))
    own = F.unhex(F.substring(F.sha2(F.array_join(words(F.col("text")), " ").cast("binary"), 256),
                              1, 32))
    joined = docs.withColumn(h_own, own).join(hit, F.col(h_own) == F.col(h_t), "left")
    out = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text").to_pylist()
            size = b.column("n_chars").to_pylist()
            p, gone = b.column(h_p), b.column(h_gone).to_pylist()
            for i, g in enumerate(gone):
                if g is None:
                    continue
                out_of = _covered(_words(text[i]), p[i].values.to_numpy(), window)
                text[i] = "" if g else out_of[0].decode("utf-8", "replace")
                size[i] = len(text[i])
            cols = [pa.array(text, pa.string()) if f.name == "text"
                    else pa.array(size, b.column("n_chars").type) if f.name == "n_chars"
                    else b.column(f.name) for f in out.fields]
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in out.fields])

    return joined.mapInArrow(run, out)
