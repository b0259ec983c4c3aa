"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprint: XXH64 (seed 42) of every word shingle, a bit being 1 if more than
half of the hashes set it.  Two fingerprints within ``max_bits`` differing bits
are linked; a document's class is its connected component.

Linking works on distinct fingerprints.  They are dealt out by each of
``max_bits + 1`` bit segments in turn (fingerprints within ``max_bits`` agree on
at least one segment whole).  A group with one segment value is sorted by Gray
rank; runs of ``FANOUT`` codes form leaves, and every node of the tree above keeps
the masked bit pattern that all its codes share.  A search descends the tree
adding up the bits in which the query differs from each node's shared pattern and
drops a node, with all codes below, once the sum passes ``max_bits``.  A group
returns a spanning forest of its links, not its pairs.  A group of more than
``GROUP_LIMIT`` codes is dealt out again by segments of its remaining bits, round
by round, so no task ever holds an unbounded group and no link is lost.

Components: alternating large and small stars over the links, each round written
to the shared folder.

Defined cases: a null or empty text has fingerprint zero and is linked like any
other; repeated rows each give a row; an empty table gives an empty result;
``component_id`` is the smallest non-null id of the component; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import small_batches, spare, staged

SHINGLE = 3
MAX_BITS = 3
SEED = 42
FANOUT = 16
GROUP_LIMIT = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    ws = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not ws:
        return 0
    joined = b" ".join(ws)
    n = max(1, len(ws) - shingle + 1)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in ws), np.int64, len(ws))) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    stop = ends[shingle - 1:] if len(ws) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), stop.tolist())),
                    np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        part = h[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tkey (MD5 of the text), fp (the 64 bits as a signed BIGINT), one row
    per input row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fps = np.array([fingerprint(t, shingle) for t in pdf["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "tkey": pdf["tkey"],
                                "fp": fps.view(np.int64)})

    t = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                    text_key(F.col(text_col)).alias("tkey"))
    kind = t.schema["doc_id"].dataType.simpleString()
    return t.mapInPandas(run, f"doc_id {kind}, tkey string, fp bigint")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    r = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayIndex:
    """Tree over codes sorted by Gray rank; a node's pattern is (value, mask) of
    the bits that all codes below it share."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        value, mask = codes, np.full(len(codes), ~np.uint64(0), np.uint64)
        self.levels = [(value, mask)]
        while len(value) > FANOUT:
            cut = np.arange(0, len(value), FANOUT)
            same = np.bitwise_and.reduceat(mask, cut)
            ones = np.bitwise_and.reduceat(value, cut)
            zero = np.bitwise_and.reduceat(~value, cut)
            mask = same & (ones | zero)
            value = ones & mask
            self.levels.append((value, mask))

    def within(self, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(query position, code position) of all codes within ``max_bits``."""
        value, mask = self.levels[-1]
        q = np.repeat(np.arange(len(queries)), len(value))
        node = np.tile(np.arange(len(value)), len(queries))
        for depth in range(len(self.levels) - 1, -1, -1):
            value, mask = self.levels[depth]
            diff = np.bitwise_count((queries[q] ^ value[node]) & mask[node])
            near = diff <= max_bits
            q, node = q[near], node[near]
            if depth:
                below = len(self.levels[depth - 1][0])
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                q = np.repeat(q, FANOUT)
                real = node < below
                q, node = q[real], node[real]
        return q, node


def _forest(codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (code, smallest code of its component) inside one group."""
    codes = codes[np.argsort(gray_rank(codes), kind="stable")]
    n = len(codes)
    root = np.arange(n)
    index = GrayIndex(codes)
    for at in range(0, n, 256):
        q, c = index.within(codes[at:at + 256], max_bits)
        a, b = q + at, c
        while True:
            ra, rb = root[a], root[b]
            open_ = ra != rb
            if not open_.any():
                break
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    linked = np.flatnonzero(root != np.arange(n))
    return codes[linked], codes[root[linked]]


def _near_in_runs(gid: np.ndarray, codes: np.ndarray, max_bits: int):
    """Links inside groups that fit in one leaf, over many groups at once."""
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    for d in range(1, min(FANOUT, len(codes))):
        same = gid[d:] == gid[:-d]
        if not same.any():
            break
        near = same & (np.bitwise_count(codes[d:] ^ codes[:-d]) <= max_bits)
        out.append((codes[d:][near], codes[:-d][near]))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _link_groups(max_bits: int):
    """mapInPandas body over rows (mask, part, fp) with groups (mask, part) in
    one piece: the links of each group.  Holds one group beyond a batch."""

    def links(pdf: pd.DataFrame, gid: np.ndarray) -> pd.DataFrame:
        codes = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        cut = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]])
        size = np.diff(np.r_[cut, len(gid)])
        leaf = np.repeat(size <= FANOUT, size)
        found = [_near_in_runs(gid[leaf], codes[leaf], max_bits)]
        for i in np.flatnonzero(size > FANOUT):
            found.append(_forest(codes[cut[i]:cut[i] + size[i]], max_bits))
        return pd.DataFrame({"a": np.concatenate([x[0] for x in found]).view(np.int64),
                             "b": np.concatenate([x[1] for x in found]).view(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry: list[pd.DataFrame] = []
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pd.concat([*carry, pdf], ignore_index=True)
            m, k = pdf["mask"].to_numpy(), pdf["part"].to_numpy()
            gid = np.r_[0, np.cumsum((m[1:] != m[:-1]) | (k[1:] != k[:-1]))]
            done = gid < gid[-1]
            if done.any():
                yield links(pdf[done], gid[done])
            carry = [pdf[~done]]
        if carry:
            yield links(carry[0], np.zeros(len(carry[0]), np.int64))

    return run


def _split(mask: int, parts: int) -> list[int]:
    """``mask`` widened by each of ``parts`` segments of the bits it lacks."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [round(i * len(free) / parts) for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[x:y]) for x, y in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(codes: DataFrame, max_bits: int = MAX_BITS,
                      limit: int = GROUP_LIMIT) -> DataFrame:
    """Distinct ``fp`` -> links (a, b) that connect all fingerprints within
    ``max_bits`` of each other."""
    rows, masks, out = codes.select("fp"), _split(0, max_bits + 1), None
    while True:
        dealt = rows.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))
                            .alias("mask")) if out is None else rows
        dealt = dealt.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("part"))
        big = staged(dealt.groupBy("mask", "part").agg(F.count("*").alias("n"))
                     .filter(F.col("n") > limit).select("mask", "part"), "simhash-big")
        hot = big.select("mask").distinct().collect()     # at most one row per mask
        whole = dealt.join(big, ["mask", "part"], "left_anti") if hot else dealt
        links = staged(whole.repartition("mask", "part").sortWithinPartitions("mask", "part")
                       .mapInPandas(_link_groups(max_bits), "a bigint, b bigint")
                       .filter("a <> b"), "simhash-links")
        out = links if out is None else out.unionByName(links)
        if not hot:
            return out
        wider = {r.mask: _split(r.mask % (1 << 64), max_bits + 1) for r in hot}
        step = F.create_map(*[x for m, ws in wider.items() for x in (
            F.lit(m), F.array(*[F.lit(_signed(w)) for w in ws]))])
        rows = staged(dealt.join(big, ["mask", "part"], "left_semi")
                      .select("fp", F.explode(step[F.col("mask")]).alias("mask")).distinct(),
                      "simhash-hot")


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> node, root (smallest node of its component) for every
    linked node other than the roots, by alternating large and small stars."""

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter("u <> v").distinct(), "cc")
    seen = mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"),
                                                           F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                             F.struct(F.col("u"), F.col("m").alias("v"))))) \
            .filter("u <> v").distinct()
        edges = staged(small, "cc")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    limit: int = GROUP_LIMIT) -> DataFrame:
    """doc_id, tkey, fp, component_id: one row per input row."""
    rows = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    per = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-codes")
    comp = components(fingerprint_links(per, max_bits, limit))
    named = _named(per, comp)
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(ids, "root").select("fp", "component_id")
    return rows.join(of, "fp").select("doc_id", "tkey", "fp", "component_id")


def _named(per: DataFrame, comp: DataFrame) -> DataFrame:
    """Every fingerprint with the root of its component (itself if unlinked)."""
    return per.join(comp, F.col("fp") == F.col("node"), "left").drop("node") \
        .withColumn("root", F.coalesce("root", "fp"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
             limit: int = GROUP_LIMIT) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and whatever else) with one of each
    component: the smallest doc_id (null last), of those the smallest text hash,
    of equal rows any one."""
    rows = staged(fingerprints(docs, shingle=shingle), "simhash-fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tkey")).alias("f")
    per = staged(rows.groupBy("fp").agg(first), "simhash-codes")
    comp = components(fingerprint_links(per, max_bits, limit))
    k_id, k_key, k_row = spare(docs, "k_id", "k_key", "k_row")
    kept = _named(per, comp).groupBy("root").agg(F.min("f").alias("f")) \
        .select(F.col("f.doc_id").alias(k_id), F.col("f.tkey").alias(k_key))
    d = docs.withColumn(k_row, text_key(F.col("text")))
    return d.join(kept, d["doc_id"].eqNullSafe(kept[k_id]) & (d[k_row] == kept[k_key]),
                  "left_semi").dropDuplicates(["doc_id", k_row]).drop(k_row)
