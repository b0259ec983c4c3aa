"""Phrase collocation mining over mergeable Misra-Gries summaries.

Which n-grams (1 to ``max_words`` words) are frequent is found in two passes over
whole texts:

1. Every task counts the n-grams of its texts by a 48-bit name and deals the counts
   out over hash partitions.  A partition knows the mass that all tasks send it, and
   folds their counts into one Misra-Gries summary of more than ``SLACK * mass /
   threshold`` counters.  Overflowing summaries subtract their next largest counter
   from all; the sum of what was subtracted, the error, stays under
   ``threshold / SLACK``.  A name is dropped only if its counter plus the error is under the
   threshold, so every frequent n-gram survives.
2. The surviving names fill a Bloom filter of at most ``FILTER_BITS`` bits.  A second
   pass counts the n-grams that it lets through exactly, by their words.  A larger
   corpus makes the filter let more pass, never less, and the exact counts decide.

Memory is bounded by a block of texts and a summary: the number of partitions grows
with the bytes of the texts, so a summary stays near ``BYTES_PER_PART`` of text.

A candidate is scored by its weakest cut (see :func:`score`), those that a longer one
mostly accounts for go (:func:`covered`), and :func:`top_phrases` ranks the rest.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated
rows count each; ties are broken by count, then by the phrase in byte order; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweave.llm.common import mix64, small_batches, staged

THRESHOLD = 30
MAX_WORDS = 4
TOP = 2000
COVER_PERCENT = 80
SCALE = 2_000_000
#: Text bytes that one summary stands for.
BYTES_PER_PART = 4 << 20
#: Capacity of a summary as a multiple of mass / threshold.
SLACK = 2
#: Bounds of one task: bytes of text taken at a time, names held before they are sent.
BLOCK_BYTES = 2 << 20
HELD_NAMES = 1_500_000
#: Names in one row of the shuffle.
ROW_NAMES = 1 << 12
#: The broadcast filter has at most this many bits (16 MB).
FILTER_BITS = 1 << 27
#: Phrases of one language that a ranking task holds.
RANK_ROWS = 100_000
_WIDE = "decimal(20,0)"

#: Lower-cases A-Z, makes a tab a space and every separator of pieces a full stop.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r",
                        b"abcdefghijklmnopqrstuvwxyz .........")


class Tokens:
    """Words of a block of texts: ``vocab`` (bytes of each distinct word), ``code``
    (place in vocab), ``piece`` and ``lang`` (place in ``langs``) of every word."""

    def __init__(self, texts: pa.Array, langs: pa.Array) -> None:
        texts = texts.cast(pa.large_binary())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = (data.to_pybytes()[at[0]:at[-1]] if data is not None else b"").translate(_FOLD)
        b = np.frombuffer(raw, np.uint8)
        at = at - at[0]
        first = np.zeros(len(b) + 1, bool)
        first[at] = True
        stop = b == 0x2E
        word = ~(stop | (b == 0x20))
        before = np.r_[False, word[:-1]] if len(b) else word
        after = np.r_[word[1:], False] if len(b) else word
        start = np.flatnonzero(word & (~before | first[:-1]))
        end = np.flatnonzero(word & (~after | first[1:])) + 1
        offsets = np.r_[0, np.cumsum(end - start)].astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(start), [
            None, pa.py_buffer(offsets), pa.py_buffer(b[word].tobytes())]).dictionary_encode()
        self.vocab: list[bytes] = coded.dictionary.to_pylist()
        self.code = coded.indices.to_numpy().astype(np.int64)
        self.piece = np.cumsum(stop | first[:-1])[start]
        named = langs.dictionary_encode()
        self.langs: list[str] = named.dictionary.to_pylist()
        self.lang = named.indices.to_numpy().astype(np.int64)[
            np.searchsorted(at, start, side="right") - 1]

    def names(self, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, places, 48-bit names) of the n-grams, for n from 1 to max_words."""
        if not len(self.code):
            return
        own = np.array([xxhash.xxh64_intdigest(w) for w in self.vocab], np.uint64)[self.code]
        h = np.array([xxhash.xxh64_intdigest(x, 1) for x in self.langs], np.uint64)[self.lang]
        place = np.arange(len(own))
        for n in range(1, max_words + 1):
            if n > 1:
                inside = np.flatnonzero(place + n - 1 < len(own))
                inside = inside[self.piece[place[inside]] == self.piece[place[inside] + n - 1]]
                place, h = place[inside], h[inside]
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + own[place + n - 1])
            yield n, place, h >> np.uint64(16)

    def count(self, n: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first places, counts) of the distinct n-grams that start at ``place``,
        compared by language and words."""
        size = len(self.vocab)
        key = self.lang[place] * size + self.code[place]
        for k in range(1, n):
            key = np.unique(key, return_inverse=True)[1] * size + self.code[place + k]
        _, one, count = np.unique(key, return_index=True, return_counts=True)
        return place[one], count

    def phrase(self, n: int, at: int) -> bytes:
        return b" ".join([self.vocab[c] for c in self.code[at:at + n].tolist()])


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[Tokens]:
    """The tokens of (text, lang) batches, about ``limit`` bytes of text at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            held.append(part)
            size += pc.sum(pc.binary_length(part.column(0))).as_py()
            if size >= limit:
                yield _tokens(held)
                held, size = [], 0
    if held:
        yield _tokens(held)


def _tokens(held: list[pa.RecordBatch]) -> Tokens:
    t = pa.Table.from_batches(held).combine_chunks()
    text = t.column(0).cast(pa.large_binary()).combine_chunks()
    lang = t.column(1).combine_chunks()
    return Tokens(text, lang)


def merge(names: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums the counts of equal names; the names come out sorted."""
    name, count = np.concatenate(names), np.concatenate(counts)
    if not len(name):
        return name, count
    order = np.argsort(name, kind="stable")
    name, count = name[order], count[order]
    first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
    return name[first], np.add.reduceat(count, first)


class Summary:
    """A Misra-Gries summary of weighted names.  A name's weight lies between its
    counter (0 if it has none) and its counter plus ``error``."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.error = capacity, 0
        self._names: list[np.ndarray] = []
        self._counts: list[np.ndarray] = []
        self._held = 0

    def add(self, names: np.ndarray, counts: np.ndarray) -> None:
        self._names.append(names)
        self._counts.append(counts)
        self._held += len(names)
        if self._held > 4 * self.capacity + (1 << 18):
            self.shrink()

    def shrink(self) -> None:
        if not self._names:
            return
        name, count = merge(self._names, self._counts)
        if len(name) > self.capacity:
            cut = np.partition(count, len(count) - self.capacity - 1)[len(count) - self.capacity - 1]
            self.error += int(cut)
            keep = count > cut
            name, count = name[keep], count[keep] - cut
        self._names, self._counts, self._held = [name], [count], len(name)

    def survivors(self, threshold: int) -> np.ndarray:
        self.shrink()
        if not self._names:
            return np.zeros(0, np.uint64)
        return self._names[0][self._counts[0] + self.error >= threshold]


def _part(names: np.ndarray, parts: int) -> np.ndarray:
    """Hash partition of sorted names, ascending."""
    return ((names >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _pack(names: np.ndarray) -> bytes:
    return np.ascontiguousarray(names.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


_SENT = "part long, kind int, mass long, ones binary, names binary, counts binary"
_SENT_ARROW = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("mass", pa.int64()),
                         ("ones", pa.binary()), ("names", pa.binary()), ("counts", pa.binary())])


def _send(name: np.ndarray, count: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Rows for the hash partitions: one with the mass, then the names, those that
    occur once without a count."""
    part = _part(name, parts)
    ids, lo = np.unique(part, return_index=True)
    hi = np.r_[lo[1:], len(part)]
    rows: list[tuple] = []
    for p, a, z in zip(ids.tolist(), lo.tolist(), hi.tolist()):
        rows.append((p, 0, int(count[a:z].sum()), b"", b"", b""))
        for s in range(a, z, ROW_NAMES):
            n, c = name[s:min(z, s + ROW_NAMES)], count[s:min(z, s + ROW_NAMES)]
            more = c > 1
            rows.append((p, 1, 0, _pack(n[~more]), _pack(n[more]), c[more].astype("<i8").tobytes()))
        if len(rows) >= 256:
            yield pa.record_batch([list(x) for x in zip(*rows)], schema=_SENT_ARROW)
            rows = []
    if rows:
        yield pa.record_batch([list(x) for x in zip(*rows)], schema=_SENT_ARROW)


def surviving_names(texts: DataFrame, threshold: int, max_words: int, parts: int) -> DataFrame:
    """name (long) of every n-gram that may occur ``threshold`` times."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for tokens in blocks(batches):
            for _, _, h in tokens.names(max_words):
                n, c = np.unique(h, return_counts=True)
                names.append(n)
                counts.append(c)
            if sum(map(len, names)) > HELD_NAMES:
                n, c = merge(names, counts)
                names, counts = [n], [c]
                if len(n) > HELD_NAMES // 2:
                    yield from _send(n, c, parts)
                    names, counts = [], []
        if names:
            yield from _send(*merge(names, counts), parts)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def done() -> Iterator[pa.RecordBatch]:
            if summary is not None:
                kept = summary.survivors(threshold).astype(np.int64)
                if len(kept):
                    yield pa.record_batch([pa.array(kept)], names=["name"])

        for batch in batches:
            for i in range(batch.num_rows):
                p, kind, more_mass, ones, more, counts = (c[i].as_py() for c in batch.columns)
                if p != part:
                    yield from done()
                    part, mass, summary = p, 0, None
                if kind == 0:                           # these come first
                    mass += more_mass
                    continue
                if summary is None:
                    summary = Summary(SLACK * mass // threshold + 1)
                one = _unpack(ones)
                summary.add(np.r_[one, _unpack(more)],
                            np.r_[np.ones(len(one), np.int64), np.frombuffer(counts, "<i8")])
        yield from done()

    n = max(parts, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (texts.mapInArrow(count, _SENT)
            .repartition(n, "part").sortWithinPartitions("part", "kind")
            .mapInArrow(fold, "name long"))


def _probe(names: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two filter bits of each name; ``bits`` is a power of two."""
    h = mix64(names)
    mask = np.uint64(bits - 1)
    return h & mask, (h >> np.uint64(32)) & mask


def name_filter(names: DataFrame) -> np.ndarray:
    """A Bloom filter of the names as bytes, at most FILTER_BITS bits: 16 to 32 bits a
    name, fewer beyond FILTER_BITS / 16 names.  Its 64-bit cells are put together by
    Spark; the driver gets the cells, never the names."""
    n = names.count()
    bits = 1 << 16
    while bits < min(16 * n, FILTER_BITS):
        bits *= 2

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.concatenate(_probe(batch.column(0).to_numpy().astype(np.uint64), bits))
            yield pa.record_batch([
                pa.array((bit >> np.uint64(6)).astype(np.int64)),
                pa.array((np.uint64(1) << (bit & np.uint64(63))).view(np.int64))], names=["cell", "bits"])

    found = names.mapInArrow(cells, "cell long, bits long") \
        .groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found.column("cell").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out.view(np.uint8)


def _passes(filt: np.ndarray, names: np.ndarray) -> np.ndarray:
    ok = np.ones(len(names), bool)
    for bit in _probe(names, 8 * len(filt)):
        ok &= (filt[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return ok


def frequent_ngrams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                    threshold: int = THRESHOLD, max_words: int = MAX_WORDS,
                    bytes_per_part: int = BYTES_PER_PART) -> DataFrame:
    """lang, phrase, words (1 to max_words), f: every n-gram with f >= threshold, and for
    each language a row of 0 words with the number of all its words."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
                        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    names = staged(surviving_names(texts, threshold, max_words, 1 + size // bytes_per_part),
                   "phrase-names")
    filt = spark.sparkContext.broadcast(name_filter(names))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(batches):
            total = np.bincount(t.lang, minlength=len(t.langs))
            lang, phrase = list(t.langs), [b""] * len(t.langs)
            words, f = [0] * len(t.langs), total.tolist()
            for n, place, h in t.names(max_words):
                first, count = t.count(n, place[_passes(filt.value, h)])
                lang += [t.langs[x] for x in t.lang[first].tolist()]
                phrase += [t.phrase(n, i) for i in first.tolist()]
                words += [n] * len(first)
                f += count.tolist()
            for lo in range(0, len(f), 1 << 16):
                s = slice(lo, lo + (1 << 16))
                yield pa.record_batch([pa.array(lang[s], pa.string()), pa.array(phrase[s], pa.binary()),
                                       pa.array(words[s], pa.int32()), pa.array(f[s], pa.int64())],
                                      names=["lang", "phrase", "words", "f"])

    counted = texts.mapInArrow(count, "lang string, phrase binary, words int, f long")
    return (counted.groupBy("lang", "words", F.col("phrase").cast("string").alias("phrase"))
            .agg(F.sum("f").alias("f"))
            .filter((F.col("words") == 0) | (F.col("f") >= threshold))
            .select("lang", "phrase", "words", "f"))


def _slice(start, length):
    return F.array_join(F.slice(F.split("phrase", " "), start, length), " ")


def score(counts: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of the phrases of two words and more: the cut
    with the lowest floor(SCALE * a / (l + r)), of equals the first.  Both parts of a
    frequent phrase are frequent, so they stand in ``counts`` too."""
    cuts = counts.filter("words > 1").withColumnRenamed("f", "a") \
        .withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"left": _slice(F.lit(1), F.col("cut")),
                             "right": _slice(F.col("cut") + 1, F.col("words") - F.col("cut"))})
    parts = counts.filter("words > 0")
    for side, out in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(out)),
                         ["lang", side])
    value = F.expr(f"cast(cast({SCALE} as decimal(8,0)) * cast(a as {_WIDE})"
                   f" div (cast(l as {_WIDE}) + cast(r as {_WIDE})) as bigint)")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct(value.alias("score"), "cut", "l", "r")).alias("best")) \
        .select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def covered(counts: DataFrame) -> DataFrame:
    """lang, phrase, longer: the count of the most frequent longer candidate that holds
    the phrase."""
    inner = F.expr("flatten(transform(sequence(2, words - 1), n -> "
                   "transform(sequence(1, words - n + 1), s -> "
                   "array_join(slice(split(phrase, ' '), s, n), ' '))))")
    return counts.filter("words > 2").select("lang", "f", F.explode(inner).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def top_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                threshold: int = THRESHOLD, max_words: int = MAX_WORDS, top: int = TOP,
                cover_percent: int = COVER_PERCENT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    counts = staged(frequent_ngrams(docs, text_col, lang_col, threshold, max_words), "phrase-counts")
    mostly = F.expr(f"cast(100 as decimal(3,0)) * cast(longer as {_WIDE})"
                    f" >= cast({cover_percent} as decimal(3,0)) * cast(a as {_WIDE})")
    kept = staged(score(counts).join(covered(counts), ["lang", "phrase"], "left")
                  .filter(F.col("longer").isNull() | ~mostly)
                  .select("lang", "phrase", "a", "l", "r", "score"), "phrase-scores")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salts = 1 + kept.count() // RANK_ROWS
    first = Window.partitionBy("lang", "salt").orderBy(*order)
    best = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts))) \
        .withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))
                             .cast("bigint")).filter(F.col("rank") <= top)
    n = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
