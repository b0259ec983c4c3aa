"""Toxicity by multiple-instance learning.

Only documents carry labels, so a document is a bag of sentences: a sentence has
probability sigmoid(bias + weights of its words), and the document's is the
noisy-or 1 - prod(1 - p).  Bias and weights are trained on document labels
through the noisy-or; the sentence probabilities then locate what offends.

A word's weight is the sum over its features, the word and its prefixes.
Features come from a screening of the training sample (log-likelihood ratio of
their document counts against the label), which Spark counts.  Training reads at
most ``SAMPLE`` labelled documents in hash order, whole texts; every document is
scored.

Defined cases: a null or empty text has no sentences and score 0; labels that are
null or without document are not used; a document labelled toxic and clean counts
once with each; a null id counts as held out; without training rows every score
is 0; repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import hash_sample, small_batches, staged

#: Bound on the labelled documents that training reads.
SAMPLE = 8_000
#: Bound on the model's features.
MAX_FEATURES = 20_000
MIN_DOCS = 3
MIN_LLR = 14.0
PREFIXES = (3, 4, 5)
FOLDS = 5
_CACHE = 200_000
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def word_features(word: str) -> list[str]:
    return [word] + ["^" + word[:k] for k in PREFIXES if len(word) > k]


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, distinct lower-case words) of each sentence with words."""
    low = text.lower()
    whole = low if len(low) == len(text) else None
    for m in _SENTENCE.finditer(text):
        a, b = m.span()
        ws = set(_WORD.findall(whole[a:b] if whole else text[a:b].lower()))
        if ws:
            yield a, b, ws


class _Weights(dict):
    """word -> summed feature weights, filled on demand, bounded."""

    def __init__(self, model: dict[str, float]):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > _CACHE:
            self.clear()
        get = self.model.get
        v = sum(get(f, 0.0) for f in word_features(word))
        self[word] = v
        return v


def _fit_bags(y: np.ndarray, empty: np.ndarray, doc: np.ndarray, sent: np.ndarray,
              feat: np.ndarray, n_feat: int, steps: int = 400, l2: float = 2e-4):
    """Noisy-or logistic weights.  ``empty``: sentences without a feature by
    document; (sent, feat): one entry per feature occurrence; ``doc``: document
    of each sentence."""
    n, n_sent = len(y), len(doc)
    w, b = np.zeros(n_feat), -5.0
    mom, sq = np.zeros(n_feat + 1), np.zeros(n_feat + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(sent, w[feat], n_sent)
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-b))
        clean = np.bincount(doc, -np.logaddexp(0, z), n) - empty * np.logaddexp(0, b)
        bag = np.clip(-np.expm1(clean), 1e-9, 1)
        # d loss / d z_s = p_s * (1 - y / P)
        slope = 1 - y / bag
        gz = p * slope[doc]
        g = np.r_[np.bincount(feat, gz[sent], n_feat) / n + l2 * w,
                  (gz.sum() + p0 * (slope * empty).sum()) / n]
        mom, sq = .9 * mom + .1 * g, .99 * sq + .01 * g * g
        step = .15 * (mom / (1 - .9 ** t)) / (np.sqrt(sq / (1 - .99 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> dict[str, float]:
    """Feature -> weight (the bias under ''), learnt outside the held-out fold."""
    small_batches(docs.sparkSession)
    lab = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y"))
    lab = lab.filter(F.col("y").isin(0.0, 1.0) & ~held_out(F.col("doc_id"))).distinct()
    lab = hash_sample(lab, ["doc_id"], sample, order=["doc_id", "y"])     # at most ``sample`` rows
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
        .filter(F.col("text").isNotNull())
    rows = staged(d.join(F.broadcast(lab), "doc_id").dropDuplicates(["doc_id", "y"])
                  .select("y", "text"), "toxic-sample")

    def presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ys, fs = [], []
            for y, text in zip(pdf["y"], pdf["text"]):
                have = {f for _, _, ws in sentences(text) for w in ws for f in word_features(w)}
                fs.extend(have)
                ys.extend([y] * len(have))
            yield pd.DataFrame({"f": fs, "y": np.array(ys, float)})

    total = rows.agg(F.count("*"), F.sum("y")).first()
    n, n1 = float(total[0]), float(total[1] or 0)
    if not n1 or n1 == n:
        return {}
    spread = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    df = spread.mapInPandas(presence, "f string, y double").groupBy("f").agg(
        F.count("*").cast("double").alias("d"), F.sum("y").alias("d1"))

    def part(k, m):     # k log(k / (m * n1 / n)) with 0 log 0 = 0
        return F.when(k > 0, k * F.log(k / m)).otherwise(0.0)

    d_, d1 = F.col("d"), F.col("d1")
    llr = 2 * (part(d1, d_ * n1 / n) + part(d_ - d1, d_ * (n - n1) / n)
               + part(F.lit(n1) - d1, (n - d_) * n1 / n)
               + part((n - d_) - (n1 - d1), (n - d_) * (n - n1) / n))
    chosen = [r.f for r in df.filter(d_ >= MIN_DOCS).withColumn("llr", llr)
              .filter(F.col("llr") >= MIN_LLR).orderBy(F.desc("llr"), "f")
              .limit(MAX_FEATURES).collect()]
    index = {f: i for i, f in enumerate(chosen)}

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for y, text in zip(pdf["y"], pdf["text"]):
                lists = [[index[f] for w in ws for f in word_features(w) if f in index]
                         for _, _, ws in sentences(text)]
                used = [x for x in lists if x]
                out.append((y, len(lists) - len(used), used))
            yield pd.DataFrame(out, columns=["y", "empty", "s"])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [r for pdf in batches for r in pdf.itertuples(index=False)]
        got.sort(key=lambda r: (r.y, r.empty, [list(x) for x in r.s]))
        y = np.array([r.y for r in got])
        empty = np.array([r.empty for r in got], float)
        doc = np.array([i for i, r in enumerate(got) for _ in r.s], np.int64)
        lists = [list(x) for r in got for x in r.s]
        sent = np.array([i for i, x in enumerate(lists) for _ in x], np.int64)
        feat = np.array([f for x in lists for f in x], np.int64)
        w, b = _fit_bags(y, empty, doc, sent, feat, len(chosen))
        yield pd.DataFrame({"i": np.arange(-1, len(w)), "w": np.r_[b, w]})

    fitted = spread.mapInPandas(bags, "y double, empty bigint, s array<array<int>>") \
        .coalesce(1).mapInPandas(fit, "i bigint, w double").collect()   # <= MAX_FEATURES + 1 rows
    return {("" if r.i < 0 else chosen[r.i]): r.w for r in fitted}


def bag_score(text: str | None, model: dict[str, float], weight) -> tuple[float, list[dict]]:
    """(noisy-or probability, sentences with probability of a half or more)."""
    clean, found, bias = 0.0, [], model.get("", 0.0)
    for a, b, ws in sentences(text or "") if model else ():
        z = bias + sum(map(weight, ws))
        soft = max(z, 0.0) + math.log1p(math.exp(-abs(z)))
        clean -= soft
        if z >= 0:
            found.append({"start": a, "end": b, "score": -math.expm1(-soft)})
    return max(0.0, -math.expm1(clean)), found


def score(docs: DataFrame, model: dict[str, float], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, score, offending (sentences as likely as not to offend: start,
    end, score); one row per input row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight = _Weights(model).__getitem__
        for pdf in batches:
            got = [bag_score(t, model, weight) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": [g[0] for g in got],
                                "offending": [g[1] for g in got]})

    t = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = t.schema["doc_id"].dataType.simpleString()
    return t.mapInPandas(run, f"doc_id {kind}, score double, "
                              "offending array<struct<start:int,end:int,score:double>>")


def keep_clean(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and whatever else) that score under 0.5."""
    model = train(docs, labels, sample=sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = _Weights(model).__getitem__
        for b in batches:
            ok = [bag_score(t, model, weight)[0] < 0.5 for t in b.column("text").to_pylist()]
            yield b.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, offending."""
    scored = score(docs, train(docs, labels, id_col, text_col, label_col, sample),
                   id_col, text_col)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")
