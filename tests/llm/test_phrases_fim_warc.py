"""Phrase mining, fill-in-middle and WARC against brute force, round trips and awkward rows."""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweave.llm import fim, phrases, warc

COLS = "doc_id long, text string, lang string, words int, phrase string, f long, salt int, rank int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _docs(spark, texts, langs):
    data = [(None if i == 2 else i, t, x, 1, "p", 2, 3, 4) for i, (t, x) in enumerate(zip(texts, langs))]
    return spark.createDataFrame(data, COLS).repartition(3)


# ------------------------------------------------------------------- phrases
def _counts(texts, langs, most=4):
    f = defaultdict(Counter)
    for t, x in zip(texts, langs):
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, most + 1):
                f["und" if x is None else x].update(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1))
    return f


def _mined(texts, langs, threshold, top, percent=80):
    out = []
    for lang, f in _counts(texts, langs).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= threshold}
        rows = []
        for p, a in cand.items():
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                        for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * c >= percent * a
                       and any(q[i:i + len(p)] == p for i in range(len(q))) for q, c in cand.items()):
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def _texts(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(9)] + ["É", "straße", "ÉCOLE", "The", "the", "\x1fx", "a\xa0b", "😀"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ; "]
    out = ["".join(w + rnd.choice(gaps) for w in rnd.choices(vocab, k=rnd.choice([0, 1, 2, 5, 30, 80])))
           for _ in range(n)]
    return out + [None, "", " \t ", "...", "New York City. " * 7, "new york city " * 5, "x " * 300, out[5], out[5]]


@pytest.mark.parametrize("block, held, parts", [(1 << 21, 1_500_000, 1 << 22), (64, 50, 200)])
def test_phrases_against_brute_force(spark, monkeypatch, block, held, parts):
    """With production bounds, and with tiny blocks, rows, summaries and a filter that
    lets nearly everything pass: the same rows."""
    texts = _texts(3, 90)
    langs = [(None, "en", "und", "fr")[i % 4] for i in range(len(texts))]
    if block == 64:
        monkeypatch.setattr(phrases, "ROW_NAMES", 7)
        monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 10)
    monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
    monkeypatch.setattr(phrases.blocks, "__defaults__", (block,))
    monkeypatch.setattr(phrases, "HELD_NAMES", held)
    monkeypatch.setattr(phrases.frequent_ngrams, "__defaults__",
                        (*phrases.frequent_ngrams.__defaults__[:-1], parts))
    for threshold, top in ((4, 2000), (9, 5)):
        got = phrases.top_phrases(_docs(spark, texts, langs), threshold=threshold, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == _mined(texts, langs, threshold, top)


def test_phrases_of_nothing(spark):
    assert phrases.top_phrases(_docs(spark, [], [])).collect() == []
    assert phrases.top_phrases(_docs(spark, [None, "", "a b c"], ["en", None, "en"])).collect() == []


def test_ranking_by_salts(spark, monkeypatch):
    texts = _texts(5, 60)
    langs = ["en"] * len(texts)
    monkeypatch.setattr(phrases, "RANK_ROWS", 3)
    got = phrases.top_phrases(_docs(spark, texts, langs), threshold=3, top=20)
    assert sorted(map(tuple, got.collect())) == _mined(texts, langs, 3, 20)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=60), min_size=1, max_size=8), st.integers(2, 9))
def test_every_frequent_name_survives(batches, threshold):
    mass = sum(map(len, batches))
    s = phrases.Summary(phrases.SLACK * mass // threshold + 1)
    monkey = s.capacity
    for b in batches:
        s.add(*phrases.merge([np.array(b, np.uint64)], [np.ones(len(b), np.int64)]))
        s.shrink()
        assert len(s._names[0]) <= monkey
    kept = set(s.survivors(threshold).tolist())
    true = Counter(x for b in batches for x in b)
    assert {x for x, c in true.items() if c >= threshold} <= kept
    assert s.error <= threshold / phrases.SLACK


def test_a_small_summary_drops_and_keeps():
    """300 names that occur once and 3 frequent ones through 20 counters."""
    s = phrases.Summary(20)
    for i in range(100):
        s.add(np.array([1, 2, 3, *range(1000 + 3 * i, 1003 + 3 * i)], np.uint64), np.ones(6, np.int64))
        s.shrink()
    kept = s.survivors(60)
    assert {1, 2, 3} <= set(kept.tolist()) and len(kept) <= 20


def test_names_travel_whole():
    names = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 1000, dtype=np.uint64))
    assert (phrases._unpack(phrases._pack(names)) == names).all()
    assert (np.diff(phrases._part(names, 37)) >= 0).all()


# ----------------------------------------------------------------------- fim
def _units(t, unit):
    return re.findall(r"[^\n]*\n|[^\n]+", t) if unit == "line" else list(t)


def _fim(doc_id, t, unit="line"):
    t = t or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    ls = _units(t, unit)
    a, b = sorted((h1 % (len(ls) + 1), h2 % (len(ls) + 1)))
    p, m, s = "".join(ls[:a]), "".join(ls[a:b]), "".join(ls[b:])
    if not t or "<P>" in t or "<S>" in t or "<M>" in t:
        return doc_id, len(ls), "plain", None, None, t
    if h4 % 100 < 50:
        return doc_id, len(ls), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(ls), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", fim.UNITS)
def test_fim_against_brute_force(spark, unit):
    rnd = random.Random(11)
    texts = ["".join(rnd.choices(["a", "é", "中", "😀", "\n", "\r", " ", "<", "P>", "\x00"], k=k))
             for k in (0, 1, 2, 3, 9, 30, 200) for _ in range(12)]
    texts += [None, "", "\n", "\n\n\n", "no newline", "ends\n", "<P>", "x<M>y", "x<S>", "é" * 70_000 + "\nz"]
    docs = _docs(spark, texts, ["en"] * len(texts))
    docs = docs.unionByName(docs.limit(3))
    got = fim.fill_in_middle(docs, unit=unit).collect()
    want = {_fim(None if i == 2 else i, t, unit) for i, t in enumerate(texts)}
    assert {(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got} == want
    assert len(got) == len(texts) + 3
    for r in got:
        text = (texts[2 if r.doc_id is None else r.doc_id] or "").encode()
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text).hexdigest()
    assert len({r.form for r in got}) == 3


def test_fim_shares_and_nothing(spark):
    docs = _docs(spark, ["a\nb"] * 400, ["en"] * 400)
    n = Counter(r.form for r in fim.fill_in_middle(docs, fim_percent=50, spm_percent=100, with_output=False)
                .select("form").collect())
    assert set(n) == {"plain", "spm"} and 120 < n["plain"] < 280
    assert fim.fill_in_middle(_docs(spark, [], [])).collect() == []
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, unit="word")


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aé中😀\n", max_size=60))
def test_index_converts_both_ways(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    index = fim.MultibyteIndex(raw)
    points = np.arange(len(text) + 1)
    at = np.array([len(text[:i].encode()) for i in points])
    assert (index.bytes(points) == at).all() and (index.points(at) == points).all()
    assert len(index.at) == sum(ord(c) > 127 for c in text)


# ---------------------------------------------------------------------- warc
PAGES = "page_id long, url string, html string, rid long, digest string, payload string, first long"


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "d", "p", 2) for i, u, h in rows], PAGES).repartition(3)


def _warc_want(rows):
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[(h or "").encode()].append(i)
    out = []
    for b, ids in groups.items():
        ids = sorted(ids, key=lambda x: (x is None, x))
        for place, i in enumerate(ids):
            again = place > 0 and len(b) >= 100
            out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response",
                        ids[0] if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    body = ["".join(rnd.choices("abc é中😀\r\n<>", k=k)) for k in (0, 1, 99, 100, 101, 500, 40_000)]
    out = [(i, f"http://x/{i}", rnd.choice(body)) for i in range(60)]
    return out + [(60, None, None), (None, "http://n", body[5]), (None, "u\r\nX-Page-ID: 9\r\n\r\n", body[4]),
                  (7, "http://again", body[5]), (7, "http://again", body[5]), (61, "ü", "x" * 99), (62, "", "x" * 100),
                  (63, "", "x" * 100), (64, "", "WARC/1.1\r\n\r\n" * 20)]


def test_archive_round_trip(spark, rows):
    got = warc.archive(_pages(spark, rows))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == _warc_want(rows)


def test_archive_of_nothing(spark, tmp_path):
    assert warc.archive(_pages(spark, [])).collect() == []


@pytest.mark.parametrize("range_bytes", [7, 100, 4096, 1 << 25])
def test_any_ranges_give_the_same_records(spark, rows, tmp_path, range_bytes):
    path = f"{tmp_path}/w"
    warc.write_warc(_pages(spark, rows[:25] if range_bytes == 7 else rows), path)
    if range_bytes == 7:                    # one small file; the others hold long members
        for f in sorted(os.listdir(path)):
            if os.path.getsize(f"{path}/{f}") > 6_000:
                os.truncate(f"{path}/{f}", 6_000)
    key = lambda df: sorted((r.path, r.offset, r.end, r.record_id, r.error, bytes(r.payload or b""))
                            for r in df.collect())
    whole = key(warc.read_warc(spark, path, 1 << 30).fillna({"record_id": "", "error": ""}))
    assert key(warc.read_warc(spark, path, range_bytes).fillna({"record_id": "", "error": ""})) == whole
    if range_bytes != 7:
        assert len(whole) == len(rows) and not any(r[4] for r in whole)


def test_files_are_gzip_members(spark, rows, tmp_path):
    """Any gzip reader sees WARC records one after the other."""
    warc.write_warc(_pages(spark, rows), f"{tmp_path}/w")
    n = 0
    for f in os.listdir(f"{tmp_path}/w"):
        if f.startswith("part-"):
            raw = gzip.open(f"{tmp_path}/w/{f}").read()
            while raw:
                rec = warc.parse_record(raw)
                end = raw.index(b"\r\n\r\n") + 4 + len(rec["block"])
                assert raw[end:end + 4] == b"\r\n\r\n"
                raw, n = raw[end + 4:], n + 1
    assert n == len(rows)


def _member(text: bytes, level=6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(text) + z.flush()


def test_foreign_archives(spark, tmp_path):
    """Members with a name field, an archive stored inside a record, magic bytes by chance, a
    broken member and one that the file ends in."""
    inner = warc.gzip_member(warc.build_record(1, 1, "in", b"inner", "d", None))
    block = b"\x1f\x8b\x08" + inner * 3
    outer = (b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:o>\r\nContent-Type: application/gzip\r\n"
             b"Content-Length: " + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")
    named = io.BytesIO()
    with gzip.GzipFile("some.name", "wb", fileobj=named) as g:
        g.write(warc.build_record(2, 5, "u", b"named", "d", None))
    broken = bytearray(warc.gzip_member(warc.build_record(3, 6, "u", b"lost" * 50, "d", None)))
    broken[-6] ^= 0xFF                      # its checksum
    last = warc.gzip_member(warc.build_record(4, 7, "u", b"end", "d", None))
    data = _member(outer, 0) + named.getvalue() + bytes(broken) + last + last[:-20]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.warc.gz").write_bytes(data)
    for size in (16, 64, 1 << 20):
        got = warc.read_warc(spark, f"{tmp_path}/f", size).orderBy("offset").collect()
        assert [(r.record_id and r.headers.get("x-page-id"), r.error) for r in got] == [
            (None, None), ("5", None), (None, "broken member"), ("7", None), (None, "broken member")]
        assert bytes(got[0].payload) == block and got[1].payload == b"named"


def test_long_records_end_with_a_zero_byte():
    for n in (10, warc._SHORT - 1, warc._SHORT, 3 * warc._SHORT + 5):
        m = warc.gzip_member(bytes(n))
        assert m[-1] == 0 and len(gzip.decompress(m)) == n


def test_a_damaged_archive_raises(spark, tmp_path, monkeypatch):
    whole = warc.build_record
    monkeypatch.setattr(warc, "build_record", lambda rid, p, u, body, d, first, date=warc.DATE:
                        whole(rid, p, u, body + b"!", d, first, date))
    with pytest.raises(Exception, match="damaged record"):
        warc.archive(_pages(spark, [(1, "u", "x")])).collect()
