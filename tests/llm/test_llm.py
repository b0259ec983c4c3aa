"""Operators of the llm subpackage against brute force and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from logweave.llm import (chatfmt, decontam, htmltext, licences, mixing, quality, simhash, substr,
                          tokencount, toxicity)
from logweave.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLS = ("doc_id long, text string, lang string, source string, n_chars int, rid string, key int, "
        "size int, fp string, score string, hot int, w int")


def rows(texts, sources=None):
    sources = sources or [f"s{i % 3}" for i in range(len(texts))]
    return [(None if i == 3 else i, t, "en", s, len(t or ""), "x", 1, 2, "y", "z", 0, 0)
            for i, (t, s) in enumerate(zip(texts, sources))]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(40)] + ["É", "straße", "The"]
    base = [" ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 2, 4, 9, 40, 120]))) for _ in range(40)]
    passage = " ".join(f"p{i}" for i in range(60))
    base += [None, "", "  \t\n", passage, "x " + passage + " y", "q " + passage[30:] + " r",
             "same " * 90, "a b c d e " * 20, base[7], base[7], base[7].replace(" ", "\n"),
             "one\ntwo\nOne \n\none\n" + base[5], "#$%&|<>* tail", "long " * 3 + base[6] * 3]
    return base


@pytest.fixture(scope="module")
def docs(spark, texts):
    sources = [None if i % 7 == 0 else f"s{i % 3}" for i in range(len(texts))]
    data = rows(texts, sources)
    return spark.createDataFrame(data + [data[9]], COLS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLS)


def words(t):
    return WORD.findall(t or "")


# --- near-duplicates

def brute_fp(t):
    ws = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    sh = [" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(codes, bits=3):
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def test_simhash_components(docs):
    got = simhash.near_duplicates(docs).collect()
    src = [(r.doc_id, r.text) for r in docs.collect()]
    codes = [brute_fp(t) for _, t in src]
    roots = brute_roots(codes)
    least = {r: min((src[i][0] for i in range(len(src)) if roots[i] == r and src[i][0] is not None),
                    default=None) for r in set(roots)}
    want = Counter((d, c - (1 << 64) if c >> 63 else c, least[r])
                   for (d, _), c, r in zip(src, codes, roots))
    assert Counter((r.doc_id, r.fp, r.component_id) for r in got) == want


@pytest.mark.parametrize("limit", [4096, 20])
def test_links_of_dense_groups(spark, limit):
    rnd = random.Random(limit)
    centre = rnd.getrandbits(64)
    codes = {0, centre}
    while len(codes) < 300:
        x = centre if rnd.random() < .7 else rnd.getrandbits(64)
        for _ in range(rnd.randrange(1, 9)):
            x ^= 1 << rnd.randrange(64)
        codes.add(x)
    codes = sorted(codes)
    df = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "fp long")
    comp = {r.node: r.root for r in simhash.components(
        simhash.fingerprint_links(df, limit=limit)).collect()}
    root = [comp.get(c - (1 << 64) if c >> 63 else c, c - (1 << 64) if c >> 63 else c) for c in codes]
    want = brute_roots(codes)
    assert len({(a, b) for a, b in zip(root, want)}) == len(set(want)) == len(set(root))


# --- decontamination

@pytest.mark.parametrize("index_limit, hash_limit", [(decontam.INDEX_LIMIT, 0), (0, decontam.HASH_LIMIT),
                                                     (0, 0)])
def test_decontamination(spark, docs, index_limit, hash_limit):
    items = [(1, " ".join(f"P{i}" for i in range(10, 25))), (2, "w1"), (3, None), (4, ""),
             (5, "straße the"), (None, "w2"), (12, "p5, p6; p7 p8"), (12, "p5, p6; p7 p8"),
             (6, "nowhere to be found at all in any of these texts whatever")]
    got = decontam.decontaminate(docs, spark.createDataFrame(items, "item_id int, text string"),
                                 index_limit=index_limit, hash_limit=hash_limit).collect()

    def split(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    wins = {(i, tuple(ws[s:s + 10])) for i, t in items if (ws := split(t))
            for s in range(max(1, len(ws) - 9))}
    want = Counter()
    for r in docs.collect():
        ws, hit, ids = split(r.text), set(), set()
        for i, w in wins:
            for s in range(len(ws) - len(w) + 1):
                if tuple(ws[s:s + len(w)]) == w:
                    hit |= set(range(s, s + len(w)))
                    ids |= {str(i)} - {"None"}
        want[(r.doc_id, len(ws), len(hit), ",".join(sorted(ids)))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in got) == want


# --- token counts

@pytest.fixture(scope="module")
def slow_encode():
    """Splits by the pattern with another engine and merges the lowest-ranked pair, one by one."""
    import base64

    import regex
    ranks = {base64.b64decode(t): int(r) for t, r in
             (x.split() for x in open(tokencount.VOCABULARY, "rb").read().splitlines() if x)}

    def encode(text):
        out = []
        for piece in regex.findall(tokencount.PATTERN, text):
            parts = [bytes([b]) for b in piece.encode()]
            while len(parts) > 1:
                rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
                if rank == 1 << 40:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            out += [ranks[p] for p in parts]
        return out
    return encode


def test_tokens_of_white_space_runs(slow_encode, monkeypatch):
    rnd = random.Random(5)
    content = open(tokencount.VOCABULARY, "rb").read()
    monkeypatch.setattr(tokencount, "LONG_RUN", 3)
    encode = tokencount.encoder(content)
    for n in (0, 1, 2, 5, 30, 90):
        for _ in range(40):
            t = "".join(rnd.choice(["a", "Wörter", "12", "'s", "!?", "\x1f", " ", "\n", "\t", "\u3000", "\x85"])
                        * rnd.choice([1, 1, 1, 5, 9]) for _ in range(n))
            assert encode(t) == slow_encode(t), repr(t)
    monkeypatch.undo()
    encode = tokencount.encoder(content)
    for ch in (" ", "\n", "a", "\u3000 "):
        for n in (10**5, 10**7):
            run = ch * (n // len(ch))
            k = len(encode("x" + run + "y"))
            assert k == len(encode("x" + run[:-1])) + len(encode(run[-1] + "y")) or ch == "a"


def test_token_histogram(docs, slow_encode):
    lens = [r.length for r in tokencount.token_lengths(docs).collect()]
    assert sorted(lens) == sorted(len(slow_encode(r.text or "")) for r in docs.collect())
    got = tokencount.token_counts(docs).collect()
    assert sum(r.n_docs for r in got) == len(lens) and {r.length for r in got} == set(lens)
    for r in got:
        assert r.n_tokens == r.length * r.n_docs and r.n_docs == lens.count(r.length)
        assert r.docs_up_to == sum(x <= r.length for x in lens)
        assert r.tokens_beyond == sum(x for x in lens if x > r.length)
        assert r.tokens_up_to == sum(x for x in lens if x <= r.length)
        assert r.docs_beyond == sum(x > r.length for x in lens)
        assert r.truncated_tokens == sum(min(x, r.length) for x in lens)
        assert r.quantile == pytest.approx(r.docs_up_to / len(lens))


# --- mixing

def test_mixing(docs):
    got = mixing.mix_sources(docs).collect()
    src = docs.collect()
    size = Counter()
    for r in src:
        size[r.source] += len(words(r.text))
    names = sorted(size, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), sum(size.values())
    while True:
        over = {s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 3 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * size[s]
            rest -= 3 * size[s]
        free -= over
    for s in free:
        target[s] = rest * weight[s] / sum(weight[x] for x in free)
    assert len(got) == len(src)
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) < 1.0 for s in names)
    _, stream = mixing.mix_stream(docs)
    order = stream.orderBy("total").collect()
    assert [r.total for r in order] == list(np.cumsum([r.words for r in order]))
    assert all(a.finish <= b.finish for a, b in zip(order, order[1:]))


# --- toxicity

def test_toxicity_learns_and_locates(spark):
    rnd = random.Random(3)
    fine = [f"word{i}" for i in range(60)]
    bad = ["vile" + c for c in ("a", "bo", "cu", "dix", "ert")] + ["nasty"]
    data = []
    for i in range(400):
        sents = [" ".join(rnd.choices(fine, k=8)) for _ in range(rnd.randrange(1, 9))]
        y = int(rnd.random() < .3)
        if y:
            k = rnd.randrange(len(sents))
            sents[k] += " " + rnd.choice(bad)
        data.append((i, ". ".join(sents) + ".", y))
    data += [(400, None, 0), (401, "", 1), (None, "nasty words", 1)]
    d = spark.createDataFrame([(a, b, "junk", 1) for a, b, _ in data],
                              "doc_id long, text string, score string, y int")
    lab = spark.createDataFrame([(a, 1, y) for a, _, y in data] + [(7, 1, None), (9999, 0, 1)],
                                "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(d, lab).collect()
    assert len(got) == len(data) and all(0 <= r.score <= 1 for r in got)
    truth = {a: y for a, _, y in data}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > .95
    text = {a: b for a, b, _ in data}
    for r in got:
        for s in r.offending:
            assert any(b in text[r.doc_id][s.start:s.end] for b in ("vile", "nasty"))
    assert all(r.score == 0 for r in got if r.doc_id in (400, 401))
    assert {r.score for r in toxicity.toxicity(d, lab.limit(0)).collect()} == {0.0}


# --- chats

def _paths(e, m, lens):
    """Best states of each piece by trying all of them."""
    import itertools
    out, at = [], 0
    for n in lens:
        best = max((sum(x) for x in [[-1e18]]), default=0)
        pick = None
        may = [np.flatnonzero(e[at + i] > -1e8).tolist() for i in range(n)]
        for path in itertools.product(*may):
            v = m["start"][path[0]] + e[at, path[0]] + sum(
                m["step"][path[i - 1], path[i]] + e[at + i, path[i]] for i in range(1, n))
            if v > best:
                best, pick = v, path
        out += pick
        at += n
    return out


def test_viterbi_against_all_paths(spark):
    """Pieces of one to five units, decoded at once, and the chain over cut partitions."""
    import pandas as pd
    rnd = random.Random(8)
    for seed in range(25):
        lens = [rnd.randint(1, 5) for _ in range(4)]
        n = sum(lens)
        starts = set(np.cumsum([0, *lens]).tolist())
        pdf = pd.DataFrame([{
            "sub": 0 if i in starts else rnd.choice([0, 1]), "mark": rnd.randrange(5), "kind": 0,
            "size": rnd.randrange(12), "lines": rnd.randrange(8), "ask": rnd.randrange(2)} for i in range(n)])
        pdf["kind"] = [rnd.randrange(1, 7) if x else 0 for x in pdf["mark"]]
        pdf.loc[(pdf["sub"] == 1) & (pdf["mark"] == 0), "sub"] = 0
        model = chatfmt.train(spark.createDataFrame([], chatfmt._UNIT.format(c="int", t="int"))) \
            if seed == 0 else model  # noqa: F821
        for k in ("size", "lines", "ask"):
            w = np.random.default_rng(seed).random(model[k].shape)
            model[k] = np.log(w / w.sum(axis=1, keepdims=True))
        e = chatfmt._scores(pdf, model)
        cut = np.cumsum([0, *lens[:-1]])
        assert chatfmt._decode(e, cut, model, None, None).tolist() == _paths(e, model, lens)


def test_viterbi_over_any_partitions(spark):
    conv = table(spark, SF, "conversations").select("conv_id", "turn", "role", "text")
    one = conv.filter("conv_id < 40").withColumn("turn", F.col("turn") + 20 * F.col("conv_id")) \
        .withColumn("conv_id", F.lit(1))
    both = conv.filter("conv_id >= 40").unionByName(one)
    said = both.withColumn("text", F.when(F.col("turn") % 3 == 0, F.concat(
        F.lit("User: "), "text", F.lit("\nAssistant: yes\nModel: X\nhuman: why?"))).otherwise(F.col("text")))
    units = chatfmt.split_turns(said)
    model = chatfmt.train(units)
    base = None
    for n in (1, 4, 17):
        got = {(r.rid, r.sub): (r.role, r.stands) for r in chatfmt.viterbi(units, model, n).collect()}
        base = base or got
        assert got == base
    # Decoding does not look at the roles.
    blind = chatfmt.viterbi(units.withColumn("role", F.lit(None).cast("string")), model, 4)
    assert {(r.rid, r.sub): (r.role, r.stands) for r in blind.collect()} == base
    units = chatfmt.split_turns(both)
    truth = {r.rid: r.role for r in units.filter("sub = 0").collect()}
    got = {r.rid: r.role for r in chatfmt.viterbi(units.drop("role"), chatfmt.train(units), 4).collect()}
    assert np.mean([got[k] == v for k, v in truth.items()]) > .9


def _said(spark, *texts):
    d = spark.createDataFrame([(1, i, None, t) for i, t in enumerate(texts)],
                              "conv_id int, turn int, role string, text string")
    return [(r.turn, r.part, r.role, r.rendered.split("\n", 1)[1][:-len("\n<|end|>")])
            for r in chatfmt.format_chats(d).orderBy("turn", "part").collect()]


@pytest.mark.parametrize("text", ["user\nadmin\nroot", "I bought it.\nModel: X100", "function\nme\nmodel\nanswer",
                                  "Model: X100\nColour: red", "user", "Question", "a\nAnswer: 42\nb", "me:",
                                  "the roles are\nuser\nassistant\n"])
def test_no_word_is_lost(spark, text):
    for said in ([text], ["Hello, can you help me?", text], ["Hello?", "Yes.", text]):
        got = _said(spark, *said)
        assert [t for _, _, _, t in got] == [x.strip() for x in said]


def test_markers_that_open_turns(spark):
    got = _said(spark, "<|user|>hello\n<|assistant|>\nhi", "Human: x\ny\nAI: z", "user\nhello\nassistant\nhi you",
                "### Instruction:\nwrite\n### Response:\nwritten")
    assert [(t, p, r, x) for t, p, r, x in got] == [
        (0, 0, "user", "hello"), (0, 1, "assistant", "hi"), (1, 0, "user", "x\ny"), (1, 1, "assistant", "z"),
        (2, 0, "user", "hello"), (2, 1, "assistant", "hi you"), (3, 0, "system", "write"),
        (3, 1, "assistant", "written")]


def test_rendering_is_canonical(spark):
    texts = ["\t\n a <|end|>\nx <|user|> b \x0b", "<\\|x|>", "<|", "< |", "\\"]
    got = [r for *_, r in _said(spark, *texts)]
    assert got == ["a <\\|end|>\nx <\\|user|> b", "<\\\\|x|>", "<\\|", "< |", "\\"]
    assert [re.sub(r"<(\\*)\\\|", r"<\1|", r) for r in got] == [t.strip() for t in texts]


def test_the_sample_takes_blocks_of_long_conversations(spark):
    """Three conversations of 20,000 turns, sample of 2,000: rows of all three."""
    d = spark.range(60_000).select(
        (F.col("id") % 3).cast("int").alias("conv_id"), F.floor(F.col("id") / 3).cast("int").alias("turn"),
        F.when(F.floor(F.col("id") / 3) % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.floor(F.col("id") / 3) % 2 == 0, "why?").otherwise(F.repeat(F.lit("because "), 9)).alias("text"))
    units = chatfmt.split_turns(d)
    m = chatfmt.train(units, 2000)
    prior = chatfmt.train(units.limit(0), 2000)
    user, bot = chatfmt.ROLES.index("user"), chatfmt.ROLES.index("assistant")
    assert m["ask"][user, 1] > -.01 > prior["ask"][user, 1] and m["step"][user, bot] > -.01
    got = chatfmt.viterbi(units, m).join(units.select("rid", F.col("role").alias("truth")), "rid")
    assert got.filter("role = truth").count() > 59_000


def test_chat_markers_and_awkward_rows(spark):
    data = [(1, 0, None, "User: hello\nAssistant: hi\nthere\nuser: bye"), (1, 1, "odd", None),
            (None, None, "user", "Human: x"), (2, 0, "user", ""), (2, 0, "user", "")]
    got = chatfmt.format_chats(spark.createDataFrame(
        data, "conv_id int, turn int, role string, text string")).collect()
    first = sorted((r.part, r.role, r.rendered) for r in got if r.conv_id == 1 and r.turn == 0)
    assert first == [(0, "user", "<|user|>\nhello\n<|end|>"),
                     (1, "assistant", "<|assistant|>\nhi\nthere\n<|end|>"),
                     (2, "user", "<|user|>\nbye\n<|end|>")]
    assert len(got) == 7


# --- pages

def test_html():
    body = "The quick story of the town and the river that ran through it for many years. " * 4
    page = ("<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var a='</p>';"
            "</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>"
            "<div class='ad'>Buy now and be happy with the offer</div><article><h1>Head &amp; tail</h1>"
            f"<p>{body}<br>next<p>Short one.</p><!-- gone --><div class=comments><p>{body}</p></div>"
            "<form>sign up</form></article><aside>see also</aside><footer>&copy; me</footer>")
    flat = " ".join(body.split())
    assert htmltext.main_text(page) == f"Head & tail\n{flat} next\nShort one."
    assert htmltext.main_text(None) == htmltext.main_text("") == ""
    assert htmltext.main_text("<article><p>Only words<scr") == "Only words"
    plain = f"<body><ul><li><a>Menu</a></li></ul><p>Hi</p><p>{body}</p><p>Bye</p></body>"
    assert htmltext.main_text(plain).split("\n")[-2:] == [flat, "Bye"]


def test_hints_do_not_swallow_articles():
    body = "The quick story of the town and the river that ran through it for many years. " * 4
    flat = " ".join(body.split())
    article = f"<article><p>{body}</p></article>"
    for page in (f"<div style='overflow:hidden'>{article}</div>", f"<div class=widget>{article}</div>",
                 f"<body class='single has-sidebar'>{article}</body>",
                 f"<body class='sidebar'>{article}</body>", f"<div data-x='hidden'>{article}</div>",
                 f"<div class='no-sidebar nav-open'>{article}</div>",
                 f"<article><section id=related-work><p>{body}</p></section></article>",
                 f"<article><section id=related><p>{body}</p></section></article>",
                 f"<div class=overlay><p>{body}</p></div><div class=ad>Buy the thing</div>"):
        assert htmltext.main_text(page) == flat, page
    page = f"<article><h2 id=social-impact>Impact</h2><p>{body}</p><h2 id=social>More</h2></article>"
    assert htmltext.main_text(page) == f"Impact\n{flat}\nMore"
    page = f"<div class=overlay><p>{body}</p><p>Short.</p><div class=ad>Buy</div></div>"
    assert htmltext.main_text(page) == f"{flat}\nShort."
    for gone in ("hidden", "hidden=''", "style='color:red; display: none'", "aria-hidden=true",
                 "class='big comments'", "id=comments"):
        assert htmltext.main_text(f"{article}<div {gone}><p>{body}</p></div>") == flat, gone


def test_raw_elements_end():
    body = "The quick story of the town and the river that ran through it for many years. " * 4
    flat = " ".join(body.split())
    article = f"<article><p>{body}</p></article>"
    for tag in ("<svg-icon></svg-icon>", "<title-bar></title-bar>", "<svg class='i'/>", "<svg class=i>",
                "<svg viewBox='0 0 1 1' />", "<object data='x'/>", "<template/>", "<iframe src=x>",
                "<noscript>", "<object-view>", "<svg><title>t</title><path d='M0'/></svg>",
                "<template><p>no</p></template >", "<script >var a='<svg>'</script x>"):
        assert htmltext.main_text(tag + article) == flat, tag
        assert htmltext.main_text(tag + article + "<svg><text>no</text></svg>") == flat, tag
        assert htmltext.main_text(f"<article><p>{body}{tag}</p></article>") == flat, tag
    assert htmltext.main_text(article + "<script>var a = 1") == flat
    for end in ("", "</svg>", "</iframe>"):
        assert htmltext.main_text("<svg class=i>" * 20_000 + article + end) == flat


def test_nearest_label_of_many_blocks():
    rnd = random.Random(3)
    for n in (0, 1, 5, 60):
        groups = [rnd.randrange(3) for _ in range(n)]
        labels = [rnd.choice([True, False, None, None, None]) for _ in range(n)]
        want = []
        for i in range(n):
            near = [(abs(i - j), j < i, j) for j in range(n)
                    if groups[j] == groups[i] and labels[j] is not None]
            want.append(labels[min(near)[2]] if near else None)
        assert htmltext.nearest_label(groups, labels) == want
    page = "<body><article>" + "<p>Yes.</p>" * 50_000 + "</article></body>"
    assert htmltext.main_text(page) == "\n".join(["Yes."] * 50_000)


PROSE = {
    "en": "The quick story of the town and the river that ran through it for many years. ",
    "it": "Il fiume scorreva tra le colline e gli abitanti raccontavano ancora storie di tempi lontani. ",
    "ru": "Река текла между холмами, и жители всё ещё рассказывали истории о далёких временах. ",
    "zh": "河流在山丘之间流淌，居民们仍然讲述着遥远时代的故事，谁也不知道它们从哪里来。",
    "pl": "Rzeka płynęła między wzgórzami, a mieszkańcy wciąż opowiadali historie z dawnych czasów. ",
    "fi": "Joki virtasi kukkuloiden välissä ja asukkaat kertoivat yhä tarinoita kaukaisista ajoista. ",
    "de": "Der Fluss lief zwischen den Hügeln und die Leute erzählten sich noch immer von alten Zeiten. "}


@pytest.mark.parametrize("lang", PROSE)
def test_pages_of_any_language(lang):
    """No article element: a heading, three paragraphs, a menu, teasers and a footer."""
    body = " ".join((PROSE[lang] * 4).split())
    teaser = f"<a href=x><div><h3>Altro</h3><p>{PROSE[lang] * 2}</p></div></a>"
    page = (f"<body><div><a href=a>Uno due tre</a> <a href=b>Quattro cinque</a></div><div><h1>Titolo</h1>"
            f"<p>{body}</p><p>{body}</p><p>{body}</p></div><div>{teaser * 3}</div><footer>x {body}</footer></body>")
    assert htmltext.main_text(page) == "\n".join(["Titolo", body, body, body])


def test_links_and_notices_inside_an_article():
    body = " ".join((PROSE["en"] * 4).split())
    refs = "".join(f"<li><a href=x{i}>Reference number {i}, a book about rivers</a></li>" for i in range(3))
    flat = [f"Reference number {i}, a book about rivers" for i in range(3)]
    owner = "© the word of the law: " + body
    page = f"<main><p>{body}</p><ul>{refs}</ul><p>{owner}</p><p>© 2020 Me</p></main>"
    assert htmltext.main_text(page) == "\n".join([body, *flat, owner])
    assert htmltext.main_text(f"<p>{body}</p><ul>{refs}</ul>") == body
    open_link = f"<div><a href=x>menu</div><p>{body}</p>"
    assert htmltext.main_text(open_link) == body


@pytest.mark.parametrize("page", [
    "<a b " * 200_000 + '"', "<a b='\"" * 100_000, "<div>" * 2000 + "</section>" * 90_000, '<a href="x>' * 90_000,
    "<!--" * 250_000, "<" * 1_000_000, "<a href=x>" * 50_000 + "<div>" * 80_000, "<svg>" * 200_000,
    "<p class=\"a" * 90_000, "</a " * 250_000])
def test_a_megabyte_of_broken_tags(page):
    import time
    body = " ".join((PROSE["en"] * 4).split())
    began = time.process_time()
    htmltext.main_text(page)
    htmltext.main_text(f"<article><p>{body}</p></article>" + page)
    assert time.process_time() - began < 4          # two pages
    for tail in ('<p title="odd>', "<p title='odd", "<b x"):
        assert htmltext.main_text(f"<article><p>{body}</p></article>{tail}") == body


def test_html_rows(spark):
    d = spark.createDataFrame([(1, None, None, 0), (None, "u", "<p>a</p>", 1), (1, None, None, 0)],
                              "page_id int, url string, html string, text int")
    got = sorted((str(r.page_id), r.text) for r in htmltext.extract_pages(d).collect())
    assert got == [("1", ""), ("1", ""), ("None", "a")]


# --- licences

def test_licences(spark):
    rnd = random.Random(1)
    prose = [" ".join(rnd.choices(["tree", "the", "river", "and", "town", "old", "of"], k=30))
             for _ in range(60)]
    data = [(i, p, 0) for i, p in enumerate(prose)]
    data += [(100, prose[0] + "\nReleased under the MIT License.", 0), (101, None, 0), (102, "", 0),
             (103, "Licensed under the Apache License, Version 2.0.\nAll rights reserved.", 0),
             (104, "This work is licensed under the Zebra Public Licence.", 0),
             (None, prose[1] + " " + "licensed under CC BY-NC 4.0 " + prose[2], 0)]
    got = {(r.doc_id, r.par): r.family for r in licences.scan(
        spark.createDataFrame(data, "doc_id int, text string, family int")).collect()}
    assert got[(100, 1)] == "mit" and got[(103, 0)] == "apache-2.0"
    assert got[(103, 1)] == "proprietary" and got[(104, 0)] == "unknown"
    assert not [k for k in got if k[0] is not None and k[0] < 100]


def test_licence_phrases_name_one_family():
    for family, phrases in licences.PHRASES.items():
        for phrase in phrases:
            assert len(phrase.split()) <= licences.MAX_WORDS // 2
            assert not [f for f, texts in licences.TEXTS.items() if f != family
                        and any(f" {phrase} " in f" {x} " for x in texts)]


def test_licence_texts_and_short_forms(spark):
    rnd = random.Random(2)
    prose = [" ".join(rnd.choices(["tree", "the", "river", "and", "town", "old", "of"], k=30))
             for _ in range(60)]
    grant = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software '
             'and associated documentation files (the "Software"), to deal in the Software without '
             'restriction, including without limitation the rights to use, copy, modify, merge, publish, '
             'distribute, sublicense, and/or sell copies of the Software')
    apache = ('Unless required by applicable law or agreed to in writing, software distributed under the '
              'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.')
    bsd = ("Redistributions of source code must retain the above copyright notice, this list of conditions "
           "and the following disclaimer.")
    gpl = ("it under the terms of the GNU {}General Public License as published by the Free Software "
           "Foundation, either version {} of the License, or (at your option) any later version.")
    want = [
        (grant, "mit"), (f"{prose[0]} {grant} {prose[1]}", "mit"), (grant[:76], "mit"),
        (grant[77:150], "mit"), (apache, "apache-2.0"), (f"{prose[2]} {apache}", "apache-2.0"),
        ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
        (bsd, "bsd"), (f"{prose[3]} {bsd} {prose[4]}", "bsd"),
        ("* Redistributions in binary form must reproduce the above copyright notice,", "bsd"),
        (gpl.format("", 3), "gpl-3.0"), (gpl.format("", 2), "gpl-2.0"),
        (gpl.format("Lesser ", 3), "lgpl"), (gpl.format("Affero ", 3), "agpl"),
        ("purpose with or without fee is hereby granted, provided that the above copyright notice", "isc"),
        ("If a copy of the MPL was not distributed with this file, You can obtain one", "mpl-2.0"),
        ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"), ("SPDX-License-Identifier: MIT", "mit"),
        ("SPDX-License-Identifier: ISC", "isc"), ("BSD-3-Clause", "bsd"),
        ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0"),
        ("GNU General Public License v3.0", "gpl-3.0"), ("CC BY 3.0", "cc-by"),
        ("https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa"),
        (f"{prose[5]} licensed under CC BY-NC 4.0 {prose[6]}", "cc-by-nc"),
        ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of "
         "the software and accompanying documentation covered by this license", "unknown")]
    data = [(i, x) for i, x in enumerate(prose)] + [(100 + i, x) for i, (x, _) in enumerate(want)]
    data.append((99, "the town was old and the people of the river had permission to copy the tree"))
    got = {r.doc_id: r.family for r in licences.scan(
        spark.createDataFrame(data, "doc_id int, text string")).collect()}
    assert {100 + i: f for i, (_, f) in enumerate(want)} == got


TEXTS = {
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version."""}


def test_wrapped_licences_and_variants(spark):
    """Texts wrapped at three widths amid prose are one notice each, on their lines; the
    Creative Commons variants are told apart."""
    import textwrap
    rnd = random.Random(4)
    prose = [" ".join(rnd.choices(["tree", "the", "river", "and", "town", "old", "of"], k=30))
             for _ in range(60)]
    data, want = [(i, p) for i, p in enumerate(prose)], {}
    for family, text in TEXTS.items():
        for width in (60, 72, 80):
            lines = textwrap.wrap(" ".join(text.split()), width)
            k = 100 + len(want)
            data.append((k, "\n".join(["The old town and the river.", "", *lines, "", prose[k % 60]])))
            want[k] = (family, 2, len(lines))
    variants = {"CC BY-NC-SA 4.0": "cc-by-nc-sa", "CC BY-NC-ND 4.0": "cc-by-nc-nd", "CC BY-ND 4.0": "cc-by-nd",
                "CC BY-NC 4.0": "cc-by-nc", "CC BY-SA 4.0": "cc-by-sa", "CC BY 4.0": "cc-by",
                "https://creativecommons.org/licenses/by-nc-sa/4.0/": "cc-by-nc-sa",
                "Creative Commons Attribution-NonCommercial-ShareAlike": "cc-by-nc-sa"}
    data += [(500 + i, f"This work is licensed under {v}.") for i, v in enumerate(variants)]
    got = {}
    for r in licences.scan(spark.createDataFrame(data, "doc_id int, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.family, r.par, r.last_line))
    for k, (family, first, n) in want.items():
        assert len(got[k]) == 1 and got[k][0][0] == family, (k, family, got.get(k))
        _, lo, hi = got[k][0]
        assert lo <= first + 2 and first + n // 3 <= hi < first + n, (family, got[k], n)
    assert [got[500 + i][0][0] for i in range(len(variants))] == list(variants.values())
    assert not [k for k in got if k < 100]


# --- repeated substrings

def brute_substr(texts):
    ws = [words(t) for t in texts]
    n = Counter(tuple(w[s:s + 35]) for w in ws for s in range(len(w) - 34))
    out = []
    for w in ws:
        gone = {x for s in range(len(w) - 34) if n[tuple(w[s:s + 35])] > 1 for x in range(s, s + 35)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), kept))
    return out


@pytest.mark.parametrize("hot_rows", [substr.HOT_ROWS, 1])
def test_substrings(docs, hot_rows):
    src = docs.collect()
    want = Counter((r.doc_id, n, g, hashlib.sha256(k.encode()).hexdigest())
                   for r, (n, g, k) in zip(src, brute_substr([r.text for r in src])))
    got = substr.dedup_substrings(docs, hot_rows=hot_rows).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(5)
    for _ in range(60):
        size = rnd.choice([1, 2, 3, 10, 500])
        shared = [str(rnd.randrange(size)) for _ in range(60)]
        ts = []
        for _ in range(4):
            a = [str(rnd.randrange(size)) for _ in range(rnd.randrange(90))]
            i = rnd.randrange(len(a) + 1)
            ts.append(a[:i] + shared[rnd.randrange(20):] + a[i:])
        lens = np.array([len(t) for t in ts])
        names = np.array([xxhash.xxh64_intdigest(w) for t in ts for w in t], np.uint64)
        got = {(t, s): k for t, k, lo, hi, _ in zip(*substr.anchors(names, lens))
               for s in range(lo, hi + 1)}
        assert set(got) == {(i, s) for i, t in enumerate(ts) for s in range(len(t) - 34)}
        by = {}
        for (i, s), k in got.items():
            assert by.setdefault(tuple(ts[i][s:s + 35]), k) == k


# --- quality

def test_quality(docs):
    src = docs.collect()
    got = quality.quality_rules(docs, min_docs=2, host_share=0.0).collect()
    norm = lambda x: " ".join(words(x.lower()))
    held = Counter()
    for s, t in {(r.source, r.text or "") for r in src}:
        held.update({(s, norm(x)) for x in t.split("\n") if words(x)})
    want = Counter()
    for r in src:
        t = r.text or ""
        w, lines = words(t), [x for x in t.split("\n") if words(x)]
        grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        rep = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        lost = sum(len(words(x)) for x in lines if held[(r.source, norm(x))] > 2)
        failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
        want[(r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t),
              len(lines) - len(set(lines)), len(rep), lost, failed,
              not failed and len(w) - lost >= .5 * len(w))] += 1
    assert Counter(tuple(r) for r in got) == want


def test_quality_limits_of_small_and_large_hosts(spark):
    def host(name, n, held):
        return [(f"{name}{i}", " ".join(f"{name}{i}w{k}" for k in range(12))
                 + ("\nsubscribe to our letter" if i < held else ""), name) for i in range(n)]

    data = host("a", 500, 20) + host("b", 500, 21) + host("c", 2500, 25) + host("d", 2500, 26)
    got = quality.quality_rules(spark.createDataFrame(data, "doc_id string, text string, source string"))
    lost = Counter(r.doc_id[0] for r in got.filter("n_boilerplate_words = 4").collect())
    assert lost == {"b": 21, "d": 26}


# --- empty tables, pipeline

def test_empty_tables(spark, empty):
    items = spark.createDataFrame([], "item_id int, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    conv = spark.createDataFrame([], "conv_id int, turn int, role string, text string")
    pages = spark.createDataFrame([], "page_id int, url string, html string")
    for df in (simhash.near_duplicates(empty), decontam.decontaminate(empty, items),
               tokencount.token_counts(empty), mixing.mix_sources(empty),
               toxicity.toxicity(empty, labels), chatfmt.format_chats(conv),
               htmltext.extract_pages(pages), licences.scan(empty),
               substr.dedup_substrings(empty), quality.quality_rules(empty)):
        assert df.count() == 0


def test_stages(spark, docs):
    src = docs.collect()
    one = simhash.keep_one(docs)
    assert one.columns == docs.columns
    codes = [brute_fp(r.text) for r in src]
    roots = brute_roots(codes)
    kept = one.collect()
    assert len(kept) == len(set(roots))
    cut = substr.remove_substrings(docs).collect()
    want = Counter()
    for r, (n, g, k) in zip(src, brute_substr([r.text for r in src])):
        want[(r.doc_id, k if g else r.text)] += 1
    assert Counter((r.doc_id, r.text) for r in cut) == want
    assert all(r.n_chars == len(r.text or "") for r in cut)
    items = spark.createDataFrame([(1, " ".join(f"p{i}" for i in range(10, 25)))],
                                  "item_id int, text string")
    left = decontam.keep_uncontaminated(docs, items).collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter(
        (r.doc_id, r.text) for r in src if "p10 p11" not in (r.text or ""))


def test_stages_keep_columns_with_working_names(docs):
    names = ["k_id", "k_key", "k_row", "k_bad", "h_own", "h_t", "h_p", "h_gone", "rid2"]
    extra = docs.select("*", *[F.col("doc_id").alias(n) for n in names])
    items = docs.sparkSession.createDataFrame([(1, "p1 p2 p3")], "item_id int, text string")
    for stage in (simhash.keep_one, substr.remove_substrings,
                  lambda d: decontam.keep_uncontaminated(d, items)):
        out, plain = stage(extra), stage(docs)
        assert out.columns == extra.columns
        got = Counter(tuple(r) for r in out.select(*docs.columns).collect())
        assert got == Counter(tuple(r) for r in plain.collect())
        assert not out.filter(~F.col("k_row").eqNullSafe(F.col("doc_id"))).count()


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "substrings", "decontamination", "mixing"]
    d = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, SF)
        assert out.columns == d.columns and out.count() <= d.count()
    got = corpus_pipeline.run(spark, SF).collect()
    assert got and all(r.taken <= 3 * r["size"] for r in got)
