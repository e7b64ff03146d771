"""Small tests of the operators against brute force, and of their defined results at the edges."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from catamill.llm import byte_bpe, html_wrapper, language_id, ngram_join, packing, pitman_yor, quality_classifier, quality_rules, queries, seating, telephony, url_filter
from catamill.llm.components import connected
from catamill.session import table

SPACE = r"[\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    None, "", " ", "\n\n", "a", "One two", "Ünïcode  double\tspace\r\n end ", "x" * 5000, "\x00 nul\x00", "same words here now", "same words here now", "日本語 テキスト。", "it's  don't\u00a0stop… 1234 ½",
    "#$ %% ** <>|&", " ".join(f"w{k}" for k in range(3000)), "row of words " * 40, "e\u0301 , f", "<b>&amp;</b>",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, null ids, and columns named like what operators make."""
    rows = [(k, t, "en" if k % 3 else None, "s", 1, "x", 2.0, [1], b"z") for k, t in enumerate(ODD)] + [(3, ODD[3], "en", "s", 1, "x", 2.0, [1], b"z")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, qr string, score double, w array<int>, media binary").repartition(3)


def words(t):
    return [x for x in re.split(SPACE, t or "") if x]


def texts_of(sf):
    import pyarrow.parquet as pq

    d = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return dict(zip(d["doc_id"], d["text"], strict=True))


# 1. Audio


def test_op1(spark, sf, odd):
    texts = texts_of(sf)
    got = {r.doc_id: r for r in queries.op1_telephony(spark, sf).collect()}
    assert len(got) == len(texts)
    for k, t in texts.items():
        data = (t or "").encode()
        padded = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        r = got[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    payload = odd.select("doc_id", telephony.padded(F.col("text")).alias("payload"), F.lit(1).alias("media"))
    for codec in (telephony.MULAW, telephony.ALAW, telephony.IMA):
        back = telephony.expand(telephony.store(payload, codec)).collect()
        assert sorted((r.doc_id, bytes(r.payload)) for r in back) == sorted((r.doc_id, bytes(r.payload)) for r in payload.collect())
        assert all(r.pcm[:4] == b"RIFF" and r.feature.startswith(f"{codec}:16000:") for r in back)
    assert telephony.expand(telephony.store(payload.limit(0))).count() == 0
    assert telephony.expand(telephony.store(spark.createDataFrame([(1, None), (2, b"")], "doc_id long, payload binary"))).orderBy("doc_id").select("payload").collect()[0][0] is None


def test_codecs():
    assert telephony.MULAW_TABLE[[0x00, 0x7F, 0x80, 0xFF]].tolist() == [-32124, 0, 32124, 0]
    assert telephony.ALAW_TABLE[[0x55, 0xD5, 0x2A, 0xAA]].tolist() == [-8, 8, -32256, 32256]

    def plain(block):
        value, index, out = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88), []
        out.append(value)
        for b in block[4:]:
            for code in (b & 15, b >> 4):
                step = int(telephony.IMA_STEPS[index])
                d = step >> 3
                for bit, s in ((4, step), (2, step >> 1), (1, step >> 2)):
                    d += s if code & bit else 0
                value = max(-32768, min(32767, value - d if code & 8 else value + d))
                index = max(0, min(88, index + int(telephony.IMA_MOVES[code])))
                out.append(value)
        return out

    raw = np.random.default_rng(1).integers(0, 256, (20, 64), dtype=np.uint8)
    assert telephony.decode_ima(raw).tolist() == [plain(b.tobytes()) for b in raw]
    wave = (np.sin(np.arange(1000) / 9) * 9000).astype(np.int16)
    back = telephony.decode_ima(np.frombuffer(telephony.encode_ima(wave), np.uint8).reshape(-1, 64)).ravel()[:1000]
    assert np.abs(back.astype(int) - wave).mean() < 300
    assert telephony.doubled(np.array([0, 10, 20], np.int16)).tolist() == [0, 5, 10, 15, 20, 20]


# 2. BPE


def tiktoken_of(name):
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def test_op2(spark, sf, odd):
    e, ranks = tiktoken_of("byte_bpe_multi_50k.tiktoken")
    texts, seen = texts_of(sf), 0
    for r in queries.op2_byte_bpe(spark, sf).collect():
        ids = e.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest())
        seen += 1
    assert seen == len(texts)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_bpe.encode(odd, path, public_tokenizers.PATTERN)
    assert sorted((r.doc_id, r.ids) for r in ids.collect()) == sorted((r.doc_id, e.encode_ordinary(r.text or "")) for r in odd.select("doc_id", "text").collect())
    assert byte_bpe.decode(ids.limit(0), path, public_tokenizers.PATTERN).count() == 0
    enc = byte_bpe.BytePairEncoder(ranks, public_tokenizers.PATTERN)
    rnd = random.Random(4)
    for _ in range(300):
        t = "".join(rnd.choice("abe é\n.,'st1 \t\u00a0\x1d日ß") for _ in range(rnd.randint(1, 40)))
        assert enc.encode(t) == e.encode_ordinary(t)


# 3. Language


def test_op3(spark, sf, odd):
    lang = {r.doc_id: r.lang for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    got = queries.op3_language_id(spark, sf).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.93 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    model = language_id.train(table(spark, sf, "documents").select("text", "lang"))
    out = {r.doc_id: r for r in language_id.predict(odd, model).collect()}
    assert out[0].lang_pred == out[1].lang_pred == out[13].lang_pred == "und" and out[0].score == 0 and out[0].rejected
    assert out[4].lang_pred in model.languages
    assert language_id.predict(odd.limit(0), model).count() == 0
    assert language_id.train(odd.where("lang is null").select("text", "lang")) is None
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}


def drawn_text(spark, seed, share):
    """A text that a hash of texts alone draws."""
    return next(r.text for r in spark.range(1000).select(F.concat(F.lit("hot words of text "), "id").alias("text")).where(F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 30)) < share * (1 << 30)).limit(1).collect())


def captured(monkeypatch, module):
    tables, written = {}, module.written
    monkeypatch.setattr(module, "written", lambda df, name: tables.setdefault(name, written(df, name)))
    return tables


def test_op3_sample(spark, monkeypatch):
    """Copies of one text don't fill the sample, and document frequencies are those of all rows."""
    fit = language_id.Fit(per_language=200)
    hot = drawn_text(spark, fit.seed, 0.05)
    rows = [(k, hot if k % 3 == 0 else f"words number {'abcdefghij'[k % 10]} {'klmnopqrst'[k // 10 % 10]} {'uvwxyzabcd'[k // 100 % 10]}", "en") for k in range(3000)]
    tables = captured(monkeypatch, language_id)
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), fit)
    assert 120 < tables["lang-sample"].count() < 280
    df = sum((language_id.counts(language_id.pa.array([t for _, t, _ in rows[k : k + 500]], language_id.pa.large_string()), fit) > 0).sum(axis=0) for k in range(0, 3000, 500))
    assert model.idf == pytest.approx(np.log(3001 / (1 + df)) + 1, rel=1e-5)


def test_op3_centroids():
    """Centroids, radius and the nearest one by brute force; ties go to the first language; blocks of bytes change nothing."""
    fit = language_id.Fit(clusters=2, buckets=64)
    rng = np.random.default_rng(5)
    x = np.abs(rng.normal(size=(60, 64))).astype(np.float32)
    x[:30, :32] += 3
    x[30:, 32:] += 3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c, radius = language_id.cluster(x, fit)
    for k, part in enumerate((x[:30], x[30:])):
        mean = part.mean(axis=0) / np.linalg.norm(part.mean(axis=0))
        assert max(c @ mean) > 0.999, k
    assert radius == pytest.approx(np.quantile(1 - (x @ c.T).max(axis=1), 1 - fit.reject) + fit.slack)
    texts = language_id.pa.array(["Ab cd, efg h" * 50, "", "zz"], language_id.pa.large_string())
    whole = language_id.counts(texts, fit)
    want = Counter()
    data = re.sub(r"[^a-z]+", " ", ("Ab cd, efg h" * 50).lower()).encode()
    for order in fit.orders:
        for i in range(len(data) - order + 1):
            h = sum(int(language_id._TABLE[k + 1][data[i + k]]) * (order * 2 + 1) for k in range(order))
            h ^= h >> 15
            want[(h * 0x9E3779B1 & (1 << 64) - 1) >> 16 & 63] += 1
    assert [want[b] for b in range(64)] == whole[0].tolist() and not whole[1].any()
    old, language_id.BLOCK = language_id.BLOCK, 7
    try:
        assert (language_id.counts(texts, fit) == whole).all()
    finally:
        language_id.BLOCK = old


def test_op3_ties(spark):
    """Two languages learned from the same texts are as near: the first by name counts, with score 0.5."""
    rows = [(k, f"some words {'abcdefgh'[k % 8]} here", lang) for k in range(40) for lang in ("bb", "aa")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = language_id.predict(spark.createDataFrame([(1, "some words here"), (2, "some words here")], "doc_id long, text string"), model).collect()
    assert {(r.lang_pred, round(r.score, 6)) for r in got} == {("aa", 0.5)}


# 4. HTML


def page(body, host="h.example.com", k=0):
    return (k, f"https://{host}/{k}", f"<html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>")


def test_op4(spark, sf):
    def plain(h):
        import html as entities

        inner = re.search(r"<article>(.*?)</article>", h, re.S)
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inner[1]))
        return " ".join(x for x in (" ".join(entities.unescape(b).split()) for b in blocks) if x)

    html = {r.page_id: r.html for r in table(spark, sf, "pages").collect()}
    got = queries.op4_html_wrapper(spark, sf).collect()
    assert len(got) == len(html) and all(r.text == plain(html[r.page_id]) and r.n_chars == len(r.text) for r in got)


def test_op4_furniture(spark):
    menu = '<header><h2>Site</h2></header><nav><a href="/a">Menu</a></nav><div class="cookie-notice">Cookies!</div>'
    rest = '<aside>Side</aside><div id="comments"><p>A reader says so, at length, again and again and again.</p></div><form><p>Sign up</p><input></form><footer>&copy; x</footer>'
    main = '<article><header><h1>Head</h1></header><p>One <b>bo</b>ld&nbsp;&amp; two<br>three<!-- no --> four</p><div class="ad">Buy</div><ul><li>a<li>b</ul></article>'
    bare = "<div class=wrap><div><p>This is a long paragraph of the main text, with many words in it, number {}.</p></div></div>"
    rows = [page(menu + main + rest, k=k) for k in range(6)] + [page(menu + bare.format(k) + rest, "bare.example.com", k) for k in range(6, 12)]
    rows += [(20, None, None), (21, "no host", ""), page("<p>cut <b>off & <a hre", "cut.example.com", 22), page(menu + main + rest, k=0), page("<script>var a='</p>'</script><nav>only</nav>", "none.example.com", 23)]
    got = defaultdict(list)
    for r in html_wrapper.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect():
        got[r.page_id].append(r.text)
    assert set(got[3]) == {"Head One bold & two three four a b"} and len(got[0]) == 2
    assert got[7] == ["This is a long paragraph of the main text, with many words in it, number 7."]
    assert got[20] == got[21] == got[23] == [""] and got[22] == ["cut off &"]
    assert html_wrapper.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_op4_templates_of_one_host(spark):
    text = "The main text of page {}, which is long enough to be told apart from other slots."
    forms = ["<article><p>{}</p></article>", "<main><p>{}</p></main>", "<div class=content><p>{}</p></div>", "<div><div><p>{}</p></div></div>"]
    rows = [page("<nav>Menu</nav>" + forms[k % 4].format(text.format(k)) + "<footer>End</footer>", k=k) for k in range(24)]
    got = {r.page_id: r.text for r in html_wrapper.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: text.format(k) for k in range(24)}


def test_op4_many_forms(spark, monkeypatch):
    """More forms than one task aligns, in containers without a name."""
    monkeypatch.setattr(html_wrapper, "FAN", 2)
    text = "The main text of page {}, which is long enough to be told apart from other slots."
    rows = [page(f"<nav>Menu</nav><div><p>{text.format(k)}</p></div>", k=k) for k in range(6)]
    rows += [page("<nav>Menu</nav>" + "<section>" * d + f"<p>{text.format(10 * d + k)}</p>" + "</section>" * d, k=10 * d + k) for d in range(1, 8) for k in range(2)]
    got = {r.page_id: r.text for r in html_wrapper.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {r[0]: text.format(r[0]) for r in rows}
    card = tuple(f"{k}" for k in range(20))
    assert html_wrapper.fold(card * 3)[0] == html_wrapper.fold(card * 7)[0] == (card,)


def test_op4_only_alignment_tells(spark, monkeypatch):
    """Names mean nothing or mislead: what is the same on all pages is template, wherever it stands and however long it is."""
    about = "This site has been about all kinds of things for many years now, and we are glad that you came by to read it."
    text = "Page {} says something of its own here, in a paragraph that is long enough, and then it goes on with {} more words."
    plain = "<div class=a1><div class=content><p>" + about + "</p><p>Home</p></div><div class=b2><p>{0}</p><p>Note</p><p>{0}</p></div><div class=c3><p>" + about + "</p></div></div>"
    misled = "<div class=post><p>" + about + "</p></div><div class=sidebar><p>{0}</p></div><footer>{1}</footer>"
    rows = [page(plain.format(text.format(k, k)), "plain.example.com", k) for k in range(5)]
    rows += [page(misled.format(text.format(k, k), f"Number {k} of all the pages of this site, which has many of them"), "misled.example.com", k) for k in range(5, 10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {k: f"{text.format(k, k)} Note {text.format(k, k)}" for k in range(5)} | {k: text.format(k, k) for k in range(5, 10)}
    assert {r.page_id: r.text for r in html_wrapper.extract_pages(df).collect()} == want
    alone = {k: html_wrapper.extract(html_wrapper.parse(h), [], {}) for k, _, h in rows}
    assert all(alone[k] != want[k] for k in want)  # without the wrapper, names decide


def test_op4_long_pages(spark):
    """1 MB of nested tags, and a page with a very long text."""
    import time

    began = time.time()
    items = html_wrapper.parse("<div><b class=x>" * 70000 + "deep" + "</div>" * 70000)
    assert time.time() - began < 2 and items[70000].text == "deep"
    html_wrapper.form_of(html_wrapper.parse("<div class=a><section>" * 30000 + "deep"))
    words_of = " ".join(f"w{k}" for k in range(200000))
    rows = [page(f"<article><p>{words_of}</p></article>", k=1), page("<div>" * 50000 + "<p>deep</p>", k=2)]
    got = {r.page_id: r.text for r in html_wrapper.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: words_of, 2: "deep"}


def test_op4_bare_articles(spark):
    """Articles in containers without a name: titles, lists, tables, quotes, linked paragraphs and constant headings stay."""
    menu = "<header><h2>Site</h2></header><nav><a href=/a>Menu</a></nav><div><ul><li><a href=/x>Home</a></ul></div>"
    body = (
        "<p>This is a long paragraph of the main text, with many words in it, number {0}.</p><h2>Ingredients</h2><ul><li>salt {0}</li><li>oil</li></ul>"
        "<table><tr><td>{0} g</td><td>of it</td></tr></table><blockquote>So {0}</blockquote><p><a href=/y>Linked paragraph {0}</a></p>"
    )
    text = "Head {0} This is a long paragraph of the main text, with many words in it, number {0}. Ingredients salt {0} oil {0} g of it So {0} Linked paragraph {0}"
    rows = [page(menu + f"<div class=wrap><div class=title><h1>Head {k}</h1></div><section>{body.format(k)}</section></div><footer>End</footer>", k=k) for k in range(8)]
    rows += [page(menu + f"<section><div>Head {k}</div>{body.format(k)}</section>", "other.example.com", k) for k in (9, 9, 9, 9, 9, 9, 10)]
    rows += [page(menu + f"<section><p>Short {k}</p></section>", "other.example.com", k) for k in (11, 12)]
    got = html_wrapper.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    assert {(r.page_id, r.text) for r in got} == {(k, text.format(k)) for k in (*range(8), 9, 10)} | {(11, "Short 11"), (12, "Short 12")}


def test_wrapper_alignment():
    def nodes(*tokens, same=1):
        return [html_wrapper.Node(t, False, same, 1, 1, 1) for t in tokens]

    w = html_wrapper.infer([nodes("<a>", "x#", "</a>"), nodes("<a>", ("x#",), "y#", "</a>", same=2), nodes("<a>", "</a>")])
    assert [(x.token, x.optional, x.same) for x in w] == [("<a>", False, -1), (("x#",), True, -1), ("y#", True, 2), ("</a>", False, -1)]
    assert html_wrapper.fold(("a", "b", "a", "b", "a", "b", "c", "c")) == ((("a", "b"), ("c",)), [6, 2])
    # A repeated group has one hash however its runs are read.
    one = html_wrapper.joined([html_wrapper.Node("x#", False, html_wrapper.text_hash([t]), 1, 1, 1) for t in "abc"], ("x#",))
    assert (one.same, one.leaves) == (html_wrapper.text_hash(["a", "b", "c"]), 3)
    rnd = random.Random(3)
    for _ in range(200):
        a, b = ([rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 12))] for _ in range(2))
        got = html_wrapper.matches(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(p < q for x, y in zip(got, got[1:]) for p, q in zip(x, y, strict=True))  # noqa: B905
    long = [f"t{k}" for k in range(3000)]
    assert html_wrapper.matches(["p", *long[:1500], "q", *long[1500:], "r"], ["s", *long, "u"]) == [(k + 1 + (k >= 1500), k + 1) for k in range(3000)]


# 5. Language model


def test_op5_distinct(monkeypatch):
    """Numbers of several pieces, each sorted by itself, are those that one sort of all gives."""
    monkeypatch.setattr(pitman_yor, "DISTINCT_AT_ONCE", 7)
    x = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    for pieces in ([x], np.array_split(x, 3), [x[:1], x[1:]]):
        assert (pitman_yor._distinct(pieces) == np.unique(x)).all()


def brute_pitman_yor(texts, learn, fit, sweeps=12, burn=4):
    """Seats every customer one by one, removing and adding them in turn."""
    rnd = random.Random(3)
    toks = {k: [*words((t or "").translate(LOWER)), None] for k, t in texts.items()}
    pairs = [(u, w) for k, ws in toks.items() if learn(k) for u, w in zip(["<s>", *ws], ws, strict=False)]
    kinds = len({w for _, w in pairs})
    seats, cu, tu = defaultdict(list), Counter(), Counter()  # tables of (u, w); customers and tables of u
    top, tops = defaultdict(list), [0, 0]

    def p0(w):
        c, t = sum(top[w]), len(top[w])
        return (c - fit.base_discount * t + (fit.base_strength + fit.base_discount * tops[1]) / (kinds + 1)) / (fit.base_strength + tops[0])

    def choose(sizes, new, d):
        weights = [s - d for s in sizes] + [new]
        return rnd.choices(range(len(weights)), weights)[0]

    def add(u, w):
        k = choose(seats[u, w], (fit.strength + fit.discount * tu[u]) * p0(w), fit.discount)
        cu[u] += 1
        if k == len(seats[u, w]):
            seats[u, w].append(0)
            tu[u] += 1
            j = choose(top[w], (fit.base_strength + fit.base_discount * tops[1]) / (kinds + 1), fit.base_discount)
            if j == len(top[w]):
                top[w].append(0)
                tops[1] += 1
            top[w][j] += 1
            tops[0] += 1
        seats[u, w][k] += 1

    def remove(u, w):
        k = rnd.choices(range(len(seats[u, w])), seats[u, w])[0]
        seats[u, w][k] -= 1
        cu[u] -= 1
        if not seats[u, w][k]:
            del seats[u, w][k]
            tu[u] -= 1
            j = rnd.choices(range(len(top[w])), top[w])[0]
            top[w][j] -= 1
            tops[0] -= 1
            if not top[w][j]:
                del top[w][j]
                tops[1] -= 1

    for u, w in pairs:
        add(u, w)
    sums, n = defaultdict(float), 0
    for sweep in range(sweeps):
        for u, w in pairs:
            remove(u, w)
            add(u, w)
        if sweep >= burn:
            n += 1
            for u, w in {(u, w) for ws in toks.values() for u, w in zip(["<s>", *ws], ws, strict=False)}:  # each pair once, however many documents have it
                own = seats.get((u, w), [])
                sums[u, w] += p0(w) if not cu[u] else (sum(own) - fit.discount * len(own) + (fit.strength + fit.discount * tu[u]) * p0(w)) / (fit.strength + cu[u])
    of_context = Counter()
    for (u, _), p in sums.items():
        of_context[u] += p / n
    assert max(of_context.values()) <= 1 + 1e-9  # they are probabilities
    return {k: sum(math.log10(sums[u, w] / n) for u, w in zip(["<s>", *ws], ws, strict=False)) for k, ws in toks.items()}


def test_op5(spark, sf, odd):
    texts = {k: t for k, t in texts_of(sf).items() if k < 60}
    learn = lambda k: zlib.crc32(str(k).encode()) % 7 != 2
    docs = table(spark, sf, "documents").where("doc_id < 60").withColumn("learn", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
    got = {r.doc_id: r for r in pitman_yor.score_documents(docs).collect()}
    toks = {k: [*words((t or "").translate(LOWER)), None] for k, t in texts.items()}
    c = Counter(w for k, ws in toks.items() if learn(k) for w in ws)
    n = sum(c.values())
    for k, ws in toks.items():
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens, got[k].learned) == (len(ws), sum(c[w] > 0 for w in ws), n, learn(k))
        assert got[k].base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in ws))
    want = brute_pitman_yor(texts, learn, pitman_yor.Fit())
    for side in (True, False):
        a, b = (sum(x(k) for k in toks if learn(k) == side) for x in (lambda k: got[k].score, lambda k: want[k]))
        assert a == pytest.approx(b, rel=0.005)
    held = [k for k in toks if not learn(k)]
    assert sum(got[k].score for k in held) > sum(got[k].base_score for k in held)
    out = pitman_yor.score_documents(odd.withColumn("learn", F.col("doc_id") != 5)).collect()
    assert len(out) == len(ODD) + 1 and all(r.n_tokens == len(words((ODD[r.doc_id] or "").translate(LOWER))) + 1 and r.score < 0 for r in out)
    assert pitman_yor.score_documents(odd.limit(0).withColumn("learn", F.lit(True))).count() == 0
    assert len(pitman_yor.score_documents(odd.withColumn("learn", F.lit(None).cast("boolean"))).collect()) == len(ODD) + 1


def test_op5_buckets(spark, sf):
    """The number of buckets, which follows the size of the input, does not shape the scores."""
    docs = table(spark, sf, "documents").where("doc_id < 60").withColumn("learn", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0]
    few, many = ({r.doc_id: r for r in pitman_yor.score_documents(docs, pitman_yor.Fit(bucket_bytes=-(-size // n))).collect()} for n in (4, 64))
    for side in (True, False):
        a, b = (sum(r.score for r in x.values() if r.learned == side) for x in (few, many))
        assert a == pytest.approx(b, rel=0.001)


def test_tables():
    """Draws of tables against posteriors enumerated over all seatings, and Stirling numbers beyond the exact table."""

    def posterior(c, openings, d):
        weights = Counter()

        def seat(sizes, n, p):
            if n == c:
                weights[len(sizes)] += p
                return
            for k, size in enumerate(sizes):
                seat([*sizes[:k], size + 1, *sizes[k + 1 :]], n + 1, p * (size - d))
            seat([*sizes, 1], n + 1, p * openings[len(sizes)])

        seat([], 0, 1.0)
        return {t: x / sum(weights.values()) for t, x in weights.items()}

    rng = np.random.default_rng(0)
    for c in range(1, 9):
        for d, a, slope in ((0.8, 0.5, 0.0), (0.5, 2.0, 0.3)):
            want = posterior(c, [a + slope * i for i in range(c)], d)
            got = seating.draw_tables(np.full(50000, c), np.ones(50000, int), lambda k, i, a=a, slope=slope: np.log(a + slope * i), d, rng)
            assert all(abs((got == t).mean() - p) < 0.012 for t, p in want.items())
    for d in (0.8, 0.5):
        exact = seating.stirling_table(d, 1500)
        t = np.array([1, 2, 3, 10, 100, 700, 1400, 1500])
        assert np.abs(seating.log_stirling(np.full(len(t), 1500), t, d) - exact[1500, t]).max() < 0.11
    big = seating.draw_tables(np.full(3000, 5000), np.full(3000, 3), lambda k, i: np.full(len(k), math.log(4.0)), 0.8, rng)
    exact = seating.stirling_table(0.8, 700)[700, 1:60] + np.arange(1, 60) * math.log(4.0)  # the law hardly changes beyond
    mean = np.exp(exact - exact.max()) @ np.arange(1, 60) / np.exp(exact - exact.max()).sum()
    assert big.mean() == pytest.approx(mean, rel=0.05)
    assert seating.draw_tables(np.array([0, 1]), np.array([0, 1]), lambda k, i: np.zeros(len(k)), 0.5, rng).tolist() == [0, 1]
    wide = seating.draw_tables(np.full(50, 10**8), np.full(50, 10**6), lambda k, i: np.full(len(k), math.log(8e5)), 0.8, rng)
    assert np.abs(wide / 1e6 - 1).max() < 0.05


def test_op5_shared_pairs_and_long_texts(spark, monkeypatch):
    """Pairs that are dealt once for all documents of a chunk, chunks of any size, and texts read in parts give the same counts and nearly the same scores."""
    rnd = random.Random(8)
    rows = [(k, " ".join(["hot pair"] + [f"w{rnd.randrange(50)}" for _ in range(20)] + ["hot pair"] * (k % 3)), k % 4 != 0) for k in range(300)]
    rows.append((999, " ".join(f"w{rnd.randrange(60)}" for _ in range(4000)), True))
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(2)
    plain = {r.doc_id: r for r in pitman_yor.score_documents(docs, pitman_yor.Fit(shared=10**9)).collect()}
    few = {r.doc_id: r for r in pitman_yor.score_documents(docs, pitman_yor.Fit(shared=3, chunk_bytes=3000, bucket_bytes=4000)).collect()}
    found = list(pitman_yor._pairs(pitman_yor.pa.array(["a b", "", "c"], pitman_yor.pa.large_string()), np.arange(3), np.array([True, True, True]), pitman_yor.START))
    assert found[4].tolist() == [3, 1, 2] and len(found[0]) == 6
    for k in plain:
        assert (plain[k].n_tokens, plain[k].n_known, plain[k].train_tokens) == (few[k].n_tokens, few[k].n_known, few[k].train_tokens)
        assert plain[k].base_score == pytest.approx(few[k].base_score)
    assert sum(r.score for r in plain.values()) == pytest.approx(sum(r.score for r in few.values()), rel=0.01)
    # Texts read in parts: the same pairs as whole.
    words_of = rows[-1][1]
    batch = pitman_yor.pa.record_batch({"doc_id": [1], "learn": [True], "text": [words_of]})

    def pairs(step):
        monkeypatch.setattr(pitman_yor, "STEP", step)
        out, before = Counter(), pitman_yor.START
        for _, text, part, ends in pitman_yor._parts([batch], 2):
            w, u, _, n, _ = pitman_yor._pairs(text, part, ends, before)
            for a, b, m in zip(w.tolist(), u.tolist(), n.tolist(), strict=True):
                out[a, b] += m
            before = np.uint64(pitman_yor.word_hash(text[0].as_py().split()[-1]))
        return out

    assert pairs(1 << 20) == pairs(500) and pairs(500).total() == 4001


# 6. Joins


def brute_components(texts, n=4, percent=85):
    sets = []
    for k, t in texts:
        w = words((t or "").translate(LOWER))
        sets.append((k, frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    low = defaultdict(lambda: 1 << 60)
    for i, (k, _) in enumerate(sets):
        low[root(i)] = min(low[root(i)], k)
    return sorted((k, len(s), low[root(i)]) for i, (k, s) in enumerate(sets))


def test_op6(spark, sf, odd):
    got = sorted(map(tuple, queries.op6_ngram_join(spark, sf).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == brute_components(list(texts_of(sf).items()))
    got = sorted(map(tuple, ngram_join.join(odd).collect()))
    assert got == brute_components([tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert ngram_join.join(odd.limit(0)).count() == 0


def test_op6_near_copies(spark):
    rnd = random.Random(2)
    rows = []
    shared = [f"s{k}" for k in range(60)]
    for g in range(6):
        base = [f"g{g}w{rnd.randrange(400)}" for _ in range(150)]
        for _ in range(40):
            own = list(base)
            for _ in range(rnd.randrange(6)):
                own[rnd.randrange(len(own))] = f"x{rnd.randrange(10**6)}"
            rows.append(own)
    rows += [shared + [f"u{k}_{j}" for j in range(80)] for k in range(60)]  # one passage, else different
    rnd.shuffle(rows)
    texts = [(k, " ".join(w)) for k, w in enumerate(rows)]
    got = sorted(map(tuple, ngram_join.join(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()))
    assert got == brute_components(texts)


def test_op6_within_groups(spark):
    """Sets of one size and one prefix, some of them similar to each other but not to their group's first."""
    rnd = random.Random(11)
    n, percent = 1, 85
    word_of = {}
    for k in range(4000):
        h = ngram_join.shingle_sets(ngram_join.pa.array([f"w{k}"], ngram_join.pa.large_string()), n)[0]
        word_of[int(h[0])] = f"w{k}"
    order = [word_of[h] for h in sorted(word_of)]
    head = order[:20]  # the prefix of every set below
    rows = []
    for _ in range(12):
        base = rnd.sample(order[20:], 80)
        for _ in range(4):
            own = list(base)
            for _ in range(rnd.randrange(8)):
                own[rnd.randrange(80)] = rnd.choice(order[20:])
            own = list(dict.fromkeys(own))
            own += [w for w in rnd.sample(order[20:], 100) if w not in own][: 80 - len(own)]
            rows.append(" ".join(head + own))
    texts = list(enumerate(rows))
    got = sorted(map(tuple, ngram_join.join(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), n, percent).collect()))
    assert got == brute_components(texts, n, percent) and len({c for _, _, c in got}) < len(rows)


def test_op6_bounds_shape_the_work_alone(spark, sf, monkeypatch):
    """Tiny bounds of counts, of frequent shingles and of lists give the same components."""
    for name, value in (("COUNTED", 50), ("LOCAL", 2), ("FREQUENT_MOST", 5), ("LIST_MOST", 2), ("STEP", 20_000)):
        monkeypatch.setattr(ngram_join, name, value)
    got = sorted(map(tuple, queries.op6_ngram_join(spark, sf).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == brute_components(list(texts_of(sf).items()))


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, 5), (5, 9), (9, 2), (7, 7)]
    got = {r.node: r.label for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, 1: 1, 5: 1, 9: 1, 2: 1}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# 7. URLs


def test_op7(spark, sf):
    rules = [(r.host, r.path, r.verdict) for r in queries.URL_RULES]
    pages = {r.page_id: r.url for r in table(spark, sf, "pages").select("page_id", "url").collect()}
    for r in queries.op7_url_filter(spark, sf).collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", pages[r.page_id])
        host, path = m[1].translate(LOWER), m[2]
        fit = max((x for x in rules if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])), key=lambda x: len(x[0] + x[1]), default=None)
        assert (r.host, r.path, r.rule) == (host, path, fit and fit[0] + fit[1])
        assert r.verdict == fit[2] if fit else r.verdict in ("allow", "block")


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_op7_sql(spark, size):
    import duckdb

    sf = f"/root/testdata/{size}"
    c = duckdb.connect()
    for t in ("pages", "documents", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = sorted(c.sql(queries.oracle_sql()["op7_url_filter"]).fetchall())
    got = queries.op7_url_filter(spark, sf)
    assert sorted(tuple(r) for r in got.collect()) == want and got.columns == c.sql(queries.oracle_sql()["op7_url_filter"]).columns


def test_op7_reputation(spark):
    rows = [(1, "http://Bad.Example.com:80/x?y"), (2, "ftp://a.example.com"), (3, None), (4, "no"), (5, "http://com/en/"), (6, "x://b.example.com/en/7/"), (1, "http://Bad.Example.com:80/x?y")]
    rows += [(100 + k, f"http://spam.other.org/{k}") for k in range(30)] + [(200 + k, f"http://good{k % 3}.other.org/") for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("clash"), "bad": F.lit(1)})
    marks = spark.createDataFrame([(100 + k, True) for k in range(30)] + [(200 + k, False) for k in range(60)] + [(1, None), (None, True)], "page_id long, bad boolean")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, marks, queries.URL_RULES).collect()}
    assert (got[1].host, got[1].path, got[2].host, got[2].path) == ("bad.example.com:80", "/x", "a.example.com", "")
    assert (got[3].host, got[3].path, got[4].host, got[4].rule) == ("", "", "", None)
    assert (got[5].rule, got[5].verdict, got[6].rule, got[6].verdict) == ("com/en/", "block", "example.com/en/7", "allow")
    assert got[100].verdict == "block" and got[200].verdict == "allow" and got[100].bad_low > 0.5
    assert got[3].verdict == "allow"
    none = marks.limit(0)
    assert {r.verdict for r in url_filter.judge_urls(pages, none, ()).collect()} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), marks, queries.URL_RULES).count() == 0


def test_op7_contract(spark):
    """The list's words, written out: they are the same in the code, in the query's SQL and in what pages get."""
    import duckdb

    words = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}
    assert {r.text: r.verdict for r in queries.URL_RULES} == words
    urls = [(k, f"https://a.{rule}") for k, rule in enumerate(words)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = {r.rule: r.verdict for r in url_filter.judge_urls(pages, none, queries.URL_RULES).collect()}
    c = duckdb.connect()
    c.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR); CREATE TABLE documents (doc_id BIGINT, text VARCHAR); CREATE TABLE labels (doc_id BIGINT, quality INT)")
    c.executemany("INSERT INTO pages VALUES (?, ?, '')", urls)
    assert got == dict(c.sql(queries.oracle_sql()["op7_url_filter"]).project("rule, verdict").fetchall()) == words


def test_op7_posterior(spark):
    """Priors by hand from host to domain to suffix to all, and the bound against the beta law integrated numerically."""
    p = url_filter.Reputation()
    groups = {("a.x.com", "x.com", "com"): (10, 9), ("b.x.com", "x.com", "com"): (10, 8), ("y.com", "y.com", "com"): (20, 1), ("z.org", "z.org", "org"): (40, 2), ("new.x.com", "x.com", "com"): (0, 0)}
    hosts = spark.createDataFrame([(*h, *nk) for h, nk in groups.items()], "host string, domain string, suffix string, n long, k long")
    got = {r.host: r for r in url_filter.reputation(hosts, p).collect()}

    def pooled(children):
        seen = [(n, k) for n, k in children if n]
        n, k = sum(n for n, _ in seen), sum(k for _, k in seen)
        mu, j = k / n, len(seen)
        between = sum(k * k / n for n, k in seen) - k * mu
        below = (n - sum(n * n for n, _ in seen) / n - (j - 1)) * mu * (1 - mu)
        rho = (between - (j - 1) * mu * (1 - mu)) / below if below > 1e-9 else p.rho_high
        rho = max(p.rho_low, min(p.rho_high, rho))
        return n, k, (1 - rho) / rho

    def level(at):
        sets = defaultdict(list)
        for h, nk in groups.items():
            sets[h[at:]].append(nk)
        return sets

    domains = {h: pooled(c) for h, c in level(1).items()}
    suffixes = defaultdict(list)
    for (_, s), (n, k, _) in domains.items():
        suffixes[s].append((n, k))
    suffixes = {s: pooled(c) for s, c in suffixes.items()}
    n, k, strength = pooled([x[:2] for x in suffixes.values()])
    up = (k + 0.5) / (n + 1)
    of_suffix = {s: ((k + strength * up) / (n + strength), m) for s, (n, k, m) in suffixes.items()}
    of_domain = {d: ((k + of_suffix[d[1]][1] * of_suffix[d[1]][0]) / (n + of_suffix[d[1]][1]), m) for d, (n, k, m) in domains.items()}
    for (h, d, s), (n, k) in groups.items():
        mean, m = of_domain[d, s]
        rate = (k + m * mean) / (n + m)
        assert got[h].bad_rate == pytest.approx(rate)
        a, b = rate * (n + m), (1 - rate) * (n + m)
        x = (np.arange(200000) + 0.5) / 200000
        law = np.exp((a - 1) * np.log(x) + (b - 1) * np.log(1 - x) - max((a - 1) * math.log(q) + (b - 1) * math.log(1 - q) for q in (0.001, 0.2, 0.5, 0.8, 0.9, 0.95, 0.999)))
        assert law[x < got[h].bad_low].sum() <= p.error * law.sum() and got[h].blocked == (got[h].bad_low > 0.5)


def test_op7_domains(spark):
    rows = [("a.b.example.co.uk", "co.uk", "example.co.uk"), ("co.uk", "co.uk", "co.uk"), ("x.example.com:80", "com", "example.com"), ("10.0.0.1:8080", "10.0.0.1", "10.0.0.1"), ("[::1]", "[::1]", "[::1]"), ("localhost", "localhost", "localhost"), ("", "", ""), ("shop.com.br", "com.br", "shop.com.br"), ("me.example.org", "org", "example.org")]
    df = spark.createDataFrame([(h,) for h, *_ in rows], "host string")
    suffix = url_filter.suffix_of(F.col("host"))
    assert [tuple(r) for r in df.select("host", suffix, url_filter.domain_of(F.col("host"), suffix)).collect()] == rows
    long = "http://Long.example.com/" + "x" * 300000 + "?q"
    got = url_filter.judge_urls(spark.createDataFrame([(1, long)], "page_id long, url string"), spark.createDataFrame([], "page_id long, bad boolean"), ()).first()
    assert (got.host, len(got.path), got.verdict) == ("long.example.com", 300001, "allow")


def test_op7_outcomes(spark, sf):
    """Outcomes come from the documents that pages hold, not from equal ids."""
    import html as entities
    import pyarrow.parquet as pq

    bare = lambda t: re.sub(r"\s+", "", t)
    quality = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    marks = defaultdict(list)
    for k, t in texts_of(sf).items():
        if k in quality and bare(t or ""):
            marks[bare(t)].append(quality[k] == 0)
    rows = table(spark, sf, "pages").collect()
    held = {r.page_id: bare(entities.unescape(re.sub(r"<[^>]*>", "", re.search(r"(?s)</h1>(.*?)</article>", r.html)[1]))) for r in rows}
    want = {k: 2 * sum(marks[t]) >= len(marks[t]) for k, t in held.items() if t in marks}
    labels = spark.createDataFrame([(k, q == 0) for k, q in quality.items()], "doc_id long, bad boolean")
    got = {r.page_id: r.bad for r in url_filter.outcomes_of(table(spark, sf, "pages"), table(spark, sf, "documents"), labels).collect()}
    assert want and got == want


def test_op7_held_documents(spark, tmp_path):
    """A host whose pages hold bad documents is blocked, though documents with the pages' ids are good."""
    n = 40
    docs = [(k, f"Text {k}:\n a & b < {k}", "en", "s") for k in range(2 * n)]
    pages = [(k, f"http://{'spam.example.org' if k < n else 'fine.example.org'}/{k}", f"<html><body><article><h1>T</h1><p>Text {(k + n) % (2 * n)}:<p>a &amp; b &lt; {(k + n) % (2 * n)}</article></body></html>") for k in range(2 * n)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(k, int(k < n), 0) for k in range(2 * n)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert all(r.verdict == ("block" if r.page_id < n else "allow") for r in queries.op7_url_filter(spark, str(tmp_path)).collect())


# 8. Rules


def brute_counts(t):
    t = t or ""
    w = words(t)
    again = Counter(zip(w, w[1:], w[2:]))  # noqa: B905
    covered = {k + j for k in range(len(w) - 2) if again[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_op8(spark, sf, odd):
    texts = texts_of(sf)
    good = {r.doc_id for r in table(spark, sf, "labels").where("quality = 1").collect()}
    rows = queries.op8_quality_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, *rest = brute_counts(texts[r.doc_id])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == [n, *rest]
        assert r.base_failed == (n < 50 or 100 * rest[-1] > 50 * n) and not (r.base_failed and r.kept)
        assert r.kept or r.base_failed or r.doc_id not in good
    out = quality_rules.apply_rules(odd)
    assert sorted(out.columns) == sorted(odd.columns)
    for r in out.collect():
        assert (r.qr.n_words, r.qr.word_chars, r.qr.n_symbols, r.qr.n_dup_lines, r.qr.n_repeat_words) == brute_counts(r.text)
    assert quality_rules.apply_rules(odd.limit(0)).count() == 0


def test_op8_adapts(spark):
    """A source whose texts are all tables keeps them; one such text in a plain source fails."""
    plain = lambda k: " ".join(f"word{k}x{j}" for j in range(80))
    tables = lambda k: " | ".join(f"word{k}x{j}" for j in range(80))
    rows = [(k, plain(k), "en", "plain") for k in range(250)] + [(1000 + k, tables(k), "en", "tables") for k in range(250)] + [(2000, tables(9999), "en", "plain")]
    kept = {r.doc_id: r.qr.kept for r in quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert kept[0] and kept[1000] and not kept[2000] and sum(kept.values()) == 500


def test_op8_fences(spark):
    """Quartiles of small groups shrink toward their language's and all rows'; a value at the fence stays."""
    rnd = random.Random(9)
    rows = []
    for lang, source, n, top in (("en", "a", 3, 40), ("en", "b", 60, 10), ("de", "c", 120, 20), ("de", None, 1, 5)):
        rows += [(len(rows) + j, " ".join(["#" * rnd.randrange(1, top)] * 5 + [f"w{len(rows)}x{j}x{i}" for i in range(60)]), lang, source) for j in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    rules = quality_rules.Rules(measures=(quality_rules.Measure("symbol_rate", 0.001, reach=1.0),))
    got = {r.doc_id: r.qr for r in quality_rules.apply_rules(docs, rules).collect()}

    def quartiles(xs):
        xs = sorted(xs)
        return [xs[max(0, math.ceil(r * len(xs)) - 1)] for r in (0.25, 0.75)]

    def shrink(own, n, up):
        return [(n * a + rules.weight * b) / (n + rules.weight) for a, b in zip(own, up, strict=True)]

    passed = {k: q.symbol_rate for k, q in got.items() if not q.base_failed}
    key = {k: (lang, source) for k, _, lang, source in rows}
    every = quartiles(passed.values())
    for k, rate in passed.items():
        of_lang = [v for j, v in passed.items() if key[j][0] == key[k][0]]
        own = [v for j, v in passed.items() if key[j] == key[k]]
        q = shrink(quartiles(own), len(own), shrink(quartiles(of_lang), len(of_lang), every))
        high = q[1] + max(q[1] - q[0], 0.001)
        if abs(rate - high) > 1e-9:
            assert got[k].kept == (rate < high)
    assert 0 < sum(q.kept for q in got.values()) < len(rows)
    same = spark.createDataFrame([(k, " ".join(f"w{k}x{i}" for i in range(60)), "en", "s") for k in range(5)], "doc_id long, text string, lang string, source string")
    at_fence = quality_rules.Rules(measures=(quality_rules.Measure("symbol_rate", 0.0),))
    assert all(r.qr.kept for r in quality_rules.apply_rules(same, at_fence).collect())


# 9. Classifier


def test_op9(spark, sf, odd):
    quality = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    got = queries.op9_quality_classifier(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    known = [r for r in got if r.doc_id in quality]
    assert len(got) == len(texts_of(sf)) and sum(r.predicted == quality[r.doc_id] for r in known) >= 0.9 * len(known)
    assert {r.score for r in quality_classifier.score(odd, None).collect()} == {0.5}
    none = quality_classifier.train(odd, odd.select("doc_id", F.lit(None).cast("int").alias("label")))
    assert none is None
    model = quality_classifier.train(table(spark, sf, "documents"), table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")))
    out = quality_classifier.score(odd, model)
    assert out.count() == len(ODD) + 1 and out.where("score between 0 and 1").count() == len(ODD) + 1
    assert quality_classifier.score(odd.limit(0), model).count() == 0


def test_factorisation():
    """The identity equals the sum over pairs, and the slopes are those of differences."""
    fit = quality_classifier.Fit(buckets=8, rank=3)
    rng = np.random.default_rng(2)
    m = quality_classifier.Model(fit, 0.3, rng.normal(size=fit.width), rng.normal(size=(fit.width, 3)))
    x = rng.normal(size=fit.width) * (rng.random(fit.width) < 0.5)
    (c,) = np.nonzero(x)
    got = quality_classifier.margins(np.zeros(len(c), int), c, x[c], 1, m)[0][0]
    want = 0.3 + m.linear @ x + sum(m.factors[i] @ m.factors[j] * x[i] * x[j] for i in range(fit.width) for j in range(i))
    assert got == pytest.approx(want)


def test_op9_sample(spark, monkeypatch):
    """Copies of one text, or rows of one id, neither fill the sample nor fall into one shard."""
    fit = quality_classifier.Fit(sample=300, buckets=64, rounds=1, epochs=1, steps=1)
    hot = drawn_text(spark, fit.seed, 0.08)
    docs = [(k, hot if k % 3 == 0 else f"text number {k}") for k in range(3000)] + [(7, "of one id")] * 3000
    labels = spark.createDataFrame([(k, k % 2) for k in range(3000)] + [(7, 1)] * 3000 + [(None, 1), (8, None)], "doc_id long, label int")
    for rows in (docs[:3000], docs):
        tables = captured(monkeypatch, quality_classifier)
        assert quality_classifier.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), labels, fit)
        shards = Counter(r.shard for r in tables["quality-sample"].collect())
        assert 200 < sum(shards.values()) <= 2 * fit.sample and len(shards) == 5 and max(shards.values()) < 0.4 * sum(shards.values())


def test_op9_learns(spark):
    """Training lowers the loss of a rule that needs an interaction of two words, and calibration keeps the order."""
    rnd = random.Random(6)
    rows = []
    for k in range(1600):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        rows.append((k, " ".join(["alpha"] * a + ["beta"] * b + [f"w{rnd.randrange(30)}" for _ in range(6)]), int(a == b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = quality_classifier.train(docs, docs.select("doc_id", "label").where("doc_id < 1200"), quality_classifier.Fit(rounds=8, epochs=8, rate=0.1))
    got = [(r.score >= 0.5) == (r.label == 1) for r in quality_classifier.score(docs.where("doc_id >= 1200"), model).collect()]
    assert sum(got) >= 0.9 * len(got)
    margin = np.array([-3.0, -2.0, -2.5, 2.0, 3.0, 4.0, 5.0, 2.5])
    slope, shift = quality_classifier.calibration(margin, (margin > 0).astype(float))
    p = 1 / (1 + np.exp(-(slope * margin + shift)))
    assert p[:3].max() < 0.3 and p[3:].min() > 0.5 and (np.diff(p[np.argsort(margin)]) > 0).all()


# 10. Packing


def test_op10(spark, sf, odd):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    def check(rows, texts):
        by, places = defaultdict(list), defaultdict(list)
        for r in rows:
            by[r.doc_id].append(r)
            places[r.sequence_id].append((r.offset, r.length))
        copies = Counter(k for k, _ in texts)
        for k, text in dict(texts).items():
            ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
            pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by[k])
            want = sorted(copies[k] * [(s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes()), len(ids)) for s in range(0, len(ids), 4096)])
            assert pieces == want
        for own in places.values():
            at = 0
            for offset, n in sorted(own):
                assert offset == at
                at += n
            assert at <= 4096
        return len(places), sum(r.length for r in rows)

    n, total = check(queries.op10_packing(spark, sf).collect(), list(texts_of(sf).items()))
    assert n <= math.ceil(total / 4096) * 1.03 + 1
    check(packing.pack(odd, public_tokenizers.path("word_bpe_49k.json"), 2).collect(), [tuple(r) for r in odd.select("doc_id", "text").collect()])
    marks = ["<|endoftext|>", "a<|endoftext|>b.c", "A <|ENDOFTEXT|> b", "x <|startoftext|> Don't, 12<|endoftext|><|endoftext|>", "<|endoftext", "e\u0301<|endoftext|>\u0301 É"]
    rows = list(enumerate(marks)) + [(100 + k, "one") for k in range(1000)] + [(2000 + k, "w " * 1999) for k in range(50)]
    n, _ = check(packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), public_tokenizers.path("word_bpe_49k.json"), 2).collect(), rows)
    assert n == 25  # of 24.9 at least
    assert packing.pack(odd.limit(0), public_tokenizers.path("word_bpe_49k.json"), 2).count() == 0


def test_histogram():
    rnd = random.Random(5)
    h = Counter(rnd.randint(1, 4096) for _ in range(4000))
    packs = packing.pack_histogram(h, 4096)
    placed = Counter()
    for count, lengths in packs:
        assert sum(lengths) <= 4096
        for x in lengths:
            placed[x] += count
    assert placed == h
    assert packing.pack_histogram({5: 3}, 10) == [(1, [5, 5]), (1, [5])] and packing.pack_histogram({}, 10) == []
    assert packing.pack_histogram({1: 1000}, 4096) == [(1, [1] * 1000)] and packing.pack_histogram({2000: 1000}, 4096) == [(500, [2000, 2000])]
    many = {n: 10**9 if n == 7 else n for n in range(1, 4097)}
    parts = packing.parts_of(many)
    assert sum(parts.values()) <= packing.PARTS + 4096 and parts[7] > 8000 and parts[1] == 1


def test_very_long_texts(spark):
    """A text of 20 MB goes through every operator over documents whole."""
    n = 3_000_000
    text = " ".join(f"w{k % 50021:05d}" for k in range(n))
    docs = spark.createDataFrame([(1, text, "en", "s"), (2, None, "en", "s"), (3, "short text", "en", "s")], "doc_id long, text string, lang string, source string").repartition(1).persist()
    payload = docs.select("doc_id", telephony.padded(F.col("text")).alias("payload"))
    back = telephony.expand(telephony.store(payload)).select("doc_id", F.octet_length("payload").alias("n"), F.md5("payload").alias("h")).orderBy("doc_id").first()
    padded = text.encode() + bytes(-len(text) % 64)
    assert (back.n, back.h) == (len(padded), hashlib.md5(padded).hexdigest())
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_bpe.encode(docs, path, public_tokenizers.PATTERN)
    out = byte_bpe.decode(ids, path, public_tokenizers.PATTERN).select("doc_id", F.md5("decoded").alias("h")).where("doc_id = 1").first()
    assert out.h == hashlib.md5(text.encode()).hexdigest()
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    assert language_id.predict(docs, model).where("doc_id = 1").first().lang_pred == "en"
    scored = {r.doc_id: r for r in pitman_yor.score_documents(docs.withColumn("learn", F.lit(True))).collect()}
    assert scored[1].n_tokens == n + 1 and scored[1].train_tokens == n + 5 and scored[3].n_known == 3
    joined = {r.doc_id: r.n_shingles for r in ngram_join.join(docs).collect()}
    assert joined == {1: 50021, 2: 0, 3: 1}
    rules = {r.doc_id: r.qr for r in quality_rules.apply_rules(docs).collect()}
    assert rules[1].n_words == n and rules[1].n_repeat_words == n and rules[1].base_failed
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, label int")
    assert quality_classifier.score(docs, quality_classifier.train(docs, labels)).count() == 3
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2).where("doc_id = 1").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).first()
    assert pieces.n == pieces.t > n
    docs.unpersist()
