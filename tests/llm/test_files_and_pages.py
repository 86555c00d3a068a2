"""WARC bundles, token files, page text, the pipeline and the registered SQL."""
import hashlib
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tripforge.llm import extract as X
from tripforge.llm import oracle, queries
from tripforge.llm import tokens as T
from tripforge.llm import warc as W
from tripforge.llm.common import open_fs

from .conftest import SF

BIG = "<p>" + "copy " * 300 + "</p>"


# -- WARC -------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a.example/1", BIG), (2, "http://a.example/2", BIG), (3, None, BIG), (4, "http://b.example/ x\n", "small"),
            (5, "http://b.example/", "small"), (6, "u", None), (7, "u", ""), (None, "v", BIG), (3, None, BIG), (8, "ü", "ünï" * 900)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(7))


@pytest.mark.parametrize("frame_bytes", [1, 1 << 18])
def test_warc_round_trip(spark, pages, frame_bytes):
    index = W.write_bundles(pages, frame_bytes=frame_bytes, bundle_bytes=1000)
    got = sorted(map(tuple, W.read_bundles(spark, index).collect()), key=str)
    want = []
    for r in pages.collect():
        p = (r.html or "").encode()
        refers = 3 if r.html == BIG and r.page_id != 3 else None
        want.append((r.page_id, len(p), hashlib.sha1(p).hexdigest(), "revisit" if refers else "response", refers))
    assert got == sorted(want, key=str)
    some = {r.page_id: r.payload for r in W.fetch(index.filter("page_id IN (1, 3, 8)")).collect()}
    assert some[1] is None and some[3].decode() == BIG and some[8].decode() == "ünï" * 900
    # an ordinary reader decompresses a whole bundle
    fs, path = open_fs(index.first().bundle)
    with fs.open_input_file(path) as f:
        assert zstandard.ZstdDecompressor().stream_reader(f.read(), read_across_frames=True).read(9) == b"WARC/1.1\r"


def test_warc_of_nothing(spark, pages):
    assert W.read_bundles(spark, W.write_bundles(pages.limit(0))).count() == 0


def test_damaged_record_is_noticed():
    raw = W.record(1, "u", b"x" * 50, hashlib.sha1(b"x" * 50).hexdigest(), None)
    assert W.parse(raw)[1] == b"x" * 50
    with pytest.raises(ValueError):
        W.parse(raw.replace(b"xxxx", b"xyxx"))


# -- token files ----------------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 31, 32, 33, T.BLOCK, T.BLOCK + 1, 3 * T.BLOCK + 77])
def test_rans_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 50_000
    seen, count = np.unique(ids, return_counts=True)
    table = T.Table.fit(seen, count)
    assert table.freq.sum() == 1 << T.SCALE and (table.freq[seen] > 0).all()
    blocks = T.encode_blocks(table, ids)
    sizes = [min(T.BLOCK, n - k) for k in range(0, n, T.BLOCK)]
    assert (T.decode_blocks(table, blocks, sizes) == ids).all()
    assert (T.decode_blocks(table, blocks[-1:], sizes[-1:]) == ids[-sizes[-1]:]).all()      # a block alone


def test_rans_is_near_the_entropy():
    ids = np.random.default_rng(0).integers(0, 256, 4 * T.BLOCK)
    table = T.Table.fit(np.arange(256), np.bincount(ids, minlength=256))
    assert sum(map(len, T.encode_blocks(table, ids))) < len(ids) * 1.02
    one = T.Table.fit(np.array([7]), np.array([100]))
    assert (T.decode_blocks(one, T.encode_blocks(one, np.full(100, 7)), [100]) == 7).all()


def test_pieces_encode_like_whole_texts():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(T.default_tokenizer())
    odd = ["", " ", "  a  b", "a \n b", "\n\n x", "it's 's  'll <|endoftext|> x", "日本語 テキスト", "a b", " lead", "trail ", "x\x1cy",
           "l’été — “q”…", "a\t\tb \t c", "é x", "123 ²³ ½x", "don't I'LL we've 'd", "end. (x) a, b! c1. \U0001f600", "ª º a·b a‐b"]
    odd += [" ".join(odd), "  ".join(odd * 3), "\n ".join(odd)]
    want = [np.array(e.ids, "<u2").tobytes() for e in tok.encode_batch(odd, add_special_tokens=False)]
    for piece, keep in ((1, 0), (2, 4), (7, 30), (T.PIECE, T.KEEP)):
        enc = T.Encoder(T.default_tokenizer(), piece, keep)
        for _ in range(3):
            assert enc.encode(odd) == want
            assert [enc.encode([t])[0] for t in odd] == want


def test_parts_of_pieces_are_encoded_once():
    from tokenizers import Tokenizer
    tok, enc, sent = Tokenizer.from_file(T.default_tokenizer()), T.Encoder(T.default_tokenizer()), []
    library = enc._library
    enc._library = lambda texts, *a: sent.extend(texts) or library(texts, *a)
    texts = ["x alpha bêta gamma.\nDelta end", "y alpha, bêta! gamma.\nDelta, alpha**.", "z a_1, b2;\nÉtat ²! x\n1 ½. don't, ×, .\nA x.\n\nB\u0587, ǅ.", "w \xad, ÿ\nÀ a\n\u0345b"]
    for t in texts:
        at = len(sent)
        assert enc.encode([t]) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u2").tobytes()]
        assert at == 0 or not any(w in x for x in sent[at:] for w in ("alpha", "gamma", "Delta"))


def test_token_files(spark, odd, documents, no_documents):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(T.default_tokenizer())
    for df in (odd, documents):
        rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want, start = [], 0
        for d, t in rows:
            ids = tok.encode(t, add_special_tokens=False).ids + [0]
            want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        index, folder = T.write_token_files(df, file_tokens=20_000)
        got = T.read_token_files(spark, index, folder, with_ids=True).orderBy("start").collect()
        assert [tuple(r)[:4] for r in got] == want
        assert got[-1].ids == tok.encode(rows[-1][1], add_special_tokens=False).ids + [0]
    index, folder = T.write_token_files(no_documents)
    assert T.read_token_files(spark, index, folder).count() == 0


def test_damaged_block_is_noticed(spark, documents):
    index, folder = T.write_token_files(documents)
    fs, path = open_fs(index.first().file)
    with fs.open_input_file(path) as f:
        entries, _, _ = T.read_footer(f)
        f.seek(0)
        raw = bytearray(f.read())
    raw[entries[0][0] + 300] ^= 1
    import io
    with pytest.raises(ValueError):
        T.read_blocks(io.BytesIO(bytes(raw)), T.read_table(f"{folder}/table.bin"), entries[:1])


# -- page text -------------------------------------------------------------------------
def test_main_text_of_one_page():
    page = ("<html><head><title>t</title><style>p{}</style></head><body class='has-sidebar'><header><h1>Site</h1></header><nav>menu</nav>"
            "<div class=ad>Buy</div><div id='cookie-notice'>cookies</div><article><header><h1>Title &amp; more</h1></header><p>One<b> two"
            "\n three<br>four<p>Five &lt;5&gt; &eacute;&nbsp;x</p><!-- no --><script>var a='</p>';</script><aside>side</aside><form>f</form>"
            "<ul><li>i1<li>i2</ul><section class='comments'><p>I agree</p></section><a title='a>b' href=x>link</a></article>"
            "<article class=comment>mine</article><div class='sidebar'>s</div><footer>foot</footer></body></html>")
    assert X.main_text(page) == "Title & more\nOne two three four\nFive <5> é x\ni1\ni2\nlink"
    assert X.main_text(None) == X.main_text("") == X.main_text("<!-- x") == ""
    assert X.main_text("plain <b>text</b> &amp") == "plain text &"
    assert X.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert X.main_text('<p title="never closed>a</p><p>b</p>').endswith("b")


def test_wrapper_drops_what_the_host_repeats(spark):
    def page(i, host, body):
        return (i, f"https://{host}/{i}", f"<html><body><div class='top'>Welcome to our place</div><div class='x1'>{body}</div>"
                f"<div class='x2'>Call us on 555</div></body></html>")
    body = lambda i: "".join(f"<p>Paragraph {i} {k} is about subject {i * 31 + k} and no other.</p>" for k in range(4))
    rows = [page(i, "h.example", body(i)) for i in range(12)] + [page(50, "single.example", body(50))]
    rows += [page(60 + i, "copies.example", body(7)) for i in range(6)] + [(70, None, body(70)), (71, "http://h.example/e", None), (72, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r.text for r in X.main_texts(df).collect()}
    lines = lambda i: [f"Paragraph {i} {k} is about subject {i * 31 + k} and no other." for k in range(4)]
    assert all(got[i].split("\n") == lines(i) for i in range(12))
    # one page, or copies of one page, tell nothing about the template
    assert got[50].split("\n") == ["Welcome to our place", *lines(50), "Call us on 555"]
    assert all(got[60 + i].split("\n")[1:-1] == lines(7) for i in range(6))
    assert got[70].split("\n") == lines(70) and got[71] == "" and got[72] == ""
    assert X.main_texts(df.limit(0)).count() == 0


def test_all_slots_of_a_page_are_kept(spark):
    def page(i):
        lines = [f"Headline {i} of the day", f"Lead {i} says what {i * 7} is about", *[f"Paragraph {i} {k} tells {i * 31 + k}." for k in range(5)],
                 f"Second part {i} goes on with {i * 13}", f"Quote {i} by person {i * 3}"]
        body = "".join(f"<p>{x}</p>" for x in lines[2:7])
        return (i, f"https://slots.example/{i}", f"<body><div class='top'>Welcome to our place</div><h1>{lines[0]}</h1><div class='lead'>{lines[1]}"
                f"</div><div class='one'>{body}</div><div class='two'><p>{lines[7]}</p><blockquote>{lines[8]}</blockquote></div></body>"), lines
    made = [page(i) for i in range(9)]
    df = spark.createDataFrame([r for r, _ in made], "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in X.main_texts(df).collect()}
    assert got == {r[0]: lines for r, lines in made}


def html_of(host, kind, i, n=3, notes=2):
    """A page of one of two templates, and the text that is its own."""
    lines = [f"Paragraph {i} {k} is about subject {i * 31 + k} and no other." for k in range(n)]
    body = "".join(f"<p>{x}</p>" for x in lines)
    rules = "".join(f"<div class='{kind}r{k}'>{kind} house rule {k}: {'please be kind ' * 8}</div>" for k in range(notes))
    inner = f"<div class='one'>{body}</div>" if kind == "a" else f"<section class='two'><div class='in'>{body}</div></section>"
    return (i, f"https://{host}/{i}", f"<body>{rules}{inner}<div class='{kind}end'>End of {kind}</div></body>"), lines


def test_constants_of_long_boilerplate_and_of_each_template(spark):
    made = [html_of("long.example", "a", i, 3, 3) for i in range(8)]
    made += [html_of("mixed.example", "ab"[i % 2], 100 + i, 4, 1) for i in range(16)]
    near = "".join(f"<p>Sentence {k} of the one story that is told here.</p>" for k in range(10))
    rows = [r for r, _ in made] + [(900 + i, "https://near.example/", f"<body><div>{near}<p>Seen {i} times</p></div></body>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text.split("\n") for r in X.main_texts(df).collect()}
    assert {i: t for i, t in got.items() if i < 900} == {r[0]: lines for r, lines in made}
    assert all(len(got[900 + i]) == 11 for i in range(6))     # copies of one page keep their text


def test_long_pages_have_a_wrapper_however_rows_are_dealt(spark):
    made = [html_of("big.example", "a", i, 700 if i % 2 else 5) for i in range(30)]
    made += [html_of("rare.example", "a" if i % 10 else "b", 100 + i, 4) for i in range(40)]
    df = spark.createDataFrame([r for r, _ in made], "page_id long, url string, html string")
    for parts in (1, 7):
        got = {r.page_id: r.text.split("\n") for r in X.main_texts(df.repartition(parts)).collect()}
        assert got == {r[0]: lines for r, lines in made}


def test_tree_matching_prefers_equal_text():
    a = X.shape("<body><p>x1</p><p>same</p><p>x2</p></body>")
    b = X.shape("<body><p>same</p><p>y</p></body>")
    pairs = [(a["keys"][i], b["keys"][j]) for i, j in X.matched(a, b)]
    assert any(k == m and k for k, m in pairs)


def test_tree_matching_is_the_heaviest():
    import random

    def tree(rng, depth=0):
        kids = [tree(rng, depth + 1) for _ in range(rng.randint(0, 3))] if depth < 3 else []
        return rng.choice("ab") if depth else "r", kids

    def flat(t, depth=0):
        return [(depth, t[0])] + [x for k in t[1] for x in flat(k, depth + 1)]

    def plain(a, b):
        """Simple tree matching by its textbook table; nodes matched."""
        if a[0] != b[0]:
            return 0
        t = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
        for i, x in enumerate(a[1]):
            for j, y in enumerate(b[1]):
                t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + plain(x, y))
        return 1 + t[-1][-1]
    rng = random.Random(5)
    for _ in range(300):
        a, b = tree(rng), tree(rng)
        sa, sb = ({"depth": [d for d, _ in f], "label": [x for _, x in f], "keys": [[] for _ in f]} for f in (flat(a), flat(b)))
        got = X.matched(sa, sb)
        assert len(got) == plain(a, b) == len({i for i, _ in got}) == len({j for _, j in got})


def test_one_word_of_a_name_drops_nothing():
    kept = ("entry-header post-header article-header search-results social-science share-prices related-work footer-notes banner-story "
            "content-notice entryHeader").split()
    for name in [*kept, "widget"]:
        assert X.main_text(f"<main><article><div class='{name}'><h1>Head</h1></div><p>Text</p></article></main>") == "Head\nText", name
    for name in kept:
        assert X.main_text(f"<body><div id='{name}'><h1>Head</h1></div><p>Text</p></body>") == "Head\nText", name
    for name in "comments share-buttons related-posts cookie-notice newsletter-signup ad navBar".split():
        assert X.main_text(f"<article><p>Text</p><div class='x {name}'>no</div></article>") == "Text", name
    for name in "site-header page-footer widget search-form left-sidebar".split():
        assert X.main_text(f"<body><p>Text</p><div class='{name}'>no</div></body>") == "Text", name


def test_constants_come_from_aligned_nodes():
    def page(i, top, end):
        return X.collapsed(X.shape(f"<body><nav>Menu</nav>{top}<div class='own'>Story {i} of {i * 31} things told</div>{end}</body>"))
    said = "<section><p>Said on all pages</p></section>"
    pages = [page(i, said, "<div>Fixed</div>") for i in range(5)] + [page(5, said, "")]
    wrapper = X.induce(pages)
    every = set.intersection(*(set(p["keys"]) for p in pages))
    assert wrapper >= every and len(wrapper) == 3        # the menu too, and what one page lacks
    # held by all, but on two of five pages where the alignment has it out of order
    mixed = [page(i, said if i % 2 else "", "<div>Fixed</div>" + ("" if i % 2 else said)) for i in range(5)]
    aligned = X.held([X._texts(p) for p in mixed], 0.2)
    assert max(aligned[k] for k in set.intersection(*(set(p["keys"]) for p in mixed))) == 5
    assert 5 not in [aligned[k] for p in mixed for k, i in zip(p["keys"], p["at"]) if p["depth"][i] == 4]
    # a wide tree of many different paths is aligned like any other
    wide = [X.collapsed(X.shape("<body>" + "".join(f"<div class='c{k}'><p>{'Fixed' if k % 2 else i} {k} text</p></div>" for k in range(900)) + "</body>"))
            for i in range(4)]
    assert len(X.induce(wide)) == 450


def test_constants_are_counted_over_all_pages(spark):
    import xxhash
    notice = "<div class='n'>Seen on few pages, but on those first by hash</div>"
    order = lambda page: xxhash.xxh64_intdigest(page) - (1 << 63)

    def body(i, mid):
        return f"<body><div class='t'>Top line</div><div class='x'><p>Story {i} is about {i * 31} and no other.</p></div>{mid}</body>"
    few = sorted((body(i, notice) for i in range(2000)), key=order)[:20]
    many = sorted((body(i, f"<div class='n'>Varies as {i}</div>") for i in range(2000, 4000)), key=order)[-60:]
    # a template of the same labels near the root that no page first by hash has
    deep = "<div><div><div><ul class='u'><li>a{i}<li class='k'>b{i}</ul><ol><li class='l'>c{i}</ol><dl><dt>d{i}<dd>Own end</dl><section><h2>e{i}</h2><h3>f{i}</h3></section></div></div></div>"
    rare = sorted((body(i, deep.format(i=i)) for i in range(4000, 5000)), key=order)[-9:]
    usual = sorted((body(i, "<div><div><div><p>Usual end</p></div></div></div>") for i in range(5000, 6000)), key=order)[:40]
    pages = [("few", p) for p in few + many] + [("rare", p) for p in rare + usual]
    df = spark.createDataFrame([(i, f"https://{h}.example/{i}", p) for i, (h, p) in enumerate(pages)], "page_id long, url string, html string")
    for parts in (1, 5):
        got = {r.page_id: r.text.split("\n") for r in X.main_texts(df.repartition(parts)).collect()}
        for i, (h, p) in enumerate(pages):
            assert "Top line" not in got[i] and got[i][0].startswith("Story")
            assert ("Seen on few pages, but on those first by hash" in got[i]) == (notice in p)      # 20 of 80 pages hold it
            assert not {"Usual end", "Own end"} & set(got[i])


def test_wrappers_are_those_of_all_pages_in_memory(spark):
    import random

    import xxhash
    rng, rows = random.Random(3), []
    for h in range(12):
        fixed = [f"<div class='f{k}'>Fixed {h} {k} {'of this place ' * rng.randint(0, 3)}</div>" for k in range(4)]
        for i in range(rng.choice([2, 3, 9, 40])):
            parts = [f for f in fixed if rng.random() < 0.9] + [f"<p>Told {h} {j} as {j * 7}</p>" for j in rng.sample(range(60), 5)]
            if rng.random() < 0.3:
                rng.shuffle(parts)
            rows.append((len(rows), f"https://h{h}.example/{i}", f"<body>{''.join(parts)}</body>"))
    df = spark.createDataFrame(rows + rows[:30], "page_id long, url string, html string")
    got = {r.host: set(r.constants) for r in X.wrappers(df).collect()}
    found = X.shapes(df).collect()
    trees = spark.createDataFrame([(r.host, r.skel, 1, r.depth, r.path, r.label) for r in found if r.depth], X.SKEL).dropDuplicates(["host", "skel"])
    counted = X.shapes(df).dropDuplicates(["host", "hash"]).groupBy("host", "skel").count().withColumnRenamed("count", "n")
    template = {(r.host, r.skel): r.template for r in X.templates(trees.drop("n").join(counted, ["host", "skel"]).select(
        "host", "skel", "n", "depth", "path", "label")).collect()}
    assert template.keys() == {(r.host, r.skel) for r in found} and len(set(template.values())) < len(template)
    groups: dict = {}
    for page in sorted({r[2] for r in rows}, key=lambda p: xxhash.xxh64_intdigest(p)):
        r = next(r for r in rows if r[2] == page)
        host, skel = next((f.host, f.skel) for f in found if f.hash == xxhash.xxh64_intdigest(page) - (1 << 63))
        groups.setdefault((r[1][8:].split("/")[0], template[host, skel]), []).append(X.collapsed(X.shape(page)))
    want: dict = {}
    for (host, _), shapes in groups.items():
        want[host] = want.get(host, set()) | X.induce(shapes)
    assert got == {h: c for h, c in want.items() if c} and len(got) >= 4


# -- queries and pipeline -----------------------------------------------------------------
def test_queries_match_their_sql(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in oracle.oracle_sql().items():
        got = queries.queries()[name](spark, SF)
        cols = sorted(got.columns)
        cur = con.execute(sql)
        assert sorted(d[0] for d in cur.description) == cols, name
        want = [tuple(r[[d[0] for d in cur.description].index(c)] for c in cols) for r in cur.fetchall()]
        have = [tuple(r[c] for c in cols) for r in got.collect()]
        close = lambda rows: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in rows)
        assert close(have) == close(want), name


def test_pipeline(spark, documents):
    import corpus_pipeline as P
    docs, counts = documents, []
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == documents.columns, name
        counts.append(out.count())
        docs = out
    assert documents.count() > counts[0] >= counts[1] >= counts[2] > 0
    rows = P.run(spark, SF).orderBy("start").collect()
    assert len(rows) == counts[3]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))
