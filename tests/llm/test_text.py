"""SentencePiece, toxicity, WARC and HTML text."""

import gzip
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from sparkmart.llm import html_text, pieces, toxicity, warc
from tests.llm.cases import DOCS, FOLDER, awkward, frame, prose


def hard_texts():
    rng = random.Random(12)
    odd = ["a  b \t c\n d ", "a" * 300, " " * 40, "\x00\x01z", "漢字かな", "😀😀 é", "x = f(a, b)  # " + "=" * 50, "ÀÈ" * 30, "<s> </s> <unk> <0x41>"]
    made = ["".join(rng.choice("abcdefgh the\nAB012  .,é") for _ in range(rng.randrange(1, 200))) for _ in range(200)]
    return [*odd, *made, prose(rng, 3000)]


def test_encoding_equals_the_definition(spark):
    path = pieces.default_model()
    judge = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [*awkward(random.Random(1)), *((100 + i, t, None, None, 1) for i, t in enumerate(hard_texts()))]
    got = pieces.decode(pieces.encode(frame(spark, rows, extra=True), path), path).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["ids"] == (judge.encode(r["text"]) if r["text"] else []) and r["decoded"] == (r["text"] or "").replace(pieces.BLANK, " ") and r["kept"] == "mine"
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = pieces.digest(docs).collect()
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in found)
    want = {r["doc_id"]: judge.encode(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: r["ids"] for r in found} == want
    assert pieces.digest(spark.createDataFrame([], DOCS)).count() == 0


class Unigram(pieces.Encoder):
    """An encoder over a small vocabulary with scores, without a model file."""

    def __init__(self, scores):
        names = ["<unk>", *scores]

        class Same:
            @staticmethod
            def normalize(text):
                return text

        self.__dict__["v"] = pieces.Vocabulary(b"", names, list(range(1, len(names))), [0.0, *scores.values()], [], 0, False, True)
        self.normalizer, self.number, self.n = Same(), {p: i for i, p in enumerate(names) if i}, len(names)
        self.longest = max(map(len, scores))
        self.unit = pieces.re.compile("(?s).+")
        ordered = sorted(range(1, len(names)), key=lambda i: names[i])
        self.ids, self.sizes = np.array(ordered), np.array([len(names[i]) for i in ordered])
        self.lows, self.highs = (self._keys([names[i] for i in ordered], f) for f in (b"\0", b"\xff"))
        self.lowest, self.pairs, self.known = min(scores.values()) - 10, {}, {}


def test_unigram_takes_the_best_sum():
    rng = random.Random(7)
    scores = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): -rng.random() * 9 for _ in range(25)} | {"a": -3.1, "b": -2.7, "c": -3.3}
    encoder = Unigram(scores)
    texts = ["".join(rng.choice("abcx") for _ in range(rng.randint(1, 30))) for _ in range(200)]

    def best(text):
        top = [0.0] + [-1e9] * len(text)
        for i in range(1, len(text) + 1):
            for n in range(1, 5):
                if i >= n:
                    s = scores.get(text[i - n : i], encoder.lowest if n == 1 else -1e9)
                    top[i] = max(top[i], top[i - n] + s)
        return top[-1]

    for text, numbers in zip(texts, encoder.encode_units(texts)):
        said = "".join(encoder.text_of(k) for k in numbers)
        assert said == text and sum(encoder.v.scores[k] if k < encoder.n else encoder.lowest for k in numbers) == pytest.approx(best(text))


def test_kernel_by_its_definition():
    def plain(s, t):
        from itertools import combinations

        def weights(x):
            out = {}
            for at in combinations(range(len(x)), toxicity.ORDER):
                k = tuple(x[i] for i in at)
                out[k] = out.get(k, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
            return out

        a, b = weights(s), weights(t)
        dot = sum(v * b.get(k, 0) for k, v in a.items())
        return dot / (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5

    for s, t in (("idiot", "idxiot"), ("idiot", "idot"), ("clown", "idiot"), ("moron", "moorron")):
        table = np.zeros(toxicity.CLASSES**toxicity.ORDER)
        number, weight = toxicity.subsequences(toxicity.coded([t]))
        np.add.at(table, number[0], weight / toxicity.norms(number, weight)[0])
        assert toxicity.evaluate([s], table)[0] == pytest.approx(plain(s, t))


def test_words_in_letters():
    assert toxicity.words("You i d i o t, st*pid ID1OT a b m.o.r.o.n!") == ["you", "idiot", "stpid", "idiot", "moron"]
    assert toxicity.words(None) == [] and "".join(sorted(set("".join(toxicity.pieces("x" * 95 + "y"))))) == "$^xy"


def labelled(rng, n):
    insults = ["idiot", "moron", "stupid", "pathetic"]
    rows, labels = [], []
    for i in range(n):
        w = prose(rng, rng.randint(10, 120)).split(" ")
        if i % 6 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(insults))
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(i % 6 == 0)))
    return rows, labels


def test_toxicity_learns_and_tolerates_gaps(spark):
    rng = random.Random(13)
    rows, labels = labelled(rng, 900)
    disguised = ["you are an id-iot and a sttupid mo.ron", "i d i o t and p a t h e t i c", "1diot st0pid mor0n"]
    rows += [(2000 + i, f"{prose(rng, 20)} {t} {prose(rng, 20)}", None, None, 1) for i, t in enumerate(disguised)]
    rows += [(r[0] + 5000 if r[0] is not None else None, *r[1:]) for r in awkward(rng)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = frame(spark, rows, extra=True)
    got = toxicity.digest(df, known).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert held and all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in got if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.97
    assert all(r["predicted"] == 1 for r in got if r["doc_id"] and 2000 <= r["doc_id"] < 2003)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] is None or r["doc_id"] >= 5000)
    assert {r["doc_id"] for r in toxicity.keep_clean(df, known, df).collect()}.isdisjoint({2000, 2001, 2002})


def test_toxicity_without_labels(spark):
    df = frame(spark, awkward(random.Random(1)))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r["predicted"] == 0 for r in toxicity.digest(df, none).collect())
    assert toxicity.digest(spark.createDataFrame([], DOCS), none).count() == 0
    both = spark.createDataFrame([(1, 1, None), (None, 1, 1), (5, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.digest(df, both).count() == len(awkward(random.Random(1)))


def test_toxicity_held_out_on_the_table(spark):
    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet")
    got = toxicity.digest(read("documents"), read("labels")).filter("held_out").join(read("labels"), "doc_id").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) >= 0.85


def test_html_cases(spark):
    page = """<html><head><title>x</title><style>a</style></head><body class="no-sidebar"><header><h1>Site</h1></header><nav>m</nav><div id="cookie-notice">c</div>
    <article><header><h1>T &amp; t</h1><p>by me</p></header><p>One<br>two &nbsp; x<p>Three <a href=x>l</a></p><ul><li>i1<li>i2</ul><table><tr><td>a<td>b<tr><td>c</table>
    <div class="comments"><p>bad</p></div><aside>z</aside><!-- k --><script>var t="</p>";</script>tail</article><form><p>f</p></form>
    <section class=comments><article class="comment"><p>r</p></article></section><footer>c</footer></body></html>"""
    bare = '<div class="menu"><a href=1>one</a></div><div><p>Hello world</p><p><a href=2>link only</a></p><p>x &lt; y</p>'
    cases = [(1, "http://a.b/1", page), (2, None, bare), (3, "x", None), (4, "", ""), (5, "http://u@A.B:80/?q", "<<<>>"), (6, "http://a.b/2", "<p>" + "long " * 50000), (7, "http://a.b/3", "<script>never"), (1, "http://a.b/1", page)]
    df = spark.createDataFrame(cases, "page_id long, url string, html string").selectExpr("*", "'mine' AS text", "1 AS template")
    got = [(r["page_id"], r["text"]) for r in html_text.main_text(df).orderBy("page_id").collect()]
    assert got[0][1] == got[1][1] == "T & t\nOne two x\nThree l\ni1\ni2\na b\nc\ntail"
    assert got[2][1] == "Hello world\nx < y" and got[3][1] == got[4][1] == got[7][1] == "" and got[6][1] == ("long " * 50000).strip()
    assert html_text.digest(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_induction(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(40):
        own = [prose(rng, 12).replace("\n", " ") for _ in range(rng.randint(2, 5))]
        body = "".join(f"<p>{x}</p>" for x in own)
        rows.append((i, "http://site.org/%d" % i, f"<body><div><p>Welcome to our site</p></div><div>{body}</div><div><p>All rights kept by us</p></div></body>"))
        want[i] = "\n".join(" ".join(x.split()) for x in own)
    same = "<body><p>One page that stands here many times</p><p>With two lines</p></body>"
    rows += [(100 + i, "http://copies.org/%d" % i, same) for i in range(30)]
    got = {r["page_id"]: r["text"] for r in html_text.digest(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: got[i] for i in want} == want
    assert all(got[100 + i] == "One page that stands here many times\nWith two lines" for i in range(30))


def test_tree_matching_is_largest():
    def tree(spec):
        node = html_text.Node(spec[0], False, False, False)
        node.children = [tree(s) for s in spec[1:]]
        return node

    def plain(a, b):
        if a.tag != b.tag:
            return 0
        m = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
        for i, x in enumerate(a.children, 1):
            for j, y in enumerate(b.children, 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + plain(x, y))
        return 1 + m[-1][-1]

    rng = random.Random(5)

    def random_tree(depth):
        return tree_spec(depth)

    def tree_spec(depth):
        return [rng.choice("ab"), *([tree_spec(depth - 1) for _ in range(rng.randint(0, 4))] if depth else [])]

    for _ in range(100):
        a, b = tree(["r", *random_tree(3)[1:]]), tree(["r", *random_tree(3)[1:]])
        assert len(html_text.matched(a, b)) == plain(a, b)


def test_warc_round_trip(spark, tmp_path):
    html = b"<html lang=de><title>A &amp; b</title><body><nav><a href='/x'>menu</a></nav><p>caf\xe9</p></body></html>"
    chunked = b"%x\r\n%s\r\n0\r\n\r\n" % (len(html), html)
    bodies = {
        "<urn:uuid:1>": b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\nX-A: 1\r\nX-A: 2\r\n\r\n" + html,
        "<urn:uuid:2>": b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n" + chunked.replace(chunked, b"%x\r\n%s\r\n0\r\n\r\n" % (len(gzip.compress(html, mtime=0)), gzip.compress(html, mtime=0))),
        "<urn:uuid:3>": b"",
    }
    out = b""
    for i, block in bodies.items():
        head = [("WARC-Type", "response"), ("WARC-Record-ID", i), ("WARC-Target-URI", "http://h.de/p"), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Block-Digest", warc.digest_of(block)), ("Content-Length", str(len(block)))]
        out += gzip.compress(warc.wire(head, block))
    out += gzip.compress(warc.wire([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:uuid:9>"), ("Content-Length", "3")], b"GET"))
    (tmp_path / "a.warc.gz").write_bytes(out)
    found = warc.read_warc(spark, str(tmp_path))
    assert found.count() == 4
    got = warc.with_wire(warc.derive(found)).collect()
    assert len(got) == 6
    by = {(r["refers_to"], r["warc_type"]): r for r in got}
    for i in ("<urn:uuid:1>", "<urn:uuid:2>"):
        text, meta = by[i, "conversion"], by[i, "metadata"]
        assert bytes(text["block"]).decode() == "menu\ncafé" and text["concurrent_to"] == meta["record_id"] and meta["concurrent_to"] == text["record_id"]
        said = bytes(meta["block"]).decode()
        assert "title: A & b\r\n" in said and "language: de\r\n" in said and "outlink: http://h.de/x\r\n" in said and "source-block-digest-holds: true\r\n" in said
        assert meta["source_block_digest"] == warc.digest_of(bodies[i])
    assert [(h["name"], h["value"]) for h in by["<urn:uuid:1>", "metadata"]["source_headers"]][1:] == [("X-A", "1"), ("X-A", "2")]
    for r in got:
        (headers, block), = warc.records(bytes(r["wire"]))
        assert block == bytes(r["block"]) and warc.named(headers, "WARC-Refers-To") == r["refers_to"] and warc.named(headers, "warc-block-digest") == warc.digest_of(block)


def test_warc_of_pages(spark):
    rows = [(1, "http://a/1", "<p>x</p>"), (2, None, None), (None, "u", ""), (1, "http://a/1", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'mine' AS block", "'mine' AS headers")
    got = warc.digest(df).collect()
    assert len(got) == 8 and sorted(r["record_id"] for r in got) == sorted(r["record_id"] for r in warc.digest(df).collect())
    one = [r for r in got if r["page_id"] == 1 and r["warc_type"] == "conversion"]
    assert {r["block"] for r in one} == {"x"} and one[0]["source_payload_digest"] == warc.digest_of(b"<p>x</p>")
    assert hashlib.sha1(b"").digest() and warc.digest(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_markup_inside_scripts_and_open_heads():
    def said(source):
        return [text for text, _, _ in html_text.Page(source).blocks]

    loop = "<script>for(i=0;i<n;i++){x()}</script>"
    assert said(f"{loop}<p>main text</p>") == ["main text"] and said(f"<body><p>a</p>{loop.upper()}<p>b</p></body>") == ["a", "b"]
    assert said("<style>a<b{}</style><p>x</p><textarea>1<2 <p>no</textarea><p>y") == ["x", "y"]
    assert said("<head><title>t <b</title><meta charset=x><noscript><img src=i><p>no</p></noscript><div>one</div><p>two") == ["one", "two"]
    assert said("<head><title>never closed<body><p>x</p>") == ["x"] and said("<script>never") == [] and said("<script src=a /><p>x</p>") == ["x"]
    title, lang, links = warc.page_facts(f"<title>T</title>{loop}<script>'<a href=/no>'</script><a href=/yes>y</a>", "http://h/")
    assert (title, lang, links) == ("T", "", ["http://h/yes"])


def test_long_sibling_lists_are_aligned():
    def tree(tags):
        root = html_text.Node("body", False, False, False)
        root.children = [html_text.Node(t, False, False, False) for t in tags]
        return root

    rng = random.Random(8)
    tags = [rng.choice(("p", "ul", "h2", "div", "table")) for _ in range(900)]
    less = tags[:100] + tags[101:500] + tags[503:]
    assert len(html_text.matched(tree(tags), tree(less))) == 1 + len(less) == len(html_text.matched(tree(less), tree(tags)))
    deep = [html_text.Page("<div>" * 3000 + "<p>x").root for _ in range(2)]
    assert len(html_text.matched(*deep)) == 3002


def test_templates_of_several_layouts(spark):
    rng = random.Random(6)
    rows, want = [], {}

    def add(host, page, own, source):
        rows.append((page, f"http://{host}/{page}", source))
        want[page] = own

    for i in range(24):
        own = " ".join(prose(rng, 12).split())
        add("two.org", i, own, (f"<div><p>Welcome here</p></div><div><p>{own}</p></div>", f"<section><h2>Also on this site</h2></section><ul><li>{own}</ul><section><p>Kept by us</p></section>")[i % 2])
        add("holes.org", 100 + i, own, f"<div><p>Welcome here</p></div><div><p>{own}</p></div>")
    rows += [(200 + i, f"http://holes.org/e{i}", (None, "", "<body></body>")[i % 3]) for i in range(60)]
    want |= {200 + i: "" for i in range(60)}
    for i in range(12):
        own = "ok" if i % 2 else " ".join(prose(rng, 60).split())
        add("short.org", 300 + i, f"{own} {i}", f"<div><p>Welcome to all of our pages here</p></div><div><p>{own} {i}</p></div>")
    for k in range(3):  # whichever page has the smallest hash
        shifted = [(p, u and f"{u}?{k}", h) for p, u, h in rows]
        got = {r["page_id"]: r["text"] for r in html_text.digest(spark.createDataFrame(shifted, "page_id long, url string, html string")).collect()}
        assert got == want


def test_induction_alone_finds_the_text(spark):
    """Pages without article, main or telling names; one says in its text what stands in the template."""
    def body(i, extra=""):
        return f"<html><body><div><p>Motto of the house.</p><p>Home</p></div><div><div><p>Text {i} of day {i * 7}.</p><p>More of it: {i * i}.</p>{extra}</div></div><div><p>Imprint, and so on.</p></div></body></html>"

    pages = [(i, f"http://a.example/{i}", body(i)) for i in range(12)]
    pages[3] = (3, "http://a.example/3", body(3, "<p>Motto of the house.</p>"))
    pages += [(20 + i, "http://a.example/4", pages[4][2]) for i in range(30)] + [(90, None, None), (91, "http://b.example/", body(1)), (92, "http://a.example/", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.digest(df).collect()}
    for i in range(12):
        assert got[i] == f"Text {i} of day {i * 7}.\nMore of it: {i * i}." + ("\nMotto of the house." if i == 3 else "")
    assert {got[20 + i] for i in range(30)} == {got[4]} and got[90] == got[92] == ""
    assert got[91] == "Motto of the house.\nHome\nText 1 of day 7.\nMore of it: 1.\nImprint, and so on."  # one page of a host shows no template
    named = df.selectExpr("*", "'mine' AS row", "'mine' AS _host", "'mine' AS _template", "'mine' AS texts", "'mine' AS id")
    assert {(r["row"], r["_host"], r["_template"], r["texts"], r["id"]) for r in html_text.main_text(named).collect()} == {("mine",) * 5}


def test_pairs_are_judged_together_and_memory_is_exact(monkeypatch):
    """Few remembered pairs, groups of a few letters and a short memory change no id."""
    monkeypatch.setattr(pieces, "PAIR_BITS", 3)
    monkeypatch.setattr(pieces, "INDEXED", 50)
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    path = pieces.default_model()
    judge = sentencepiece.SentencePieceProcessor(model_file=path)
    encoder, decoder = pieces.Encoder(pieces.Vocabulary.read(path)), pieces.Decoder(pieces.Vocabulary.read(path))
    texts = [None, "", *hard_texts()[:80]]
    for at in range(0, len(texts), 9):
        part = texts[at : at + 9]
        ids, ends = encoder.encode(part)
        got = [x.tolist() for x in np.split(ids, ends[:-1])]
        assert got == [judge.encode(t) if t else [] for t in part]
        said = decoder.decode_all(pa.array([None, *got], pa.list_(pa.int32()))).to_pylist()
        assert said == [None, *(decoder.decode(x) for x in got)] == [None, *((t or "").replace(pieces.BLANK, " ") for t in part)]
    one, two = (x.ravel() for x in np.meshgrid(np.arange(300, 900), np.arange(300, 900)))
    made = encoder.merges.made
    one, two = one[made[one] & made[two]], two[made[one] & made[two]]
    assert encoder.side_by_side(one, two).tolist()[::97] == [encoder.side_by_side(one[i : i + 1], two[i : i + 1])[0] for i in range(0, len(one), 97)]


def test_a_decoder_reads_the_vocabulary_once():
    """Every task makes one: its start may not grow with the square of the vocabulary."""
    reads = []

    class Watched(list):
        def __iter__(self):
            reads.append(1)
            return super().__iter__()

    vocabulary = pieces.Vocabulary.read(pieces.default_model())
    vocabulary.normal = Watched(vocabulary.normal)
    decoder = pieces.Decoder(vocabulary)
    assert len(reads) <= 2
    control = vocabulary.pieces.index("<s>")
    assert decoder.table[control] == b"" and decoder.table[vocabulary.unknown] and decoder.table[vocabulary.byte_ids[65]] == b"A"
    assert decoder.decode([control, vocabulary.pieces.index("▁the")]) == "the"
