"""SentencePiece codec, HTML extraction and WARC derivatives."""

import random

import pytest

from riskspark.llm import html_lineblocks, sentencepiece_codec, warc_derive
from tests.conftest import SF_MID, SF_SMALL

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "\n", "▁", "▁▁", " a", "a ", "<s>", "</s> <unk>", "a" * 3000, " " * 500, "\r\n\x00\t", "漢字🙂é", "x" * 25 + "," * 30]


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(MODEL)


def test_ids_equal_the_library(codec):
    rnd = random.Random(3)
    letters = " \n\t▁ abcdethinESé漢ゼ🙂\0<s>0x,.   "
    texts = ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    assert codec.encode(texts) == [codec.library.encode(t) for t in texts]


def test_long_parts_use_the_heap(codec):
    for text in ["international" * 20, "é" * 100, "the" * 50]:
        assert codec.encode([text])[0] == codec.library.encode(text)


def test_a_wrong_part_is_found(codec):
    codec.kept["▁wrongly"] = (1, 2)
    with pytest.raises(AssertionError):
        codec.check(["▁wrongly"])
    del codec.kept["▁wrongly"]


def test_kept_parts_take_little_memory():
    import tracemalloc

    import pyarrow as pa

    codec, rnd = sentencepiece_codec.Codec(MODEL), random.Random(8)
    codec.encode(["warm up"])
    texts = [" ".join("".join(rnd.choice("abcdeinorst") for _ in range(10)) for _ in range(500)) for _ in range(60)]
    want = [codec.library.encode(t) for t in texts]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
        for at in range(0, 60, 20):
            assert codec.encode(texts[at:at + 20]) == want[at:at + 20]
        grown = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert grown < 100 * 30_000, grown  # bytes a part; all 30,000 are kept


def test_full_stores_change_no_ids(monkeypatch):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdeinorst, é漢") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    for parts, size in ((30, 1 << 25), (400_000, 500)):
        monkeypatch.setattr(sentencepiece_codec, "PARTS_KEPT", parts)
        monkeypatch.setattr(sentencepiece_codec, "BYTES_KEPT", size)
        codec = sentencepiece_codec.Codec(MODEL)
        for _ in range(60):
            texts = [None, "", *(" ".join(rnd.choices(words, k=rnd.randint(0, 20))) for _ in range(rnd.randint(0, 3)))]
            assert codec.encode(texts) == [codec.library.encode(t or "") for t in texts]
        assert codec.encode([]) == [] and codec.encode([None, ""]) == [[], []]


def test_other_model_kinds_are_refused(tmp_path):
    def field(n, payload):
        return bytes([n << 3 | 2, len(payload)]) + payload

    with open(MODEL, "rb") as f:
        data = f.read()
    path = tmp_path / "unigram.model"
    path.write_bytes(data + field(2, bytes([3 << 3, 1])))  # a later field of the same number wins: unigram
    with pytest.raises((ValueError, RuntimeError, OSError)):
        sentencepiece_codec.Codec(str(path))


def test_query_over_documents(spark, codec):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in sentencepiece_codec.digests(docs, MODEL).collect()}
    import hashlib

    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = codec.library.encode(r["text"])
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(codec.library.decode(ids).encode()).hexdigest()


def test_codec_edge_rows(spark):
    rows = [(1, None, "x", 0), (2, "", "x", 0), (3, "two words", "x", 0), (3, "two words", "x", 0), (None, "a", None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, ids int")
    got = sorted(sentencepiece_codec.digests(df, MODEL).collect(), key=str)
    assert len(got) == 5 and sum(r["n_tokens"] == 0 for r in got) == 2
    assert sentencepiece_codec.digests(df.limit(0), MODEL).collect() == []


ARTICLE = "<h1>Head &amp; line</h1><p>" + "word " * 30 + "</p><p>Short.</p><p>" + "more " * 20 + "</p>"
WANT = "Head & line\n" + " ".join(["word"] * 30) + "\nShort.\n" + " ".join(["more"] * 20)


@pytest.mark.parametrize("page", [
    f"<body><nav><a href=x>Home</a></nav><article>{ARTICLE}</article><footer>foot {'f ' * 200}</footer></body>",
    f"<div class='header'>top</div><div id=content>{ARTICLE}</div><div class='sidebar'>{'junk ' * 400}</div>",
    f"<main>{ARTICLE}<aside>{'a ' * 90}</aside></main><section id=comments><p>{'c ' * 400}</section>",
    f"<article>{ARTICLE.replace('<p>Short', '<form>name <input></form><div class=ad>buy</div><p>Short')}</article>",
    f"<html><head><title>t</title><script>var a='</p>';</script><style>p{{}}</style></head><body><!-- <p>no</p> -->{ARTICLE}",
    f"<article>{ARTICLE}</article><article class='related'>{'teaser ' * 3}</article>",
    f"<div role=dialog>We use cookies {'x ' * 300}</div><article>{ARTICLE}<noscript>{'n ' * 99}</noscript></article>",
])
def test_article_is_found(page):
    assert html_lineblocks.main_text(page) == WANT


REFS = "<ul>" + "".join(f"<li><a href=r{i}>Reference number {i}</a></li>" for i in range(4)) + "</ul>"
REFS_WANT = "\n".join(f"Reference number {i}" for i in range(4))


@pytest.mark.parametrize("page, want", [
    (f"<nav>Menu</nav><article>{ARTICLE}{REFS}{ARTICLE}</article><footer>foot</footer>", f"{WANT}\n{REFS_WANT}\n{WANT}"),
    (f"<article>{REFS}{ARTICLE}{REFS}</article><p>{'outside ' * 300}</p>", f"{REFS_WANT}\n{WANT}\n{REFS_WANT}"),
    (f"<main>{ARTICLE}<p><a href=n>Next chapter</a></p></main>", f"{WANT}\nNext chapter"),
    (f"<article>{ARTICLE}</article><div>between</div><article>{ARTICLE}{REFS}</article>", f"{WANT}\n{WANT}\n{REFS_WANT}"),
    (f"<article><p>Short teaser.</p></article><div>{ARTICLE}</div>", f"Short teaser.\n{WANT}"),
    (f"<main>{REFS}</main>", REFS_WANT),
])
def test_articles_are_kept_whole(page, want):
    assert html_lineblocks.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    (f"<body><form id=aspnetForm><div class=nav>Menu</div><input><article>{ARTICLE}</article><button>Go</button></form></body>", WANT),
    (f"<body><form id=aspnetForm action='./'><nav>Menu</nav><select><option>x</select><div>{ARTICLE}</div></form><footer>foot</footer></body>", WANT),
    (f"<body><div>{ARTICLE}</div><form class=login>Your name <input><p>{'rules ' * 20}</p></form></body>", WANT),
    *[(f"<div class='{name}'><div class=share>Share this</div><article>{ARTICLE}</article></div>", WANT)
      for name in ("social", "related", "share", "widget", "notice", "search-results")],
    (f"<section role=search><main>{ARTICLE}</main></section><div class=social>{'tweet ' * 200}</div>", WANT),
    (f"<head><title>t</title><body><header><main>{ARTICLE}</main></header>", WANT),
    (f"<div hidden><article>{'gone ' * 200}</article></div><article>{ARTICLE}</article>", WANT),
    (f"<aside class=related><article>{'teaser ' * 20}</article></aside><article>{ARTICLE}</article>", WANT),
])
def test_what_encloses_the_article_is_not_dropped(page, want):
    assert html_lineblocks.main_text(page) == want


PARAGRAPH = "<p>" + "Several words of running text stand here. " * 5 + "</p>"
PLAIN = ("Several words of running text stand here. " * 5).strip()
TALK = "<section class=discussion><h3>Discussion</h3><div class=comment-author>Ann</div><p>" + "I think so too. " * 20 + "</p></section>"


@pytest.mark.parametrize("page, want", [
    # link lists between paragraphs, without article or main
    (f"<div id=top><a href=a>A</a></div><div id=body>{PARAGRAPH}{REFS}{PARAGRAPH}</div>", f"{PLAIN}\n{REFS_WANT}\n{PLAIN}"),
    (f"<body>{PARAGRAPH * 2}{REFS}{PARAGRAPH}{REFS}</body>", f"{PLAIN}\n{PLAIN}\n{REFS_WANT}\n{PLAIN}"),
    # short lines of a menu before the first paragraph and behind the last one
    (f"<div><div>About</div><div>Contact</div><h1>Title</h1>{PARAGRAPH * 3}<div>Terms</div></div>", f"Title\n{PLAIN}\n{PLAIN}\n{PLAIN}"),
    (f"<ul><li>About<li>Contact</ul><div>{PARAGRAPH * 2}</div>", f"{PLAIN}\n{PLAIN}"),
    # names that only begin like those of widgets
    *[(f"<article>{PARAGRAPH}<p class={name}>Own text.</p>{PARAGRAPH}</article>", f"{PLAIN}\nOwn text.\n{PLAIN}")
      for name in ("related-work", "social-history", "widget-theory", "notice-board-history")],
    *[(f"<article>{PARAGRAPH}<div class='x {name}'>Foreign text.</div>{PARAGRAPH}</article>", f"{PLAIN}\n{PLAIN}")
      for name in ("related-posts", "share-buttons", "widget", "ad-slot", "comments", "newsletter-box")],
    # a stray quote in a tag
    (f'<article><p title=5">Some text.</p>{PARAGRAPH}<p title="a>b">More.</p></article>', f"Some text.\n{PLAIN}\nMore."),
    # comments under a name that articles use too
    (f"<article>{PARAGRAPH}{TALK}</article>", PLAIN),
    (f"<div>{PARAGRAPH}</div>{TALK}", PLAIN),
    (f"<article>{PARAGRAPH}<section class=discussion><h2>Discussion</h2>{PARAGRAPH}</section></article>", f"{PLAIN}\nDiscussion\n{PLAIN}"),
    # a line break is white space inside its block
    (f"<article><p>One<br>two<br/> three</p>{PARAGRAPH}</article>", f"One two three\n{PLAIN}"),
])
def test_cuts_that_once_went_wrong(page, want):
    assert html_lineblocks.main_text(page) == want


def test_pages_of_the_table(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r for r in html_lineblocks.article_text(pages).collect()}
    for r in pages.collect():
        inner = re.sub("</?b>", "", r["html"].partition("<article>")[2].partition("</article>")[0])
        want = "\n".join(x for x in (" ".join(html.unescape(t).split()) for t in re.split("<[^>]*>", inner)) if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_html_edge_rows(spark):
    rows = [(1, None, None), (1, None, None), (2, "u", ""), (3, "u", "<p>only"), (4, "u", "a < b &am c&nbsp;d"), (5, "u", "<a href='" + "x" * 10**6)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'z' as text", "1 as n_chars")
    got = html_lineblocks.article_text(df).orderBy("page_id").collect()
    assert [r["text"] for r in got[:5]] == ["", "", "", "only", "a < b &am c d"] and len(got) == 6
    assert html_lineblocks.article_text(df.limit(0)).collect() == []


def test_derivatives_are_linked_and_hold(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/x", "<nav>Menu</nav><p>One</p><p>Two &amp; é</p><script>no</script>")], "page_id long, url string, html string")
    made = warc_derive.responses(pages)
    out = warc_derive.derive(made)
    meta, conv = sorted(out.collect(), key=lambda r: r["kind"], reverse=True)
    source, status, http, payload = warc_derive.parse(bytes(made.first()["record"]))
    assert (meta["kind"], conv["kind"]) == ("metadata", "conversion")
    assert meta["refers_to"] == conv["refers_to"] == source["warc-record-id"]
    assert meta["payload_ok"] and conv["payload_digest"] == source["warc-payload-digest"] == warc_derive.digest(payload)
    for r in (meta, conv):
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        block = rest[:-4]
        assert rest.endswith(b"\r\n\r\n") and len(block) == r["content_length"] and warc_derive.digest(block) == r["block_digest"]
        fields = dict(warc_derive.fields(head)[1])
        assert fields["WARC-Refers-To"] == source["warc-record-id"] and fields["WARC-Date"] == source["warc-date"]
        assert fields["WARC-Target-URI"] == "http://a/x" and int(fields["Content-Length"]) == len(block)
    assert bytes(conv["record"]).partition(b"\r\n\r\n")[2][:-4].decode() == "Menu\nOne\nTwo & é"
    assert b"http-content-type: text/html; charset=utf-8" in bytes(meta["record"])
    import gzip

    path = tmp_path / "warc"
    warc_derive.write(out.coalesce(1), str(path))
    data = b"".join(gzip.open(p).read() for p in sorted(path.glob("part-*")))
    assert data == b"".join(bytes(r["record"]) for r in out.collect())


def test_broken_records_are_named(spark):
    good = warc_derive.response("u", "2024-01-01T00:00:00Z", b"<p>x")
    rows = [(1, None), (2, b""), (3, b"junk"), (4, good.replace(b"response\r\n", b"request\r\n", 1)), (5, good[:-12]),
            (6, good.replace(b"HTTP/1.1", b"XXXX/1.1")), (7, good.replace(b"<p>x", b"<p>y")), (7, good)]
    got = warc_derive.derive(spark.createDataFrame(rows, "key long, record binary")).collect()
    assert {r["key"] for r in got if r["kind"] == "error"} == {1, 2, 3, 4, 5, 6}
    assert sorted(r["payload_ok"] for r in got if r["key"] == 7) == [False, False, True, True]
    assert warc_derive.derive(spark.createDataFrame([], "key long, record binary")).collect() == []


def test_encoded_payloads_and_odd_headers(spark):
    import gzip
    import zlib

    html = f"<body>{PARAGRAPH}</body>".encode()
    packed = gzip.compress(html)
    chunks = b"".join(f"{len(c):x};x=1\r\n".encode() + c + b"\r\n" for c in (packed[:7], packed[7:])) + b"0\r\n\r\n"

    def made(payload, *http, digest=None):
        block = "\r\n".join(["HTTP/1.1 200 OK", "Content-Type: text/html", *http]).encode() + b"\r\n\r\n" + payload
        return warc_derive.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Target-URI", "http://a/\x85b"),
                                   *([("WARC-Payload-Digest", digest)] if digest else [])], block)

    rows = [(1, made(chunks, "Transfer-Encoding: chunked", "Content-Encoding: gzip", digest=warc_derive.digest(packed))),
            (2, made(zlib.compress(html), "Content-Encoding: deflate")), (3, made(zlib.compress(html)[2:-4], "Content-Encoding: deflate")),
            (4, made(html, "Content-Encoding: br")), (5, made(html[:9], "Content-Encoding: gzip")), (6, made(b"ff\r\nab", "Transfer-Encoding: chunked")),
            (7, made(html, "X-Odd: a\u2028b: c\x85d"))]
    df = spark.createDataFrame(rows, "key bigint, record binary").selectExpr("*", "'k' as kind", "1 as error", "2 as record_id")
    got = warc_derive.derive(df).collect()
    texts = {r["key"]: warc_derive.fields(bytes(r["record"]))[0] and bytes(r["record"]).partition(b"\r\n\r\n")[2].decode().strip() for r in got if r["kind"] == "conversion"}
    assert texts == {k: PLAIN for k in (1, 2, 3, 7)}
    assert {r["key"]: r["error"] for r in got if r["kind"] == "error"} == {
        4: "content encoding br cannot be read", 5: "payload cannot be unpacked", 6: "chunks cut short"}
    assert [r["payload_ok"] for r in got if r["key"] == 1] == [True, True]
    assert {r["target_uri"] for r in got if r["key"] == 7} == {"http://a/\x85b"}
    meta = next(bytes(r["record"]).decode() for r in got if r["key"] == 7 and r["kind"] == "metadata")
    assert "http-x-odd: a\u2028b: c\x85d\r\n" in meta
