"""Operators that work row by row: tokens, media, pages."""

import hashlib
import math
import random
import struct
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import bpe, html_extract, media
from recordloom.llm.queries import tokenizer_path

VOCAB = tokenizer_path("word_bpe_49k.json")
ODD = [None, "", " ", "a", "x" * 30_000, "word " * 20_000, "<|endoftext|> a<|startoftext|>", "Ünïcødé ΣΑΣ ß İ 漢字 🎉", "\x00\x1c\x85 　", "it's we'll I'd 12 ٣٤", "é"]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCAB)
    t.no_padding()
    t.no_truncation()
    return t


def same_as_library(texts, reference):
    ours = bpe.coder(VOCAB).encode_batch(texts)
    for text, ids, ref in zip(texts, ours, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ref.ids, text[:50]
        assert bpe.coder(VOCAB).decode(ids) == reference.decode(ref.ids, skip_special_tokens=False)


def test_bpe_equals_the_library(reference):
    r = random.Random(3)
    alphabets = ["ab", "aaab", "the in on er", "abcdefghijklmnopqrstuvwxyz' ", "ΣσÄß€漢🎉́e İ1２٣", "ȺɄɅKÅẞªº²¼×ǅñ a", "'s't're!?- \n"]
    same_as_library(["".join(r.choice(a) for _ in range(r.randint(0, 40))) for a in alphabets for _ in range(800)] + [x or "" for x in ODD], reference)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_bpe_on_any_text(reference, texts):
    same_as_library([t for t in texts if all(not 0xD800 <= ord(c) < 0xE000 for c in t)], reference)


def test_bpe_forgets_words_beyond_its_cache(reference):
    small = bpe.TrieBpe(VOCAB, cached=3, max_pairs=2)
    texts = ["one two three four", "five six one two", "three nine"]
    assert small.encode_batch(texts) + small.encode_batch(texts[::-1]) == [np.array(x.ids, "<u4").tobytes() for x in reference.encode_batch(texts + texts[::-1], add_special_tokens=False)]


def test_bpe_rows(spark, reference):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(None, "null id", "c"), (3, "a", "c"), (3, "a", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.encode_digests(df, VOCAB).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    by = {(r.doc_id, r.ids_sha256): r for r in got}
    for i, t, _ in rows:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        r = by[i, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()]
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(df.limit(0), VOCAB).collect() == []


def png(w=2, h=2):
    chunk = lambda n, d: struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress((b"\0" + b"x" * w) * h)) + chunk(b"IEND", b"")


GIF = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + b"\0" * 6 + b"," + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02D\x01\0;"
JPEG = b"\xff\xd8\xff\xe0\x00\x04JF\xff\xc0\x00\x0b\x08\x00\x03\x00\x05\x01\x01\x11\x00\xff\xda\x00\x02ab\xff\x00c\xff\xd9"
BMP = b"BM" + struct.pack("<IHHIIiiHHIIiiII", 54 + 4, 0, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\1\2\3\0"
MP4 = struct.pack(">I4s4sI", 16, b"ftyp", b"isom", 0) + struct.pack(">I4s", 12, b"mdat") + b"data"
PDF = b"%PDF-1.4\n1 0 obj\n<<>>\nendobj\nstartxref\n0\n%%EOF"
OGG = b"OggS\0\x04" + b"\0" * 20 + b"\x01\x03abc"
FLAC = b"fLaC\x80\0\0\x22" + b"\0" * 34 + b"\xff\xf8zz"


@pytest.mark.parametrize(("value", "kind"), [(png(), "image/png"), (GIF, "image/gif"), (JPEG, "image/jpeg"), (BMP, "image/bmp"), (media.wav8(b"abc"), "audio/wav"), (MP4, "video/mp4"), (PDF, "application/pdf"), (OGG, "audio/ogg"), (FLAC, "audio/flac")])
def test_sniffing(value, kind):
    whole = media.sniff(value)
    assert [(f.start, f.end, f.kind) for f in whole] == [(0, len(value), kind)]
    assert [f.start for f in media.sniff(b"junk" + value) if f.kind == kind] == [4]
    if kind != "audio/flac":
        assert all(f.kind != kind for f in media.sniff(value[:-1])) or kind == "application/pdf"


def test_carving_and_correction(spark):
    zipped = png() + b"??" + media.wav8(b"12") + GIF
    df = spark.createDataFrame([("a", zipped, "image/jpeg"), ("b", png(), "image/gif"), ("c", None, "x/y"), ("d", b"", None), ("e", b"BM RIFF PK", "image/bmp"), (None, GIF, "image/gif")], "id string, value binary, declared string")
    got = {r.id: r for r in media.inspect(df, "value", "declared").collect()}
    assert [(o.kind, o.start) for o in got["a"].objects] == [("image/png", 0), ("audio/wav", len(png()) + 2), ("image/gif", len(png()) + 2 + 46)]
    assert got["a"].kind is None and not got["a"].corrected
    assert got["b"].kind == "image/png" and got["b"].corrected
    assert got["c"].kind is None and got["d"].objects == [] and got["e"].objects == []
    assert got[None].kind == "image/gif" and not got[None].corrected
    assert media.inspect(df.limit(0), "value").collect() == []


def test_text_media_round_trip(spark):
    texts = [*ODD, "%PDF- BM RIFF GIF89a fLaC OggS ftyp PK\x03\x04", "y" * 192, "y" * 193, GIF.decode("latin-1")]
    rows = [(i, t, b"?") for i, t in enumerate(texts)] + [(None, "a", b""), (0, None, b"")]
    got = media.text_media(spark.createDataFrame(rows, "doc_id long, text string, media_bytes binary")).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t, _ in rows:
        raw = (t or "").encode()
        size = max(192, -(-len(raw) // 192) * 192)
        payload = raw.ljust(size, b" ")
        want[i] = (len(raw), size, hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    for r in got:
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == want[r.doc_id]
        assert r.media_bytes == r.payload_bytes + 44 and r.feature.startswith("audio/wav;") and r.corrected and r.kind == "audio/wav"
    by = {r.doc_id: r for r in got if r.doc_id}
    assert by[len(texts) - 1].objects.startswith("image/gif:") == ("image/gif" in [f.kind for f in media.sniff(texts[-1].encode())])


def test_neighbours_are_carved_apart():
    import io
    import zipfile

    def archive(name, inner=b"x"):
        z = io.BytesIO()
        with zipfile.ZipFile(z, "w") as f:
            f.writestr(name, inner)
        return z.getvalue()

    one, two = archive("a"), archive("b", archive("inside"))
    values = [PDF, PDF.replace(b"%%EOF", b"%%EOF\n2 0 obj\n<<>>\nendobj\nstartxref\n9\n%%EOF"), one, two, PDF]
    whole = b"junk".join(values)
    found = media.sniff(whole)
    assert [whole[f.start : f.end] for f in found] == values


@pytest.mark.parametrize("magic", [m for m, *_ in media.MAGIC] + [b"PK\x03\x04PK\x05\x06", b"%PDF-1 startxref", b"fLaC\x80\0\0\x22"])
def test_sniffing_is_linear(magic):
    took = []
    for size in (1 << 17, 1 << 19):
        began = time.process_time()
        media.sniff(magic * (size // len(magic)))
        took.append(time.process_time() - began)
    assert took[1] < 9 * took[0] + 0.3


def test_features_are_of_the_samples():
    assert "peak=128;mean=-128.000;rms=128.000;cross=0;entropy=0.000" in media.sample_features(b"\0" * 192)
    wave = lambda k: bytes(int(128 + 100 * math.sin(2 * math.pi * k * i / 192)) for i in range(192 * 3))
    for k, band in ((3, 0), (30, 2), (90, 7)):
        shown = [int(x) for x in media.sample_features(wave(k)).split("bands=")[1].split(",")]
        assert shown.index(max(shown)) == band and max(shown) > 900
    r = random.Random(1)
    long = bytes(r.randrange(256) for _ in range((192 << 10) + 500))
    x = [v - 128 for v in long]
    cross = sum((a >= 0) != (b >= 0) for a, b in zip(x, x[1:], strict=False))
    assert f";mean={sum(x) / len(x):.3f};rms={(sum(v * v for v in x) / len(x)) ** 0.5:.3f};cross={cross};" in media.sample_features(long)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=/a>Menu a</a><li><a href=/b>Menu b</a></ul></nav><div class="cookie-notice">We use cookies and more text than the article has, again and again and again.</div>
<div id=sidebar><p>Side text that is quite long, longer than some paragraphs of the article itself.</div>
<article><h1>Title &amp; more</h1><p>First&nbsp;paragraph with <b>bold</b>,
  <i>italic</i> and &eacute;&#8217;.<p>Short.</p><div class="ad">Buy now</div><blockquote>Quoted words that go on.<br>Same block<br> <br/>Next block</blockquote>
<ul><li>one</li><li>two</ul><aside>Related: other</aside><form><input value=x><button>Send</button></form><!-- hidden --></article>
<section class="comments"><p>A reader says something very long about the article, more than the article says itself, really.</p></section>
<footer>&copy; Site &middot; footer text</footer></body></html>"""


def test_page():
    want = "Title & more\nFirst paragraph with bold, italic and é’.\nShort.\nQuoted words that go on. Same block\nNext block\none\ntwo"
    assert html_extract.main_text(PAGE) == want


def test_page_without_article_element():
    page = "<html><body><nav><a href=/>Home</a> <a href=/x>X</a></nav><div id=content><h1>Head</h1>" + "".join(f"<p>Paragraph {i} has some words that make it text.</p>" for i in range(5)) + "<p>End.</p></div><div class=footer>(c)</div></body></html>"
    assert html_extract.main_text(page).split("\n") == ["Head", *(f"Paragraph {i} has some words that make it text." for i in range(5)), "End."]


STORY = "<article><h1>Head</h1><p>Paragraph one of the story has some words.</p><p>Paragraph two has some more of them.</p></article>"
SIDE = '<div class="widget"><p>A widget at the side that says something longer than the whole story does, again and again and again and again.</p></div>'


@pytest.mark.parametrize("page", [
    "<div class='content-sidebar-wrap'><main>%s</main>%s</div>", "<div class='site has-sidebar'>%s%s</div>", "<div class='post no-comments'>%s</div>%s", "<form action=/><div id=all>%s</div>%s</form>",
    "<div class='comments-open'><main>%s</main></div>%s", "<div class='site has-sidebar'><main>%s</main><ol class='comments'><li><article>A reader writes a lot, much more than the story says, and goes on.</article></ol></div>%s",
    "<main><div class='content-sidebar-wrap'>%s</div></main>%s", "%s<div class='more-widget'><article>A teaser of another story that is longer than the paragraphs of this one, by far.</article></div>%s",
])
def test_marks_of_layout_around_the_article(page):
    html = "<html><body><nav class=menu><article>Menu article</article></nav>" + page % (STORY, SIDE) + "<footer>(c)</footer></body></html>"
    assert html_extract.main_text(html).split("\n") == ["Head", "Paragraph one of the story has some words.", "Paragraph two has some more of them."]


def test_odd_names_around_and_inside():
    text = "".join(f"<p>Paragraph {i} has some words that make it text, and it goes on a bit.</p>" for i in range(4))
    want = "\n".join(f"Paragraph {i} has some words that make it text, and it goes on a bit." for i in range(4))
    for name in ("page search-on", "has-sidebar", "content-sidebar-wrap", "no-comments", "side-by-side", "withBanner header"):
        assert html_extract.main_text(f"<body><nav><a href=/>Home</a></nav><div class='{name}'><article>{text}</article></div></body>") == want
        assert html_extract.main_text(f"<body><ul><li><a href=/>Home</a></ul><div class='{name}'>{text}</div><div class=sidebar>Some more words at the side.</div></body>") == want
    assert html_extract.main_text(f"<article>{text}<div class='side-by-side'><p>Left of it, in words enough.</p><p>Right of it, in words enough.</p></div><p>tail short</p></article>").split("\n")[4:] == ["Left of it, in words enough.", "Right of it, in words enough.", "tail short"]


def test_ratios_choose_the_region_where_no_element_tells():
    teasers = "".join(f"<div><a href=/{i}>Teaser {i} of another story, with a title that is quite long and longer than paragraphs</a></div>" for i in range(30))
    story = "<div><h2>Head of it</h2><div>A short story in a few words.</div><div>It has two parts, no more than that.</div></div>"
    want = "Head of it\nA short story in a few words.\nIt has two parts, no more than that."
    for page in (f"<body><div>{teasers}</div>{story}</body>", f"<body>{story}<div>{teasers}</div></body>", f"<div>{teasers}</div><table><tr><td>{story}</td><td>{teasers}</td></tr></table>"):
        assert html_extract.main_text(page) == want
        assert any(html_extract.main_text(page, smoother=lambda v, s, k=k: np.random.default_rng(k).random(len(v))) != want for k in range(5))
    straight = f"<body><p>{'Words straight in the body. ' * 5}</p>{teasers}</body>"
    assert html_extract.main_text(straight) == ("Words straight in the body. " * 5).strip()


def region_brute(p):
    """Scores of all elements by walking their lines one by one, and smoothing by its formula."""
    plain = [(x[2] if x[0] else 0) / max(1, x[3]) for x in p.lines]
    logs = [math.log1p(x) for x in plain]
    get = lambda i: logs[min(max(i, 0), len(logs) - 1)]
    weight = [math.exp(-0.5 * d * d) for d in range(-3, 4)]
    level = [sum(w * get(i + d) for w, d in zip(weight, range(-3, 4), strict=True)) / sum(weight) for i in range(len(logs))]
    least = html_extract.threshold(np.array(level))
    return [sum(p.lines[i][1] * ((level[i] if plain[i] else 0) - least) for i in range(a, b)) for a, b in zip(p.starts, p.ends, strict=True)]


def test_regions_against_brute_force():
    r = random.Random(8)
    for _ in range(60):
        def block(depth):
            kind = r.choice(["div", "section", "table", "ul"])
            inside = "".join(block(depth - 1) if depth and r.random() < 0.5 else "".join(r.choice(["<i>", "</i>", "word ", "more words here ", "<a href=x>link text</a>"]) for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 4)))
            return f"<{kind}>{inside}</{kind}>"

        html = "".join(block(3) for _ in range(3))
        p = html_extract._Page().finish(html)
        if not p.lines:
            continue
        score = region_brute(p)
        best = max(range(len(score)), key=lambda k: (round(score[k], 9), -k))
        if score[best] <= 1e-9 or sum(abs(x - score[best]) < 1e-6 for x in score) > 1:
            continue
        want = [x for x in p.lines[p.starts[best] : p.ends[best]] if x[0]]
        for side in (0, -1):  # three lines of links and more at an end are a menu
            run = [bool(x[2]) for x in (want[::-1] if side else want)].index(True) if any(x[2] for x in want) else 0
            if run >= 3:
                want = want[:-run] if side else want[run:]
        assert html_extract.main_text(html) == "\n".join(x[0] for x in want)


@pytest.mark.parametrize("piece", ["<b>x<br>", "<b><p>x", "<div>x", "<p>x<b>", "<<a ", "<!-", "<li>x<ul>", "<a href=x>y", "<td>x", "</b>x<i>"])
def test_nesting_is_linear(piece):
    took = []
    for size in (1 << 17, 1 << 19):
        began = time.process_time()
        html_extract.main_text(piece * (size // len(piece)))
        took.append(time.process_time() - began)
    assert took[1] < 9 * took[0] + 0.5


def test_articles_that_are_apart_stay_out():
    text = "<div id=content><p>The text of the page, which has no article element.</p><p>It has two paragraphs.</p></div>"
    for apart in ("<section id=comments class=no-border>%s</section>", "<div class='related-posts'>%s</div>", "<footer>%s</footer>", "<div role=navigation>%s</div>"):
        page = f"<body>{text}{apart % '<article>Something else that is long, longer than all of the text of the page is, and goes on and on.</article>'}</body>"
        assert html_extract.main_text(page) == "The text of the page, which has no article element.\nIt has two paragraphs."


def test_page_corner_cases(spark):
    rows = [(1, "u", None, 5), (2, None, "", 5), (None, "u", "<p>x", 5), (4, "u", "no markup at all", 5), (4, "u", "no markup at all", 5), (5, "u", "<<<>><p", 5), (6, "u", "<nav>only menu</nav>", 5), (7, "u", "<p>" + "long " * 100_000, 5), (8, "u", "<div>" * 3000 + "deep" + "</div>" * 3000, 5)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows_out = got.collect()
    by = {r.page_id: r.text for r in rows_out}
    assert len(rows_out) == len(rows) and by[1] == by[2] == by[6] == "" and by[None] == "x" and by[4] == "no markup at all"
    assert len(by[7]) == 499_999 and by[8] == "deep" and all(r.n_chars == len(r.text) for r in rows_out)
    assert got.limit(0).collect() == []
