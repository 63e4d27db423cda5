"""Packing, archives and pages: exact round trips and brute force."""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections import Counter, defaultdict
from datetime import datetime

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortloom.llm import packing, templates, warc

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    (1, "Hello, WORLD it's 12ab café ñandú\n\nfoo"),
    (2, None),
    (3, ""),
    (4, "Σας ΣΑΣ İstanbul éa <|endoftext|>b 中文字 مرحبا ǅ \x85x\xa0y \x1cz don't ’s" * 40),
    (4, "same id"),
    (None, "no id"),
    (9, "word " * 5000),
]


def test_pieces_join_to_the_ids_of_the_tokenizer(spark):
    docs = spark.createDataFrame([(*r, 7, b"x") for r in TEXTS], "doc_id long, text string, part int, ids binary").repartition(3)
    pieces = packing.pack(docs, PATH, length=64).collect()
    tokenizer = Tokenizer.from_file(PATH)
    expected = Counter()
    for doc_id, text in TEXTS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        expected[(doc_id, struct.pack(f"<{len(ids)}I", *ids))] += 1
    windows, whole = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        windows[p.sequence_id].append((p.offset, p.length))
        # Pieces of one document follow each other in the stream.
        whole[(p.doc_id, p.sequence_id * 64 + p.offset - p.start, p.doc_tokens)].append((p.start, bytes(p.ids)))
    assert Counter((key[0], b"".join(x for _, x in sorted(parts))) for key, parts in whole.items()) == expected
    for number, parts in windows.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == 64 or number == max(windows)
    digest = packing.piece_digest(packing.pack(docs, PATH, length=64))
    assert all(0 <= r.ids_crc32 < 1 << 32 for r in digest.collect())
    assert sum(zlib.crc32(bytes(p.ids)) for p in pieces) > 0
    joined = packing.sequences(packing.pack(docs, PATH, length=64))
    assert sum(len(r.ids) for r in joined.collect()) == sum(len(p.ids) for p in pieces)


def test_encoder_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(packing, "MAX_CACHED_PIECES", 2)
    encoder, tokenizer = packing.WordEncoder(PATH), Tokenizer.from_file(PATH)
    for text in ("one two three four", "five, six. SEVEN", "one two"):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode([text]) == [struct.pack(f"<{len(ids)}I", *ids)]


PAGES = [
    (5, "http://a.example/x", "<p>é\r\n\r\nWARC/1.1\r\n\r\n"),
    (3, None, "<p>é\r\n\r\nWARC/1.1\r\n\r\n"),
    (3, "http://b.example\r\nX: y", "<p>é\r\n\r\nWARC/1.1\r\n\r\n"),
    (None, "u", "<p>é\r\n\r\nWARC/1.1\r\n\r\n"),
    (None, "u", "alone"),
    (8, "u", None),
    (7, "u", ""),
]


@pytest.mark.parametrize("least", [0, 10])
def test_revisits_after_a_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, "x") for r in PAGES], "page_id long, url string, html string, path string")
    rows = warc.deduplicate(pages.repartition(2), least).collect()
    groups = defaultdict(list)
    for page_id, _, html in PAGES:
        groups[html or ""].append(page_id)
    expected = Counter()
    for html, ids in groups.items():
        raw = html.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        ids.sort(key=lambda i: (i is None, i))
        for at, page_id in enumerate(ids):
            again = at > 0 and len(raw) >= least
            expected[(page_id, len(raw), digest, "revisit" if again else "response", ids[0] if again else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == expected


def test_every_reference_leads_to_a_record(spark):
    same, other = "<p>the same page again and again</p>", "<p>nobody knows this one</p>"
    rows = [(i, f"http://h.example/{i}", same) for i in range(7, 0, -1)]
    rows += [(None, f"http://n.example/{i}", other) for i in range(3)] + [(50, "http://h.example/50", "alone"), (51, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = warc.deduplicate(pages.repartition(3), now=datetime(2024, 2, 1, 12, 30)).collect()
    by_id = {r.record_id: r for r in found}
    assert len(by_id) == len(rows) and {r.date for r in found} == {"2024-02-01T12:30:00Z"}
    revisits = [r for r in found if r.record_type == "revisit"]
    assert sorted(Counter(r.refers_to for r in revisits).items(), key=str) == [(1, 6), (None, 2)]
    for r in revisits:
        original = by_id[r.refers_to_record]
        assert original.record_type == "response" and original.payload_digest == r.payload_digest
        assert original.page_id == r.refers_to
    assert all(r.refers_to_record is None for r in found if r.record_type == "response")


def test_revisit_records_say_what_they_repeat():
    first = warc.Original("<urn:uuid:1>", None, "http://h.example/", "2024-01-01T00:00:00Z")
    text = warc.record("9", "http://h.example/9", "body", "D", 4, "2024-02-01T00:00:00Z", "<urn:uuid:2>", first)
    ((_, fields, payload),) = warc.parse((text + warc.END).encode())
    assert payload == b"" and fields["Content-Length"] == "0" and fields["X-Payload-Length"] == "4"
    assert (fields["WARC-Refers-To"], fields["WARC-Refers-To-Target-URI"]) == ("<urn:uuid:1>", "http://h.example/")
    assert fields["WARC-Refers-To-Date"] == "2024-01-01T00:00:00Z" and fields["WARC-Record-ID"] == "<urn:uuid:2>"


def test_archives_of_nothing(spark):
    assert warc.deduplicate(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


ARTICLE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">'
    '<nav><ul><li>Menu</li></ul></nav><header>Site</header><!-- <p>x</p> --><div class="ad">Buy</div><article><header><h1>Head &amp; tail</h1>'
    '</header><p><b>One\n two<br>three<p>Four <i>fi</i>ve</p><div class="comments"><p>Nice!</p></div></article><aside>Side</aside>'
    "<form>Name</form><footer>&copy; us</footer>"
)


def test_article_text():
    assert templates.main_text(ARTICLE, frozenset()) == "Head & tail\n\nOne two three\n\nFour five"
    assert templates.main_text("", frozenset()) == ""
    assert templates.main_text("a < b & c<p>d", frozenset()) == "a < b & c\n\nd"
    assert templates.main_text('<p title="a>b">x', frozenset()) == "x"


def test_the_template_decides_on_marked_pages_too(spark):
    within = "<body><article><div>Read our terms</div><p>Story {0}</p></article></body>"
    beside = "<body><article>Teaser {0}</article><div><p>The long story of number {0}</p><p>goes on and on {0}</p></div></body>"
    rows = [(i, "http://within.example/", within.format(i)) for i in range(6)]
    rows += [(10 + i, "http://beside.example/", beside.format(i)) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in templates.extract(pages).collect()}
    assert texts[3] == "Story 3"
    assert texts[13] == "Teaser 3\n\nThe long story of number 3\n\ngoes on and on 3"


def test_text_shared_by_a_hosts_pages_is_template(spark):
    body = "<body><div>Welcome to this site</div><div>All rights</div><section><p>Story {0}</p><p>More {0}</p></section></body>"
    rows = [(i, f"http://h.example/{i}", body.format(f"number {i}")) for i in range(6)]
    rows += [(10 + i, "http://h.example/copy", body.format("number 0")) for i in range(9)]  # copies count once
    rows += [(30, None, None), (31, "http://other.example/", body.format("alone")), (None, "x", "<p>t")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string")
    texts = {r.page_id: r for r in templates.extract(pages).collect()}
    assert len(texts) == len(rows)
    assert texts[3].text == "Story number 3\n\nMore number 3"
    assert texts[12].text == "Story number 0\n\nMore number 0"
    assert texts[31].text.startswith("Welcome")
    assert (texts[30].text, texts[30].n_chars, texts[None].text) == ("", 0, "t")
    assert templates.extract(pages.limit(0)).count() == 0
