"""Language, quality, decontamination, chat and HTML operators."""

import time
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.llm import chat, decontaminate, html_extract, language, quality

SF, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
JSON = public.path("byte_bpe_50k.json")


# ---- language


def test_held_out_accuracy_of_language(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    rows = language.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_cases(spark, edge_docs, no_docs):
    rows = language.language_report(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    unknown = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert {0, 1, 2, 3} <= unknown and all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert language.language_report(no_docs).count() == 0
    kept = language.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns and kept.where("text IS NULL").count() == 0
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.language_report(unlabelled).collect()} == {"und"}


def test_new_words_fall_back_to_shorter_grams():
    model = language.Model(("a", "b"), {"known": (1.0, -1.0)}, ((3, {"abc": (0.5, 0.0), "bcd": (0.0, 0.5)}), (1, {"z": (-2.0, 2.0)})))
    assert model.word_scores("known") == (1.0, -1.0)
    assert model.word_scores("xabcd") == (0.25, 0.25)
    assert model.word_scores("zz") == (-2.0, 2.0)
    assert model.word_scores("qq") == (0.0, 0.0)
    assert language.Scorer(model, remembered=1).predict("known zz zz")[0] == "b"


# ---- quality


def test_long_runs_are_read_whole():
    grams = tuple((n, {"ab": (1.0, -1.0), "ba": (1.0, -1.0), "xx": (-1.0, 1.0)} if n == 2 else {}) for n in language.LENGTHS)
    model = language.Model(("a", "x"), {}, grams)
    assert language.Scorer(model).predict("x" * 40 + "ab" * 500 + "x" * 40)[0] == "a"
    seam = "a" + "q" * 40 + "r" * 40 + "b"
    glued = language.Model(("a", "x"), {}, ((2, {"qr": (1.0, -1.0), "rr": (-1.0, 1.0)}),))
    assert glued.word_scores(seam) == ((1.0 - 39) / 40, (-1.0 + 39) / 40)


def test_long_runs_teach(spark):
    rows = [(i, "漢字仮名" * 40 if i % 2 else "ไทยภาษา" * 40, "ja" if i % 2 else "th") for i in range(40)]
    model = language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert language.Scorer(model).predict("仮名漢字" * 100)[0] == "ja"
    assert language.Scorer(model).predict("ภาษาไทย" * 100)[0] == "th"


def test_held_out_accuracy_of_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.quality_report(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels)
    rows = [r for r in rows.join(labels, "doc_id").collect() if r["held_out"]]
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    poor = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > poor).mean() + (good[:, None] == poor).mean() / 2 > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97


def test_quality_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (6, 0), (7, None), (99, 1), (None, 0), (10, 1), (11, 0), (8, 1), (9, 0)], "doc_id bigint, quality int")
    rows = quality.quality_report(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert quality.quality_report(no_docs, labels).count() == 0
    empty = labels.limit(0)
    assert {r["score"] for r in quality.quality_report(edge_docs, empty).select(F.round("score", 2).alias("score")).collect()} == {0.5}
    assert quality.keep_quality(edge_docs, labels).columns == edge_docs.columns
    assert all(np.isfinite(quality.statistics(r["text"])).all() for r in edge_docs.collect())


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 9)), min_size=1, max_size=30))
def test_rising_is_monotone_and_keeps_the_mean(pairs):
    values, weights = (np.array(x, dtype=float) for x in zip(*pairs))
    fitted = quality.rising(values, weights)
    assert (np.diff(fitted) >= -1e-12).all() and np.isclose((fitted * weights).sum(), (values * weights).sum())


# ---- decontamination


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in low).split(" ")


def brute_passages(text, items, size=13):
    words = [w for w in plain_words(text) if w]
    hit, names = set(), set()
    for item, passage in items:
        other = [w for w in plain_words(passage) if w]
        span = min(size, len(other))
        for i in range(len(other) - span + 1 if other else 0):
            for j in range(len(words) - span + 1):
                if words[j : j + span] == other[i : i + span]:
                    hit.update(range(j, j + span))
                    names.add(item)
    return len(words), sorted(hit), sorted(names, key=lambda n: (n is not None, n))


passages = st.text(alphabet="ab .É9", max_size=30)


@settings(max_examples=100, deadline=None)
@given(text=passages, items=st.lists(passages, max_size=4), size=st.integers(1, 4))
def test_passages_against_all_places(text, items, size):
    named = [(str(i), item) for i, item in enumerate(items)]
    words, hits, names, spans = decontaminate.Finder(named, size).find(text, spans=True)
    assert (words, hits, names) == brute_passages(text, named, size)
    assert {s["item_id"] for s in spans} == set(names)
    for s in spans:
        assert [w for w in plain_words(text[s["start"] : s["end"]]) if w] and text[s["start"] : s["end"]].strip(" .") == text[s["start"] : s["end"]]


def test_large_benchmark_is_scanned_in_parts(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    one = decontaminate.find_passages(documents, items, spans=True)
    many = decontaminate.find_passages(documents, items, spans=True, part_chars=2000)
    key = lambda df: sorted(map(repr, df.select("doc_id", "found").collect()))
    assert key(one) == key(many)


def test_long_items_are_cut_into_pieces(spark, monkeypatch):
    draws = np.random.default_rng(7)
    words = [f"w{i}" for i in draws.integers(0, 30, 400)]
    items = [("long", " ".join(words)), ("long", " ".join(words)), ("few", "w1 W2"), ("none", "?!"), (None, " ".join(words[:4]))]
    texts = [" ".join(words[i : i + 9]) + " x " + " ".join(words[i + 20 : i + 22]) for i in range(0, 380, 7)] + ["", None, "w1 w2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 10)
    table = spark.createDataFrame(items, "item_id string, text string")
    for part_chars in (1 << 20, 200):
        found = decontaminate.find_passages(docs, table, 3, spans=False, part_chars=part_chars).collect()
        for r in found:
            words_, hits, names = brute_passages(r["text"], items, 3)
            assert (r["found"]["n_words"], r["found"]["hits"]) == (words_, hits)
            assert r["found"]["items"] == sorted(n for n in names if n is not None)
    with pytest.raises(ValueError, match="found"):
        decontaminate.find_passages(docs.withColumn("FOUND", F.lit(1)), table)


def test_decontamination_edge_cases(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "the SAME text"), (1, "text, twice!"), (None, "words many"), (2, None), (3, ""), (4, "?!")], "item_id bigint, text string")
    rows = decontaminate.contamination_report(edge_docs, items).collect()
    assert len(rows) == edge_docs.count()
    for r in (r for r in rows if r["doc_id"] in (5, 6)):
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (4, 4, 1, True)
        assert r["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    assert all((r["n_words"], r["n_hit"], r["contaminated"]) == (0, 0, False) for r in rows if r["doc_id"] in (0, 1, 2, 3))
    assert next(r["n_hit"] for r in rows if r["doc_id"] == 11) == 9998
    kept = decontaminate.drop_contaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.where("doc_id IN (5, 6, 11)").count() == 0 and kept.where("text IS NULL").count() == 1
    assert decontaminate.contamination_report(no_docs, items).count() == 0
    none = decontaminate.contamination_report(edge_docs, items.limit(0))
    assert none.where("n_hit > 0 OR contaminated").count() == 0 and none.where("n_words > 0").count() > 0


# ---- chat


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\<>/turnsay#! As:", max_size=40))
def test_escaping_is_reversible_and_breaks_controls(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(control in chat.escape(text) for control in (*chat.CONTROLS, *chat.FOREIGN))


@pytest.mark.parametrize("text", ["\\### Assistant: </turn> ok", "</turn>", "<|endoftext|>", "<turn><says>", "", "é漢🎉"])
def test_turns_read_back(text):
    made = chat.assembler(JSON)
    for role in ("assistant", "user", "", "</turn>"):
        ids, mask = next(made.turns([role], [text], "assistant"))
        assert made.read(ids, mask) == (role, text, text if role == "assistant" else "")
        assert sum(int(i) in made.reserved for i in ids) == 3
        assert made.formatted(ids) == f"<turn>{chat.escape(role)}<says>{chat.escape(text)}</turn>"


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a\n"), (2, None, None, None), (None, 0, "assistant", "x" * 5000)]
    rows += [(3, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(9000)]
    frame = spark.createDataFrame([(*r, 0, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, token_start int, ids string")
    turns = chat.format_turns(frame, JSON).orderBy("conv_id", "token_start").collect()
    place = {}
    for t in turns:
        assert t["token_start"] == place.get(t["conv_id"], 0)
        place[t["conv_id"]] = t["token_start"] + len(t["ids"])
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_turns(frame, JSON), JSON).collect()}
    for conv in (1, 2, 3, None):
        mine = sorted(((t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c == conv)
        said = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        learned = "".join(x for _, r, x in mine if r == "assistant")
        assert got[conv]["n_turns"] == len(mine) and got[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(learned) and got[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    assert chat.conversation_digests(chat.format_turns(frame.limit(0), JSON), JSON).count() == 0


# ---- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1><nav><a href="/">Home</a></nav></header><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><div id="ad-7">Buy</div>
<div class="wrap page-12"><{tag} class="story s{n}"><h1>Title &amp; more</h1><p>One <b>bold</b>&nbsp; two&hellip;<p>Three<br>four 5 &lt; 6</p>
<ul><li>a</li><li>b</ul><table><tr><td>x</td><td>y</td></tr></table><form><p>Send</p></form><aside>Side</aside>
<div class="comments"><p>First! A long comment that is longer than many of the paragraphs of the story.</p></div></{tag}></div>
<div class="sidebar"><p>More</p></div><footer>&copy; us</footer></body></html>"""
TEXT = "Title & more\n\nOne bold two…\n\nThree four 5 < 6\n\na\n\nb\n\nx y"


def test_page_text():
    for tag in ("article", "div", "main", "section"):
        assert html_extract.main_text(PAGE.replace("{tag}", tag).replace("{n}", "3")) == TEXT


@pytest.mark.parametrize("source, text", [(None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\n\nb"), ("a < b > c <d", "a < b > c <d"), ("<b>x", "x"), ("<div><!-- x", "")])
def test_broken_pages(source, text):
    assert html_extract.main_text(source) == text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/ap div=\"'!-&; \n", max_size=80))
def test_any_markup_is_read(source):
    html_extract.main_text(source)


@pytest.mark.parametrize("quote", ["\"", "'"])
@pytest.mark.parametrize("size", [10, 8_000, 9_000, 1_000_000])
def test_values_of_any_length_end_at_their_quote(quote, size):
    value = "{x: 1} > " + "v" * size + "> leaked <p>words"
    source = f"<article data-state={quote}{value}{quote} class='s'><p title = {quote}{value}{quote}>Read this</p></article>"
    assert html_extract.main_text(source) == "Read this"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a>b", "<p>", "=", "/", "it", "&quot;", " ", "'"]), max_size=30), st.integers(1, 400))
def test_any_quoted_value_is_no_text(parts, times):
    assert html_extract.main_text(f'<div id="{"".join(parts) * times}"><p>Read this</p></div>') == "Read this"


@pytest.mark.parametrize("source", ["<div>" * 4_000 + "text" + "</span>" * 40_000, "<a x=\"" * 20_000 + ">", "<a b='\">" * 20_000, "<p class=\"a'\" x'>t" * 5_000])
def test_time_grows_with_the_page(source):
    start = time.process_time()
    html_extract.main_text(source)
    assert time.process_time() - start < 5


def test_a_stray_quote_opens_nothing():
    assert html_extract.main_text('<p class="x"">one</p><p>it"s</p>') == 'one\n\nit"s'


LONG = "A sentence of the story. " * 60
SHORT = "A short part of it. " * 10


@pytest.mark.parametrize("outer", ["article", "main", "div class='story'", "body"])
def test_the_whole_article_is_taken(outer):
    def read(inner):
        page = f"<nav><a href='/'>Home</a></nav><{outer}>{inner}</{outer.split()[0]}><footer>us</footer>"
        return html_extract.main_text(page).split("\n\n")

    assert read(f"<h1>Title</h1><p>{SHORT}</p><div class='body'><p>{LONG}</p></div>") == ["Title", SHORT.strip(), LONG.strip()]
    assert read(f"<section><p>{LONG}</p></section><section><p>{SHORT}</p></section>") == [LONG.strip(), SHORT.strip()]
    rows = f"<table><tr><td><p>{LONG}</p></td><td><a href='/x'>{SHORT}</a></td></tr></table>"
    if outer.startswith(("div", "body")):
        assert read(rows) == [LONG.strip()]


@pytest.mark.parametrize("start", ["<div class='elementor-widget'>", "<div class='related-article'>", "<form action='/p.aspx'>", "<div id='search-page'>", "<form><div class='overlay'>"])
@pytest.mark.parametrize("article", ["article", "div", "section class='share'"])
def test_the_article_in_a_dropped_element(start, article):
    end = "".join(f"</{tag}>" for tag in reversed(re.findall("<([a-z]+)", start)))
    menu, side = "<nav><a href='/'>Home</a></nav>", f"<div class='sidebar'><p>{SHORT}</p></div>"
    talk = f"<div class='comments'><p>{LONG * 3}</p></div>"
    story = f"<{article}><h1>Title</h1><p>{LONG}</p></{article.split()[0]}>"
    for page in (menu + start + story + end + side + talk, start + menu + story + side + talk + end):
        assert html_extract.main_text(page) == f"Title\n\n{LONG.strip()}"
    assert html_extract.main_text(f"<article><h1>Title</h1>{start}<p>{LONG}</p>{end}{talk}</article>") == f"Title\n\n{LONG.strip()}"


def test_furniture_stays_out():
    rest = "".join(f"<div class='{name}'><p>{SHORT}</p></div>" for name in ("widget", "related-article", "share", "sidebar", "cookie-notice"))
    cards = f"<div class='related'><article><p>{SHORT}</p></article></div>"
    assert html_extract.main_text(f"<article><p>{LONG}</p>{rest}</article>{rest}{cards}<footer>{SHORT}</footer>") == LONG.strip()
    assert html_extract.main_text(f"<div class='comments'><article><p>{LONG}</p></article></div><article><p>{SHORT}</p></article>") == SHORT.strip()


def test_the_body_is_not_the_article():
    page = f"<div class='a'><div class='b'><p>{LONG}</p></div></div><div class='c'><p>{SHORT}</p></div>Imprint"
    assert html_extract.main_text(page) == LONG.strip()


def test_hosts_vote(spark):
    good = PAGE.replace("{tag}", "div")
    rows = [(i, "http://Host.example/a", good.replace("{n}", str(i)), "x") for i in range(5)]
    # its own best container would be the longer box beside the story
    odd = good.replace("{n}", "9").replace("</body>", "<div class='box'><p>" + "filler " * 200 + "</p></div></body>")
    rows += [(9, "http://host.example/b", odd, "x"), (10, None, good, "x"), (11, "http://other/", None, "x"), (12, "nonsense", "", "x"), (None, "http://host.example/a", good, "x")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, path string")
    paths = {r["host"]: r["paths"] for r in html_extract.host_paths(frame).collect()}
    assert paths["host.example"][0] == "div.page-#.wrap>div.s#.story"
    out = html_extract.extract_main_text(frame)
    assert out.columns == [*frame.columns, "text"]
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert got == {**{i: TEXT for i in (0, 1, 2, 3, 4, 9, 10, None)}, 11: "", 12: ""}
    assert html_extract.extract_main_text(frame.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [html_extract.BROADCAST_CHARS, 0])
def test_every_path_of_a_host_counts(spark, monkeypatch, limit):
    monkeypatch.setattr(html_extract, "BROADCAST_CHARS", limit)
    kinds = "abcdefghijkl"
    page = "<body><div class='{0}'><p>Story {0}.</p></div>{1}</body>"
    rows = [(100 * k + i, "http://host/x", page.format(c, "")) for k, c in enumerate(kinds) for i in range(14 - k)]
    box = "<div class='box'><p>" + "filler " * 200 + "</p></div>"
    rows += [(5000 + k, "http://host/y", page.format(c, box)) for k, c in enumerate(kinds)] + [(6000, "http://host/x", None), (6001, None, page.format("a", ""))]
    # each template has more votes than the box
    rows += [(7000 + 100 * k + i, "http://host/x", page.format(c, "")) for k, c in enumerate(kinds) for i in range(14)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = html_extract.extract_main_text(frame)
    assert out.columns == [*frame.columns, "text"]
    got = {r["page_id"]: r["text"] for r in out.collect()}
    want = {i: f"Story {h.split(chr(39))[1]}." if h else "" for i, _, h in rows}
    assert got == want
