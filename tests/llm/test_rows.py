"""Operators that look at one text, page or conversation at a time."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from alluvia.llm import chat, html, licenses, quality, tokens, words
from alluvia.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.mark.parametrize("name", ["op1_quality_rules", "op2_chat_format", "op6_source_mixing"])
def test_against_sql(llm, small, name):
    assert differences(QUERIES[name](llm, small), connect(small), ORACLES[name]) == []


# -- quality -----------------------------------------------------------------------------------


def measured_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures_of_odd_texts(odd):
    rows = quality.ledger(odd.filter("length(text) < 1000 OR text IS NULL"), keep=["text"]).collect()
    for r in rows:
        x = r.ledger
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == measured_by_hand(r.text)
    whole = quality.ledger(odd)
    assert whole.columns == [*odd.columns, "ledger"] and whole.count() == odd.count()


def test_random_texts(llm):
    random.seed(3)
    texts = ["".join(random.choice("ab \n\t%") for _ in range(random.randint(0, 120))) for _ in range(60)]
    rows = quality.ledger(llm.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert all((r.ledger.n_words, r.ledger.word_chars, r.ledger.n_symbols, r.ledger.n_dup_lines, r.ledger.n_repeat_words)
               == measured_by_hand(r.text) for r in rows)


def test_texts_built_to_collide():
    """Thue-Morse strings: two that differ everywhere collide in every polynomial hash modulo a power of two."""
    for size in (8, 64, 1024, 65_536):
        one = "".join("ab"[bin(n).count("1") % 2] for n in range(size))
        other = one.translate(str.maketrans("ab", "ba"))
        for text in (f"{one}\n{other}", f"{one} {other}"):
            measures = dict(zip(quality.MEASURES, quality.measure([text]), strict=True))
            assert measures["n_dup_lines"][0] == 0 and all(measures[m][0] == 0 for m in measures if "stutter" in m)
        assert dict(zip(quality.MEASURES, quality.measure([f"{one}\n{other}\n{one}"]), strict=True))["n_dup_lines"][0] == 1


def test_span_hashes_tell_spans_apart():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 3, 4000).astype(np.uint8)
    starts = rng.integers(0, 3990, 3000)
    ends = np.minimum(starts + rng.choice([0, 1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 513, 600], 3000), 4000)
    hashes = words.span_hashes(data, starts, ends)
    by_text = {}
    for a, b, h in zip(starts, ends, hashes.tolist()):
        assert by_text.setdefault(data[a:b].tobytes(), h) == h
    assert len(set(by_text.values())) == len(by_text)
    assert len(words.span_hashes(data, starts[:0], ends[:0])) == 0


def test_policies_and_ablations(llm):
    rows = llm.createDataFrame([(0,), (1,), (3,), (4,), (4,)], "fail_bits bigint").select(F.struct("fail_bits").alias("ledger"))
    policy = quality.Policy("t", ("few_words", "repeated_windows"))
    assert policy.mask() == 3
    assert [r[0] for r in rows.select(quality.passes(F.col("ledger.fail_bits"), policy)).collect()] == [True, False, False, True, True]
    got = {r.rule: (r.rows, r.rejected, r.fails, r.only, r.policy) for r in quality.ablations(rows, policy).collect()}
    assert got == {"few_words": (5, 2, 2, 1, "t"), "repeated_windows": (5, 2, 1, 0, "t")}


def test_good_labels_are_kept(llm, small):
    kept = QUERIES["op1_quality_rules"](llm, small).join(llm.read.parquet(f"{small}/labels.parquet"), "doc_id")
    assert kept.filter("quality = 1 AND NOT kept AND NOT base_failed").count() == 0
    assert kept.filter("quality = 0 AND kept").count() <= 1


# -- chat --------------------------------------------------------------------------------------


def test_turns_come_back(llm):
    turns = [
        (1, 0, "user", "a<|b"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>assistant\nno"), (1, 2, "assistant", "<|im_next|>||"),
        (1, 3, "us\ner<|", ""), (2, 5, None, None), (2, 5, "assistant", "é<"), (2, 6, "assistant", "|<|"), (None, 1, "system", "x"),
        (3, 0, "user", "same"), (3, 0, "user", "same"),
    ]
    made = chat.format_conversations(llm.createDataFrame(turns, "conv_id int, turn int, role string, text string"))
    rows = {r.conv_id: r for r in made.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                                             chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    for conv in (1, 2, 3, None):
        own = sorted((t, r or "", x or "") for c, t, r, x in turns if c == conv)
        assert [(t.role, t.text) for t in rows[conv].turns] == [(r, x) for _, r, x in own]
        assert rows[conv].loss == "".join(x for _, r, x in own if r == "assistant")
    assert rows[1].formatted.count("<|im_start|>") == 3  # neighbours of one role share a block
    assert made.limit(0).count() == 0


def test_probe_conversation(llm, small):
    row = QUERIES["op2_chat_format"](llm, small).filter("conv_id = -1").first()
    said = chat.PROBE
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and row.n_turns == 2
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


# -- tokens ------------------------------------------------------------------------------------


def test_counts_equal_the_library(llm, odd, small):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    random.seed(1)
    made = ["".join(random.choice("ab e\n<>é日/=-_▁ \t1290thin") for _ in range(random.randint(1, 300))) for _ in range(200)]
    made += [" " * 40 + "x" + " " * 33, "ab" * 300, "a" * 500, "<s>hello</s>", "\r\n\t "]
    texts = odd.filter("length(text) < 1000 OR text IS NULL").select("text").union(
        llm.read.parquet(f"{small}/documents.parquet").select("text")).union(llm.createDataFrame([(t,) for t in made], "text string"))
    for r in tokens.count_tokens(texts).collect():
        assert (r.tokens.n_tokens, r.tokens.n_bytes) == (len(library.encode(r.text or "")), len((r.text or "").encode()))


def test_long_texts_without_spaces():
    import public_tokenizers
    import sentencepiece

    file = public_tokenizers.path("piece_bpe_32k.model")
    library, vocabulary = sentencepiece.SentencePieceProcessor(model_file=file), tokens.Vocabulary(file)
    rng = random.Random(7)

    def counted(text):
        return int(vocabulary.count(vocabulary.cut(tokens.SPACE + text.replace(" ", tokens.SPACE))).sum())

    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "ab", "etaoins", "日本語の文章", "<>=/-_.0", "aAbB日é", "lo"):
        for size in (65, 150, 700):
            text = "".join(rng.choice(alphabet) for _ in range(size))
            assert counted(text) == len(library.encode(text)), text
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    began = time.time()
    assert counted(text) == len(library.encode(text)) and time.time() - began < 3


# -- pages -------------------------------------------------------------------------------------

PAGE = """<html><head><title>no</title><style>p{}</style></head><body><header><a href=/>Home</a></header><nav><ul><li>menu</li></ul></nav>
<div class="cookie-notice">We use cookies.</div><aside class=sidebar><p>Related things that are long enough to look like text of the page</p></aside>
<form><p>Subscribe to our letter</p><input></form><%s><h1>The &amp; title</h1><p>First  paragraph with <b>bold</b>ness &eacute;
and more text that goes on for a while<br>after the break.<p>Second one, not closed, also of a good length so that it is dense.
<div class="ad-slot">Buy now!</div><ul><li>Short item</ul><p>.</p><section id="comments"><p>Reader comment that is rather long, as comments
are</p></section></%s><script>var x = "<p>no</p>";</script><footer><p>&copy; 2024</p></footer></body></html>"""
ARTICLE = ("The & title First paragraph with boldness é and more text that goes on for a while after the break. "
           "Second one, not closed, also of a good length so that it is dense. Short item .")


@pytest.mark.parametrize("element", ["article", "main", 'div class="content"'])
def test_article_of_a_page(element):
    assert html.main_text(PAGE % (element, element.split()[0])) == ARTICLE


LONG = "This is a long paragraph of the story with many words in it and hardly a tag, so that it is dense enough to be found"


@pytest.mark.parametrize(("body", "wanted"), [
    (f"<main><p>{LONG} 1<p>{LONG} 2<article class=related><p>{LONG} card</article><p>End.</main>", f"{LONG} 1 {LONG} 2 End."),
    (f"<main><p>{LONG} 1<article><p>{LONG} 2</article><p>End.</main>", f"{LONG} 1 {LONG} 2 End."),
    (f"<article><p>{LONG} 1<article class=comment><p>{LONG} reader</article></article>", f"{LONG} 1"),
    (f"<article hidden><p>{LONG} old</article><main><p>{LONG} new</main>", f"{LONG} new"),
    (f"<article><p>{LONG} 1</article><article><p>Short.</article>", f"{LONG} 1 Short."),
    (f"<p>{LONG} 1<p>{LONG} 2<p><a href=/>all of it a link</a><p>{LONG} 3<p>Short.<p>End.", f"{LONG} 1 {LONG} 2 all of it a link {LONG} 3 Short. End."),
    (f"<div><p>Short.<p>{LONG} 1<p>End.</div>", f"Short. {LONG} 1 End."),
])
def test_whole_regions(body, wanted):
    assert html.main_text(f"<html><body><nav><a>x</a></nav>{body}</body></html>") == wanted


@pytest.mark.parametrize("element", [
    'main class="content has-sidebar"', 'div class="content with-sidebar"', 'article class="post comments-open"',
    'div id="page" class="site menu-closed"', 'div class="sidebar-layout"', 'section class="no-ads nav-off"'])
def test_names_of_states_and_layouts(element):
    tag = element.split()[0]
    body = f"<{element}><p>{LONG} 1<p>{LONG} 2<div class='ad-slot'>Buy now</div></{tag}><div class='left-sidebar'><p>{LONG} beside</div>"
    assert html.main_text(f"<html><body><nav><a>x</a></nav>{body}</body></html>") == f"{LONG} 1 {LONG} 2"


@pytest.mark.parametrize(("body", "wanted"), [
    (f"<div class='widget'><article><p>{LONG} 1<p>{LONG} 2</article></div><p>{LONG} out", f"{LONG} 1 {LONG} 2"),
    (f"<div class='search'><p>{LONG} 1<p>{LONG} 2<div class=promo>Buy</div></div><form>Out.</form>", f"{LONG} 1 {LONG} 2"),
    (f"<article><p>{LONG} 1</article><div class=comments><p>{LONG} a<p>{LONG} b<p>{LONG} c</div>", f"{LONG} 1"),
    (f"<div><p>{LONG} 1<p>More.</div><div class=comments><p>{LONG} a<p>{LONG} b<p>{LONG} c</div>", f"{LONG} 1 More."),
])
def test_a_name_is_not_believed_of_the_whole_article(body, wanted):
    assert html.main_text(f"<html><body>{body}</body></html>") == wanted


def test_deep_pages_take_linear_time():
    for opened in ("<div>" * 50_000, "<section><p>" * 25_000, "<b>" * 50_000 + "</i>" * 50_000, "<ul><li>" * 25_000):
        began = time.time()
        assert html.main_text(f"<body>{opened}{LONG}") == LONG
        assert time.time() - began < 3


def test_generated_pages_with_known_articles():
    """Pages put together from parts that are known to be content or not, in all orders."""
    rng = random.Random(12)
    for _ in range(150):
        said = [f"{LONG} {n}" if rng.random() < 0.7 else f"Short {n}." for n in range(rng.randint(2, 7))]
        said[rng.randrange(len(said))] = f"{LONG} certain"
        inner = "".join(rng.choice([f"<p>{t}</p>", f"<p>{t}", f"<div>{t}</div>", f"<ul><li>{t}</ul>", f"<h2>{t}</h2>"])
                        + rng.choice(["", "<div class='ad-slot'>Buy</div>", "<script>x</script>", "<aside>Aside</aside>"]) for t in said)
        tag, names = rng.choice([("article", ""), ("main", " class='has-sidebar'"), ("div", " class='content comments-closed'"), ("div", "")])
        around = [rng.choice(["", "<nav><a>Menu</a></nav>", "<header>Head</header>", "<div class=sidebar><p>Beside</div>", "<form>Form</form>"]),
                  rng.choice(["", "<footer>Foot</footer>", f"<section id=comments><p>{LONG} reader</section>", "<div class='cookie-notice'>Cookies</div>"])]
        assert html.main_text(f"<html><body>{around[0]}<{tag}{names}>{inner}</{tag}>{around[1]}</body></html>") == " ".join(said)


def test_odd_pages(llm):
    assert [html.main_text(x) for x in (None, "", "<p>", "<nav>only</nav>", "plain text")] == ["", "", "", "", "plain text"]
    rows = llm.createDataFrame([(None, 1), ("<p>a</p>", 2), ("<p>a</p>", 2)], "html string, content int")
    assert html.extract(rows, into="made").count() == 3
    long = "<article>" + "<p>text of a paragraph</p>" * 20_000 + "</article>"
    assert len(html.main_text(long)) == 20_000 * 20 - 1


def test_pages_of_the_table(llm, small):
    from html import unescape

    pages = {r.page_id: r.html for r in llm.read.parquet(f"{small}/pages.parquet").collect()}
    for r in QUERIES["op5_html_extraction"](llm, small).collect():
        body = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        said = re.sub("<[^>]+>", "", re.sub("</?(?:p|h1|br)>", " ", body))
        assert r.text == " ".join(unescape(said).split()) and r.n_chars == len(r.text)


# -- licenses ----------------------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def licensed_by_hand(text):
    low = (text or "").translate(LOWER)
    words = PLAIN.findall(low)
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        found = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += found
        base |= {label} if found else set()
    flat = " " + " ".join(words) + " "
    met = []
    if any(t in flat for t in licenses.TRIGGERS):
        met = [(m.start(), m.end(), s.order, s.label) for s in licenses.signatures() if f" {s.keyword} " in flat for m in re.finditer(s.pattern, low)]
    inside = lambda d, e: e[0] <= d[0] and e[1] >= d[1] and (e[2] < d[2] or e[2] == d[2] and e[1] - e[0] > d[1] - d[0])
    labels = base | {d[3] for d in met if not any(inside(d, e) for e in met)}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)))


def test_licenses_by_hand(llm, odd, small):
    lines = [
        "GNU General Public License, version 3 and the Apache\nLicense", "CC BY-NC 4.0 cc, by CC-BY", "MIT License MIT License", "mit licenses",
        "SPDX-License-Identifier: GPL-2.0-or-later", "under the terms of the GNU Lesser General Public License v2.1", "emit license",
        "See https://creativecommons.org/licenses/by-sa/4.0 or BSD 3-Clause", "the MIT", "cc by", "apache license", "License: Zlib license.",
    ]
    texts = odd.filter("length(text) < 1000 OR text IS NULL").select("text").union(llm.createDataFrame([(x,) for x in lines], "text string")).union(
        llm.read.parquet(f"{small}/documents.parquet").select("text"))
    for r in licenses.scan(texts).collect():
        x = r.license
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.labels) == licensed_by_hand(r.text), r.text
        assert 0 <= x.score <= 1
    assert len(licenses.signatures()) > 300


def test_gates_lose_no_match(llm):
    """Against all rules without any gate."""
    wanted = {
        "see https://creativecommons.org/licenses/by-sa/4.0/": "cc-by-sa-4.0", "https://creativecommons.org/licenses/by-nc/3.0": "cc-by-nc-3.0",
        "https://creativecommons.org/publicdomain/zero/1.0/": "cc0-1.0", "AGPL 3.0": "agpl-3.0", "an Expat License": "mit", "PSF License": "psf",
        "Berkeley Software Distribution License": "bsd", "MIT No Attribution": "mit-0", "http://scripts.sil.org/OFL": "ofl",
        "https://www.latex-project.org/lppl/": "lppl", "GPLv3": "gpl-3.0", "GPLv2": "gpl-2.0", "AGPLv3": "agpl-3.0", "LGPLv2.1": "lgpl-2.1",
        "MPL2.0": "mpl-2.0", "GPLv9": "gpl", "CC—BY": "cc-by", "https://opendatacommons.org/licenses/pddl/1-0/": "pddl",
    }
    for _, _, names, _, url in licenses.FAMILIES:
        for said in (*names, *([url] if url else [])):
            wanted.setdefault(said.upper(), None)
    inside = lambda d, e: e[0] <= d[0] and e[1] >= d[1] and (e[2] < d[2] or e[2] == d[2] and e[1] - e[0] > d[1] - d[0])
    rules = licenses.signatures()
    for r in licenses.scan(llm.createDataFrame([(x,) for x in wanted], "text string")).collect():
        low = r.text.translate(LOWER)
        met = [(m.start(), m.end(), s.order, s.label) for s in rules for m in re.finditer(s.pattern, low)]
        labels = set(r.license.base_labels.split(",")) - {""} | {d[3] for d in met if not any(inside(d, e) for e in met)}
        assert met and r.license.labels == ",".join(sorted(labels)), r.text
        assert wanted[r.text] in (None, *r.license.labels.split(",")), r.text


def test_scan_keeps_rows_and_names(odd, nothing):
    assert licenses.scan(odd, into="found").columns == [*odd.columns, "found"]
    assert licenses.scan(odd, into="found").count() == odd.count()
    assert licenses.scan(nothing, into="found").count() == tokens.count_tokens(nothing).count() == quality.ledger(nothing).count() == 0
