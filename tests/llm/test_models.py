"""Language profiles, the toxicity model and main text: accuracy on held-out rows, and odd input."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest

from candlewick.llm import crf, html_extraction, html_region, language_id, registry, toxicity
from candlewick.llm.common import table

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    step = np.exp(rng.normal(size=(2, 2)))
    lengths = np.array([1, 4, 6])
    odds = np.exp(rng.normal(size=(6, 3)))
    got = crf.marginals(odds, lengths, step)
    for j, n in enumerate(lengths):
        weight = np.zeros(n)
        total = 0.0
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.prod([odds[t, j] if y else 1.0 for t, y in enumerate(path)])
            w *= np.prod([step[a, b] for a, b in zip(path, path[1:])])
            total += w
            weight += w * np.array(path)
        assert np.allclose(got[:n, j], weight / total)


def test_plain_sequences_take_the_short_way():
    m = crf.Model({"bad": 5.0}, -2.0, np.array([[2.0, 0.5], [0.4, 1.5]]))
    words = ["good"] * 25
    whole = crf.marginals(np.full((25, 1), np.exp(-2.0)), np.array([25]), m.step)[:, 0]
    assert np.allclose(m.tag([words])[0], whole)
    assert m.tag([[], ["bad"]])[1][0] > 0.9


def test_toxic_words_are_found_with_their_places():
    rng = random.Random(1)
    clean = ["".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(300)]
    texts, labels = [], []
    for i in range(600):
        w = [rng.choice(clean) for _ in range(rng.randrange(20, 60))]
        if i % 4 == 0:
            w[rng.randrange(len(w))] = rng.choice(["Nasty", "gruel", "nastyish"])
        texts.append(" ".join(w))
        labels.append(int(i % 4 == 0))
    m = crf.fit(texts[:400], labels[:400])
    for text, y in zip(texts[400:], labels[400:]):
        score, spans = toxicity.document_score(m.tag([crf.words(text)])[0], m)
        assert (score >= 0.7) == bool(y)
        if y:
            assert any(crf.words(text)[a][:4] in ("nast", "grue") for a, _, _ in spans)


def test_toxicity_on_held_out_labels(spark):
    got = {r["doc_id"]: r for r in registry.op7_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    held = [(got[i]["predicted"], y) for i, y in labels.items() if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    hits = sum(p and y for p, y in held)
    assert hits / max(1, sum(p for p, _ in held)) > 0.95 and hits / sum(y for _, y in held) > 0.9
    lang = {r["doc_id"]: r["lang"] for r in table(spark, "/root/testdata/sf0.1", "documents").collect()}
    for x in sorted(set(lang.values())):  # no language is left out
        of_x = [(got[i]["predicted"], y) for i, y in labels.items() if zlib.crc32(str(i).encode()) % 3 == 1 and lang[i] == x]
        assert sum(p and y for p, y in of_x) / sum(y for _, y in of_x) > 0.85, x
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_score_equals_enumeration():
    """A document's score and spans from the sum over all labelings of its words."""
    m = crf.Model({"bad": 2.0, "ba*": 0.5, "ugly*": 3.0}, -1.5, np.array([[2.0, 0.5], [0.4, 1.5]]), (-1.0, 2.5, -0.3))
    for text in ("bad good ugly", "good good bad badly good ugly uglyish fine", "good", "ugly"):
        w = crf.words(text)
        p, total = np.zeros(len(w)), 0.0
        for path in itertools.product((0, 1), repeat=len(w)):
            odds = [np.exp(m.bias + sum(m.weights.get(f, 0) for f in crf.features(x))) if y else 1.0
                    for x, y in zip(w, path)]
            weight = np.prod(odds) * np.prod([m.step[a, b] for a, b in zip(path, path[1:])])
            total += weight
            p += weight * np.array(path)
        p /= total
        want = 1 / (1 + np.exp(-(m.scale[0] + m.scale[1] * np.log1p(p.sum()) + m.scale[2] * np.log1p(len(w)))))
        score, spans = toxicity.document_score(m.tag([w])[0], m)
        assert np.isclose(score, want)
        hot = "".join("x" if q >= 0.5 else " " for q in p)
        assert [(a, b) for a, b, _ in spans] == [(x.start(), x.end() - 1) for x in re.finditer("x+", hot)]


def test_samples_hold_distinct_texts_of_every_group(spark):
    from candlewick.llm.samples import chosen_keys, level, text_key, texts_of

    assert level([5, 1000, 2000], 605) == 300 and level([1, 2], 100) == 2 and level([], 9) == 1
    rows = [("same text", "x")] * 3000 + [(f"text {i}", "x") for i in range(900)] + [(f"rare {i}", "y") for i in range(5)]
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("key", text_key())
    got = [tuple(r) for r in texts_of(df, chosen_keys(df, ["lang"], most=100), ["lang"]).select("lang", "text").collect()]
    assert len(set(got)) == len(got) and sum(x == "y" for x, _ in got) == 5 and 60 < len(got) < 150


def test_many_languages_can_be_learned(spark):
    docs = spark.createDataFrame([(i, f"word{chr(97 + i % 26)} text", f"l{i}") for i in range(3000)],
                                 "doc_id long, text string, lang string")
    assert len(language_id.learn(docs).languages) == 3000


def test_toxicity_of_odd_rows(spark, make_docs, odd_rows):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(make_docs(odd_rows), none)
    got = toxicity.toxicity(make_docs(odd_rows), model).collect()
    assert len(got) == len(odd_rows) and all(r["score"] < 0.01 for r in got)
    marks = spark.createDataFrame([(1, 1), (2, None), (None, 1), (4, 0), (4, 1)], "doc_id long, toxic int")
    assert toxicity.fit(make_docs(odd_rows), marks) is not None
    assert toxicity.toxicity(make_docs([]), model).count() == 0


def test_language_on_held_out_rows(spark):
    got = registry.op4_language_id(spark, SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in table(spark, SF, "documents").collect()}
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98


def test_grams_and_distance_by_hand():
    text = "Ab, ab!"
    a, b, s = ord("a"), ord("b"), 32
    pack = lambda *c: sum(x << (21 * i) for i, x in enumerate(c))
    want = sorted([pack(a), pack(b)] * 2 + [pack(s, a), pack(a, b), pack(b, s)] * 2 + [pack(s, a, b), pack(a, b, s)] * 2)
    assert sorted(language_id.grams(text).tolist()) == want
    p = language_id.Profiles.of({"x": language_id.profile(["ab ab ab"]), "y": language_id.profile(["zz zz"])})
    assert p.predict("ab") == ("x", 1.0) and p.predict("zz")[0] == "y" and p.predict("12 !") == ("und", 0.0)


def test_language_of_odd_rows(spark, odd_rows):
    rows = [(i, t, "en" if i and i % 2 else None, "x") for i, t in odd_rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = language_id.identify(docs, language_id.learn(docs)).collect()
    assert len(got) == len(rows)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {"und"}
    empty = docs.where("false")
    assert language_id.identify(empty, language_id.learn(empty)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, language_id.learn(empty)).collect()} == {"und"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie-notice">We use cookies, please agree to all of them now.</div>
<article><h1>A title &amp; more</h1><p>First   paragraph with <b>bold</b> text&nbsp;here.<p>Second one, 1 &lt; 2.
<div class="ad">Buy this thing today for little money</div><ul><li>point one<li>point two</ul><br>
<form><input name="q"><button>Send it</button></form><p>Last.</p></article>
<section class="comments"><p>A reader wrote a very long comment about all of this, with many words.</p></section>
<aside>Related stories</aside><footer>&copy; somebody</footer></body></html>"""


def test_main_text():
    want = "A title & more\nFirst paragraph with bold text here.\nSecond one, 1 < 2.\npoint one\npoint two\nLast."
    assert html_region.main_text(PAGE, html_region.Weights()) == want
    plain = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    assert want.startswith(html_region.main_text(plain, html_region.Weights()))  # the run alone decides
    learned = html_region.Weights(tags={t: -0.05 for t in ("p", "/p", "ul", "/ul", "li", "/li", "form", "/form", "div.ad",
                                                           "button", "/button", "/div", "b", "/b", "h1", "/h1")})
    assert html_region.main_text(plain, learned) == want


@pytest.mark.parametrize("page,text", [("", ""), ("<p>", ""), ("just words", "just words"), ("a < b", "a < b"),
                                       ("<article><p>cut off <b>here", "cut off here"), ("<!-- only -->", ""),
                                       ("<script>x</script>", ""), ("<p title='a>b'>ok</p>", "ok")])
def test_main_text_of_odd_pages(page, text):
    assert html_region.main_text(page, html_region.Weights()) == text


LEAD, MORE = "Many words of a long first text " * 6, "and others of the second one " * 4


@pytest.mark.parametrize("wrapper", ['div class="content no-sidebar"', 'div id="page" class="has-sidebar"', "form",
                                     'div class="sidebar"', 'section class="social-studies"', 'p class="share-price"'])
@pytest.mark.parametrize("inner", ["article", "div"])
def test_wrapped_pages_keep_their_text(wrapper, inner):
    page = (f'<body><nav><a>Home</a></nav><{wrapper}><{inner}><p>{LEAD}</p></{inner}></{wrapper.split()[0]}>'
            '<div class="sidebar">Other things</div></body>')
    assert html_region.main_text(page, html_region.Weights()) == LEAD.strip()


def test_asides_with_articles_of_their_own_stay_out():
    page = (f'<body><article><p>{LEAD}</p></article><div class="comments"><article><p>Nice one</p></article></div>'
            '<div class="entry-header"><h1>T</h1></div><form>Your mail</form></body>')
    asides = [t.text for t in html_region.tokens(page)[0] if t.aside and t.words]
    assert asides == ["Nice one", "Your mail"]


def test_region_is_widened_never_cut():
    lead = f"<main><h1>Title</h1><p>{MORE}</p><article><p>{LEAD}</p></article></main>"
    assert html_region.main_text(lead, html_region.Weights()) == f"Title\n{MORE.strip()}\n{LEAD.strip()}"
    two = f"<article><p>{LEAD}</p></article><article><p>{MORE}</p></article>"
    assert html_region.main_text(two, html_region.Weights()) == f"{LEAD.strip()}\n{MORE.strip()}"


def test_region_is_the_maximum_run():
    rng = random.Random(2)
    for _ in range(200):
        page = [html_region.Token("", words=rng.randrange(5)) if rng.random() < 0.5
                else html_region.Token(rng.choice(["p", "div", "i"]), block=rng.random() < 0.5) for _ in range(rng.randrange(12))]
        w = html_region.Weights(tags={"p": -0.7, "div": -3.0})
        a, b = html_region.region(page, w)
        sums = [sum(map(w.score, page[x:y])) for x in range(len(page) + 1) for y in range(x, len(page) + 1)]
        assert abs(sum(map(w.score, page[a:b])) - max(sums)) < 1e-9


def test_pages_of_the_test_data(spark):
    """Paragraphs below the title equal the lines of the document that a page was made of."""
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    import re

    got = registry.op10_html_extraction(spark, SF).collect()
    pairs = [(r["text"], docs[int(m[1])]) for r in got
             if (m := re.search(html_extraction.NUMBER_AT_END, r["url"])) and int(m[1]) in docs]
    assert len(pairs) > 150
    same = [t.split("\n")[1:] == [x for x in (" ".join(x.split()) for x in d.split("\n")) if x] for t, d in pairs]
    assert np.mean(same) > 0.98
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_pages_with_nulls(spark):
    rows = [(1, "http://x/1", None, "t"), (None, None, "<p>text</p>", "t"), (2, "http://x/2", "<p>two</p>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    docs = spark.createDataFrame([(2, "two"), (None, "x"), (3, None)], "doc_id long, text string")
    got = html_extraction.extract(pages, html_extraction.learn(pages, docs)).collect()
    assert {(r["page_id"], r["text"]) for r in got} == {(1, ""), (None, "text"), (2, "two")}
    assert html_extraction.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize("odd", ['<svg viewBox="0 0 1 1"/>', "<svg><path d='x'/><text>label</text></svg>", "<select><option>a",
                                 "<p title=don't>", "<img alt='a>b'>", "<br/>", "<div title=\"it's\"></div>", "<!-->", "<!--->",
                                 "<?xml version='1.0'?>", "</nothing x='>'>", "<textarea><p>no</p></textarea>",
                                 "<script>if (a<b) document.write('</p></scripty>')</script>", "<noscript>enable scripts</noscript>",
                                 "<style>p::after{content:'</div>'}</style>", "<a href=/x/>", "<p class=>"])
def test_odd_markup_keeps_the_text(odd):
    page = f"<body><nav><a>Home</a></nav><article><h1>Head</h1>{odd}<p>{LEAD}</p><p>{MORE}</p></article></body>"
    got = html_region.main_text(page, html_region.Weights()).split("\n")
    assert got[0] == "Head" and got[-2:] == [LEAD.strip(), MORE.strip()]
    assert set(got[1:-2]) <= {"a"}  # the open select's option


def test_names_of_paragraphs_and_headings_are_their_own():
    page = (f'<article><h2 id="comment">On comments</h2><p class="share">{LEAD}</p><div class="share">Tell all</div>'
            f'<p>{MORE}</p></article>')
    assert html_region.main_text(page, html_region.Weights()) == f"On comments\n{LEAD.strip()}\n{MORE.strip()}"


@pytest.mark.parametrize("names", ['class="responses"', 'id="reader-replies"', 'class="comments-list"', 'class="user comments"',
                                   'id="discussion"', 'role="complementary"'])
def test_reader_comments_stay_out(names):
    page = f"<article><h1>Head</h1><p>{LEAD}</p><div {names}><p>{MORE}</p></div></article><section {names}><p>{MORE}</p></section>"
    assert html_region.main_text(page, html_region.Weights()) == f"Head\n{LEAD.strip()}"


def test_names_are_learned():
    """Labelled pages teach that a name is an aside, or that a listed one is not."""
    pages = [(f'<body><div class="zq">{MORE} {i}</div><div><h1>T {i}</h1><div class="social"><p>{LEAD} {i}</p></div>'
              f'<p>{MORE} last</p></div></body>', f"T {i}\n{LEAD} {i}\n{MORE} last") for i in range(30)]
    w = html_region.learn(pages)
    assert w.is_aside("#zq") and not w.is_aside("#social") and w.is_aside("#comments")
    page = f'<div><p>{LEAD}</p><div class="zq">{MORE}</div><div class="social"><p>{LEAD}x</p></div></div>'
    assert html_region.main_text(page, w) == f"{LEAD.strip()}\n{LEAD}x"


def test_long_and_repeated_pages(spark):
    long = "<article>" + "".join(f"<p>{LEAD}{i}</p>" for i in range(3000)) + "</article>"
    nested = "<div>" * 30000 + f"<p>{LEAD}</p>" + "</div>" * 30000 + "</b>" * 30000 + "<nav>" * 9000 + "</nav>" * 9000
    rows = [(1, "u", long, "t"), (1, "u", long, "t"), (2, "u", nested, "t"), (3, "u", "<" * 5000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r["page_id"], r["text"]) for r in html_extraction.extract(pages).collect())
    want = "\n".join(f"{LEAD}{i}" for i in range(3000))
    assert got == [(1, want), (1, want), (2, LEAD.strip()), (3, "<" * 5000)]


def plain_language(text, texts_by_lang):
    """Out-of-place distance, with counters and lists."""
    from collections import Counter

    def grams(t):
        out = []
        for word in "".join(c if c.isalpha() else " " for c in t.lower()).split():
            padded = f" {word} "
            out += list(word) + [padded[i:i + 2] for i in range(len(padded) - 1)]
            out += [padded[i:i + 3] for i in range(len(padded) - 2)]
        return Counter(out)

    order = lambda g: sum(ord(c) << (21 * i) for i, c in enumerate(g))  # noqa: E731  ties: the packed code
    top = lambda n, most: sorted(n, key=lambda g: (-n[g], order(g)))[:most]
    own = top(grams(text), language_id.DOCUMENT)
    if not own:
        return "und", 0.0
    best = None
    for lang in sorted(texts_by_lang):
        place = {g: i for i, g in enumerate(top(sum(map(grams, texts_by_lang[lang]), Counter()), language_id.PROFILE))}
        far = language_id.PROFILE
        distance = sum(min(abs(place[g] - i), far) if g in place else far for i, g in enumerate(own))
        if best is None or distance < best[1]:
            best = lang, distance
    return best[0], 1 - best[1] / (language_id.PROFILE * len(own))


def test_languages_equal_the_plain_version(spark):
    rows = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang").collect()
    texts = {}
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 5:
            texts.setdefault(r["lang"], set()).add(r["text"])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in registry.op4_language_id(spark, "/root/testdata/sf0.001").collect()}
    for r in rows:
        lang, score = plain_language(r["text"], texts)
        assert got[r["doc_id"]][0] == lang and np.isclose(got[r["doc_id"]][1], score)
