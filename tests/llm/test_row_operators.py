"""Quality measures, byte-level BPE, main text, url rules, license scan and decontamination."""

import hashlib
import math
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from pathwarden.llm import byte_bpe, decontaminate, host_quality, html_text, license_scan, url_filter
from tests.llm.conftest import DOCS, ODD

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


# Quality


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(zip(words, words[1:], words[2:], strict=False))
    marked = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked), len(lines)


@pytest.mark.parametrize("text", [*ODD, "a b c a b c", "a\nb\na\n\n \na", "## $x <y>\x0b\x0cz\u00a0w", "aa aa aa aa"])
def test_measures(text):
    assert host_quality.text_measures(text) == plain_measures(text)


def test_bad_hosts_go_and_clean_ones_stay(documents, prose):
    rows = [(i, "too short", "bad") for i in range(60)] + [(60, prose(80, 1), "bad")]
    rows += [(100 + i, prose(80, i), h) for i in range(40) for h in ("good", None)] + [(500, "short", "good")]
    docs = documents(rows, extra=["n_words", "_measures_"])
    kept = host_quality.keep_good(docs)
    assert kept.columns == docs.columns
    got = kept.select("doc_id", "source", "n_words").collect()
    assert {r.source for r in got} == {"good", None} and len(got) == 80 and {r.n_words for r in got} == {"x"}


def test_columns_of_any_name_stay(documents, prose):
    docs = documents([(1, prose(80, 1), "h"), (2, "short", "h")], extra=["_host", "_Measures", "_coded"])
    measured = host_quality.with_measures(docs)
    judged = host_quality.judge(measured, host_quality.host_verdicts(measured))
    assert {r.doc_id: (r.kept, r["_host"], r["_Measures"]) for r in judged.collect()} == {1: (True, "x", "x"), 2: (False, "x", "x")}
    coded = byte_bpe.digest_columns(docs, RANKS, public_tokenizers.PATTERN)
    assert {(r["_coded"], r["_host"], r.n_tokens > 0) for r in coded.collect()} == {("x", "x", True)}


def test_rates_are_shrunk(spark):
    rows = [(f"h{n}", k < 2 + n % 8) for n in range(30) for k in range(50)] + [("one", True)] + [("bad", k < 990) for k in range(1_000)]
    frame = spark.createDataFrame(rows, "source string, rule_failed boolean")
    rates = {r["_host"]: r for r in host_quality.host_verdicts(frame).collect()}
    assert rates["one"].host_rate < 0.9 and not rates["one"].host_rejected
    assert 0.98 < rates["bad"].host_rate < 0.99 and rates["bad"].host_rejected
    assert rates["h0"].host_rate > 0.04  # pulled to the mean


def test_one_host_and_none(documents):
    assert host_quality.keep_good(documents([])).count() == 0
    assert host_quality.keep_good(documents([(1, "few words")])).count() == 0


# Byte-level BPE


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_ids_are_the_librarys(library):
    pick = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", "\u00e9", "\u00df", "\x1c", "\x85", "\u00a0", "\u3000", "1", "\u00b2", "\u6f22", "\U0001f44d", "\u0301"]
    parts += ["'s", "'S", "!", "--", "the", "ther", "x" * 200, "_", "\x00", "<|endoftext|>"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 50))) for _ in range(800)]
    texts += ["a" * 5_000, " " * 3_000, "".join(pick.choice("abcdefgh") for _ in range(20_000)), ""]
    coder = byte_bpe.Coder(RANKS, public_tokenizers.PATTERN)
    got = list(coder.encode(texts))
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [coder.decode(ids).decode() for ids in got] == texts


def test_one_by_one_equals_all_at_once(monkeypatch, library, prose):
    texts = [prose(300, i) for i in range(20)]
    for few in (0, 10**9):
        monkeypatch.setattr(byte_bpe, "FEW", few)
        coder = byte_bpe.Coder(RANKS, public_tokenizers.PATTERN)
        assert list(coder.encode(texts)) == [library.encode_ordinary(t) for t in texts]


def test_forgetting_words_changes_nothing(monkeypatch, library, prose):
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", 50)
    coder = byte_bpe.Coder(RANKS, public_tokenizers.PATTERN)
    for seed in range(5):
        text = prose(200, seed)
        assert next(iter(coder.encode([text]))) == library.encode_ordinary(text)


def test_columns_round_trip(documents, library):
    docs = documents(list(enumerate([*ODD, "same", "same"])), extra=["ids", "_coded_"])
    rows = byte_bpe.digest_columns(docs.drop("ids"), RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        assert (r.n_tokens, list(r.ids)) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = byte_bpe.decode_column(byte_bpe.encode_column(docs.drop("ids"), RANKS, public_tokenizers.PATTERN), RANKS)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back.collect())
    assert byte_bpe.digest_columns(documents([]), RANKS, public_tokenizers.PATTERN).count() == 0


# Main text

PAGE = """<html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home<li>More</ul></nav><div class="cookie-notice">We use cookies and more cookies and more cookies.</div>
%s<aside>Aside</aside><section id="comments"><p>A long comment by a reader, a very long comment by a reader.</p></section>
<form><label>Mail</label><input></form><script>var a = "<p>no</p>";</script><footer>&copy; all</footer></body></html>"""
BODY = "<h1>The &amp; title</h1><p><b>Some   text<br>of\nthe article</b>&nbsp;here.<p>Short.<ul><li>one<li>two</ul>"
TEXT = "The & title Some text of the article here. Short. one two"


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main>", '<div class="post">%s</div>', "<main><article><header>%s</header></article></main>"])
def test_main_text(around):
    expected = TEXT if "header" not in around else "The & title"
    assert html_text.main_text(PAGE % (around % BODY)) == expected


@pytest.mark.parametrize("html, text", [(None, ""), ("", ""), ("plain &lt; text", "plain < text"), ("<p>", ""), ("<nav>menu</nav>", ""), ("<p>a<b>b</b>c", "abc"), ("<div><p>x" * 3, "x x x"), ("<a" * 50, "")])
def test_odd_pages(html, text):
    assert html_text.main_text(html) == text


LONG = "<p>%s</p>" % ("a long paragraph of the page " * 40)
LONG_TEXT = ("a long paragraph of the page " * 40).strip()


@pytest.mark.parametrize(
    "html",
    [
        "<main><h1>The title</h1><p>A lead.</p><article>%s</article><article>Short post.</article></main>",
        "<body><article>The title A lead.</article><article>%s</article><article>Short post.</article></body>",
        "<body><div class='page'><div>The title</div><div>A lead.</div><div>%s</div><div>Short post.</div></div></body>",
        "<body><section><h1>The title</h1><p>A lead.</p></section><section>%s</section><section>Short post.</section></body>",
    ],
)
def test_short_parts_beside_long_ones_stay(html):
    assert html_text.main_text(html % LONG) == f"The title A lead. {LONG_TEXT} Short post."


def test_menus_beside_content_go():
    menu = "<div><a href='/'>Home</a> <a href='/x'>More</a></div>"
    assert html_text.main_text(f"<body>{menu}<div>{LONG}</div><div>Short.</div></body>") == f"{LONG_TEXT} Short."
    linked = f"<div><a href='/'>{LONG_TEXT[:400]}</a></div>"
    assert html_text.main_text(f"<body>{menu}<div>{LONG}</div>{linked}</body>") == f"{LONG_TEXT} {LONG_TEXT[:400].strip()}"


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "page-with-nav", "widget-area-off site", "related-article"])
@pytest.mark.parametrize("around", ["<div class='%s'>{}</div>", "<article class='%s'>{}</article>", "<div class='%s'><main>{}</main></div>", "<div class='%s'><article>{}</article></div>"])
def test_hint_words_around_the_content(name, around):
    inner = LONG + "<div class='share'>Share this</div>"
    assert html_text.main_text((around % name).format(inner)) == LONG_TEXT


def test_comments_longer_than_the_article_go():
    comments = "<section id='comments'><article class='comment'>%s</article></section>" % (LONG * 3)
    assert html_text.main_text(f"<article>{LONG}</article>{comments}") == LONG_TEXT
    assert html_text.main_text(f"<div class='post'>{LONG}</div><div id='comments'>{LONG * 3}</div>") == LONG_TEXT


def test_given_articles(spark):
    """All pages of the table hold an article; its text is what the tags leave."""
    import html as escapes

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for row in html_text.extract(pages).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", row.html, re.S).group(1)
        article = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", article))
        assert row.text == " ".join(escapes.unescape(article).split())
        assert row.n_chars == len(row.text)


def test_extract_keeps_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a b</p>", "old"), (1, "u", "<p>a b</p>", "old"), (None, None, None, None)], "page_id long, url string, html string, text string")
    rows = html_text.extract(pages).orderBy("page_id").collect()
    assert [(r.page_id, r.text, r.n_chars) for r in rows] == [(None, "", 0), (1, "a b", 3), (1, "a b", 3)]
    assert html_text.extract(pages.limit(0)).count() == 0


# Url rules

RULES = [("com", "/", "allow"), ("a.com", "/en/", "block"), ("www.a.com", "/en/", "allow"), ("a.com", "/en/x/", "allow"), ("a.com", "/en/x/y", "block"), ("net", "", "block")]


def plain_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[2:] if fits else (None, "allow"))


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://a.com", "http://A.com/en/", "https://www.a.com/en/1?q=/en/x", "ftp://b.www.a.com/en/x/y/z", "http://a.com/en/x", "http://aa.com/en/"]
    urls += ["http://x.net", "http://net/#a", "http://com/", "x://a.com/en/x/y", "x://a.com/en/x/\U0010ffff", "x://a.com?/en/", "x://.com/", "x://" + "l." * 300 + "net/" + "p" * 5000]
    urls += [u for u in urls for _ in range(2)]
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    for sweep in (1, 2_000):
        found = url_filter.innermost(pages.select(*[c.alias(n) for c, n in zip(url_filter.host_and_path(F.col("url")), ("host", "path"), strict=True)]).distinct(), rules, sweep)
        got = {(r.host, r.path): (r.rule, r.verdict) for r in found.collect()}
        for url in urls:
            host, path, rule, verdict = plain_verdict(url, RULES)
            assert got.get((host, path), (None, "allow")) == (rule, verdict)
    judged = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    assert judged == {i: plain_verdict(u, RULES) for i, u in enumerate(urls)}


def test_no_rules_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    none = rules.limit(0)
    assert url_filter.judge_urls(pages, none).first().verdict == "allow"
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    odd = spark.createDataFrame([(None, "/", "block"), ("com", None, "block"), ("com", "/", "allow"), ("com", "/", "block")], rules.schema)
    assert url_filter.judge_urls(pages, odd).first().verdict == "block"


# Licenses


def test_license_scan(documents):
    rows = [*enumerate(ODD), (20, "x CC-BY y cc by, all rights reserved. cc_by ccby"), (21, "Licensed under the\nApache License, Version 2.0 now"), (22, "the license apache")]
    rows += [(23, "w " * 997 + "permission is hereby granted free of charge to any person getting a copy of this software")] * 2
    got = {}
    for r in license_scan.scan(documents(rows, extra=["words", "row", "key"])).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[23]) == 2
    r = got[20][0]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.score) == (4, 1, 9, "cc-by,reserved", 1.0)
    assert (got[21][0].labels, got[21][0].base_labels, got[21][0].n_base, got[21][0].score) == ("apache-2.0", "", 0, 1.0)
    assert got[22][0].labels == "" and got[22][0].score == 0 and got[22][0].first_word is None
    assert got[23][0].labels == "mit" and 0.9 <= got[23][0].score < 1
    assert [got[i][0].n_words for i in range(4)] == [0, 0, 0, 1]
    assert license_scan.scan(documents([])).count() == 0


def test_license_scan_equals_brute_force(documents):
    pick = random.Random(5)
    templates = [("a b c d e f g h", "one"), ("a b x y", "two"), ("q r s t u v w x y z", "three")]
    letters = "abcdefghqrstuvwxyz"
    rows = [(i, " ".join(pick.choice(letters) for _ in range(pick.randint(0, 60)))) for i in range(150)]
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in license_scan.scan(documents(rows), phrases={}, templates=templates, threshold=0.7).collect()}
    for i, text in rows:
        words, best, labels = text.split(), 0, set()
        for at in range(0, max(1, len(words)), 10):
            block = set(words[at : at + 20])
            for template, label in templates:
                share = len(block & set(template.split())) / len(set(template.split()))
                if share >= 0.7:
                    best, labels = max(best, share), labels | {label}
        assert got[i] == (",".join(sorted(labels)), round(best, 9))


# Decontamination


def plain_distance(window, text):
    """Fewest edits between the window and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(window, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(text, edits, seed):
    pick, chars = random.Random(seed), list(text)
    for _ in range(edits):
        at = pick.randrange(len(chars))
        kind = pick.randrange(3)
        if kind == 0:
            chars[at] = pick.choice("aeiou")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, pick.choice("aeiou"))
    return "".join(chars)


def test_every_window_within_the_bound_is_found(prose):
    items = [(i, prose(n, 100 + i)) for i, n in enumerate((5, 8, 20, 40))]
    passages = decontaminate.Passages(items)
    texts = []
    for n in range(60):
        item = items[n % 4][1]
        texts.append(prose(10, n) + " " + edited(item, n // 5, n) + (" " + prose(10, 900 + n) if n % 2 else ""))
    found = passages.search(texts)
    for text, leaks in zip(texts, found, strict=True):
        folded = "".join(map(chr, decontaminate.fold(text)[0]))
        expected = {i: 0 for i, words in items if len(words) < decontaminate.SHORTEST and f" {words} " in f" {folded} "}
        for number, size in enumerate(passages.size):
            start = passages.start[number]
            distance = plain_distance("".join(map(chr, passages.bench[start : start + size])), folded)
            if distance <= passages.edits[number]:
                item = passages.items[number]
                expected[item] = min(expected.get(item, 99), distance)
        assert {x["item_id"]: x["edits"] for x in leaks} == expected


def test_excerpts_are_found_at_every_offset(prose):
    item = prose(80, 11)
    passages = decontaminate.Passages([(1, item)])
    size = decontaminate.WINDOW + decontaminate.STRIDE - 1
    assert size <= 100 < len(item) / 2
    texts = [prose(6, n) + " " + item[n : n + size + 2] + " " + prose(6, 500 + n) for n in range(len(item) - size - 2)]
    assert all(len(leaks) == 1 for leaks in passages.search(texts))


def test_short_items_are_found_as_whole_words(documents, spark):
    items = [(1, "What is the capital of?"), (2, "ab"), (3, "what is the capital of"), (4, "..."), (5, ""), (6, "x y")]
    texts = ["Tell me: what is the CAPITAL, of Peru", "the capital of", "cab abc a b", "say ab", "(ab)", "x\ny x y", "overwhat is the capital of", "ab ab"]
    expected = {(n, i) for n, t in enumerate(texts) for i, w in items if (f := re.sub(r"\W+", " ", w.lower()).strip()) and f" {f} " in f" {re.sub(r'\W+', ' ', t.lower()).strip()} "}
    docs = documents(list(enumerate(texts)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected) and {r.edits for r in found} == {0}
    assert [(r.first_char, r.end_char) for r in found if (r.doc_id, r.item_id) == (5, 6)] == [(0, 7)]
    assert decontaminate.drop_leaking(docs, benchmark).count() == len(texts)
    assert decontaminate.drop_leaking(docs, benchmark, shortest=3).count() == len(texts) - 2


def test_runs_of_one_character_take_little_memory():
    passages = decontaminate.Passages([(1, "x" * 200), (2, "ab" * 50)])
    tracemalloc.start()
    found = passages.search(["x" * 300_000, "ab" * 500, "x" * 50 + "ab" * 20])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [[(leak["item_id"], leak["edits"]) for leak in leaks] for leaks in found] == [[(1, 0)], [(2, 0)], []]
    assert found[0][0]["first_char"] < 100 and found[0][0]["end_char"] > 299_900
    assert peak < 300_000_000


def test_the_whole_search_by_brute_force(documents, spark, prose):
    """All documents and items, each window against each text, items shorter than a window and runs included."""
    items = [(n, prose(size, 300 + n)) for n, size in enumerate((5, 7, 12, 18, 25))] + [(10, "ha " * 40), (11, "z" * 90)]
    pick, rows = random.Random(5), []
    for n in range(40):
        item = items[n % 7][1]
        at = pick.randrange(len(item))
        piece = edited(item, n % 9, n) if n % 3 else item[at : at + 90]
        rows.append((n, f"{prose(4, n)} {piece} {prose(4, 700 + n)}"))
    rows += [(100 + n, t) for n, t in enumerate([None, "", "ha " * 200, "z" * 2_000, "Z" * 85, prose(60, 1)])]
    expected = {}
    for item, text in items:
        words = re.sub(r"\W+", " ", text.lower()).strip()
        last = max(0, len(words) - decontaminate.WINDOW)
        for start in sorted({*range(0, last, decontaminate.STRIDE), last}):
            window = words[start : start + decontaminate.WINDOW]
            most = min(int(len(window) * decontaminate.EDIT_RATE), (len(window) - decontaminate.Q) // decontaminate.Q)
            for doc, t in rows:
                distance = plain_distance(window, re.sub(r"\W+", " ", (t or "").lower()))
                if distance <= most:
                    windows, edits = expected.get((doc, item), (0, 99))
                    expected[doc, item] = windows + 1, min(edits, distance)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(documents(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id): (r.windows, r.edits) for r in found} == expected and len(expected) > 20


def test_matches_do_not_cross_documents(prose):
    item = prose(25, 7)
    half = len(item) // 2
    passages = decontaminate.Passages([(1, item)])
    assert passages.search([item[:half], item[half:], "", item]) [:3] == [[], [], []]
    assert passages.search([item[:half], item[half:], "", item])[3][0]["end_char"] == len(item)


def test_a_match_cut_at_either_end_belongs_to_its_own_text(prose):
    item = prose(40, 12)
    passages = decontaminate.Passages([(1, item[:60])])
    found = passages.search(["before", item[2:60], "between", item[:58], "after"])
    assert [[(leak["item_id"], leak["edits"]) for leak in leaks] for leaks in found] == [[], [(1, 2)], [], [(1, 2)], []]


def test_find_and_drop(documents, spark, prose):
    item = prose(30, 8)
    benchmark = spark.createDataFrame([(5, item), (6, item.upper()), (7, None), (8, "short"), (None, prose(40, 9))], "item_id long, text string")
    rows = [*enumerate(ODD), (50, prose(40, 1)), (51, "x " + item.replace(" ", ",\n") + " y"), (51, "x " + item), (None, prose(40, 9))]
    docs = documents(rows, extra=["item_id", "leaks"])
    found = decontaminate.find_leaks(docs, benchmark).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in found) == [(0, 0), (51, 5), (51, 5), (51, 6), (51, 6)]
    kept = decontaminate.drop_leaking(docs, benchmark)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {*range(len(ODD)), 50}
    assert decontaminate.drop_leaking(docs, benchmark.limit(0)).count() == len(rows)
    assert decontaminate.find_leaks(docs.limit(0), benchmark).count() == 0 and decontaminate.find_leaks(docs, benchmark.limit(0)).count() == 0


def test_blocks_of_the_benchmark(documents, spark, prose, monkeypatch):
    items = [(i, prose(30, 200 + i)) for i in range(6)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents([(i, prose(5, i) + " " + t) for i, t in items] + [(99, prose(50, 99))])
    assert len(list(decontaminate.blocks(benchmark, most=200))) > 1
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", ("item_id", "text", 200))
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, benchmark).collect()) == [(i, i) for i, _ in items]
    assert [r.doc_id for r in decontaminate.drop_leaking(docs, benchmark).collect()] == [99]


def test_html_never_raises(prose):
    pick = random.Random(1)
    bits = ["<", ">", "</", "/>", "<!", "<![", "<!--", "-->", "<p", "<div", "<article>", "</article>", "<main", "<a href=x", "&amp;", "&", "&#", "x y", '"', "'", "=", " ", "\n"]
    bits += ["<script>", "</script>", "<style", "<title>", "<?", "?>", "]]>", "\0", "é", "<li", "<td", "<br/>", "<textarea>", "<h1>", "<header>", 'class="comment"', "[ x ]", "%y;"]
    for _ in range(10_000):
        assert isinstance(html_text.main_text("".join(pick.choice(bits) for _ in range(pick.randint(1, 40)))), str)
    assert html_text.main_text("<p>a</p><![ x ]>") == "a" and html_text.main_text("<p>a</p><![%y;]]>b") == "a b"


def test_html_of_many_tags_is_linear():
    """Twice the tags take about twice the time, where a walk over the open elements would take four times."""
    pages = {
        "ends": lambda n: "<b>" * n + "</i>" * n + "x",
        "ends behind a block": lambda n: "<i><p>" + "<b>" * n + "</i>" * n + "x",
        "blocks": lambda n: "<b>" * n + "<div>" * n + "x",
        "headings": lambda n: "<article><header>" + "<b>" * n + "<h1>x" * n,
        "divisions": lambda n: "<div><p>some words here</div>" * n,
    }
    for make in pages.values():
        begun = time.process_time()
        html_text.main_text(make(10_000))
        assert time.process_time() - begun < 5


def test_an_article_does_not_win_over_longer_text(prose):
    body = f"<div class=body><h1>{prose(5, 1)}</h1><p>{prose(120, 2)}</p><p>{prose(3, 3)}</p><p>{prose(90, 4)}</p></div>"
    wanted = " ".join([prose(5, 1), prose(120, 2), prose(3, 3), prose(90, 4)])
    teaser = "<article><a href=/x>Read also this</a></article>"
    for page in (body + teaser, teaser + body, f"<section>{body}{teaser}</section>"):
        assert html_text.main_text(f"<body><nav><a>Home</a></nav>{page}</body>") == wanted
    # A short article beside a longer advert or below a lead stays the content.
    assert html_text.main_text(f"<div class=ad>{prose(40, 5)}</div><article><p>{prose(8, 6)}</p></article>") == prose(8, 6)
    assert html_text.main_text(f"<main><p>{prose(20, 7)}</p><article><p>{prose(80, 8)}</p></article></main>") == f"{prose(20, 7)} {prose(80, 8)}"


def test_ratios_and_threshold_line_by_line(prose):
    """Ratio, blur and threshold by the plain formulas, on pages where they decide."""
    decided = 0
    for seed in range(30):
        pick = random.Random(seed)
        parts = []
        for n in range(pick.randint(3, 12)):
            text = prose(pick.choice([1, 2, 30, 80]), 100 * seed + n)
            parts.append(pick.choice([f"<p>{text}</p>", f"<div><p><a href=/x>{text}</a></div>", f"<td><i>{text}</i>", f"<article>{text}</article>" if seed % 3 == 0 else f"<p>{text}"]))
        lines = html_text.Lines()
        lines.feed("<body>" + "".join(parts))
        lines.close()
        lines.end_line()
        lines.resolve()
        raw = [len(t) / max(tags, 1) for t, tags in zip(lines.texts, lines.tags, strict=True)]
        weight = [math.exp(-0.5 * (k / html_text.SIGMA) ** 2) for k in range(-6, 7)]
        plain = []
        for n, text in enumerate(lines.texts):
            near = sum(w / sum(weight) * raw[n + k] for k, w in zip(range(-6, 7), weight, strict=True) if 0 <= n + k < len(raw))
            plain.append((near * (html_text.PRIOR if lines.regions[n] in lines.landmarks else 1)) if text else 0)
        smooth, threshold = html_text.smoothed_ratios(lines)
        assert np.allclose(smooth, plain) and threshold == pytest.approx(min(np.std(plain), max(plain)))
        decided += html_text.content_regions(lines) is not lines.landmarks
    assert decided > 15


def test_html_keeps_columns_of_any_name(spark):
    pages = spark.createDataFrame([("<p>words here</p>", "own", "own too")], "html string, _main string, _main_ string")
    row = html_text.extract(pages).first()
    assert (row["_main"], row["_main_"], row["text"], row["n_chars"]) == ("own", "own too", "words here", 10)
