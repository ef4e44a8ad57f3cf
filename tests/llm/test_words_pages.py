"""Spelling variants, main text and collocations: brute force, SQL, messy tables and unusual pages."""

import random
import re
import string
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from revue.llm import bloom, main_text, phrases, spelling
from revue.llm import textops as T
from tests.llm.conftest import QUERIES, SMALL, oracle, rows_of


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_main_text", "op13_phrase_collocations"])
def test_query_equals_sql(spark, name):
    columns, want = oracle(name)
    assert sorted(rows_of(QUERIES[name](spark, SMALL), *columns), key=repr) == sorted(want, key=repr) and want


# ------------------------------------------------------------------ 11 spelling variants

def plain_words(rows, altered=31):
    """Count of every word of at least seven letters, from (id, text) rows."""
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in string.ascii_uppercase else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if altered and h % altered == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def plain_groups(counts):
    out = {}
    for w in counts:
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        out[w] = (best if best and counts[best] >= 10 * counts[w] else None, len(near))
    rows = []
    for w, (form, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, counts[w], near, counts[form] if form else None))
    return sorted(rows)


def misspelt(rng, word):
    at, c = rng.randrange(len(word)), rng.choice("abcxyzéÿÀÞ")
    return rng.choice([word[:at] + word[at + 1:], word[:at] + c + word[at:], word[:at] + c + word[at + 1:]])


@pytest.fixture(scope="module")
def misspelt_rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randrange(6, 12))) for _ in range(20)] + ["aaaaaaaa", "aabbaabb"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = rng.choice(base[:rng.randrange(1, len(base) + 1)])
            for _ in range(rng.choice([0, 0, 0, 0, 1, 2])):
                w = misspelt(rng, w)
            words.append(rng.choice([w, w.title(), w + "Ā" + w]))
        rows.append((i if i % 50 else None, rng.choice([" ", ", ", "\n"]).join(words)))
    long_ = "".join(rng.choice("abc") for _ in range(900))
    rows += [(1000, long_), (1001, long_), (1002, long_[:400] + long_[401:]), (1003, long_[:400] + long_[401:]), (1004, None), (1005, "")]
    return rows + rows[:20]


@pytest.mark.parametrize("per_pass", [bloom.PER_PASS, 300])
def test_spelling_groups_equal_brute_force(spark, misspelt_rows, per_pass):
    got = spelling.spelling_groups(spark.createDataFrame(misspelt_rows, "doc_id long, text string"), per_pass=per_pass)
    want = plain_groups(plain_words(misspelt_rows))
    assert rows_of(got, "word", "form", "root", "n", "n_near", "form_n") == want
    assert len({r[2] for r in want}) < len(want) and any(r[1] and r[2] != r[1] for r in want)


def test_crc_and_words_of_long_runs():
    texts = ["x" * 500 + " Ab" + "é" * 70, "ÀÉ" * 40, "", "a×b" * 9]
    data, offsets = T.buffers(pa.array(texts))
    for altered in (0, 1, 2):
        got = spelling.words_of(data, offsets, [f"{k}:".encode() for k in range(4)], 1, altered).to_pylist()
        want = []
        for k, text in enumerate(texts):
            for run in re.findall("[A-Za-zÀ-ÿ]+", text):
                run = run.replace("A", "a")
                h = zlib.crc32(f"{k}:{run}".encode())
                if altered and h % altered == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                want += [run] if run else []
        assert got == want


def test_filters_hold_every_key_and_few_others(spark):
    keys = np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, 60_000)
    df = spark.createDataFrame([(int(k % 2), int(k)) for k in keys[:30_000]], "shard int, key long")
    sizes = {r["shard"]: r["count"] for r in df.groupBy("shard").count().collect()}
    filters = bloom.build(df, sizes)
    for shard in (0, 1):
        own = keys[:30_000][keys[:30_000] % 2 == shard].view(T.U)
        assert len(filters.find(shard, own)) == len(own)
        assert len(filters.find(shard, keys[30_000:].view(T.U))) < 300
    assert len(filters.find(7, keys.view(T.U))) == 0


def test_spelling_of_messy_and_empty_tables(spark, messy, empty):
    rows = [(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]
    assert rows_of(spelling.spelling_groups(messy), "word", "form", "root", "n", "n_near", "form_n") == plain_groups(plain_words(rows))
    assert spelling.spelling_groups(empty).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_groups(messy, ratio=2)


# ------------------------------------------------------------------ 12 main text

ARTICLE = ["A title", "The first paragraph has some words, a few more &amp; a <b>bold</b> one.", "Short.",
           "The last paragraph <a href='x>y'>links</a> somewhere else and then it goes on for a while."]
TEXT = "A title\nThe first paragraph has some words, a few more & a bold one.\nShort.\nThe last paragraph links somewhere else and then it goes on for a while."
CHROME = """<!DOCTYPE html><html class="no-js"><head><title>T</title><style>p{a:b}</style><script>var t="</p><p>not this";</script></head>
<body class="has-sidebar comments-open"><header><h2>Site name</h2><p>The motto of the whole site</p></header><nav><ul><li><a href=/a>Home</a>
<li><a href=/b>Other things</a></ul></nav><!-- <p>hidden</p> --><div class="cookie-notice">We use cookies on this site to do things.</div>%s
<aside><p>Read this, too, it is about something else.</p></aside><form><label>Name</label><input><button>Send</button></form>
<section id="comments"><p>A reader says that this is a very nice text.</p></section><footer>&copy; someone, all rights</footer></body></html>"""


def body(wrap="<article>%s</article>", between=""):
    return CHROME % (wrap % ("<h1>%s</h1><p>%s<p>%s</p>" + between + "<p>%s") % tuple(ARTICLE))


@pytest.mark.parametrize("page", [
    body(), body("<div class='post-content'>%s</div>"), body("<div>%s</div>"), body("<main><div>%s</div></main>"),
    body(between='<div class="ad">Buy this thing now, it is cheap</div>'), body("<ARTICLE>%s</ARTICLE>").replace("<p>", "\n<P >\t"),
    body().replace("</body></html>", ""), body(between="<!-- a --><script>x()</script><aside>not of the text</aside>"),
    body("<table><tr><td>%s</td></tr></table>")])
def test_main_text_of_pages(page):
    assert main_text.main_text(page, main_text.Weights({}, {})) == TEXT


def test_main_text_of_unusual_pages():
    text = lambda page: main_text.main_text(page, main_text.Weights({}, {}))
    assert text("") == "" and text("<p></p>") == "" and text("<nav>only a menu</nav>") == ""
    assert text("plain words only") == "plain words only"
    assert text("<article><p>a&nbsp;&#8212;\n b &lt;p&gt;<br>c</article>") == "a — b <p> c"
    assert text("<article><p>one two<!-- not closed <p>three") == "one two"
    assert text("<article><p>one two</div></span></p>three <i>f</article></i>our") in ("one two\nthree f", "one two\nthree f\nour")
    assert text("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>") == "one\ntwo\na\nb"
    assert text("<article><p>1 < 2 and 3 > 2</article>") == "1 < 2 and 3 > 2"


@pytest.mark.parametrize("page", ["<a <a " * 50_000 + ">", "<!--" * 50_000, "<b>" * 100_000 + "x" + "</b>" * 100_000, "<div>" * 100_000 + "x",
                                  "<p title='" * 30_000, "<script>" * 50_000, "<p>word " * 100_000, "</p>" * 100_000, "&amp" * 100_000])
def test_main_text_takes_linear_time(page):
    began = time.time()
    main_text.main_text(page, main_text.Weights({}, {}))
    assert time.time() - began < 10


def test_best_run():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(9)
        gains, costs = [rng.choice([0, 1, 2, 5]) for _ in range(n)], [rng.choice([0, 1, 3]) for _ in range(n)]
        total = lambda b, e: sum(gains[b:e]) - sum(costs[b + 1:e])  # noqa: E731,B023
        runs = [(total(b, e), -b, -e) for b in range(n) for e in range(b + 1, n + 1)]
        begin, end = main_text.best_run(gains, costs)
        best = max((r[0] for r in runs), default=0)
        assert (total(begin, end) if end else 0) == max(best, 0)


def test_weights_of_labelled_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    weights = main_text.fit(pages)
    assert weights.word(["p"], False) > 0.9 > 0.1 > weights.word(["footer"], True)
    assert weights.cost(["p"]) < 0.2 < 1 < weights.cost(["section"])


def test_main_text_of_messy_and_empty_tables(spark):
    rows = [(1, "u", body(), "x"), (1, "u", body(), "x"), (None, None, None, None), (3, "v", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    weights = main_text.fit(pages)
    got = rows_of(main_text.extract(pages, weights, ["page_id", "url"]), "page_id", "url", "text", "n_chars")
    assert got == [(1, "u", TEXT, len(TEXT))] * 2 + [(3, "v", "", 0), (None, None, "", 0)]
    none = main_text.extract(pages.limit(0), main_text.fit(pages.limit(0)), ["page_id"])
    assert none.count() == 0 and none.columns == ["page_id", "text", "n_chars"]


# ------------------------------------------------------------------ 13 collocations

def plain_collocations(rows, least, top=2000):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if c in string.ascii_uppercase else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, *words[k:k + size]) for k in range(len(words) - size + 1))
    out = {}
    for phrase, a in f.items():
        lang, words = phrase[0], phrase[1:]
        if len(words) == 1 or a < least:
            continue
        if len(words) == 2 and any(b >= least and 2 * b >= a and p[0] == lang and words in (p[1:3], p[2:]) for p, b in f.items() if len(p) == 4):
            continue
        cuts = [(1000000 * a * a // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[(lang, *words[:k])], f[(lang, *words[k:])]))
    return sorted((lang, rank, p.decode(), -a, left, right, total[lang], -score) for lang, found in out.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1))


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(7)
    words = ["the", "The", "of", "new", "york", "city", "é", " x", "a b", "--", "Ä", "hot", "dog", "of"]
    rows = [("".join(rng.choice(words[:rng.randrange(2, len(words))]) + rng.choice([" ", " ", "\t", "  ", ", ", ".", "\n"])
                     for _ in range(rng.randrange(60))), rng.choice(["en", "en", "de", None, "und"])) for _ in range(300)]
    return rows + rows[:30] + [(None, "en"), ("", None), ("new york city " * 3000, "en"), (" ,.", "fr")]


@pytest.mark.parametrize(("room", "window"), [(phrases.GROUP, phrases.WINDOW), (50, 100)])
def test_collocations_equal_brute_force(spark, phrase_rows, room, window, monkeypatch):
    monkeypatch.setattr(phrases, "WINDOW", window)
    df = spark.createDataFrame([(*r, "clash", 1) for r in phrase_rows], "text string, lang string, h1 string, n int")
    want = plain_collocations(phrase_rows, 10)
    assert rows_of(phrases.collocations(df, room=room), *COLUMNS) == want and {r[0] for r in want} == {"en", "de", "und"}
    assert rows_of(phrases.collocations(df, room=room, top=7), *COLUMNS) == [r for r in want if r[1] <= 7]


def test_windows_cut_a_block_anywhere(phrase_rows):
    langs, texts = pa.array([r[1] or "und" for r in phrase_rows]), pa.array([r[0] for r in phrase_rows])
    data, offsets = T.buffers(texts)
    block = phrases.Block(data, offsets, langs, 0)
    common, slices = np.ones(len(block.hashes), bool), 1 << phrases.SLICE_BITS

    def leaves(step):
        out = Counter()
        for begin in range(0, len(block.symbol), step):
            for batch in phrases._suffixes(block, common, begin, min(begin + step, len(block.symbol)), np.zeros(slices, int), np.ones(slices, int)):
                raw = batch.column(1)[0].as_buffer().to_pybytes()
                m = len(raw) // 28
                h = np.frombuffer(raw, np.int64, 3 * m).reshape(3, m).T.tolist()
                for key, n in zip(map(tuple, h), np.frombuffer(raw, np.uint32, m, 24 * m).tolist(), strict=True):
                    out[key] += n
        return out
    assert leaves(10 ** 9) == leaves(7) == leaves(1) and leaves(7)


def test_partition_keeps_groups_within_the_budget():
    rng = random.Random(2)
    sizes = {s: rng.choice([0, 1, 30, 70, 500]) for s in range(1 << phrases.SLICE_BITS)}
    first, parts, groups = phrases.partition(sizes, 100)
    load = Counter()
    for s, size in sizes.items():
        for g in range(parts[s]):
            load[int(first[s]) + g] += -(-size // int(parts[s]))
    assert max(load) == groups - 1 and max(load.values()) <= 100
    assert phrases.partition({}, 100)[2] == 1


def test_collocations_of_messy_and_empty_tables(spark, messy, empty):
    rows = [(r["text"], r["lang"]) for r in messy.select("text", "lang").collect()]
    assert rows_of(phrases.collocations(messy), *COLUMNS) == plain_collocations(rows, 10)
    assert phrases.collocations(empty).count() == 0
