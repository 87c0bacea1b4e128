"""Periodic runs, spelling variants, main text of pages: against brute force and planted answers."""

import hashlib
import html
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ODD, WORD

from strata.llm import html_extract as he
from strata.llm.periodic_runs import find_runs, periodic_runs, run_digests, suffix_pairs, tail_repeated
from strata.llm.queries import op11_periodic_runs, op12_spelling, op13_html_extract
from strata.llm.ship import documents
from strata.llm.spelling import near_words, variant_forms, word_counts

# -- periodic runs ----------------------------------------------------------------------------------------------


def plain_runs(w, least=6, exponent=4):
    """Every longest stretch with smallest period q of at least max(least, exponent * q) words."""
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if i > s and length >= max(least, exponent * q):
                part = w[s : s + length]
                if not any(part[r:] == part[: length - r] for r in range(1, q)):
                    out.append((s, length, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def edited(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def digest(doc_id, text):
    w = edited(doc_id, text)
    runs = plain_runs(w)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(x for k, x in enumerate(w) if k not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, milli, sha(lines), sha(left))


def rows_of(seed, rows=200):
    rnd = random.Random(seed)
    for _ in range(rows):
        n, letters = rnd.randint(0, 70), rnd.choice([1, 2, 3, 5])
        w = [rnd.randrange(letters) for _ in range(n)]
        if n > 4 and rnd.random() < 0.6:
            a, p = rnd.randrange(n), rnd.randint(1, n // 3)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        yield w


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 2), (5, 3), (9, 2)])
def test_runs_equal_brute_force(least, exponent):
    rows = list(rows_of(least * 10 + exponent))
    codes = np.array([x * 7919 + 5 for w in rows for x in w], np.uint64)
    first = np.concatenate(([0], np.cumsum([len(w) for w in rows])))
    got = find_runs(codes, first, least, exponent)
    want = {k: plain_runs(w, least, exponent) for k, w in enumerate(rows)}
    assert got == {k: v for k, v in want.items() if v} and got


def test_suffix_neighbours_share_what_they_say():
    rows = list(rows_of(8, 40))
    codes = np.array([x for w in rows for x in w], np.uint64)
    first = np.concatenate(([0], np.cumsum([len(w) for w in rows])))
    a, b, shared = suffix_pairs(codes, first, 1)
    want = Counter()
    for k, w in enumerate(rows):
        order = sorted(range(len(w)), key=lambda i: w[i:])
        for i, j in itertools.pairwise(order):
            n = next((x for x in range(len(w)) if max(i, j) + x == len(w) or w[i + x] != w[j + x]), 0)
            if n:
                want[first[k] + i, first[k] + j, n] += 1
    assert Counter(zip(a.tolist(), b.tolist(), shared.tolist(), strict=True)) == want


def test_long_row_with_a_long_run():
    codes = np.arange(60_000, dtype=np.uint64)
    codes[500:] = 500 + (np.arange(59_500) % 700)
    assert find_runs(codes, np.array([0, 60_000])) == {0: [(500, 59_500, 700)]}


def test_run_digests_of_odd_rows(spark, odd, nothing):
    again = (10, " a b A b\ta b a b a b \n a b x x x x x x x", None, None, None)
    docs = odd.unionByName(spark.createDataFrame([again], "doc_id long, text string, lang string, source string, n_chars long"), True)
    changed = docs.withColumn("text", tail_repeated(docs.doc_id, docs.text))
    got = list(map(tuple, run_digests(periodic_runs(changed)).collect()))
    rows = [(r[0], r[1]) for r in [*ODD, again] if r[0] not in (5, 6)]  # those two are too long for brute force
    assert Counter(g for g in got if g[0] not in (5, 6)) == Counter(digest(*r) for r in rows)
    assert len(got) == len(ODD) + 1 and any(g[1] for g in got)
    assert run_digests(periodic_runs(nothing)).collect() == []


def test_op11_equals_brute_force(spark, small):
    want = {digest(*r) for r in documents(spark, small).select("doc_id", "text").collect() if len(r.text or "") < 8000}
    got = set(map(tuple, op11_periodic_runs(spark, small).collect()))
    assert want <= got and sum(1 for w in want if w[1]) > 5


def test_text_without_repeats(spark):
    got = periodic_runs(spark.createDataFrame([(1, "x  go go go go go go\ngo y"), (2, "日本 " * 7)], "doc_id long, text string")).collect()
    assert [(r.doc_id, [tuple(x) for x in r.runs], r.text) for r in got] == [(1, [(1, 7, 1)], "x go y"), (2, [(0, 7, 1)], "日本")]


# -- spelling variants ------------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and x != w and one_edit(x, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


@pytest.mark.parametrize(("letters", "shortest", "longest", "block"), [("ab", 1, 7, 4), ("abcdé日", 3, 8, 16), ("ab", 7, 11, 8), ("abc", 1, 5, 1024)])
def test_variants_equal_brute_force(spark, letters, shortest, longest, block):
    rnd = random.Random(longest)
    counts = {}
    for _ in range(400):
        word = "".join(rnd.choice(letters) for _ in range(rnd.randint(shortest, longest)))
        counts[word] = rnd.choice([2, 2, 3, 20, 30, 300, 4000, 50_000])
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in variant_forms(words, block=block).collect()} == plain_variants(counts)


def test_large_blocks_are_split(spark):
    """Words that share all but their middle: one block at first."""
    words = {f"commonbeginning{a}{b}{c}{d}commonending" for a, b, c, d in itertools.product("aei", repeat=4)}
    counts = {w: 2 + k for k, w in enumerate(sorted(words))}
    got = near_words(spark.createDataFrame(list(counts.items()), "word string, n long"), block=8)
    assert {r.word: r.n_near for r in got.collect()} == dict.fromkeys(words, 8)


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_op12_equals_brute_force(spark, small):
    counts = plain_counts(documents(spark, small).select("doc_id", "text").collect())
    by_hole = {}
    for w in counts:
        for k in range(len(w)):
            by_hole.setdefault((w[:k], w[k + 1 :]), set()).add(w)
    near = {w: set() for w in counts}
    for (a, b), same in by_hole.items():
        for w in same:
            near[w] |= same - {w} | ({a + b} & set(counts))
            if a + b in counts:
                near[a + b].add(w)
    got = {r.word: r for r in op12_spelling(spark, small).collect()}
    assert {w: r.n for w, r in got.items()} == counts
    assert {w: r.n_near for w, r in got.items()} == {w: len(x) for w, x in near.items()}
    for w, r in got.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        assert r.form == (best if best and counts[best] >= 10 * counts[w] else None)
        assert r.form_n == counts.get(r.form) and r.root == (got[r.form].root if r.form else w)


def test_words_of_odd_rows(spark, odd, nothing):
    rows = [r for r in ODD]
    got = {r.word: r.n for r in word_counts(odd, slips=31).collect()}
    assert got == plain_counts((r[0], r[1]) for r in rows)
    assert word_counts(odd, least_chars=3, least_count=9).count() > 0
    assert variant_forms(word_counts(nothing)).collect() == []


# -- main text of pages -----------------------------------------------------------------------------------------


def test_cut_equals_brute_force():
    rnd = random.Random(5)
    for _ in range(600):
        n = rnd.randint(1, 9)
        costs = [rnd.randint(-9, 9) for _ in range(n)]
        edges = [(i, i + 1, rnd.randint(0, 5)) for i in range(n - 1)]
        if n > 1:
            edges += [(*sorted(rnd.sample(range(n), 2)), rnd.randint(0, 5)) for _ in range(rnd.randint(0, n))]

        def value(side):
            lost = sum(max(-c, 0) if s else max(c, 0) for c, s in zip(costs, side, strict=True))
            return lost + sum(w for i, j, w in edges if side[i] != side[j])

        got = he.content_side(costs, edges)
        assert (value(got), sum(got)) == min((value(s), sum(s)) for s in itertools.product((0, 1), repeat=n))


def test_op13_gives_the_articles(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    got = {r.page_id: r for r in op13_html_extract(spark, small).collect()}
    for page in pages:
        article = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S)[1]
        blocks = [re.sub(r"<[^>]*>", "", b) for b in re.split(r"</?p>|</?h1>", article)]
        want = "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert (got[page.page_id].text, got[page.page_id].n_chars) == (want, len(want))
        assert got[page.page_id].url == page.url


LINKS = "<ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul>"
PAGES = {
    # names of elements
    f"<article><header><h1>T</h1></header><p>One &amp; two.<p>Three<br>four.<aside>Side.</aside></article><nav>{LINKS}</nav>": "T\nOne & two.\nThree four.",
    # roles and the words of classes
    f"<div role=banner>Site</div><div class='topnav'>{LINKS}</div><div id=content><h2>Title</h2><p>A first sentence of it.<p>Then more.</div>"
    "<div class='sidebarLeft'><p>A long text about something else entirely, with a sentence end.</p></div><div id=footer>&copy; 2020</div>": "Title\nA first sentence of it.\nThen more.",
    # no marks at all
    f"<body>{LINKS}<div>A story of some length is told here, and it goes on for a while.</div><div>It has another part, also good to read.</div>"
    "<div><a href=1>Next</a> <a href=2>Last</a></div>": "A story of some length is told here, and it goes on for a while.\nIt has another part, also good to read.",
    # comments, adverts within a line, notices, forms
    "<main><p>Text <span class=ad>Buy now!</span> goes on.</p><section id=comments><article><p>What a great text this is, thank you.</p></article></section></main>"
    "<div class='cookie-notice'>We use cookies to make this page better for you.</div><form><label>Mail</label><input name=m></form>": "Text goes on.",
    # a form around everything
    "<form><div class='page wrapper'><main><p>Inside.</p></main></div></form>": "Inside.",
    # scripts, comments, broken markup and references
    "<!-- <p>no --><script>if (a<b) t('</p>')</script><style>p{}</style><article><p title='x>y'>a < b &lt;c&gt; &nbsp; d&ampe</i><b>bold<p>next</article><p": "a < b <c> d&e bold\nnext".replace("e bold", "ebold"),
    # tables, lists, preformatted text
    "<main><table><tr><td>a<td>b<tr><th>c</table><pre>x\n  y</pre><ol><li>one<li>two</ol><dl><dt>k<dd>v</dl></main>": "a\nb\nc\nx y\none\ntwo\nk\nv",
    "<article class='has-sidebar'><p>Kept.</p></article>": "Kept.",
    "": "",
    "   ": "",
    "<script>never closed": "",
}


def test_planted_pages(spark):
    costs = he.Costs({})
    for page, want in PAGES.items():
        assert he.main_text(page, costs) == want
    rows = [(k, f"u{k}", page) for k, page in enumerate(PAGES)] + [(None, None, None), (0, "u0", next(iter(PAGES)))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 text", "2 n_chars")
    got = he.extract_text(pages).collect()
    texts = [*PAGES.values(), "", next(iter(PAGES.values()))]
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], r[1], t, len(t)) for r, t in zip(rows, texts, strict=True)), key=repr)
    assert he.extract_text(pages.limit(0)).collect() == []


def test_odds_follow_the_counts(spark):
    page = "<article>" + "<p>Some words of an article here.</p>" * 400 + "</article><nav>" + "<p>Menu point five.</p>" * 400 + "</nav>"
    odds = he.learned_odds(spark.createDataFrame([(page,)], "html string"))
    assert odds["words", 3] > he.belief("words", 3) and odds["words", 2] < he.belief("words", 2)  # six words against three
    assert abs(odds["links", 0] - he.belief("links", 0)) < 0.5


def test_one_template_does_not_decide_for_others(spark, small):
    """Odds of pages that all look alike, used on a page without any of their marks."""
    costs = he.Costs(he.learned_odds(spark.read.parquet(f"{small}/pages.parquet")))
    story = ["A story of some length is told here, and it goes on for a while.", "Be.", "It has another part, also good to read."]
    page = f"<body>{LINKS}" + "".join(f"<div>{line}</div>" for line in story) + "<div><a href=1>Next</a> <a href=2>Last</a></div>"
    assert he.main_text(page, costs) == "\n".join(story)
    for page, want in PAGES.items():
        assert he.main_text(page, costs) == want


def test_many_blocks_and_deep_pages():
    wide = "<body>" + "".join(f"<div><p>Paragraph {k} has some words, of many kinds.</p><a href=x>l</a></div>" for k in range(5000))
    parsed = he.parse(wide)
    assert len(parsed.blocks) == 10_000
    assert sum(he.content_side(he.Costs({})(parsed.blocks), he.block_edges(parsed))) == 5000
    deep = he.parse("<div>a" * 20_000)
    assert len(deep.blocks) == 20_000 and len(he.block_edges(deep)) >= 19_999
