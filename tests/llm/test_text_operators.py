"""The text operators: brute force, round trips, nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import html
import itertools
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat_format, components, decontaminate, html_extract, license_scan, minhash, packing, quality_classifier, quality_rules, queries, token_counts, url_filter
from tessera.llm.common import bitmap, maybe

DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words long, host string, kept boolean, bits string, key string, w string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, texts):
    return spark.createDataFrame([(k, t, None, "s", None, 1.0, 1, "h", True, "b", "k", "w") for k, t in texts], DOC)


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "no id here"), (5, "same row"), (5, "same row"), (6, "x" * 50_000), (7, "w " * 30_000), (8, "\u00e9\u0301 \U0001f600 <|endoftext|> it's 42 A\u00a0B \x1c y")]


# --- packing -------------------------------------------------------------------------------------------------------


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer("word_bpe_49k.json")
    encode = Tokenizer.from_file(path)
    rows = ODD + [(100 + k, " ".join(f"word{j % 17} Thre, st! caf\u00c9" for j in range(k * 7))) for k in range(60)]
    got = packing.pack_documents(docs(spark, rows).repartition(2), path, window=128).collect()
    want = Counter()
    for k, t in rows:
        ids = np.array(encode.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want[k, len(ids), ids.tobytes()] += 1
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for (k, n, ids), times in want.items():
        own = sorted(pieces[k, n], key=lambda r: r.start)
        assert sum(r.length for r in own) == n * times
        for r in own:
            assert zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32
    padded = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 128 and {r.padded for r in own} == {at if at & (at - 1) == 0 else 128}
        padded += own[0].padded - at
    assert padded < 2 * 128
    assert packing.pack_documents(docs(spark, []), path).count() == 0


def test_sum_of_squares_choice():
    p = packing.Packer(10)
    for n in (6, 6, 3):
        p.add((0, n), b"\0\0\0\0" * n)
    # two windows filled to 6: adding 3 there gives 1 + 1, a new window 4 + 1
    assert p.counts.tolist() == [0, 0, 0, 0, 0, 0, 1, 0, 0, 1, 0]
    p.add((0, 4), b"\0\0\0\0" * 4)
    assert len(p.done) == 1 and p.counts[6] == 0


# --- token counts --------------------------------------------------------------------------------------------------


def best_pieces(token, scores, byte_score):
    best = [(0.0, 0)] + [None] * len(token)
    for d in range(1, len(token) + 1):
        n = len(token[d - 1].encode("utf-8", "surrogatepass"))
        options = [(best[d - 1][0] + n * byte_score, -(best[d - 1][1] + n))]
        options += [(best[j][0] + scores[token[j:d]], -(best[j][1] + 1)) for j in range(d) if token[j:d] in scores]
        s, k = max(options)
        best[d] = (s, -k)
    return best[-1][1]


def test_token_counts_equal_brute_force(spark):
    path = queries.tokenizer("piece_bpe_32k.model")
    scores = token_counts.piece_scores(path)
    rows = [r for r in ODD if r[0] not in (6,)] + [(20, "The then there theory caf\u00e9s un\u00fcbersetzbar")]
    got = Counter(tuple(r) for r in token_counts.count_tokens(docs(spark, rows), path).collect())
    want = Counter()
    for k, t in rows:
        words = re.findall(r"[^ \t\n\r\x0b\x0c]+", t or "")
        by = {w: best_pieces("\u2581" + w, scores, min(scores.values()) - 10) for w in set(words)}
        want[k, len(words), sum(by[w] for w in words)] += 1
    assert got == want
    small = token_counts.Trie(scores, most_nodes=30)
    big = token_counts.Trie(scores)
    words = ["\u2581" + w for w in "alpha beta gamma delta alphabet betatron gammas".split()]
    assert [small.tokens(w) for w in words * 2] == [big.tokens(w) for w in words * 2]


# --- near-duplicates -----------------------------------------------------------------------------------------------


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components_by_brute_force(rows):
    sets, root = [(k, shingles(t)) for k, t in rows if k is not None], {k: k for k, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 85 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k, _ in rows if k is not None}


def test_near_duplicates_equal_brute_force(spark):
    r = np.random.default_rng(5)
    base = [f"t{x}" for x in r.integers(0, 400, 150)]
    rows = [x for x in ODD if x[0] != 5] + [(5, "same row"), (9, "Same ROW"), (10, "x y"), (None, "no id here"), (11, "No Id here")]
    for k in range(120):  # edited copies of one text, and copies of these
        w = list(base)
        for at in r.integers(0, 150, k % 7):
            w[at] = f"e{r.integers(0, 10**6)}"
        rows.append((100 + k, " ".join(w)))
    rows += [(500 + k, t) for k, (_, t) in enumerate(rows[-20:])]
    want = components_by_brute_force(rows)
    for p in (minhash.Params(), minhash.Params(block=16, stars=2, large=0)):
        got = minhash.near_duplicates(docs(spark, rows), p).collect()
        assert len(got) == len(rows)
        for x in got:
            if x.doc_id is None:
                assert x.component_id == 11 and not x.kept
            else:
                assert x.component_id == want[x.doc_id] and x.kept == (x.doc_id == x.component_id)
                assert x.n_shingles == len(shingles(dict(rows)[x.doc_id]))
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_rows_belong_by_their_own_text(spark):
    a, b = (" ".join(f"{p}{k}" for k in range(120)) for p in "ab")
    rows = [(1, a), (5, a + " end"), (5, b), (7, b + " end"), (None, b + " end"), (None, "alone and unnamed here now"), (None, "alone and unnamed here now"), (8, ""), (8, "")]
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs(spark, rows)).collect())
    assert got == Counter([(1, 116, 1, True), (5, 117, 1, False), (5, 116, 5, True), (7, 117, 5, False), (None, 117, 5, False), (None, 1, None, True), (None, 1, None, True), (8, 0, 8, True), (8, 0, 8, True)])


def test_many_near_copies_of_each_other(spark):
    """Families in which a pivot meets few: each member is near the next ones only."""
    rows = [(1000 * f + k, " ".join([f"w{f}x{j}" for j in range(k, k + 150)])) for f in range(3) for k in range(0, 260, 2)]
    want = components_by_brute_force(rows)
    got = minhash.near_duplicates(docs(spark, rows), minhash.Params(block=8, stars=1, large=0))
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_components(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 90: 90, 95: 90, 100: 90}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- quality classifier --------------------------------------------------------------------------------------------


def test_classifier_holds_out_and_scores_everything(spark):
    out = queries.op4_quality_classifier(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    model = quality_classifier.fit({0: ["bad !!! "] * 20, 1: ["good words here "] * 20})
    got = quality_classifier.score_quality(docs(spark, ODD), model, keep=("lang",)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    none = quality_classifier.fit({0: [], 1: []})
    assert {r.score for r in quality_classifier.score_quality(docs(spark, ODD), none).collect()} == {0.5}
    assert quality_classifier.score_quality(docs(spark, []), model).count() == 0


# --- HTML ----------------------------------------------------------------------------------------------------------


def flow_by_brute_force(gain, edges):
    n = len(gain)
    cost = lambda side: sum(g for k, g in enumerate(gain) if g > 0 and not side >> k & 1) + sum(-g for k, g in enumerate(gain) if g < 0 and side >> k & 1) + sum(c for a, b, c in edges if (side >> a & 1) != (side >> b & 1))
    return min(map(cost, range(1 << n))), cost


def test_min_cut_is_least():
    r = np.random.default_rng(2)
    for _ in range(300):
        n = int(r.integers(1, 10))
        gain = [float(x) for x in r.normal(0, 2, n)]
        edges = [(int(a), int(b), float(c)) for a, b, c in zip(r.integers(0, n, n), r.integers(0, n, n), r.random(n)) if a != b]
        least, cost = flow_by_brute_force(gain, edges)
        side = sum(1 << k for k, x in enumerate(html_extract.min_cut(gain, edges)) if x)
        assert abs(cost(side) - least) < 1e-4


def test_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html_extract.extract_pages(pages).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", source[r.page_id], re.S)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<(?!/?(?:p|h1)>)[^>]*>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("<nav><a href=x>Home</a></nav>", ""),
        ("<article><p>a <a href=\"x>b</a> c\u00a0&nbsp;d</p></article>", "a b c d"),
        ("<article><p>a &lt;b&gt; &eacute;&#233;<p>c\n  d<br>e</article>", "a <b> éé\nc d e"),
        ("<article><h1>T</h1><script>var a='</p><p>no'</script><!-- <p>no</p> --><style>p{}</style><p>Some words of the article.</p><aside>no</aside><form><p>no</p></form></article><footer>no</footer>", "T\nSome words of the article."),
        ("<main><p>First of the words.</p><div class='ad'>Buy it now</div><p>Last of the words.</p><section id='comments'><p>I like it very much indeed</p></section></main>", "First of the words.\nLast of the words."),
    ],
)
def test_extract(page, text):
    assert html_extract.extract(page) == text


@pytest.mark.parametrize("sign", ["class='single has-sidebar'", "class=nav-open", "id=comment-open", "class='header-fixed x'", "class=text-center", "class=body", ""])
@pytest.mark.parametrize("page", ["<body {}>{}</body>", "<html {}><body>{}</body></html>", "<body><div {}>{}</div></body>", "<body><div class=menu-open><div {}>{}</div></div></body>"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_page_wide_signs_mark_nothing(sign, page, tag):
    texts = ["The words of a paragraph, one after another, and some more of them. " * 4, "Other words of it, which go on for a line or two and then end. " * 4]
    inner = "<nav><a href=x>Home</a></nav><{0}><h2 class=text-center>Its title</h2><p>{1}</p><p>{2}</p></{0}><div class=sidebar><p>Look at this too</p></div><footer>All of it, 2020</footer>".format(tag, *texts)
    assert html_extract.extract(page.format(sign, inner)) == "\n".join(["Its title", *map(str.strip, texts)])


def test_marked_parts_stay_marked():
    long = "I like it very much indeed and so do many others here. " * 12
    page = "<body><div class=post><p>A post of a few words, and then some more of them to read.</p></div><div id=comments><p>{0}</p><p>{0}</p></div></body>".format(long)
    assert html_extract.extract(page) == "A post of a few words, and then some more of them to read."


LONG = "The words of a paragraph go on, one after another, until it ends. " * 5


@pytest.mark.parametrize(
    "page,text",
    [
        ("<body class='single no-sidebar'><article><h1>Its title</h1><p>{0}</p></article></body>", "Its title\n{0}"),
        ("<body class='comments-open'><div class=x1><h1>Its title</h1><p>{0}</p><p>{0}</p></div></body>", "Its title\n{0}\n{0}"),
        ("<body><form action=x><div class=c1><h1>Its title</h1><p>{0}</p><p>{0}</p></div></form></body>", "Its title\n{0}\n{0}"),
        ("<article><p>{0}</p><p>So <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds, as was shown.</p><p>{0}</p></article>", "{0}\nSo a=2 holds, as was shown.\n{0}"),
        ("<body><div class=c0><a href=/>Home</a> <a href=/b>About us</a></div><div class=c1><h1>Its title</h1><p>{0}</p><p>{0}</p></div><div class=c2><h3>3 comments</h3><div><b>Paul says:</b><p>Great post, thank you</p><a href=#>Reply</a></div></div><div class=c3><p>We use cookies to improve your experience on this site</p></div></body>", "Its title\n{0}\n{0}"),
        ("<article><p>{0}</p><p>No.</p><p>{0}</p></article><footer>{0}</footer>", "{0}\nNo.\n{0}"),
    ],
)
def test_pages_without_telling_names(page, text):
    assert html_extract.extract(page.format(LONG)) == text.format(LONG.strip())


def test_extraction_is_the_least_cost_labelling():
    m, moved, pages = html_extract.trained(), 0, html_extract.labelled_pages(150, seed=7)
    wrong = alone = blocks = 0
    for page in pages:
        found, nodes, want = html_extract._labelled(page)
        gain = (html_extract.features(found, nodes, m.cues) @ m.weights).tolist()
        edges = html_extract.smoothness(found, 0.8)
        keep = html_extract.min_cut(gain, edges)
        sign = [g > 0 for g in gain]
        moved += keep != sign
        wrong, alone, blocks = wrong + sum(a != b for a, b in zip(keep, want)), alone + sum(a != b for a, b in zip(sign, want)), blocks + len(want)
        if len(found) <= 11:
            least, cost = flow_by_brute_force(gain, edges)
            assert abs(cost(sum(1 << k for k, x in enumerate(keep) if x)) - least) < 1e-4
    assert moved >= 0.05 * len(pages) and wrong <= alone and wrong < 0.02 * blocks  # other pages than those trained on


def test_long_pages_take_linear_time():
    for part in ("<div class=c{0}>word word word.</div>", "<p><i>a b ", "<div><b><h1>a</h1></b><span>", "<ul><li><b>x</i></b><a href=y>z", "<p>{0}</p><td>"):
        took = []
        for n in (5_000, 50_000):
            page = "".join(part.format(k % 7) for k in range(n))
            began = time.process_time()
            html_extract.extract(page)
            took.append(time.process_time() - began)
        assert took[1] < 20 * took[0] + 1 and took[1] < 15


def test_pages_keep_odd_rows(spark):
    rows = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "", "x"), (2, None, "<p>" + "word " * 60_000, "x")], "page_id long, url string, html string, text string")
    got = html_extract.extract_pages(rows).collect()
    assert len(got) == 4 and max(r.n_chars for r in got) == 299_999


# --- decontamination -----------------------------------------------------------------------------------------------


def hits(text, items, window=10):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    w, hit, found = find(text), set(), set()
    for k, t in items:
        v = find(t)
        n = min(window, len(v))
        for win in {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else ():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) == win:
                    hit |= set(range(i, i + n))
                    found.add(str(k))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_decontamination_equals_brute_force(spark):
    a, b = [" ".join(f"{p}{k}" for k in range(25)) for p in "ab"]
    items = [(1, a), (2, b), (11, "Short item!"), (12, "solo"), (3, None), (4, ""), (5, a), (6, "r r r r r r r r r r r r")]
    rows = [(20, f"x y {a} z"), (21, a[:20]), (22, f"{a} {b} short, ITEM solo."), (23, "r " * 15), (24, "q " + " ".join(a.split()[3:13]).upper() + " q " + " ".join(a.split()[5:15])), (25, "só solo-ish short ítem")] + ODD
    bench = spark.createDataFrame([(k, t, 0) for k, t in items], "item_id long, text string, doc_id int")
    got = Counter(tuple(r) for r in decontaminate.find_contamination(docs(spark, rows), bench).collect())
    assert got == Counter((k, *hits(t, items)) for k, t in rows)
    none = decontaminate.find_contamination(docs(spark, rows), bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)
    assert decontaminate.find_contamination(docs(spark, []), bench).count() == 0


def test_bitmap(spark):
    keys = spark.createDataFrame([(k * 7919 - 50_000,) for k in range(50)], "h long")
    rows = spark.range(-60_000, 400_000, 1).select(F.col("id"), maybe(bitmap(keys, "h", 64), F.col("id")).alias("m"))
    assert rows.join(keys, F.col("id") == F.col("h")).where("not m").count() == 0
    assert 0 < rows.where("m").count() < 10_000


# --- licenses ------------------------------------------------------------------------------------------------------


def test_alignment_by_patience():
    assert license_scan.longest_rising([(0, 3), (1, 1), (2, 2), (3, 0), (4, 5)]) == [(1, 1), (2, 2), (4, 5)]
    t = "permission is hereby granted free of charge".split()
    matched = license_scan.align(t, "so permission is now hereby granted of charge".split())
    assert [t[a] for a, _ in matched] == ["permission", "is", "hereby", "granted", "of", "charge"]
    assert all(a < c and b < d for (a, b), (c, d) in zip(matched, matched[1:]))


def test_licenses_are_found(spark):
    rows = [(100 + k, f"Some words before. {t} And some after it, the end.") for k, t in enumerate(license_scan.TEMPLATES.values())]
    rows += [(200, "MIT " * 500 + license_scan.TEMPLATES["MIT"] + " x" * 5000 + license_scan.TEMPLATES["MIT"])] + ODD
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs(spark, rows)).collect()}
    assert [got[100 + k].license for k in range(len(license_scan.TEMPLATES))] == list(license_scan.TEMPLATES)
    assert got[200].license == "MIT" and all(got[k].license is None for k, _ in ODD)
    assert got[100 + list(license_scan.TEMPLATES).index("BSD-3-Clause-text")].found == ["BSD-2-Clause-text", "BSD-3-Clause-text", "BSD-conditions"]
    stray = "version " + "filler " * 100 + "Licensed under the Apache License, 2.0. " * 2
    assert license_scan.scan_licenses(docs(spark, [(1, stray)])).first().license == "Apache-2.0"
    assert license_scan.scan_licenses(docs(spark, [])).count() == 0
    bare = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = "Released under the MIT License.|Licensed under the Apache License, Version 2.0.|GNU General Public License, version 3|Licensed under CC BY-NC 4.0."
    found = license_scan.scan_licenses(bare).where("license is not null")
    assert found.count() == bare.where(F.col("text").rlike(lines.replace(".", "[.]"))).count()


def test_edited_notices_beside_stray_words():
    t = license_scan.words(license_scan.TEMPLATES["GPL-3.0"])
    far = ["far"] * 300
    notice = license_scan.words("This software is licensed under the GNU General Public License, version 3.")
    text = "this work this".split() + far + notice + far
    assert license_scan.best_alignment(t, text) == ((len(t) - 1) / len(t), 303, 303 + len(notice))
    r = np.random.default_rng(1)
    for _ in range(300):  # every notice that lacks no more than it may, beside stray words and other copies of them
        t = list("abcdefghijklmnopqrst"[: r.integers(5, 21)]) if r.random() < 0.5 else [str(x) for x in r.integers(0, 6, r.integers(5, 21))]
        least = next(m for m in range(len(t) + 1) if m / len(t) >= 0.85)
        kept = sorted(r.choice(len(t), least, replace=False))
        stray = [t[k] for k in r.integers(0, len(t), r.integers(0, 6))]
        c, a, b = license_scan.best_alignment(t, stray + far + [t[k] for k in kept] + far + stray)
        assert c >= 0.85 and 0 <= a < b
    for _ in range(200):
        x, y = ([str(k) for k in r.integers(0, 4, r.integers(0, 9))] for _ in range(2))
        pairs = license_scan.longest(x, y)
        assert license_scan.common(x, y) == len(pairs) == max((k for k in range(9) for s in itertools.combinations(x, k) if in_order(s, y)), default=0)
        assert all(x[i] == y[j] for i, j in pairs) and all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))


def in_order(s, y):
    rest = iter(y)
    return all(w in rest for w in s)


# --- quality rules -------------------------------------------------------------------------------------------------


def counts_by_brute_force(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    hit = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(3)}
    seen, dup = set(), 0
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit)


def test_quality_rules_equal_brute_force(spark):
    rows = ODD + [(30, "a b c a b c d\nx | y\nx | y\n\n \n"), (31, " ".join(f"w{k}" for k in range(60)))]
    got = Counter(tuple(r)[:6] for r in quality_rules.apply_quality_rules(docs(spark, rows)).collect())
    assert got == Counter((k, *counts_by_brute_force(t)) for k, t in rows)
    good = " ".join(f"word{k}" for k in range(60))
    mixed = spark.createDataFrame([(k, good if k % 100 else "bad", "worst" if k < 300 and k % 100 else "fine") for k in range(600)], "doc_id long, text string, source string")
    assert quality_rules.apply_quality_rules(mixed).where("kept").count() == 594
    hosts = spark.createDataFrame([(k, "bad" if k < 900 else good, "spam" if k < 905 else f"h{k % 9}") for k in range(2000)], "doc_id long, text string, source string")
    halves = [(k, good if k % 5 == 0 else "short one" if k % 5 < 3 else good + " #" * 40, "mixed") for k in range(1000)]  # most fail, no rule alone is failed by most
    halves += [(1000 + k, good, f"h{k % 30}") for k in range(3000)]
    split = quality_rules.apply_quality_rules(spark.createDataFrame(halves, "doc_id long, text string, source string"))
    assert split.where("kept").count() == 3000 and split.where("host_rejected").count() == 1000
    out = quality_rules.apply_quality_rules(hosts)
    assert out.where("doc_id between 900 and 904 and not kept and not base_failed").count() == 5 and out.where("kept").count() == 1095
    assert quality_rules.apply_quality_rules(docs(spark, [])).count() == 0


# --- URLs ----------------------------------------------------------------------------------------------------------


def test_url_rules_and_model(spark):
    model = url_filter.train(url_filter.labelled_urls(spark))
    urls = {1: "http://a.example.com/en/70?x", 2: "HTTP://A.COM/en/", 3: "https://example.net/de/8", 4: "x://b.net/de/9#y", 5: None, 6: "no scheme", 7: "https://casino-win.example.net/fr/1", 8: "https://www.city-library.example.org/fr/2", 9: "http://notcom/en/", 10: "http://com?u=://x/en/", 11: "http://É.ORG/es/", 12: "https://free-bets.example.com/en/71"}
    rows = spark.createDataFrame([(k, u, "h") for k, u in urls.items()], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(rows, queries.URL_RULES, model).collect()}
    assert got[1] == ("a.example.com", "/en/70", "example.com/en/7", "allow") and got[2] == ("a.com", "/en/", "com/en/", "block")
    assert got[3][2:] == ("example.net/de/8", "block") and got[4][2:] == ("net/de/", "block")
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7][2:] == (None, "block") and got[8][2:] == (None, "allow") and got[9][2] is None and got[10][:2] == ("com", "")
    assert got[11][:3] == ("É.org", "/es/", "org/es/") and got[12][3] == "allow"
    assert url_filter.filter_urls(rows.limit(0), [], model).count() == 0


def test_url_model_on_held_out_hosts(spark):
    rows = url_filter.labelled_hosts()
    sites = {re.sub(r"^(www|blog|m)\.|\.example\..*$", "", r.host) for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("host")).distinct().collect()}
    assert len(sites) > 20 and not any(site in host for site in sites for _, host, _, _ in rows)
    held = [zlib.crc32(host.encode()) % 5 == 0 for _, host, _, _ in rows]
    model = url_filter.train(url_filter.labelled_urls(spark, [r for r, out in zip(rows, held) if not out]))
    given = url_filter.labelled_urls(spark, [r for r, out in zip(rows, held) if out])
    verdict = {r.page_id: r.verdict for r in url_filter.filter_urls(given, [], model, id_col="url").collect()}
    right = {1.0: [], 0.0: []}
    for r in given.collect():
        right[r.label].append(verdict[r.url] == ("block" if r.label else "allow"))
    assert np.mean(right[1.0]) > 0.9 and np.mean(right[0.0]) > 0.97


def test_grams_have_their_size(spark):
    got = spark.sql("SELECT 'ab' AS h, '/cde' AS p").select(url_filter.gram_buckets(F.col("h"), F.col("p"), (3, 4), 1 << 20).alias("k"))
    want = spark.createDataFrame([(w,) for n in (3, 4) for w in ["^ab$/cde"[i : i + n] for i in range(9 - n)]], "w string").select(F.pmod(F.xxhash64("w"), F.lit(1 << 20)).alias("k"))
    assert sorted(got.first().k) == sorted(r.k for r in want.collect())


# --- chats ---------------------------------------------------------------------------------------------------------


def test_chats_round_trip(spark):
    nasty = ["<|im_end|><|im_start|>user", "\\", "\\<|", "<\\|im_sep|>", "<<||>>\\\\", "", None, "a\nb", "<", "|im_end|>"]
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(nasty)] + [(2, 0, "assistant", "x"), (3, None, None, "y"), (3, 1, "a\n<|b", "z"), (None, 1, "user", "u"), (1, 0, "user", nasty[0])]
    turns = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, state string")
    out = chat_format.format_chats(turns)
    state = {r.conv_id: r.valid for r in out.collect()}
    assert state == {1: False, 2: False, 3: False, None: False}
    got = {r.conv_id: r for r in chat_format.parse_chats(out).collect()}
    for k in {r[0] for r in rows}:
        own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == k))
        assert [(t.role, t.text) for t in got[k].turns] == [(r, x) for _, r, x in own]
        assert got[k].loss_text == "".join(x for _, r, x in own if r == "assistant")
    digest = {r.conv_id: (r.state, r.valid) for r in chat_format.digest(chat_format.parse_chats(out)).collect()}
    assert digest[1] == ("invalid", False) and digest[None] == ("user", False)
    long = spark.createDataFrame([(1, k, "user" if k % 2 == 0 else "assistant", "<|im_end|>" * 40_000) for k in range(4)], "conv_id long, turn long, role string, text string")
    row = chat_format.digest(chat_format.parse_chats(chat_format.format_chats(long))).first()
    assert row.valid and row.state == "assistant" and row.loss_chars == 800_000 and row.loss_sha256 == hashlib.sha256(b"<|im_end|>" * 80_000).hexdigest()
    ok = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")], "conv_id long, turn long, role string, text string")
    assert chat_format.format_chats(ok).first().valid
    assert chat_format.format_chats(ok.limit(0)).count() == 0
