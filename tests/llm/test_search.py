"""Secrets, pages, vectors and language-model scores."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import adaptive_scan, html_blocks, lm_scoring, recurrent, secrets

SCHEMA = "doc_id long, text string"

# secrets

PATTERNS = [
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def plain_spans(text):
    found = [(m.start(), k, m.end()) for k, (pattern, good) in enumerate(PATTERNS) for m in pattern.finditer(text or "") if good(m)]
    return sorted(found)


def spelled(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_documents():
    rng = np.random.default_rng(12)
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    base62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    hexes = "0123456789abcdef"
    texts = [
        "password=abc passwd=token:abcdefgh secret = 'x' api_key: \"q1w2e3r4\" APIKEY=zzzzzzz",
        "é😀 token = " + draw(base62, 30) + " end\npassword:\x20\x20" + draw(hexes, 40),
        "AKIA" + draw("ABC123", 16) + " AKIAabc AKIA" + draw("ABC123", 15) + "xAKIAAKIA" + draw("XYZ9", 20),
        draw(hexes, 24) + " " + draw(hexes, 23) + "g" + draw(hexes, 64),
        "token=" + draw("a", 5) + " token==abcdef tokentoken=: secret:'short",
        "",
        None,
        "word " * 20_000 + draw(hexes, 32),
        "(" + draw(base62, 44) + ") (" + draw(base62 + "+/", 86) + "==)",
        "(" + "thequickbrownfoxandthelazydog" + ") " + "=" * 40 + " " + "-" * 60 + " aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
        "see/the/path/of/all/the/pages/and/more/of/the/same abcabcabcabcabcabcabcabcabcabcabcabcabc",
    ]
    return [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3])]


@pytest.fixture(scope="module")
def scanned(spark):
    frame = spark.createDataFrame(secret_documents(), SCHEMA).withColumns({"row": F.lit(1), "token": F.lit("x"), "base": F.lit(0)})
    found = secrets.find_secrets(frame)
    return found.select("doc_id", secrets.spelled("base").alias("base"), secrets.spelled("found").alias("found")).collect()


def test_base_spans_match_the_patterns(scanned):
    want = sorted((repr(i), spelled(plain_spans(t))) for i, t in secret_documents())
    assert sorted((repr(r.doc_id), r.base) for r in scanned) == want


def test_random_tokens_are_added_and_ordinary_ones_are_not(scanned):
    extra = {r.doc_id: [s for s in r.found.split(",") if s.startswith("random")] for r in scanned if r.doc_id is not None}
    assert extra[8] == ["random:1:45", "random:48:136"] and extra[9] == [] and extra[10] == []
    for r in scanned:
        assert set(filter(None, r.base.split(","))) <= set(r.found.split(","))


def test_the_value_of_an_assignment_is_tested_on_its_own(spark):
    rng = np.random.default_rng(15)
    letters = list("+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
    name = "AWS_SECRET_ACCESS_KEY="
    texts, spans = [], []
    for i in range(300):
        value = "".join(rng.choice(letters, 40)) + "==" * (i % 2)
        before, after = [(name, ""), (name + '"', '"'), ("https://host.example/path?sig=", "&x=1"), ("x ", " y")][i % 4]
        texts.append((i, before + value + after))
        spans.append((len(before), len(before) + len(value)))
    prose = [(1000 + i, "_".join(rng.choice(["the", "and", "ing", "tion", "er"], 12))) for i in range(300)]
    rows = secrets.scan(spark.createDataFrame(texts + prose, SCHEMA)).where("doc_id < 1000").collect()
    for r in rows:
        assert spans[r.doc_id] in {(t.start, t.end) for t in r.tokens}
    found = secrets.find_secrets(spark.createDataFrame(texts + prose, SCHEMA)).where("doc_id < 1000").collect()
    kept = [spans[r.doc_id] in {(s.start, s.end) for s in r.found} for r in found]
    for form in range(4):
        assert sum(k for r, k in zip(found, kept) if r.doc_id % 4 == form) >= 68


def test_uniform_tokens_are_seldom_rejected_and_prose_nearly_always(spark):
    rng = np.random.default_rng(13)
    letters = list("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
    random = [("".join(rng.choice(letters, int(n))), True) for n in rng.integers(24, 90, 400)]
    prose = [("".join(rng.choice(["the", "and", "ing", "tion", "er"], 14)), False) for _ in range(400)]
    rows = spark.createDataFrame(random + prose, "token string, random boolean")
    tested = secrets._with_tests(rows).select("token", "random", "p", "bits").cache()
    limit, mean = secrets.threshold(tested)
    kept = tested.where(F.col("p") * mean / F.col("bits") > limit).groupBy("random").count().collect()
    counts = {r.random: r["count"] for r in kept}
    assert counts[True] > 380 and counts.get(False, 0) < 8


def plain_tests(token):
    """p-value and bits of a token, one test after the other."""
    letters = next((a for pattern, a in secrets.ENCODINGS if re.search(pattern, token)), None)
    bare = token.rstrip("=") if letters else token
    letters = letters or "+-/0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
    codes, n, width = [letters.index(c) + 1 for c in bare], len(bare), len(letters)
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    expected = n / width
    chi = sum((Counter(codes)[c] - expected) ** 2 / expected for c in range(1, width + 1))
    ps = [tail((chi - width + 1) / math.sqrt(2 * (width - 1) * (n - 1) / n))]
    sides = [c > width / 2 for c in codes]
    high, low = sum(sides), n - sum(sides)
    runs = 1 + sum(a != b for a, b in zip(sides, sides[1:]))
    spread = 2 * high * low * (2 * high * low - n) / (n * n * (n - 1))
    ps.append(2 * tail(abs((runs - 2 * high * low / n - 1) / math.sqrt(spread) if spread > 0 else 8)))
    mean = sum(codes) / n
    around = sum((c - mean) ** 2 for c in codes)
    lagged = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:]))
    ps.append(2 * tail(abs((lagged / around + 1 / n) * math.sqrt(n) if around > 0 else 8)))
    return min(1, 3 * min(ps)), n * math.log2(width)


def test_added_spans_match_a_plain_version(spark):
    rng = np.random.default_rng(16)
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    some = lambda: draw("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/"[: int(rng.choice([10, 36, 62, 64]))], int(rng.integers(15, 70)))
    parts = [some, lambda: draw("0123456789abcdef", 30), lambda: "token=" + some(), lambda: "the-path-of-all-the-pages", lambda: "é " + "ab" * 15, lambda: "password"]
    docs = [(i, " ".join(parts[int(k)]() for k in rng.integers(0, 6, int(rng.integers(0, 40))))) for i in range(60)]
    tested = []
    for i, t in docs:
        base = plain_spans(t)
        for m in re.finditer(secrets.TOKEN, t):
            if not any(a < m.end() and m.start() < b for a, _, b in base):
                tested.append((i, m.start(), m.end(), *plain_tests(m[0]), bool(re.fullmatch("[a-z]+|[A-Z]+", m[0]))))
    mean = sum(t[4] for t in tested) / len(tested)
    bins = Counter(math.ceil(max(math.log10(max(p * mean / bits, 1e-300)), secrets.LEAST_LOG) * secrets.BINS_PER_DECADE) for *_, p, bits, _ in tested)
    limits = [10 ** (b / secrets.BINS_PER_DECADE) for b in bins]
    below = lambda x: sum(n for b, n in bins.items() if 10 ** (b / secrets.BINS_PER_DECADE) <= x)
    limit = max([x for x in limits if x <= secrets.FALSE_DISCOVERY * below(x) / len(tested)], default=-1)
    least = lambda wordy: secrets.WORD_BITS if wordy else secrets.MIN_BITS
    want = {i: plain_spans(t) for i, t in docs}
    for i, a, b, p, bits, wordy in tested:
        if p * mean / bits > limit and bits >= least(wordy):
            want[i].append((a, 3, b))
    rows = secrets.find_secrets(spark.createDataFrame(docs, SCHEMA)).collect()
    assert sum(len(v) for v in want.values()) > sum(len(plain_spans(t)) for _, t in docs) and limit > 0
    for r in rows:
        assert [tuple(s) for s in r.found] == sorted(want[r.doc_id])


def test_tokens_that_no_span_touches(spark):
    rng = np.random.default_rng(17)
    cases = []
    for i in range(80):
        cuts = sorted(rng.choice(60, 2 * int(rng.integers(0, 6)), replace=False).tolist())
        spans = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 58, i % 7), rng.integers(1, 9, i % 7))]
        cases.append((i, list(zip(cuts[::2], cuts[1::2])), spans))
    shape = "array<struct<start:int,end:int>>"
    frame = spark.createDataFrame(cases, f"i int, tokens {shape}, spans {shape}")
    for r in frame.withColumn("free", secrets._untouched(F.col("tokens"), F.col("spans"))).collect():
        want = [t for t in r.tokens if not any(s.start < t.end and t.start < s.end for s in r.spans)]
        assert r.free == want


def test_many_matches_in_one_text_take_no_quadratic_time(spark):
    letters = np.array(list("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
    drawn = np.random.default_rng(18).integers(0, 62, (20_000, 32))
    text = " ".join(hashlib.md5(str(i).encode()).hexdigest() + " " + "".join(row) for i, row in enumerate(letters[drawn]))
    began = time.monotonic()
    row = secrets.find_secrets(spark.createDataFrame([(1, text)], SCHEMA)).first()
    # the quadratic form took 106 s for half as many
    assert time.monotonic() - began < 60
    assert [tuple(s) for s in row.base] == plain_spans(text) and len(row.found) > 39_000


def test_the_normal_tail(spark):
    zs = [-3.0, -1.0, 0.0, 0.5, 2.0, 5.0]
    rows = spark.createDataFrame([(z,) for z in zs], "z double").select("z", secrets._tail(F.col("z")).alias("p")).collect()
    for r in rows:
        assert r.p == pytest.approx(math.erfc(r.z / math.sqrt(2)) / 2, abs=1e-7)


def test_the_scan_runs_no_python(spark, small):
    plan = secrets.scan(spark.read.parquet(f"{small}/documents.parquet"))
    text = secrets.find_secrets(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text) and plan.count() == 200


def test_no_documents_no_spans(spark):
    assert secrets.find_secrets(spark.createDataFrame([], SCHEMA)).count() == 0


# pages

LONG = "The man of the house and the dog was in the garden with a friend for the day, as it is on that road by the river and the hills that are not far from the town. "


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>one\n  two<br>three<p>four</article><footer>f</footer>", "T & U\n\none two three\n\nfour"),
        ('<body><div class="ad">buy</div><main><p>Body &lt;b&gt; text.</p><form><p>name</p><input></form><script>var x="</p>";</script></main>', "Body <b> text."),
        (f"<body><h2>Head</h2><p>{LONG * 2}</p><p>Short end.</p><div id=sidebar><p>{LONG * 2}</p></div>", f"Head\n\n{' '.join((LONG * 2).split())}\n\nShort end."),
        (f"<article><p>{LONG}</p><section class='comments'><article><p>{LONG}</p></article></section></article>", LONG.strip()),
        (f"<article><p>a<!-- no > no --><b>b</b></p><aside>x</aside><p>&#x41;&#66;</p><style>p{{}}</style><p>cut &am", "ab\n\nAB\n\ncut &am"),
        ("<div class=nav>never closed<article><p>kept</p></article>", "kept"),
        ("<article><p>open <a href='x>y'>link</a> text that goes on and on</p><p a=\"broken>tail</p></article>", "open link text that goes on and on\n\ntail"),
        (f"<p>{LONG * 2}</p><p><a href=1>{LONG}</a></p><p>© someone</p>", " ".join((LONG * 2).split())),
    ],
)
def test_main_text(html, text):
    assert html_blocks.main_text(html or "") == text


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<p>{LONG * 2}They say that copyright is for the author.</p>", f"{LONG * 2}They say that copyright is for the author."),
        (f"<p>Copyright law is old. {LONG * 2}</p><p>Site copyright of A</p>", f"Copyright law is old. {LONG * 2}".strip()),
        (f"<p>{LONG * 2}</p><p>Copyright 2020 by A. {LONG * 2}</p><p>© A. {LONG * 2}</p>", (LONG * 2).strip()),
        ("<article><p>area <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>a=2</annotation></math> holds</p></article>", "area a=2 holds"),
        ("<article><p>see <object data=x><param name=y>the chart as text</object></p><noscript>plain</noscript></article>", "see the chart as text\n\nplain"),
        ("<article><p>press <button>Go</button> now</p></article>", "press Go now"),
    ],
)
def test_prose_on_copyright_and_fallback_content_stay(html, text):
    assert html_blocks.main_text(html) == text


RUSSIAN = "Мы пришли к реке рано утром, и вода была ещё холодной. Потом солнце поднялось над лесом, и все стали петь. "
ITALIAN = "Siamo arrivati al fiume di mattina presto e l'acqua era ancora fredda. Poi il sole si alzò sopra il bosco e tutti cantarono. "
CHINESE = "我们清晨来到河边，水还很冷。后来太阳升到树林上面，大家都开始唱歌。" * 4


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<div class='wrap has-sidebar'><p>{LONG * 2}</p></div>", (LONG * 2).strip()),
        (f"<div id=page class='no-sidebar'><p>{LONG * 2}</p></div><div class='sidebar-left'><p>{LONG * 2}</p></div>", (LONG * 2).strip()),
        ("<article><div class='article-header'><h1>T</h1></div><h2><a href=x>Linked</a></h2><p>b</p></article>", "T\n\nLinked\n\nb"),
        ("<article><section class='related-work'><p>a</p></section><p class='press-comment'>b</p></article>", "a\n\nb"),
        ("<article><ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul></article>", "one\n\ntwo"),
        ("<article><p hidden>x</p><p class='advert'>buy</p><p style='display: none'>y</p><p>kept</p></article>", "kept"),
        ("<article><header><h1>T</h1></header><p>a</p><div class='post-comments'><p>b</p></div><p class=user-comment>c</p></article>", "T\n\na"),
        (f"<div class='main-nav'><p>{LONG * 2}</p></div><div class=page-header>{LONG * 2}</div><p>{LONG * 2}</p>", (LONG * 2).strip()),
        *((f"<div><a href=x>m</a></div><h1>T</h1><p>{t * 3}</p><p>{t}</p>", f"T\n\n{(t * 3).strip()}\n\n{t.strip()}") for t in (RUSSIAN, ITALIAN, CHINESE)),
        (f"<p>{'shoes red cheap size '* 20}</p><p>{LONG * 2}</p>", (LONG * 2).strip()),
    ],
)
def test_names_hidden_blocks_linked_headings_and_other_languages(html, text):
    assert html_blocks.main_text(html) == text


def test_generated_pages_give_exactly_their_article():
    rng = np.random.default_rng(19)
    pick = lambda *values: values[int(rng.integers(len(values)))]
    for _ in range(300):
        prose = pick(LONG, RUSSIAN, ITALIAN)
        wanted = [f"Title {rng.integers(99)}"] + [prose * int(rng.integers(2, 4)) + f"End {i}." for i in range(rng.integers(2, 6))]
        wanted = [" ".join(w.split()) for w in wanted]
        body = "".join(f"<h1>{w}</h1>" if i == 0 else f"<p>{w}</p>" for i, w in enumerate(wanted))
        junk = lambda: pick(
            f"<div class='{pick('ad-slot', 'cookie-notice', 'site-footer', 'share-buttons', 'newsletter signup')}'><p>{prose * 2}</p></div>",
            f"<{pick('nav', 'aside', 'footer')}><ul><li>{prose}</li><li><a href=x>y</a></li></ul></{pick('nav', 'aside', 'footer')}>",
            "<ul><li><a href=1>Home page</a></li><li><a href=2>All about the news</a></li></ul>",
            f"<form><p>{prose}</p></form>",
            f"<div class='comment-list'><article><p>{prose * 2}</p></article></div>",
            f"<p hidden>{prose * 2}</p>",
            f"<script>var a = '<p>{prose}</p>'</script>",
        )
        junk_well = lambda: "".join(j for j in (junk() for _ in range(int(rng.integers(0, 4)))) if not re.match(r"<(nav|aside|footer)", j) or j.endswith(f"</{j[1:j.index('>')]}>"))
        holder = pick("<article>{}</article>", "<main class='no-sidebar'>{}</main>", "<div class='layout has-sidebar'>{}</div>")
        html = f"<html><head><title>x</title></head><body>{junk_well()}{holder.format(body)}{junk_well()}</body></html>"
        assert html_blocks.main_text(html) == "\n\n".join(wanted)


def test_short_blocks_inherit_from_the_nearest_decided_block():
    block = lambda text, place="": html_blocks.Block(text, 0, place, False)
    good, bad = block(LONG * 2), block("menu", "furniture")
    assert html_blocks.classify([bad, block("a"), good, block("b"), block("c"), bad]) == [False, False, True, True, False, False]
    assert html_blocks.classify([good, block("x"), good]) == [True] * 3


def test_pages_are_extracted_row_by_row(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    rows = html_blocks.extract(pages.withColumn("text", F.lit(1))).collect()
    htmls = {r.page_id: r.html for r in pages.collect()}
    assert len(rows) == len(htmls)
    for r in rows:
        assert r.text == html_blocks.main_text(htmls[r.page_id]) and r.n_chars == len(r.text)
        assert r.text and not re.search(r"</?(p|h1|nav)>", r.text)


def test_a_long_broken_page_takes_linear_time():
    assert html_blocks.main_text("<article>" + "<p>x" * 60_000 + "<b '" * 20) != ""


# vectors


def plain_nearest(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 8:
            good.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    result = {}
    for q in good:
        if q % 20 == 0:
            scores = [(-max(float(np.dot(v, w)) for v in good[i] for w in good[q]), i) for i in good if i != q]
            result[q] = [i for _, i in sorted(scores)[:k]]
    return result


def vectors(n, hot=0):
    rng = np.random.default_rng(14)
    centres = rng.standard_normal((6, 8)) * 2
    rows = [(i, (centres[rng.integers(0, 6)] + rng.standard_normal(8)).tolist()) for i in range(n)]
    rows += [(n + i, [1.0] * 8) for i in range(hot)]
    return rows + [(100_000, None), (100_020, []), (100_040, [0.0] * 8), (100_060, [1.0] * 7), (100_080, [None] + [1.0] * 7),
                   (100_100, [float("nan")] + [1.0] * 7), (100_120, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]


def search(spark, rows, k=20):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"list": F.lit(1), "id": F.lit(2)}).repartition(3)
    found = {}
    for r in adaptive_scan.nearest(frame, F.col("vec_id") % 20 == 0, k).collect():
        found.setdefault(r.query_id, []).append(r)
    return {q: sorted(rs, key=lambda r: r["rank"]) for q, rs in found.items()}


def test_vectors_reach_the_recall_and_exact_scores(spark):
    rows = vectors(3000, hot=400)
    found, want = search(spark, rows), plain_nearest(rows, 20)
    assert set(found) == set(want)
    values = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and len(v) == 8 and None not in v}
    hits = total = 0
    for q, rs in found.items():
        assert [r["rank"] for r in rs] == list(range(1, 21))
        assert all(r.score == pytest.approx(float(values[q] @ values[r.vec_id]), rel=1e-12) for r in rs)
        assert [(-r.score, r.vec_id) for r in rs] == sorted((-r.score, r.vec_id) for r in rs)
        assert q not in {r.vec_id for r in rs}
        want_scores = sorted((float(values[q] @ values[i]) for i in want[q]), reverse=True)
        hits += sum(r.score >= want_scores[-1] - 1e-9 for r in rs)
        total += 20
    assert hits / total >= 0.95


def test_the_scan_alone_reaches_the_recall_with_far_more_vectors_than_the_sample(spark, monkeypatch):
    monkeypatch.setattr(adaptive_scan, "SAMPLE", 256)
    rows = vectors(3400)
    want = plain_nearest(rows, 20)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    best, asked = adaptive_scan.scanned(frame, F.col("vec_id") % 20 == 0, 20)
    found = {}
    for r in best.collect():
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert asked.count() == len(want)
    hits = sum(len(set(ids) & {i for _, i in sorted(found.get(q, []))[:20]}) for q, ids in want.items())
    assert hits / sum(map(len, want.values())) >= 0.95


def test_the_sample_fills_only_queries_whose_scan_finds_too_few(spark, monkeypatch):
    monkeypatch.setattr(adaptive_scan, "SAMPLE", 256)
    plain = adaptive_scan.Index.sample_best

    def marked(self, ids, queries):
        names, scores = plain(self, ids, queries)
        return [n + 1_000_000 for n in names], scores

    rows = vectors(3400)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    monkeypatch.setattr(adaptive_scan.Index, "sample_best", marked)
    best, _ = adaptive_scan.scanned(frame, F.col("vec_id") % 20 == 0, 20)
    enough = {r.query_id for r in best.groupBy("query_id").count().where("count >= 20").collect()}
    assert len(enough) > 100
    found = search(spark, rows)
    assert all(r.vec_id < 1_000_000 for q in enough for r in found[q])
    assert all(len(rs) == 20 for rs in found.values())


def test_few_vectors_are_all_returned(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [1.0, 1.0]), (3, [1.0, 1.0])]
    found = search(spark, rows)
    assert [r.vec_id for r in found[0]] == [3, 4, 20] and [r.vec_id for r in found[20]] == [3, 4, 0]


def test_no_usable_vectors(spark):
    assert search(spark, [(0, None), (20, [0.0])]) == {}
    assert search(spark, [(0, [1.0])]) == {}


def test_recall_on_the_embeddings(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(small.replace("0.001", "0.1") + "/embeddings.parquet").collect()]
    matrix = np.array([v for _, v in sorted(rows)], float)
    ids = np.array(sorted(i for i, _ in rows))
    found = search(spark, rows)
    shares = []
    for at in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[at]
        scores[at] = -np.inf
        best = set(ids[np.argsort(-scores, kind="stable")[:20]].tolist())
        shares.append(len(best & {r.vec_id for r in found[ids[at]]}) / 20)
    assert np.mean(shares) >= 0.9


# language model


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    params = {k: v.astype(np.float64) * 3 for k, v in recurrent.initial(rng.random(1024) * 9).items()}
    x, y = rng.integers(0, 1024, (5, 3)), rng.integers(0, 1024, (5, 3))
    starts = np.zeros((5, 3), bool)
    starts[2, 1] = True
    state = rng.standard_normal((3, recurrent.HIDDEN))

    def loss():
        kept, _ = recurrent._forward(params, x, starts, state.copy())
        return -recurrent._log_probabilities(params, np.concatenate([k[5] for k in kept]), y.ravel()).sum() / 15

    grads, _ = recurrent._gradients(params, x, starts, y, np.ones((5, 3)), state.copy())
    for name in recurrent.NAMES:
        at = int(np.abs(grads[name]).argmax())
        flat = params[name].reshape(-1)
        kept = flat[at]
        flat[at] = kept + 1e-5
        above = loss()
        flat[at] = kept - 1e-5
        assert (above - loss()) / 2e-5 == pytest.approx(grads[name].ravel()[at], rel=1e-4)
        flat[at] = kept


def test_symbol_probabilities_sum_to_one_and_state_crosses_windows():
    rng = np.random.default_rng(1)
    params = recurrent.initial(rng.random(1024) * 99, seed=4)
    params = {n: p * 4 if n in ("inner", "table", "class_w") else p for n, p in params.items()}
    prefix = rng.integers(0, 1024, 150).astype(np.int32)
    base = recurrent.score_texts(params, [prefix])[0]
    longer = [np.append(prefix, s).astype(np.int32) for s in range(1024)]
    total = np.exp(recurrent.score_texts(params, longer) - base).sum()
    assert total == pytest.approx(1, abs=1e-3)
    # alone or beside others, with other lanes: the same score
    texts = [rng.integers(0, 1024, int(n)).astype(np.int32) for n in rng.integers(1, 300, 40)]
    together = recurrent.score_texts(params, texts, lanes=7)
    assert together == pytest.approx([recurrent.score_texts(params, [t])[0] for t in texts], rel=1e-4)


def test_training_learns_an_order_that_counts_do_not_show():
    rng = np.random.default_rng(2)
    texts = [np.array([2 + (s + i) % 40 for i in range(60)] + [0], np.int32) for s in rng.integers(0, 40, 300)]
    counts = np.bincount(np.concatenate(texts), minlength=1024)
    start = recurrent.initial(counts)
    trainer = recurrent.Trainer(start)
    for _ in range(6):
        trainer.train(texts)
    assert recurrent.score_texts(trainer.params, texts).mean() > 0.3 * recurrent.score_texts(start, texts).mean()


def test_words_split_on_ascii_white_space_only():
    import pyarrow as pa

    texts = [" A\tb\x0bC\x0cd\r\ne ", None, "", "é\x85x Y", "\x1cz"]
    words, ends = lm_scoring.words_of(pa.array(texts, pa.string()))
    lowered = [(t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split() for t in texts]
    assert [w.encode() for w in words.to_pylist()] == [w for ws in lowered for w in ws]
    assert ends.tolist() == np.cumsum([len(w) for w in lowered]).tolist()


def check_scores(rows, docs):
    tokens = [(i, (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split() + [None]) for i, t in docs]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (repr(i), held(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6))
        for i, ws in tokens
    )
    got = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], abs=2e-6)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


@pytest.mark.parametrize("known", [lm_scoring.KNOWN, 500, 0])
def test_scores_of_all_documents(spark, small, monkeypatch, known):
    monkeypatch.setattr(lm_scoring, "KNOWN", known)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    docs += [(None, "the end"), (9001, None), (9002, ""), (9003, "unseen " * 5000), (1, docs[1][1])]
    frame = spark.createDataFrame(docs, SCHEMA).withColumns({"word": F.lit(1), "row": F.lit(2)}).repartition(3)
    check_scores(lm_scoring.score_documents(frame).collect(), docs)


def test_held_out_documents_score_better_than_by_counts(spark, small):
    root = small.replace("0.001", "0.01")
    rows = lm_scoring.score_documents(spark.read.parquet(f"{root}/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert np.mean([r.score > r.base_score for r in rows]) > 0.7


def test_scores_do_not_follow_the_partitions_and_beat_the_counts(spark, small, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PART_TOKENS", 2048)  # several parts, as in a large corpus
    docs = spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet")
    seen = []
    for parts in (1, 16, 128):
        rows = lm_scoring.score_documents(docs.repartition(parts)).collect()
        seen.append({r.doc_id: r.score for r in rows})
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)
    for other in seen[1:]:
        assert other == pytest.approx(seen[0], rel=1e-4)


def test_a_part_gives_one_vector_however_many_partitions_the_session_asks_for(spark, small, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PART_TOKENS", 2048)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plain = {r.doc_id: r.score for r in lm_scoring.score_documents(docs).collect()}
    frame = type(docs)
    monkeypatch.setattr(
        frame, "repartition", lambda self, n, *cols, f=frame.repartition: f(self, max(n, 97) if cols else n, *cols)
    )
    raised = {r.doc_id: r.score for r in lm_scoring.score_documents(docs).collect()}
    assert raised == pytest.approx(plain, rel=1e-4)
    coded = spark.range(5000).select(F.col("id").alias("key"), F.col("id").alias("doc_id"), F.lit(False).alias("held_out"), F.lit(b"").alias("symbols"))
    for parts in (1, 5, 40):
        dealt = lm_scoring.deal(coded, 0, parts).groupBy(F.spark_partition_id()).count().collect()
        assert sorted(r[0] for r in dealt) == list(range(parts))


def test_logits_beyond_the_range_of_exponentials_give_the_same_probabilities():
    rng = np.random.default_rng(6)
    params = recurrent.initial(rng.random(1024) * 9)
    texts = [rng.integers(0, 1024, 70).astype(np.int32) for _ in range(5)]
    plain = recurrent.score_texts(params, texts)
    for shift in (-300, 300):
        moved = {n: v + np.float32(shift) if n in ("group_b", "class_b", "word_b") else v for n, v in params.items()}
        assert recurrent.score_texts(moved, texts) == pytest.approx(plain, rel=1e-3)


def test_sums_of_runs_add_up_all_rows_of_a_key():
    rng = np.random.default_rng(7)
    keys = np.sort(np.concatenate([rng.integers(0, 50, 400), np.full(333, 7), [99]]))
    rows = rng.standard_normal((len(keys), 3))
    seen, sums = recurrent._sums_of_runs(keys, rows.copy())
    assert seen.tolist() == sorted(set(keys.tolist()))
    assert sums == pytest.approx(np.array([rows[keys == k].sum(axis=0) for k in seen]))


def test_scores_are_those_of_the_model_token_by_token():
    rng = np.random.default_rng(20)
    params = {n: v.astype(np.float64) * 2 for n, v in recurrent.initial(rng.random(400) * 9).items()}
    text = rng.integers(0, 400, 90).astype(np.int32)
    side, singles, members = recurrent.tree(400)
    sigmoid, h = lambda x: 1 / (1 + np.exp(-x)), recurrent.HIDDEN
    log_softmax = lambda x: x - np.log(np.exp(x).sum())
    state, total, before = np.zeros(h), 0.0, recurrent.END
    for symbol in text.tolist():
        outer, inner = params["table"][before] + params["bias"], state @ params["inner"]
        update, reset = sigmoid(outer[:h] + inner[:h]), sigmoid(outer[h : 2 * h] + inner[h : 2 * h])
        state = update * state + (1 - update) * np.tanh(outer[2 * h :] + reset * inner[2 * h :])
        node = symbol if symbol < singles else singles + (symbol - singles) // members
        total += log_softmax(state @ params["group_w"] + params["group_b"])[node // side]
        total += log_softmax(state @ params["class_w"][node // side] + params["class_b"][node // side])[node % side]
        if symbol >= singles:
            total += log_softmax(state @ params["word_w"][node - singles] + params["word_b"][node - singles])[(symbol - singles) % members]
        before = symbol
    assert recurrent.score_texts(params, [text])[0] == pytest.approx(total, rel=1e-4)


def test_every_training_token_reaches_a_gradient_and_frequent_words_have_symbols(spark, monkeypatch):
    docs = [(i, " ".join(f"w{(i * 7 + j) % 3000}" for j in range(10 + i % 150))) for i in range(300)]
    counts = Counter(w for i, t in docs if not lm_scoring.held_out(i) for w in t.split())
    names = sorted(counts, key=lambda w: -counts[w])
    ends = sum(not lm_scoring.held_out(i) for i, _ in docs)
    tokens = sum(counts.values()) + ends
    words = lm_scoring.Lexicon(names, [counts[w] for w in names], ends, tokens, len(names) + 1)
    assert words.vocabulary >= len(names) and words.rare_tokens == 0
    start = recurrent.flat(recurrent.initial(words.symbol_counts()))
    monkeypatch.setattr(lm_scoring, "TaskContext", type("Context", (), {"get": classmethod(lambda c: c), "partitionId": lambda *a: 0}))
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in docs])
    made = list(lm_scoring._train_task(words, start)(iter([batch])))
    assert made[0].column("tokens")[0].as_py() == tokens


def test_scores_without_training_documents(spark):
    assert lm_scoring.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(50) if lm_scoring.held_out(i))
    row = lm_scoring.score_documents(spark.createDataFrame([(held, "a b")], SCHEMA)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.base_score == pytest.approx(0)


# registration


def test_every_operator_has_one_query():
    import __spark_entry__ as contract

    numbers = sorted(int(k[2:].split("_")[0]) for k in contract.queries() if re.match(r"op\d+_", k))
    assert numbers == list(range(1, 14))
    assert "pipeline" in contract.queries() and "op2_line_dedup" in contract.oracle_sql()


def test_digests_of_the_secret_query(spark, small):
    import __spark_entry__ as contract

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in contract.queries()["op7_randomness_battery"](spark, small).collect():
        assert r.base_sha256 == hashlib.sha256(spelled(plain_spans(texts[r.doc_id])).encode()).hexdigest()
