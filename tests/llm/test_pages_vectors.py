"""URL filter, toxicity, page texts, vectors and the pipeline."""

import math
import random
import time
import tracemalloc
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyloom.llm import embedding_dedup, html_extract, toxicity, url_filter
from skyloom.llm.queries import ORACLES, QUERIES


def test_rules_and_parts(spark):
    rows = [
        (1, "http://a.b.net/x?q#f", "a.b.net", "/x", "net/", "block"),
        (2, "https://WWW.Example.NET/en/1", "www.example.net", "/en/1", "example.net/en/", "allow"),
        (3, "http://example.com/de/9#x", "example.com", "/de/9", "example.com/de/", "block"),
        (4, "http://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
        (5, "http://planet/x", "planet", "/x", None, None),
        (6, "http://x.net", "x.net", "", None, None),
        (7, None, "", "", None, None),
        (8, "no scheme/x", "", "", None, None),
        (9, "ftp://h?x://y/z", "h", "", None, None),
        (10, "a://b://c.net/x", "b:", "//c.net/x", None, None),
        (1, "http://a.b.net/x?q#f", "a.b.net", "/x", "net/", "block"),
    ]
    pages = spark.createDataFrame(
        [(p, u, "<p>cheap pills free news</p>" if p != 7 else None, "clash") for p, u, *_ in rows],
        "page_id long, url string, html string, host string",
    )
    found = sorted(url_filter.judge_urls(pages).collect(), key=lambda r: (r.page_id, r.host))
    for row, (page_id, _, host, path, rule, verdict) in zip(found, sorted(rows, key=lambda r: r[0]), strict=True):
        assert (row.page_id, row.host, row.path, row.rule) == (page_id, host, path, rule)
        assert row.verdict in ("allow", "block") and verdict in (None, row.verdict)
    assert url_filter.judge_urls(pages.where("false")).count() == 0


def test_segmentation_is_the_best_split():
    counts, total = {"the": 50, "there": 9, "in": 40, "rein": 2, "cheap": 3, "pills": 3}, 107

    def cost(words):
        return sum(math.log(total / counts[w]) if w in counts else math.log(total + 1) + 2.3 * len(w) for w in words)

    def splits(text):
        if not text:
            yield []
        for k in range(1, len(text) + 1):
            for rest in splits(text[k:]):
                yield [text[:k], *rest]

    for label in ("therein", "cheappills", "xthe", "inin"):
        best = min(cost(s) for s in splits(label))
        assert cost(url_filter.split_label(label, counts, total)) == pytest.approx(best)
    assert url_filter.split_label("cheappills", counts, total) == ["cheap", "pills"]


def test_unwanted_hosts_are_blocked(spark):
    hosts = ["cheappills.example.com", "m.free-bets.example.org", "thrush.example.com", "morning.example.org"]
    pages = spark.createDataFrame(
        [(k, f"http://{h}/en/{k}", "thrush morning") for k, h in enumerate(hosts)]
        + [(10 + k, f"http://h{k}.net/en/{k}", "x") for k in range(20)]
        + [(50 + k, f"http://h{k}.org/fr/{k}", "x") for k in range(20)],
        "page_id long, url string, html string",
    )
    found = {r.page_id: r.verdict for r in url_filter.judge_urls(pages).collect()}
    assert [found[k] for k in range(4)] == ["block", "block", "allow", "allow"]


def test_unlisted_words_are_learned_from_rules(spark):
    pages = spark.createDataFrame(
        [(k, f"http://zorblax.h{k}.net/es/{k}", "zorblax quillon") for k in range(40)]
        + [(50 + k, f"http://quillon.h{k}.org/fr/{k}", "x") for k in range(40)]
        # votes that hold neither word do not dilute it
        + [(1000 + k, f"http://w{chr(97 + k % 26)}{chr(97 + k // 26)}.{'net/es' if k % 2 else 'org/fr'}/", "x") for k in range(600)]
        + [(100, "http://zorblax.example.com/en/1", "x"), (101, "http://quillon.example.com/en/1", "x")]
        # the segment that rules look at tells nothing
        + [(102, "http://morning.example.org/es/1", "x"), (103, "http://casino.example.org/en/1", "x")],
        "page_id long, url string, html string",
    )
    found = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert [found[k] for k in range(100, 104)] == [(None, "block"), (None, "allow"), (None, "allow"), (None, "block")]


@pytest.fixture(scope="module")
def toxic(spark):
    draw = random.Random(2)
    plain = [f"word{k}" for k in range(300)]
    docs, labels = [], []
    for k in range(600):
        sentences = [" ".join(draw.choice(plain) for _ in range(8)) for _ in range(draw.randrange(1, 9))]
        bad = k % 7 == 0
        if bad:
            where = draw.randrange(len(sentences))
            sentences[where] += " " + draw.choice(["Idiot", "scummy", "scumbag", "vile"])
        docs.append((k, ". ".join(sentences) + ".", 0.5))
        if k % 3:
            labels.append((k, int(bad), "x"))
    docs += [(None, None, 0.1), (9_000, "", 0.1), (9_001, "VILE!", 0.1), (9_001, "VILE!", 0.1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score double"),
        spark.createDataFrame([*labels, (None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, text string"),
    )


def test_toxicity_on_held_out_rows(toxic):
    docs, labels = toxic
    found = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    for doc_id, row in found.items():
        assert row.held_out == (doc_id is None or zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    wrong = [k for k in range(600) if found[k].predicted != int(k % 7 == 0)]
    assert len(wrong) <= 6
    assert found[9_000].predicted == 0 and found[None].predicted == 0 and found[9_001].predicted == 1
    model = toxicity.train(docs, labels)
    places = toxicity.offending_sentences(docs, model).collect()
    assert places and all(
        any(w in r.sentence.lower() for w in ("idiot", "scum", "vile")) for r in places
    )


def test_training_rows_are_bounded(spark, toxic):
    """One labelled id with many rows, some of them equal, takes no more than its share."""
    _, labels = toxic
    rows = [(1, f"text {k % 300}", 0.0) for k in range(500)] + [(4, "same", 0.0)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    assert toxicity._labelled(docs, labels, 5).count() == 5
    whole = toxicity._labelled(docs, labels, 10_000)
    assert sorted(r.text for r in whole.collect()) == sorted({t for _, t, _ in rows})


def _log_chance(bags, weights, bias):
    """Log of the chance that neither the leak nor a sentence is toxic, term by term."""
    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    clean = 1 - sigmoid(bias)
    for bag in bags:
        clean *= (1 - sigmoid(bias + sum(weights[f] for f in bag))) / (1 - sigmoid(bias))
    return np.log(clean)


def test_likelihood_and_score_against_brute_force():
    draw = np.random.default_rng(5)
    documents = [
        (int(draw.random() < 0.4), [sorted(set(draw.integers(0, 6, 3).tolist())) for _ in range(draw.integers(0, 4))])
        for _ in range(40)
    ]
    theta = np.append(draw.random(6) * 3, -2.0)
    value, gradient = toxicity.NoisyOr.log_likelihood(theta, documents)
    share = np.mean([d[0] for d in documents])
    expected = 0.0
    for label, bags in documents:
        none = _log_chance(bags, theta[:-1], theta[-1])
        if label:
            expected += 0.5 / share * min(1.0, 4 * share) * np.log1p(-np.exp(none)) / len(documents)
        else:
            expected += 0.5 / (1 - share) * none / len(documents)
    assert value == pytest.approx(expected, rel=1e-9)
    for k in range(len(theta)):
        step = np.zeros_like(theta)
        step[k] = 1e-6
        up, down = (toxicity.NoisyOr.log_likelihood(theta + s * step, documents)[0] for s in (1, -1))
        assert gradient[k] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-8)
    number = {f"w{c}": k for k, c in enumerate("abcdef")}
    model = toxicity.ToxicityModel(number, toxicity.NoisyOr(theta[:-1], -7.0), 0.1)
    for text in ("", None, "wb wc. quiet words! WF", "wa\nwa\nwa . nothing", "x. " * 5000, "wd. " * 5000):
        bags = [{number[w] for w in s.lower().split() if w in number} for s in (text or "").replace("!", ".").replace("\n", ".").split(".")]
        expected = -np.expm1(_log_chance([b for b in bags if b], theta[:-1], -7.0))
        assert model.score(text, {}) == pytest.approx(expected, rel=1e-9)


def test_toxicity_without_labels(toxic):
    docs, labels = toxic
    assert {r.score for r in toxicity.judge(docs, labels.where("false")).collect()} == {0.0}
    assert toxicity.judge(docs.where("false"), labels).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body><header class="top">Site</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad -->
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><article><h1>Title &amp; more</h1>
<p><b>Bold {0}.<br><p>Some <i>in</i>line&nbsp;text,
 wrapped {0} &lt;3.</p><ul><li>first<li>second</ul><form><input>Go</form>
<section id="comments"><p>Reader says</p></section></article><aside>Side</aside><footer>&copy; h</footer>"""


def test_main_text(spark):
    expected = "Title & more\n\nBold {0}.\n\nSome inline text, wrapped {0} <3.\n\nfirst\n\nsecond"
    rows = [(k, f"http://h.example/{k}", PAGE.format(k)) for k in range(6)]
    rows += [(20, "http://h.example/0", PAGE.format(0)), (21, None, PAGE.format(21)), (22, "http://o.example/", None)]
    rows += [(23, "x", ""), (24, "http://p.example/", "<div class=menu>no</div><div>plain</div>text<script>x")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, token int")
    found = {r.page_id: r for r in html_extract.extract_main_text(pages).collect()}
    for k in (*range(6), 21):
        assert found[k].text == expected.format(k)
    assert found[20].text == expected.format(0) and found[20].n_chars == len(expected.format(0))
    assert found[22].text == found[23].text == "" and found[23].n_chars == 0
    assert found[24].text == "plain\n\ntext"
    assert html_extract.extract_main_text(pages.where("false")).count() == 0


def test_equal_vectors_share_a_class(spark):
    pages = spark.createDataFrame(
        [(k, "h", PAGE.format(k) + "<div class=x>" * k) for k in range(1, 4)], "page_id long, host string, html string"
    )
    rows = html_extract.host_templates(pages).collect()
    once = {r.token.rpartition("/")[2].partition(".")[0]: r for r in rows if r.at_once}
    assert {"article", "nav", "footer", "body"} <= set(once)
    assert once["nav"].vector == once["article"].vector
    root, valid = html_extract.nested([r.asDict() for r in rows])
    assert root <= valid and any(t.endswith("/article") for t in root)


def test_long_hosts_grow_in_proportion(spark):
    """A label of 40,000 letters and a host of 20,000 labels are split like short ones."""
    draw = random.Random(3)
    label = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(38_000)) + "cheappills" * 200
    dotted = ".".join(draw.choice(["cheap", "pills", "news"]) for _ in range(20_000))
    hosts = [label, f"{label}.net", dotted, "cheappills.example.com"]
    pages = spark.createDataFrame(
        [(k, f"http://{h}/es/{k}", "cheap pills free news") for k, h in enumerate(hosts)], "page_id long, url string, html string"
    )
    found = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    assert [found[k].host for k in range(4)] == hosts and found[1].rule == "net/" and found[3].verdict == "block"
    counts = url_filter.word_counts(pages)
    words = url_filter.segment_labels(spark.createDataFrame([(label,), ("cheappills",)], "label string"), counts)
    split = {r.label: r.words for r in words.collect()}
    assert "".join(split[label]) == label and split["cheappills"] == ["cheap", "pills"]
    assert split[label][-400:] == ["cheap", "pills"] * 200


def test_pieces_lose_no_word(spark):
    """Words that lie across the ends of pieces are found."""
    label = "xq" * 124 + "morningstars" + "zv" * 124 + "thrush"
    at = [label.index("morningstars"), label.index("thrush")]
    assert at[0] < url_filter.PIECE < at[0] + 12 and at[1] < 2 * url_filter.PIECE < at[1] + 6
    counts = spark.createDataFrame([("morningstars", 5), ("thrush", 4), ("xqxq", 1)], "word string, n long")
    (row,) = url_filter.segment_labels(spark.createDataFrame([(label,)], "label string"), counts).collect()
    known = {r.word: r.n for r in counts.collect()}
    listed = {w: 1 for words in url_filter.SEEDS.values() for w in words}
    assert row.words == url_filter.split_label(label, listed | known, 10)
    assert {"morningstars", "thrush"} <= set(row.words)


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 20_000 + "Text." + "</div>" * 20_000,
        "".join(f'<div class="level{k}x">' for k in range(20_000)) + "Text.",
        "<b>" * 80_000 + "<div>Text.</div>",
        "".join(f"<i><p>t{k}</p></u>" for k in range(30_000)),
    ],
    ids=["nested", "named", "unclosed", "stray"],
)
def test_depth_and_unclosed_tags_grow_in_proportion(page):
    tracemalloc.start()
    began = time.process_time()
    blocks = html_extract.main_blocks(page, html_extract.Template([]))
    events = html_extract.settled(page)
    html_extract.occurrences(events)
    peak, spent = tracemalloc.get_traced_memory()[1], time.process_time() - began
    tracemalloc.stop()
    assert blocks[-1] in ("Text.", "t29999") and peak < 100_000_000 and spent < 20


def test_tokens_of_deep_pages_name_their_parents():
    """Digests of long paths keep the tokens of a page apart and tie each to the token around it."""
    page = "".join(f"<div class=c{k}><p>x</p>" for k in range(300))
    tokens = html_extract.occurrences(html_extract.settled(page))
    parents = {token: parent for token, parent in tokens}
    assert len(tokens) == len(parents) == 600 and set(tokens.values()) == {1}
    assert {p for p in parents.values() if p} <= set(parents) and max(map(len, parents)) < 300
    template = [{"token": t, "parent": p, "at_once": True, "vector": 1} for t, p in tokens]
    assert html_extract.nested(template)[1] == set(parents)


def test_template_survives_odd_pages(spark):
    def page(k):
        cards = "".join(f"<article class=card><p>Card {k} {n}</p></article>" for n in range(k % 3 + 2))
        return f"<html><body><article class=story><p>Story {k}</p></article><div>{cards}</div></body></html>"

    def plain(k):
        return f"<html><body><div><p class=text>Words {k}</p><p class=again>Buy our book</p></div></body></html>"

    rows = [(k, "http://h.example/x", page(k)) for k in range(6)]
    rows += [(10, "http://h.example/x", None), (11, "http://h.example/x", " "), (12, "http://h.example/x", "<p>Broken")]
    rows += [(13, "http://h.example/x", "<div><article><p>Other</p></article></div>")]
    rows += [(20 + k, "http://h.example/x", plain(k)) for k in range(4)]
    # copies of one page are no evidence of constant text
    rows += [(30 + k, "http://c.example/x", plain(1)) for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_extract.extract_main_text(pages).collect()}
    assert [found[k] for k in range(6)] == [f"Story {k}" for k in range(6)]
    assert [found[k] for k in (10, 11, 12, 13)] == ["", "", "Broken", "Other"]
    assert [found[20 + k] for k in range(4)] == [f"Words {k}" for k in range(4)]
    assert {found[30 + k] for k in range(4)} == {"Words 1\n\nBuy our book"}


WRAPPED = [
    ('<div class="layout has-sidebar"><article>{}</article></div>', "T\n\nText"),
    ('<div class="content no-comments"><article>{}</article></div>', "T\n\nText"),
    ('<div id="share-price-report"><main>{}</main></div>', "T\n\nText"),
    ('<div class="post related-news"><div>{}</div></div>', "T\n\nText"),
    ('<div data-id="sidebar" data-role="menu"><article>{}</article></div>', "T\n\nText"),
    ("<form action=x><article>{}</article><input></form>", "T\n\nText"),
    ("<form><div>{}</div></form>", "T\n\nText"),
    ('<div class="widget"><article>{}</article></div>', "T\n\nText"),
    ('<article><header class="entry-header"><h1>Head</h1></header>{}</article>', "Head\n\nT\n\nText"),
    ('<div class="related"><article>No</article></div><article>{}</article>', "T\n\nText"),
    ('<article>{}<div class="related-links">No</div><form>No</form></article>', "T\n\nText"),
    ('<header>No</header><div class="cookie-notice">No</div><div>{}</div>', "T\n\nText"),
]


def test_furniture_spares_what_holds_the_article(spark):
    rows = [(k, f"http://h{k}.example/", f"<body>{p.format('<h1>T</h1><p>Text</p>')}</body>") for k, (p, _) in enumerate(WRAPPED)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_extract.extract_main_text(pages).collect()}
    assert [found[k] for k in range(len(WRAPPED))] == [text for _, text in WRAPPED]


def test_vectors_against_brute_force(spark):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(400, 24))
    near = vectors[:80] + draw.normal(size=(80, 24)) * 0.1
    values = [v.tolist() for v in [*vectors, *near, *near[:30] * 3.0, *vectors[:5]]]
    odd = [None, [], [0.0] * 24, [math.nan] * 24, [math.inf] + [1.0] * 23, [None] * 24, [1.0, 0.0]]
    values += odd + [values[0]] * 40
    rows = [(k, v, "x") for k, v in enumerate(values)]
    frame = spark.createDataFrame([*rows, (None, values[1], "x")], "vec_id long, embedding array<double>, key string")
    found = {r.vec_id: r for r in embedding_dedup.near_duplicate_vectors(frame, recall=0.99999).collect()}
    sound = [k for k, v in enumerate(values) if v and len(v) == 24 and None not in v and np.isfinite(v).all() and any(v)]
    unit = np.array([values[k] for k in sound])
    unit = np.vstack([unit, values[1]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    names = [*sound, None]
    seen, component = set(), {}
    for start in range(len(names)):
        if start in seen:
            continue
        stack, members = [start], []
        while stack:
            k = stack.pop()
            if k not in seen:
                seen.add(k)
                members.append(k)
                stack += np.flatnonzero(linked[k]).tolist()
        least = min(names[k] for k in members if names[k] is not None)
        component |= {names[k]: least for k in members}
    for k, name in enumerate(names):
        row = found[name]
        assert (row.n_links, row.component_id) == (int(linked[k].sum()) - 1, component[name])
        assert row.kept == (name == component[name])
    for k in set(range(len(values))) - set(sound):
        assert (found[k].n_links, found[k].component_id, found[k].kept) == (0, k, True)
    assert embedding_dedup.near_duplicate_vectors(frame.where("false")).count() == 0


def test_vectors_as_registered_against_sql(spark, tmp_path):
    """The registered recall, on planted links at the least cosine, against all pairs in SQL."""
    draw = np.random.default_rng(9)
    base = draw.normal(size=(600, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = draw.normal(size=base.shape)
    away -= (away * base).sum(axis=1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = np.linspace(0.902, 0.96, len(base))[:, None]
    near = cosine * base + np.sqrt(1 - cosine**2) * away
    values = [v.tolist() for v in [*base, *near]] + [None, [], [0.0] * 64, [math.nan] * 64, [1.0], base[0].tolist()]
    rows = [(k, v, k % 3) for k, v in enumerate(values)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    wanted = {r[0]: r[1:] for r in connection.execute(ORACLES["op10_embedding_near_dedup"]).fetchall()}
    assert sum(n for n, *_ in wanted.values()) >= 1200
    result = QUERIES["op10_embedding_near_dedup"](spark, str(tmp_path)).collect()
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in result}
    assert len(result) == len(wanted) == len(values)
    # no link too many, and at most a few of the 1,200 ends missed
    assert all(found[k][0] <= wanted[k][0] for k in wanted)
    assert sum(found[k] != wanted[k] for k in wanted) <= 12


def test_clean_rows_with_a_contaminated_id_stay(spark, tmp_path):
    leak = " ".join(f"leak{k}" for k in range(12))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, leak), (None, "clean"), (None, None), (7, f"x {leak}"), (7, "clean"), (8, leak), (8, leak), (9, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert {tuple(r) for r in kept} == {(None, "clean"), (None, None), (7, "clean"), (9, "z")} and len(kept) == 4


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<article><p title="a"b">First para.</p><p>Second.</p></article>', "First para.\n\nSecond."),
        ("<article><p data-x=don't>First.</p><p>Second isn't.</p></article>", "First.\n\nSecond isn't."),
        ('<article><p title="x > y" lang = \'a>b\'>Kept.</p></article>', "Kept."),
        ('<article><p title="never closed>Text.</p><p>More.</p></article>', "Text.\n\nMore."),
        ("<article><p>E = <math><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math> ends.</p></article>", "E = mc2 ends."),
    ],
)
def test_quotes_in_tags_and_formulas(spark, html, text):
    pages = spark.createDataFrame([(1, "http://a.com/x", f"<html><body>{html}</body></html>")], "page_id long, url string, html string")
    assert html_extract.extract_main_text(pages).first().text == text


#: Names that operators use for columns of their own, and names that need quoting.
CLASHING = [
    "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "_text", "_doc", "_stretches", "_name", "_key", "_n",
    "_score", "_hit", "hit", "hit_key", "name", "key", "n", "row", "id", "doc", "component", "text_key", "score", "a b.c`d",
]


def test_pipeline_stages(spark, tmp_path):
    draw = random.Random(6)
    words = [f"w{k}" for k in range(500)]

    def text(n):
        return " ".join(draw.choice(words) for _ in range(n)) + "."

    passage, leak = text(60), text(14)
    rows = [(k, text(80)) for k in range(200)]
    rows = [(k, t + " Vile idiot." if k % 10 == 0 else t) for k, t in rows]
    rows += [(300, rows[1][1]), (301, rows[1][1]), (302, text(40) + passage + text(9)), (303, text(30) + passage)]
    rows += [(304, text(30) + " " + leak + " " + text(30)), (305, None), (306, ""), (None, text(50))]
    folder = tmp_path / "sf"
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], kind)
    docs = docs.withColumns({name: F.concat(F.lit(name), F.coalesce("doc_id", F.lit(-1))) for name in CLASHING})
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(k, int(k % 10 == 0)) for k in range(200)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, str(folder))
        assert k == 4 or result.dtypes == docs.dtypes
        result.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        kept.append({r.doc_id: r for r in docs.collect()})
        for row in kept[-1].values() if k < 4 else ():
            own = -1 if row.doc_id is None else row.doc_id
            assert [row[name] for name in CLASHING] == [f"{name}{own}" for name in CLASHING]
    assert set(kept[0]) == {d for d, _ in rows if not (d is not None and d < 200 and d % 10 == 0)}
    assert set(kept[1]) == set(kept[0]) - {300, 301, 306}
    assert set(kept[2]) == set(kept[1]) and passage not in kept[2][302].text and passage not in kept[2][303].text
    assert kept[2][5].text == kept[0][5].text
    assert set(kept[3]) == set(kept[2]) - {304}
    assert set(kept[4]) == set(kept[3]) and len(kept[4][5].token_ids) == kept[4][5].n_tokens
    assert corpus_pipeline.run(spark, str(folder)).count() == len(kept[4])
    empty = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(folder)).count() == 0
