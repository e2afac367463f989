"""The operators against brute force on small tables, and their defined results at the edges."""

import itertools
import re
import zlib
from collections import Counter
from math import log10

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelstrata.llm import fingerprint, html, langid, license, lm, mixing, ngram_join, pieces, quality, tokencount
from reelstrata.llm.common import documents, ship, stored
from reelstrata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, ids string, Verdict int, block string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(9_000))
TEXTS = [
    (1, "One two three four five six seven. " * 9, "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n\x0b ", None, "b"),
    (5, "eins zwei drei\nvier, fünf sechs\nvier, fünf sechs", "de", "b"),
    (5, "eins zwei drei\nvier, fünf sechs\nvier, fünf sechs", "de", "b"),
    (7, LONG, "en", "a"),
    (8, "###$$$ %%% ||| <<>>", "fr", None),
    (9, "Licensed under the Apache License, Version 2.0.\nmore words here", "en", "c"),
    (None, "a b c d e f", "en", "c"),
    (11, "東京 ▁ \x00 \U0001f600 ñandú", "es", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(i, t, lang, s, 7, "x", "y", 3, "z") for i, t, lang, s in TEXTS]
    return stored(spark.createDataFrame(rows, SCHEMA).repartition(3), "fixture")


@pytest.fixture(scope="module")
def given(spark):
    ship(spark)
    return documents(spark, FOLDER)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- 1 -------------------------------------------------------------------------------------------------------------


def base_by_hand(text):
    found = words(text)
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    marked = {i + k for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for k in range(3)}
    lines = (text or "").split("\n")
    copies = sum(bool(words(line)) and line in lines[:i] for i, line in enumerate(lines))
    n = len(found)
    return n, sum(map(len, found)), sum(c in "[#*$%&|<>]"[1:-1] for c in text or ""), copies, len(marked), n < 50 or 2 * len(marked) > n


def test_base_numbers(docs, given):
    field = quality.Field(np.zeros((quality.N_FEATURES, 2)), np.zeros(2), np.zeros((2, 2)))
    for frame in (docs, given):
        texts = {r.doc_id: r.text for r in frame.collect()}
        rows = quality.quality_rules(frame, field).collect()
        assert len(rows) == frame.count()
        for r in rows:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_by_hand(texts[r.doc_id])
            assert r.kept == (not r.base_failed)


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(1)
    field = quality.Field(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=2), rng.normal(size=(2, 2)))
    sizes = np.array([3, 0, 1, 6, 4])
    rows = rng.normal(size=(sizes.sum(), quality.N_FEATURES))
    got, at = quality.decode(field, rows, sizes), 0
    for n in sizes:
        x = rows[at : at + n] @ field.emit
        score = lambda y: sum(x[i, y[i]] for i in range(n)) + sum(field.move[a, b] for a, b in zip(y, y[1:])) + (field.start[y[0]] if n else 0)  # noqa: E731,B023
        assert tuple(got[at : at + n]) == max(itertools.product((0, 1), repeat=int(n)), key=score)
        at += n


def test_quality_of_labelled_documents(spark, given):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = quality.quality_rules(given, quality.fit(given, labels)).join(labels, "doc_id").where("not base_failed").collect()
    assert sum((r.quality == 1) == r.kept for r in rows) >= 0.95 * len(rows)
    untrained = quality.fit(given, labels.where("false"))
    assert not untrained.emit.any()


# --- 2 -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("mix", [mixing.Mix(block_tokens=64), mixing.Mix(entropy=0.5, repetition=2.0, budget=1.7, block_tokens=500)])
def test_mixture_equals_sql(docs, mix):
    table = docs.select("doc_id", "text", "source").toPandas()
    table["doc_id"] = table["doc_id"].astype("Int64")
    database = duckdb.connect()
    database.register("docs", table)
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r) for r in mixing.mixed(docs, mix).collect()), key=key)
    assert got == sorted(database.sql(mixing.mix_sql(mix, "docs")).fetchall(), key=key)
    assert len(got) == docs.count()


def test_mixture_keeps_the_budget(docs, given):
    rows = mixing.mixed(given).collect()
    spent = Counter()
    for r in rows:
        spent[r.source] += r.copies * r.n_tokens
    whole = sum(r.n_tokens for r in rows)
    longest = max(r.n_tokens for r in rows)
    for source, weight in {r.source: r.weight for r in rows}.items():
        assert weight * whole - longest - mixing.Mix().block_tokens <= spent[source] <= weight * whole
    assert mixing.mixed(docs.where("false")).count() == 0
    kept = mixing.mix_documents(docs, mixing.Mix(budget=3.0))
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect())[7] >= 1


def test_mixture_tells_rows_without_an_id_apart(spark):
    rows = [(None, f"small text {i} {'w ' * i}", "en", "small") for i in range(4)] + [(7, "same id one", "en", "small"), (7, "same id two x", "en", "small")]
    rows += [(9, "repeated row", "en", "small")] * 5 + [(i, "large words " * 40, "en", "large") for i in range(100, 160)]
    rows += [(None, "no source", "de", None), (8, None, None, "small")]
    frame = stored(spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long"), "alike")
    mix = mixing.Mix(entropy=1.0, repetition=9.0, budget=1.3, block_tokens=50)
    key = lambda r: (r.source, r.text, r.doc_id)
    spent, tokens = Counter(), {key(r): len(words(r.text)) for r in frame.collect()}
    for r in mixing.mixed(frame, mix).collect():
        spent[r.source, r.n_tokens, r.doc_id] += r.copies
    kept = mixing.mix_documents(frame, mix).collect()
    found = Counter()
    for r in kept:
        found[r.source, tokens[key(r)], r.doc_id] += 1
    assert found == Counter({k: v for k, v in spent.items() if v})
    per_row = Counter(r.n_chars for r in kept if r.doc_id == 9)
    assert max(per_row.values()) - min(per_row.values()) <= 1 and len(per_row) == 5
    assert len({r.text for r in kept if r.doc_id is None and r.source == "small"}) == 4


# --- 3 -------------------------------------------------------------------------------------------------------------


def test_licences(spark, docs, given):
    model = license.fit(given)
    found = {r.doc_id: r for r in license.scan(docs, model).collect()}
    assert found[9].license == "Apache-2.0" and found[9].n_confirmed == 1
    assert all(found[i].license == "none" for i in (1, 2, 3, 4, 7, 8))
    lines = [(i, t) for i, (_, t) in enumerate(license.TEMPLATES)] + [(99, "we licensed the song to nobody")]
    rows = {r.doc_id: r for r in license.scan(spark.createDataFrame(lines, "doc_id long, text string"), model).collect()}
    assert sum(rows[i].license == f for i, (f, _) in enumerate(license.TEMPLATES)) >= len(license.TEMPLATES) - 2
    assert rows[99].license == "unknown"
    assert license.scan(docs.where("false"), model).count() == 0


def test_licence_rows_equal_the_plain_rule(given):
    model = license.fit(given)
    for r in license.scan(given, model).collect()[:40]:
        text = next(t.text for t in given.where(F.col("doc_id") == r.doc_id).collect())
        sure = 0
        for p in text.split("\n"):
            if any(s in p.lower() for s in license.STEMS):
                z = np.array(model.bias) + sum((np.array(model.weights[g]) for g in license.grams_of(p) if g in model.weights), 0.0)
                family = model.families[int(z.argmax())]
                share = np.exp(z.max()) / np.exp(z).sum()
                sure += family != "unknown" and share >= model.least and license.similarity_of(p, family) >= model.similar
        assert r.n_confirmed == sure


# --- 4 -------------------------------------------------------------------------------------------------------------


def shingles(text):
    found = words(text)
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def test_fingerprints(given, docs, monkeypatch):
    import hashlib

    monkeypatch.setattr(fingerprint, "RANGE_ROWS", 1)
    texts = {r.doc_id: r.text or "" for r in given.collect()}
    rows = {r.doc_id: r for r in fingerprint.fingerprints(given).collect()}
    assert len(rows) == len(texts)
    order = sorted(texts, reverse=True)
    errors = []
    for i, doc_id in enumerate(order):
        text, after, r = texts[doc_id], texts[order[(i + 1) % len(order)]], rows[doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for other, got in ((edited, r.near_edited), (after, r.near_next)):
            a, b = shingles(text), shingles(other)
            errors.append(got - (len(a & b) / len(a | b) if a | b else 1.0))
    assert np.abs(errors).max() < 0.2 and abs(np.mean(errors)) < 0.01
    by_text = {}
    for i, r in rows.items():
        assert by_text.setdefault(texts[i], r.fingerprint) == r.fingerprint
    edge = fingerprint.fingerprints(docs).collect()
    assert len(edge) == docs.count()
    assert {r.fingerprint for r in edge if r.doc_id in (2, 3, 4)} == {""}
    assert fingerprint.fingerprints(docs.where("false")).count() == 0


# --- 5 -------------------------------------------------------------------------------------------------------------


def test_pooling_equals_plain_convolution():
    net = langid.train([b"abc abd " * 80, b"xyz xzz " * 80], ["p", "q"], rounds=1)
    rows = langid.windows_of(b"some text to look at, " * 30)
    x, best = net.embed[rows], []
    for width, kernel, bias in zip(langid.WIDTHS, net.kernels, net.biases):
        every = [x[:, i : i + width].reshape(len(rows), -1) @ kernel + bias for i in range(langid.WINDOW - width + 1)]
        best.append(np.maximum(np.max(every, 0), 0))
    assert np.allclose(langid.pooled(net, rows), np.concatenate(best, 1), atol=1e-4)


def test_languages_of_held_out_documents(docs, given):
    net = langid.fit(given)
    lang = {r.doc_id: r.lang for r in given.collect()}
    rows = [r for r in langid.identify(given, net).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.9 * len(rows)
    edge = {r.doc_id: r for r in langid.identify(docs, net).collect()}
    assert all((edge[i].lang_pred, edge[i].score) == ("und", 0.0) for i in (2, 3, 4, 8))
    assert langid.keep_known(docs, net, 0.0).columns == docs.columns
    untaught = langid.fit(given.where("false"))
    assert {r.lang_pred for r in langid.identify(docs, untaught).collect()} == {"und"}


# --- 6 -------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def test_pieces_equal_the_library_with_the_same_scores(vocabulary):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(open(pieces.MODEL, "rb").read())
    model.trainer_spec.model_type = 1
    other = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    memory = pieces.Solved(vocabulary)
    for text in ["hello thonre world", "Die Größe, naïve", "a  b", "tab\tnew\nline", "x" * 40]:
        score = lambda ids: sum(vocabulary.scores.get(other.id_to_piece(int(i)), 0.0) for i in ids)
        got = pieces.pieces_of(memory, pieces.marked(text))
        assert score(got) == pytest.approx(score(other.encode(text)))
        assert pieces.text_of(vocabulary, got.tolist()) == text


@pytest.mark.parametrize("chunk", [16, 17, 40])
def test_chunks_give_the_whole_text(vocabulary, chunk):
    rng = np.random.default_rng(chunk)
    memory = pieces.Solved(vocabulary)
    letters = list("the onre  in\néß東.-")
    texts = ["".join(rng.choice(letters, n)) for n in (chunk + 1, 90, 300)] + ["thehehethe" * 30, " " * 90, "東" * 70]
    for text in texts:
        s = pieces.marked(text)
        parts = [(s[i : i + chunk + vocabulary.widest - 1], min(chunk, len(s) - i)) for i in range(0, len(s), chunk)]
        at = pieces.states(np.stack([pieces.matrix(memory, *part) for part in parts]))
        got = np.concatenate([pieces.backtrace(memory, *part, a, b) for part, a, b in zip(parts, at, at[1:])])
        total = lambda ids: sum(vocabulary.scores.get(p, vocabulary.lone) for p in spelled(vocabulary, ids))
        assert pieces.text_of(vocabulary, got.tolist()) == text
        assert total(got) == pytest.approx(total(pieces.pieces_of(memory, s)))


def spelled(vocabulary, ids):
    names = {v: k for k, v in vocabulary.ids.items()}
    return [names.get(int(i), "") for i in ids]


def test_prefix_scan_is_the_product():
    m = np.random.default_rng(2).normal(size=(7, 3, 3))
    out = m[0]
    for k in range(1, 7):
        out = pieces.max_plus(out, m[k])
        assert np.allclose(pieces.prefixes(m)[k], out)


def test_encoding_rows(docs, vocabulary):
    whole = {(r.doc_id, tuple(r.ids)) for r in pieces.encode(docs, vocabulary).collect()}
    rows = pieces.encode(docs, vocabulary, 64).collect()
    assert {(r.doc_id, tuple(r.ids)) for r in rows} == whole
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in TEXTS)
    assert all(r.round_trip == (r.doc_id != 11) and r.n_tokens == len(r.ids) for r in rows)
    back = pieces.decode(pieces.encode(docs, vocabulary).where("doc_id = 7"), vocabulary).first()
    assert back.decoded == LONG
    assert pieces.encode(docs.where("false"), vocabulary).count() == 0


# --- 7 -------------------------------------------------------------------------------------------------------------


def test_main_text():
    page = """<html><head><title>t</title><style>p{}</style></head><body><header>Head</header><nav><a href=x>menu</a></nav>
    <div class="cookie-notice">We use cookies, all of them, and more.</div><div id="sidebar"><p>Side, side, side text of some length, yes.</p></div>
    <article><h1>Head&nbsp;line</h1><p><b>First,   second &amp; third,<br>with more words than a few, to score well.<p>Second block&#33;</p>
    <script>var a = "<p>no</p>";</script><form><p>Sign up</p></form><ul><li>item one</li><li>item two</li></ul>
    <section class="comments"><p>A reader says, at length, that this is good, very good.</p></section></article>
    <footer>Foot</footer></body></html>"""
    expected = "Head line\nFirst, second & third, with more words than a few, to score well.\nSecond block!\nitem one\nitem two"
    assert html.main_text(page) == expected
    assert html.main_text(page[: page.index("<form>")]) == "\n".join(expected.split("\n")[:3])
    plain = "<body><div class=menu><p>a, b, c</p></div><div><div><p>Some text, with commas, here it is.</p><p>Short.</p></div></div></body>"
    assert html.main_text(plain) == "Some text, with commas, here it is.\nShort."
    assert [html.main_text(t) for t in (None, "", "   ", "<p", "<!-- x", "bare words")] == ["", "", "", "", "", "bare words"]


@pytest.mark.parametrize("names", ['class="content no-sidebar"', 'class="page with-header"', 'id="search-results"', 'class="related-work"'])
def test_a_name_alone_does_not_lose_the_text(names):
    say = "<p>First, a paragraph of text, long enough to score.</p><p>Then, in the end, another one that counts.</p>"
    text = "First, a paragraph of text, long enough to score.\nThen, in the end, another one that counts."
    talk = f'<div class="comments"><article>{say * 3}</article></div>'
    assert html.main_text(f"<body><div {names}><article>{say}</article>{talk}</div><p>x</p></body>") == text
    assert html.main_text(f"<body><div {names}>{say}</div><p>x</p></body>") == f"{text}\nx"
    assert html.main_text(f"<body><main><div {names}>{say}</div></main></body>") == text
    assert html.main_text(f"<body><article>{say}{talk}</article><div {names}>{say * 3}</div></body>") == text


def test_headings_and_paragraphs_beside_the_best_container():
    say = "".join(f"<p>Paragraph {k}, with some words, and more of them.</p>" for k in range(4))
    page = f"<body><div><h1>Title</h1><div>{say}</div><p>A closing sentence.</p><p><a href=x>More pages</a></p></div></body>"
    lines = html.main_text(page).split("\n")
    assert (lines[0], len(lines), lines[-1]) == ("Title", 6, "A closing sentence.")


SAY = "<p>First, a paragraph of text, long enough to score.</p><p>Then, in the end, another one that counts.</p>"
SAID = "First, a paragraph of text, long enough to score.\nThen, in the end, another one that counts."


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        (f'<div class="entry-header"><h1>The title</h1></div>{SAY}', f"The title\n{SAID}"),
        (f'{SAY}<section id="search"><p>How we searched.</p></section>', f"{SAID}\nHow we searched."),
        (f'{SAY}<h2 id="related-work">Related work</h2><p>Others.</p>', f"{SAID}\nRelated work\nOthers."),
        (f'{SAY}<p id="notice">Mind the gap.</p>', f"{SAID}\nMind the gap."),
        (f'{SAY}<p class="notice">Page notice.</p>', SAID),
        (f'{SAY}<div class="advert"><p>Buy this, now.</p></div>', SAID),
        (f'{SAY}<section id="comments"><p>Says a reader.</p></section>', SAID),
        (f"{SAY}<ol><li><a href=x>Ref one</a></li><li><a href=x>Ref two</a></li><li><a href=x>Ref three</a></li></ol>",
         f"{SAID}\nRef one\nRef two\nRef three"),
        (f'{SAY}<ul class="references"><li><a>One</a></li><li><a>Two</a></li><li><a>Three</a></li></ul>', f"{SAID}\nOne\nTwo\nThree"),
        (f"{SAY}<ul><li><a>One</a></li><li><a>Two</a></li><li><a>Three</a></li></ul>", SAID),
    ],
)
def test_what_an_article_holds_is_kept(inner, text):
    assert html.main_text(f"<body><nav><a>Home</a></nav><article>{inner}</article><footer>Foot</footer></body>") == text


def test_further_articles_and_parts_in_containers_of_their_own():
    page = f"<body><article>{SAY}</article><article><p>A short one.</p></article><article class=comment><p>No.</p></article></body>"
    assert html.main_text(page) == f"{SAID}\nA short one."
    links = "<div><a href=x>One</a> <a href=x>Two</a></div>"
    page = f"<body><div><div><h1>Title</h1></div><div>{SAY * 3}</div><div><div>And that is the end of it.</div></div>{links}</div></body>"
    assert html.main_text(page).split("\n") == ["Title", *(SAID + "\n").splitlines() * 3, "And that is the end of it."]


@pytest.mark.parametrize("piece", ["<font><p>word, word</p>", "<div>word, word", "<b><i>word</p>", "<li>word<ul>", "</p></td></li>x", "<p>x<b>"])
def test_time_grows_with_the_page(piece):
    import time

    spent = []
    for times in (4_000, 32_000):
        started = time.process_time()
        assert html.main_text(piece * times)
        spent.append(time.process_time() - started)
    assert spent[1] < 30 * max(spent[0], 0.01)


def container_scores(page):
    """Points of every element by the plain rule: each run's points at each element above it."""
    nodes, runs = html.parse(page)
    found = Counter()
    for block, text, _ in runs:
        node, level = block, 0
        while node:
            found[node.index] += html.points(text) * (1 if level < 2 else 0.5 if level == 2 else (2 / 3) ** (level - 3) / 6)
            node, level = node.up, level + 1
    html.gather(nodes, runs)
    return {n.index: n.points for n in nodes if n.chars}, found


def test_points_equal_the_plain_rule(spark):
    pages = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").limit(20).collect()] + ["<div>" * 60 + "deep, text" + "<p>x" * 9]
    for page in pages:
        got, wanted = container_scores(page)
        assert got == pytest.approx({k: v for k, v in wanted.items() if k in got})


def test_pages_of_nothing(spark):
    ship(spark)
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract(frame).collect() == []


def test_pages(spark):
    ship(spark)
    rows = [(1, "u", "<p>x y</p>", "z"), (2, None, None, "z"), (2, None, None, "z")]
    frame = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert sorted((r.page_id, r.text, r.n_chars) for r in frame.collect()) == [(1, "x y", 3), (2, "", 0), (2, "", 0)]


# --- 8 -------------------------------------------------------------------------------------------------------------


def test_scores(docs, given):
    for frame in (given, docs):
        texts = [(r.doc_id, r.text) for r in frame.collect()]
        out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
        train = Counter(w for i, t in texts if not out(i) for w in [*((t or "").encode().lower().split()), None])
        n, v = sum(train.values()), len(train)
        text_of = dict(texts)
        rows = lm.score(frame).collect()
        assert len(rows) == len(texts)
        for r in rows:
            tokens = [*((text_of[r.doc_id] or "").encode().lower().split()), None]
            assert (r.held_out, r.n_tokens, r.train_tokens) == (out(r.doc_id), len(tokens), n)
            assert r.n_known == sum(train[t] > 0 for t in tokens)
            assert r.base_score == pytest.approx(sum(log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens))
            assert r.score < 0
    empty = lm.score(docs.where("false"))
    assert empty.count() == 0


def test_next_identifier_probabilities_sum_to_one():
    counts = np.random.default_rng(0).integers(0, 50, lm.IDS).astype(float)
    class_of, member, share = lm.classes(counts)
    model = lm.Model(lm.train([[5, 7, 9, lm.END] * 5], class_of, member), class_of, member, share)
    f = lm.forward(model.weights, np.array([[lm.END, 5, 7]]))[0][0, -1]
    every = np.repeat(f[None], lm.IDS, 0)
    logs = lm.log_probabilities(model.weights, every, class_of, member) + share
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-3)


def test_each_identifier_is_scored_once():
    lengths = np.array([1, lm.WINDOW, lm.WINDOW + 1, 100])
    text, first, size, scored = lm.spans(lengths)
    seen = Counter((t, f + k) for t, f, s, d in zip(text, first, size, scored) for k in range(d, s))
    assert seen == Counter((t, k) for t, n in enumerate(lengths) for k in range(n))


def test_gradients():
    class_of, member, _ = lm.classes(np.arange(lm.IDS)[::-1].astype(float))
    w = {k: v.astype(np.float64) for k, v in lm.initial().items()}
    ids = np.array([[3, 60, 900], [1, 2, 3]])
    kind, place, live = class_of[ids[:, ::-1]], member[ids[:, ::-1]], np.ones((2, 3), bool)
    loss = lambda: -lm.log_probabilities(w, lm.forward(w, ids)[0].reshape(-1, lm.WIDTH), kind.ravel(), place.ravel()).mean()
    g = lm.gradients(w, ids, kind, place, live)
    for key in ("qkv", "mix", "up", "down", "out", "inner0"):
        at = (1, 2)
        w[key][at] += 1e-4
        high = loss()
        w[key][at] -= 2e-4
        low = loss()
        w[key][at] += 1e-4
        assert g[key][at] == pytest.approx((high - low) / 2e-4, abs=2e-5)


# --- 9 -------------------------------------------------------------------------------------------------------------


def near_copies(seed=4):
    rng = np.random.default_rng(seed)
    out = []
    for base in range(6):
        text = [f"t{base}w{k}" for k in rng.integers(0, 400, 60 + 30 * base)]
        for _ in range(12):
            text = list(text)
            for _ in range(int(rng.integers(0, 3))):
                text[int(rng.integers(0, len(text)))] = f"n{rng.integers(0, 10**6)}"
            out.append(" ".join(text))
    out += out[:9] + ["Ab c", "aB c", "shared passage of several words here " * 3 + "one", "shared passage of several words here " * 3 + "two two two"]
    return [(i * 3 % 101, t) for i, t in enumerate(out)]


def joined_by_hand(rows):
    def grams(text):
        found = (text or "").encode().lower().split()
        return {tuple(found[i : i + 4]) for i in range(max(1, len(found) - 3))} if found else set()

    sets = [grams(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            up[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min((x for x in (least.get(root(i)), doc_id) if x is not None), default=None)
    return sorted(((i, len(s), least[root(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def test_prefixes_bound_the_overlap():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b, c = (np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in range(3))
        cut = [s[: ngram_join.prefix(len(s))] for s in (a, b, c)]
        lengths, sizes = np.array([len(cut[1]), len(cut[2])]), np.array([len(b), len(c)])
        begins = np.array([0, len(cut[1])])
        bound = ngram_join.prefix_bound(cut[0], len(a), np.concatenate(cut[1:]), begins, lengths, sizes)
        assert bound[0] >= len(np.intersect1d(a, b)) and bound[1] >= len(np.intersect1d(a, c))


@pytest.mark.parametrize("leaf", [8_192, 7])
def test_join_equals_brute_force(spark, docs, monkeypatch, leaf):
    ship(spark)
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    monkeypatch.setattr(ngram_join, "SHINGLES", leaf * ngram_join.SMALLEST)
    monkeypatch.setattr(ngram_join, "PASS", 16 * leaf)
    rows = near_copies()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in ngram_join.join(frame).collect()), key=str) == joined_by_hand(rows)
    edge = [(i, t) for i, t, *_ in TEXTS]
    assert sorted((tuple(r) for r in ngram_join.join(docs).collect()), key=str) == joined_by_hand(edge)


def test_one_of_each_group_stays(spark, docs):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({1, 2, 3, 4, 5, 7, 8, 9, 11, None})
    assert ngram_join.join(docs.where("false")).count() == 0


def test_texts_decide_what_stays_not_ids(spark):
    ship(spark)
    say = lambda stem: " ".join(f"{stem}{k}" for k in range(80))
    rows = [(None, say("a")), (None, say("b")), (None, say("c") + " one"), (None, say("c") + " two"), (None, say("d")), (2, say("d") + " more")]
    rows += [(3, say("e")), (5, say("f")), (5, say("e") + " more"), (5, say("f")), (None, " "), (None, ""), (7, ""), (7, None), (7, "")]
    kept = Counter(tuple(r) for r in ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    ends = [kept.pop((None, say("c") + end), 0) for end in (" one", " two")]
    assert sorted(ends) == [0, 1]
    expected = [(None, say("a")), (None, say("b")), (2, say("d") + " more"), (3, say("e")), (5, say("f"))]
    assert kept == Counter(expected + [(None, " "), (None, ""), (7, ""), (7, None)])


def test_tree_keeps_every_similar_pair():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 6, (5, ngram_join.GROUPS))
    points = (base[rng.integers(0, 5, 150)] + rng.integers(0, 2, (150, ngram_join.GROUPS))).astype(np.int32)
    sizes = points.sum(1)
    tree = ngram_join.Tree(points, sizes, np.arange(150))
    got = {
        tuple(sorted((int(a[i]), int(b[j]))))
        for a, b, test in ngram_join.survivors(points, sizes, tree, tree, True)
        for i, j in zip(*np.nonzero(test()))
    }
    for i, j in itertools.combinations(range(150), 2):
        if ngram_join.linked(np.minimum(points[i], points[j]).sum(), sizes[i], sizes[j]):
            assert (i, j) in got


# --- 10 ------------------------------------------------------------------------------------------------------------


def test_token_counts(docs, given):
    encode = tokencount.encoder(tokencount.VOCABULARY).encode_ordinary
    for frame in (docs, given):
        expected = Counter((r.doc_id, len(encode(r.text or ""))) for r in frame.collect())
        assert Counter((r.doc_id, r.n_tokens) for r in tokencount.document_tokens(frame).collect()) == expected


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_blocks_are_stitched(spark, tmp_path, block):
    ship(spark)
    end = tokencount.SEPARATOR
    files = {"a": [1, 2, 3, end, end, 4, end, 5], "b": [end], "c": [9] * 40, "d": []}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, ">u2").tobytes())
    rows = tokencount.count_tokens(spark, str(tmp_path), block=block).collect()
    assert sorted(tuple(r) for r in rows) == [("a", 0, 0, 3), ("a", 1, 4, 0), ("a", 2, 5, 1), ("b", 0, 0, 0)]


def test_a_file_is_counted_by_several_tasks(spark, tmp_path):
    ship(spark)
    rng = np.random.default_rng(9)
    end = tokencount.SEPARATOR
    ids = rng.integers(0, 50_256, 60_000)
    ids[rng.random(len(ids)) < 0.01] = end
    ids[rng.random(len(ids)) < 0.02] = 0x0A0A
    ids[1_000:1_400] = 0xC4  # its low byte is the separator's high one
    (tmp_path / "flat.txt").write_bytes(ids.astype(">u2").tobytes())
    at = np.flatnonzero(ids == end)
    starts = np.append(0, at[:-1] + 1)
    expected = [("flat.txt", k, int(s), int(e - s)) for k, (s, e) in enumerate(zip(starts, at))]
    for split in ("4096", "7001", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            rows = tokencount.count_tokens(spark, str(tmp_path), block=1_500).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(map(tuple, rows)) == expected
    rows = tokencount.count_tokens(spark, str(tmp_path), separator=0x0A0A).collect()
    assert len(rows) == (ids == 0x0A0A).sum()


def test_ids_follow_the_tokens_whatever_the_parallelism(spark, given, tmp_path):
    encode = tokencount.encoder(tokencount.VOCABULARY).encode_ordinary
    path = str(tmp_path / "many")
    given.select("doc_id", "text").repartition(13).write.parquet(path)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "4")
        frame = spark.read.parquet(path)
        expected = Counter((r.doc_id, len(encode(r.text or ""))) for r in frame.collect())
        found = tokencount.document_tokens(frame)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
        assert Counter((r.doc_id, r.n_tokens) for r in found.collect()) == expected
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_very_long_and_no_documents(spark, docs):
    encode = tokencount.encoder(tokencount.VOCABULARY).encode_ordinary
    long = "river stone " * 300_000
    frame = spark.createDataFrame([("a", long, 1), (None, "x\ny", 2), ("b,c", None, 3)], "doc_id string, text string, place int")
    assert Counter((r.doc_id, r.n_tokens) for r in tokencount.document_tokens(frame).collect()) == Counter(
        [("a", len(encode(long))), (None, len(encode("x\ny"))), ("b,c", 0)]
    )
    assert tokencount.document_tokens(docs.where("false")).collect() == []


# --- all -----------------------------------------------------------------------------------------------------------


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
