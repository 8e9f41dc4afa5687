"""Learned scores, rules and extraction."""

import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchloom.llm import extract, langid, lm, quality, toxicity

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are absent")


@needs_tables
def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    got = langid.op9_language_id(spark, SF).join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang_pred") == F.col("truth")).cast("double")).alias("a")).first()
    assert got.a > 0.97


def test_language_spans_and_undefined():
    scores = np.array([[0.0, -5.0]] * 6 + [[-5.0, 0.0]] * 6)
    assert langid.viterbi(scores, 12.0).tolist() == [0] * 6 + [1] * 6
    assert langid.viterbi(scores[4:9], 40.0).tolist() in ([0] * 5, [1] * 5)
    model = langid.Model(langid.Config(), ["en"], np.zeros((1 << langid.BITS, 1), np.float32), np.ones((len(langid.NAMES), 1), bool))
    assert [langid.label(t, model)[0] for t in (None, "", "12 %", "²", "word")] == ["und"] * 4 + ["en"]


def brute_viterbi(scores, penalty):
    import itertools

    paths = itertools.product(range(scores.shape[1]), repeat=len(scores))
    return max(sum(scores[i, k] for i, k in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:], strict=False)) for p in paths)


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(60):
        scores = rng.normal(0, 3, (6, 3))
        p = langid.viterbi(scores, 2.0)
        assert abs(scores[np.arange(6), p].sum() - 2.0 * (np.diff(p) != 0).sum() - brute_viterbi(scores, 2.0)) < 1e-9


def test_viterbi_of_neighbouring_foreign_stretches():
    """Two stretches side by side share a switch, so neither pays for itself alone."""
    near = np.array([[0, 11.9, -12.1], [0, -12.1, 11.9]])
    assert langid.viterbi(near, 12.0).tolist() == [1, 2]
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 5, 7):
        for _ in range(120):
            scores = rng.choice([-4.1, -2.0, 0.0, 1.9, 3.9], (n, 3))
            p = langid.viterbi(scores, 4.0)
            assert abs(scores[np.arange(n), p].sum() - 4.0 * (np.diff(p) != 0).sum() - brute_viterbi(scores, 4.0)) < 1e-9


def test_word_memory_changes_no_score(spark):
    """Full and small memories, and words too long for them, score alike."""
    rows = [(i, f"der hund läuft {'x' * (i + 30)} the dog runs w{chr(97 + i)} " * 3, "de" if i % 2 else "en") for i in range(12)] + [(50, None, "en"), (51, "", None), (52, "y" * 3_000_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    answers = []
    for words in (200_000, 6, 1):
        model = langid.fit(docs, langid.Config(cache_words=words))
        answers.append([langid.label(t, model) for _ in range(2) for _, t, _ in rows])
    assert answers[0] == answers[1] == answers[2]
    got = langid.identify(docs.withColumn("score", F.lit("clash")), langid.fit(docs)).collect()
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id >= 50}.items() >= {50: "und", 51: "und"}.items()
    assert langid.identify(docs.limit(0), langid.fit(docs.limit(0))).count() == 0


@needs_tables
def test_toxicity_of_held_out_texts(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity.op10_toxicity(spark, SF).join(labels, "doc_id").where("held_out").collect()
    clean, toxic = [r.predicted for r in rows if r.toxic == 0], [r.predicted for r in rows if r.toxic == 1]
    assert np.mean(clean) < 0.03 and np.mean(toxic) > 0.6


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.5, 0.5]


@needs_tables
def test_model_beats_counts_on_held_out_texts(spark):
    sums = lm.op3_lm_score(spark, SF).where("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s"), F.sum("n_tokens").alias("n")).first()
    assert sums.s > sums.b
    bits = math.log2(10) / sums.n
    assert bits * (sums.s - sums.b) > 0.8  # bits for each token


def test_base_score_is_exact(spark):
    docs = [(i, "the cat sat on the mat " * (i % 3) + f"word{i}") for i in range(30)] + [(77, None), (78, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    config = lm.Config(inputs=8, outputs=4, size=4, table_words=5)
    counted, model = lm.fit(df, config)
    c = Counter()
    for i, t in docs:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update([*(t or "").encode().lower().split(), lm.END])
    n, v = sum(c.values()), len(c)
    for r in lm.score(df, counted, model).collect():
        tokens = [*(dict(docs)[r.doc_id] or "").encode().lower().split(), lm.END]
        assert abs(r.base_score - sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)) < 1e-9
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(c[w] > 0 for w in tokens), n)


def small_model(spark, docs):
    config = lm.Config(singles=6, outputs=20, class_words=5, inputs=8, size=4, table_words=40, topics=3, topic_words=30, batch=64, part_tokens=100)
    return (*lm.fit(spark.createDataFrame(docs, "doc_id long, text string"), config), config)


def prose(n, seed=1):
    rng = np.random.default_rng(seed)
    words = [[f"{t}{i}" for i in range(25)] for t in "abc"]
    return [(i, " ".join(words[i % 3][int(25 * rng.random() ** 2)] for _ in range(rng.integers(0, 40)))) for i in range(n)]


def test_outputs_are_normalised(spark):
    """Over all words of the table, and one word for all others, after any two words."""
    _, model, config = small_model(spark, prose(90))
    c, n = model.classes, len(model.words.words)
    assert c.first_own == config.singles < c.first_shared < c.other and n == config.table_words
    share = np.where(c.of >= c.first_shared, (model.words.counts + 0.5) / c.totals[c.of], 1.0)
    for before in ([], [3], [7, 12], [30, -1], [-1, 25]):
        total = 0.0
        for rank in [*range(n), -1]:
            x = lm._tokens(np.array([*before, rank]), np.array([len(before) + 1]), model)
            total += np.exp(lm.log_probabilities(model, x)[-1]) * (share[rank] if rank >= 0 else 1.0)
        assert abs(total - 1) < 1e-5


def test_score_is_its_words_probabilities(spark):
    """Recomputed word by word, with plain sums, from the model's parameters."""
    docs = [*prose(60), (77, None), (78, ""), (79, "a1 never-seen a1")]
    counted, model, config = small_model(spark, docs)
    known = {bytes(r.word): r.c for r in counted.collect()}
    c, words = model.classes, model.words
    place = {w: i for i, w in enumerate(words.words)}

    def embedded(word):
        if word is None:
            return model.embed[c.n]
        rank = place.get(word, -1)
        row = model.embed[c.of[rank] if rank >= 0 else c.other]
        return row + model.own[rank] if 0 <= rank < config.inputs else row

    def log10_softmax(z, i):
        return (z[i] - np.log(np.exp(z).sum())) / math.log(10)

    for r in lm.score(spark.createDataFrame(docs, "doc_id long, text string"), counted, model).collect():
        tokens, total = [*(dict(docs)[r.doc_id] or "").encode().lower().split(), lm.END], 0.0
        for i, w in enumerate(tokens):
            h = embedded(tokens[i - 1] if i else None) @ model.turn[0] + embedded(tokens[i - 2] if i > 1 else None) @ model.turn[1]
            rank = place.get(w, -1)
            of = c.of[rank] if rank >= 0 else c.other
            total += log10_softmax(h @ model.out[:, :-1].T + model.out[:, -1], of)
            if c.first_own <= of < c.first_shared:
                members = [k for k in range(len(place)) if c.of[k] == of]
                z = np.array([h @ model.within[c.slots[k], :-1] + model.within[c.slots[k], -1] + math.log((words.counts[k] + 0.5) / sum(words.counts[j] + 0.5 for j in members)) for k in members])
                total += log10_softmax(z, members.index(rank))
            elif of >= c.first_shared:
                members = sum(words.counts[k] + 0.5 for k in range(len(place)) if c.of[k] == of) if rank >= 0 else sum(n + 0.5 for w, n in known.items() if w not in place) + 0.5
                total += math.log10((known.get(w, 0) + 0.5) / members)
        assert abs(r.score - total) < 1e-4


def test_model_is_independent_of_partitions(spark):
    docs = spark.createDataFrame(prose(80), "doc_id long, text string")
    config = lm.Config(singles=6, outputs=20, class_words=5, inputs=8, size=4, table_words=40, topics=3, topic_words=30, part_tokens=100)
    models = [lm.fit(docs.repartition(n, "text"), config)[1] for n in (1, 7)]
    assert models[0].words.words == models[1].words.words
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(models[0].parts(), models[1].parts(), strict=True))


def test_model_without_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, "x y")], "doc_id long, text string")
    counted, model = lm.fit(docs.limit(0))
    assert lm.score(docs.limit(0), counted, model).count() == 0
    got = {r.doc_id: r for r in lm.score(docs, counted, model).collect()}
    assert (got[1].n_tokens, got[2].n_tokens, got[2].n_known, got[2].train_tokens) == (1, 3, 0, 0) and got[2].score < got[1].score < 0


def test_rules_and_ledger(spark):
    eight = " ".join(f"w{i}" for i in range(8))
    docs = [(1, None), (2, f"{eight} x {eight}"), (3, " ".join(f"u{i}" for i in range(30))), (4, " ".join(f"u{i}%" for i in range(30)))]
    book = quality.apply_policy(quality.ledger(spark.createDataFrame(docs, "doc_id long, text string"))).cache()
    got = {r.doc_id: r for r in book.collect()}
    assert got[1].n_words == 0 and got[2].n_repeat_words == 16 and not got[2].kept and got[3].kept and not got[4].kept
    cost = {r.rule: (r.n_failed, r.n_failed_alone) for r in quality.ablations(book).collect()}
    assert cost["symbol_density"] == (1, 1) and cost["too_few_words"][0] == 2
    clash = spark.createDataFrame([(3, docs[2][1], 5)], "doc_id long, text string, kept int")
    assert quality.quality_filter(clash).collect()[0].asDict() == {"doc_id": 3, "text": docs[2][1], "kept": 5}


PAGE = '<html><head><title>t</title><script>var a="<p>x</p>"</script></head><body><nav><a>menu</a></nav><!-- c --><div class="ad">buy</div><article><h1>Big&amp;Bold</h1><p>One <b>wo</b>rd<br>two<p>three\n four</p><aside>side</aside><form>f</form><div id="comments"><p>me</p></div></article><footer>foot</footer></body></html>'


def test_article_and_frames():
    assert extract.parse(PAGE)[:2] == (True, ["Big&Bold", "One word", "two", "three four"])
    assert extract.parse(None) == (False, [], []) and extract.parse("<p>a</p><p>b</p>")[1] == ["a", "b"]


@pytest.mark.parametrize("part", [10**6, 50])
def test_host_runs(spark, part, monkeypatch):
    """Shared runs of unmarked pages go, in one part or in several."""
    monkeypatch.setattr(extract, "PART_TOKENS", part)
    frame = " ".join(f"f{i}" for i in range(14))
    rows = [(i, f"http://h.x/{i}", f"<p>{frame}</p><p>own{i} text</p>") for i in range(8)] + [(50, "http://other/", f"<p>{frame}</p>"), (51, None, None), (52, "http://h.x/", PAGE)]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(8)] == [f"own{i} text" for i in range(8)]
    assert (got[50], got[51], got[52]) == (frame, "", "Big&Bold One word two three four")


@pytest.mark.parametrize("part", [10**6, 50])
def test_copies_of_unmarked_pages_keep_their_text(spark, part, monkeypatch):
    """Copies are one page: the host's frame goes, the article stays in all."""
    monkeypatch.setattr(extract, "PART_TOKENS", part)
    frame, article = " ".join(f"f{i}" for i in range(14)), " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"http://h.x/a?utm_source={i}", f"<p>{frame}</p><p>{article}</p>") for i in range(5)]
    rows += [(4, "http://h.x/a?utm_source=4", rows[4][2]), (9, "http://h.x/b", f"<p>{frame}</p><p>own text</p>")]
    got = [(r.page_id, r.text) for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert sorted(got) == [*((i, article) for i in (0, 1, 2, 3, 4, 4)), (9, "own text")]


def main_text(page):
    return " ".join(extract.parse(page)[1])


@pytest.mark.parametrize(("page", "want"), [
    ('<div class="page with-sidebar"><article><p>Real article text</p></article></div>', "Real article text"),
    ('<div class="no-sidebar"><p>Real text</p></div>', "Real text"),
    ("<main><p>lead</p><article><p>longer body</p></article></main>", "lead longer body"),
    ("<header>site</header><article><header><h1>Title</h1></header><p>x</p></article>", "Title x"),
    ('<article><div class="related-work"><p>rel</p></div><p>y</p><div class="related-posts">no</div></article>', "rel y"),
    ('<article>a</article><article>b</article><section id="comments"><article class="comment">c</article></section>', "a b"),
    ('<article>a<div class="comment-list">c</div><form>f</form><aside>s</aside></article>', "a"),
    ('<form id="f"><div>all the text</div></form>', "all the text"),
    ('<div class="sidebar"><article>teaser</article></div><article>main</article>', "main"),
    ('<p class="ad"><b>buy<p>real', "real"),
    ("<div><b>x<article>y</b>z</article>w</div>", "yz"),
    ("<a title=it's>k</a> l <i x=\"a>b\">m</i>", "k l m"),
    ("<head><title>t</title><body><p>z", "z"),
    ("<div hidden>h</div><div style='display: none'>n</div>v", "v"),
    ('<div id="comments">' + "c " * 90 + "</div><p>short</p>", "short"),
    ("<p>a&nbsp;&lt;&#98;&gt;&amp;amp;", "a <b>&amp;"),
])
def test_no_text_is_lost_and_no_frame_kept(page, want):
    assert main_text(page) == want


def naive_clean(texts, frames, sure, size):
    """Runs found by comparing every two places, with the rules of extract."""
    streams = [*texts, *frames]
    inside = [*sure, *([False] * len(f) for f in frames)]

    def held(i, allowed):
        out = []
        for a in range(len(texts[i]) - size + 1):
            run = texts[i][a : a + size]
            for q, stream in enumerate(streams):
                if q % len(texts) != i and (q >= len(texts) or allowed(q)) and any(stream[b : b + size] == run and not any(inside[q][b : b + size]) for b in range(len(stream) - size + 1)):
                    out.append(a)
                    break
        return {t for a in out for t in range(a, a + size)}

    def nearly(i, gone):
        left = [t for t in range(len(texts[i])) if t not in gone]
        longest = run = 0
        for a, t in enumerate(left):
            run = run + 1 if a and left[a - 1] == t - 1 else 1
            longest = max(longest, run)
        return len(left) < extract.MIRROR_SHARE * len(texts[i]) and longest < size

    free = [{t for t in range(len(x)) if not s[t]} for x, s in zip(texts, sure, strict=True)]
    first = [held(i, lambda q: True) & free[i] for i in range(len(texts))]
    mirror = [bool(first[i]) and nearly(i, first[i]) for i in range(len(texts))]
    out = []
    for i, tokens in enumerate(texts):
        gone = held(i, lambda q: not mirror[q]) & free[i] if mirror[i] else first[i]
        out.append(tokens if not gone or nearly(i, gone) else [t for a, t in enumerate(tokens) if a not in gone])
    return out


def test_shared_runs_equal_all_substrings():
    rng, size = np.random.default_rng(4), extract.MIN_RUN
    changed = 0
    for _ in range(80):
        pool = [[f"p{i}w{j}" for j in range(rng.integers(8, 30))] for i in range(5)]
        def stream(n):
            return [t for _ in range(n) for t in (pool[rng.integers(5)] if rng.random() < 0.7 else [f"u{rng.integers(10**6)}" for _ in range(rng.integers(1, 20))])]
        k = int(rng.integers(1, 7))
        texts = [stream(rng.integers(0, 4)) for _ in range(k)]
        if k > 2:
            texts[1] = [*texts[0], "one"]  # a mirror
        frames = [stream(rng.integers(0, 2)) for _ in range(k)]
        sure = [np.repeat(rng.random() < 0.4, len(t)) for t in texts]
        got = extract.clean(texts, frames, sure)
        assert got == naive_clean(texts, frames, sure, size)
        changed += got != texts
    assert changed > 10


@pytest.mark.parametrize("part", [10**6, 60])
def test_mirrors_keep_their_text(spark, part, monkeypatch):
    """Near copies of an unmarked page keep their text but for the host's frame."""
    monkeypatch.setattr(extract, "PART_TOKENS", part)
    frame, article = " ".join(f"f{i}" for i in range(14)), " ".join(f"w{i}" for i in range(60))
    own = " ".join(f"o{i}" for i in range(30))
    rows = [(i, "http://h.x/a", f"<p>{frame}</p><p>{article} copy{i}</p>") for i in (1, 2)]
    rows += [(3, "http://h.x/b", f"<p>{frame}</p><p>{own}</p>"), (4, "http://h.x/c", f"<main>{frame}<article><p>{own}</p><p>{frame}</p></article></main>")]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    if part > 60:
        assert (got[1], got[2]) == (f"{article} copy1", f"{article} copy2")
    assert got[1].endswith(f"{article} copy1") and got[2].endswith(f"{article} copy2")
    assert got[3] == own and got[4] == f"{own} {frame}"


def test_parts_of_a_host_change_no_text(spark, monkeypatch):
    """Near copies, pages that they share passages with, and frames: the same text
    in one part, in several, and with hosts joined."""
    rng = random.Random(3)
    frame, passages = " ".join(f"f{i}" for i in range(14)), [" ".join(f"w{j}_{i}" for i in range(60)) for j in range(3)]
    rows = [(i, "http://h.x/a", f"<p>{frame}</p><p>{rng.choice(passages)} copy{i}</p>") for i in range(8)]
    rows += [(10 + j, "http://h.x/b", f"<p>{p[:150]}</p><p>{' '.join(f'o{j}_{i}' for i in range(50))}</p><footer>{frame} {j}</footer>") for j, p in enumerate(passages[:2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = []
    for part, hosts in ((10**6, 10), (150, 10), (40, 10), (150, 0)):
        monkeypatch.setattr(extract, "PART_TOKENS", part)
        monkeypatch.setattr(extract, "HELD_HOSTS", hosts)
        texts.append(dict(extract.extract(df).select("page_id", "text").collect()))
    assert len(set(texts[0].values())) == len(rows) and all(t == texts[0] for t in texts)


@pytest.mark.parametrize("held", [10**6, 0])
def test_repeated_frames_leave_articles(spark, held, monkeypatch):
    """By held grams and by a join: an article loses what the frames of two pages
    of its host hold, but never all of its text, and nothing else."""
    monkeypatch.setattr(extract, "HELD_GRAMS", held)
    frame, own = " ".join(f"f{i}" for i in range(14)), " ".join(f"o{i}" for i in range(30))
    once = " ".join(f"g{i}" for i in range(14))
    rows = [(i, "http://h.x/d", f"<footer>{frame} {i}</footer><article>art{i}</article>") for i in (5, 6)]
    rows += [(7, "http://h.x/e", f"<nav>{once}</nav><article>{own} x {frame} y</article>"), (8, "http://h.x/f", f"<article>{once} {own}</article>")]
    rows += [(9, "http://h.x/g", f"<article>{frame}</article>"), (10, "http://other/", f"<article>{own} {frame}</article>")]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {5: "art5", 6: "art6", 7: f"{own} x y", 8: f"{once} {own}", 9: frame, 10: f"{own} {frame}"}


def test_pages_with_clashing_columns_and_none(spark):
    rows = [(1, "http://a/", "<p>x</p>", "t", "h"), (1, "http://a/", "<p>x</p>", None, None), (None, None, None, "t", "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string")
    assert sorted((r.page_id or 0, r.text) for r in extract.extract(df).collect()) == [(0, ""), (1, "x"), (1, "x")]
    assert extract.extract(df.limit(0)).count() == 0
    long = "<p>" + "word " * 300_000 + "</p>"
    assert len(main_text(long)) == 5 * 300_000 - 1
