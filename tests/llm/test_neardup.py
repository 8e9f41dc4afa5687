"""Near-duplicate documents against all pairs."""

import random

import pytest

from patchloom.llm import components, neardup
from patchloom.llm.shingles import overlap, shingle_sets


def brute(docs):
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets.setdefault(i, []).append({tuple(w[j : j + 4]) for j in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    flat = [(i, s) for i, all_ in sets.items() for s in all_ if s]
    for a, (i, s) in enumerate(flat):
        for j, r in flat[a + 1 :]:
            if 100 * len(s & r) >= 80 * len(s | r):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in up}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    docs = []
    for base in range(25):
        words = passage[: rng.randint(0, 30)] + [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        for copy in range(rng.randint(1, 12)):
            edited = list(words)
            for _ in range(rng.randint(0, 5) if copy else 0):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            docs.append((len(docs), " ".join(edited)))
    docs += [(len(docs) + k, t) for k, t in enumerate([None, "", " \t", "a b", "A  B", "a b c d"])]
    return docs


def test_equals_all_pairs(spark):
    docs = corpus(1)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS sig", "1 AS rec")
    got = {r.doc_id: r for r in neardup.near_duplicates(df).collect()}
    want = brute(docs)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items()) and got[docs[-6][0]].n_shingles == 0


@pytest.mark.parametrize("others", [1, 6])
def test_large_nodes_and_families(spark, others):
    """Small limits send the same documents through blocks, levels and clusters."""
    docs = corpus(2)
    small = neardup.Config(leaf=4, pivots=2, family=3, levels=3, others=others)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), small).collect()}
    assert got == brute(docs)


def test_ids_that_are_null_or_shared(spark):
    text = "one two three four five six"
    docs = [(1, text), (1, "seven eight nine ten eleven"), (2, "seven eight nine ten eleven"), (None, text)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = neardup.near_duplicates(df).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in rows} == {(1, 1, True), (2, 1, False), (None, None, True)}
    assert sorted(r.doc_id or 0 for r in neardup.drop_near_duplicates(df).collect()) == [0, 1, 1]
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_overlap_counts():
    a, b = shingle_sets([b"a b c d e f g", b"x b c d e f g"])
    assert (len(a), overlap(a, b)) == (4, 3)


def test_pipeline_takes_five_words_a_shingle(spark):
    """Texts that are near by four words and not by five stay in the pipeline."""
    import corpus_pipeline

    a = [f"w{i}" for i in range(45)]
    docs = [(1, " ".join(a)), (2, " ".join([*a[:20], "other", *a[21:]]))]
    sets = {n: shingle_sets([t.encode() for _, t in docs], n) for n in (4, 5)}
    assert [(len(x), overlap(x, y)) for x, y in sets.values()] == [(42, 38), (41, 36)]  # 38 of 46, 36 of 46
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert [r.doc_id for r in neardup.drop_near_duplicates(df).collect()] == [1]
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == [1, 2]


def test_components_by_rounds(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(60) if i % 20 != 19] + [(5, 5), (99, 99)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = dict(components.components(df).collect())
    monkeypatch.setattr(components, "TASK_EDGES", 7)
    assert dict(components.components(df).collect()) == want and want[59] == 40 and want[99] == 99
