"""Encoding, permutation and shards: exact round trips."""

import numpy as np
import pytest

from patchloom.llm import packing, pieces

TEXTS = ["Hello  world", "日本語 é漢字\n\n x", " ", "", None, "a" * 3000, "tab\there", "  a b\x00"]


def test_equals_the_library_and_decodes(spark):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    model = pieces.load()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").selectExpr("*", "1 AS ids")
    for r in pieces.decode(pieces.encode(df, model), model).collect():
        assert r.decoded == (r.text or "") and r.ids == library.encode(r.text or "")


def test_unigram_scores_equal_brute_force():
    model = pieces.Model(("<unk>", "a", "b", "ab", "ba", "▁", "▁a"), (0.0, -2.0, -2.5, -3.0, -2.9, -1.0, -2.2), (2, 1, 1, 1, 1, 1, 1), True, 0, False)
    codec = pieces.Codec(model)
    known = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds, strict=True) if k == 1}

    def best(text):
        if not text:
            return 0.0
        return max(known[text[:n]] + best(text[n:]) for n in (1, 2) if text[:n] in known)

    for text in ("abab", "baab", "aabb ab", "a b ba"):
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        assert abs(sum(model.scores[i] for i in ids) - best("▁" + text.replace(" ", "▁"))) < 1e-9


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation_is_a_bijection(n):
    slots = packing.permute(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    assert n < 1000 or (slots != packing.permute(np.arange(n), n, packing.Config(key=1))).any()


def test_shards_hold_every_id_once(spark, tmp_path):
    config = packing.Config(length=8, per_shard=5)
    ranks = packing.load_ranks()
    texts = [(1, "one two three " * 9), (2, ""), (3, None), (4, "x"), (4, "x"), (5, "ü" * 40)]
    ordered = packing.in_training_order(spark.createDataFrame(texts, "doc_id long, text string"), ranks, config)
    rows = sorted(ordered.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    manifest = packing.write_shards(ordered, str(tmp_path)).collect()
    assert sum(m.n for m in manifest) == len(rows)
    read = packing.read_slots(str(tmp_path), 0, len(rows), config)
    assert read.shape == (len(rows), 8) and [x.tobytes() for x in read] == [bytes(r.ids) for r in rows]
    assert (packing.read_slots(str(tmp_path), 3, 4, config) == read[3:7]).all()
    import tiktoken

    encoder = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.part)):
        if r.doc_id != 4:
            whole.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), "<u2")[: r.n_ids].tolist())
    assert whole == {i: [*encoder.encode_ordinary(t), config.end_id] for i, t in texts if t and i != 4}
    assert packing.in_training_order(spark.createDataFrame([], "doc_id long, text string"), ranks, config).count() == 0


def test_white_space_is_cut_as_the_pattern_cuts(monkeypatch):
    import random

    import tiktoken

    encoder = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=packing.load_ranks(), special_tokens={})
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "b7", "!", " ", "  ", "\n", "\u3000", "\x1c", "\t \t"]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["x" + " " * 5000 + "y", " " * 5000, "\n" * 3000 + "z" + "\xa0" * 3000, " " * packing.LONG_RUN]
    for t in texts:
        assert packing.ids_of(encoder, t) == encoder.encode_ordinary(t)
    monkeypatch.setattr(packing, "_LONG_RUN", packing.re.compile(packing._LONG_RUN.pattern.replace(str(packing.LONG_RUN), "2")))
    for t in texts:
        assert packing.ids_of(encoder, t) == encoder.encode_ordinary(t)


def test_very_long_runs(spark):
    texts = [(1, "x" + " " * 5_000_000 + "y"), (2, "q" * 1_000_000), (3, " \n" * 500_000), (4, "x")]
    ordered = packing.in_training_order(spark.createDataFrame(texts, "doc_id long, text string"), packing.load_ranks())
    assert {r.doc_id for r in ordered.select("doc_id").distinct().collect()} == {1, 2, 3, 4}
