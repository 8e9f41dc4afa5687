"""Line classes and benchmark windows against brute force."""

import random
import re
import time

from pyspark.sql import functions as F

from patchloom.llm import decontaminate, linedup
from patchloom.llm.common import CLEAN_UP, materialise


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutate(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(out) + 1), rng.randint(0, 2)
        if kind == 0 and at < len(out):
            out.pop(at)
        elif kind == 1:
            out.insert(at, rng.choice("abé "))
        elif at < len(out):
            out[at] = rng.choice("abé ")
    return "".join(out)


def test_banded_distance(spark):
    rng = random.Random(4)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abé ") for _ in range(rng.randint(3, 40)))
        pairs.append((a, mutate(rng, a, rng.randint(0, 4)) or "a"))
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", linedup.banded_distance(F.col("a"), F.col("b"), 2).alias("d"), linedup.chunks_agree(F.col("a"), F.col("b"), 2, 4).alias("c")).collect():
        want = edit_distance(r.a, r.b)
        assert (r.d == want) if want <= 2 else r.d > 2
        assert r.c or want > 2


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(40, 70))) for _ in range(12)]
    docs = []
    for i in range(30):
        lines = [mutate(rng, rng.choice(pool), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 5))] + ["short"] * rng.randint(0, 2)
        docs.append((i, "\n".join(lines)))
    docs += [(90, None), (91, "")]
    order = [(i, at, line) for i, text in docs for at, line in enumerate((text or "").split("\n")) if len(line) >= 40]
    distinct = sorted({line for _, _, line in order})
    up = {x: x for x in distinct}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, a in enumerate(distinct):
        for b in distinct[n + 1 :]:
            if abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2:
                up[find(a)] = find(b)
    first = {}
    for i, at, line in order:
        first.setdefault(find(line), (i, at))
    gone = {(i, at) for i, at, line in order if first[find(line)] != (i, at)}
    want = {i: None if t is None else "\n".join(x for at, x in enumerate(t.split("\n")) if (i, at) not in gone) for i, t in docs}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    clash = {c: F.lit("clash") for c in ("gone", "_id", "_row", "place", "k", "line", "given", "n_lines", "n_gone")}
    got = linedup.without_repeats(df.withColumns(clash)).collect()
    assert {r.doc_id: r.text for r in got} == want and sum(r.n_gone for r in got) == len(gone) > 0
    assert all(r.gone == r._id == r._row == r.given == "clash" and isinstance(r.n_lines, int) for r in got)
    assert linedup.without_repeats(df.limit(0)).count() == 0


def test_growing_distance_equals_brute_force(spark):
    """Replaced words in lines of all lengths, and repeats of short lines."""
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(60)]
    pool = [[rng.choice(vocabulary) for _ in range(n)] for n in (5, 6, 7, 8, 9, 9, 10, 19, 20, 29, 30, 39, 40, 45, 95)]
    lines = []
    for _ in range(150):
        words = list(rng.choice(pool))
        for _ in range(rng.randint(0, len(words) // 8 + 1)):
            at, kind = rng.randrange(len(words)), rng.randint(0, 3)
            words[at : at + (kind > 0)] = [] if kind == 1 else [rng.choice(vocabulary)]
        lines.append(" ".join(words))
    docs = [(i, f"{line}\n\nshort {i % 3}") for i, line in enumerate(lines)]
    distinct = sorted({x for x in lines if len(x) >= 40})
    up = {x: x for x in distinct}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, a in enumerate(distinct):
        for b in distinct[n + 1 :]:
            x, y = a.split(), b.split()
            longer = max(len(x), len(y))
            most = max(1, longer // 10) if longer >= 6 else 0
            if (abs(len(x) - len(y)) <= most and edit_distance(x, y) <= most) or (abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2):
                up[find(a)] = find(b)
    first, want = {}, {}
    for i, text in docs:
        kept = []
        for at, line in enumerate(text.split("\n")):
            if not line or first.setdefault(find(line) if line in up else line, (i, at)) == (i, at):
                kept.append(line)
        want[i] = "\n".join(kept)
    got = linedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"), linedup.WHOLE).collect()
    assert {r.doc_id: r.text for r in got} == want


def test_edits_of_characters_in_lines_of_all_lengths(spark):
    """Two edits, spaces among them, link lines with segments, lines that meet
    by word runs only, and lines of both kinds."""
    rng = random.Random(12)
    lines = []
    for n in [*range(16, 24), 28, 30, 38, 39, 40, 41] * 3:
        line = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))
        for _ in range(2):
            at = [rng.randrange(2, len(line) - 2) for _ in range(2)]
            spaces = [i for i, c in enumerate(line) if c == " "]
            at = rng.sample(spaces, 2) if rng.random() < 0.5 else at
            out = list(line)
            for i in at:
                out[i] = rng.choice(["x", "", " " + out[i], out[i] + "x"])
            lines.append("".join(out))
        lines.append(line)
    docs = [(i, line) for i, line in enumerate(lines)]
    got = {r.doc_id: r.n_gone for r in linedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"), linedup.WHOLE).collect()}
    first = {}
    for i, _ in docs:
        first.setdefault(i // 3, i)
    assert got == {i: int(first[i // 3] != i) for i, _ in docs}


def test_lines_far_apart_never_meet(spark, monkeypatch):
    """Long lines that share a passage and nothing else fill no table of pairs,
    and two lines that are near among them are found."""
    rng = random.Random(13)
    passage = " ".join(f"p{i}" for i in range(25))
    lines = [f"{' '.join(f'w{rng.randrange(10**6)}' for _ in range(100))} {passage} {' '.join(f'w{rng.randrange(10**6)}' for _ in range(100))}" for _ in range(60)]
    lines.append(lines[7].replace(" p3 ", " q ").replace("w", "v", 9))
    met = []

    def written(df, label, codec="zstd"):
        out = materialise(df, label, codec)
        if label == "met":
            met.append(out.count())
        return out

    monkeypatch.setattr(linedup, "materialise", written)
    got = linedup.without_repeats(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), linedup.WHOLE)
    assert [r.doc_id for r in got.where("n_gone > 0").collect()] == [60] and sum(met) <= 6


def test_dense_group_meets_in_few_pairs(spark, monkeypatch):
    """Copies around the limit: one class of most, without all pairs."""
    rng = random.Random(14)
    base = [f"w{rng.randrange(10**6)}" for _ in range(95)]
    lines = []
    for _ in range(300):
        words = list(base)
        for at in rng.sample(range(95), 5):
            words[at] = f"v{rng.randrange(10**6)}"
        lines.append(words)
    up = list(range(300))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(300):
        for b in range(a):
            if sum(x != y for x, y in zip(lines[a], lines[b])) <= 9:
                up[max(find(a), find(b))] = min(find(a), find(b))
    met = []

    def written(df, label, codec="zstd"):
        out = materialise(df, label, codec)
        if label == "met":
            met.append(out.count())
        return out

    monkeypatch.setattr(linedup, "materialise", written)
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id for r in linedup.without_repeats(docs, linedup.WHOLE).where("n_gone = 0").collect()}
    assert got == {find(i) for i in range(300)} and sum(met) < 12_000, met


def test_words_that_share_a_hash_stay_apart(spark):
    """Words are compared by hashes only where no two of the lines share one."""
    held = {}
    for r in spark.range(6000).select(F.concat(F.lit("w"), "id").alias("w")).select("w", F.pmod(F.hash("w"), F.lit(1 << 20)).alias("h")).collect():
        held.setdefault(r.h, []).append(r.w)
    a, b = next(ws for ws in held.values() if len(ws) > 1)[:2]
    x = ["x0", "x1", a, *(f"y{i}" for i in range(17))]
    apart, near = [*x[1:2], b, *x[3:], "z"], [*x[1:], "z"]
    df = spark.createDataFrame([(x, apart), (x, near)], "x array<string>, y array<string>")
    assert edit_distance(x, apart) == 3 and edit_distance(x, near) == 2
    assert [r.near for r in df.select(linedup.words_near(F.col("x"), F.col("y")).alias("near")).collect()] == [False, True]


def test_lines_near_by_characters(spark, monkeypatch):
    """By the plain edit distance and, for long lines, by the banded one."""
    rng = random.Random(10)
    pairs = [(a, mutate(rng, a, rng.randint(0, 4)) or "a") for a in ("".join(rng.choice("abé ") for _ in range(rng.randint(3, 40))) for _ in range(200))]
    df = spark.createDataFrame(pairs, "a string, b string")
    for plain in (1_000, 20):
        monkeypatch.setattr(linedup, "PLAIN", plain)
        for r in df.select("a", "b", linedup.chars_near(F.col("a"), F.col("b"), 2).alias("near")).collect():
            assert r.near == (edit_distance(r.a, r.b) <= 2)


def test_windows_equal_brute_force(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(30)]
    items = [(str(i), " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 10, 14])))) for i in range(8)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(20)) + "! " + rng.choice(items)[1].upper() + " tail") for i in range(25)] + [(50, None), (51, "")]
    bench = spark.createDataFrame([*items, (None, "w1"), ("9", None)], "item_id string, text string")
    for block in (10**6, 60):  # one block, and several passes
        got = decontaminate.match(spark.createDataFrame(docs, "doc_id long, text string"), bench, block_chars=block).collect()
        for r in got:
            n, hit, ids = decontaminate.brute_force(dict(docs)[r.doc_id], items)
            assert (r.n_words, sum(b - a for a, b in r.hit_spans), list(r.item_ids)) == (n, hit, ids)
    assert decontaminate.match(spark.createDataFrame(docs, "doc_id long, text string"), bench.limit(0)).where("size(item_ids) > 0").count() == 0


def test_windows_of_items_without_an_id(spark):
    """They count as hits and name no item, alone or beside an item with an id."""
    a, b = " ".join(f"a{i}" for i in range(10)), " ".join(f"b{i}" for i in range(10))
    bench = spark.createDataFrame([(None, a), (None, b), ("7", b)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"x {a} y"), (2, f"x {b} y"), (3, "x y")], "doc_id long, text string")
    for block in (10**6, 30):
        got = {r.doc_id: (sum(e - s for s, e in r.hit_spans), list(r.item_ids)) for r in decontaminate.match(docs, bench, block_chars=block, nameless=True).collect()}
        assert got == {1: (10, []), 2: (10, ["7"]), 3: (0, [])}
    assert [r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()] == [3]


def test_index_of_a_large_block(monkeypatch):
    """A block of four million characters is held in some tens of bytes a word,
    and finds what brute force finds, in one go or in several."""
    import pickle

    rng = random.Random(1)
    words = [f"w{i}" for i in range(40_000)]
    items = [(str(i), " ".join(rng.choice(words) for _ in range(700))) for i in range(900)]
    index = decontaminate.Index([(i, t.encode()) for i, t in items], {})
    n = sum(len(t) for _, t in items)
    assert n > 3_500_000 and len(pickle.dumps(index)) < 12 * n
    cut = items[5][1].split()[100:140] + ["w1", "zz"] + items[7][1].split()[:9] + items[9][1].split()[-12:]
    want = decontaminate.brute_force(" ".join(cut), [items[5], items[7], items[9]])
    for probes in (10**6, 1, 7):
        monkeypatch.setattr(decontaminate, "PROBES", probes)
        found = list(index.occurrences([w.encode() for w in cut]))
        spans = decontaminate.merge_spans([(a, b) for a, b, _ in found])
        assert (len(cut), sum(b - a for a, b in spans), sorted({i for *_, ids in found for i in ids})) == want


def test_shuffles_are_removed_once_their_table_is_written(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return set(re.findall(r"shuffle_[0-9_]+\.data", disk.getAllFiles().mkString(" ")))

    known = shuffles()
    rows = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    setting = spark.conf.get(CLEAN_UP)
    written = materialise(rows, "rows")
    deadline = time.time() + 5
    while shuffles() - known and time.time() < deadline:
        time.sleep(0.1)
    assert not shuffles() - known and spark.conf.get(CLEAN_UP) == setting
    assert len(written.collect()) == 7
