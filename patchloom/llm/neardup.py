"""Near-duplicate documents by a chosen-path set similarity join.

Texts become sets of distinct word shingles and are sketched by minhashes. Equal
sets meet by fingerprint, so a group of copies is one record, however large. In
every tree a record follows chosen paths: at a node, minhash places picked by
the node's own hash, about 1 / similarity branches for each level, lead to the
children named by the values there. Similar records share each branch with a
chance that adds up to one for a level; dissimilar ones part. A node that is
small enough is compared exhaustively by sketch. A larger one is dealt to blocks
that share pivots, compared, and branched further unless nearly all its records
already lie in one confirmed component and the others have met them all; what is
still large at the last level is compared block by block. Independent trees are
repeated to the target recall.

Records that hang together by sketch form families; each record's full set is
read once more and links are confirmed on full sets: within the family; in a
large family between its main component, block by block, and all other records,
or, if these are many, within the clusters of its nodes. Only links that join
two components are kept, so no group emits all its pairs.

Defined results: null and wordless texts have no shingles and link with nothing;
rows that share an id are one vertex; a null id links with nothing and is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.llm.common import bytes_column, ids_only, materialise, table
from patchloom.llm.components import components
from patchloom.llm.shingles import SIZE, mix, overlap, shingle_sets


@dataclass(frozen=True)
class Config:
    percent: int = 80
    #: Words of a shingle.
    shingle_words: int = SIZE
    trees: int = 10
    places: int = 128
    leaf: int = 256
    pivots: int = 8
    levels: int = 6
    #: Records outside a main component that meet all of it at once.
    others: int = 2048
    #: Records and shingles of a family that one task confirms together.
    family: int = 1024
    family_shingles: int = 4_000_000
    #: Ids that are broadcast at most (8 bytes each); more are joined by shuffle.
    broadcast_ids: int = 1_000_000

    @property
    def least_equal(self) -> int:
        """Equal places that a pair at the threshold has but once in 100,000."""
        s = self.percent / 100
        return int(self.places * s - 4.3 * (self.places * s * (1 - s)) ** 0.5)


def _seeds(n: int, start: int) -> np.ndarray:
    return mix(np.arange(start, start + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """Sixteen bits of the minimum of each of so many hash functions."""
    a = (_seeds(places, 1) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    b = (_seeds(places, 1001) >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(sets), places), np.uint32)
    for i, s in enumerate(sets):
        x = (s >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(x), 4096):
            low = (x[at : at + 4096, None] * a + b).min(0)
            out[i] = low if at == 0 else np.minimum(out[i], low)
    return ((out * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def sketch(docs: DataFrame, config: Config = Config()) -> DataFrame:
    """doc_id, n_shingles, fingerprint (two longs) and sig of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sets = shingle_sets(bytes_column(batch.column(1)), config.shingle_words)
                prints = np.array([[mix(s).sum(dtype=np.uint64), mix(s + np.uint64(7)).sum(dtype=np.uint64)] for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
                sig = signatures(sets, config.places)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array([x.tobytes() for x in sig], pa.binary())],
                    ["doc_id", "n_shingles", "h1", "h2", "sig"],
                )

    return ids_only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, sig binary")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, list]]]:
    """Runs of rows with one value in the first column, across batches."""
    key, held = None, None
    for batch in batches:
        names = batch.schema.names
        keys = batch.column(0).to_numpy()
        columns = [batch.column(i).to_pylist() for i in range(1, len(names))]
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            part = {n: c[a:b] for n, c in zip(names[1:], columns, strict=True)}
            if held is not None and key == keys[a]:
                for n in part:
                    held[n] += part[n]
                continue
            if held is not None:
                yield key, held
            key, held = int(keys[a]), part
    if held is not None:
        yield key, held


def _by_group(df: DataFrame, key: str, fn: Callable[[int, dict[str, list]], list[tuple]], names: list[str], schema: str) -> DataFrame:
    """fn on each group of rows with one key, streamed from sorted partitions.
    All columns of fn's rows are longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for group, held in _groups(batches):
            rows += fn(group, held)
            if len(rows) > 50_000:
                yield _table(rows, names)
                rows = []
        yield _table(rows, names)

    others = [c for c in df.columns if c != key]
    return df.select(key, *others).repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


class _Union:
    """Disjoint sets over range(n); the root of a set is its least member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def _equal_places(sig: np.ndarray, i: int) -> np.ndarray:
    return (sig[i + 1 :] == sig[i]).sum(1)


def _clusters(config: Config) -> Callable[[int, dict[str, list]], list[tuple]]:
    """(group, rec, root) of the records that hang together in a group."""

    def compare(group: int, held: dict[str, list]) -> list[tuple]:
        order = sorted(dict(zip(held["rec"], range(len(held["rec"])), strict=True)).items())
        recs = [r for r, _ in order]
        sig = np.frombuffer(b"".join([held["sig"][i] for _, i in order]), np.uint16).reshape(len(recs), -1)
        union = _Union(len(recs))
        for i in range(len(recs) - 1):
            for j in np.flatnonzero(_equal_places(sig, i) >= config.least_equal):
                union.join(i, i + 1 + int(j))
        roots = [union.find(i) for i in range(len(recs))]
        sizes = np.bincount(roots, minlength=len(recs))
        return [(group, recs[i], recs[r]) for i, r in enumerate(roots) if sizes[r] > 1]

    return compare


def _roots(reps: DataFrame, config: Config) -> DataFrame:
    """(node, rec): the grandchildren of every tree's root."""
    order = np.argsort(_seeds(config.places, 5001))
    branches: list[tuple[int, int, int]] = []
    for tree in range(config.trees):
        # two levels at once: about 1.25 ** 2 branches on average, at 0.8
        for _ in range(2 if tree % 5 < 3 else 1):
            at = 2 * len(branches)
            branches.append((tree, int(order[at % config.places]), int(order[(at + 1) % config.places])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recs = batch.column(0).to_numpy()
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(recs), -1).astype(np.uint64)
            nodes = [mix(sig[:, one] << np.uint64(16) | sig[:, two] | np.uint64((tree * config.places + one + 1) << 40)) for tree, one, two in branches]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes).view(np.int64)), pa.array(np.tile(recs, len(nodes)))], ["node", "rec"])

    return reps.select("rec", "sig").mapInArrow(run, "node long, rec long")


def _children(large: DataFrame, config: Config) -> DataFrame:
    """(node, rec) below the nodes of large (node, n, rec, sig).

    A node of n records branches as many levels at once, up to four, as records
    of 0.8 similarity would take to shrink to a leaf, with as many branches.
    """
    s = config.percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column(0).to_numpy().view(np.uint64)
            n = batch.column(1).to_numpy().astype(float)
            recs = batch.column(2).to_numpy()
            sig = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint16).reshape(len(recs), -1)
            depth = np.clip(np.ceil(np.log(n / config.leaf) / np.log(1 / s)), 1, 4).astype(int)
            width = np.ceil((1 / s) ** depth).astype(int)
            out_node, out_rec = [], []
            for b in range(int(width.max(initial=0))):
                child = mix(node + np.uint64((b + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
                path = child.copy()
                for d in range(int(depth.max(initial=0))):
                    place = (mix(child + np.uint64(d)) % np.uint64(config.places)).astype(np.int64)
                    step = mix(path ^ (sig[np.arange(len(recs)), place].astype(np.uint64) + np.uint64(1)))
                    path = np.where(d < depth, step, path)
                mine = b < width
                out_node.append(path[mine])
                out_rec.append(recs[mine])
            if out_node:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_node).view(np.int64)), pa.array(np.concatenate(out_rec))], ["node", "rec"])

    return large.select("node", "n", "rec", "sig").mapInArrow(run, "node long, rec long")


def _blocks(large: DataFrame, config: Config) -> DataFrame:
    """(grp, rec, sig, node, pivots): the records of large nodes in blocks that
    share the node's pivots, those with least hashes."""
    blocks = F.ceil(F.col("n") / config.leaf).cast("int")
    placed = large.withColumn("block", F.pmod(F.xxhash64("rec"), blocks).cast("int"))
    least = [F.min(F.struct(F.xxhash64("rec", F.lit(i)), F.col("rec").alias("rec"), F.col("sig").alias("sig"))).alias(f"p{i}") for i in range(config.pivots)]
    pivots = large.groupBy("node", "n").agg(*least).select("node", "n", F.explode(F.array(*[F.struct(F.col(f"p{i}.rec").alias("rec"), F.col(f"p{i}.sig").alias("sig")) for i in range(config.pivots)])).alias("p"))
    dealt = pivots.select("node", F.col("p.rec").alias("rec"), F.col("p.sig").alias("sig"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    return placed.select("node", "rec", "sig", "block").unionByName(dealt).select(F.xxhash64("node", "block").alias("grp"), "rec", "sig")


def _pairs_of_blocks(large: DataFrame, config: Config) -> DataFrame:
    """(grp, rec, sig): every two blocks of a node together, so that all its
    records are compared. Only what no level could split comes here."""
    blocks = F.ceil(F.col("n") / config.leaf).cast("int")
    placed = large.withColumns({"block": F.pmod(F.xxhash64("rec"), blocks).cast("int"), "blocks": blocks})
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("grp"), "rec", "sig")


def candidates(docs: DataFrame, reps: DataFrame, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """(grp, rec, root): the clusters by sketch of all groups of all trees, and
    (a, b): links that were confirmed on the way.

    Every fourth large node is confirmed on full sets at once. A large node
    whose records then lie in one component is done: nothing could add to it.
    One with few records outside its main component is done when these have met
    all others. The rest branches.
    """
    compare, names, schema = _clusters(config), ["grp", "rec", "root"], "grp long, rec long, root long"
    spark = reps.sparkSession
    found: list[DataFrame] = []
    linked = spark.createDataFrame([], "a long, b long")
    frontier = materialise(_roots(reps, config), "frontier")
    for level in range(config.levels):
        sizes = frontier.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        signed = materialise(frontier.join(sizes, "node").join(reps.select("rec", "sig"), "rec").select("node", "n", "rec", "sig"), "nodes")
        leaves = signed.where(F.col("n") <= config.leaf).select(F.col("node").alias("grp"), "rec", "sig")
        found.append(materialise(_by_group(leaves, "grp", compare, names, schema), "leaves"))
        large = signed.where(F.col("n") > config.leaf)
        if large.isEmpty():
            break
        early = materialise(_by_group(_blocks(large.where(F.pmod(F.xxhash64("node"), F.lit(4)) == 0), config), "grp", compare, names, schema), "early")
        linked = materialise(linked.unionByName(_confirmed(docs, early, config)), "linked")
        classes = components(linked)
        sized = _majorities(large.select("node", "n", "rec"), classes)
        large = materialise(large.join(sized.where("others > 0"), "node"), "large")
        if large.isEmpty():
            break
        last = level == config.levels - 1
        few = F.col("others") <= config.others
        rest = large.where(~few)
        dealt = _blocks_with_others(large.where(few), classes, config).unionByName(_pairs_of_blocks(rest, config) if last else _blocks(rest, config))
        found.append(materialise(_by_group(dealt, "grp", compare, names, schema), "blocks"))
        if not last:
            frontier = materialise(_children(rest, config).distinct(), "frontier")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, linked


def _majorities(large: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, class, others): the confirmed component that holds most records of
    a node, and how many records it doesn't hold."""
    roots = classes.select(F.col("node").alias("rec"), "root")
    own = large.join(roots, "rec", "left").groupBy("node", "n", F.coalesce("root", "rec").alias("class")).agg(F.count(F.lit(1)).alias("held"))
    most = own.groupBy("node", "n").agg(F.max(F.struct("held", "class")).alias("m"))
    return most.select("node", F.col("m.class").alias("class"), (F.col("n") - F.col("m.held")).alias("others"))


def _blocks_with_others(large: DataFrame, classes: DataFrame, config: Config) -> DataFrame:
    """(grp, rec, sig): the node's main component in blocks, and with each block
    all records outside it. Every pair that could still join two components is
    in a block, so the node is done. A block holds as many records of the main
    component as there are others, so rows at most double."""
    roots = classes.select(F.col("node").alias("rec"), "root")
    blocks = F.ceil(F.col("n") / F.greatest(F.col("others"), F.lit(config.leaf))).cast("int")
    own = large.join(roots, "rec", "left").withColumn("main", F.coalesce("root", "rec") == F.col("class"))
    block = F.explode(F.when(F.col("main"), F.array(F.pmod(F.xxhash64("rec"), blocks).cast("int"))).otherwise(F.sequence(F.lit(0), blocks - 1)))
    return own.select("node", "rec", "sig", block.alias("block")).select(F.xxhash64("node", "block").alias("grp"), "rec", "sig")


def _confirmed(docs: DataFrame, clusters: DataFrame, config: Config) -> DataFrame:
    """(a, b): links of the records of each cluster, on full sets."""
    members = clusters.select(F.xxhash64("grp", "root").alias("cluster"), "rec").distinct()
    sets = _full_sets(docs, members.select("rec").distinct(), config)
    return _by_group(members.join(sets, "rec").select("cluster", "rec", "shingles", "sig"), "cluster", _confirm(config), ["a", "b"], "a long, b long")


def _confirm(config: Config) -> Callable[[int, dict[str, list]], list[tuple]]:
    """(rec, root) confirmed on full sets within a group.

    A record is compared with those before it that its sketch doesn't rule out
    and that lie in another component so far, so a group of near copies costs
    about a comparison each.
    """
    percent, least = config.percent, config.least_equal

    def confirm(group: int, held: dict[str, list]) -> list[tuple]:
        order = sorted({(r, s, g) for r, s, g in zip(held["rec"], held["shingles"], held["sig"], strict=True)})
        recs = [r for r, _, _ in order]
        sets = [np.frombuffer(s, np.uint64) for _, s, _ in order]
        sig = np.frombuffer(b"".join([g for _, _, g in order]), np.uint16).reshape(len(recs), -1)
        union = _Union(len(recs))
        for i, mine in enumerate(sets):
            if i and recs[i] == recs[i - 1]:
                union.join(i - 1, i)
            for j in np.flatnonzero((sig[:i] == sig[i]).sum(1) >= least).tolist():
                if union.find(i) == union.find(j):
                    continue
                low, high = sorted((len(mine), len(sets[j])))
                if 100 * low >= percent * high:
                    both = overlap(mine, sets[j])
                    if 100 * both >= percent * (low + high - both):
                        union.join(i, j)
        roots = [union.find(i) for i in range(len(recs))]
        return [(recs[i], recs[r]) for i, r in enumerate(roots) if recs[r] != recs[i]]

    return confirm


def _full_sets(docs: DataFrame, members: DataFrame, config: Config) -> DataFrame:
    """(rec, shingles, sig) of the members (rec, each once), from whole texts."""
    n = members.count()
    ids = members.select(F.col("rec").alias("doc_id"))
    held = ids_only(docs, "doc_id", "text").join(F.broadcast(ids) if n <= config.broadcast_ids else ids, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sets = shingle_sets(bytes_column(batch.column(1)), config.shingle_words)
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([g.tobytes() for g in signatures(sets, config.places)], pa.binary())], ["rec", "shingles", "sig"])

    return held.mapInArrow(run, "rec long, shingles binary, sig binary")


def links(docs: DataFrame, reps: DataFrame, config: Config = Config()) -> DataFrame:
    """(node, root) of the records that are linked with another record."""
    clusters, linked = candidates(docs, reps, config)
    edges = clusters.select(F.col("rec").alias("a"), F.col("root").alias("b")).unionByName(linked)
    families = components(edges)
    sized = families.join(reps.select(F.col("rec").alias("node"), "n_shingles"), "node")
    sizes = sized.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
    fits = (F.col("n") <= config.family) & (F.col("shingles") <= config.family_shingles)
    members = materialise(families.join(sizes, "root").select(F.col("node").alias("rec"), F.col("root").alias("family"), fits.alias("fits")), "members")
    small = members.where("fits").select("rec", "family")
    sets = _full_sets(docs, small.select("rec"), config)
    done = _by_group(small.join(sets, "rec").select("family", "rec", "shingles", "sig"), "family", _confirm(config), ["a", "b"], "a long, b long")
    large = members.where("NOT fits").select("rec")
    if large.isEmpty():
        # a family is whole in its task, so its roots are final
        return done.select(F.col("a").alias("node"), F.col("b").alias("root"))
    classes = components(linked)
    whole = materialise(members.where("NOT fits").join(sizes.select(F.col("root").alias("family"), "n"), "family").select(F.col("family").alias("node"), "n", "rec"), "families")
    sized = _majorities(whole, classes)
    few = whole.join(sized.where(F.col("others").between(1, config.others)), "node")
    met = _blocks_with_others(few.withColumn("sig", F.lit(None).cast("binary")), classes, config).select("grp", "rec", F.lit(0).cast("long").alias("root"))
    # other families: clusters of their nodes that don't lie in one component
    many = whole.join(sized.where(F.col("others") > config.others), "node").select("rec")
    named = classes.select(F.col("node").alias("rec"), F.col("root").alias("class"))
    open_ = clusters.join(many, "rec").join(named, "rec", "left").withColumn("class", F.coalesce("class", "rec"))
    mixed = open_.groupBy("grp", "root").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("grp", "root")
    left = open_.join(mixed, ["grp", "root"]).select("grp", "rec", "root")
    rest = _confirmed(docs, materialise(met.unionByName(left), "mixed"), config)
    return components(done.unionByName(rest).unionByName(linked)).where("node <> root")


def near_duplicates(docs: DataFrame, config: Config = Config()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    known = materialise(sketch(docs, config), "sketch")
    named = known.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # min_by over (doc_id, sig): equal sets have equal sketches
    reps = materialise(named.groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rec"), F.min("sig").alias("sig")), "records")
    found = links(docs, reps, config).groupBy("node").agg(F.min("root").alias("root"))
    component = F.coalesce("root", "rec")
    classes = reps.join(found, reps.rec == found.node, "left").select("h1", "h2", "n_shingles", component.alias("component_id"))
    out = known.select("doc_id", "n_shingles", "h1", "h2").join(classes, ["h1", "h2", "n_shingles"], "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.cast("long").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, config: Config = Config()) -> DataFrame:
    """The documents that are their component's first, with docs' columns.
    Of several rows with one id all stay or all go."""
    gone = near_duplicates(docs, config).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
