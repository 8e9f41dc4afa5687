"""A log-bilinear language model, trained with noise-contrastive estimation.

The words of all training texts are counted on the executors; the counts give
the base score, the vocabulary and the noise distribution. A word's probability
has two factors, both normalised: its class, given the two words before, and the
word in its class. The most frequent words are classes of their own. The words
behind them are put into classes of ``class_words`` by the topic that they are
most often found in (a mixture of word distributions over a bounded sample; each
training text counts for its likeliest topic) and by frequency, and have vectors
and biases of their own; rarer words of the table share classes by topic and
frequency, in which they are drawn by their counts, and so do, in one class, all
words outside the table and one unseen word. Contexts go by class and, for
frequent words, by word, through embeddings and one matrix for each place. So
every word's probability depends on its context, and classes, vectors and tables
grow with the vocabulary up to the sizes that a worker holds.

A bounded sample gives the start. Then training texts are dealt by the hash of
their ids to parts of about ``part_tokens`` tokens, whose number the counts give;
each part is passed once, in an order of its own, from the same start, and the
parameters of all parts are averaged by the tokens that moved them. The result
doesn't depend on how Spark deals out rows.

Counts of the most frequent words reach the Python workers as a bounded table;
all other words meet their counts in a join, so no count is approximate.

Defined results: a null text is empty and scores its end only; a word that no
training text holds counts as one more type with half a token; without training
tokens every word is unknown. Repeated rows are scored alike. Extra columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.llm.common import bytes_column, fold_of, ids_only, materialise, table

#: No word holds a line feed, so it names the end.
END = b"\n"


@dataclass(frozen=True)
class Config:
    folds: int = 5
    held_fold: int = 1
    #: Frequent words that are classes of their own, the end among them.
    singles: int = 32
    #: Words with an output vector of their own, and of a class of such words.
    outputs: int = 16_384
    class_words: int = 128
    #: Words with an input vector of their own beside that of their class.
    inputs: int = 2048
    size: int = 16
    noise: int = 64
    word_noise: int = 2
    batch: int = 8192
    #: Topics, and the frequent words of the sample that tell them apart.
    topics: int = 8
    topic_words: int = 512
    topic_passes: int = 25
    #: Texts of the bounded sample that topics and start are fitted on.
    start_texts: int = 400
    start_passes: int = 12
    start_rate: float = 0.12
    rate: float = 0.03
    part_tokens: int = 2_000_000
    most_parts: int = 65_536
    #: Words whose counts and classes each Python worker holds.
    table_words: int = 300_000


def words_of(text: bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ after lower-casing A-Z: bytes are split at just
    these characters."""
    return text.lower().split() if text else []


def sample(train: DataFrame, config: Config) -> list[bytes]:
    """The bounded sample: distinct texts of the rows with least hashes of ids."""
    rows = ids_only(train, "doc_id", "text").where("text IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(config.start_texts)
    return list(dict.fromkeys(r.text.encode() for r in rows.toLocalIterator()))


@dataclass
class Topics:
    """Log shares of the topics and of the words in each of them."""

    place: dict[bytes, int]
    prior: np.ndarray  # (topics,)
    words: np.ndarray  # (topics, words)

    def of(self, words: list[bytes]) -> int:
        known = [i for i in map(self.place.get, words) if i is not None]
        if not known:
            return int(self.prior.argmax())
        return int((self.prior + self.words[:, known].sum(1)).argmax())


def fit_topics(texts: list[bytes], config: Config) -> Topics:
    """A mixture of word distributions, by expectation maximisation from the
    texts that are farthest from one another."""
    split = [words_of(t) for t in texts]
    total = Counter(w for words in split for w in words)
    top = sorted(total, key=lambda w: (-total[w], w))[: config.topic_words]
    place = {w: i for i, w in enumerate(top)}
    x = np.zeros((len(split), max(1, len(top))))
    for row, words in zip(x, split, strict=True):
        np.add.at(row, [place[w] for w in words if w in place], 1)
    k = config.topics
    if not len(x):
        return Topics(place, np.zeros(k), np.zeros((k, 1)))
    share = (x + 0.01) / (x + 0.01).sum(1, keepdims=True)
    unit = np.sqrt(share)
    picked, near = [int(x.sum(1).argmax())], np.full(len(x), -1.0)
    while len(picked) < k:
        near = np.maximum(near, unit @ unit[picked[-1]])
        picked.append(int(near.argmin()))
    held = (unit @ unit[picked].T).argmax(1)
    weight = np.eye(k)[held]
    for _ in range(config.topic_passes):
        prior = np.log((weight.sum(0) + 1) / (len(x) + k))
        counts = weight.T @ x + 0.1
        words = np.log(counts / counts.sum(1, keepdims=True))
        z = prior + x @ words.T
        weight = np.exp(z - z.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
    return Topics(place, prior, words)


def count(train: DataFrame, topics: Topics) -> DataFrame:
    """(word, c, topic) over whole training texts, each with one end: how often
    a word stands, and the topic in whose texts it does most; written once."""
    held, k = train.sparkSession.sparkContext.broadcast(topics), len(topics.prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, found = held.value.of, [Counter() for _ in range(k)]

        def emit() -> Iterator[pa.RecordBatch]:
            for topic, counted in enumerate(found):
                if counted:
                    columns = [pa.array(list(counted), pa.binary()), pa.array(np.full(len(counted), topic, np.int32)), pa.array(list(counted.values()), pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["word", "topic", "c"])
                    counted.clear()

        for batch in batches:
            for text in bytes_column(batch.column(0)):
                words = words_of(text)
                mine = found[of(words)]
                mine.update(words)
                mine[END] += 1
            if sum(map(len, found)) > 300_000:
                yield from emit()
        yield from emit()

    by_topic = ids_only(train, "text").mapInArrow(run, "word binary, topic int, c long").groupBy("word").agg(*[F.sum(F.when(F.col("topic") == t, F.col("c")).otherwise(0)).alias(f"t{t}") for t in range(k)])
    sums = F.array(*[F.col(f"t{t}") for t in range(k)])
    most = F.array_position(sums, F.array_max(sums)) - 1
    return materialise(by_topic.select("word", F.aggregate(sums, F.lit(0).cast("long"), lambda a, b: a + b).alias("c"), most.cast("int").alias("topic")), "words")


@dataclass
class Counts:
    """Exact totals, and the most frequent words in order, the end first."""

    tokens: int
    types: int
    words: list[bytes]
    counts: np.ndarray
    topics: np.ndarray


def totals(counted: DataFrame, config: Config) -> Counts:
    n, v = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    end = counted.where(F.col("word") == F.lit(END)).select("c").first()
    top = counted.where(F.col("word") != F.lit(END)).orderBy(F.desc("c"), "word").limit(config.table_words - 1).toArrow()
    words = [END, *top.column("word").to_pylist()]
    counts = np.array([end.c if end else 0, *top.column("c").to_pylist()], np.int64)
    return Counts(n, v, words, counts, np.array([0, *top.column("topic").to_pylist()], np.int64))


class Classes:
    """Which class each word of the table is in, by its rank, and the words of
    each class; the last class is that of all words outside the table."""

    def __init__(self, words: Counts, config: Config):
        n = len(words.words)
        singles, own = min(config.singles, n), min(config.outputs, n)
        self.of = np.arange(n)
        ranks = np.arange(singles, own)
        ranks = ranks[np.argsort(words.topics[ranks], kind="stable")]
        topics = words.topics[ranks]
        within = np.arange(len(ranks)) - np.searchsorted(topics, topics)
        keys, made = np.unique(np.stack([topics, within // config.class_words], 1), axis=0, return_inverse=True)
        self.of[ranks] = singles + made.ravel()
        tail = np.arange(own, n)
        rare, shared = np.unique(np.stack([words.topics[tail], np.log2(np.maximum(1, words.counts[tail])).astype(np.int64)], 1), axis=0, return_inverse=True)
        self.of[tail] = singles + len(keys) + shared.ravel()
        self.first_own, self.first_shared = singles, singles + len(keys)
        self.other = singles + len(keys) + len(rare)
        self.n = self.other + 1
        #: own words, class after class: ranks by slot, slots by rank (-1: none)
        self.ranks, self.slots = ranks, np.full(n + 1, -1)
        self.slots[ranks] = np.arange(len(ranks))
        self.bounds = np.searchsorted(made.ravel(), np.arange(len(keys) + 1))
        smooth = words.counts + 0.5
        self.totals = np.bincount(self.of, smooth, minlength=self.n)
        self.totals[self.other] = words.tokens - words.counts.sum() + 0.5 * (words.types - int((words.counts > 0).sum()) + 1)
        self.log_share = np.log(smooth[ranks] / self.totals[self.of[ranks]]) if len(ranks) else np.zeros(0)
        counts = np.bincount(self.of, words.counts, minlength=self.n)
        counts[self.other] = words.tokens - words.counts.sum()
        self.noise = (counts + 1) / (counts + 1).sum()


@dataclass
class Model:
    config: Config
    words: Counts
    embed: np.ndarray  # (classes + 1, size): input classes, and the begin
    turn: np.ndarray  # (2, size, size): one matrix for each place
    own: np.ndarray  # (inputs + 1, size): added for frequent words; the last is 0
    out: np.ndarray  # (classes, size + 1): vectors and biases of classes
    within: np.ndarray  # (own words, size + 1): those of words in their class

    @cached_property
    def classes(self) -> Classes:
        return Classes(self.words, self.config)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "classes"}

    def parts(self) -> list[np.ndarray]:
        """The parameters, as rows of one width or one less."""
        return [self.embed, self.turn.reshape(-1, self.config.size), self.own, self.out, self.within]

    def with_parts(self, parts: list[np.ndarray]) -> Model:
        embed, turn, own, out, within = (p.astype(np.float32) for p in parts)
        made = Model(self.config, self.words, embed, turn.reshape(2, self.config.size, self.config.size), own, out, within)
        made.__dict__["classes"] = self.classes
        return made


def new_model(words: Counts, config: Config) -> Model:
    rng, classes = np.random.default_rng(7), Classes(words, config)
    shapes = ((classes.n + 1, config.size), (2, config.size, config.size), (classes.n, config.size + 1))
    embed, turn, out = (rng.normal(0, 0.3, s).astype(np.float32) for s in shapes)
    out[:, -1] = np.log(classes.noise)
    return Model(config, words, embed, turn, np.zeros((config.inputs + 1, config.size), np.float32), out, np.zeros((len(classes.ranks), config.size + 1), np.float32))


@dataclass
class Tokens:
    """Of all tokens of some texts: classes and own rows of the two words before,
    class and slot of the token itself."""

    one: np.ndarray
    two: np.ndarray
    one_own: np.ndarray
    two_own: np.ndarray
    target: np.ndarray
    slot: np.ndarray

    def take(self, at) -> Tokens:
        return Tokens(self.one[at], self.two[at], self.one_own[at], self.two_own[at], self.target[at], self.slot[at])


def _tokens(ranks: np.ndarray, lengths: np.ndarray, model: Model) -> Tokens:
    """ranks holds each text's words and its end; a negative rank is a word
    outside the table."""
    c, inputs, n = model.classes, model.config.inputs, len(ranks)
    target = np.where(ranks < 0, c.other, c.of[ranks])
    own = np.where((ranks < 0) | (ranks >= inputs), inputs, ranks)
    first = np.cumsum(lengths) - lengths
    second = first[lengths > 1] + 1

    def shifted(values: np.ndarray, by: int, begin: int) -> np.ndarray:
        out = np.full(n, begin)
        out[by:] = values[:-by] if n > by else values[:0]
        out[first] = begin
        if by == 2:
            out[second] = begin
        return out

    return Tokens(shifted(target, 1, c.n), shifted(target, 2, c.n), shifted(own, 1, inputs), shifted(own, 2, inputs), target, c.slots[ranks])


def _rank(texts: list[bytes | None], place: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    split = [words_of(t) for t in texts]
    ranks = np.array([r for words in split for r in (*[place.get(w, -1) for w in words], 0)], np.int64)
    return ranks, np.array([len(w) + 1 for w in split], np.int64), split


def _sum_rows(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows added up by their place in a table of n rows."""
    return np.stack([np.bincount(at, column, minlength=n) for column in rows.T], 1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Trainer:
    """Passes of noise-contrastive estimation over tokens; a batch shares its
    noise classes, and a token has noise words of its class of its own."""

    def __init__(self, model: Model, rate: float, seed: int):
        self.model, self.rate, self.rng = model, rate, np.random.default_rng(seed)
        self.now = [p.copy() for p in model.parts()]
        self.seen = [np.full(p.shape, 1e-3, np.float32) for p in self.now]
        self.moved = np.zeros(len(self.now[4]), np.int64)  # how often a word's row was
        self.tokens = 0
        c = model.classes
        self.sums = np.concatenate([[0.0], np.cumsum(np.exp(c.log_share))])

    def result(self) -> Model:
        return self.model.with_parts(self.now)

    def _step(self, part: int, gradient: np.ndarray, rows=slice(None)) -> None:
        self.seen[part][rows] += gradient * gradient
        self.now[part][rows] -= self.rate * gradient / np.sqrt(self.seen[part][rows])

    def train(self, tokens: Tokens) -> None:
        for at in range(0, len(tokens.target), self.model.config.batch):
            self._batch(tokens.take(slice(at, at + self.model.config.batch)))
        self.tokens += len(tokens.target)

    def _batch(self, x: Tokens) -> None:
        m, c, n = self.model.config, self.model.classes, len(x.target)
        embed, turn, own, out, within = self.now
        first, second = turn[: m.size], turn[m.size :]
        a, b = embed[x.one] + own[x.one_own], embed[x.two] + own[x.two_own]
        h = a @ first + b @ second
        # classes: how far each is taken for noise; the target is data once more
        drawn = np.bincount(self.rng.choice(c.n, m.noise, p=c.noise), minlength=c.n).astype(np.float32)
        taken = np.flatnonzero(drawn)
        bias = out[:, -1] - np.log(m.noise * c.noise).astype(np.float32)
        g = _sigmoid(h @ out[taken, :-1].T + bias[taken])
        g *= drawn[taken] / n
        rows = out[x.target, :-1]
        data = (_sigmoid(np.einsum("ij,ij->i", h, rows) + bias[x.target]) - 1) / n
        dh = g @ out[taken, :-1] + data[:, None] * rows
        d_out = _sum_rows(x.target, np.concatenate([data[:, None] * h, data[:, None]], 1), c.n)
        d_out[taken, :-1] += g.T @ h
        d_out[taken, -1] += g.sum(0)
        # words of their class, against words drawn from it by count
        mine = np.flatnonzero(x.slot >= 0)
        if len(mine):
            at = x.target[mine] - c.first_own
            low, high = self.sums[c.bounds[at]], self.sums[c.bounds[at + 1]]
            u = low[:, None] + self.rng.random((len(mine), m.word_noise)) * (high - low)[:, None]
            noise = np.clip(np.searchsorted(self.sums, u, "right") - 1, c.bounds[at][:, None], c.bounds[at + 1][:, None] - 1)
            ids = np.concatenate([x.slot[mine][:, None], noise], 1)
            rows, hs = within[ids], h[mine]
            gw = _sigmoid((rows[:, :, :-1] @ hs[:, :, None])[:, :, 0] + rows[:, :, -1] - np.float32(np.log(m.word_noise)))
            gw[:, 0] -= 1
            gw /= n
            dh[mine] += (gw[:, None, :] @ rows[:, :, :-1])[:, 0]
            flat = ids.ravel()
            order = np.argsort(flat, kind="stable")
            places = flat[order]
            heads = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
            with_one = np.concatenate([hs, np.ones((len(hs), 1), np.float32)], 1)
            gradient = np.add.reduceat(gw.ravel()[order, None] * with_one[order // ids.shape[1]], heads, axis=0)
            self._step(4, gradient, places[heads])
            self.moved[places[heads]] += np.diff(np.append(heads, len(places)))
        da, db = dh @ first.T, dh @ second.T
        d_own = _sum_rows(np.concatenate([x.one_own, x.two_own]), np.concatenate([da, db]), len(own))
        d_own[-1] = 0
        self._step(0, _sum_rows(np.concatenate([x.one, x.two]), np.concatenate([da, db]), len(embed)))
        self._step(1, np.concatenate([a.T @ dh, b.T @ dh]))
        self._step(2, d_own)
        self._step(3, d_out)


def start(texts: list[bytes], words: Counts, config: Config) -> Model:
    """A model fitted on the bounded sample."""
    model = new_model(words, config)
    if not texts:
        return model
    ranks, lengths, _ = _rank(texts, {w: i for i, w in enumerate(words.words)})
    tokens, trainer = _tokens(ranks, lengths, model), Trainer(model, config.start_rate, 7)
    for _ in range(config.start_passes):
        trainer.train(tokens.take(trainer.rng.permutation(len(ranks))))
    return trainer.result()


def train_on_all(train: DataFrame, model: Model) -> Model:
    """Every training text is passed once, in its part; see the module's text."""
    config, spark = model.config, train.sparkSession
    parts = min(config.most_parts, max(1, -(-model.words.tokens // config.part_tokens)))
    held, width = spark.sparkContext.broadcast(model), config.size + 1
    names = [f"v{i}" for i in range(width)]
    firsts = np.cumsum([0, *(len(p) for p in model.parts())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = held.value
        place = {w: i for i, w in enumerate(begin.words.words)}
        trainer, part, texts, size = None, None, [], 0

        def learn() -> None:
            ranks, lengths, _ = _rank(texts, place)
            trainer.train(_tokens(ranks, lengths, begin))
            texts.clear()

        def emit() -> Iterator[pa.RecordBatch]:
            learn()
            for k, p in enumerate(trainer.now):
                weight = trainer.moved if k == 4 else np.full(len(p), trainer.tokens)
                rows = np.flatnonzero(weight)
                values = np.zeros((len(rows), width), np.float64)
                values[:, : p.shape[1]] = p[rows] * weight[rows, None]
                yield pa.RecordBatch.from_arrays([pa.array((firsts[k] + rows).astype(np.int32)), pa.array(weight[rows].astype(np.int64)), *[pa.array(v.astype(np.float32)) for v in values.T]], ["at", "n", *names])

        for batch in batches:
            for mine, text in zip(batch.column(0).to_pylist(), bytes_column(batch.column(1)), strict=True):
                if mine != part:
                    if trainer is not None:
                        yield from emit()
                    trainer, part, size = Trainer(begin, config.rate, 11 + mine), mine, 0
                texts.append(text)
                size += len(text or b"")
                if size > 500_000:
                    learn()
                    size = 0
        if trainer is not None:
            yield from emit()

    dealt = ids_only(train, "doc_id", "text").select(F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part"), "text", F.xxhash64("doc_id", "text").alias("place"))
    ordered = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "place", "text").select("part", "text")
    moved = ordered.mapInArrow(run, "at int, n long, " + ", ".join(f"{v} float" for v in names))
    mean = moved.groupBy("at").agg(*[(F.sum(F.col(v).cast("double")) / F.sum("n")).cast("float").alias(v) for v in names]).toArrow()
    flat = np.zeros((int(firsts[-1]), width), np.float32)
    for k, p in enumerate(model.parts()):
        flat[firsts[k] : firsts[k + 1], : p.shape[1]] = p
    if mean.num_rows:
        flat[mean.column("at").to_numpy()] = np.stack([mean.column(v).to_numpy() for v in names], 1)
    return model.with_parts([flat[a:b, : p.shape[1]] for a, b, p in zip(firsts, firsts[1:], model.parts(), strict=False)])


def _picked_log_softmax(scores: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Natural log probability of the picked column; scores are overwritten.
    Large ones are first taken down by each row's greatest."""
    found = scores[np.arange(len(scores)), picked]
    top = 0.0
    if max(scores.max(initial=0), -scores.min(initial=0)) > 60:
        top = scores.max(1)
        scores -= top[:, None]
    np.exp(scores, out=scores)
    return found - top - np.log(scores @ np.ones(scores.shape[1], np.float32))


def log_probabilities(model: Model, x: Tokens) -> np.ndarray:
    """Natural log probability of each token, its class's and, for words with a
    vector of their own, theirs in the class; both are normalised."""
    c, out = model.classes, np.empty(len(x.target))
    one, two = model.embed @ model.turn[0], model.embed @ model.turn[1]
    one_own, two_own = model.own @ model.turn[0], model.own @ model.turn[1]
    h = np.empty((len(out), model.config.size), np.float32)
    for at in range(0, len(out), 8192):
        k = slice(at, at + 8192)
        h[k] = one[x.one[k]] + one_own[x.one_own[k]] + two[x.two[k]] + two_own[x.two_own[k]]
        out[k] = _picked_log_softmax(h[k] @ model.out[:, :-1].T + model.out[:, -1], x.target[k])
    mine = np.flatnonzero(x.slot >= 0)
    mine = mine[np.argsort(x.target[mine], kind="stable")]
    cuts = np.searchsorted(x.target[mine], np.arange(c.first_own, c.first_shared + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        a, b = c.bounds[k], c.bounds[k + 1]
        for at in range(cuts[k], cuts[k + 1], 8192):
            rows = mine[at : min(at + 8192, cuts[k + 1])]
            scores = h[rows] @ model.within[a:b, :-1].T + (model.within[a:b, -1] + c.log_share[a:b]).astype(np.float32)
            out[rows] += _picked_log_softmax(scores, x.slot[rows] - a)
    return out


def score(docs: DataFrame, counted: DataFrame, model: Model) -> DataFrame:
    """doc_id, fold, n_tokens, n_known, base_score, score of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    config, words = model.config, model.words
    kind = docs.schema["doc_id"].dataType.simpleString()
    base_total = words.tokens + 0.5 * (words.types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        place = {w: i for i, w in enumerate(m.words.words)}
        c = m.classes
        counts = np.append(m.words.counts, 0)
        smoothed = np.log10(counts + 0.5)
        # words without a vector are drawn from their class by count
        share = np.log10(c.totals)
        shared = np.append(c.of >= c.first_shared, True)
        class_of = np.append(c.of, c.other)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ranks, lengths, split = _rank(bytes_column(batch.column(2)), place)
                first = np.cumsum(lengths) - lengths
                lp = log_probabilities(m, _tokens(ranks, lengths, m)) / np.log(10)
                rare = ranks < 0
                base = np.where(rare, 0.0, smoothed[ranks]) - np.log10(base_total)
                drawn = np.where(shared[ranks], np.where(rare, 0.0, smoothed[ranks]) - share[class_of[ranks]], 0.0)
                known = (~rare) & (counts[ranks] > 0)
                others = [[w for w in s if w not in place] for s in split]
                tallies = [Counter(o) for o in others]
                offsets = np.cumsum([0, *map(len, tallies)]).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array([w for t in tallies for w in t], pa.binary()), pa.array([n for t in tallies for n in t.values()], pa.int64())], ["word", "n"])
                sums = [np.add.reduceat(x, first) for x in (known.astype(np.int64), base, lp + drawn)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(lengths), *map(pa.array, sums), pa.ListArray.from_arrays(pa.array(offsets), pairs)],
                    ["row", "doc_id", "n_tokens", "known", "base", "score", "rare"],
                )

    # a task's rows keep their ids when it is run again
    named = ids_only(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    parts = materialise(named.mapInArrow(run, f"row long, doc_id {kind}, n_tokens long, known long, base double, score double, rare array<struct<word:binary,n:long>>"), "scored")
    words_left = parts.select("row", F.explode("rare").alias("x")).select("row", "x.word", "x.n")
    met = words_left.join(counted.select("word", "c"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    summed = met.groupBy("row").agg(F.sum(F.col("n") * F.log10(c + 0.5)).alias("more"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more_known"))
    done = parts.drop("rare").join(summed, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return done.select(
        "doc_id",
        (fold_of("doc_id", config.folds) == config.held_fold).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


def fit(docs: DataFrame, config: Config = Config()) -> tuple[DataFrame, Model]:
    """The word counts and the model of the texts outside the held-out fold."""
    train = docs.where(fold_of("doc_id", config.folds) != config.held_fold)
    texts = sample(train, config)
    counted = count(train, fit_topics(texts, config))
    return counted, train_on_all(train, start(texts, totals(counted, config), config))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ids_only(table(spark, sf_dir, "documents"), "doc_id", "text")
    counted, model = fit(docs)
    return score(docs, counted, model)
