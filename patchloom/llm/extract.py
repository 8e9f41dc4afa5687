"""Main text of web pages: structure first, then the host's repeated runs.

The markup is read once, with the end tags that HTML leaves out. What stands in
menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles
or reader comments is frame, told by element and role, or by a hint: a class or
id that is such a word, or begins or ends with one. A marked article (``article``,
``main`` or the role) wins over a form and over hints by a part of a name around
it; all unframed articles of a page count, in order, with their own headers. On a
page without one, a hint on a container that holds most of the text doesn't count.

Then the token streams of a host's pages outside marked articles, main text and
frame, are concatenated and their suffixes sorted. Stretches of ``MIN_RUN`` tokens
or more that distinct pages share are boilerplate and are removed. A marked
article is no such evidence, as its passages may well be repeated; it loses only
runs that the frames of two or more distinct pages of the host hold, which are
found by the hashes of the frames' ``MIN_RUN``-grams, so that no article leaves
its task. What stays uncovered is kept. A page that would be covered nearly whole
(``nearly_all``) is a mirror: only what pages that are no mirrors hold, or any
page's frame, counts against it, and if that still covers it, it keeps its text. A host with many pages
is dealt to parts of bounded size; stretches that several parts share are found
by hashes of their ``MIN_RUN``-grams, which cover exactly the same tokens. Its
mirrors are told in a pass before, so that the parts change no result.

Defined results: null or empty html gives empty text; a url without a host
belongs to the host ``''``; pages alone on their host keep everything that
structure leaves. Rows of a host with equal tokens are one page: they don't cover
each other, and all get its text. Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.common import empty_like, ids_only, materialise, table

MIN_RUN = 12
#: Tokens of one host that a task sorts together.
PART_TOKENS = 400_000
#: Grams of repeated frames that tasks hold at most (8 bytes each); more are joined.
HELD_GRAMS = 1_000_000
#: Names of hosts that tasks hold at most; more are joined.
HELD_HOSTS = 200_000
#: Runs cover a page nearly whole if they leave less than this share of its tokens
#: and nowhere MIN_RUN tokens in a row.
MIRROR_SHARE = 0.1

# fixed values: element names, roles, and words and parts of classes and ids
CHROME = frozenset("nav header footer aside menu button select dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
ROLES = frozenset("navigation banner complementary contentinfo search form dialog alertdialog alert menu menubar toolbar".split())
COMMENTS = frozenset("comment comments disqus".split())
OFFERS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion".split())
WORDS = COMMENTS | OFFERS | frozenset(
    "banner sidebar nav navbar navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices alert "
    "newsletter subscribe share sharing social related recommended popup modal login signup widget complementary contentinfo search".split()
)
FIRST = COMMENTS | OFFERS | frozenset("sidebar nav navbar navigation menu breadcrumb breadcrumbs footer cookie cookies consent newsletter subscribe share sharing social popup".split())
LAST = WORDS - {"search", "related", "recommended", "login"}
LISTED = frozenset("posts articles stories links news reading items products topics videos content".split())
LAYOUT = frozenset("no not with without has have hide hidden show is left right one two three col cols layout".split())
HEADERS = frozenset("header masthead banner".split())
# fixed values: what an opening tag closes, and what it looks no further than
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
}

_ATTRIBUTES = r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)|[\"'])*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(script|style|noscript|template|iframe|object|svg|canvas|math|audio|video|textarea|title)\b{_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"(?<![\w-])(class|id|role|hidden|style)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

NONE, SOFT, FIRM, HARD = range(4)


def _hint(name: str) -> tuple[int, str]:
    """(strength, word) of one class or id: firm if it is a word of the frame
    itself, soft if it begins or ends with one."""
    parts = [p for p in _PART.split(_CAMEL.sub("-", name).lower()) if p]
    if not parts:
        return NONE, ""
    if len(parts) == 1:
        return (FIRM, parts[0]) if parts[0] in WORDS else (NONE, "")
    if parts[0] in FIRST or (parts[0] in ("related", "recommended") and parts[1] in LISTED):
        return SOFT, parts[0]
    if parts[-1] in LAST and LAYOUT.isdisjoint(parts):
        return SOFT, parts[-1]
    return NONE, ""


def _frame(name: str, attributes: str, inside: bool) -> tuple[int, str, bool]:
    """(strength, word, marks an article) of an opening tag. inside: in a marked
    article, whose own header is part of it."""
    strength, word, marks = NONE, "", name in ("article", "main")
    if name in CHROME and not (inside and name == "header"):
        strength = HARD
    elif name == "form":
        strength, word = SOFT, "form"
    if not attributes or not (found := _NAMED.findall(attributes)) or name in ("html", "body"):
        return strength, word, marks
    for key, a, b, c in found:
        key, value = key.lower(), a or b or c
        if key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            strength = HARD
        elif key == "role":
            role = value.strip().lower()
            marks |= role in ("main", "article")
            if role in ROLES and not (inside and role == "banner"):
                strength = HARD
        elif key in ("class", "id"):
            for each in value.split():
                now, what = _hint(each)
                if marks and what not in COMMENTS | OFFERS:
                    continue
                if now > strength and not (inside and what in HEADERS):
                    strength, word = now, what
    return strength, word, marks and strength == NONE


def parse(page: str | None) -> tuple[bool, list[str], list[str]]:
    """(whether an article is marked, blocks of the main text, other blocks)."""
    found = blocks_of(page)
    return any(k == "a" for k, _ in found), [b for k, b in found if k != "f"], [b for k, b in found if k == "f"]


def blocks_of(page: str | None) -> list[tuple[str, str]]:
    """(kind, text) of the blocks in page order: ``a`` in a marked article, ``m``
    other main text, ``f`` frame."""
    # text, in a hard frame, hints around it, article, whether in main only
    blocks: list[tuple[str, bool, tuple[int, ...], int, bool]] = []
    hints: list[tuple[int, str, int]] = [(NONE, "", 0)]  # strength, word, article that it stands in
    base = (False, (), 0, False)
    stack: list[tuple[str, tuple[bool, tuple[int, ...], int, bool]]] = []
    opened: Counter = Counter()
    state, articles = base, 0
    text: list[str] = []

    def flush() -> None:
        if text:
            if block := " ".join(entities.unescape("".join(text)).split()):
                blocks.append((block, *state))
            text.clear()

    def back_to(depth: int) -> None:
        nonlocal state
        for name, _ in stack[depth:]:
            opened[name] -= 1
        del stack[depth:]
        new = stack[-1][1] if stack else base
        if new != state:
            flush()
            state = new

    def found(names: set[str], stop: set[str] | None) -> int:
        """Depth of the nearest open element of names; -1 if what comes first is
        in stop (any block, without stop)."""
        for depth in range(len(stack) - 1, -1, -1):
            name = stack[depth][0]
            if name in names:
                return depth
            if name in stop if stop is not None else name not in INLINE:
                return -1
        return -1

    at, page = 0, page or ""
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        inline = name in INLINE
        if not inline:
            flush()
        if m[2]:
            if not opened[name]:
                continue
            depth = found({name}, None) if inline else next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
            if depth >= 0:
                back_to(depth)
            else:  # a formatting element that was left open around blocks
                del stack[next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)]
                opened[name] -= 1
            continue
        if name in VOID or m[4].endswith("/"):
            continue
        if opened["head"] and stack[-1][0] == "head" and name not in IN_HEAD:
            back_to(len(stack) - 1)
        if not inline and opened["p"] and (depth := found({"p"}, None)) >= 0:
            back_to(depth)
        if name in ENDS and (depth := found(*ENDS[name])) >= 0:
            back_to(depth)
        hard, around, article, only_main = state
        strength, word, marks = _frame(name, m[4], article > 0) if not hard else (NONE, "", False)
        if name == "head" or strength == HARD:
            hard = True
        elif strength:
            hints.append((strength, word, article))
            around = (*around, len(hints) - 1)
        elif marks and (not article or only_main):
            articles += 1
            article, only_main = articles, name != "article" and "article" not in m[4].lower()
        new = (hard, around, article, only_main)
        if new != state:
            flush()
            state = new
        stack.append((name, state))
        opened[name] += 1
    text.append(page[at:])
    flush()
    return _sorted_out(blocks, hints)


def _sorted_out(blocks: list[tuple[str, bool, tuple[int, ...], int, bool]], hints: list[tuple[int, str, int]]) -> list[tuple[str, str]]:
    """The kinds of blocks, when all of the page has been seen."""

    def counts(hint: int, article: int) -> bool:
        strength, word, inside = hints[hint]
        return strength == FIRM or word in COMMENTS | OFFERS or not article or inside > 0

    marked = [article > 0 and not hard and not any(counts(h, article) for h in around) for _, hard, around, article, _ in blocks]
    if any(marked):
        within = any(ok and not only_main for ok, (*_, only_main) in zip(marked, blocks, strict=True))
        return [(("m" if within and only_main else "a") if ok else "f", block) for ok, (block, _, _, _, only_main) in zip(marked, blocks, strict=True)]
    sizes: Counter = Counter()
    total = 0
    for block, hard, around, _, _ in blocks:
        if not hard:
            total += len(block)
            for h in around:
                sizes[h] += len(block)
    small = {h for h in sizes if 2 * sizes[h] <= total or hints[h][1] in COMMENTS}
    main = [not hard and small.isdisjoint(around) for _, hard, around, _, _ in blocks]
    return [("m" if ok else "f", block) for ok, (block, *_) in zip(main, blocks, strict=True)]


def nowhere() -> Column:
    """Bounds of no token range."""
    return F.array().cast("array<int>")


def host_of(url: str | None) -> str:
    m = re.match(r"\s*[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def gram_hashes(tokens: list[str], size: int = MIN_RUN) -> np.ndarray:
    """A hash of each run of size tokens, by the place where it begins."""
    if len(tokens) < size:
        return np.zeros(0, np.uint64)
    import xxhash

    words = np.array([xxhash.xxh64_intdigest(t) for t in tokens], np.uint64)
    h = np.zeros(len(tokens) - size + 1, np.uint64)
    for i in range(size):
        h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ words[i : len(h) + i]
        h ^= h >> np.uint64(29)
    return h


class Runs:
    """Equal runs of size tokens in streams, side by side in suffix order.

    group: of each place of the concatenated streams, the number of its run (-1
    where fewer tokens are left); cuts: where the streams begin.
    """

    def __init__(self, streams: list[list[str]], size: int = MIN_RUN):
        ids: dict[str, int] = {}
        lengths = np.array([len(s) for s in streams], np.int64)
        n = int(lengths.sum()) + len(streams)
        stream, at = np.empty(n, np.int64), 0
        for i, tokens in enumerate(streams):
            stream[at : at + len(tokens)] = [ids.setdefault(t, len(ids)) for t in tokens]
            stream[at + len(tokens)] = -1 - i  # no two streams end alike
            at += len(tokens) + 1
        rank = np.unique(stream, return_inverse=True)[1].astype(np.int64)
        order, length = np.argsort(rank, kind="stable"), 1
        while length < size and n:  # suffixes sorted by twice as many tokens
            after = np.full(n, -1, np.int64)
            after[: max(0, n - length)] = rank[length:]
            order = np.lexsort((after, rank))
            a, b = rank[order], after[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
            length *= 2
        equal = np.zeros(n, bool)  # a suffix begins like the one before it in order
        if n > 1:
            left, right = order[:-1], order[1:]
            same = (left + size <= n) & (right + size <= n)
            for d in range(size):
                same &= stream[np.minimum(left + d, n - 1)] == stream[np.minimum(right + d, n - 1)]
            equal[1:] = same
        self.size, self.cuts, self.lengths = size, np.concatenate([[0], np.cumsum(lengths + 1)]), lengths
        self.group = np.empty(n, np.int64)
        self.group[order] = np.cumsum(~equal) - 1
        self.owner = np.repeat(np.arange(len(streams)), lengths + 1)

    def least_and_greatest(self, values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the values at some places, the least and the greatest in each run;
        runs without a place have a least above their greatest."""
        n = int(self.group.max(initial=-1)) + 1
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        np.minimum.at(low, self.group[places], values[places])
        np.maximum.at(high, self.group[places], values[places])
        return low, high


def covered(n: int, starts: np.ndarray, size: int = MIN_RUN) -> np.ndarray:
    """Which of n tokens lie in the runs of size tokens that begin at starts."""
    edge = np.zeros(n + size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge)[:n] > 0


def nearly_all(gone: np.ndarray) -> bool:
    """Whether what is left of a page is a small share in short stretches."""
    left = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
    stretches = left[1::2] - left[::2]
    return bool(stretches.sum() < MIRROR_SHARE * len(gone) and stretches.max(initial=0) < MIN_RUN)


def _evidence(texts: list[list[str]], frames: list[list[str]], sure: list[np.ndarray], elsewhere: dict[str, np.ndarray] | None) -> Callable[[int, np.ndarray | None], np.ndarray]:
    """The tokens of page i that other pages' runs cover: runs of all pages or,
    where mirrors are given, of the pages that are none and of all frames."""
    k = len(texts)
    runs = Runs([*texts, *frames])
    page, framed = runs.owner % max(1, k), runs.owner >= k
    article = np.concatenate([x for s in [*sure, *(np.zeros(len(f), bool) for f in frames)] for x in (_touching(s), [False])]) if k else np.zeros(0, bool)
    bounds: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def gone(i: int, mirror: np.ndarray | None) -> np.ndarray:
        kind = "any" if mirror is None else "plain"
        if kind not in bounds:
            bounds[kind] = runs.least_and_greatest(page, np.flatnonzero(~article if mirror is None else ~article & (framed | ~mirror[page])))
        low, high = bounds[kind]
        group = runs.group[runs.cuts[i] : runs.cuts[i] + runs.lengths[i]]
        held = (high[group] >= 0) & ((low[group] != i) | (high[group] != i))
        if elsewhere is not None and len(texts[i]) >= MIN_RUN:
            grams = gram_hashes(texts[i]).view(np.int64)
            held[: len(grams)] |= np.isin(grams, elsewhere[kind])
        return covered(len(texts[i]), np.flatnonzero(held[: max(0, len(held) - MIN_RUN + 1)])) & ~sure[i]

    return gone


def _mirrors(gone: list[np.ndarray]) -> np.ndarray:
    return np.array([bool(g.any()) and nearly_all(g) for g in gone], bool)


def mirrors(texts: list[list[str]], frames: list[list[str]], sure: list[np.ndarray], elsewhere: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """Which of a host's distinct pages are mirrors; arguments as of clean."""
    found = _evidence(texts, frames, sure, elsewhere)
    return _mirrors([found(i, None) for i in range(len(texts))])


def clean(texts: list[list[str]], frames: list[list[str]], sure: list[np.ndarray], elsewhere: dict[str, np.ndarray] | None = None, mirror: np.ndarray | None = None) -> list[list[str]]:
    """What stays of the texts of a host's distinct pages.

    sure: which tokens stand in a marked article; they stay, and are no evidence.
    elsewhere: gram hashes that other parts of the host hold (``any``), or hold in
    a frame or a page that is no mirror (``plain``). mirror: which pages are
    mirrors, if the pages are a part of the host's.
    """
    found = _evidence(texts, frames, sure, elsewhere)
    gone = [found(i, None) for i in range(len(texts))]
    mirror = _mirrors(gone) if mirror is None else mirror
    for i in np.flatnonzero(mirror):
        gone[i] = found(i, mirror)
    return [t if not g.any() or nearly_all(g) else _left(t, g) for t, g in zip(texts, gone, strict=True)]


def _touching(mine: np.ndarray, size: int = MIN_RUN) -> np.ndarray:
    """Where a run of size tokens begins that holds one of these."""
    sums = np.concatenate([[0], np.cumsum(mine), np.full(size, mine.sum())])
    return sums[size : size + len(mine)] > sums[: len(mine)]


def _left(tokens: list[str], gone: np.ndarray) -> list[str]:
    return [t for t, x in zip(tokens, gone.tolist(), strict=True) if not x]


def _mask(n: int, bounds: list[int]) -> np.ndarray:
    mine = np.zeros(n, bool)
    for a, b in zip(bounds[::2], bounds[1::2], strict=True):
        mine[a:b] = True
    return mine


def _bounds(mine: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8))).tolist()


def _parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, text, sure (bounds of the token ranges in articles),
    loose (whether there are others) and frame of every row."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def read(page: str | None) -> tuple[str, list[int], bool, str]:
        bounds, at, texts, loose = [], 0, [], False
        blocks = blocks_of(page)
        for what, block in blocks:
            if what != "f":
                n = block.count(" ") + 1
                if what == "m":
                    loose = True
                elif bounds and bounds[-1] == at:
                    bounds[-1] = at + n
                else:
                    bounds += [at, at + n]
                at += n
                texts.append(block)
        return " ".join(texts), bounds, loose, " ".join(block for what, block in blocks if what == "f")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                found = list(zip(*map(read, batch.column(2).to_pylist()), strict=True))
                hosts = [host_of(u) for u in batch.column(1).to_pylist()]
                kinds = (pa.string(), pa.list_(pa.int32()), pa.bool_(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(hosts, pa.string()), *(pa.array(x, t) for x, t in zip(found, kinds, strict=True))],
                    ["page_id", "url", "host", "text", "sure", "loose", "frame"],
                )

    return ids_only(pages, "page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, host string, text string, sure array<int>, loose boolean, frame string")


def _grams(streams: DataFrame, keys: list[str]) -> DataFrame:
    """keys and gram of each distinct gram of each row (keys, stream, sure), without
    those that hold a token of an article."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in streams.select(*keys).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (stream, sure) in enumerate(zip(batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist(), strict=True)):
                tokens = stream.split(" ")
                grams = gram_hashes(tokens)
                grams = np.unique(grams[~_touching(_mask(len(tokens), sure))[: len(grams)]]).view(np.int64)
                if len(grams):
                    held = [batch.column(i).take(pa.array(np.full(len(grams), row))) for i in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*held, pa.array(grams)], [*keys, "gram"])

    return streams.select(*keys, "stream", "sure").mapInArrow(run, f"{schema}, gram long")


def _repeated_frames(parsed: DataFrame) -> DataFrame:
    """(host, gram) of the runs that frames of distinct pages hold."""
    frames = parsed.where("frame <> ''").groupBy("host", F.md5("frame").alias("copy")).agg(F.min("frame").alias("stream"))
    return _grams(frames.withColumn("sure", nowhere()), ["host"]).groupBy("host", "gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("host", "gram")


def _without_frames(parsed: DataFrame, framed: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """What takes the runs of repeated frames out of the articles of any rows of
    parsed."""
    grams = framed.limit(HELD_GRAMS + 1).count()
    if not grams:
        return lambda rows: rows
    schema, names = parsed.schema, parsed.columns
    table: dict[str, np.ndarray] = {}
    if grams <= HELD_GRAMS:
        held = framed.orderBy("host", "gram").toArrow()
        hosts, values = np.array(held.column("host").to_pylist(), object), held.column("gram").to_numpy()
        cuts = [0, *(np.flatnonzero(hosts[1:] != hosts[:-1]) + 1).tolist(), len(hosts)]
        table = {hosts[a]: values[a:b] for a, b in zip(cuts, cuts[1:], strict=False)}
        added = lambda rows: rows.withColumn("starts", F.lit(None).cast("array<int>"))
    else:
        own = F.md5(F.concat_ws("\n", "host", "text"))

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for host, copy, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    found = gram_hashes(text.split(" ")).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([host] * len(found), pa.string()), pa.array([copy] * len(found), pa.string()), pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found)], ["host", "copy", "at", "gram"])

        texts = parsed.where("size(sure) > 0").select("host", own.alias("copy"), "text").join(framed.select("host").distinct(), "host", "left_semi")
        probes = texts.dropDuplicates(["copy"]).mapInArrow(probe, "host string, copy string, at int, gram long")
        starts = probes.join(framed, ["host", "gram"]).groupBy("copy").agg(F.collect_list("at").alias("starts"))  # at most a page's tokens
        added = lambda rows: rows.withColumn("copy", own).join(starts, "copy", "left").select(*names, "starts")
    sent = parsed.sparkSession.sparkContext.broadcast(table)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            host, text, sure, starts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("host", "text", "sure", "starts"))
            for i, bounds in enumerate(sure):
                runs = starts[i]
                if not bounds or (not runs and host[i] not in known):
                    continue
                tokens = text[i].split(" ")
                if host[i] in known:
                    runs = np.flatnonzero(np.isin(gram_hashes(tokens).view(np.int64), known[host[i]]))
                mine = _mask(len(tokens), bounds)
                gone = covered(len(tokens), np.asarray(runs, np.int64)) & mine
                if gone.any() and not nearly_all(gone):
                    text[i], sure[i] = " ".join(_left(tokens, gone)), _bounds(mine[~gone])
            new = {"text": pa.array(text, pa.string()), "sure": pa.array(sure, pa.list_(pa.int32()))}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(batch.schema.get_field_index(c))) for c in names], names)

    return lambda rows: added(rows).mapInArrow(cut, schema)


def _between_parts(large: DataFrame) -> DataFrame:
    """(host, part, gram, plain): grams that several parts of a host hold; plain:
    another part in a frame, or in a page that is no mirror."""

    def streams(column: str, plain: Column, sure: Column) -> DataFrame:
        return large.select("host", "part", plain.cast("int").alias("plain"), F.col(column).alias("stream"), sure.alias("sure"))

    held = _grams(streams("text", ~F.col("mirror"), F.col("sure")).unionByName(streams("frame", F.lit(True), nowhere())), ["host", "part", "plain"])
    held = materialise(held.groupBy("host", "gram", "part").agg(F.max("plain").alias("plain")), "grams")
    several = held.groupBy("host", "gram").agg(F.count(F.lit(1)).alias("n"), F.sum("plain").alias("all")).where("n > 1")
    return held.join(several, ["host", "gram"]).select("host", "part", "gram", (F.col("all") > F.col("plain")).alias("plain"))


def _read(left: pd.DataFrame, right: pd.DataFrame) -> tuple[list[list[str]], list[list[str]], list[np.ndarray], dict[str, np.ndarray] | None]:
    """The arguments of clean, of a host's part and of the grams elsewhere."""
    texts, frames = ([s.split(" ") if s else [] for s in left[c]] for c in ("text", "frame"))
    sure = [_mask(len(t), list(b)) for t, b in zip(texts, left["sure"], strict=True)]
    grams = right["gram"].to_numpy(np.int64)
    return texts, frames, sure, {"any": grams, "plain": grams[right["plain"].to_numpy(bool)]} if len(right) else None


def _told(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"host": left["host"], "copy": left["copy"], "mirror": mirrors(*_read(left, right))})


def _cleaned(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    mirror = left["mirror"].to_numpy(bool) if len(left) and left["parts"].iloc[0] > 1 else None
    done = pd.DataFrame({"host": left["host"], "copy": left["copy"], "text": [" ".join(t) for t in clean(*_read(left, right), mirror)]})
    return done[left["loose"].to_numpy(bool)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of pages."""
    read = materialise(_parsed(pages), "pages")
    without_frames = _without_frames(read, materialise(_repeated_frames(read), "frames"))
    # of a page whose text is all in articles only the frame leaves its task
    hosts = materialise(read.where("loose").select("host").distinct(), "hosts")
    few = hosts.limit(HELD_HOSTS + 1).count()
    if not few:
        return without_frames(read).select("page_id", "url", "text")
    hosts = F.broadcast(hosts) if few <= HELD_HOSTS else hosts
    own = F.when(F.col("loose"), F.col("text")).otherwise(F.lit(""))
    sure = F.when(F.col("loose"), F.col("sure")).otherwise(nowhere())
    loose = without_frames(read.join(hosts, "host", "left_semi").select(*read.columns))
    held = loose.select("page_id", "url", "host", "loose", own.alias("text"), sure.alias("sure"), "frame")
    held = held.withColumn("copy", F.md5(F.concat_ws("\n", F.col("loose").cast("string"), "text", F.concat_ws(",", F.col("sure").cast("array<string>")), "frame")))
    # copies are one page, in the sort of a part and between parts
    once = held.groupBy("host", "copy", "loose").agg(F.first("text").alias("text"), F.first("sure").alias("sure"), F.first("frame").alias("frame"))
    tokens = F.size(F.split("text", " ")) + F.size(F.split("frame", " "))
    sizes = once.groupBy("host").agg(F.ceil(F.sum(tokens) / PART_TOKENS).cast("int").alias("parts"))
    placed = once.join(sizes, "host").withColumn("part", F.pmod(F.xxhash64("copy"), F.col("parts")).cast("int"))
    placed = placed.withColumn("mirror", F.lit(False))
    elsewhere = empty_like(pages.sparkSession, T.StructType.fromDDL("host string, part int, gram long, plain boolean"))
    large = placed.where("parts > 1")
    if not sizes.where("parts > 1").isEmpty():
        told = large.groupBy("host", "part").cogroup(_between_parts(large).groupBy("host", "part")).applyInPandas(_told, "host string, copy string, mirror boolean")
        told = materialise(told.where("mirror"), "mirrors")
        placed = placed.drop("mirror").join(told, ["host", "copy"], "left").withColumn("mirror", F.coalesce("mirror", F.lit(False)))
        elsewhere = _between_parts(placed.where("parts > 1"))
    cleaned = placed.select("host", "copy", "part", "parts", "loose", "text", "sure", "frame", "mirror").groupBy("host", "part").cogroup(elsewhere.groupBy("host", "part"))
    texts = cleaned.applyInPandas(_cleaned, "host string, copy string, text string")
    changed = held.where("loose").select("page_id", "url", "host", "copy").join(texts, ["host", "copy"]).select("page_id", "url", "text")
    return without_frames(read.where("NOT loose")).select("page_id", "url", "text").unionByName(changed)


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
