"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once for each document. The ledger keeps what was
measured and one bit for each failed rule. A policy is a named, versioned mask
over these bits: applying another policy, or asking what a rule costs, reads
the ledger and never the texts.

Defined results: a null or blank text has no words and zero measurements, so it
fails ``too_few_words``. Repeated rows are separate rows of the ledger. Extra
columns are ignored. An empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.llm.common import BLANKS, ids_only, let, table

WINDOW = 8
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Thresholds of the rules; they are the same at every size of input."""

    min_words: int = 20
    max_repeat_pct: int = 30
    max_symbols_per_100_words: int = 30
    max_dup_lines_pct: int = 60
    max_mean_word: float = 25.0
    max_shout_pct: int = 60


@dataclass(frozen=True)
class Policy:
    """The rules whose failure rejects a document."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(r) for r in self.rules)


#: The position of a rule is its bit; new rules are appended, never reordered.
RULES = ("too_few_words", "repeated_windows", "symbol_density", "duplicate_lines", "long_words", "shouting")

BASE = Policy("base", 1, RULES[:2])
DEFAULT = Policy("default", 1, RULES)


def words_of(text: Column) -> Column:
    """Maximal runs of characters outside [\\x20\\x09-\\x0D]; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _covered(hashes: Column) -> Column:
    """Words inside the windows whose hash occurs twice or more.

    Windows sorted by (hash, place) have equal ones side by side. Each such
    window adds the words that the one before it doesn't reach.
    """

    def places(pairs: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            before = (i > 0) & (F.get(pairs, i - 1)["h"] == x["h"])
            after = F.coalesce(F.get(pairs, i + 1)["h"] == x["h"], F.lit(False))
            return before | after

        return F.sort_array(F.transform(F.filter(pairs, twice), lambda x: x["i"]))

    def total(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.when(i == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), p - F.get(at, i - 1))))
        return F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(pairs, lambda p: let(places(p), total))


def repeat_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more in the text.

    Windows are compared by a 64-bit hash; within one text of a million words
    two different windows share one with a chance of about 3e-8.
    """
    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    counted = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(counted)


def measure(docs: DataFrame) -> DataFrame:
    """What the rules need of each text, one row for each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = ids_only(docs, "doc_id", "text").withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    counted = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    letters = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")
    return bare.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        counted.alias("lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        (F.length(text) - F.length(letters)).cast("long").alias("n_capitals"),
    ).select("doc_id", "n_words", "word_chars", "n_symbols", F.col("lines.n").cast("long").alias("n_lines"), F.col("lines.dup").cast("long").alias("n_dup_lines"), "n_repeat_words", "n_capitals")


def _checks(limits: Limits) -> dict[str, Column]:
    c = F.col
    return {
        "too_few_words": c("n_words") < limits.min_words,
        "repeated_windows": 100 * c("n_repeat_words") > limits.max_repeat_pct * c("n_words"),
        "symbol_density": 100 * c("n_symbols") > limits.max_symbols_per_100_words * c("n_words"),
        "duplicate_lines": 100 * c("n_dup_lines") > limits.max_dup_lines_pct * c("n_lines"),
        "long_words": c("word_chars") > limits.max_mean_word * c("n_words"),
        "shouting": 100 * c("n_capitals") > limits.max_shout_pct * c("word_chars"),
    }


def ledger(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Measurements and ``fail_bits`` (bit i: rule i of RULES failed)."""
    checks = _checks(limits)
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(checks[rule], F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measure(docs).withColumn("fail_bits", bits)


def apply_policy(book: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Adds ``kept``: no bit of the policy's mask is set."""
    return book.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0)


def ablations(book: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """What each rule of a policy rejects, alone and beside the others.

    Documents are first counted by bit pattern, at most 2 ** len(RULES) rows;
    the rules are then read off the patterns.
    """
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES.index(r)).cast("long").alias("bit")) for r in policy.rules])
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")
    return (
        patterns.withColumn("r", F.explode(rules))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum("n").alias("n_docs"),
        )
        .withColumns({"policy": F.lit(policy.name), "policy_version": F.lit(policy.version)})
    )


def quality_filter(docs: DataFrame, policy: Policy = DEFAULT, limits: Limits = Limits()) -> DataFrame:
    """The documents that a policy keeps, with the columns of docs.

    The verdict is computed beside each row, so no join and no shuffle. Rows are
    dropped through a generator: a filter would be pushed below the measures and
    evaluate them anew in each rule.
    """
    row = F.struct(*[F.col(c) for c in docs.columns])
    held = docs.select(row.alias("doc_id"), F.col("text"))
    judged = apply_policy(ledger(held, limits), policy)
    return judged.select(F.explode_outer(F.when(F.col("kept"), F.array("doc_id"))).alias("row")).where("row IS NOT NULL").select("row.*")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = apply_policy(ledger(table(spark, sf_dir, "documents")))
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE.mask).cast("long")) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits")
