"""Normalised keys: weakness ids, commits, paths, hashes, labels. Catalyst only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: target weaknesses with label and risk group, related ones, and
# path parts that need review
TARGETS = {
    "CWE-22": ("PATH_TRAVERSAL", "A01"),
    "CWE-78": ("COMMAND_INJECTION", "A05"),
    "CWE-79": ("XSS", "A05"),
    "CWE-89": ("SQL_INJECTION", "A05"),
    "CWE-287": ("INSECURE_AUTHENTICATION", "A07"),
    "CWE-798": ("HARDCODED_CREDENTIALS", "A07"),
}
RELATED = ("CWE-23", "CWE-36", "CWE-77")
REVIEW_PARTS = ("tests", "test", "docs", "examples", "vendor", "generated", "migrations")
PYTHON_NAMES = ("python", "py", "python3")
UNKNOWN_NAMES = ("", "unknown", "none", "null")


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def is_missing(c: Column, kind: str = "string") -> Column:
    """Null, the empty string or the empty array."""
    return c.isNull() | ((F.size(c) == 0) if kind.startswith("array") else (c.cast("string") == ""))


def normalize_cwes(c: Column) -> Column:
    """Distinct ``CWE-n`` of a text in numeric order; leading zeros go.

    Numbers are compared by length and digits, so none can overflow.
    """
    digits = F.regexp_extract_all(text(c), F.lit(r"(?i)CWE[-_ ]?(\d+)"), F.lit(1))
    bare = F.transform(digits, lambda d: F.regexp_replace(d, "^0+(?=.)", ""))
    order = F.array_sort(F.transform(F.array_distinct(bare), lambda d: F.struct(F.length(d).alias("n"), d.alias("d"))))
    return F.transform(order, lambda s: F.concat(F.lit("CWE-"), s["d"]))


def source_cwes(*columns: Column) -> Column:
    """The same over several texts or arrays at once."""
    return normalize_cwes(F.concat_ws(" ", *columns))


def commit_parts(c: Column) -> Column:
    """Struct of raw, repository, repository_id, commit_id, canonical_url, join_key.

    The last hash behind /commit/ or /commits/ wins, else the last free hash.
    """
    raw = F.trim(text(c))
    repo = F.regexp_replace(F.regexp_extract(raw, r"(?i)github\.com/([^/]+/[^/#?]+)", 1), r"\.git$", "")
    named = F.try_element_at(F.regexp_extract_all(raw, F.lit(r"(?i)/commits?/([0-9a-f]{7,64})(?=[/?#]|$)"), F.lit(1)), F.lit(-1))
    free = F.try_element_at(F.regexp_extract_all(raw, F.lit(r"(?i)(?<![0-9a-f])([0-9a-f]{7,64})(?![0-9a-f])"), F.lit(1)), F.lit(-1))
    sha = F.lower(F.coalesce(named, free))
    repository = F.when(repo != "", repo)
    both = repository.isNotNull() & sha.isNotNull()
    return F.struct(
        raw.alias("raw"),
        repository.alias("repository"),
        F.lower(repository).alias("repository_id"),
        sha.alias("commit_id"),
        F.when(both, F.concat(F.lit("https://github.com/"), repository, F.lit("/commit/"), sha)).otherwise(F.nullif(raw, F.lit(""))).alias("canonical_url"),
        F.when(both, F.concat(F.lower(repository), F.lit("@"), sha)).otherwise(raw).alias("join_key"),
    )


def with_repository(parts: Column, repository: Column) -> Column:
    """commit_parts with the repository of another field where it has none."""
    name = F.coalesce(parts["repository"], clean_repository(repository))
    both = name.isNotNull() & parts["commit_id"].isNotNull()
    rebuilt = F.struct(
        parts["raw"].alias("raw"),
        name.alias("repository"),
        F.lower(name).alias("repository_id"),
        parts["commit_id"].alias("commit_id"),
        F.when(both, F.concat(F.lit("https://github.com/"), name, F.lit("/commit/"), parts["commit_id"])).otherwise(parts["canonical_url"]).alias("canonical_url"),
        F.when(both, F.concat(F.lower(name), F.lit("@"), parts["commit_id"])).otherwise(parts["join_key"]).alias("join_key"),
    )
    return F.when(parts["repository"].isNull(), rebuilt).otherwise(parts)


def lookup_keys(parts: Column) -> Column:
    """The three forms under which a commit may be listed."""
    sha = F.when(parts["commit_id"].isNotNull(), F.concat(F.lit("sha:"), parts["commit_id"]))
    return F.array_distinct(F.array_compact(F.array(F.when(parts["raw"] != "", parts["raw"]), F.when(parts["join_key"] != "", parts["join_key"]), sha)))


def clean_repository(c: Column) -> Column:
    bare = F.regexp_replace(F.trim(text(c)), r"(?i)^https?://github\.com/", "")
    return F.nullif(F.regexp_replace(F.rtrim(bare, F.lit("/")), r"\.git$", ""), F.lit(""))


def clean_path(c: Column) -> Column:
    """Trimmed, with forward slashes, without leading ``./``; empty is null."""
    return F.nullif(F.regexp_replace(F.translate(F.trim(text(c)), "\\", "/"), r"^(\./)+", ""), F.lit(""))


def resolve_path(own: list[Column], enrichment: list[Column]) -> Column:
    return F.coalesce(*[clean_path(c) for c in [*own, *enrichment]])


def is_review_path(c: Column) -> Column:
    parts = F.split(F.lower(text(c)), "/")
    name = F.element_at(parts, -1)
    return F.arrays_overlap(parts, F.array(*[F.lit(p) for p in REVIEW_PARTS])) | name.startswith("test_") | name.endswith("_test.py")


def has_binary_controls(c: Column) -> Column:
    return text(c).rlike(r"[\x00-\x08\x0E-\x1F]")


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def pair_id(repository_id: Column, commit_id: Column, path: Column, file_change_id: Column, function: Column) -> Column:
    """Identity of a pair; null where every part is empty."""
    file = F.coalesce(F.nullif(text(path), F.lit("")), F.when(text(file_change_id) != "", F.concat(F.lit("file_change_id:"), text(file_change_id))))
    parts = [text(x) for x in (repository_id, commit_id, file, function)]
    return F.when(F.concat(*parts) != "", F.sha2(F.concat_ws("|", *parts), 256))


def external_pair_id(repository: Column, commit_id: Column, path: Column, function: Column) -> Column:
    """The same for external pairs: the repository keeps its case, never null."""
    return F.sha2(F.concat_ws("|", *[text(x) for x in (repository, commit_id, path, function)]), 256)


def language_decision(meta: Column, path: Column, ast_valid: Column) -> Column:
    """Struct of is_python, conflict, unknown from metadata, suffix and syntax."""
    name = F.lower(F.trim(text(meta)))
    known = ~name.isin(*UNKNOWN_NAMES)
    suffix = F.regexp_extract(F.lower(text(path)), r"(\.[^./]+)$", 1)
    has_suffix = suffix != ""
    by_meta, by_suffix, by_ast = name.isin(*PYTHON_NAMES), suffix == ".py", F.coalesce(ast_valid, F.lit(False))
    conflict = known & has_suffix & (by_meta != by_suffix)
    python = F.when(conflict, F.lit(True)).when(known, by_meta).when(has_suffix, by_suffix).otherwise(by_ast)
    return F.struct(python.alias("is_python"), conflict.alias("conflict"), (~known & ~has_suffix & ~by_ast).alias("unknown"))


def meaningful_line(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def code_lines(code: Column) -> Column:
    """Distinct collapsed lines that hold code: no blanks, no comments."""
    lines = F.transform(F.split(text(code), r"\r\n|\r|\n"), meaningful_line)
    return F.array_distinct(F.filter(lines, lambda x: ~x.startswith("#") & x.rlike("[A-Za-z0-9_]")))


def approx_tokens(c: Column) -> Column:
    """Words and single signs, and two for the ends of the sequence."""
    return (F.size(F.regexp_extract_all(text(c), F.lit(r"(?U)(\w+|[^\w\s])"), F.lit(1))) + 2).cast("long")


def source_slice(source: Column, start: Column, end: Column) -> Column:
    """Lines start to end and the one behind, as the older importer cut them."""
    return F.array_join(F.slice(F.split(source, "\n"), start, end - start + 2), "\n")


def severity(c: Column) -> Column:
    """The number in parentheses; longer than four characters is no score."""
    inner = F.regexp_extract(text(c), r"\(([^()]*)\)", 1)
    return F.when(F.length(inner) <= 4, inner.try_cast("double"))


def file_to_commit(c: Column) -> Column:
    """owner_name_sha.ext to the commit's link; underscores in names are lost."""
    stem = F.regexp_replace(c, r"\.[A-Za-z]+$", "")
    return F.concat(F.lit("https://github.com/"), F.translate(F.regexp_extract(stem, r"^(.*)_([^_]+)$", 1), "_", "/"), F.lit("/commit/"), F.regexp_extract(stem, r"([^_]+)$", 1))


def labels_of(cwes: Column, place: int = 0) -> Column:
    """Sorted distinct labels (0) or risk groups (1) of the target weaknesses."""
    table = F.create_map(*[x for k, v in TARGETS.items() for x in (F.lit(k), F.lit(v[place]))])
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(cwes, lambda x: F.try_element_at(table, x)))))


def labels_in_order(cwes: Column) -> Column:
    """Labels of the target weaknesses in the order of the weaknesses."""
    table = F.create_map(*[x for k, v in TARGETS.items() for x in (F.lit(k), F.lit(v[0]))])
    return F.array_compact(F.transform(cwes, lambda x: F.try_element_at(table, x)))


def signature(c: Column) -> Column:
    """A method's signature without spaces."""
    return F.replace(F.trim(text(c)), F.lit(" "), F.lit(""))


def commit_link(repository_url: Column, sha: Column) -> Column:
    """The commit's link of a repository's URL, with or without ``.git``."""
    return F.concat(F.regexp_replace(repository_url, r"\.git$", ""), F.lit("/commit/"), sha)


def target_label(variant: Column, vulnerable: Column, cwes: Column) -> Column:
    safe = (variant == "after") | ~vulnerable
    return F.when(safe, F.lit("SAFE")).when(F.size(cwes) == 1, cwes[0]).otherwise(F.raise_error(F.lit("a vulnerable sample needs exactly one weakness")))


def split_group(repository: Column, commit_id: Column) -> Column:
    missing = is_missing(repository) | is_missing(commit_id)
    return F.when(missing, F.raise_error(F.lit("repository or commit is missing"))).otherwise(F.concat_ws("@", F.lower(repository), F.lower(commit_id)))


def line_offsets(lines: Column) -> Column:
    """Places where the lines begin in their text."""
    return F.aggregate(lines, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(x))))
