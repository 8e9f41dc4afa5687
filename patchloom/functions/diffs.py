"""Unified diffs and line differences, in Arrow-batched workers."""


import codecs
import difflib
import re

import pandas as pd
from patchloom.functions.udf import arrow_udf

_HEADER = re.compile(r'^diff --git ("(?:[^"\\]|\\.)*"|\S+) ("(?:[^"\\]|\\.)*"|\S+)$')
_HUNK = re.compile(r"^@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@")

FILE_LINES = "array<struct<old_path:string,new_path:string,deleted:array<string>,added:array<string>,context:array<string>,patch:string>>"
FILE_NUMBERS = "array<struct<old_path:string,new_path:string,old_lines:array<int>,new_lines:array<int>>>"


def decode_path(path: str | None) -> str | None:
    """A path of a diff: unquoted, without a/ or b/; /dev/null is none."""
    if path and path.startswith('"') and path.endswith('"') and len(path) > 1:
        path = codecs.escape_decode(path[1:-1].encode())[0].decode("utf-8", "replace")
    if not path or path == "/dev/null":
        return None
    return path[2:] if path[:2] in ("a/", "b/") else path


def collapse(line: str) -> str:
    return " ".join(line.split())


def _is_code(line: str) -> bool:
    return bool(line) and not line.startswith("#") and bool(re.search(r"[A-Za-z0-9_]", line))


def split_files(diff: str | None) -> list[tuple[str | None, str | None, list[str]]]:
    """(old path, new path, lines behind the header) of each file."""
    files: list[tuple[str | None, str | None, list[str]]] = []
    for line in (diff or "").split("\n"):
        if m := _HEADER.match(line):
            files.append((decode_path(m[1]), decode_path(m[2]), []))
        elif files:
            old, new, lines = files[-1]
            if line.startswith(("--- ", "+++ ")) and not any(x.startswith("@@") for x in lines):
                path = decode_path(line[4:].split("\t")[0])
                files[-1] = (path, new, lines) if line[0] == "-" else (old, path, lines)
            else:
                lines.append(line)
    return files


def line_sets(diff: str | None) -> list[dict]:
    """Distinct collapsed code lines of each file by sign, and its raw patch."""
    out = []
    for old, new, lines in split_files(diff):
        sets: dict[str, dict[str, None]] = {"-": {}, "+": {}, " ": {}}
        patch, inside = [], False
        for line in lines:
            inside |= line.startswith("@@")
            if inside and line[:1] in sets and _is_code(code := collapse(line[1:])):
                sets[line[0]][code] = None
            if inside and line[:1] in sets:
                patch.append(line)
        out.append({"old_path": old, "new_path": new, "deleted": list(sets["-"]), "added": list(sets["+"]), "context": list(sets[" "]), "patch": "\n".join(patch)})
    return out


def line_numbers(diff: str | None) -> list[dict]:
    """Changed old and new line numbers of each file. A hunk that changes one
    side only gives the other side its first line as an anchor, unless that side
    has no line at all (``-0,0``)."""
    out = []
    for old, new, lines in split_files(diff):
        sides: tuple[set[int], set[int]] = (set(), set())
        at, seen, first, none = [0, 0], [False, False], [0, 0], [False, False]

        def close(sides=sides, seen=seen, first=first, none=none) -> None:
            for side in (0, 1):
                if seen[1 - side] and not seen[side] and not none[side]:
                    sides[side].add(first[side])

        for line in lines:
            if m := _HUNK.match(line):
                close()
                at[:] = first[:] = [max(1, int(m[1])), max(1, int(m[3]))]
                seen[:] = [False, False]
                none[:] = [m[1] == "0", m[3] == "0"]
            elif line[:1] in ("-", "+"):
                side = "-+".index(line[0])
                sides[side].add(at[side])
                seen[side] = True
                at[side] += 1
            elif line[:1] == " ":
                at[0] += 1
                at[1] += 1
        close()
        out.append({"old_path": old, "new_path": new, "old_lines": sorted(sides[0]), "new_lines": sorted(sides[1])})
    return out


def regions(before: str | None, after: str | None) -> tuple[list[dict], list[dict]]:
    """Changed regions of both texts as lines and half-open character ranges;
    a pure insertion or deletion leaves an empty anchor on the other side."""
    sides = [(t or "").splitlines(keepends=True) for t in (before, after)]
    starts = []
    for lines in sides:
        offsets = [0]
        for line in lines:
            offsets.append(offsets[-1] + len(line))
        starts.append(offsets)
    out: tuple[list[dict], list[dict]] = ([], [])
    for tag, a, b, c, d in difflib.SequenceMatcher(None, *sides, autojunk=False).get_opcodes():
        if tag != "equal":
            for side, (low, high) in enumerate(((a, b), (c, d))):
                out[side].append({"line_start": low + 1, "line_end": max(high, low + 1), "char_start": starts[side][low], "char_end": starts[side][high]})
    return out


@arrow_udf(FILE_LINES)
def diff_lines(diff: pd.Series) -> pd.Series:
    return diff.map(line_sets)


@arrow_udf(FILE_NUMBERS)
def diff_numbers(diff: pd.Series) -> pd.Series:
    return diff.map(line_numbers)


_REGION = "array<struct<line_start:int,line_end:int,char_start:int,char_end:int>>"


@arrow_udf(f"before {_REGION}, after {_REGION}", once=True)
def patch_regions(before: pd.Series, after: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([regions(b, a) for b, a in zip(before, after, strict=True)], columns=["before", "after"])
