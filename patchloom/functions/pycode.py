"""Python source analysis in Arrow-batched workers: one pass for each text.

These need the interpreter's own parser, so their results hold for the Python
version of the workers; errors are compared by class, not by message.
"""


import ast
import io
import re
import textwrap
import tokenize

import pandas as pd
from patchloom.functions.udf import arrow_udf

# fixed values: what names a credential, and what is no literal secret
SECRET_NAME = re.compile(r"(?:password|passwd|secret|api[_-]?key|access[_-]?token|jwt[_-]?key|signing[_-]?key|credential)", re.I)
PLACEHOLDER = re.compile(r"^(?:none|null|changeme|change-me|example|dummy|test|mock)$", re.I)

FACTS = "valid boolean, has_function boolean, error string, normalized string, credentials array<struct<name:string,literal:string>>"
SPAN = "qname string, start int, end int, code string"
_LAYOUT = {tokenize.COMMENT, tokenize.NL, tokenize.NEWLINE, tokenize.INDENT, tokenize.DEDENT, tokenize.ENCODING, tokenize.ENDMARKER}


def parse(code: str | None) -> tuple[ast.Module | None, str]:
    try:
        return ast.parse(textwrap.dedent(code or "")), ""
    except (SyntaxError, ValueError, TypeError, RecursionError, MemoryError) as error:
        return None, type(error).__name__


def normalized(code: str | None) -> str:
    """Token stream without comments and layout; where that fails, the text
    without comments and with single spaces."""
    source = textwrap.dedent(code or "")
    try:
        return " ".join(f"{t.type}:{t.string}" for t in tokenize.generate_tokens(io.StringIO(source).readline) if t.type not in _LAYOUT)
    except (tokenize.TokenError, SyntaxError, ValueError):
        return " ".join(re.sub(r"#[^\n]*", "", source).split())


def dotted(node: ast.AST) -> str:
    """Name of an assignment's target: a.b, a[...], (a, b)."""
    match node:
        case ast.Name(id=name):
            return name
        case ast.Attribute(value=value, attr=attr):
            return f"{dotted(value)}.{attr}".lstrip(".")
        case ast.Subscript(value=value, slice=index):
            key = index.value if isinstance(index, ast.Constant) else ""
            return f"{dotted(value)}.{key}".strip(".")
        case ast.Tuple(elts=items) | ast.List(elts=items):
            return ",".join(map(dotted, items))
    return ""


def _literal(node: ast.AST, known: dict[str, str]) -> str:
    """The string an expression yields: itself, the default of an environment
    lookup, or a top-level name that holds one."""
    if isinstance(node, ast.Call) and dotted(node.func) == "os.environ.get" and len(node.args) > 1:
        node = node.args[1]
    if isinstance(node, ast.Name):
        return known.get(node.id, "").strip()
    return node.value.strip() if isinstance(node, ast.Constant) and isinstance(node.value, str) else ""


def credentials(tree: ast.Module | None) -> list[tuple[str, str]]:
    """(lower-case target, literal) of assignments that hard-code a secret."""
    found, known = set(), {}

    def sides(node: ast.AST) -> tuple[list[ast.AST], ast.AST | None]:
        if isinstance(node, ast.Assign):
            return node.targets, node.value
        return ([node.target], node.value) if isinstance(node, ast.AnnAssign) else ([], None)

    for targets, value in map(sides, tree.body if tree else ()):
        if isinstance(value, ast.Constant) and isinstance(value.value, str):
            known.update({t.id: value.value for t in targets if isinstance(t, ast.Name)})
    for targets, value in map(sides, ast.walk(tree) if tree else ()):
        literal = _literal(value, known) if value is not None else ""
        if len(literal) >= 3 and not PLACEHOLDER.match(literal):
            found |= {(name.lower(), literal) for name in map(dotted, targets) if SECRET_NAME.search(name)}
    return sorted(found)


def has_binding(code: str | None, name: str) -> bool:
    tree, _ = parse(code)
    return bool(tree) and any(isinstance(t, ast.Name) and t.id == name for s in tree.body if isinstance(s, (ast.Assign, ast.AnnAssign)) for t in (s.targets if isinstance(s, ast.Assign) else [s.target]))


def function_spans(source: str | None) -> list[tuple[str, int, int, str]]:
    """(dotted name, first line with decorators, last line, text) of every
    function, nested ones too."""
    try:
        tree = ast.parse(source or "")
    except (SyntaxError, ValueError):
        return []
    lines, out = (source or "").splitlines(keepends=True), []
    todo: list[tuple[ast.AST, str]] = [(tree, "")]
    while todo:
        node, path = todo.pop()
        for child in ast.iter_child_nodes(node):
            name = f"{path}.{child.name}".lstrip(".") if isinstance(child, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)) else path
            if isinstance(child, (ast.FunctionDef, ast.AsyncFunctionDef)):
                start = min([child.lineno, *(d.lineno for d in child.decorator_list)])
                out.append((name, start, child.end_lineno, "".join(lines[start - 1 : child.end_lineno])))
            todo.append((child, name))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def _names(node: ast.AST, context: type) -> set[str]:
    return {x.id for x in ast.walk(node) if isinstance(x, ast.Name) and isinstance(x.ctx, context)}


def module_slice(source: str | None, binding: str) -> tuple[str, int, int, str, list[list[int]]] | None:
    """The assignment of a module binding, the definitions it needs in turn, and
    later statements that store it: one text in line order, with its spans."""
    try:
        tree = ast.parse(source or "")
    except (SyntaxError, ValueError):
        return None
    definitions: dict[str, ast.stmt] = {}
    for s in tree.body:
        if isinstance(s, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
            definitions[s.name] = s
        elif isinstance(s, (ast.Assign, ast.AnnAssign)):
            definitions.update(dict.fromkeys((t.id for t in (s.targets if isinstance(s, ast.Assign) else [s.target]) if isinstance(t, ast.Name)), s))
    if not isinstance(definitions.get(binding), (ast.Assign, ast.AnnAssign)):
        return None
    chosen, todo = {}, [definitions[binding]]
    while todo:
        s = todo.pop()
        if s.lineno not in chosen:
            chosen[s.lineno] = s
            todo += [definitions[n] for n in _names(s, ast.Load) if n in definitions]
    chosen |= {s.lineno: s for s in tree.body if not isinstance(s, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)) and binding in _names(s, ast.Store)}
    lines = (source or "").splitlines()
    spans = [[min([s.lineno, *(d.lineno for d in getattr(s, "decorator_list", []))]), s.end_lineno] for _, s in sorted(chosen.items())]
    return binding, spans[0][0], spans[-1][1], "\n\n".join("\n".join(lines[a - 1 : b]) for a, b in spans), spans


@arrow_udf(FACTS)
def code_facts(code: pd.Series) -> pd.DataFrame:
    """Syntax, functions, normalised tokens and credentials in one pass."""
    rows = []
    for c in code:
        tree, error = parse(c)
        has = bool(tree) and any(isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)) for n in ast.walk(tree))
        rows.append((tree is not None, has, error, normalized(c), [dict(name=n, literal=x) for n, x in credentials(tree)]))
    return pd.DataFrame(rows, columns=["valid", "has_function", "error", "normalized", "credentials"])


@arrow_udf("boolean")
def parses(source: pd.Series) -> pd.Series:
    """Whether a whole file parses; null stays null."""

    def whole(s: str) -> bool:
        try:
            ast.parse(s)
        except (SyntaxError, ValueError, RecursionError, MemoryError):
            return False
        return True

    return source.map(whole, na_action="ignore").astype("boolean")


@arrow_udf("boolean")
def binds(code: pd.Series, name: pd.Series) -> pd.Series:
    """Whether a text assigns the name at its top level."""
    return pd.Series([has_binding(c, n) for c, n in zip(code, name, strict=True)], dtype=bool)


@arrow_udf(f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in SPAN.split(', '))}>>")
def spans_of(source: pd.Series) -> pd.Series:
    return source.map(lambda s: [dict(zip(("qname", "start", "end", "code"), x, strict=True)) for x in function_spans(s)])


@arrow_udf("qname string, start int, end int, code string, spans array<array<int>>")
def slice_of(source: pd.Series, binding: pd.Series) -> pd.DataFrame:
    rows = [module_slice(s, b) or (None, None, None, None, None) for s, b in zip(source, binding, strict=True)]
    out = pd.DataFrame(rows, columns=["qname", "start", "end", "code", "spans"])
    return out.astype({"start": "Int32", "end": "Int32"})
