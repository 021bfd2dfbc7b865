"""Code to records: functions, classes and inline comments of ten languages.

Python goes through `ast` and `tokenize`. The others are scanned: strings and comments are
found first, then headers in what is left, and a body runs to its matching brace (or `end`).
A file that doesn't parse gives no rows. Everything works on one file at a time, so
extraction is a map over Arrow batches without a shuffle.
"""

from __future__ import annotations

import ast
import io
import re
import tokenize as pytokens
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import tokenize

LANGUAGES = ("python", "java", "javascript", "c", "cpp", "c_sharp", "go", "rust", "php", "ruby")
ALIASES = {"c#": "c_sharp", "c++": "cpp", "js": "javascript"}
NO_CLASSES = ("go", "c")
MIN_CODE_LINES = 3
RECORD = "repo string, path string, language string, license string, identifier string, parameters map<string,string>, code string, code_tokens array<string>, original_docstring string, docstring_tokens array<string>, comment array<string>"
CONTEXT = "struct<code:string,start_point:array<int>,end_point:array<int>>"
INLINE = f"repo string, path string, language string, license string, identifier string, code string, code_tokens array<string>, prev_context {CONTEXT}, next_context {CONTEXT}, start_point array<int>, end_point array<int>, original_comment string"
_BLACK = re.compile(r"^__.*__$|^(?:set|get)|test_|Test_|_test|toString|[cC]onstructor")


@dataclass
class Node:
    """A function or class: its place in the text, and what is said in and above it. comments: (start, end)."""

    name: str
    start: int
    end: int
    parameters: dict[str, str | None] = field(default_factory=dict)
    docstring: str | None = None
    doc_span: tuple[int, int] | None = None
    comments: list[tuple[int, int]] = field(default_factory=list)


def language_of(name: str) -> str:
    name = ALIASES.get(str(name).lower(), str(name).lower())
    if name not in LANGUAGES:
        raise ValueError(f"{name} is not one of {LANGUAGES}")
    return name


def _offsets(text: str) -> list[int]:
    out = [0]
    for line in text.splitlines(keepends=True):
        out.append(out[-1] + len(line))
    return out


def python_nodes(text: str, classes: bool) -> list[Node]:
    try:
        tree = ast.parse(text)
        found = [t for t in pytokens.generate_tokens(io.StringIO(text).readline) if t.type == pytokens.COMMENT]
    except (SyntaxError, ValueError, pytokens.TokenError, RecursionError):
        return []
    at = _offsets(text)
    lines = text.splitlines(keepends=True)
    place = lambda row, col: at[row - 1] + len(lines[row - 1].encode()[:col].decode("utf-8", "ignore")) if row <= len(lines) else at[-1]
    comments = [(at[t.start[0] - 1] + t.start[1], at[t.end[0] - 1] + t.end[1]) for t in found]
    out = []
    for n in ast.walk(tree):
        if not isinstance(n, ast.ClassDef if classes else (ast.FunctionDef, ast.AsyncFunctionDef)):
            continue
        start, end = place(n.lineno, n.col_offset), place(n.end_lineno, n.end_col_offset)
        node = Node(n.name, start, end, docstring=ast.get_docstring(n, clean=False), comments=[c for c in comments if start <= c[0] < end])
        if node.docstring is not None:
            e = n.body[0]
            node.doc_span = (place(e.lineno, e.col_offset), place(e.end_lineno, e.end_col_offset))
        if classes:
            node.parameters = {ast.unparse(b): None for b in n.bases}
        else:
            a = n.args
            every = [*a.posonlyargs, *a.args, *([a.vararg] if a.vararg else []), *a.kwonlyargs, *([a.kwarg] if a.kwarg else [])]
            node.parameters = {x.arg: ast.unparse(x.annotation) if x.annotation else None for x in every}
        out.append(node)
    return sorted(out, key=lambda n: n.start)


_LINE = {"php": r"//[^\n]*|#(?!\[)[^\n]*", "ruby": r"#[^\n]*"}
_BLOCK = {"ruby": r"(?m:^=begin\b[\s\S]*?^=end\b)"}
_STRINGS = {"rust": r'"(?:\\.|[^"\\])*"|\'(?:\\.|[^\'\\\n])\'', "go": r'"(?:\\.|[^"\\\n])*"|`[^`]*`|\'(?:\\.|[^\'\\\n])\'', "javascript": r'"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'|`(?:\\.|[^`\\])*`'}
_SCAN = {x: re.compile(f"(?P<c>{_BLOCK.get(x, r'/\*[\s\S]*?\*/')}|{_LINE.get(x, r'//[^\n]*')})|{_STRINGS.get(x, r'''"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*' ''').strip()}") for x in LANGUAGES}
_KEYWORDS = set("if for while switch catch return else do try new throw sizeof using lock fixed foreach when match loop synchronized super this elseif".split())
_CALLABLE = {
    "go": r"\bfunc\s*(?:\([^)]*\)\s*)?(?P<n>\w+)\s*(?:\[[^\]]*\])?\s*\(",
    "rust": r"\bfn\s+(?P<n>\w+)\s*(?:<[^({]*>)?\s*\(",
    "php": r"\bfunction\s+&?\s*(?P<n>\w+)\s*\(",
    "javascript": r"\bfunction\s*\*?\s+(?P<n>[\w$]+)\s*\(|\b(?P<m>[\w$]+)\s*=\s*(?:async\s+)?function\b[^(]*\(|(?m:^[ \t]*(?:static\s+|async\s+|\*\s*)*(?P<k>[\w$]+)\s*\()",
}
_TYPED = r"(?P<n>~?\b\w+)\s*\("
_TYPES = {"javascript": r"\bclass\s+(?P<n>[\w$]+)", "rust": r"\b(?:struct|enum|trait|union)\s+(?P<n>\w+)", "php": r"\b(?:class|interface|trait)\s+(?P<n>\w+)"}
_HEADS = {x: re.compile(_CALLABLE.get(x, _TYPED)) for x in LANGUAGES}
_CLASS_HEADS = {x: re.compile(_TYPES.get(x, r"\b(?:class|interface|struct|enum|record)\s+(?P<n>\w+)")) for x in LANGUAGES}
_BEFORE_DOC = re.compile(r"(?:\s|@\w+(?:\([^)]*\))?|\[[^\]\n]*\]|#\[[^\]]*\]|\b(?:public|private|protected|internal|static|final|abstract|virtual|override|async|export|default|pub(?:\([^)]*\))?|unsafe|extern|const|inline|sealed|partial|function|class|interface|struct|enum|trait|record|fn|func)\b|[\w<>\[\],.*&:?~$]+(?=[\s\w*&]))*\Z")


def _closing(bare: str, at: int, left: str, right: str) -> int:
    depth = 0
    for m in re.compile(f"[{re.escape(left + right)}]").finditer(bare, at):
        depth += 1 if m[0] == left else -1
        if depth == 0:
            return m.end()
    return -1


def scan(text: str, language: str) -> tuple[str, list[tuple[int, int]]]:
    """(text with strings and comments blanked, comments)."""
    bare, comments = list(text), []
    for m in _SCAN[language].finditer(text):
        if m["c"] is not None:
            comments.append(m.span())
        for i in range(*m.span()):
            if bare[i] != "\n":
                bare[i] = " "
    return "".join(bare), comments


def _parameters(inside: str, language: str) -> dict[str, str | None]:
    out: dict[str, str | None] = {}
    depth, part, parts = 0, "", []
    for c in inside + ",":
        depth += (c in "(<[{") - (c in ")>]}")
        if c == "," and depth <= 0:
            parts.append(part.strip())
            part = ""
        else:
            part += c
    for p in filter(None, parts):
        p = re.sub(r"\s*=.*", "", p, flags=re.S)
        if language in ("javascript", "ruby", "php"):
            name = re.findall(r"[\w$]+", p)
            if name:
                out[name[-1].lstrip("$")] = p[: p.rfind(name[-1])].strip(" &.$*:") or None
        elif language == "rust":
            name, _, kind = p.partition(":")
            out[name.strip(" &").removeprefix("mut ")] = kind.strip() or None
        elif language == "go":
            name, _, kind = p.partition(" ")
            out[name] = kind.strip() or None
        elif m := re.search(r"(\w+)\s*(?:\[\s*\])?$", p):
            out[m[1]] = p[: m.start()].strip() or None
    return out


def _doc_above(text: str, start: int, comments: list[tuple[int, int]]) -> tuple[int, int] | None:
    """The comments that end right above: one block, or line comments of following lines."""
    above = [c for c in comments if c[1] <= start]
    if not above or text[above[-1][1] : start].count("\n\n"):
        return None
    if not _BEFORE_DOC.match(text[above[-1][1] : start]):
        return None
    first = len(above) - 1
    while first and not text[above[first][0] :].startswith("/*") and re.fullmatch(r"[ \t]*\n[ \t]*", text[above[first - 1][1] : above[first][0]]):
        first -= 1
    return above[first][0], above[-1][1]


def brace_nodes(text: str, language: str, classes: bool) -> list[Node]:
    bare, comments = scan(text, language)
    out = []
    for m in (_CLASS_HEADS if classes else _HEADS)[language].finditer(bare):
        name = next((x for x in m.groupdict().values() if x), "")
        if not name or name in _KEYWORDS or name == "function":
            continue
        at, parameters = m.end(), {}
        if not classes:
            close = _closing(bare, m.end() - 1, "(", ")")
            if close < 0:
                continue
            parameters, at = _parameters(bare[m.end() : close - 1], language), close
        head = re.compile(r"[^{};=]*(?:->[^{;]*)?\{").match(bare, at)
        if not head:
            continue
        end = _closing(bare, head.end() - 1, "{", "}")
        if end < 0:
            continue
        line = bare.rfind("\n", 0, m.start()) + 1
        start = line + len(bare[line:]) - len(bare[line:].lstrip()) if bare[line : m.start()].strip() not in ("", "}") or not bare[line : m.start()].strip() else m.start()
        doc = _doc_above(text, start, comments)
        out.append(Node(name, start, end, parameters, text[doc[0] : doc[1]] if doc else None, None, [c for c in comments if start <= c[0] < end]))
    return out


def ruby_nodes(text: str, classes: bool) -> list[Node]:
    bare, comments = scan(text, "ruby")
    opens = re.compile(r"(?m:^\s*(?:def|class|module|if|unless|while|until|case|begin|for)\b)|\bdo\b(?=\s*(?:\|[^|]*\|)?\s*$)|=\s*(?:if|case|begin|unless)\b|\bend\b", re.M)
    out = []
    for m in re.finditer(r"(?m)^[ \t]*(?:class|module)\s+(?P<n>[\w:]+)" if classes else r"(?m)^[ \t]*def\s+(?:self\.)?(?P<n>\w+[?!=]?)\s*(?:\((?P<p>[^)]*)\))?", bare):
        depth, end, looped = 0, -1, False
        for o in opens.finditer(bare, m.start()):
            word = o[0].strip(" =\t\n")
            if word == "do" and looped and "\n" not in bare[line_of:o.start()]:
                continue  # the do of a while, until or for
            depth += -1 if word == "end" else 1
            looped, line_of = word in ("while", "until", "for"), o.end()
            if depth == 0:
                end = o.end()
                break
        if end < 0:
            continue
        start = m.start() + len(m[0]) - len(m[0].lstrip())
        doc = _doc_above(text, start, comments)
        parameters = {} if classes or not m["p"] else _parameters(m["p"], "ruby")
        out.append(Node(m["n"], start, end, parameters, text[doc[0] : doc[1]] if doc else None, None, [c for c in comments if start <= c[0] < end]))
    return out


def nodes(text: str, language: str, classes: bool = False) -> list[Node]:
    if language == "python":
        return python_nodes(text, classes)
    if language == "ruby":
        return ruby_nodes(text, classes)
    return [] if classes and language in NO_CLASSES else brace_nodes(text, language, classes)


def passes(text: str, node: Node) -> bool:
    """Not a test, getter, setter, dunder or constructor; longer than 3 lines; 3 lines of code without comments."""
    code = text[node.start : node.end]
    if not node.name or _BLACK.search(node.name) or code.count("\n") <= 3:
        return False
    said = [text[a:b] for a, b in node.comments]
    return sum(1 for x in code.splitlines() if x and not any(c in x for c in said)) >= MIN_CODE_LINES


def code_tokens(text: str, node: Node) -> list[str]:
    """Tokens of the code without docstring and comments; a quoted string is one."""
    cuts = sorted([*node.comments, *([node.doc_span] if node.doc_span else [])])
    code, at = "", node.start
    for a, b in cuts:
        code, at = code + text[at:a], max(at, b)
    return re.findall(r'"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'|[A-Za-z0-9_]+|[^\sA-Za-z0-9_]', code + text[at : node.end])


def records(row: dict, classes: bool = False) -> list[dict]:
    language, text = language_of(row["language"]), row["code"] or ""
    out = []
    for n in nodes(text, language, classes):
        if passes(text, n):
            said = n.docstring or None
            out.append({**{k: row.get(k) for k in ("repo", "path", "license")}, "language": language, "identifier": n.name, "parameters": n.parameters, "code": text[n.start : n.end], "code_tokens": code_tokens(text, n), "original_docstring": said, "docstring_tokens": tokenize(said) if said else None, "comment": [text[a:b] for a, b in n.comments]})
    return out


def inline_comments(row: dict) -> list[dict]:
    """Runs of adjacent comments inside functions, with the code before and after up to the next comment."""
    language, text = language_of(row["language"]), row["code"] or ""
    at = _offsets(text)
    out = []

    def point(offset: int, first: int) -> list[int]:
        import bisect

        k = bisect.bisect_right(at, offset) - 1
        return [k - first, offset - at[k]]

    def context(a: int, b: int, first: int) -> dict | None:
        part = text[a:b]
        a += len(part) - len(part.lstrip())
        part = part.strip()
        return {"code": part, "start_point": point(a, first), "end_point": point(a + len(part), first)} if part else None

    for n in nodes(text, language):
        if not n.comments:
            continue
        first = point(n.start, 0)[0]
        runs: list[list[tuple[int, int]]] = []
        for c in n.comments:
            if runs and not text[runs[-1][-1][1] : c[0]].strip():
                runs[-1].append(c)
            else:
                runs.append([c])
        tokens = code_tokens(text, n)
        for k, run in enumerate(runs):
            before = runs[k - 1][-1][1] if k else n.start
            after = runs[k + 1][0][0] if k + 1 < len(runs) else n.end
            out.append({**{x: row.get(x) for x in ("repo", "path", "license")}, "language": language, "identifier": n.name, "code": text[n.start : n.end], "code_tokens": tokens, "prev_context": context(before, run[0][0], first), "next_context": context(run[-1][1], after, first), "start_point": point(run[0][0], first), "end_point": point(run[-1][1], first), "original_comment": "\n".join(text[a:b] for a, b in run)})
    return out


def extract(df: DataFrame, level: str = "function") -> DataFrame:
    """Records of (repo, path, language, license, code) rows. level: function, class or inline.

    Files of other languages, null code and code that doesn't parse give no rows.
    """
    if level not in ("function", "class", "inline"):
        raise ValueError(level)
    schema = INLINE if level == "inline" else RECORD
    names = [x.split()[0] for x in re.sub(r"<[^<>]*>", "", re.sub(r"<[^<>]*<[^<>]*>[^<>]*(?:<[^<>]*>[^<>]*)*>", "", schema)).split(",")]

    def run(batches):
        for batch in batches:
            rows = [r for row in batch.to_dict("records") for r in (inline_comments(row) if level == "inline" else records(row, level == "class"))]
            yield pd.DataFrame(rows, columns=[n.strip() for n in names])

    known = F.lower("language").isin(*LANGUAGES, *ALIASES)
    source = df.where(known & F.col("code").isNotNull()).select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("repo", "path", "language", "license", "code")])
    return source.mapInPandas(run, schema)
