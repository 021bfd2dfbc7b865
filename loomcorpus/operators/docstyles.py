"""Docstring styles: the description, and what is said of parameters, returns, errors and the rest.

Each language tries its styles in order; the one that finds most entries wins, the first on
a tie.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import clean_docstring, drop_delimiters, html_text, tokenize

_PARAM = "struct<identifier:string,docstring:string,docstring_tokens:array<string>,type:string,default:string,is_optional:boolean>"
_TYPED = "struct<docstring:string,docstring_tokens:array<string>,type:string>"
_OTHER = "struct<identifier:string,docstring:string,docstring_tokens:array<string>>"
SCHEMA = f"struct<docstring:string,docstring_tokens:array<string>,short_docstring:string,short_docstring_tokens:array<string>,docstring_params:struct<params:array<{_PARAM}>,outlier_params:array<{_PARAM}>,returns:array<{_TYPED}>,raises:array<{_TYPED}>,others:array<{_OTHER}>>>"


@dataclass
class Entry:
    kind: str  # param, return, raise, other
    name: str | None
    text: str
    type: str | None = None
    default: str | None = None
    optional: bool | None = None


@dataclass
class Parsed:
    description: str
    entries: list[Entry] = field(default_factory=list)


_KINDS = {**dict.fromkeys("param parameter arg argument key keyword attribute attributes args arguments params parameters keywords".split(), "param"), **dict.fromkeys("return returns yield yields result".split(), "return"), **dict.fromkeys("raise raises throw throws except exception exceptions errors".split(), "raise")}


def _kind(tag: str) -> str:
    return _KINDS.get(tag.lower(), "other")


def _default(text: str) -> str | None:
    m = re.search(r"(?i)defaults?\s*(?:to|is|=|:)\s*([^\s.,;]+(?:\.\d+)?)", text)
    return m[1] if m else None


def _param(name: str, kind: str | None, text: str) -> Entry:
    optional = None if kind is None else bool(re.search(r"\boptional\b|\?$", kind))
    kind = re.sub(r",?\s*optional\b|\?$", "", kind).strip() if kind else kind
    return Entry("param", name, text, kind or None, _default(text), optional)


def _tagged(text: str, sign: str, named: str) -> Parsed:
    """`:tag name: text` or `@tag name: text` fields."""
    parts = re.split(rf"(?m)^\s*{sign}(?=\w)", text)
    out, types = Parsed(parts[0].strip()), {}
    for part in parts[1:]:
        m = re.match(named, part, re.S)
        if not m:
            continue
        tag, name, said = m["tag"].lower(), (m["name"] or "").strip(), re.sub(r"\s*\n\s*", "\n", m["text"].strip())
        if tag in ("type", "rtype"):
            types[name if tag == "type" else "return"] = said
            continue
        kind = _kind(tag)
        if kind == "param":
            *before, name = name.split() or [""]
            out.entries.append(_param(name, " ".join(before) or None, said))
        elif kind == "raise":
            out.entries.append(Entry(kind, None, said, name or None))
        else:
            out.entries.append(Entry(kind, tag, said))
    for e in out.entries:
        e.type = e.type or types.get(e.name if e.kind == "param" else e.kind)
    return out


def rest(text: str) -> Parsed:
    return _tagged(text, ":", r"(?P<tag>\w+)(?P<name>[^:\n]*):(?P<text>.*)")


def epydoc(text: str) -> Parsed:
    return _tagged(text, "@", r"(?P<tag>\w+)(?P<name>[^:\n]*):(?P<text>.*)")


def google(text: str) -> Parsed:
    heads = "Args|Arguments|Parameters|Params|Attributes|Keyword Args|Returns|Return|Yields|Raises|Except|Exceptions|Example|Examples|Note|Notes|See Also|Todo|Warnings?|References"
    parts = re.split(rf"(?m)^([ \t]*)({heads}):[ \t]*$", text)
    out = Parsed(parts[0].strip())
    for head, body in zip(parts[2::3], parts[3::3]):
        kind = _kind(head.split()[0])
        lines = [x for x in body.split("\n") if x.strip()]
        if not lines:
            continue
        margin = min(len(x) - len(x.lstrip()) for x in lines)
        items: list[str] = []
        for x in lines:
            if len(x) - len(x.lstrip()) == margin or not items:
                items.append(x.strip())
            else:
                items[-1] += "\n" + x.strip()
        for item in items if kind in ("param", "raise") else ["\n".join(items)]:
            m = re.match(r"(?P<name>[*\w.]+)\s*(?:\((?P<type>[^)]*)\))?\s*:\s*(?P<text>.*)", item, re.S)
            if kind == "param" and m:
                out.entries.append(_param(m["name"].lstrip("*"), m["type"], m["text"]))
            elif kind == "raise":
                out.entries.append(Entry(kind, None, m["text"] if m else item, m["name"] if m else None))
            elif kind == "return":
                r = re.match(r"(?P<type>[\w.\[\], ]+):\s+(?P<text>.*)", item, re.S)
                out.entries.append(Entry(kind, None, r["text"] if r else item, r["type"] if r else None))
            elif kind == "other":
                out.entries.append(Entry(kind, head.lower(), item))
    return out


def numpydoc(text: str) -> Parsed:
    parts = re.split(r"(?m)^[ \t]*([A-Z][A-Za-z ]+)\n[ \t]*-{3,}[ \t]*$", text)
    out = Parsed(parts[0].strip())
    for head, body in zip(parts[1::2], parts[2::2]):
        kind = "param" if head.lower() == "other parameters" else _kind(head.split()[0])
        lines = [x for x in body.split("\n") if x.strip()]
        if not lines:
            continue
        margin = min(len(x) - len(x.lstrip()) for x in lines)
        if kind == "other":
            out.entries.append(Entry(kind, head.lower(), "\n".join(x.strip() for x in lines)))
            continue
        items: list[list[str]] = []
        for x in lines:
            if len(x) - len(x.lstrip()) == margin:
                items.append([x.strip()])
            else:
                items[-1].append(x.strip())
        for head_line, *said in items:
            name, _, kind_of = map(str.strip, head_line.partition(":"))
            if kind == "param":
                for one in name.split(","):
                    out.entries.append(_param(one.strip().lstrip("*"), kind_of or None, "\n".join(said)))
            else:
                out.entries.append(Entry(kind, None, "\n".join(said), kind_of or name))
    return out


def block_tags(text: str) -> Parsed:
    """@tag {type} name text, as in the comments of Java, JavaScript and PHP."""
    parts = re.split(r"(?m)^[ \t]*[@\\](?=[a-z])", text)
    out = Parsed(parts[0].strip())
    for part in parts[1:]:
        m = re.match(r"(?P<tag>[\w-]+)\s*(?P<text>.*)", part, re.S)
        tag, said, kind_of = m["tag"], m["text"].strip(), None
        if t := re.match(r"\{(?P<type>[^}]*)\}\s*", said):
            kind_of, said = t["type"], said[t.end() :]
        kind = _kind(tag)
        if kind == "param":
            p = re.match(r"(?:(?P<type>[\w\\|\[\]]+)\s+(?=\$))?(?P<name>\[[^\]]*\]|<\w+>|[$\w.]+)\s*-?\s*(?P<text>.*)", said, re.S)
            if not p:
                continue
            name, _, value = p["name"].strip("[]").partition("=")
            e = _param(name.lstrip("$"), kind_of or p["type"], p["text"])
            if p["name"].startswith("["):
                e.optional, e.default = True, value or None
            out.entries.append(e)
        elif kind == "raise":
            first, _, rest_ = said.partition(" ")
            out.entries.append(Entry(kind, None, rest_ if not kind_of else said, kind_of or first or None))
        else:
            out.entries.append(Entry(kind, tag, said, kind_of))
    return out


def xml(text: str) -> Parsed:
    summary = " ".join(re.findall(r"<(?:summary|remarks)>\s*([\s\S]*?)\s*</(?:summary|remarks)>", text)) or re.split(r"<(?:param|returns|exception)\b", text)[0]
    out = Parsed(html_text(summary).strip())
    for tag, attributes, said in re.findall(r"<(param|typeparam|returns|exception|value|example)\b([^>]*)>([\s\S]*?)</\1>", text):
        name = re.search(r"(?:name|cref)\s*=\s*\"([^\"]*)\"", attributes)
        said, name = html_text(said).strip(), name[1] if name else None
        kind = "param" if tag in ("param", "typeparam") else _kind(tag)
        out.entries.append(_param(name, None, said) if kind == "param" else Entry(kind, None if kind == "raise" else tag, said, name if kind == "raise" else None))
    return out


def rdoc(text: str) -> Parsed:
    """`name:: text` items and `= Returns` heads, as in the comments of Ruby; or its @tags."""
    if re.search(r"(?m)^\s*@\w+", text):
        out = block_tags(re.sub(r"(?m)^(\s*@(?:param|return|raise)\b)\s*(\w+)?\s*\[([^\]]*)\]", r"\1 {\3} \2", text))
        return out
    parts = re.split(r"(?m)^[ \t]*(?:\*\s*)?<?(?:tt>|\+)?([\w]+)(?:</tt>|\+)?::[ \t]*", text)
    out = Parsed(parts[0].strip())
    for name, said in zip(parts[1::2], parts[2::2]):
        kind = _kind(name)
        out.entries.append(Entry(kind, name, said.strip()) if kind != "other" else _param(name, None, said.strip()))
    return out


def rustdoc(text: str) -> Parsed:
    parts = re.split(r"(?m)^[ \t]*#+[ \t]+(\w+).*$", text)
    out = Parsed(parts[0].strip())
    for head, body in zip(parts[1::2], parts[2::2]):
        kind = "raise" if head.lower() in ("errors", "panics") else _kind(head)
        items = re.findall(r"(?m)^[ \t]*[*-][ \t]+`?(\w+)`?[ \t]*[-:–]?[ \t]*(.*)$", body) if kind == "param" else []
        for name, said in items:
            out.entries.append(_param(name, None, said))
        if not items and body.strip():
            out.entries.append(Entry("other" if kind == "param" else kind, head.lower(), body.strip()))
    return out


STYLES = {"python": (rest, google, numpydoc, epydoc), "java": (block_tags,), "c": (block_tags,), "cpp": (block_tags,), "javascript": (block_tags,), "ruby": (rdoc,), "php": (block_tags,), "c_sharp": (xml, block_tags), "rust": (rustdoc, block_tags)}


def parse(text: str, language: str) -> Parsed | None:
    tried = [style(text) for style in STYLES.get(language, ())]
    return max(tried, key=lambda p: len(p.entries), default=None)


def first_sentence(text: str) -> str:
    parts = re.split(r"(?<=[.!?])\s+", drop_delimiters(text).split("\n\n")[0])
    return next((s.strip() for s in parts if s.strip()), "")


def extract_docstring(docstring: str | None, parameters: dict | list | None, language: str) -> dict | None:
    """What SCHEMA says, or None where no style applies or the description is rejected."""
    if not docstring:
        return None
    parsed = parse(drop_delimiters(docstring), language)
    if parsed is None:
        return None
    whole = clean_docstring(parsed.description)
    if not whole:
        return None
    declared = dict(parameters) if isinstance(parameters, dict) else dict.fromkeys(parameters or [])
    known = {k: {"identifier": k, "docstring": None, "docstring_tokens": [], "type": v, "default": None, "is_optional": None} for k, v in declared.items()}
    extra: dict[str, dict] = {}
    out: dict[str, list] = {"returns": [], "raises": [], "others": []}
    for e in parsed.entries:
        said = clean_docstring(e.text, True)
        both = {"docstring": said, "docstring_tokens": tokenize(said)}
        if e.kind == "param":
            new = {"identifier": e.name, **both, "default": e.default, "is_optional": e.optional}
            if e.name in known:
                known[e.name] |= new | ({} if isinstance(parameters, dict) else {"type": e.type})
            else:
                extra[e.name] = {"type": e.type, **new}
        elif e.kind == "other":
            out["others"].append({"identifier": e.name, **both})
        else:
            out[e.kind + "s"].append({**both, "type": e.type})
    short = first_sentence(parsed.description)
    return {"docstring": whole, "docstring_tokens": tokenize(whole), "short_docstring": short, "short_docstring_tokens": tokenize(short), "docstring_params": {"params": list(known.values()), "outlier_params": list(extra.values()), **out}}


def parsed_docstring(docstring: Column, parameters: Column, language: Column) -> Column:
    """extract_docstring over Arrow batches; null where it gives None."""

    @F.pandas_udf(SCHEMA)
    def run(docs: pd.Series, params: pd.Series, languages: pd.Series) -> pd.DataFrame:
        rows = [extract_docstring(d, None if p is None else dict(p), g) for d, p, g in zip(docs, params, languages)]
        keys = ["docstring", "docstring_tokens", "short_docstring", "short_docstring_tokens", "docstring_params"]
        return pd.DataFrame([[None] * 5 if r is None else [r[k] for k in keys] for r in rows], columns=keys)

    return run(docstring, parameters, language)
