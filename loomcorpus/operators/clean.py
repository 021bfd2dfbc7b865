"""Docstring cleaning: loops until nothing changes, HTML to text, sentence by sentence filters.

What has no bound on its number of rounds can't be one column expression, so these steps
are plain functions run in Arrow batches; the rules use the patterns of functions.predicates.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from html.parser import HTMLParser
from itertools import permutations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import transforms as X
from ..functions.tokens import TOKEN

ORNAMENTS = ".*-_@#$!\\/+"
_SPANS = re.compile(r"\((?:i\.e|e\.g|\beg|\bie)[\s\S]+?\)", re.I)
_RULERS = re.compile(r"(?:-|=|#|\*){5,}")
_INLINE_TAG = re.compile(r"\{(@.*?)\}")
_LINKS = [re.compile(rf"\{a}(?:see|eg.|http|e\.g).*?\{b}") for a, b in ("()", "<>")]
_FRAMED = re.compile("|".join(rf"\{c}.*\{c}" for c in "*+-/=_"))
_RULER_LINE = re.compile(r"^[^\S\n]*[*+/=-][^\S\n]*$", re.M)
_HEAD, _TAIL = (re.compile(p % re.escape(ORNAMENTS)) for p in (r"\A(?:([%s])\1+)+", r"(?:([%s])\1+)+\Z"))
_NAMES = [re.compile(r"^[a-zA-Z0-9_()]+:"), re.compile(r"^[a-zA-Z0-9_()]+\s-")]
_SENTENCE = re.compile(r"[.!?](?<=..)(?=\s)")
_TOKEN = re.compile(TOKEN)
_QUESTION = re.compile(r"^(?:are|how|is|what'?s?|where|why)\b", re.I)
_UNFINISHED = re.compile(r"^(?:Description of the Method|NOT YET DOCUMENTED|Missing[\s\S]+Description|not in use|Insert the method's description here|No implementation provided|\(non-Javadoc\)|todo|to-do|deprecate|copyright|fixme)", re.I)
_GENERATED = re.compile(r"@[a-zA-Z]*generated\b|\Aauto[-\s]generated|\AThis method (?:initializes|was generated by)", re.I)
_FORMAT = re.compile("(?:HH|MM|SS|DD|YY|hh|mm|ss|dd|yy)[:-]|[RGBrgb][,-][RGBrgb]")
_FLAT = [(sign.join(order), "".join(order).lower()) for parts, signs in X.FORMATS for sign in signs for order in permutations(parts)]
_SIGNS = re.compile("[" + re.escape(P.SYMBOLS + P.BRACKETS) + "]")
_SHOUT = re.compile(r"\s[A-Z][A-Z0-9_]+")
_SNAKE, _CAMEL, _CALL, _URL = (re.compile(p) for p in (P.SNAKE, P.CAMEL, P.CALL, P.URL))


def tokenize(text: str | None) -> list[str]:
    return _TOKEN.findall(text) if text else []


def drop_delimiters(text: str) -> str:
    text = re.sub("\"\"\"|'''", "", text)
    text = re.sub(r"(?m)^(\s*)(?:/\*+!?|//+[!*]*|#+!?|--+|\*+(?!/))[ \t]?", r"\1", text)
    return re.sub(r"(?m)\s*\*+/[ \t]*$", "", text) if "*/" in text else text


def drop_spans(text: str) -> str:
    """Bracketed examples and rulers go; {@tag words} keeps the words."""
    text = _RULERS.sub("", _SPANS.sub("", text))
    return _INLINE_TAG.sub(lambda m: re.sub(r"@\w*", "", m[1]), text)


def drop_links(text: str) -> str:
    for link in _LINKS:
        text = link.sub("", text.strip())
    return text.strip()


def drop_markers(text: str) -> str:
    return reduce(lambda rest, mark: rest.replace(mark, "").strip() if mark in rest else rest, X.MARKERS, text)


def blank_rulers(text: str) -> str:
    return _RULER_LINE.sub("", text.strip()).strip() if re.search("[*+/=-]", text) else text.strip()


def drop_framed_lines(text: str) -> str:
    return "\n".join(x for x in map(str.strip, text.strip().split("\n")) if not _FRAMED.fullmatch(x)).strip()


def _bare(line: str) -> str:
    while line and (line[0] in ORNAMENTS or line[-1] in ORNAMENTS):
        start = line.removeprefix("* ")
        if start == (line := _TAIL.sub("", _HEAD.sub("", start))):
            break
    return line


def trim_ornaments(text: str) -> str:
    """Of each line a leading "* ", and runs of two or more of one ornament at both ends, until none is left."""
    return "\n".join(map(_bare, text.strip().split("\n"))).strip()


def drop_leading_name(text: str) -> str:
    for name in _NAMES:
        if found := name.match(text):
            text = text[found.end() :]
    return text.strip()


STEPS = (drop_spans, drop_links, drop_markers, blank_rulers, drop_framed_lines, trim_ornaments, drop_leading_name)


def remove_noise(text: str) -> str:
    """All steps in order, again and again until nothing changes; then the end is closed.

    Each step only takes away, so that a round that changes anything leaves a shorter text.
    """
    before = None
    while before != text:
        before = text
        for step in STEPS:
            text = step(text)
    if text and text[-1] in ":;,@":
        text = text[:-1] + "."
    return text.strip()


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data):
        self.parts.append(data)


def html_text(text: str) -> str:
    """Markup gone, entities decoded."""
    if "<" not in text and "&" not in text:
        return text
    parser = _Text()
    parser.feed(text)
    parser.close()
    return "".join(parser.parts)


def _flatten(text: str) -> str:
    return reduce(lambda rest, pair: rest.replace(*pair), _FLAT, text) if _FORMAT.search(text) else text


def _math(text: str) -> bool:
    return any(s in text for s in P.MATH_SIGNS)


# Each rule first asks, where that is quick, for something without which it can't hold.
def few_letters(text: str) -> bool:
    solid = "".join(text.split())
    if not solid:
        return True
    ratio = len(re.sub("[^a-zA-Z]+", "", solid)) / len(solid)
    return ratio < 0.65 and (len(solid) > 15 and ratio < 0.4 if _math(text) else len(solid) > 5)


def many_symbols(text: str) -> bool:
    if len(_SIGNS.findall(text)) <= 4:
        return False
    text = _flatten(text.strip())
    math, n = _math(text), Counter(_SIGNS.findall(text))
    if any(n[s] > 6 for s in P.BRACKETS) or any(n[s] > (10 if math and s in P.MATH_SYMBOLS else 4) for s in P.SYMBOLS):
        return True
    return sum(n[s] for s in P.SYMBOLS) > (20 if math else max(15, 0.3 * len(tokenize(text))))


def few_characters(text: str) -> bool:
    return sum(not c.isspace() for c in set(text)) <= 3 and len("".join(text.split())) > 5


def repeated_word(text: str) -> bool:
    words = re.findall("[A-Za-z0-9_]+", text)
    if "_" in text:
        words = [w for w in words if "_" not in w]
    if not words or len(words) - len(set(words)) < 2:
        return not words
    most = max(Counter(w for w in words if w not in P.COMMON).values(), default=0)
    return most >= 3 and most / len(words) > 0.3


def many_variables(text: str) -> bool:
    if "_" not in text and not re.search("[A-Za-z0-9][A-Z]", text):
        return False
    n = len(text.split())
    return n > 0 and (len(_SNAKE.findall(text)) + len(_CAMEL.findall(_SNAKE.sub("", text)))) / n > 0.3


def many_calls(text: str) -> bool:
    if not re.search("[.(][a-zA-Z0-9]", text):
        return False
    n = len(text.split())
    return n > 0 and len(_CALL.findall(text)) / n > 0.2


def many_capitals(text: str) -> bool:
    n = len(text.split())
    if n <= 10 or len(_SHOUT.findall(text)) / n <= 0.3:
        return False
    for part in P.DATE_PARTS:
        text = text.replace(part, part.lower())
    return len(_SHOUT.findall(_SNAKE.sub("x", text.strip()))) / n > 0.3


def long_word(text: str) -> bool:
    words = text.split()
    if not words or max(map(len, words)) < 31:
        return not words
    marked = re.sub("([A-Z])([A-Z][a-z])", r"\1 \2", re.sub("([a-z])([A-Z])", r"\1 \2", text))
    return re.search("[A-Za-z0-9]{31,}", marked) is not None


def has_url(text: str) -> bool:
    if "://" not in text and ("." not in text or not any(s in text.lower() for s in ("www.", "ftp."))):
        return False
    return _URL.search(text) is not None


RULES = (
    lambda t: t[-1] == "?" or _QUESTION.match(t) is not None,
    lambda t: _UNFINISHED.match(t) is not None,
    lambda t: (_GENERATED.search if "@" in t else _GENERATED.match)(t) is not None,
    few_letters,
    many_symbols,
    few_characters,
    repeated_word,
    many_variables,
    many_calls,
    many_capitals,
    long_word,
    has_url,
)
LOOSE_RULES = tuple(r for r in RULES if r not in (many_symbols, many_variables, many_calls))


def bad_sentence(text: str, loose: bool = False) -> bool:
    return not text or any(rule(text) for rule in (LOOSE_RULES if loose else RULES))


def clean_docstring(text: str | None, loose: bool = False) -> str | None:
    """Cleaned text, or None if it is rejected.

    Of each paragraph the sentences before the first bad one stay; separators become full
    stops. Null, empty, non-ASCII, and texts that end up too short or too long give None.
    """
    if not text:
        return None
    text = drop_delimiters(text)
    if not text.isascii() or not re.search("[a-zA-Z0-9]", text):
        return None
    done = []
    for paragraph in text.strip().split("\n\n"):
        parts, kept = _SENTENCE.split(remove_noise(paragraph)), []
        for part in map(html_text, parts):
            if bad_sentence(part, loose):
                break
            kept.append(part)
        done.append(".".join(kept if len(kept) == len(parts) else [*kept, ""]))
    out = "\n\n".join(done)
    return None if len(out.split()) < 3 or len(out.splitlines()) > 200 else out


def _column(function):
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else function(t))

    return run


def cleaned(text: Column, loose: bool = False) -> Column:
    return _column(lambda t: clean_docstring(t, loose))(text)


def spans_dropped(text: Column) -> Column:
    return _column(drop_spans)(text)


def ornaments_trimmed(text: Column) -> Column:
    return _column(trim_ornaments)(text)


def noise_removed(text: Column) -> Column:
    return _column(remove_noise)(text)


def html_as_text(html: Column) -> Column:
    return _column(html_text)(html)
