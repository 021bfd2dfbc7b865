"""Cleaning steps for documentation text that built-in expressions can say: Column -> Column.

Steps that loop until nothing changes are in operators.clean.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tokens as T

#: Literal beginnings of what a docstring says after its description, in the order they are cut at.
AFTERTHOUGHTS = "E.g|e.g|eg.|Eg.|Example usage:|Created by|Example:|Note:|. Note|note::|note:|. note".split("|")
MARKERS = "/** /* <code> </code> *-*".split()
SEPARATOR = "\u0001"
FORMATS = [(order, signs) for case in (str.upper, str.lower) for order, signs in [(["hh", "mm", "ss"], ":-"), (["mm", "dd", "yy"], ":-"), (["mm", "dd", "yyyy"], ":-")] for order in [[case(x) for x in order]]]
FORMATS += [(list("RGB"), ",-"), (list("rgb"), ",-")]


def _lines(text: Column) -> Column:
    return F.split(T.strip(text), "\n", -1)


def _joined(lines: Column) -> Column:
    return T.strip(F.array_join(lines, "\n"))


def drop_bracketed_links(text: Column) -> Column:
    """(http...), (see ...), (e.g ...) and the same in <>."""
    for left, right in ("()", "<>"):
        text = F.regexp_replace(T.strip(text), rf"\{left}(?:see|eg.|http|e\.g).*?\{right}", "")
    return T.strip(text)


def drop_markers(text: Column) -> Column:
    """Comment openers and code tags, wherever they stand."""
    for mark in MARKERS:
        text = F.when(F.contains(text, F.lit(mark)), T.strip(F.replace(text, F.lit(mark), F.lit("")))).otherwise(text)
    return text


def blank_rulers(text: Column) -> Column:
    """Lines of one ornament character become empty."""
    return _joined(F.transform(_lines(text), lambda x: F.when(T.strip(x).isin(list("*+-/=")), F.lit("")).otherwise(x)))


def drop_framed_lines(text: Column) -> Column:
    """Lines that begin and end with the same ornament character go; the rest lose blanks at their ends."""
    framed = "|".join(rf"\{c}.*\{c}" for c in "*+-/=_")
    return _joined(F.filter(F.transform(_lines(text), T.strip), lambda x: ~x.rlike(rf"\A(?:{framed})\z")))


def drop_leading_name(text: Column) -> Column:
    """A name with a colon, then one with a dash, at the beginning."""
    return T.strip(F.regexp_replace(F.regexp_replace(text, r"^[a-zA-Z0-9_()]+:", ""), r"^[a-zA-Z0-9_()]+\s-", ""))


def cut_afterthoughts(text: Column) -> Column:
    for mark in AFTERTHOUGHTS:
        text = F.substring_index(T.strip(text), mark, 1)
    return T.strip(text)


def marked_sentences(text: Column) -> Column:
    """Sentence ends before white space become SEPARATOR. A line's first character ends no sentence."""
    return F.regexp_replace(text, r"([^\n])[.!?](\s)", f"$1{SEPARATOR}$2")


def sentences(text: Column) -> Column:
    parts = F.transform(F.split(marked_sentences(text), SEPARATOR, -1), T.strip)
    return F.filter(parts, lambda s: s != "")


def cut_after_url(text: Column) -> Column:
    """The sentences before the first that has a web address."""
    parts = sentences(text)
    first = F.array_position(F.transform(parts, lambda s: s.rlike("https?:")), True)
    kept = F.when(first > 0, F.slice(parts, 1, (first - 1).cast("int"))).otherwise(parts)
    return T.strip(F.array_join(kept, ". "))


def strip_tags(html: Column) -> Column:
    """Text between tags, entities as they are; operators.clean.html_text decodes them."""
    return F.regexp_replace(html, "<[^>]*>", "")


def plain_characters(text: Column) -> Column:
    return F.regexp_replace(text, r"[^a-zA-Z0-9\\_.,]", " ")


def flatten_formats(text: Column) -> Column:
    """HH:MM:SS -> hhmmss and such, in any order of the parts, for times, dates and colours."""
    out = text
    for parts, signs in FORMATS:
        for sign in signs:
            for order in permutations(parts):
                out = F.replace(out, F.lit(sign.join(order)), F.lit("".join(order).lower()))
    return F.when(text.rlike("[:-](?<=(?:HH|MM|SS|DD|YY|hh|mm|ss|dd|yy).)|[,-](?<=[RGBrgb].)(?=[RGBrgb])"), out).otherwise(text)


def close_sentence(text: Column) -> Column:
    """A colon, semicolon, comma or at sign at the end becomes a full stop."""
    return T.strip(F.regexp_replace(text, r"[:;,@]\z", "."))


def first_sentence(text: Column) -> Column:
    """The first sentence that isn't blank of the first paragraph; "" if there is none."""
    paragraph = F.element_at(F.split(text, "\n\n", 2), 1)
    ends = F.regexp_replace(paragraph, r"([.!?])\s+", f"$1{SEPARATOR}")
    found = F.filter(F.transform(F.split(ends, SEPARATOR, -1), T.strip), lambda s: s != "")
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def drop_comments(code: Column, comments: Column) -> Column:
    """Code without each comment's text, in order, and without blank lines."""
    bare = F.aggregate(comments, code, lambda acc, c: F.replace(acc, c, F.lit("")))
    return F.array_join(F.filter(F.split(bare, "\n", -1), lambda x: T.strip(x) != ""), "\n")


def lines_without_comments(code: Column, comments: Column) -> Column:
    """How many non-empty lines hold no comment's text."""
    return F.size(F.filter(F.split(code, "\n", -1), lambda x: (x != "") & ~F.exists(comments, lambda c: F.contains(x, c))))


def drop_delimiters(comment: Column) -> Column:
    """A comment's text: without the marks that open, close and border it; indentation stays."""
    text = F.regexp_replace(comment, '"""|\'\'\'', "")
    text = F.regexp_replace(text, r"(?m)^(\s*)(?:/\*+!?|//+[!*]*|#+!?|--+|\*+(?!/))[ \t]?", "$1")
    return F.regexp_replace(text, r"(?m)\s*\*+/[ \t]*$", "")
