"""Rejection rules for documentation text: Column -> boolean Column, true = reject.

The rules assume text that passed `not_english` (ASCII); on other text they are still
defined, by the ASCII character classes they are written in. A null text gives null.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tokens as T
from .transforms import flatten_formats

BRACKETS = "[({"
SYMBOLS = "!\"#$%&'*+-/:<=>?@\\^`|~"
MATH_SYMBOLS = "|>=<^:/*-+"
MATH_SIGNS = ["mathbf", "mathrm", "equation", "\\log(", "\\exp(", "\\sqrt("]
COMMON = ["a", "an", "but", "for", "in", "it", "of", "or", "the"]
DATE_PARTS = "DD MM YY YYYY R,G,B R-G-B SS HH API".split()
#: Where a word ends. Java's boundary (\b) counts letters outside ASCII as parts of words, although \w doesn't.
END = "(?![A-Za-z0-9_])"
#: A whole run of word characters with an underscore inside. Tried at the run's start only, as it fails later if it fails there.
SNAKE = r"(?<![A-Za-z0-9_])[A-Za-z0-9_]+_[A-Za-z0-9_]+"
#: A run in which both a capital and a small letter follow its first capital.
CAMEL = "(?<![A-Za-z0-9])[a-z0-9]*+[A-Z](?=[a-z0-9]*+[A-Z])(?=[A-Z0-9]*+[a-z])[A-Za-z0-9]*+"
#: The first link of a.b(c: a run that follows no other of its chain.
CALL = r"(?<![a-zA-Z0-9])(?<![a-zA-Z0-9][.(])[a-zA-Z0-9]++[.(](?=[a-zA-Z0-9])"
URL = r"(?i)(?:(?:file|ftp|https?)://|(?:www|ftp)\.)[-?!:,.]*(?:[A-Z0-9+&@#/%=~_|$]|\([-?!:,.A-Z0-9+&@#/%=~_|$]*\))"
LICENSES = "0BSD Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-3.0 CC-BY-4.0 CC0-1.0 MIT MIT-0 RSA-MD WTFPL".split()


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def occurrences(text: Column, piece: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))


def _then(first: Column, rest: Column) -> Column:
    """first & rest, where the rest isn't made unless `first` holds: parts that an `and` has twice are made in any case."""
    return F.when(~first, F.lit(False)).otherwise(rest)


def about_math(text: Column) -> Column:
    return _any([F.contains(text, F.lit(s)) for s in MATH_SIGNS])


def not_english(text: Column) -> Column:
    """Anything but ASCII, or no letter and no digit."""
    return ~text.rlike(r"\A[\x00-\x7F]*\z") | ~text.rlike("[a-zA-Z0-9]")


def bad_length(text: Column) -> Column:
    """Fewer than 3 words or more than 200 lines."""
    ends = F.regexp_count(text, F.lit("\r\n|[\n\r\x0b\x0c\x1c-\x1e]"))
    lines = ends + F.when(text.rlike("[^\n\r\x0b\x0c\x1c-\x1e]\\z"), 1).otherwise(0)
    return (T.word_count(text) < 3) | (lines > 200)


def question(text: Column) -> Column:
    return F.endswith(text, F.lit("?")) | text.rlike(f"(?i)^(?:are|how|is|whats?|where|why){END}")  # what's is a whole "what" too


def unfinished(text: Column) -> Column:
    notes = r"Description of the Method|NOT YET DOCUMENTED|Missing[\s\S]+Description|not in use|Insert the method's description here|No implementation provided|\(non-Javadoc\)"
    return text.rlike(f"(?i)^(?:{notes}|todo|to-do|deprecate|copyright|fixme)")


def generated(text: Column) -> Column:
    return (F.contains(text, F.lit("@")) & text.rlike(f"(?i)@[a-zA-Z]*generated{END}")) | text.rlike(r"(?i)^(?:auto[-\s]generated|This method (?:initializes|was generated by))")


def few_letters(text: Column) -> Column:
    solid, letters = F.regexp_replace(text, r"\s+", ""), F.regexp_replace(text, r"\P{Alpha}+", "")
    sizes = F.struct(F.length(solid).alias("n"), F.length(letters).alias("letters"), about_math(text).alias("math"))

    def rule(x):
        ratio = x["letters"] / x["n"]
        return (x["n"] < 1) | F.when(x["math"], (x["n"] > 15) & (ratio < 0.4)).otherwise((x["n"] > 5) & (ratio < 0.65))

    return T.bind(sizes, rule)


def many_symbols(text: Column) -> Column:
    """Too many of one symbol, or of all but brackets, after time and colour formats are flattened.

    With mathematics the total must pass 17 and 20: the ratio there is 0 times the tokens.
    """

    def rule(x):
        signs, math = x["signs"], x["math"]
        each = [occurrences(signs, s) > 6 for s in BRACKETS]
        each += [occurrences(signs, s) > F.when(math, 10 if s in MATH_SYMBOLS else 4).otherwise(4) for s in SYMBOLS]
        total = F.length(signs) - F.length(F.translate(signs, SYMBOLS, ""))
        return _any(each) | F.when(math, total > 20).otherwise((total > 15) & (total > 0.3 * T.token_count(x["flat"])))

    others = "[^" + re.sub(r"(\W)", r"\\\1", BRACKETS + SYMBOLS) + "]+"
    parts = lambda flat: F.struct(flat.alias("flat"), F.regexp_replace(flat, others, "").alias("signs"), about_math(flat).alias("math"))
    return T.bind(flatten_formats(T.strip(text)), lambda flat: T.bind(parts(flat), rule))


def few_characters(text: Column) -> Column:
    solid = lambda x: F.regexp_replace(x, r"\s+", "")
    few = lambda x: F.size(F.array_distinct(F.split(solid(x), ""))) <= 3
    return _then(few(F.substring(text, 1, 64)), (F.length(solid(text)) > 5) & few(text))  # no more can be in the beginning than in all


def repeated_word(text: Column) -> Column:
    """The most frequent word, common ones aside, occurs 3 times or more and is over 30 % of all; or no word at all."""

    def rule(words):
        n = F.size(words)
        return (n == 0) | T.bind(T.most_frequent(words, 0.29, COMMON), lambda most: (most >= 3) & (most / n > 0.3))

    return T.bind(T.plain_words(text), rule)


def _over(found: Column, text: Column, share: float) -> Column:
    """More found than `share` of the words; these aren't counted where nothing is found."""
    n = T.word_count(text)
    return _then(found > 0, (n > 0) & (found / n > share))


def many_variables(text: Column) -> Column:
    camel = lambda x: F.regexp_count(x, F.lit(CAMEL))
    snake = F.contains(text, F.lit("_"))
    found = F.when(snake, F.regexp_count(text, F.lit(SNAKE)) + camel(F.regexp_replace(text, SNAKE, ""))).otherwise(camel(text))
    return _over(found, text, 0.3)


def many_calls(text: Column) -> Column:
    return _then(text.rlike(r"[.(](?<=[a-zA-Z0-9].)(?=[a-zA-Z0-9])"), _over(F.regexp_count(text, F.lit(CALL)), text, 0.2))


def many_capitals(text: Column) -> Column:
    shouts = lambda x: F.regexp_count(x, F.lit(r"\s[A-Z][A-Z0-9_]+"))
    bare = text
    for part in DATE_PARTS:
        bare = F.replace(bare, F.lit(part), F.lit(part.lower()))
    bare, n = F.regexp_replace(T.strip(bare), SNAKE, "x"), T.word_count(text)
    return _then(_over(shouts(text), text, 0.3), (n > 10) & (shouts(bare) / n > 0.3))  # `bare` can only have fewer than the text


def long_word(text: Column) -> Column:
    """A piece of a word over 30 characters, or no token."""
    return ~text.rlike(r"\S") | _then(text.rlike(r"\w{31}"), T.camel_marked(text).rlike("[A-Za-z0-9]{31,}"))


def has_url(text: Column) -> Column:
    return (F.contains(text, F.lit("://")) | text.rlike(r"\.(?<=(?i:www|ftp)\.)")) & text.rlike(URL)


LOOSE = (question, unfinished, generated, few_letters, few_characters, repeated_word, many_capitals, long_word, has_url)
STRICT = (question, unfinished, generated, few_letters, many_symbols, few_characters, repeated_word, many_variables, many_calls, many_capitals, long_word, has_url)


def bad_sentence(text: Column, loose: bool = False) -> Column:
    """Any rule of the list, or an empty text."""
    return (text == "") | _any([rule(text) for rule in (LOOSE if loose else STRICT)])  # in order: `or` stops at the first that holds


def skipped_name(name: Column, excluded: list[str] = ()) -> Column:
    """Names of dunders, getters, setters, tests, constructors and of `excluded`."""
    marks = [*"Test_ test_ _test Constructor constructor toString".split(), *excluded]
    dunder = F.startswith(name, F.lit("__")) & F.endswith(name, F.lit("__"))
    return dunder | F.startswith(name, F.lit("set")) | F.startswith(name, F.lit("get")) | _any([F.contains(name, F.lit(m)) for m in marks])


def no_name(name: Column) -> Column:
    return name.isNull() | (name == "")


def says_its_name(name: Column, comment: Column) -> Column:
    """The comment is, but for 40 % of its characters, the name's parts."""
    a = F.array_join(T.identifier_parts(name), " ")
    b = F.lower(F.regexp_replace(comment, "[^a-zA-Z0-9]", " "))
    return F.levenshtein(a, b) <= 0.4 * F.greatest(F.length(a), F.length(b))


def licensed(licenses: Column, allowed: list[str] = LICENSES) -> Column:
    """Every licence is allowed; none at all is allowed too."""
    return F.forall(licenses, lambda x: x.isin(list(allowed)))


def licensed_by_one(license: Column, allowed: list[str] = ("MIT",)) -> Column:
    """A single licence is allowed; none isn't."""
    return F.coalesce(license.isin(list(allowed)), F.lit(False))


def specific_pattern(text: Column) -> Column:
    """Never holds for ASCII text: it asks one first character to be a letter and not alphanumeric."""
    return F.when(text.isNotNull(), F.lit(False))


def documentation_fits(n_tokens: Column) -> Column:
    return n_tokens.between(6, 499)


def code_fits(n_tokens: Column) -> Column:
    return n_tokens.between(6, 999)
