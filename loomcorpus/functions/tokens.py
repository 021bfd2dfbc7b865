"""Word and token splitting as column expressions.

Character classes are ASCII on purpose: they mean the same in Java and in RE2, and the
cleaning pipeline only lets ASCII text reach them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A docstring token: a run of word characters, or one other visible character.
TOKEN = r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]"
#: The same for Java, where \w is ASCII and quicker than ranges.
_JAVA_TOKEN = r"\w+|[^\s\w]"


def strip(text: Column) -> Column:
    """Without white space at both ends (blanks, tabs and line ends alike)."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def bind(value: Column, use) -> Column:
    """use(value), with the value made once however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_JAVA_TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_JAVA_TOKEN))


def blank_words(text: Column) -> Column:
    """What stands between white space."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of blank_words, without building them."""
    return F.regexp_count(text, F.lit(r"\S+"))


def plain_words(text: Column) -> Column:
    """Alphanumeric words that don't touch an underscore."""
    words = F.split(text, r"\W+")
    return F.when(F.contains(text, F.lit("_")), F.filter(words, lambda w: (w != "") & ~F.contains(w, F.lit("_")))).otherwise(F.array_remove(words, ""))


def camel_marked(text: Column, mark: str = " ") -> Column:
    """A mark where a camel-case word changes: aB -> a B, ABc -> A Bc."""
    return F.regexp_replace(F.regexp_replace(text, "([a-z])([A-Z])", f"$1{mark}$2"), "([A-Z])([A-Z][a-z])", f"$1{mark}$2")


def word_pieces(text: Column) -> Column:
    """Tokens, split at underscores and camel-case changes; empty pieces dropped."""
    pieces = F.transform(tokens(text), lambda t: F.split(F.replace(camel_marked(t), F.lit("_"), F.lit(" ")), " "))
    return F.filter(F.flatten(pieces), lambda p: p != "")


def identifier_parts(name: Column) -> Column:
    """Lower-case parts of an identifier, cut at underscores, blanks, camel case, digits and quotes or dots."""
    between = [("a-z0-9", "[A-Z]"), ("A-Z0-9", "[A-Z][a-z]"), ("0-9", "[A-Za-z]"), ("A-Za-z", "[0-9]"), ("\"$'.@", "[A-Za-z0-9]"), ("A-Za-z0-9", "[\"$'.@]")]
    cuts = [f"(?<=[{left}])(?={right})" for left, right in between] + [r"_|\s+"]
    parts = F.filter(F.split(name, "|".join(cuts)), lambda p: p != "")
    return F.when(F.size(parts) == 0, F.array(name)).otherwise(F.transform(parts, F.lower))


def most_frequent(words: Column, share: float, ignored: list[str]) -> Column:
    """How often the most frequent word that isn't ignored occurs, if that is more than `share` of all; else some lower number.

    In sorted order such a word's run is as long as a step of that share, so that one of the steps' ends falls on it.
    """

    def count(ordered: Column) -> Column:
        n = F.size(ordered)
        step = F.floor(share * n).cast("int") + 1
        ends = [F.get(ordered, k * step - 1) for k in range(1, int(1 / share) + 1)]
        return F.greatest(F.lit(0), *[F.when(end.isNotNull() & ~end.isin(ignored), n - F.size(F.array_remove(ordered, end))).otherwise(0) for end in ends])

    return bind(F.sort_array(words), count)
