"""One query for each operator over the test tables, and SQL that gives the same rows.

A docstring is documents.text, its repository documents.source, its language
documents.lang and its code length documents.n_chars.
"""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import tokens as T
from ..functions import transforms as X
from ..operators import clean, dedup, extract, licenses, splits, stats
from ..operators.docstyles import parsed_docstring
from ..operators.model_filter import keep_by_model, trained_classifier
from ..sources.tables import read_parquet
from . import corpus, samples

T_WORD = re.compile(r"\w+")
SQL: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark, sf_dir: str, name: str):
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def texts(spark, sf_dir: str):
    """documents (doc_id, text) and the literal texts, which have negative ids."""
    more = spark.createDataFrame([(-k, x) for k, x in enumerate(samples.TEXTS, 1)], "doc_id bigint, text string")
    return table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(more)


# DuckDB pieces. Lists and patterns are written out here once more, apart from the engine's. _q: a literal; _strip: no white space at the ends.
def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {_q(pattern)}))"


def _less(x: str, piece: str) -> str:
    return f"(length({x}) - length(replace({x}, {_q(piece)}, '')))"


def _values(rows: list[tuple], names: str) -> str:
    show = lambda v: "null" if v is None else str(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v).lower() if isinstance(v, bool) else _q(v)
    return f"select * from (values {', '.join('(' + ', '.join(map(show, r)) + ')' for r in rows)}) as v({names})"


_TEXTS = f"(select doc_id, text from documents union all {_values([(-k, x) for k, x in enumerate(samples.TEXTS, 1)], 'doc_id, text')})"
_TOKEN = r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]"
_SNAKE = "[A-Za-z0-9_]+_[A-Za-z0-9_]+"
_HUMP = "[A-Z][A-Za-z0-9]*([a-z][A-Za-z0-9]*[A-Z]|[A-Z][A-Za-z0-9]*[a-z])[A-Za-z0-9]*"
_SOLID = r"regexp_replace(text, '\s+', '', 'g')"
_MATH = r"(contains(text, 'mathbf') or contains(text, 'mathrm') or contains(text, 'equation') or contains(text, '\log(') or contains(text, '\exp(') or contains(text, '\sqrt('))"
_CAMEL = "regexp_replace(regexp_replace({x}, '([a-z])([A-Z])', '\\1 \\2', 'g'), '([A-Z])([A-Z][a-z])', '\\1 \\2', 'g')"
_N = _count("text", r"\S+")


def _flat(x: str) -> str:
    """Formats of times, dates and colours, each order of the parts, become one lower-case word: longest parts last, as listed."""
    for parts, signs in (("HH MM SS", ":-"), ("MM DD YY", ":-"), ("MM DD YYYY", ":-"), ("hh mm ss", ":-"), ("mm dd yy", ":-"), ("mm dd yyyy", ":-"), ("R G B", ",-"), ("r g b", ",-")):
        a, b, c = parts.split()
        for sign in signs:
            for one in ((a, b, c), (a, c, b), (b, a, c), (b, c, a), (c, a, b), (c, b, a)):
                x = f"replace({x}, '{sign.join(one)}', '{''.join(one).lower()}')"
    return x


def _symbols(x: str) -> str:
    each = [f"{_less(x, s)} > 6" for s in "[({"] + [f"{_less(x, s)} > {f'(case when {_MATH} then 10 else 4 end)' if s in '|>=<^:/*-+' else 4}" for s in "!\"#$%&'*+-/:<=>?@\\^`|~"]
    total = f"(length({x}) - length(translate({x}, {_q('!' + chr(34) + '#$%&' + chr(39) + '*+-/:<=>?@' + chr(92) + '^`|~')}, '')))"
    return f"({' or '.join(each)} or {total} > case when {_MATH} then 20.0 else greatest(15.0, 0.3 * {_count(x, _TOKEN)}) end)"


_DATES = "text"
for _part in ("DD", "MM", "YY", "YYYY", "R,G,B", "R-G-B", "SS", "HH", "API"):
    _DATES = f"replace({_DATES}, '{_part}', '{_part.lower()}')"

#: Rules in SQL over `text`; those that need more than a row's expression come after.
RULES_SQL = {
    "not_english": r"(not regexp_full_match(text, '[\x00-\x7F]*', 's') or not regexp_matches(text, '[a-zA-Z0-9]'))",
    "bad_length": f"({_N} < 3 or {_count('text', chr(13) + chr(10) + '|[' + chr(10) + chr(13) + r'\x0b\x0c\x1c-\x1e]')} + case when regexp_matches(text, '[^\\n\\r\\x0b\\x0c\\x1c-\\x1e]\\z') then 1 else 0 end > 200)",
    "question": r"(ends_with(text, '?') or regexp_matches(text, '(?i)^(?:are|how|is|what''?s?|where|why)\b'))",
    "unfinished": r"regexp_matches(text, '(?i)^(?:Description of the Method|NOT YET DOCUMENTED|Missing[\s\S]+Description|not in use|Insert the method''s description here|No implementation provided|\(non-Javadoc\)|todo|to-do|deprecate|copyright|fixme)')",
    "generated": r"(regexp_matches(text, '(?i)@[a-zA-Z]*generated\b') or regexp_matches(text, '(?i)^(?:auto[-\s]generated|This method (?:initializes|was generated by))'))",
    "few_letters": f"(length({_SOLID}) < 1 or case when {_MATH} then length({_SOLID}) > 15 and length(regexp_replace(text, '[^a-zA-Z]+', '', 'g')) / length({_SOLID}) < 0.4 else length({_SOLID}) > 5 and length(regexp_replace(text, '[^a-zA-Z]+', '', 'g')) / length({_SOLID}) < 0.65 end)",
    "many_symbols": _symbols("flat"),
    "few_characters": f"(length({_SOLID}) > 5 and len(list_distinct(string_split({_SOLID}, ''))) <= 3)",
    "repeated_word": "(n_words = 0 or (most >= 3 and most / n_words > 0.3))",
    "many_variables": f"({_N} > 0 and ({_count('text', _SNAKE)} + {_count(f'regexp_replace(text, {_q(_SNAKE)}, {_q("")}, {_q("g")})', _HUMP)}) / {_N} > 0.3)",
    "many_calls": f"({_N} > 0 and {_count('text', '[a-zA-Z0-9]+([.(][a-zA-Z0-9]+)+')} / {_N} > 0.2)",
    "many_capitals": f"({_N} > 10 and {_count(f'regexp_replace({_strip(_DATES)}, {_q(_SNAKE)}, {_q("x")}, {_q("g")})', chr(92) + 's[A-Z][A-Z0-9_]+')} / {_N} > 0.3)",
    "long_word": rf"(not regexp_matches(text, '\S') or regexp_matches({_CAMEL.format(x='text')}, '[A-Za-z0-9]{{31,}}'))",
    "has_url": r"regexp_matches(text, '(?i)((file|ftp|https?)://|(www|ftp)\.)[-?!:,.]*([A-Z0-9+&@#/%=~_|$]|\([-?!:,.A-Z0-9+&@#/%=~_|$]*\))')",
}
_BASE = f"""with w as (select doc_id, text, list_filter(regexp_split_to_array(text, '[^A-Za-z0-9_]+'), lambda x: x <> '' and not contains(x, '_')) as words from {_TEXTS}),
b as (select doc_id, text, len(words) as n_words, coalesce(list_max(map_values(list_histogram(list_filter(words, lambda x: x not in ('a', 'an', 'but', 'for', 'in', 'it', 'of', 'or', 'the'))))), 0) as most, {_flat(_strip('text'))} as flat from w) """


def _rule(number: int, rule) -> None:
    name = rule.__name__

    def run(spark, sf_dir):
        return texts(spark, sf_dir).select("doc_id", rule(F.col("text")).alias("rejected"))

    run.__name__ = f"p{number}_{name}"
    query(_BASE + f"select doc_id, {RULES_SQL[name]} as rejected from b")(run)


for _k, _f in enumerate([P.not_english, P.bad_length, P.question, P.unfinished, P.generated, P.many_symbols, P.few_letters, None, P.few_characters, P.repeated_word, P.many_variables, P.many_calls, P.many_capitals, P.long_word, P.has_url], 1):
    if _f is not None:
        _rule(_k, _f)


def _all(rules) -> str:
    return "(text = '' or " + " or ".join(RULES_SQL[r.__name__] for r in rules) + ")"


@query(_BASE + f"select doc_id, {_all(P.STRICT)} as rejected from b")
def p17_strict(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", P.bad_sentence(F.col("text")).alias("rejected"))


@query(_BASE + f"select doc_id, {_all(P.LOOSE)} as rejected from b")
def p17_loose(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", P.bad_sentence(F.col("text"), True).alias("rejected"))


@query("select p_partkey, p_name like 'set%' or p_name like 'get%' or contains(p_name, 'test_') or contains(p_name, 'Test_') or contains(p_name, '_test') or contains(p_name, 'toString') or contains(p_name, 'constructor') or contains(p_name, 'Constructor') or (starts_with(p_name, '__') and ends_with(p_name, '__')) as skipped, p_name is null or p_name = '' as unnamed from part")
def p19_p21_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", P.skipped_name(F.col("p_name")).alias("skipped"), P.no_name(F.col("p_name")).alias("unnamed"))


_SAYS = r"levenshtein(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(name, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '([0-9])([A-Za-z])', '\1 \2', 'g'), '([A-Za-z])([0-9])', '\1 \2', 'g'), '_|\s+', ' ', 'g')), lower(regexp_replace(said, '[^a-zA-Z0-9]', ' ', 'g')))"


@query(f"select id, {_SAYS} <= 0.4 * greatest(length(regexp_replace(regexp_replace(regexp_replace(name, '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '([0-9])([A-Za-z])', '\\1 \\2', 'g'), '([A-Za-z])([0-9])', '\\1 \\2', 'g')), length(said)) as rejected from (select c_custkey as id, c_name as name, c_mktsegment as said from customer union all {_values([(-k, *x) for k, x in enumerate(samples.NAMES, 1)], 'id, name, said')})")
def p23_says_its_name(spark, sf_dir):
    pairs = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("said"))
    more = spark.createDataFrame([(-k, *x) for k, x in enumerate(samples.NAMES, 1)], "id bigint, name string, said string")
    return pairs.unionByName(more).select("id", P.says_its_name(F.col("name"), F.col("said")).alias("rejected"))


_FRAMED = "|".join(rf"\{c}.*\{c}" for c in "*+-/=_")
_LINES = f"string_split({_strip('text')}, chr(10))"
_LINK1 = rf"regexp_replace({_strip('text')}, '\((?:see|eg.|http|e\.g).*?\)', '', 'g')"


def _markers(x: str) -> str:
    for mark in ("/**", "/*", "<code>", "</code>", "*-*"):
        x = f"case when contains({x}, {_q(mark)}) then {_strip(f'replace({x}, {_q(mark)}, {_q("")})')} else {x} end"
    return x


def _cuts(x: str) -> str:
    for mark in ("E.g", "e.g", "eg.", "Eg.", "Example usage:", "Created by", "Example:", "Note:", ". Note", "note::", "note:", ". note"):
        x = f"split_part({_strip(x)}, {_q(mark)}, 1)"
    return _strip(x)


_SENTENCES = rf"list_filter(list_transform(string_split(regexp_replace(text, '([^\n])[.!?](\s)', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: {_strip('s')}), lambda s: s <> '')"
_STEPS = {
    "t2_bracketed_links": (X.drop_bracketed_links, _strip(rf"regexp_replace({_strip(_LINK1)}, '<(?:see|eg.|http|e\.g).*?>', '', 'g')")),
    "t4_rulers": (X.blank_rulers, _strip(f"array_to_string(list_transform({_LINES}, lambda x: case when {_strip('x')} in ('*', '/', '=', '-', '+') then '' else x end), chr(10))")),
    "t5_framed_lines": (X.drop_framed_lines, _strip(f"array_to_string(list_filter(list_transform({_LINES}, lambda x: {_strip('x')}), lambda x: not regexp_full_match(x, {_q(_FRAMED)})), chr(10))")),
    "t7_leading_name": (X.drop_leading_name, _strip(r"regexp_replace(regexp_replace(text, '^[a-zA-Z0-9_()]+:', ''), '^[a-zA-Z0-9_()]+\s-', '')")),
    "t8_afterthoughts": (X.cut_afterthoughts, _cuts("text")),
    "t11_plain_characters": (X.plain_characters, r"regexp_replace(text, '[^a-zA-Z0-9\\_.,]', ' ', 'g')"),
    "t12_formats": (X.flatten_formats, _flat("text")),
    "t13_close": (X.close_sentence, _strip(r"regexp_replace(text, '[:;,@]\z', '.')")),
}


def _step(name: str, step, sql: str) -> None:
    def run(spark, sf_dir):
        return texts(spark, sf_dir).select("doc_id", step(F.col("text")).alias("text"))

    run.__name__ = name
    query(f"select doc_id, {sql} as text from {_TEXTS}")(run)


for _name, (_f, _s) in _STEPS.items():
    _step(_name, _f, _s)


@query(f"select page_id, {_markers('html')} as text from pages")
def t3_markers(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.drop_markers(F.col("html")).alias("text"))


@query("select page_id, regexp_replace(html, '<[^>]*>', '', 'g') as text from pages")
def t10_strip_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.strip_tags(F.col("html")).alias("text"))


@query(f"with s as (select doc_id, {_SENTENCES} as parts from {_TEXTS}), f as (select doc_id, parts, list_position(list_transform(parts, lambda s: regexp_matches(s, 'https?:')), true) as k from s) select doc_id, {_strip('array_to_string(case when k > 0 then parts[1:k - 1] else parts end, ' + _q('. ') + ')')} as text from f")
def t9_after_url(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", X.cut_after_url(F.col("text")).alias("text"))


@query(f"select doc_id, cast(n as int) as k, s as sentence from (select doc_id, unnest({_SENTENCES}) as s, generate_subscripts({_SENTENCES}, 1) - 1 as n from documents)")
def t15_sentences(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("k", "sentence"))


@query(r"select conv_id, turn, coalesce(list_filter(list_transform(string_split(regexp_replace(split_part(text, chr(10) || chr(10), 1), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: " + _strip("s") + "), lambda s: s <> '')[1], '') as sentence from conversations")
def t18_first_sentence(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.first_sentence(F.col("text")).alias("sentence"))


@query(f"select page_id, array_to_string(list_filter(string_split(replace(html, regexp_extract(html, '<!--.*?-->', 0, 's'), ''), chr(10)), lambda x: {_strip('x')} <> ''), chr(10)) as code from pages")
def t19_drop_comments(spark, sf_dir):
    said = F.array(F.regexp_extract("html", "(?s)<!--.*?-->", 0))
    return table(spark, sf_dir, "pages").select("page_id", X.drop_comments(F.col("html"), said).alias("code"))


@query("select doc_id, cast(len(list_filter(string_split(text, chr(10)), lambda x: x <> '' and not contains(x, lang))) as int) as n from documents")
def t20_code_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.lines_without_comments(F.col("text"), F.array("lang")).alias("n"))


@query()
def t21_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean.cleaned(F.col("text")).alias("docstring"))


@query()
def t10_html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", clean.html_as_text(F.col("html")).alias("text"))


def licensed(spark, sf_dir):
    """Documents with the licences their text names, an empty list for none, and lengths."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", F.array_distinct(F.regexp_extract_all("text", F.lit(r"under the (\w+) License"), F.lit(1))).alias("license"), T.word_count(F.col("text")).alias("n_docstring_tokens"), F.length("text").alias("n_code_tokens"))


_ALLOWED = "'0BSD', 'Apache-2.0', 'BSD-2-Clause', 'BSD-3-Clause', 'CC-BY-3.0', 'CC-BY-4.0', 'CC0-1.0', 'MIT', 'MIT-0', 'RSA-MD', 'WTFPL'"
_LICENSED = rf"with l as (select doc_id, lang, list_distinct(regexp_extract_all(text, 'under the (\w+) License', 1)) as license, {_N} as nd, length(text) as nc from documents), t as (select *, len(list_filter(license, lambda x: x not in ({_ALLOWED}))) = 0 as a, nd between 6 and 499 as b, nc between 6 and 999 as c from l) "


@query(_LICENSED + "select doc_id from t where a and b and c")
def lic_valid(spark, sf_dir):
    return licenses.keep_valid(licensed(spark, sf_dir), licenses.conditions()).select("doc_id")


@query(_LICENSED + "select lang, count(*) as original, count(*) filter (a) as has_valid_license, count(*) filter (b) as valid_docstring_tokens_num, count(*) filter (c) as valid_code_tokens_num, count(*) filter (a and b and c) as filtered, count(*) filter (a and b and c) * 100 / count(*) as percent from t group by lang")
def lic_report(spark, sf_dir):
    return licenses.report(licensed(spark, sf_dir), licenses.conditions(), "lang")


@query(_LICENSED + "select doc_id from t where not a")
def lic_invalid(spark, sf_dir):
    return licenses.invalid(licensed(spark, sf_dir)).select("doc_id")


@query(_LICENSED + f"select distinct license from (select unnest(license) as license from t) where license not in ({_ALLOWED})")
def a17_invalid_names(spark, sf_dir):
    return licenses.invalid_names(licensed(spark, sf_dir))


@query("select source, avg(n_chars) as mean_n_chars, avg(length(text)) as mean_n_text, count(*) as n from documents group by source")
def a1_repo_means(spark, sf_dir):
    return splits.by_repo(table(spark, sf_dir, "documents").withColumn("n_text", F.length("text")), "source", "n_chars", "n_text")


_BINS = "with m as (select source, avg(n_chars) as v from documents group by source), e as (select quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as edges from m), b as (select source, v, len(list_filter(edges, lambda x: v > x)) as bin from m, e) "


@query(_BINS + "select source, cast(bin as int) as bin from b")
def a3_deciles(spark, sf_dir):
    means = splits.by_repo(table(spark, sf_dir, "documents"), "source", "n_chars")
    return splits.quantile_bins(means, "mean_n_chars").select("source", "bin")


@query("select doc_id, text from (select *, row_number() over (partition by text order by doc_id) as k from documents) where k = 1")
def a4_keep_first(spark, sf_dir):
    return splits.keep_first(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ["doc_id"])


@query(r"select lang, count(*) as n, count(*) filter (text is null or not regexp_matches(text, '\S')) as none_docstring from documents group by lang")
def a5_volume(spark, sf_dir):
    return stats.volume(table(spark, sf_dir, "documents"), "lang", "text")


def tokenized(spark, sf_dir):
    return table(spark, sf_dir, "documents").withColumn("tokens", T.tokens(F.col("text")))


_TOKENS = f"with t as (select lang, unnest(regexp_extract_all(text, {_q(_TOKEN)})) as t from documents) "


@query(_TOKENS + "select lang, count(*) as all_tokens, count(distinct t) as unique_tokens from t group by lang")
def a7_token_volume(spark, sf_dir):
    return stats.token_volume(tokenized(spark, sf_dir), "lang", "tokens")


@query(f"select lang, cast(len(regexp_extract_all(text, {_q(_TOKEN)})) as int) as length, count(*) as n from documents group by all")
def a8_lengths(spark, sf_dir):
    return stats.length_distribution(tokenized(spark, sf_dir), "lang", "tokens")


@query("select lang, avg(n_chars) as mean, median(n_chars) as median, max(n_chars) as max, min(n_chars) as min, stddev_pop(n_chars) as std, count(n_chars) as n from documents group by lang")
def a11_summary(spark, sf_dir):
    return stats.summary(table(spark, sf_dir, "documents"), "lang", "n_chars")


_CLEAN = _BASE + f", r as (select d.lang, count(*) as n, count(*) filter (not regexp_matches(d.text, '\\S')) as none_docstring, count(*) filter (regexp_matches(d.text, '\\S') and not {RULES_SQL['not_english'].replace('text', 'd.text')}) as clean from documents d group by d.lang), a as (select *, n - none_docstring - clean as noise from r) "


@query(_CLEAN + "select *, clean / n as ratio from (select lang, n, none_docstring, clean, noise from a union all select 'total', cast(sum(n) as bigint), cast(sum(none_docstring) as bigint), cast(sum(clean) as bigint), cast(sum(noise) as bigint) from a)")
def a12_a13_breakdown(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    kept = d.where(F.col("text").rlike(r"\S") & ~P.not_english(F.col("text"))).groupBy("lang").agg(F.count("*").alias("n"))
    return stats.breakdown(stats.volume(d, "lang", "text"), kept, "lang")


@query("select role, turn, count(*) as n from conversations where turn <= 20 group by role, turn")
def a14_histogram(spark, sf_dir):
    return stats.histogram(table(spark, sf_dir, "conversations"), "role", "turn", 20)


@query("select lang, quantile_cont(n_chars, 0.25) as q1, quantile_cont(n_chars, 0.5) as q2, quantile_cont(n_chars, 0.75) as q3, avg(n_chars) as mean from documents group by lang")
def a15_quartiles(spark, sf_dir):
    return stats.quartiles(table(spark, sf_dir, "documents"), "lang", "n_chars")


@query(_TOKENS + "select count(distinct t) as unique_tokens from t")
def a16_token_union(spark, sf_dir):
    return stats.union_of_tokens(tokenized(spark, sf_dir), "tokens")


_SPLIT = _BINS + ", p as (select source, row_number() over (partition by bin order by md5('42:' || source), source) / count(*) over (partition by bin) as place, v from b) "


#: A repository is a source and a language here, and eval and test get this many rows each, so that the test tables are split.
SET_ROWS = 150
_BY_REPO = "with r as (select *, source || '/' || lang as repo from documents), m as (select repo, avg(n_chars) as v from r group by repo), e as (select quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as edges from m), b as (select repo, len(list_filter(edges, lambda x: v > x)) as bin from m, e), p as (select repo, row_number() over (partition by bin order by md5('42:' || repo), repo) / count(*) over (partition by bin) as place from b) "


@query(_BY_REPO + ", s as (select 150 / (select count(*) from documents) as x) select doc_id, repo, case when place <= x then 'test' when place <= x + x then 'eval' else 'train' end as set_name from r join p using (repo), s")
def sp1_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("repo", F.concat_ws("/", "source", "lang"))
    return splits.train_eval_test(d, "repo", "n_chars", SET_ROWS).select("doc_id", "repo", "set_name")


@query(_SPLIT + "select doc_id, case when place <= 0.0 + 0.05::double then 'small_train' when place <= 0.05::double + 0.25::double then 'medium_train' else 'large_train' end as set_name from documents join p using (source)")
def sp2_train_sizes(spark, sf_dir):
    return splits.train_sizes(table(spark, sf_dir, "documents"), "source", "n_chars").select("doc_id", "set_name")


@query("select doc_id, sha256(text) as id from documents")
def sp4_id(spark, sf_dir):
    return splits.with_id(table(spark, sf_dir, "documents"), "text").select("doc_id", "id")


@query("select doc_id, n_chars from documents order by n_chars desc, doc_id limit 100")
def sp6_limit(spark, sf_dir):
    """A row cap, which is the feature: the 100 longest."""
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(100)


@query("select d.doc_id, s.n as repo_rows from documents d join (select source, count(*) as n from documents group by source) s on d.source = s.source")
def j1_right(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.join(d.groupBy("source").agg(F.count("*").alias("repo_rows")), "source", "right").select("doc_id", "repo_rows")


_SETS = "with s as (select doc_id, case when toxic = 1 then 'test' when quality = 0 then 'eval' else 'small_train' end as set_name from labels) "


def labelled_sets(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "test").when(F.col("quality") == 0, "eval").otherwise("small_train").alias("set_name"))


@query(_SETS + "select d.doc_id, coalesce(set_name, 'train') as set_name from documents d left join s on d.doc_id = s.doc_id")
def j2_assign(spark, sf_dir):
    return splits.assign(table(spark, sf_dir, "documents").select("doc_id"), labelled_sets(spark, sf_dir), "doc_id")


@query(_SETS + ", a as (select d.doc_id, coalesce(set_name, 'train') as set_name from documents d left join s on d.doc_id = s.doc_id) select set_name, count(*) as n from a group by set_name union all select 'full_train', count(*) from a where set_name not in ('eval', 'test')")
def k4_route(spark, sf_dir):
    a = splits.assign(table(spark, sf_dir, "documents").select("doc_id"), labelled_sets(spark, sf_dir), "doc_id")
    return a.groupBy("set_name").agg(F.count("*").alias("n")).unionByName(splits.full_train(a).agg(F.lit("full_train").alias("set_name"), F.count("*").alias("n")))


def grams(spark, sf_dir, name: str, key: str):
    return dedup.with_ngrams(table(spark, sf_dir, name), key, "text").withColumnRenamed(key, "id")


def _grams(name: str, key: str) -> str:
    words = f"regexp_extract_all(lower(coalesce(text, '')), {_q(_TOKEN)})"
    return f"select id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) else [] end as g from (select {key} as id, {words} as w from {name})"


@query(f"select id, cast(len(g) as int) as n from ({_grams('documents', 'doc_id')})")
def j6_ngrams(spark, sf_dir):
    return grams(spark, sf_dir, "documents", "doc_id").select("id", F.size("grams").alias("n"))


@query(f"with a as ({_grams('documents', 'doc_id')}), b as ({_grams('benchmark', 'item_id')}), x as (select id as tgt, len(g) as nb, unnest(g) as s from b), y as (select id as src, len(g) as na, unnest(g) as s from a), c as (select src, tgt, na, nb, count(*) as c from x join y using (s) group by all) select src, tgt, c / (na + nb - c) as jaccard from c where c / (na + nb - c) >= 0.05")
def j8_jaccard(spark, sf_dir):
    return dedup.overlap(grams(spark, sf_dir, "documents", "doc_id"), grams(spark, sf_dir, "benchmark", "item_id"), 0.05)


@query(f"with a as ({_grams('documents', 'doc_id')}), b as ({_grams('benchmark', 'item_id')}), x as (select id as tgt, len(g) as nb, unnest(g) as s from b), y as (select id as src, len(g) as na, unnest(g) as s from a), c as (select src, tgt, na, nb, count(*) as c from x join y using (s) group by all) select doc_id from documents where doc_id not in (select src from c where c / (na + nb - c) >= 0.05)")
def dedup_anti(spark, sf_dir):
    found = dedup.overlap(grams(spark, sf_dir, "documents", "doc_id"), grams(spark, sf_dir, "benchmark", "item_id"), 0.05)
    return table(spark, sf_dir, "documents").select("doc_id").join(found.select(F.col("src").alias("doc_id")).distinct(), "doc_id", "left_anti")


@query()
def j8_lsh(spark, sf_dir):
    return dedup.contaminated(grams(spark, sf_dir, "documents", "doc_id"), grams(spark, sf_dir, "benchmark", "item_id"), 0.3, recall=0.95)


@query()
def j3_signatures(spark, sf_dir):
    rows = lambda name, key: table(spark, sf_dir, name).select(F.col(key).alias("id"), "text")
    return dedup.similar_pairs(rows("documents", "doc_id"), rows("benchmark", "item_id"), 0.1)


@query("select conv_id, turn, lag(text) over w as prev_context, lead(text) over w as next_context from conversations window w as (partition by conv_id order by turn)")
def ctx_lag_lead(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lag("text").over(w).alias("prev_context"), F.lead("text").over(w).alias("next_context"))


@query()
def p33_model_filter(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text is not null")
    model = trained_classifier(d.join(table(spark, sf_dir, "labels").where("quality is not null"), "doc_id"), "quality", "text")
    return model.transform(d).where("prediction != 0").select("doc_id")


_KEPT = f"with b as (select lang, {RULES_SQL['not_english']} or {RULES_SQL['few_letters']} or {RULES_SQL['bad_length']} as bad from documents) select lang, count(*) filter (not bad) as kept, count(*) filter (bad) as rejected from b group by lang"


@query(_KEPT)
def kept_by_language(spark, sf_dir):
    return corpus.kept_by_language(table(spark, sf_dir, "documents"))


def files(spark):
    """The literal files, in one task: each task of a few rows has Python workers of its own."""
    return spark.createDataFrame([("r", *f) for f in samples.FILES], "repo string, path string, language string, code string").coalesce(1)


def _head(c: str):
    return F.split(c, "\n").getItem(0)


# What extraction finds in samples.FILES, written down by hand.
_FUNCTIONS = [
    ("a.py", "python", "total_price", "items:,rate:float", 3, "def total_price(items, rate: float = 0.2):", "Sums the prices of all items."),
    ("a.go", "go", "Add", "a:int,b:int", 1, "func Add(a int, b int) int {", "// Add adds the numbers."),
    ("A.java", "java", "add", "a:int,b:List<String>", 0, "public int add(int a, List<String> b) {", "/**"),
    ("a.js", "javascript", "join", "first:,last:", 0, "function join(first, last) {", "/** Joins the names."),
    ("a.rb", "ruby", "count_words", "text:", 1, "def count_words(text)", "# Counts the words of a text."),
    ("a.rs", "rust", "double", "n:i32", 0, "pub fn double(n: i32) -> i32 {", "/// Doubles the number given."),
]


@query(_values(_FUNCTIONS, "path, language, identifier, parameters, n_comments, first_line, said"))
def e3_functions(spark, sf_dir):
    r = corpus.raw(files(spark))
    parameters = F.array_join(F.transform(F.array_sort(F.map_entries("parameters")), lambda e: F.concat(e["key"], F.lit(":"), F.coalesce(e["value"], F.lit("")))), ",")
    return r.select("path", "language", "identifier", parameters.alias("parameters"), F.size("comment").alias("n_comments"), _head("code").alias("first_line"), _head("original_docstring").alias("said"))


@query(_values([("a.py", "Basket", "Store,list"), ("A.java", "A", "")], "path, identifier, bases"))
def e4_classes(spark, sf_dir):
    return corpus.raw(files(spark), level="class").select("path", "identifier", F.array_join(F.array_sort(F.map_keys("parameters")), ",").alias("bases"))


_INLINE = [
    ("a.py", "# start from nothing", "def total_price(items, rate: float = 0.2):", "total = 0", 13, 4, 13, 24),
    ("a.py", "# add the tax\n# to the sum", "total = 0", "if rate:", 17, 4, 18, 16),
    ("a.go", "// and the other", "func Add(a int, b int) int {", "y := b", 2, 1, 2, 17),
    ("a.rb", "# one more", "def count_words(text)", "end", 3, 11, 3, 21),
]


@query(_values(_INLINE, "path, original_comment, before, after, first_line, first_column, last_line, last_column"))
def e5_inline(spark, sf_dir):
    r = corpus.raw(files(spark), level="inline")
    place = [F.col(p).getItem(k).alias(n) for p, k, n in (("start_point", 0, "first_line"), ("start_point", 1, "first_column"), ("end_point", 0, "last_line"), ("end_point", 1, "last_column"))]
    return r.select("path", "original_comment", _head("prev_context.code").alias("before"), _head("next_context.code").alias("after"), *place)


_SAID = [
    ("a.py", "Sums the prices of all items.", "items,rate", "extra", "the price of all items together", "float", "ValueError"),
    ("A.java", "Adds two numbers to each other.", "a,b", "", "the sum of both numbers", None, None),
    ("a.js", "Joins the names.", "first,last", "", "both of the names together", "string", None),
    ("a.rb", "Counts the words of a text.", "text", "", None, None, None),
    ("a.rs", "Doubles the number given.", "n", "", None, None, None),
]


def documented_files(spark):
    r = corpus.raw(files(spark))
    return r.select("path", "language", parsed_docstring(F.col("original_docstring"), F.col("parameters"), F.col("language")).alias("s")).where("s.docstring is not null").select("path", "language", "s.*")


@query(_values(_SAID, "path, docstring, params, outliers, returns, return_type, raise_type"))
def e7_docstrings(spark, sf_dir):
    names = lambda c: F.array_join(F.array_sort(F.transform(f"docstring_params.{c}", lambda p: p["identifier"])), ",")
    first = lambda c, x: F.get(F.col(f"docstring_params.{c}"), F.lit(0))[x]
    return documented_files(spark).select("path", "docstring", names("params").alias("params"), names("outlier_params").alias("outliers"), first("returns", "docstring").alias("returns"), first("returns", "type").alias("return_type"), first("raises", "type").alias("raise_type"))


_PARTS = _values([("python", 1, 1, 5), ("java", 1, 1, 3), ("javascript", 1, 1, 3), ("ruby", 1, 0, 1), ("rust", 1, 0, 1)], "language, a, b, c")


@query(f"select language, cast(a as bigint) as n, cast(b as bigint) as with_parts, cast(c as bigint) as attributes from ({_PARTS})")
def a9_a10_documented(spark, sf_dir):
    return stats.documented(documented_files(spark), "language")


def _on_comments(name: str, step, want: list[str | None]) -> None:
    def run(spark, sf_dir):
        return spark.createDataFrame([(k, c) for k, c in enumerate(samples.COMMENTS, 1)], "id int, comment string").select("id", step(F.col("comment")).alias("text"))

    run.__name__ = name
    query(_values([(k, w) for k, w in enumerate(want, 1)], "id, text"))(run)


_SAME = dict(enumerate(samples.COMMENTS, 1))
_on_comments("t1_spans", clean.spans_dropped, list((_SAME | {6: "Returns the surface  of it.", 7: "\nPrints  the value of it ", 9: " Starts the engine ", 10: "\nLoads the file:"}).values()))
_on_comments("t6_ornaments", clean.ornaments_trimmed, list((_SAME | {2: " TODO: Why is he using Math.round?".strip(), 3: "public String transformTypeID(URI typeuri){", 7: "Prints {@code the value} of it (i.e. all of it)", 8: "first line here\nsecond line there", 9: "Starts the engine", 10: "=====\nLoads the file:"}).values()))
_on_comments("t14_noise", clean.noise_removed, ["将JSONArray转换为Bean的List, 默认为ArrayList */", "Why is he using Math.round?", "public String transformTypeID(URI typeuri){", "Do we need to show the upgrade wizard prompt? */", "This function is not in use */", "Returns the surface  of it.", "Prints  the value of it", "first line here\nsecond line there", "Starts the engine", "Loads the file.", "Sorts the list of names.", "Keeps this sentence. Is this one kept? And this one isn't.", "Returns &lt;b&gt; of <b>all</b> values there.", ""])
_on_comments("t21_literals", clean.cleaned, [None, None, None, None, "This function is not in use", "Returns the surface  of it.", "Prints  the value of it", "first line here\nsecond line there", "Starts the engine", "Loads the file.", "Sorts the list of names.", "Keeps this sentence. Is this one kept. And this one isn't.", "Returns <b> of all values there.", None])


@query(_values([(1,), (5,)], "id"))
def p33_pairs(spark, sf_dir):
    import pandas as pd

    def shares_a_word(docstrings, codes):
        return pd.Series([int(bool(set(T_WORD.findall(a)) & set(T_WORD.findall(b)))) for a, b in zip(docstrings, codes)], dtype="int32")

    return keep_by_model(spark.createDataFrame(samples.PAIRS, "id int, docstring string, code string"), shares_a_word).select("id")


@query(f"select doc_id, {_MATH} as math from {_TEXTS}")
def p8_math(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", P.about_math(F.col("text")).alias("math"))


@query(r"select p_partkey, list_transform(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(p_brand || p_type, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '([0-9])([A-Za-z])', '\1 \2', 'g'), '([A-Za-z])([0-9])', '\1 \2', 'g'), '[\s#_]+', ' ', 'g'), ' '), lambda x: x <> ''), lambda x: lower(x)) as parts from part")
def t16_identifier_parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.identifier_parts(F.regexp_replace(F.concat("p_brand", "p_type"), "#", " ")).alias("parts"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
