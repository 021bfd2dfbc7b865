"""Every query that has SQL gives the rows that DuckDB gives; the rest gives rows."""

import math

import duckdb
import pytest

import __spark_entry__
from loomcorpus.plans import queries as own

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows(found):
    plain = lambda v: None if v is None else f"{float(v):.9g}" if isinstance(v, (int, float)) and not (isinstance(v, float) and math.isnan(v)) else str(v)
    return sorted([tuple(plain(v) for v in r) for r in found], key=str)


@pytest.mark.parametrize("name", list(own.oracle_sql()))
def test_query(spark, sf_dir, duck, name):
    got = own.queries()[name](spark, sf_dir)
    assert rows(got.collect()) == rows(duck.execute(f"select {', '.join(got.columns)} from ({own.oracle_sql()[name]})").fetchall())


RULES = [k for k in own.queries() if k.startswith("p") and k not in ("p19_p21_names", "p33_model_filter", "p33_pairs", "p8_math")]


@pytest.mark.parametrize("name", RULES)
def test_rules_reject_some_and_keep_some(spark, sf_dir, name):
    assert {r.rejected for r in own.queries()[name](spark, sf_dir).select("rejected").distinct().collect()} == {True, False}


@pytest.mark.parametrize("name", [k for k in own.queries() if k in ("t2_bracketed_links", "t4_rulers", "t5_framed_lines", "t7_leading_name", "t8_afterthoughts", "t9_after_url", "t11_plain_characters", "t12_formats", "t13_close")])
def test_steps_change_some_and_leave_some(spark, sf_dir, name):
    before = {r.doc_id: r.text.strip() for r in own.texts(spark, sf_dir).collect()}
    after = {r.doc_id: r.text.strip() for r in own.queries()[name](spark, sf_dir).collect()}
    assert 0 < sum(before[i] != after[i] for i in after) < len(after)


def test_cleaned_documents_are_those_of_plain_python(spark, sf_dir):
    from loomcorpus.operators import clean

    texts = {r.doc_id: r.text for r in own.table(spark, sf_dir, "documents").collect()}
    assert {r.doc_id: r.docstring for r in own.t21_clean(spark, sf_dir).collect()} == {i: clean.clean_docstring(t) for i, t in texts.items()}
    pages = {r.page_id: r.html for r in own.table(spark, sf_dir, "pages").collect()}
    assert {r.page_id: r.text for r in own.t10_html_text(spark, sf_dir).collect()} == {i: clean.html_text(t) for i, t in pages.items()}


def test_signatures_are_those_of_brute_force(spark, sf_dir):
    """Every document with every benchmark item, by plain integers of 160 bits."""
    import hashlib
    import re

    seeds = [int(hashlib.sha1(str(i).encode()).hexdigest(), 16) for i in range(100)]

    def sign(text):
        words = re.findall(r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]", text)
        hashed = [int(hashlib.sha1(str(tuple(words[i : i + 3])).encode()).hexdigest(), 16) for i in range(len(words))]
        return [min((h ^ s for h in hashed), default=2**160 - 1) for s in seeds]

    docs = {r.doc_id: r.text for r in own.table(spark, sf_dir, "documents").where("length(text) < 3000").collect()}
    items = {r.item_id: sign(r.text) for r in own.table(spark, sf_dir, "benchmark").collect()}
    want = {(i, j): s for i, t in docs.items() for a in [sign(t)] for j, b in items.items() if (s := sum(x == y for x, y in zip(a, b)) / 100) > 0.1}
    assert {(r.src, r.tgt): r.score for r in own.j3_signatures(spark, sf_dir).collect() if r.src in docs} == want and want


def test_banded_join_finds_what_the_exact_join_does(spark):
    from loomcorpus.operators import dedup

    sf = "/root/testdata/sf0.1"
    exact = {(r.src, r.tgt) for r in own.j8_jaccard(spark, sf).where("jaccard >= 0.3").collect()}
    found = {(s, r.tgt) for r in own.j8_lsh(spark, sf).collect() for s in r.src}
    assert len(exact) > 10 and len(exact & found) / len(exact) >= 0.9
    assert dedup.bands_for_recall(0.3, 0.95) == (32, 2)


def test_model_filter_learns_its_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = own.table(spark, sf, "labels")
    kept = {r.doc_id for r in own.p33_model_filter(spark, sf).collect()}
    said = [(r.doc_id in kept, r.quality) for r in labels.where("quality is not null").collect()]
    assert sum(k == bool(q) for k, q in said) / len(said) > 0.9


def test_literal_files_take_one_task_and_no_table(spark):
    found = own.e7_docstrings(spark, "/nowhere")
    assert found.rdd.getNumPartitions() == 1 and found.count() == 5


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["lang", "kept", "rejected"]
