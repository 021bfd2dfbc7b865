"""Every operator and stage on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest

import corpus_pipeline
from loomcorpus.llm import block_topk, decision_list, gru_lm, line_runs, lsh_forest, mixing, page_diff, rlz, sp_viterbi, weak_label

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
PARA = " ".join(f"passage{i}" for i in range(70))
ROWS = [
    (1, "a good plain text with some words in it.\nand a second line\nshared one\nshared two"),
    (2, "another text\nshared one\nshared two"),
    (2, "another text\nshared one\nshared two"),
    (3, ""),
    (4, None),
    (None, "no id here " + PARA),
    (None, None),
    (5, LONG),
    (6, LONG),
    (7, "   \n\t "),
    (8, PARA),
    (9, "▁ é中\U0001f600 \x00 ok"),
    (-3, "|" * 300),
]
CLASH = "__key_d __key_t __gone __text __p __copy __runs __depth __there __lines __rule __rank __words __n_chars d t i h r k n p u v root label tree whole sketch copy count w rate rule keep gone fp ids part b g score quality toxic host path c".split()
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASH)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), *["x"] * len(CLASH)) for i, t in ROWS], DOCS).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "x"), (2, 1, 0, None), (8, 0, 0, None), (9, 1, 1, None), (None, 1, 0, None), (3, None, None, None), (77, 0, 1, None)], "doc_id bigint, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


def key(v):
    return (v is not None, v)


def ids(df):
    return sorted([r["doc_id"] for r in df.select("doc_id").collect()], key=key)


ALL = sorted([i for i, _ in ROWS], key=key)


def test_lm(docs, nothing):
    out = {(r.doc_id, r.n_words): r for r in gru_lm.score_documents(docs).collect()}
    assert ids(gru_lm.score_documents(docs)) == ALL
    assert out[5, 60_000].log_likelihood == out[6, 60_000].log_likelihood < 0
    assert out[3, 0].log_likelihood == out[4, 0].log_likelihood == out[7, 0].log_likelihood < 0
    assert gru_lm.score_documents(nothing[0]).count() == 0


def test_mixing(docs, labels, nothing):
    out = mixing.mix(docs, labels)
    assert ids(out) == ALL and out.where("rate < 0 or rate is null").count() == 0
    assert ids(mixing.mix(docs, nothing[1])) == ALL
    assert mixing.mix(*nothing).count() == 0
    for df in (mixing.resample(docs, labels), mixing.resample(docs, nothing[1])):
        assert df.columns == docs.columns and set(ids(df)) <= set(ALL)
    assert mixing.resample(*nothing).count() == 0


def test_spans(docs, nothing):
    out = rlz.duplicate_spans(docs).collect()
    assert sorted([(r.doc_id, r.start_word, r.end_word, tuple(r.ref_doc_ids)) for r in out]) == [(6, 0, 60_000, (5,)), (8, 0, 70, (None,))]
    assert rlz.duplicate_spans(nothing[0]).count() == 0


def test_rules(docs, labels, nothing):
    assert ids(decision_list.judge(docs, labels)) == ALL
    assert decision_list.keep_good(docs, nothing[1]).collect() == docs.collect()
    assert decision_list.keep_good(*nothing).count() == 0
    assert decision_list.keep_good(docs, labels).columns == docs.columns


def test_weak_labels(docs, labels, nothing):
    assert ids(weak_label.classify(docs, labels)) == ALL
    assert ids(weak_label.classify(docs, nothing[1])) == ALL
    assert weak_label.classify(*nothing).count() == 0


def test_pages(spark):
    schema = "page_id bigint, url string, html string, host string, path string, chunk string, text string, k string"
    rows = [(1, "http://a.b/x/1", "<p>head</p><p>one</p>"), (2, "http://a.b/x/2", "<p>head</p><p>two</p>"), (2, "http://a.b/x/2", "<p>head</p><p>two</p>"), (3, None, None), (None, "http://c.d/", ""), (4, "http://e.f", "<p>" * 50_000 + "x"), (5, "::", "<b>a")]
    pages = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], schema)
    out = page_diff.page_texts(pages).collect()
    assert sorted([r.page_id for r in out], key=key) == sorted([r[0] for r in rows], key=key)
    said = {r.page_id: r for r in out}
    assert said[1].text == "one" and said[1].partner_id == 2 and said[4].text == "x" and said[3].text == ""
    assert [(r.text, r.partner_id) for r in out if r.page_id == 2] == [("two", 1)] * 2  # a copy is no partner
    assert page_diff.page_texts(spark.createDataFrame([], schema)).count() == 0


def test_search(spark, docs, nothing):
    asked = spark.createDataFrame([(1, "shared one", "x"), (1, "shared one", "x"), (2, "", None), (3, None, None), (None, "passage3 passage5", None)], "item_id bigint, text string, rank string")
    out = block_topk.search(asked, docs).collect()
    assert sorted([r.rank for r in out if r.item_id == 1]) == [1, 1, 2, 2, 3, 3]
    assert [r.doc_id for r in sorted(out, key=lambda r: r.rank) if r.item_id is None] == [8, None]
    assert block_topk.search(asked, nothing[0]).count() == block_topk.search(asked.limit(0), docs).count() == 0


def test_encode(docs, nothing):
    out = sp_viterbi.encode_documents(docs).collect()
    assert sorted([r.doc_id for r in out], key=key) == ALL
    for r in out:
        if r.doc_id == 4:
            assert r.ids is None and r.decoded is None and r.n_tokens == 0
    assert {r.decoded for r in out if r.doc_id in (5, 6)} == {LONG}
    assert sp_viterbi.encode_documents(nothing[0]).count() == 0


def test_near(docs, nothing):
    out = {(r.doc_id, r.keep_doc_id) for r in lsh_forest.near_duplicates(docs).collect()}
    assert (6, 5) in out and (8, None) in out and not any(x in (3, 4, 7) for p in out for x in p)
    kept = lsh_forest.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(ids(kept), key=key) == sorted([None, None, -3, 1, 2, 3, 4, 5, 7, 9], key=key)
    assert lsh_forest.drop_near_duplicates(nothing[0]).count() == lsh_forest.near_duplicates(nothing[0]).count() == 0


def test_lines(docs, nothing):
    out = line_runs.dedup_lines(docs)
    assert out.columns == docs.columns and ids(out) == ALL
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1].endswith("shared two") and texts[2] == "another text" and texts[4] is None
    assert line_runs.dedup_lines(nothing[0]).count() == line_runs.dedup_lines(nothing[0], report=True).count() == 0


def test_stages(spark, docs, labels, nothing, tmp_path):
    for name, d, l in (("some", docs, labels), ("none", *nothing)):
        l.select("doc_id", "quality", "toxic").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        now = d
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            now = stage(spark, now, f"{tmp_path}/{name}")
            if k < len(corpus_pipeline.STAGES) - 1:
                assert now.columns == d.columns
            now.write.parquet(f"{tmp_path}/{name}/{k}")
            now = spark.read.parquet(f"{tmp_path}/{name}/{k}")
        assert now.columns == ["doc_id", "n_tokens", "ids", "decoded"]
