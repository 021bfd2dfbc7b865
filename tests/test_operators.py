"""Splits, dedup, licences, statistics, sources, extraction, streams."""

import datetime

import pytest
from pyspark.sql import functions as F

from loomcorpus.operators import dedup, extract, licenses, splits, stats
from loomcorpus.operators.docstyles import extract_docstring, parse
from loomcorpus.plans import corpus
from loomcorpus.sources import tables
from loomcorpus.streaming import filters

PYTHON = '''
class Shape(Base):
    """A shape that can be drawn on a page."""

    def area_of(self, width: int, height=2):
        """Computes the area of the whole shape.

        Args:
            width (int): the width of the shape in points
            depth: not declared anywhere in here

        Returns:
            int: the area that was computed
        """
        # multiply them
        # both
        total = width * height
        print(total)
        return total

    def get_x(self):
        return 1
'''
JAVA = """
class A {
    /**
     * Adds two numbers to each other.
     * @param a the first of the numbers
     * @return the sum of both numbers
     */
    @Override
    public int add(int a, List<String> b) {
        // a comment } here
        String s = "}";
        int c = a + 1;
        return c;
    }
}
"""
OTHERS = {
    "go": "// Add adds the numbers.\nfunc Add(a int, b int) int {\n\tx := a\n\ty := b\n\tz := x + y\n\treturn z\n}\n",
    "rust": "/// Adds the numbers.\npub fn add(a: i32, b: i32) -> i32 {\n    let x = a;\n    let y = b;\n    let z = x + y;\n    z\n}\n",
    "ruby": "# Adds the numbers.\ndef add(a, b)\n  x = a\n  if x > 1\n    x += b\n  end\n  x\nend\n",
    "javascript": "/** Adds the numbers. */\nfunction add(a, b) {\n  const x = a;\n  const y = b;\n  const z = x + y;\n  return z;\n}\n",
    "php": "<?php\n/** Adds the numbers. */\nfunction add($a, $b) {\n  $x = $a;\n  $y = $b;\n  $z = $x + $y;\n  return $z;\n}\n",
    "c": "/* Adds the numbers. */\nint add(int a, int b) {\n  int x = a;\n  int y = b;\n  int z = x + y;\n  return z;\n}\n",
}


def test_python_records():
    (r,) = extract.records({"language": "Python", "code": PYTHON, "repo": "r", "path": "p"})
    assert r["identifier"] == "area_of" and r["parameters"] == {"self": None, "width": "int", "height": None}
    assert r["comment"] == ["# multiply them", "# both"] and "Computes" not in r["code_tokens"] and r["code"].startswith("def area_of")
    (c,) = extract.records({"language": "python", "code": PYTHON}, True)
    assert c["identifier"] == "Shape" and c["parameters"] == {"Base": None}
    (i,) = extract.inline_comments({"language": "python", "code": PYTHON})
    assert i["original_comment"] == "# multiply them\n# both" and i["next_context"]["code"].startswith("total =")
    assert extract.records({"language": "python", "code": "def broken("}) == []


def test_java_record():
    (r,) = extract.records({"language": "java", "code": JAVA})
    assert r["identifier"] == "add" and r["parameters"] == {"a": "int", "b": "List<String>"} and r["code"].endswith("return c;\n    }")
    assert r["original_docstring"].startswith("/**")


@pytest.mark.parametrize("language", list(OTHERS))
def test_other_languages(language):
    (r,) = extract.records({"language": language, "code": OTHERS[language]})
    assert r["identifier"].lower() == "add" and list(r["parameters"]) == ["a", "b"] and "Add" in r["original_docstring"]


def test_docstring_styles():
    out = extract_docstring(extract.records({"language": "python", "code": PYTHON})[0]["original_docstring"], {"width": "int"}, "python")
    assert out["docstring"].startswith("Computes the area") and out["docstring_params"]["params"][0]["docstring"].startswith("the width")
    assert out["docstring_params"]["outlier_params"][0]["identifier"] == "depth" and out["docstring_params"]["returns"][0]["type"] == "int"
    kinds = {
        "python": ["Does it.\n\n:param int x: the x\n:returns: the y\n:raises ValueError: if bad", "Does it.\n\nParameters\n----------\nx : int, optional\n    the x\n\nReturns\n-------\nint\n    the y\n\nRaises\n------\nValueError\n    if bad", "Does it.\n@param x: the x\n@return: the y\n@raise ValueError: if bad"],
        "java": ["Does it.\n@param x the x\n@return the y\n@throws ValueError if bad"],
        "javascript": ["Does it.\n@param {int} x - the x\n@returns {int} the y\n@throws {ValueError} if bad"],
        "c_sharp": ['<summary>Does it.</summary><param name="x">the x</param><returns>the y</returns><exception cref="ValueError">if bad</exception>'],
    }
    for language, samples in kinds.items():
        for text in samples:
            p = parse(text, language)
            assert p.description == "Does it." and [e.kind for e in p.entries] == ["param", "return", "raise"], text
            assert p.entries[0].name == "x" and p.entries[2].type == "ValueError"


def test_corpus_stages(spark, tmp_path):
    files = spark.createDataFrame([("r", "a.py", "python", "mit", PYTHON), ("r", "A.java", "java", "mit", JAVA), ("r", "x", "cobol", None, "x"), ("r", "y", "python", None, None)], "repo string, path string, language string, license string, code string")
    assert corpus.run(files, str(tmp_path / "f")) == {"raw": 2, "filtered": 2, "extracted": 2}
    assert corpus.run(files, str(tmp_path / "c"), level="class")["raw"] == 2  # Shape and A
    assert set(corpus.run(files, str(tmp_path / "i"), level="inline")) == {"raw", "filtered"}
    done = spark.read.json(str(tmp_path / "f/extracted"))
    meta = corpus.split_meta(corpus.merged(done)).collect()
    assert len(meta) == 2 and all(len(m["ID"]) == 64 for m in meta)
    assert stats.documented(done, "language").where("with_parts > 0").count() == 2


def test_splits_are_whole_and_disjoint(spark):
    df = spark.createDataFrame([(i, f"repo{i % 97}", i % 1000) for i in range(5000)], "id bigint, repo string, n bigint")
    out = splits.train_eval_test(df, "repo", "n", 500)
    assert out.count() == 5000 and out.groupBy("repo").agg(F.countDistinct("set_name").alias("k")).where("k > 1").count() == 0
    assert {r.set_name for r in out.select("set_name").distinct().collect()} == {"train", "eval", "test"}
    assert {r.set_name for r in splits.train_sizes(df, "repo", "n").select("set_name").distinct().collect()} <= {"small_train", "medium_train", "large_train"}
    assert splits.keep_first(df, "repo", ["id"]).agg(F.max("id")).first()[0] == 96


def test_dedup(spark):
    words = [f"w{i}" for i in range(60)]
    near = [*words[:58], "x", "y"]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, "one two three four five six"), (4, "too few"), (5, None)], "k bigint, text string")
    bench = spark.createDataFrame([(9, " ".join(words))], "k bigint, text string")
    a, b = (dedup.with_ngrams(x, "k", "text").withColumnRenamed("k", "id") for x in (df, bench))
    assert {r.id: len(r.grams) for r in a.collect()} == {1: 58, 2: 58, 3: 4, 4: 0, 5: 0}
    exact = {r.src: r.jaccard for r in dedup.overlap(a, b, 0.5).collect()}
    assert exact[1] == 1 and exact[2] == 56 / 60
    found = dedup.contaminated(a, b)
    assert [(r.tgt, r.src) for r in found.collect()] == [(9, [1, 2])]
    assert sorted(r.id for r in dedup.without(a, found).collect()) == [3, 4, 5]
    assert dedup.bands(128, 0.8) == (9, 13)
    rows = lambda x: x.select(F.col("k").alias("id"), F.split(F.coalesce("text", F.lit("")), " ").alias("words"))
    sign = lambda t: dedup.sha1_signature(t.split(" "))
    agree = {r.k: sum(x == y for x, y in zip(sign(r.text or ""), sign(" ".join(words)))) / 100 for r in df.collect()}
    for least in (0.85, 0.5):
        assert {r.src: r.score for r in dedup.similar_pairs(rows(df), rows(bench), least).collect()} == {k: s for k, s in agree.items() if s > least}
    assert agree[1] == 1 and agree[2] > 0.7 > 0.2 > agree[3]


def test_licences(spark):
    df = spark.createDataFrame([(1, ["MIT"], 10, 10), (2, ["GPL", "MIT"], 10, 10), (3, [], 1, 10), (4, None, 10, 10)], "id int, license array<string>, n_docstring_tokens int, n_code_tokens int")
    assert [r.id for r in licenses.keep_valid(df, licenses.conditions()).orderBy("id").collect()] == [1, 4]
    assert [r.id for r in licenses.invalid(df).orderBy("id").collect()] == [2, 4]
    assert [r.license for r in licenses.invalid_names(df).collect()] == ["GPL"]
    r = licenses.report(df, licenses.conditions()).first()
    assert (r.original, r.has_valid_license, r.valid_docstring_tokens_num, r.filtered, r.percent) == (4, 2, 3, 2, 50)


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"content": "x", "n": 1}\nnot json\n{"content": "y"}\n')
    assert tables.read_jsonl(spark, str(tmp_path / "a.jsonl"), "content string, n int").select("content", "n").count() == 3 - 1
    kept = tables.read_jsonl(spark, str(tmp_path / "a.jsonl"), "content string, n int", "keep").cache()
    assert kept.count() == 3 and kept.where("_corrupt_record is not null").count() == 1
    with pytest.raises(ValueError):
        tables.read_jsonl(spark, "x.csv", "a int")
    with pytest.raises(KeyError):
        tables.project(kept, {"code": "content"})
    (tmp_path / "m.yaml").write_text("code: content # main\nrepo: 'r'\n")
    assert tables.read_mapping(str(tmp_path / "m.yaml")) == {"code": "content", "repo": "r"}
    df = spark.createDataFrame([(1, "train"), (2, "test")], "id int, set_name string")
    tables.write_sets(df, str(tmp_path / "sets"))
    assert spark.read.json(str(tmp_path / "sets/set_name=test")).first().id == 2
    tables.write_csv(df, str(tmp_path / "csv"))
    assert tables.read_csv(spark, str(tmp_path / "csv"), "id int, set_name string").count() == 2
    tables.write_if_absent(df.limit(0), str(tmp_path / "csv"))
    assert tables.read_csv(spark, str(tmp_path / "csv"), "id int, set_name string").count() == 2


def test_more_sources_and_sinks(spark, tmp_path):
    raw = spark.createDataFrame([("f()", "r", "p", "go", "f", None, ["f"], "// f", None)], "code string, repo string, path string, language string, identifier string, parameters map<string,string>, code_tokens array<string>, original_docstring string, comment array<string>")
    assert tables.project(raw, tables.MAPPINGS["records"]).collect() == raw.collect()
    with pytest.raises(KeyError):
        tables.project(raw, tables.MAPPINGS["stack"])
    at = tables.write_same_name(raw.select("repo"), "/data/in/part_3.jsonl", str(tmp_path / "kept"))
    assert at == str(tmp_path / "kept/part_3.jsonl") and spark.read.json(at).first().repo == "r"
    bench = spark.createDataFrame([(None, "T/1", "says it", "def f():\n", "  return 1"), ("a", "T/2", None, "x", None)], "id string, task_id string, docstring string, declaration string, canonical_solution string")
    assert [tuple(r) for r in tables.flatten_benchmark(bench).collect()] == [("T/1", "says it", "def f():\n  return 1"), ("a", None, None)]
    tables.write_report(spark.range(3), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 3
    raw.write.parquet(str(tmp_path / "t"))
    assert tables.read_parquet(spark, str(tmp_path / "t"), "go").count() == 1 and tables.read_parquet(spark, str(tmp_path / "t"), "c").count() == 0


def test_finished_records(spark):
    files = spark.createDataFrame([("r", "a.py", "python", "mit", PYTHON)], "repo string, path string, language string, license string, code string")
    done = corpus.extracted(corpus.filtered(corpus.raw(files)))
    corpus.check_schema(done)
    assert corpus.valid(done).count() == done.count() == 1
    assert corpus.valid(done.withColumn("code", F.lit(""))).count() == corpus.valid(done.withColumn("repo", F.lit(None).cast("string"))).count() == 0
    for broken in (done.drop("license"), done.withColumn("parameters", F.lit("x"))):
        with pytest.raises(TypeError):
            corpus.check_schema(broken)


def test_one_licence(spark):
    from loomcorpus.functions import predicates as P

    df = spark.createDataFrame([("MIT",), ("GPL",), (None,)], "l string")
    assert [r[0] for r in df.select(P.licensed_by_one(F.col("l"))).collect()] == [True, False, False]
    assert [r[0] for r in df.select(P.specific_pattern(F.col("l"))).collect()] == [False, False, None]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"id": 1, "text": "Adds two numbers together nicely."}\n{"id": 2, "text": "no"}\n{"id": 3, "text": "caf\\u00e9 au lait now"}\n')
    stream = filters.keep_clean(filters.read(spark, str(tmp_path / "in"), "id int, text string"), "text")
    filters.write(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert [r.id for r in spark.read.json(str(tmp_path / "out")).collect()] == [1]
    rows = spark.createDataFrame([(datetime.datetime(2024, 1, 1), "a")], "t timestamp, k string")
    assert filters.count_by(rows, "t", "k", "1 hour", "1 hour").first()["count"] == 1


def test_signature_is_the_least_of_all_bits():
    """By plain integers, with quotes and signs in the words; hashes that share their first 64 bits, and none."""
    import hashlib

    import numpy as np

    from loomcorpus.operators import dedup

    def plain(words):
        hashed = [int(hashlib.sha1(str(tuple(words[i : i + 3])).encode()).hexdigest(), 16) for i in range(len(words))]
        return [min((h ^ int(hashlib.sha1(str(i).encode()).hexdigest(), 16) for h in hashed), default=2**160 - 1).to_bytes(20, "big") for i in range(100)]

    for words in ([], ["a"], ["a", "'"], ["'", '"', "\\"], ["é", "\x85", "b", "'", "b"], [str(i * i % 977) for i in range(3000)]):
        assert dedup.sha1_signature(words) == plain(words)
    rng = np.random.default_rng(3)
    hashed, seeds = rng.integers(0, 256, (40, 20), np.uint8), rng.integers(0, 256, (9, 20), np.uint8)
    hashed[::2, :8] = hashed[0, :8]
    big = lambda x: int.from_bytes(x.tobytes(), "big")
    assert dedup._least_mixed(hashed, seeds) == [min(big(h) ^ big(x) for h in hashed).to_bytes(20, "big") for x in seeds]


def test_ngrams_of_texts_are_those_of_columns(spark):
    """White space and signs beyond ASCII, null, and fewer words than needed; signatures of texts are those of their tokens."""
    from pyspark.sql import functions as F

    from loomcorpus.functions.tokens import tokens
    from loomcorpus.operators import dedup

    texts = [None, "", "a b c d", "a b c d e", "A b, A b. a B, a b", "\u0130x \u00c4\u00a0b\x1cc d\u2003e_f \U0001f600 g", "x\x0by\fz\r1\t2\n3", "caf\u00e9 au lait du matin"] + ["w%d v u" % (k % 7) * (k % 50) for k in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "k bigint, text string").coalesce(1)
    words = tokens(F.lower(F.coalesce("text", F.lit(""))))
    for n in (2, 3, 6):
        got = {r.k: r.grams for r in dedup.with_ngrams(df, "k", "text", n).collect()}
        assert got == {r.k: r.grams for r in df.select("k", dedup.ngrams(words, n).alias("grams")).collect()} and len(got) == len(texts)
    a, b = dedup.sha1_signatures(F.col("text")), dedup.sha1_signatures(tokens(F.col("text")))
    assert df.where("k < 20").select(a.alias("a"), b.alias("b")).where("a != b").count() == 0
    plan = dedup.with_ngrams(df, "k", "text")._jdf.queryExecution().toString()
    assert "lambda" not in plan
    assert "regexp_extract_all" not in dedup.similar_pairs(*[df.select(F.col("k").alias("id"), "text")] * 2)._jdf.queryExecution().toString()


def test_signatures_of_many_rows_are_those_of_each(spark):
    from pyspark.sql import functions as F

    from loomcorpus.operators import dedup

    rows = [(k, [f"{k % 5} {i}" for i in range(n)]) for k, n in enumerate([0, 1, 40_000, 3, 0, 20_000, 20_000, 5, 7])]
    df = spark.createDataFrame(rows, "k int, grams array<string>")
    sign = dedup.signature(F.col("grams"), 4)
    got = {r.k: r.s for r in df.coalesce(1).select("k", sign.alias("s")).collect()}
    assert got == {r.k: r.s for r in df.repartition(9, "k").select("k", sign.alias("s")).collect()} and [len(got[k]) for k in range(9)] == [0, 4, 4, 4, 0, 4, 4, 4, 4]
