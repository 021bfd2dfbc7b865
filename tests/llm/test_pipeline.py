"""The pipeline stage by stage against brute-force versions on a small table."""

from collections import Counter

import corpus_pipeline
import numpy as np
import sentencepiece

from loomcorpus.llm import decision_list, mixing, sp_viterbi
from loomcorpus.llm.common import table

from .test_operators import brute_lines, jaccard_pairs


def test_stages_and_run(spark, sf_dir, tmp_path):
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents")
    steps = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs if not steps else steps[-1], sf_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        steps.append(spark.read.parquet(f"{tmp_path}/{k}"))
    rules, lines, near, mixed, encoded = steps
    assert all(s.columns == docs.columns for s in steps[:4])

    judged = {r.doc_id: r.keep for r in decision_list.judge(docs, labels).collect()}
    assert sorted(r.doc_id for r in rules.collect()) == sorted(i for i, keep in judged.items() if keep)

    want = brute_lines([(r.doc_id, r.text) for r in rules.orderBy("doc_id").collect()], 2)
    assert {r.doc_id: (r.text, r.n_chars) for r in lines.collect()} == {i: (t, len(t)) for i, t in want.items()}

    kept = {r.doc_id for r in near.collect()}
    pairs = jaccard_pairs(sorted(want.items()), 0.7)
    assert np.mean([not (a in kept and b in kept) for a, b in pairs]) >= 0.9
    alone = set(want) - {x for p in jaccard_pairs(sorted(want.items()), 0.3) for x in p}
    assert alone <= kept

    rates = {r.doc_id: r for r in mixing.mix(near, labels).collect()}
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= kept
    for i, r in rates.items():
        assert np.floor(r.rate) <= copies[i] <= np.ceil(r.rate + 1e-4) <= mixing.MAX_RATE + 1

    sp = sentencepiece.SentencePieceProcessor(model_file=sp_viterbi.MODEL)
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert Counter(r.doc_id for r in encoded.collect()) == copies
    assert all(list(r.ids) == sp.encode(texts[r.doc_id]) and r.decoded == texts[r.doc_id] for r in encoded.collect())

    whole = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert whole == Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect())
