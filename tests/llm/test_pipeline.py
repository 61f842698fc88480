"""The pipeline's stages against the operators' own results."""

from collections import Counter

import corpus_pipeline as P
from equiframe.llm import decontam, jaccard, mixing, quality
from equiframe.llm.shared import stored

SF = "/root/testdata/sf0.01"


def test_stages(spark, documents):
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "source_mix", "token_output"]
    docs = documents
    want = {r.doc_id for r in quality.score(docs).filter("kept").collect()}
    for name, stage in P.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == documents.columns
        ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
        if name == "near_duplicates":
            want = {r.component_id for r in jaccard.join(before).collect()}
        if name == "decontamination":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            want = {r.doc_id for r in decontam.search(before, bench).filter("n_hit = 0").collect()}
        if name == "source_mix":
            assert ids == Counter({r.doc_id: r.copies for r in mixing.mix(before).collect() if r.copies})
        else:
            assert ids == Counter(want) and want
    out = P.run(spark, SF).collect()
    assert Counter(r.doc_id for r in out) == ids
    place = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens


def test_stages_on_odd_rows(spark, edge, empty):
    for docs in (edge, empty):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            assert name == "token_output" or out.columns == docs.columns
            assert docs is edge or rows == []
