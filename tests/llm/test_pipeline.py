"""The corpus pipeline against its stages' plain versions, one after the other."""

from tokenizers import Tokenizer

import brute
import corpus_pipeline
from conftest import SF_SMALL
from quarry.llm import bpe, toxicity
from quarry.llm.queries import learned_ids
from quarry.llm.store import read_table


def test_pipeline(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    machine = toxicity.fit(docs, read_table(spark, SF_SMALL, "labels"), learned_ids)
    toxic = {r.doc_id for r in toxicity.score(docs, machine).where("score >= 0.5").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in toxic}
    texts = {i: t for i, (t, _) in brute.line_dedup(texts).items()}
    _, label = brute.near(texts, 5)
    texts = {i: t for i, t in texts.items() if label[i] == i}
    items = {r.item_id: r.text for r in read_table(spark, SF_SMALL, "benchmark").collect()}
    bad = {i for i, _ in brute.leaks({i: t for i, t in texts.items() if len(t) < 4000}, items)}
    lib = Tokenizer.from_file(bpe.default_path())
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert not bad & got.keys()
    assert {i for i, t in texts.items() if len(t) < 4000} - bad == {i for i in got if len(texts[i]) < 4000}
    assert all(got[i] == lib.encode(texts[i], add_special_tokens=False).ids for i in got)


def test_stages_keep_columns_and_odd_rows(spark):
    rows = [(1, "a b c " * 9, "en", "s", 54, "x"), (1, "a b c " * 9, "en", "s", 54, "x"), (2, None, None, None, None, None),
            (3, "", "en", "s", 0, None), (None, "text without id", "en", "s", 15, "y"), (4, "a b c " * 9, "en", "s", 54, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, copy_id string")
    for name, stage in corpus_pipeline.STAGES:
        for d in (docs, docs.where("false")):
            out = stage(spark, d, SF_SMALL)
            n = out.count()
            assert n == 0 if d is not docs else n >= 4
            if name != "encoding":
                assert out.columns == docs.columns
