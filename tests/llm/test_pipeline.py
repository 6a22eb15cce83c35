"""corpus_pipeline: run() against a brute-force version, stage by stage, and odd tables."""

import collections

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sensorlab.llm import langid, mixing
from sensorlab.llm.storage import written
from tests.llm import helpers as h
from tests.llm.test_dedup import brute_exact, brute_jaccard


def stages(spark, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], h.SF), name))
    return out


@pytest.mark.parametrize("table", [h.documents, h.odd_documents])
def test_stages_against_brute_force(spark, table):
    docs = table(spark)
    start, lang, exact, near, mixed, coded = stages(spark, docs)
    for frame in (lang, exact, near, mixed):
        assert frame.columns == docs.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(lang) == sorted(r.doc_id for r in docs.collect() if any(x.isalpha() for x in r.text or ""))
    assert set(ids(exact)) == {r[0] for r in brute_exact(lang) if r[3]}
    assert set(ids(near)) == {r[0] for r in brute_jaccard(exact) if r[0] == r[2]}
    words = {r.doc_id: r for r in mixing.mix(near).collect()}
    times = collections.Counter(ids(mixed))
    for i, r in words.items():
        assert times[i] in ({0} if r.taken == 0 else {1, 2}) and (r.taken <= r.size or times[i] == 2)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in near.collect()}
    rows = coded.collect()
    assert collections.Counter(r.doc_id for r in rows) == times
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(text[r.doc_id], add_special_tokens=False).ids


def test_predicted_language_is_written(spark):
    docs = h.documents(spark)
    lang = corpus_pipeline.identify_language(spark, docs, h.SF)
    want = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert {r.doc_id: r.lang for r in lang.collect()} == {k: v for k, v in want.items() if v != "und"}


@pytest.mark.parametrize("label", [None, "und"])
def test_clean_documents_stay_without_labels(spark, label):
    docs = h.odd_documents(spark).withColumn("lang", F.lit(label).cast("string"))
    lang = corpus_pipeline.identify_language(spark, docs, h.SF).collect()
    assert sorted(r.doc_id for r in lang) == sorted(r.doc_id for r in docs.collect() if any(x.isalpha() for x in r.text or ""))
    assert {r.lang for r in lang} == {"und"}


def test_empty_table(spark):
    assert stages(spark, h.empty_documents(spark))[-1].collect() == []


def test_run(spark):
    assert corpus_pipeline.run(spark, h.SF).count() > 0
