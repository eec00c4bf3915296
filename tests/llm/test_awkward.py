"""Every operator and stage takes nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import importlib

import pytest
from pyspark.sql import functions as F

from quire.llm import bpe, fingerprints, jaccard_join, licenses, lm_scores, mixing, quality_classifier, quality_rules, substring_dedup, suffix_dedup

OPERATORS = {
    1: lambda d, m: suffix_dedup.deduplicate(d),
    2: lambda d, m: bpe.round_trip(d, tokens=True, decoded=True),
    3: lambda d, m: mixing.taken(*mixing.mix(d)),
    4: lambda d, m: lm_scores.score_documents(d),
    5: lambda d, m: fingerprints.fingerprints(d),
    6: lambda d, m: quality_rules.apply_rules(d, m.where("quality = 1")),
    7: lambda d, m: quality_classifier.classify(d, m),
    8: lambda d, m: licenses.scan(d),
    9: lambda d, m: substring_dedup.deduplicate(d),
    10: lambda d, m: jaccard_join.jaccard_components(d),
}


@pytest.mark.parametrize("number", OPERATORS)
def test_rows_of_awkward_tables(awkward, marks, number):
    rows = OPERATORS[number](awkward, marks).collect()
    key = lambda x: (x is not None, x)
    assert sorted((r["doc_id"] for r in rows), key=key) == sorted((r["doc_id"] for r in awkward.collect()), key=key)


@pytest.mark.parametrize("number", OPERATORS)
def test_empty_tables(nothing, marks, number):
    assert OPERATORS[number](nothing, marks.limit(0)).collect() == []


@pytest.mark.parametrize("which", ["awkward", "nothing"])
def test_stages(request, spark, tmp_path, marks, which):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = request.getfixturevalue(which)
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema.names == docs.schema.names, name
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        assert out.count() == 0 if which == "nothing" else out.count() <= 2 * docs.count()
    assert pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_first_columns_are_the_contracts(awkward, marks):
    expected = {
        1: "doc_id n_bytes n_removed n_spans kept_sha256",
        2: "doc_id n_tokens ids_sha256 decoded_sha256",
        3: "doc_id size source_size target taken",
        4: "doc_id held_out n_tokens n_known train_tokens base_score score",
        5: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        6: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        7: "doc_id held_out score predicted",
        10: "doc_id n_shingles component_id",
    }
    kinds = {"doc_id": "bigint", "size": "bigint", "target": "double", "held_out": "boolean", "score": "double", "predicted": "int", "kept": "boolean", "base_failed": "boolean"}
    for number, names in expected.items():
        frame = OPERATORS[number](awkward.where("doc_id in (0, 9, 10)"), marks)
        assert set(names.split()) <= set(frame.columns)
        got = dict(frame.select(F.struct(*names.split()).alias("x")).select("x.*").dtypes)
        for name in names.split():
            want = kinds.get(name, "string" if "sha256" in name or "fingerprint" in name else "double" if name.startswith(("near", "base_s")) else "bigint")
            assert got[name] == want, (number, name)
