"""The pipeline stage by stage and as a whole, and the registered queries on the smallest tables."""

import os
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from headwater.llm.queries import ORACLE, QUERIES
from tests.llm import test_rules, test_similar, test_spans
from tests.llm.conftest import key

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
COLUMNS = {
    "op1": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op2": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3": "doc_id size source_size target taken",
    "op4": "doc_id held_out score predicted",
    "op5": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6": "doc_id n_sentences n_removed text",
    "op7": "doc_id n_shingles component_id",
    "op8": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9": "doc_id n_tokens best_score",
    "op10": "doc_id held_out lang_pred score",
    "op11": "doc_id n_shingles component_id kept",
    "op12": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard", "sentence_spans", "source_mix", "tokens"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_cover_their_table(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = queries()[name](spark, SF_DIR)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(found.columns)
    if name.startswith("op12"):  # a search: see its own tests
        anchors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").where("vec_id % 50 = 0").count()
        assert 0 < found.select("anchor_id").distinct().count() <= anchors
        return
    ids = Counter(r.doc_id for r in found.select("doc_id").collect())
    assert ids == Counter(r.doc_id for r in docs.select("doc_id").collect())


def test_stages_on_edges(spark, docs, no_docs, tmp_path):
    for start in (docs, no_docs):
        rows = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF_DIR)
            path = str(tmp_path / f"{name}-{start is docs}")
            out.write.parquet(path)
            rows = spark.read.parquet(path)
            if name != "tokens":
                assert rows.columns == docs.columns
        assert rows.columns == ["doc_id", "n_tokens", "ids"]


def test_survivors_by_brute_force(spark, docs, edge_rows, no_labels, tmp_path):
    """The first three stages in their order: what each keeps of what the one before kept."""
    no_labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = [r for r in edge_rows if r[0] != 7]  # ties of an id are ordered by a hash
    found = docs.where("doc_id is null or doc_id <> 7")
    for name, stage in corpus_pipeline.STAGES[:3]:
        path = f"{tmp_path}/{name}"
        stage(spark, found, str(tmp_path)).write.parquet(path)
        found = spark.read.parquet(path)
        if name == "quality_rules":
            counts = [test_rules.brute(r[1]) for r in rows]
            rows = [r for r, c in zip(rows, counts) if r[1] is not None and c[0] >= 10 and 100 * c[4] <= 20 * c[0]]
        elif name == "ngram_jaccard":
            roots = test_similar.groups_of([test_similar.set_of(r[1], 5) for r in rows], (4, 5))
            firsts = {}
            for r, root in zip(rows, roots):
                firsts[root] = min(firsts.get(root, r), r, key=lambda x: key(x[:1]))
            rows = list(firsts.values())
        else:
            left = test_spans.brute(rows)
            cleaned = [(r, *left[r[0], r[1]]) for r in rows]
            rows = [(r[0], text) for r, text, n, removed in cleaned if removed < n or not n]
        assert sorted(key((r.doc_id, r.text)) for r in found.collect()) == sorted(key(r[:2]) for r in rows), name
    assert 10 < len(rows) < 40


def test_the_whole_run(spark):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    whole = 0
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.n_tokens
        whole += library.decode(ids, skip_special_tokens=False) == texts[r.doc_id]
    assert len({r.doc_id for r in found}) > 100 and whole > 0.8 * len(found)
    assert max(Counter(r.doc_id for r in found).values()) <= 3
