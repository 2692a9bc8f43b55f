"""Every query and stage on nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
import edge_tables  # noqa: E402
from plaudit.llm.queries import QUERIES  # noqa: E402

DOCUMENT_QUERIES = [
    name for name in QUERIES
    if name not in ("op4_nearest", "op5_near_embeddings", "op12_filter_audit", "op13_spelling_variants")
]
CONTRACT = {
    "op1": ["doc_id", "held_out", "score", "predicted"], "op2": ["doc_id", "size", "source_size", "target", "taken"],
    "op3": ["doc_id", "n_bytes", "n_tokens", "over_limit"], "op4": ["query_id", "rank", "vec_id", "score"],
    "op5": ["vec_id", "n_links", "component_id", "kept"],
    "op6": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op7": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"],
    "op8": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9": ["doc_id", "n_shingles", "component_id", "kept"], "op10": ["doc_id", "held_out", "score", "predicted"],
    "op11": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op12": [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    ],
    "op13": ["word", "form", "root", "n", "n_near", "form_n"],
}


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    return edge_tables.write(spark, str(tmp_path_factory.mktemp("edge")))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return edge_tables.write(spark, str(tmp_path_factory.mktemp("empty")), empty=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    result = QUERIES[name](spark, empty)
    assert result.columns == CONTRACT[name.split("_")[0]] and result.count() == 0


@pytest.mark.parametrize("name", sorted(DOCUMENT_QUERIES))
def test_one_row_per_document(spark, edge, name):
    result = QUERIES[name](spark, edge)
    assert result.columns == CONTRACT[name.split("_")[0]]
    assert Counter(r.doc_id for r in result.collect()) == Counter(r[0] for r in edge_tables.rows())


def test_embeddings(spark, edge):
    links = {r.vec_id: r for r in QUERIES["op5_near_embeddings"](spark, edge).collect()}
    for alone in (201, 202, 203, 204, 205, 206, 207):
        assert (links[alone].n_links, links[alone].component_id, links[alone].kept) == (0, alone, True)
    assert links[200].n_links >= 1 and links[200].component_id == links[5].component_id
    assert links[None].component_id is None and not links[None].kept
    found = QUERIES["op4_nearest"](spark, edge).collect()
    assert {r.query_id for r in found} == {0, 50, 100, 200, 250}
    assert not {r.vec_id for r in found} & {None, 202, 203, 204, 205, 206, 207}
    assert all(sorted(r.rank for r in found if r.query_id == q) == [1, 2, 3, 4, 5] for q in (0, 50, 100, 200, 250))


@pytest.mark.parametrize("kind", ["edge", "empty"])
def test_stages(spark, request, kind, tmp_path):
    folder = request.getfixturevalue(kind)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES, 1):
        before = docs
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if number < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
        if kind == "empty":
            assert docs.count() == 0
        elif name == "near_copies":
            ids = [r.doc_id for r in docs.collect()]
            assert 106 not in ids and 105 not in ids and 104 in ids and None in ids
            assert max(Counter(i for i in ids if i is not None).values()) == 1
        elif name == "secrets":
            assert docs.count() == before.count()
            assert "abcdefgh1234" not in "".join(r.text or "" for r in docs.collect())
        elif name == "pieces":
            assert docs.columns == ["doc_id", "ids", "begins", "ends"] and docs.count() == before.count()


def test_run_gives_what_the_stages_give(spark, edge):
    assert corpus_pipeline.run(spark, edge).columns == ["doc_id", "ids", "begins", "ends"]
