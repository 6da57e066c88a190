import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_models import rules
from test_neardup import by_force

import corpus_pipeline
from loanmill.llm import quality
from loanmill.llm.common import fold

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input of every stage and what the last returns, as rows."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        seen.append(docs.collect())
        rows = stage(spark, docs, SF)
        if number < len(corpus_pipeline.STAGES):
            assert rows.columns == columns
        docs = spark.createDataFrame(rows.collect(), rows.schema)
    return [*seen, docs.collect()]


def by_id(rows):
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r for r in rows}


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "MinHash near-dedup",
        "benchmark decontamination",
        "secret scans",
        "byte-level BPE encoding and decoding",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_stage(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels, fold("doc_id", 5) != 0)).collect()
    assert {r.doc_id for r in stages[1]} == {r.doc_id for r in scored if r.score >= 0.3}


def test_near_dedup_stage(stages):
    want = by_force([(r.doc_id, r.text) for r in stages[1]], 5, 80)
    assert {r.doc_id for r in stages[2]} == {i for i, v in want.items() if v[2]}


def test_decontamination_stage(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r.doc_id for r in stages[2] if any(i in r.text for i in items)}
    left = {r.doc_id for r in stages[3]}
    assert held and not held & left and len(stages[2]) - len(stages[3]) <= 2 * len(held)


def test_secrets_stage(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(before) == set(after)
    for doc_id, row in after.items():
        assert not rules(row.text) and row.n_chars == len(row.text)
        if "[SECRET]" not in row.text:
            assert row == before[doc_id]


def test_encoding_stage(stages):
    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = by_id(stages[4])
    assert set(texts) == {r.doc_id for r in stages[5]}
    for r in stages[5]:
        want = library.encode_ordinary(texts[r.doc_id].text)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want) and r.round_trip


def test_run_gives_the_same_rows(spark, stages):
    got = {r.doc_id: bytes(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {r.doc_id: bytes(r.ids) for r in stages[5]}


def test_edge_rows(spark, edge_rows):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in edge_rows if i is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() <= len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0
