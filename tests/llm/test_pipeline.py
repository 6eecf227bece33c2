"""The pipeline's stages against plain Python, each on its own input."""

import collections

import pytest

pytest.importorskip("touchline.llm")

from conftest import SF_DIR  # noqa: E402
from llm import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from touchline.llm.common import stored  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
        out.append(docs)
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_and_sizes(steps):
    assert all(df.columns == steps[0].columns for df in steps[1:5])
    counts = [df.count() for df in steps]
    assert counts[0] > counts[1] > counts[2] >= counts[3] <= counts[4] == counts[5]


def test_quality_stage_keeps_clean_rows(spark, steps):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {i for i, _ in texts(steps[1])}
    good = [i for i, q in label.items() if q == 1]
    bad = [i for i, q in label.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good) and sum(i in kept for i in bad) <= 0.1 * len(bad)


def test_near_copy_stage(steps):
    heads = {i for i, _, c in brute.jaccard(texts(steps[1])) if i == c}
    assert collections.Counter(i for i, _ in texts(steps[2])) == collections.Counter(heads)


def test_decontamination_stage(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = [row[0] for row in brute.contamination(texts(steps[2]), items) if not row[-1]]
    assert collections.Counter(i for i, _ in texts(steps[3])) == collections.Counter(clean)


def test_mixing_stage_drops_nothing(steps):
    before, after = collections.Counter(texts(steps[3])), collections.Counter(texts(steps[4]))
    assert set(before) == set(after) and all(after[k] >= n for k, n in before.items())


def test_token_stage(steps):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    got = [tuple(r) for r in steps[5].select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    want = brute.tokens(texts(steps[4]), Tokenizer.from_file(path))
    assert sorted(got, key=lambda r: r[1]) == want


def test_empty_documents(spark, steps):
    docs = steps[0].limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
        assert docs.count() == 0
