"""The pipeline's stages on a small table, each against a plain computation on its own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pvspark.llm import decontamination, mixing, quality, sharding, simhash

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    """Documents before each stage and after the last."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).toPandas())
        out.append(docs)
    return out


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_columns(inputs):
    for df in inputs[:-1]:
        assert df.columns == inputs[0].columns
    assert inputs[-1].columns == [*inputs[0].columns, "slot", "shard", "shard_name"]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_quality_keeps_what_scores_well(spark, inputs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    forest = quality.fit(inputs[0], labels)
    texts = {r.doc_id: r.text for r in inputs[0].collect()}
    import numpy as np

    good = {i for i, t in texts.items() if forest.score(np.array([quality.statistics(t)]))[0] >= 0.5}
    assert sorted(ids(inputs[1])) == sorted(good)


def test_one_document_of_each_group(inputs):
    fps = {r.doc_id: simhash.fingerprint(r.text) for r in inputs[1].collect()}
    left, kept = sorted(fps), []
    while left:
        group, front = {left[0]}, [left[0]]
        while front:
            x = front.pop()
            new = [y for y in left if y not in group and bin(fps[x] ^ fps[y]).count("1") <= 2]
            group.update(new)
            front.extend(new)
        kept.append(min(group))
        left = [x for x in left if x not in group]
    assert sorted(ids(inputs[2])) == sorted(kept)


def test_contaminated_documents_go(spark, inputs):
    import re

    def words(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    windows = set()
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} - {()}
    lengths = {len(w) for w in windows}
    clean = []
    for r in inputs[2].collect():
        w = words(r.text)
        hit = {k for n in lengths for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for k in range(i, i + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            clean.append(r.doc_id)
    assert sorted(ids(inputs[3])) == sorted(clean)


def test_mixing_repeats_rows_as_the_mix_takes_them(inputs):
    plan = {r.doc_id: r.n_passes for r in mixing.mix(inputs[3]).collect() if r.n_passes}
    assert Counter(ids(inputs[4])) == Counter(plan)


def test_every_row_has_its_shard(inputs):
    owners = sharding.slot_owners(corpus_pipeline.SHARDS)
    rows = inputs[5].collect()
    assert sorted(r.doc_id for r in rows) == sorted(ids(inputs[4]))
    assert all(owners[r.slot] == r.shard and r.shard_name == corpus_pipeline.SHARDS[r.shard] for r in rows)


def test_run_equals_the_stages(spark, inputs):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, inputs[5].collect()))


@pytest.mark.parametrize("number", range(5))
def test_a_stage_takes_odd_rows(spark, number):
    rows = [(1, None, None, None, None, 1), (None, "", "en", "a", 0, 2), (None, None, None, None, None, 3), (2, "x " * 30_000, "en", "b", 9, 4), (2, "x " * 30_000, "en", "b", 9, 4), (3, "a b c", "en", "a", 5, 5)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score INT")
    stage = corpus_pipeline.STAGES[number][1]
    out = stage(spark, docs, SF_DIR)
    assert out.columns[: len(docs.columns)] == docs.columns
    known = {tuple(r) for r in docs.collect()}
    assert {tuple(r)[: len(docs.columns)] for r in out.collect()} <= known
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0
