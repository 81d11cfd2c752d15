"""The pipeline's stages, each on what the one before kept, against brute force."""

import zlib

import corpus_pipeline
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import test_decontamination
import test_line_dedup
import test_ngram_join
from edge_cases import SF_DIR, texts
from tokenizers import Tokenizer

from brooklet.llm import toxicity
from brooklet.llm.common import BATCH_BYTES, BYTES_SETTING, read_table
from brooklet.llm.queries import QUERIES
from brooklet.plans.inputs import scratch


def stages(spark, docs):
    """Rows of each stage, written and read as the pipeline does."""
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, f"test-{name}")
        stage(spark, out[-1], SF_DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def check(spark, docs):
    read, calm, lines, single, clean, packed = stages(spark, docs)
    for rows in (calm, lines, single, clean):
        assert rows.columns == docs.columns and rows.dtypes == docs.dtypes
    machine = toxicity.train(docs, read_table(spark, SF_DIR, "labels"))
    score = toxicity.Scorer(machine)
    key = lambda rows: sorted(rows, key=repr)
    wanted = [(d, t) for d, t in texts(read) if machine.score([score.positions(t)])[0] < 0.7]
    assert key(texts(calm)) == key(wanted)
    digests = [(d, h) for d, _, _, h in test_line_dedup.brute_force(texts(calm))]
    assert key((d, _sha(t)) for d, t in texts(lines)) == key(digests)
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    least = {d: c for d, _, c in test_ngram_join.brute_force(texts(lines))}
    assert key(texts(single)) == key((d, t) for d, t in texts(lines) if d is None or least[d] == d)
    items = [(r.item_id, r.text) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    leaked = {d for d, *_ in test_decontamination.brute_force(texts(single), items)}
    assert key(texts(clean)) == key((d, t) for d, t in texts(single) if d not in leaked)
    tokenizer, ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    for d, t in texts(clean):
        whole = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        for start in range(0, len(whole), 1024):
            part = whole[start : start + 1024]
            ids.append((d, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(whole)))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert key(map(tuple, packed.select(*names).collect())) == key(ids)


def _sha(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def test_documents(spark, documents):
    check(spark, documents)


def test_edge_rows(spark, edge):
    check(spark, edge)


def test_empty_table(spark, empty):
    assert [rows.count() for rows in stages(spark, empty)] == [0] * 6


def test_run_is_the_stages_one_after_another(spark, documents):
    rows = corpus_pipeline.run(spark, SF_DIR)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, rows.select(*names).collect())) == sorted(
        map(tuple, stages(spark, documents)[-1].select(*names).collect())
    )


@pytest.mark.parametrize(("before", "after"), [(None, BATCH_BYTES), ("1g", BATCH_BYTES), ("3m", 3 << 20)])
def test_stages_hand_texts_to_python_a_few_megabytes_at_a_time(spark, before, after):
    """Rows of 2 MB, one of 9 MB, all in one partition; each arrives, few of them together."""

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [int(batch["text"].str.len().sum())]})

    docs = spark.range(0, 12, 1, 1).selectExpr("id AS doc_id", "repeat('ab', IF(id = 5, 4500000, 1000000)) AS text")
    was = spark.conf.get(BYTES_SETTING)
    try:
        spark.conf.unset(BYTES_SETTING) if before is None else spark.conf.set(BYTES_SETTING, before)
        rows = corpus_pipeline.lean(lambda spark, docs, sf_dir: docs)(spark, docs, SF_DIR)
        got = [r.n for r in rows.mapInPandas(sizes, "n long").collect()]
    finally:
        spark.conf.set(BYTES_SETTING, was)
    assert sum(got) == 11 * 2_000_000 + 9_000_000
    assert sorted(got)[-2] <= after + 2_000_000 and max(got) <= after + 9_000_000
    assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered(name):
    from __spark_entry__ import oracle_sql, queries

    assert queries()[name] is QUERIES[name] and queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in oracle_sql()
