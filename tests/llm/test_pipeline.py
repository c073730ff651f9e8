"""The registered queries and the pipeline's stages, each against its own input."""

import os
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from sftpipe.llm import exact_names, near_jaccard, quality_eb, queries, simhash_vp
from sftpipe.session import write_stage
from test_near_jaccard import classes

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


def test_all_are_registered():
    names = contract.LLM_QUERIES
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names and set(names) <= set(contract.queries())


def test_sql_twin(spark):
    name = "op10_exact_dedup"
    found = contract.queries()[name](spark, SF_DIR)
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    wanted = duck.execute(contract.oracle_sql()[name])
    assert [d[0] for d in wanted.description] == found.columns
    assert Counter(map(tuple, found.collect())) == Counter(wanted.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    at = {"documents": docs}
    previous = docs
    for name, stage in corpus_pipeline.STAGES:
        out = write_stage(stage(spark, previous, SF_DIR), name)
        at[name], before, previous = out, previous, out
        if name != "byte_bpe":
            assert out.schema == docs.schema
    ids = {name: Counter(r[0] for r in df.select("doc_id").collect()) for name, df in at.items()}

    labels = queries.quality_labels(spark, SF_DIR)
    kept = quality_eb.classify(docs, "doc_id", "text", "source", "lang", labels).filter("kept").select("doc_id")
    assert ids["quality_classifier"] == Counter(r[0] for r in kept.collect())

    last = {}
    for r in at["quality_classifier"].collect():
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert ids["exact_dedup"] == Counter(last.values())

    rows = sorted((r.doc_id, r.text) for r in at["exact_dedup"].collect())
    assert ids["near_dedup"] == Counter({rows[first][0] for first in classes([text for _, text in rows])})
    assert len(ids["near_dedup"]) < len(rows)

    before = {r.doc_id: len(r.text.split()) for r in at["near_dedup"].collect()}
    taken = Counter()
    for r in at["source_mixing"].collect():
        taken[r.doc_id] += len(r.text.split())
    assert set(taken) <= set(before) and all(n <= 2 * before[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(before.values())) < 20
    assert ids["byte_bpe"] == ids["source_mixing"]


def test_every_query_runs(spark):
    for name in contract.LLM_QUERIES:
        if name != "pipeline":
            assert contract.queries()[name](spark, SF_DIR).limit(1).count() == 1
    assert exact_names.BLOCK_BYTES == 4096


@pytest.mark.parametrize("sketches", [True, False])
def test_near_copies_by_op1_as_well(spark, monkeypatch, sketches):
    """The stage runs op1 over all texts: what its fingerprints link is compared, whatever sketches find."""
    words = [f"w{i * i % 997}" for i in range(3000)]
    text = lambda changed: " ".join([*words[:changed], "other", *words[changed + 1 :]])
    # A passage that repeats rules the fingerprint and is little of the set of shingles.
    unlike = [" ".join([f"p{i}" for i in range(13)] * 400 + [f"{c}{i}" for i in range(40)]) for c in "ab"]
    rows = [(1, text(50)), (2, text(1500)), (3, " ".join(words[:700])), (4, unlike[0]), (5, unlike[1]), (None, text(50)), (6, None)]
    for a, b in ((0, 1), (3, 4)):
        bits = simhash_vp.fingerprint(rows[a][1]) ^ simhash_vp.fingerprint(rows[b][1])
        assert bits.bit_count() <= simhash_vp.THRESHOLD
    assert classes([t or "" for _, t in rows]) == [0, 0, 2, 3, 4, 0, 6]
    if not sketches:
        monkeypatch.setattr(near_jaccard, "bucket_roots", lambda sigs: np.arange(len(sigs)))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR).collect()
    assert Counter(r.doc_id for r in kept) == Counter([1, 3, 4, 5, None, 6])
