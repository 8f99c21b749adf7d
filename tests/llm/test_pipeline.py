"""The pipeline's stages on rows with known faults, and the registered queries."""

import duckdb
import pytest
from conftest import *  # noqa: F403
from test_classifiers import BAD, LABELS, corpus

import corpus_pipeline
from kerbside.llm import queries, simhash
from kerbside.llm.common import staged

CONTRACT = {
    "op1_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op2_web_archives": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op3_quality": {"doc_id", "expected_grade", "selected"},
    "op4_fingerprints": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op5_simhash": {"doc_id", "fingerprint", "component_id"},
    "op6_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op7_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op8_maxent": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op9_pieces": {"doc_id", "n_pieces", "pieces", "scores", "decodes"},
    "op10_nearest": {"query_id", "rank", "vec_id", "score"},
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with toxic, junk and copied texts, odd rows among them, and their labels."""
    rows, labels = corpus(400, seed=9_000)
    rows += [(1000 + i, rows[i][1], "t") for i in range(20)]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = [document(*r) for r in rows] + [(r[0] and r[0] + 5000, *r[1:]) for r in odd_rows()]  # noqa: F405
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")  # noqa: F405
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path, {i: (q, t) for i, q, t, *_ in labels}


def test_stages(spark, folder):
    path, truth = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, path), name)
        assert docs.columns == columns
        kept[name] = docs.collect()
    ids = {name: {r.doc_id for r in rows} for name, rows in kept.items()}
    clean = {i for i, (q, t) in truth.items() if q and not t}
    assert not any(any(b.lower() in (r.text or "").lower() for b in BAD) for r in kept["toxicity"])
    assert len(clean - ids["toxicity"]) <= 2 and {5002, 5003, 5006} <= ids["toxicity"]
    junk = {i for i, (q, _) in truth.items() if not q}
    assert len(junk & ids["quality"]) <= 0.05 * len(junk) + 1 and len(clean - ids["quality"]) <= 0.03 * len(clean)
    # Of exact copies the one with the smallest id stays, and no two texts with close fingerprints are left.
    assert not {i + 1000 for i in range(20) if i in ids["quality"]} & ids["near_duplicates"]
    fps = [simhash.fingerprint(r.text) for r in kept["near_duplicates"]]
    assert all((a ^ b).bit_count() > 2 for n, a in enumerate(fps) for b in fps[:n])
    assert ids["mixing"] <= ids["near_duplicates"]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert len(last) == len(kept["mixing"]) and all(r.decodes for r in last)


def test_run_without_labels_or_rows(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")  # noqa: F405
    spark.createDataFrame([], LABELS).write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []


@pytest.mark.parametrize("name", list(CONTRACT))
def test_registered(spark, sf, name):
    found = queries.QUERIES[name](spark, sf)
    assert CONTRACT[name] <= set(found.columns)
    rows = found.toPandas()
    assert len(rows)
    if name in queries.ORACLES:
        connection = duckdb.connect()
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
        expected = connection.execute(queries.ORACLES[name]).df()
        columns = sorted(expected.columns)
        left, right = (f[columns].sort_values(columns).reset_index(drop=True) for f in (rows, expected))
        assert left.equals(right)


def test_all_are_registered():
    import __spark_entry__ as contract

    assert set(CONTRACT) == set(queries.QUERIES)
    assert {*CONTRACT, "pipeline"} <= set(contract.queries())
