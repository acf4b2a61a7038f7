"""The pipeline's stages, one by one, against brute force on what each one keeps."""

from __future__ import annotations

import importlib
import subprocess
import sys

import numpy as np
import pytest
import public_tokenizers

import corpus_pipeline
from kinstar.llm import secrets, toxicity
from kinstar.llm.queries import ORACLE, QUERIES
from tests.compare import compare, duck
from tests.llm.cases import documents, nothing
from tests.llm.test_duplicates import brute_components
from tests.llm.test_scans import bare
from tests.llm.test_tokens import PATH, check_pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, con, name):
    result = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert result["ok"], result


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = stages["toxicity"](spark, docs, SF)
    assert clean.columns == docs.columns
    toxic = {r.doc_id for r in toxicity.severity(docs, model).where("is_toxic").collect()}
    rows = clean.collect()
    assert sorted(r.doc_id for r in rows) == sorted({r.doc_id for r in docs.collect()} - toxic)

    single = stages["near_duplicates"](spark, clean, SF)
    left = single.collect()
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in left) == sorted(i for i, _, _, kept in brute_components([(r.doc_id, r.text) for r in rows], 5, 80, 100) if kept)

    unseen = stages["decontamination"](spark, single, SF)
    items = [" ".join(bare(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in left if any(f" {t} " in f" {' '.join(bare(r.text))} " for t in items)}
    kept = unseen.collect()
    assert unseen.columns == docs.columns and {r.doc_id for r in left} - {r.doc_id for r in kept} == whole

    masked = stages["secrets"](spark, unseen, SF)
    field = secrets.train(unseen)
    texts = {r.doc_id: r.text for r in kept}
    final = masked.collect()
    assert masked.columns == docs.columns and masked.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    for r in final:
        assert r.text == secrets.mask(texts[r.doc_id], secrets.all_spans(texts[r.doc_id], field), "[SECRET]")
        assert r.n_chars == len(r.text) and secrets.base_spans(r.text) == []

    pieces = stages["packing"](spark, masked, SF).collect()
    check_pieces([p.asDict() for p in pieces], [(r.doc_id, r.text) for r in final], 1024)
    assert sorted({p.doc_id for p in corpus_pipeline.run(spark, SF).collect()}) == sorted(r.doc_id for r in final)


def test_stages_take_edge_cases(spark):
    for docs in (documents(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SF)
            rows = after.collect()
            if name != "packing":
                assert after.columns == docs.columns
        assert rows == [] or docs.count()


def test_columns_named_like_the_models_keep_their_values(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.selectExpr("*", "concat('KEEP', doc_id) AS grade", "doc_id AS is_toxic", "lang AS p_toxic", "source AS expected_severity")
    after = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert after.schema == docs.schema
    held = {r.doc_id: r for r in docs.collect()}
    rows = after.collect()
    assert 0 < len(rows) <= 60 and all(r == held[r.doc_id] for r in rows)


def test_entry_without_the_subpackage(tmp_path):
    """Without the llm folder and the pipeline module the other queries stay."""
    import shutil
    from pathlib import Path
    repo = Path(corpus_pipeline.__file__).parent
    shutil.copytree(repo / "kinstar", tmp_path / "kinstar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') and n[2].isdigit() for n in q) and 'pipeline' not in q; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
    assert importlib.util.find_spec("kinstar.llm") and np is not None and public_tokenizers.path("byte_bpe_50k.json") == PATH


def test_stages_hand_texts_to_python_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    texts = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    try:
        spark.conf.unset(name)
        corpus_pipeline.leaks_out(spark, texts, SF)
        held = [r["size"] for r in texts.mapInArrow(sizes, "size long").collect()]
        assert len(held) > 3 and max(held) < 1.1 * corpus_pipeline.BATCH_BYTES
        spark.conf.set(name, "9000000")  # a session's own setting stays
        corpus_pipeline.leaks_out(spark, texts, SF)
        assert spark.conf.get(name) == "9000000"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
