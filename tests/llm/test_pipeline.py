"""The pipeline, stage by stage, against plain-Python twins."""

import os
import shutil
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import SF, components_by_hand, documents, messy, none_of
from test_secret_scan import base_by_hand
from test_tokens_packing import check_packed, ids_of
from tokenizers import Tokenizer

import corpus_pipeline
from envflow.llm import decontaminate, secret_scan

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_are_as_asked():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scans", "best_fit_packing"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, f in corpus_pipeline.STAGES:
        rows = f(spark, out[-1], SF)
        out.append(spark.createDataFrame(rows.collect(), rows.schema))
    return out


def test_stages_against_plain_ones(spark, stages):
    first, langs, alone, clean, masked, packed = stages
    docs = documents()
    # every document here has a language
    assert {r.doc_id for r in langs.collect()} == set(docs)
    want = {i for i, (_, c) in components_by_hand(docs).items() if i == c}
    assert {r.doc_id for r in alone.collect()} == want
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert clean.count() == len(want)
    assert decontaminate.contamination(alone, bench).where("contaminated").count() > 0
    hits = {r.doc_id for r in decontaminate.contamination(alone, bench).where("contaminated").collect()}
    assert all((r.text != docs[r.doc_id]) == (r.doc_id in hits) for r in clean.collect())
    assert not any(base_by_hand(r.text) for r in masked.collect())
    changed = {r.doc_id for r in secret_scan.scan_secrets(clean).where("spans <> ''").collect()}
    before = {r.doc_id: r.text for r in clean.collect()}
    assert all((r.text != before[r.doc_id]) == (r.doc_id in changed) for r in masked.collect())
    for df in stages[1:5]:
        assert df.columns == first.columns and [f.dataType for f in df.schema] == [f.dataType for f in first.schema]
        assert all(r.n_chars == len(r.text) for r in df.collect())
    texts = {r.doc_id: r.text for r in masked.collect()}
    check_packed(packed.collect(), {i: [*x, 0] for i, x in zip(texts, ids_of(texts.values()))}, 2048)


def test_run_gives_the_same_pieces(spark, stages):
    def pieces(df):
        return sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())

    assert pieces(corpus_pipeline.run(spark, SF)) == pieces(stages[-1])


def test_messy_rows_go_through_every_stage(spark):
    docs = messy(spark)
    for name, f in corpus_pipeline.STAGES[:-1]:
        rows = f(spark, docs, SF)
        assert rows.columns == docs.columns, name
        docs = spark.createDataFrame(rows.collect(), rows.schema)
    # without letters: 3, 4, 5, 9 and a null text; 2 is a copy of 1, and so is a repeated 1
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 1, 6, 7, 8]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    for r in docs.collect():
        ids = np.asarray([*tok.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        if len(ids) <= 2048:
            assert zlib.crc32(ids.tobytes()) in {x.ids_crc32 for x in got if x.doc_id == r.doc_id}
    empty = none_of(messy(spark))
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, empty, SF).count() == 0, name


def test_the_rest_works_without_these_folders(tmp_path):
    """What the guard in the entry module is for."""
    for x in ("envflow", "__spark_entry__.py", "corpus_pipeline.py"):
        src = os.path.join(ROOT, x)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(src, tmp_path / x)
    ask = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(k[:2] == 'op' or k == 'pipeline' for k in q))"

    def told():
        env = os.environ | {"PYTHONPATH": ""}
        return subprocess.run([sys.executable, "-B", "-c", ask], cwd=tmp_path, env=env, capture_output=True, text=True, check=True).stdout.split()

    every, ours = map(int, told())
    assert ours == 11
    os.remove(tmp_path / "corpus_pipeline.py")
    assert list(map(int, told())) == [every - 1, 10]
    shutil.rmtree(tmp_path / "envflow" / "llm")
    assert list(map(int, told())) == [every - 11, 0]
