import os
import shutil
import subprocess
import sys

import corpus_pipeline
import pytest

from pulsegrid.llm import packing, queries
from pulsegrid.sources.scratch import cut
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute_print

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_have_their_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    schema, seen = docs.schema, [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, small), name)
        seen.append(docs)
        if name != "packing":
            assert [f.name for f in docs.schema] == [f.name for f in schema]
    raw, good, single, clean, mixed, packed = ({} if k == 5 else {r.doc_id: r for r in df.collect()} for k, df in enumerate(seen))
    good_rows = {r.doc_id: r.score for r in queries.op7_quality(spark, small).collect()}
    assert set(good) == {i for i, s in good_rows.items() if s >= 0.3} and set(single) < set(good) < set(raw)
    prints = [brute_print(r.text) for r in single.values()]
    assert all((a ^ b).bit_count() > 2 for k, a in enumerate(prints) for b in prints[:k])
    assert set(clean) == set(single) and all(len(r.text) <= len(single[i].text) and r.n_chars == len(r.text) for i, r in clean.items())
    assert set(mixed) <= set(clean) and all(set(r.text.split()) <= set(clean[i].text.split()) for i, r in mixed.items())
    check(seen[5].collect(), [(i, r.text) for i, r in mixed.items()], 1024)


def test_registered_pipeline(spark, small):
    rows = queries.llm_queries()["pipeline"](spark, small).collect()
    assert rows and max(r.offset + r.length for r in rows) <= 1024 and packing.END == 2


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_edge_rows_and_none(spark, edge, nothing, small, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for docs in (edge, nothing):
        out = stage(spark, docs, small)
        rows = out.collect()
        assert name == "packing" or out.columns == docs.columns
        assert rows or docs is nothing


def test_rest_works_without_the_subpackage(tmp_path):
    for part in os.listdir(ROOT):
        if part not in (".git", "tests", "corpus_pipeline.py") and os.path.isdir(os.path.join(ROOT, part)):
            shutil.copytree(os.path.join(ROOT, part), tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op') or n == 'pipeline']; print(len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert done.returncode == 0, done.stderr
