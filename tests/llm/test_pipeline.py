"""Stages of the pipeline against brute force, and the entry without the subpackage."""

import os
import shutil
import subprocess
import sys

import corpus_pipeline
from navloom.llm import toxicity
from navloom.llm.common import table
from test_dedup import components_by_brute_force, kept_by_brute_force
from test_mixing_packing import poisson

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        rows = out.collect()
        if name != "packing":
            assert out.columns == columns and all(r == before[r.doc_id] for r in rows)
        ids, pairs = sorted(r.doc_id for r in rows), [(i, r.text) for i, r in before.items()]
        if name == "toxicity":
            scored = toxicity.score_toxicity(docs, model).collect()
            assert ids == sorted(r.row.doc_id for r in scored if r.score < 0.5) and len(ids) < len(before)
        if name == "exact_dedup":
            assert ids == sorted({k for k, _ in kept_by_brute_force(pairs).values()})
        if name == "jaccard_join":
            assert ids == sorted({c for _, c in components_by_brute_force(pairs, 5, 80).values()})
        if name == "mixing":
            from navloom.llm.mixing import source_rates

            rates = {r.source: r.rate for r in source_rates(docs).collect()}
            assert ids == sorted(i for i, r in before.items() for _ in range(poisson(17, i, rates[r.source])))
        if name == "packing":
            assert ids == mixed
        mixed, docs = ids, out
        before = {r.doc_id: r for r in rows}


def test_run_gives_the_rows_of_the_stages(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_entry_without_the_subpackage(tmp_path):
    """The rest imports and lists its queries when the subpackage and the pipeline are gone; other import errors are raised."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 200 and 'pipeline' not in q and not any(n.startswith('op') for n in q), len(q)"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=120)
    done = run()
    assert done.returncode == 0, done.stderr
    (copy / "corpus_pipeline.py").write_text("import no_such_module\n")
    assert "no_such_module" in run().stderr
