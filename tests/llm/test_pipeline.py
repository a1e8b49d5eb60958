"""The pipeline on small tables, each stage against brute force on its own input."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from claimwright.llm import pii
from claimwright.llm.queries import QUERIES
from tests.llm import helpers as h
from tests.llm import test_decontaminate as decontaminate_tests
from tests.llm.test_dedup import brute_jaccard

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(*r, "en" if r[1] and "quick" in r[1] else "fr", "src1", len(r[1] or "")) for r in h.awkward_rows()]
    rows += [(50 + k, " ".join(reversed(h.FIRST.split()[k:])) + f" tail{k}", "en", "src0", 0) for k in range(8)]
    rows.append((90, "xqzj vwkx jjqz qxzw zzkq " * 10, None, "src0", 0))
    rows.append((91, "before " + h.SECOND + " " + "after " * 3, "fr", "src0", 0))
    h.documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "la pluie tombe doucement dans le jardin et que les enfants")],
                          "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def rows_of(frame):
    assert frame.columns == COLUMNS
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    before = rows_of(docs)

    kept = stage("language_id")(spark, docs, tables)
    after = rows_of(kept)
    gone = [r for r in before if r not in after]
    assert gone == [r for r in before if r[0] == 90 or not any(c.isalpha() for c in r[1] or "")]

    single = rows_of(stage("near_duplicates")(spark, kept, tables))
    names = list(range(len(after)))
    groups = {}
    for k, (_, n, root) in zip(names, brute_jaccard([(k, r[1]) for k, r in enumerate(after)], 5, (80, 100))):
        groups.setdefault(root if n else ("alone", k), []).append(after[k])
    wanted = sorted((min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values()), key=repr)
    assert sorted((r[0] for r in single), key=repr) == wanted and all(r in after for r in single)

    frame = h.documents(spark, single)
    clean = rows_of(stage("decontamination")(spark, frame, tables))
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    hit = decontaminate_tests.brute([(r[0], r[1]) for r in single], items)
    assert clean == [r for r, x in zip(single, hit) if not x[-1]] and len(clean) < len(single)

    private = rows_of(stage("personal_data")(spark, h.documents(spark, clean), tables))
    assert len(private) == len(clean) and all(r[4] == (len(r[1]) if r[1] is not None else None) for r in private)
    plain = {r[0]: r[1] for r in clean}
    assert all(r[1] == plain[r[0]] for r in private if not pii.TRIGGER.search(plain[r[0]] or ""))

    packed = stage("best_fit_packing")(spark, h.documents(spark, private), tables).collect()
    assert {r.doc_id for r in packed} == {r[0] for r in private}


def test_run_on_empty_tables(spark, tmp_path):
    h.documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run(spark, tables):
    got = corpus_pipeline.run(spark, tables)
    assert got.count() > 0 and "sequence_id" in got.columns


def test_all_queries_are_registered():
    names = sorted(n.split("_")[0] for n in QUERIES if n.startswith("op"))
    assert names == sorted(f"op{k}" for k in range(1, 14))


def test_entry_without_the_package(tmp_path):
    """The entry works where the package and the pipeline are missing."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for name in ("claimwright", "catalog"):
        shutil.copytree(f"{root}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), "
                          "any(n.startswith('op1_') for n in e.queries()))"], cwd=tmp_path, capture_output=True,
                         text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.returncode == 0 and out.stdout.split()[1] == "False", out.stderr
