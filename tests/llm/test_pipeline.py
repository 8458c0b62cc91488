"""The pipeline's stages, each on its predecessor's rows, against brute force."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import numpy as np  # noqa: E402

from quire.llm import quality_classifier  # noqa: E402


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        got = stage(spark, docs, sf)
        after = {r["doc_id"]: r for r in got.collect()}
        assert set(after) <= set(before)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert got.columns == docs.columns and got.dtypes == docs.dtypes
        texts = [(d, r["text"]) for d, r in before.items()]
        if name == "quality classifier":
            model = quality_classifier.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
            views = [(np.array([quality_classifier.content_view(r["text"])]), np.array([quality_classifier.metadata_view(r["source"], r["lang"], r["n_chars"])])) for r in before.values()]
            assert set(after) == {d for d, v in zip(before, views, strict=True) if model.score(*v)[0] >= model.threshold}
            bad = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()} & set(before)
            assert len(bad & set(after)) < 0.3 * len(bad)
        elif name == "line dedup":
            want = brute.line_dedup(texts)
            assert {d: brute.sha(r["text"]) for d, r in after.items()} == {d: v[0][2] for d, v in want.items()}
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        elif name == "SimHash near-dedup":
            assert set(after) == {c for _, _, c in brute.components(texts)}
        elif name == "mixing sources":
            assert set(after) == set(before)
        elif name == "benchmark decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert not any(i in r["text"] for r in after.values() for i in items)
            assert len(after) > 0.8 * len(before)
        docs = spark.createDataFrame([tuple(r) for r in after.values()], got.schema)
    assert docs.count() > 0


def test_stages_on_odd_rows(spark, sf, odd_docs, no_docs):
    import corpus_pipeline

    for docs in (odd_docs.withColumnRenamed("chunk", "kept_text"), no_docs):
        rows = docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, sf)
            assert got.columns == docs.columns and got.count() <= rows
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == rows


def test_entry_without_the_subpackage(tmp_path):
    import shutil
    import subprocess

    root = Path(__file__).parents[2]
    for name in ("__spark_entry__.py", "quire"):
        (shutil.copytree if (root / name).is_dir() else shutil.copy)(root / name, tmp_path / name)
    shutil.rmtree(tmp_path / "quire/llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
