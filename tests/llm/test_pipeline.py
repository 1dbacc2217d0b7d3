import hashlib
import random

import plain_versions as plain
import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from veilgrid.llm import compression  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages_match_plain(spark, tmp_path):
    """Each stage over all rows its predecessor kept, against a plain version of the stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = compression.NAMES.index("kept")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "byte_bpe"]

    def step(name):
        out = stages[name](spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    docs = step("quality_rules")
    rows = [r for r in rows if compression.measure(r[1].encode())[kept]]
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == rows and docs.columns == columns
    docs = step("line_dedup")
    rows = [r for r in plain.without_line_runs(rows) if r[1]]
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == rows and docs.columns == columns
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    docs = step("near_duplicates")
    stay = {d for d, _, _, keep in plain.near_duplicates(rows) if keep}
    rows = [r for r in rows if r[0] in stay]
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == rows and docs.columns == columns
    docs = step("decontamination")
    bad = {d for d, _ in plain.leaks(rows, items, plain.folded_words)}
    rows = [r for r in rows if r[0] not in bad]
    assert bad and sorted((r.doc_id, r.text) for r in docs.collect()) == rows and docs.columns == columns
    out = step("byte_bpe").collect()
    assert {r.doc_id: r.decoded_sha256 for r in out} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in rows}


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns[:2] == ["doc_id", "n_tokens"] and 0 < out.count() <= 200


def test_stages_on_odd_tables(spark, tmp_path):
    """Empty tables, null and empty texts, repeated rows and columns with clashing names pass through all stages."""
    rng = random.Random(40)
    text = "\n".join(" ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 9) for _ in range(12)) for _ in range(12))
    rows = [(1, text, "x"), (1, text, "x"), (2, text, "y"), (3, None, "z"), (4, "", "z"), (None, text, "n")]
    for table in (rows, []):
        docs = spark.createDataFrame(table, "doc_id long, text string, row1 string").withColumns({"gone": F.lit(1), "__row__": F.lit(2), "n_tokens": F.lit(3)})
        columns = docs.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, FOLDER)
            path = str(tmp_path / f"{len(table)}-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            assert i == 4 or docs.columns == columns
        assert docs.count() <= len(table)
