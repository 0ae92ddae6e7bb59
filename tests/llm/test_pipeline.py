"""The pipeline's stages in a row, and its registration."""

from __future__ import annotations

import __spark_entry__ as contract
import corpus_pipeline
from tidewater.llm import queries

from .cases import AWKWARD, documents, words


def test_registered():
    names = contract.queries()
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= set(names)


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    junk = [" ".join(w + "$$$" for w in words(60, 1000 + i)) for i in range(30)]
    good = [" ".join(words(60, i)) for i in range(30)]
    passage = words(40, 77)
    good += [" ".join(words(50, 400 + i) + passage) for i in range(3)] + [good[0], 'token = "' + "0123456789abcdef" * 2 + '" ' + good[1][::-1]]
    docs = documents(spark, good + junk + AWKWARD)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i < len(good))) for i in range(len(good) + len(junk))]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    held = spark.read.parquet(str(tmp_path / "documents.parquet"))
    sizes = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, held, str(tmp_path))
        if n < 4:
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        out.write.parquet(str(tmp_path / f"stage{n}"))
        held = spark.read.parquet(str(tmp_path / f"stage{n}"))
        sizes.append({r.doc_id for r in held.select("doc_id").collect()})
    assert not sizes[0] & set(range(len(good), len(good) + len(junk))) and sizes[0] >= set(range(len(good)))
    assert len(good) - 2 not in sizes[1] and set(range(1, 30)) <= sizes[1]
    texts = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "stage3")).collect()}
    assert all(" ".join(passage) not in texts[i] for i in (30, 31, 32))
    assert "[REDACTED]" in texts[len(good) - 1]
    total = {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "length", "ids_crc32").collect()}
    assert total == {tuple(r) for r in held.select("doc_id", "start", "length", "ids_crc32").collect()}
