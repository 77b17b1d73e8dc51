"""Every query of this subpackage, and the pipeline, on tables without rows."""

from __future__ import annotations

import pytest

from loomcart.llm.registry import queries


@pytest.fixture(scope="module")
def empty_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for table in ("documents", "benchmark", "pages", "conversations"):
        spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").limit(0).write.parquet(f"{folder}/{table}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, empty_folder, name):
    rows = queries()[name](spark, empty_folder).collect()
    # The stated extra conversation is there without any other.
    assert [r["conv_id"] for r in rows] == [-7] if name == "op5_chat_format" else rows == []


def test_pipeline(spark, empty_folder):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, empty_folder).collect() == []
