"""The registered queries on the smallest tables: with SQL where there is one, else their rows."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
import corpus_pipeline  # noqa: E402
from chunkatlas.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert not check.compare(spark, con, name, SF)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.quality_rules(spark, docs, SF)
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids"]
