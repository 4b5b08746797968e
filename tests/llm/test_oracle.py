"""Each query of this part that has SQL gives the rows that DuckDB gives for it, on the driver's tables and on odd rows."""

import pytest

from meterline.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import difference, duck_connection
from tests.llm.edge import documents


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_is_its_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), duck_connection(sf_dir), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op9_ngram_jaccard", "op10_quality_rules"])
def test_odd_rows(spark, tmp_path, name):
    """SQL speaks of one row for each doc_id, so rows without one, and repeated ones, stay out here; so do very long texts,
    whose windows take DuckDB too long (the brute-force tests have them)."""
    documents(spark).where("doc_id IS NOT NULL AND (text IS NULL OR length(text) < 20000)").dropDuplicates(["doc_id"]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    db = duck_connection(str(tmp_path / "none"))
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert difference(QUERIES[name](spark, str(tmp_path)), db, ORACLE_SQL[name]) is None
