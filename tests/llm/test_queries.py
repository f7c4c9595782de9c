"""Registered queries against their SQL on the small tables."""

import pytest

from cordon.llm.queries import ORACLE, QUERIES
from oracle_compare import compare, duck_connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_small, name):
    r = compare(QUERIES[name](spark, sf_small), duck_connection(sf_small), ORACLE[name])
    assert r["columns_match"] and r["values_match"], r


# Queries over embeddings: their key, and which rows of the table have results.
OF_VECTORS = {"op11_embedding_whitening": ("vec_id", "true"), "op13_nearest_neighbours": ("query_id", "vec_id % 100 = 0")}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - set(OF_VECTORS)))
def test_other_queries_cover_all_rows(spark, sf_small, name):
    rows = QUERIES[name](spark, sf_small).select("doc_id").distinct().count()
    assert rows == spark.read.parquet(f"{sf_small}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(OF_VECTORS))
def test_vector_queries_cover_all_rows(spark, sf_small, name):
    key, which = OF_VECTORS[name]
    rows = QUERIES[name](spark, sf_small).select(key).distinct().count()
    assert rows == spark.read.parquet(f"{sf_small}/embeddings.parquet").filter(which).count() > 0
