"""Every corpus query with SQL against DuckDB, on the test tables and on odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from llm.helpers import ODD_TEXTS, frame, stored
from llm.test_tables import against_sql, near_texts
from quotemill.llm.queries import QUERIES
from quotemill.llm.sql import SQL

DOCUMENT_QUERIES = sorted(set(SQL) - {"op5_top_k"})


def test_every_operator_has_one_query():
    assert sorted(name.split("_")[0] for name in QUERIES) == sorted(f"op{n}" for n in range(1, 14))
    # Labels, spans, scores and token ids come from methods SQL cannot express.
    assert set(QUERIES) - set(SQL) == {"op7_source_mix", "op1_pii", "op2_license_scan", "op3_quality", "op9_token_counts", "op10_bpe_codec",
                                        "op12_packing", "op13_runs"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    against_sql(spark, name, sf_dir, ["documents", "embeddings"])


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_query_matches_sql_on_odd_rows(spark, tmp_path, name):
    draw = random.Random(21)
    texts = near_texts(draw) + ODD_TEXTS + ["line one\nline two"] * 40
    sources = [draw.choice(["hot", "hot", "a", "b", None]) for _ in texts]
    docs = frame(spark, texts, sources).withColumns({"id": F.lit(1), "size": F.lit("x"), "rank": F.lit(0)})
    against_sql(spark, name, stored(docs, tmp_path), ["documents"])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op3_quality", "op5_top_k"}))
def test_schema_of_an_empty_table(spark, tmp_path, sf_dir, name):
    empty = QUERIES[name](spark, stored(frame(spark, []), tmp_path))
    assert empty.dtypes == QUERIES[name](spark, sf_dir).dtypes
    assert empty.count() == 0
