"""Each registered query against its SQL, on the smallest tables."""

import duckdb
import pytest
from quern.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(tuple, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def base(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, base, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), base.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_embeddings_get_a_cluster_each(spark, sf_dir):
    found = QUERIES["hdbscan_embeddings"](spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert all(r.cluster >= -1 and 0 <= r.prob <= 1 for r in found)


def test_stream_reads_a_table_in_parts(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got, want = (QUERIES[name](spark, str(tmp_path)).toPandas() for name in ("text_stats_stream", "text_stats"))
    assert len(got) and rows(got) == rows(want)
