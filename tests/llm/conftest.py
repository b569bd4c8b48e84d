import os

import duckdb
import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def against_sql(spark):
    """Compare a query with its SQL over the sample tables."""

    def compare(name):
        from fieldfit.llm.queries import QUERIES, SQL

        con = duckdb.connect()
        for t in ("documents", "pages", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        result = con.execute(SQL[name])
        names = [d[0] for d in result.description]
        theirs = sorted(repr(r) for r in result.fetchall())
        ours = sorted(repr(tuple(r)) for r in QUERIES[name](spark, SF).select(*names).collect())
        assert len(ours) == len(theirs)
        assert [p for p in zip(ours, theirs) if p[0] != p[1]][:2] == []

    return compare
