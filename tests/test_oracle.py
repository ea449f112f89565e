"""Every registered query against its DuckDB statement (sf0.001)."""

import pandas as pd
import pytest

import __spark_entry__ as se
from strata.plans.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

NAMES = sorted(QUERIES)          # the training-data queries have tests of their own


def canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_float_dtype(s):
            nn = s.dropna()
            if len(nn) and (nn == nn.round()).all() and s.isna().any():
                s = s.astype("Int64")
            else:
                s = s.round(6)
        elif pd.api.types.is_datetime64_any_dtype(s):
            s = s.astype("datetime64[us]").astype("int64")
        df[c] = s.astype(object).where(s.notna(), None).astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(se.queries()) and set(ORACLE_SQL) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = se.queries()[name](spark, SF_SMALL).toPandas()
    sql = se.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    exp = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(exp.columns)
    pd.testing.assert_frame_equal(canon(got), canon(exp))


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert df.columns == ["c_nationkey", "c_mktsegment", "count"]
    assert sum(r["count"] for r in rows) == spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    counts = [r["count"] for r in rows]
    assert counts == sorted(counts, reverse=True)
