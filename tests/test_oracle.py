"""Every registered query against its SQL."""

from __future__ import annotations

import pandas as pd
import pytest

from granary import plans

QUERIES, SQL = plans.queries(), plans.oracle_sql()


def plain(df: pd.DataFrame) -> pd.DataFrame:
    def cell(s: pd.Series) -> pd.Series:
        if pd.api.types.is_numeric_dtype(s) and not pd.api.types.is_bool_dtype(s):
            return s.astype("float64").round(9).astype(str)
        return s.map(lambda v: "null" if v is None or v is pd.NA or (isinstance(v, float) and v != v) else str(v))

    cols = sorted(df.columns)
    return df[cols].apply(cell).sort_values(cols).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, sf, duck):
    ours = plain(QUERIES[name](spark, sf).toPandas())
    theirs = plain(duck.sql(SQL[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    pd.testing.assert_frame_equal(ours, theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(name, spark, sf):
    assert QUERIES[name](spark, sf).columns
