"""Every query of the catalog against its SQL."""

import math

import pytest

from signalwerk import plans

from .conftest import SF


def shown(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, list):
        return repr(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(map(shown, r)) for r in pdf[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    assert rows(plans.QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(plans.ORACLE_SQL[name]).fetchdf())


def test_digest_is_stable_and_sees_changes(spark):
    from signalwerk.operators import reviews

    a = spark.range(100).selectExpr("id", "id * 2 AS v")
    b = a.selectExpr("id", "if(id = 7, 0, v) AS v")
    one = lambda df: reviews.digest(df, "id", "v").first()["digest"]
    assert one(a) == one(a.repartition(7)) != one(b)
