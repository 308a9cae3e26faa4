"""Driver contract, oracle agreement on the smallest tables, and physical-plan properties."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from delaylab.plans import catalog
from delaylab.plans import inspect as plan
from tests.conftest import SF_SMALL

QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["Date", "n_flights", "avg_delay", "avg_daily_load", "month_sin",
                          "holiday_distance"]


def test_every_query_names_operators():
    ops = catalog.operators()
    assert set(ops) == set(QUERIES) <= set(E.queries())
    assert all(ops[k] for k in ops)
    assert set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events", "customer", "part", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows, cols):
    import tools.check_oracle as chk

    strict, chk.STRICT = chk.STRICT, True  # exact floats, -0.0 distinguished
    try:
        return chk.rows_of(cols, rows)
    finally:
        chk.STRICT = strict


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_agrees_small(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in sdf.collect()], sdf.columns) == _norm(res.fetchall(), dcols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    rows = [r.asDict() for r in E.queries()[name](spark, SF_SMALL).collect()]
    assert rows
    for r in rows:
        if "n_test" in r:
            assert r["n"] == r["n_test"] > 0  # no row of the test split is lost
        assert r.get("train_seconds", 1) > 0
        for k in ("rmse", "mean_rmse"):
            assert r.get(k, 1) > 0


def test_flagship_plan_is_two_partial_aggregations(spark):
    df = E.queries()["flagship_daily_features"](spark, SF_SMALL)
    p = plan.physical(df)
    assert "Window" not in p and "Join" not in p
    assert plan.count(p, "HashAggregate") >= 4  # partial + final, twice
    assert not plan.has_python(df)
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz," \
           "o_orderpriority:string>" in plan.formatted(df)


def test_group_count_broadcasts_measured_side(spark):
    df = E.queries()["departures_window"](spark, SF_SMALL)
    p = plan.physical(df)
    assert "BroadcastHashJoin" in p and "Window" not in p
    w = E.queries()["departures_window_plain"](spark, SF_SMALL)
    assert "Window" not in plan.physical(w)
    assert w.exceptAll(df.select(*w.columns)).count() == 0


def test_filters_pushed_to_scan(spark):
    df = E.queries()["outliers"](spark, SF_SMALL)
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThan(l_extendedprice,90000.0)]" \
        in plan.formatted(df)


def test_no_python_in_feature_plans(spark):
    for name in ("hhmm_split", "holiday_distance", "clean_table", "custom_stage_features",
                 "reason_counts", "box_stats_by"):
        assert not plan.has_python(E.queries()[name](spark, SF_SMALL)), name


@pytest.mark.parametrize("name", ["holiday_distance_span", "flagship_daily_features",
                                  "boxcox_profile", "hhmm_split"])
def test_heavy_expressions_stay_in_codegen(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    final = plan.physical(df)  # the final adaptive plan once the query ran
    assert "*(" in final  # WholeStageCodegen subtrees
    assert not plan.has_python(df)


def test_recommended_conf_scales_with_input():
    from delaylab.session import recommended_conf

    small = recommended_conf(10 * 2**30, 64)
    big = recommended_conf(100 * 10**12, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128  # 2 per core floor
    assert int(big["spark.sql.shuffle.partitions"]) > 300_000
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


@pytest.mark.parametrize("name", ["departures_window", "arrivals_window", "reason_counts",
                                  "reason_counts_nonnull"])
def test_group_counts_never_shuffle_the_big_table(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    final = plan.physical(df)
    assert "BroadcastHashJoin" in final
    assert "Exchange hashpartitioning" not in final and "SortMergeJoin" not in final
    assert "Window" not in final
