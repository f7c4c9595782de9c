"""Physical-plan properties that matter at scale."""

import contextlib
import io
import tempfile

import pytest

from cordon.config import FIXTURE_CONFIG as CFG
from cordon.operators import compare, zones
from cordon.plans import audit, catalog
from cordon.sources import fixture


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_udfs_and_no_pair_joins(spark, sf_small, name):
    plan = formatted(catalog.QUERIES[name](spark, sf_small))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


@pytest.fixture(scope="module")
def written(spark, sf_small):
    root = tempfile.mkdtemp(prefix="cordon-plans-")
    tables = audit.AuditTables(root)
    rb = {t: fixture.raw_trips(spark, sf_small, t) for t in CFG.taxi_types}
    from cordon.operators import unify

    audit.write_labelled(unify.unify_all(rb, CFG.column_maps), CFG, tables)
    return tables


def test_classification_broadcasts_and_does_not_shuffle_trips(spark, sf_small, written):
    ids = zones.zone_id_set(zones.congestion_zones(fixture.zones(spark, sf_small), CFG), CFG)
    plan = formatted(zones.classify(audit.read_clean(spark, written), ids, CFG))
    assert plan.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_rollup_aggregates_before_the_shuffle(spark, sf_small, written):
    ids = zones.zone_id_set(zones.congestion_zones(fixture.zones(spark, sf_small), CFG), CFG)
    plan = formatted(zones.zone_daily(zones.classify(audit.read_clean(spark, written), ids, CFG)))
    tree = plan.split("\n\n")[0]
    lines = [ln.strip(" :+-") for ln in tree.splitlines()]
    agg_idx = [i for i, ln in enumerate(lines) if ln.startswith("HashAggregate")]
    ex_idx = [i for i, ln in enumerate(lines) if ln.startswith("Exchange")]
    assert len(agg_idx) >= 2 and ex_idx, tree
    assert agg_idx[0] < ex_idx[0] < agg_idx[1], tree  # final agg above the shuffle, partial agg below it


def test_period_queries_prune_partitions_and_columns(spark, written):
    plan = formatted(compare.quarter_comparison(audit.read_clean(spark, written), CFG))
    scan = plan[plan.index("Scan parquet"):]
    assert "PartitionFilters: [" in scan and "year" in scan.split("PartitionFilters")[1].split("\n")[0]
    assert "PushedFilters: [" in scan and "pickup_time" in scan.split("PushedFilters")[1].split("\n")[0]
    schema = scan.split("ReadSchema: ")[1].split("\n")[0]
    assert "dropoff_loc" not in schema and "congestion_surcharge" not in schema, schema


def _tree(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_statistics_share_one_pass(spark, written, tmp_path):
    from cordon.operators import anomaly

    hub = anomaly.anomaly_hub(audit.read_labelled(spark, written))
    assert _tree(hub).count("FileScan") == 1 and "Expand" not in _tree(hub)
    hub.write.parquet(str(tmp_path / "hub"))
    stored = spark.read.parquet(str(tmp_path / "hub"))
    for f in (anomaly.ghost_stats, anomaly.ghost_totals, anomaly.ghost_patterns):
        plan = _tree(f(stored))
        assert plan.count("FileScan") == 1 and "run_id" not in plan, f.__name__


def test_location_reports_share_one_pass(spark, sf_small, written):
    ids = zones.zone_id_set(zones.congestion_zones(fixture.zones(spark, sf_small), CFG), CFG)
    hub = zones.location_hub(zones.classify(audit.read_clean(spark, written), ids, CFG), CFG)
    plan = formatted(hub)
    trips = [s for s in plan.split("Scan parquet") if "pickup_time" in s.split("ReadSchema")[-1].split("\n")[0]]
    assert len(trips) == 1 and "Expand" not in plan


def test_projection_reads_the_trip_table_once(spark, sf_small):
    assert _tree(catalog.unified(spark, sf_small)).count("lineitem.parquet") == 1
