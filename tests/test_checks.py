"""The queries of ``checks`` store what they use twice, and store it small."""

import glob

from checks import gold_checks, layer_checks
from checks.fixtures import Inputs
from sluicebox.plans import changes, serving, silver


def test_served_tables_are_built_once(spark, monkeypatch):
    seen = []
    frame = spark.sql("SELECT 1L AS customer_id, 'a' AS customer_name, 0L AS total_orders FROM range(3) GROUP BY 1, 2")
    monkeypatch.setattr(gold_checks, "gold_tables", lambda t: {"customer_360": frame})
    monkeypatch.setattr(serving, "replace_serving_table", lambda df, name, target: seen.append(df))
    monkeypatch.setattr(gold_checks.stacking, "serving", lambda frames: frames)
    monkeypatch.setattr(gold_checks, "read_table", lambda *a: None)
    gold_checks.sink_serving_replace(Inputs(spark, ""))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in seen]
    assert len(plans) == 2 and not any("HashAggregate" in plan for plan in plans)
    assert seen[1].collect() == frame.collect()


def test_bronze_copies_are_written_with_zstd(spark, data, monkeypatch):
    folders = []
    monkeypatch.setattr(silver, "refine", lambda spark, bronze, *a: folders.append(bronze))
    monkeypatch.setattr(silver, "refine_together", lambda spark, bronze, layer: folders.append(bronze))
    monkeypatch.setattr(changes, "refine_changes", lambda spark, bronze, store: folders.append(bronze))
    layer_checks.refined(Inputs(spark, data))
    for query in (layer_checks.sink_silver_overwrite, layer_checks.pipe_silver_changes):
        try:
            query(Inputs(spark, data))
        except KeyError:  # no table is published here
            pass
    files = [name for folder in folders for name in glob.glob(f"{folder}/*/*.parquet")]
    assert len(set(folders)) == 3 and files and all(".zstd." in name for name in files)
