import pytest

from sluicebox.__main__ import parser, run
from sluicebox.contracts import RAW_SOURCES
from sluicebox.settings import cluster_settings
from sluicebox.sources.storage import read_table


def test_whole_chain_from_csv_to_forecast(spark, data, folder):
    """CSV, Bronze, Silver, Gold, serving, features, training and forecast, as the commands run them."""
    from checks.fixtures import Inputs

    t = Inputs(spark, data)
    for name, source in RAW_SOURCES.items():
        t[f"raw_{name}"].select(*source.columns).write.csv(
            f"{folder}/raw/{source.file_name}", header=True,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )

    def command(*words):
        return run(spark, parser().parse_args(["--root", folder, *words]))

    loaded = command("bronze", "--raw", f"{folder}/raw", "--batch-id", "b1")
    assert {c.table for c in loaded} == set(RAW_SOURCES) and {c.batch_id for c in loaded} == {"b1"}
    refined = command("silver")
    assert all(c.written > 0 for c in refined)
    built = {b.table: b.written for b in command("gold", "--as-of", "2001-08-01")}
    served = {s.table: s.rows for s in command("serve")}
    assert built == served and min(built.values()) > 0
    assert command("features")
    assert command("train")[0]["test_rows"] > 0
    (version,) = command("predict", "--horizon-days", "3")
    rows = spark.read.option("header", "true").csv(f"{folder}/models/predictions/{version}")
    assert rows.count() % 3 == 0 and rows.count() > 0
    assert {r["result"] for r in command("kpi", "--limit", "5")} >= {"overview_kpis", "daily_sales", "product_performance", "customer_segments"}
    report = command("check")
    assert report and all(r["rule"].startswith("flag:") and r["violations"] > 0 for r in report)
    assert len(command("query", "--sql", "SELECT customer_id FROM customer_360 ORDER BY lifetime_value DESC")) <= 100
    with pytest.raises(ValueError, match="not approved"):
        command("query", "--sql", "SELECT * FROM users")
    assert read_table(spark, f"{folder}/gold/customer_360").count() == built["customer_360"]


def test_unknown_tables_are_refused():
    with pytest.raises(SystemExit):
        parser().parse_args(["--root", "x", "silver", "--tables", "users"])


def test_cluster_settings_scale_with_the_shuffle():
    small, large = cluster_settings(10**9, 16, "/shared"), cluster_settings(100 * 10**12, 4000, "/shared")
    assert small["spark.sql.shuffle.partitions"] == "32"
    assert large["spark.sql.shuffle.partitions"] == str(-(-100 * 10**12 // (256 * 1024**2)))
    assert large["spark.checkpoint.dir"] == "/shared"
