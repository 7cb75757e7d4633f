"""The sample star through every kind of run."""

from datetime import date

import pytest
from fixtures import (
    BATCHES,
    DATES,
    DIM_CUSTOMER,
    DIM_CUSTOMER_HALF_OPEN,
    DIM_PRODUCT,
    FACT,
    rows,
    write_raw,
)

from strata.operators.history import to_closed
from strata.operators.reconcile import content_check, count_check, row_counts, summary
from strata.plans import layers, retail
from strata.sources.tables import read_table

COUNTS = {
    "bronze.customers": 8, "bronze.products": 5, "bronze.orders": 9, "bronze.order_lines": 11,
    "silver.customers": 6, "silver.products": 5, "silver.orders": 8, "silver.order_lines": 11,
    "gold.dim_customer": 8, "gold.dim_product": 5, "gold.dim_date": 91,
    "gold.fact_order_line": 11,
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("star")
    raw = write_raw(root / "raw")
    runs = {
        "compare": lambda out: layers.run_batch(spark, raw, out, DATES, method="compare"),
        "history": lambda out: layers.run_batch(spark, raw, out, DATES),
        "half_open": lambda out: layers.run_batch(spark, raw, out, DATES, encoding="half_open"),
        "incremental": lambda out: layers.run_incremental(spark, raw, out, DATES, buckets=4),
        "snapshots": lambda out: layers.run_snapshots(spark, raw, out, DATES),
    }
    return {name: (str(root / name), run(str(root / name))) for name, run in runs.items()}


def gold(spark, built, run, name):
    return read_table(spark, f"{built[run][0]}/gold/{name}")


RUNS = ["compare", "history", "half_open", "incremental", "snapshots"]
HALF_OPEN = ["half_open", "incremental"]


@pytest.mark.parametrize("run", RUNS)
def test_row_counts_of_every_layer(built, run):
    written = {k: v for k, v in built[run][1].items() if not k.startswith("rejects")}
    assert written == COUNTS


@pytest.mark.parametrize("run", RUNS)
def test_dim_customer(spark, built, run):
    dim = gold(spark, built, run, "dim_customer")
    expected = DIM_CUSTOMER_HALF_OPEN if run in HALF_OPEN else DIM_CUSTOMER
    assert rows(dim) == expected
    assert dict(dim.dtypes)["customer_sk"] == "bigint"


@pytest.mark.parametrize("run", RUNS)
def test_dim_product_and_fact(spark, built, run):
    assert rows(gold(spark, built, run, "dim_product")) == DIM_PRODUCT
    fact = gold(spark, built, run, "fact_order_line")
    assert rows(fact) == FACT
    assert [t for _, t in fact.dtypes] == [
        "bigint", "int", "int", "bigint", "bigint", "int", "int",
        "decimal(10,2)", "decimal(5,2)", "decimal(12,2)", "string",
    ]


@pytest.mark.parametrize("run", RUNS)
def test_dim_date(spark, built, run):
    days = rows(gold(spark, built, run, "dim_date"))
    assert len(days) == 91
    assert days[0] == (20240101, date(2024, 1, 1), 2024, 1, 1, "January", 2, "Monday", False)
    assert days[-1] == (20240331, date(2024, 3, 31), 2024, 1, 3, "March", 1, "Sunday", True)
    assert sum(day[-1] for day in days) == 26


def test_runs_agree_with_each_other(spark, built):
    customers = {
        run: to_closed(gold(spark, built, run, "dim_customer"))
        if run in HALF_OPEN
        else gold(spark, built, run, "dim_customer")
        for run in RUNS
    }
    columns = [*retail.COLUMNS["customers"], "valid_from", "valid_to"]
    checked = content_check(customers, ["customer_id", "valid_from"], columns)
    assert {(r.distinct_hashes, r.variant_count, r.status) for r in checked.collect()} == {
        (1, 5, "PASS")
    }
    tables = {(run, t): gold(spark, built, run, t) for run in RUNS for t in retail.GOLD}
    assert row_counts(tables).count() == 20
    expected = {"dim_customer": 8, "dim_product": 5, "dim_date": 91, "fact_order_line": 11}
    overall = summary(count_check(tables, expected)).collect()
    assert {r.overall_status for r in overall} == {"ALL PASS"}
    assert {r.total_variants for r in overall} == {5}


@pytest.mark.parametrize("run", RUNS)
def test_declared_tests_pass(spark, built, run):
    found = layers.layer_tests(spark, built[run][0], ["batch_1", "batch_2"]).collect()
    assert len(found) > 30
    assert [r for r in found if r.status != "PASS"] == []


def test_incremental_runs_pick_up_new_folders_only(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    write_raw(raw, {"batch_1": BATCHES["batch_1"]})
    first = layers.run_incremental(spark, str(raw), out, DATES, buckets=4)
    assert (first["bronze.customers"], first["gold.dim_customer"]) == (5, 5)
    write_raw(raw, {"batch_2": BATCHES["batch_2"]})
    second = layers.run_incremental(spark, str(raw), out, DATES, buckets=4)
    assert (second["bronze.customers"], second["gold.dim_customer"]) == (3, 8)
    assert rows(read_table(spark, f"{out}/gold/fact_order_line")) == FACT
    third = layers.run_incremental(spark, str(raw), out, DATES, buckets=4)
    assert third["bronze.customers"] == 0
    assert rows(read_table(spark, f"{out}/gold/dim_customer")) == DIM_CUSTOMER_HALF_OPEN


def test_rejects_are_counted_and_set_aside(spark, tmp_path):
    batches = {b: dict(e) for b, e in BATCHES.items()}
    batches["batch_2"]["orders"] += "abc,1,2024-03-16,completed\n,1,2024-03-16,completed\n"
    raw, out = write_raw(tmp_path / "raw", batches), str(tmp_path / "out")
    written = layers.run_batch(spark, raw, out, DATES)
    assert written["silver.orders"] == 8
    assert written["rejects.orders"] == 2
    aside = read_table(spark, f"{out}/rejects/orders").collect()
    assert [r.failed_rules for r in aside] == [["valid_order_id"]] * 2


def test_a_batch_without_a_date_stops_the_run(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    with pytest.raises(Exception, match="no effective date for batch batch_2"):
        layers.run_batch(spark, raw, str(tmp_path / "out"), {"batch_1": DATES["batch_1"]})


@pytest.mark.parametrize("run", ["compare", "history", "incremental", "snapshots"])
def test_no_run_loses_an_undated_batch(spark, tmp_path, run):
    batches = {**BATCHES, "batch_3": BATCHES["batch_2"]}
    raw, out = write_raw(tmp_path / "raw", batches), tmp_path / "out"
    with pytest.raises(ValueError, match="no effective date for batch batch_3"):
        if run == "incremental":
            layers.run_incremental(spark, raw, str(out), DATES)
        elif run == "snapshots":
            layers.run_snapshots(spark, raw, str(out), DATES)
        else:
            layers.run_batch(spark, raw, str(out), DATES, method=run)
    assert not out.exists()


def test_rejects_of_an_earlier_run_do_not_stay(spark, tmp_path):
    batches = {b: dict(e) for b, e in BATCHES.items()}
    batches["batch_2"]["orders"] += "abc,1,2024-03-16,completed\n"
    out = str(tmp_path / "out")
    assert layers.run_batch(spark, write_raw(tmp_path / "a", batches), out, DATES)["rejects.orders"] == 1
    assert layers.run_batch(spark, write_raw(tmp_path / "b"), out, DATES)["rejects.orders"] == 0
    assert read_table(spark, f"{out}/rejects/orders").count() == 0


def test_unreadable_measures_are_counted(spark, tmp_path):
    batches = {b: dict(e) for b, e in BATCHES.items()}
    batches["batch_2"]["order_lines"] += "1008,9,101,bad,99999999999.00,0\n1008,10,101,99999999,99999999.00,0\n"
    written = layers.run_batch(spark, write_raw(tmp_path / "raw", batches), str(tmp_path / "out"), DATES)
    assert {k: n for k, n in written.items() if k.startswith("unreadable")} == {
        "unreadable.order_lines.readable_quantity": 1,
        "unreadable.order_lines.readable_unit_price": 1,
        "unreadable.order_lines.amount_fits": 1,
    }


def test_compare_takes_two_batches(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    with pytest.raises(ValueError, match="two batches"):
        layers.run_batch(spark, raw, str(tmp_path / "out"), DATES | {"batch_3": date(2024, 5, 1)},
                         method="compare")
