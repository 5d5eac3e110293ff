"""Headers of Bronze files: the report, and reading by name."""

import gzip
import os

import pytest

from conftest import write_csv
from daybook.plans import pipeline
from daybook.session import local_path
from daybook.sources import bronze, headers

NAMES = ["event_id", "user_id", "event_type", "product_id", "event_timestamp", "amount"]
DAY = "2026-07-01"
VALUES = {"event_id": "a", "user_id": "1", "event_type": "view", "product_id": "10",
          "event_timestamp": f"{DAY}T00:00:01", "amount": "1.5", "more": "x"}


def land(paths, name, columns, **values):
    row = {**VALUES, **values}
    write_csv(bronze.date_path(paths.bronze, DAY), name,
              ",".join(columns) + "\n" + ",".join(row[c] for c in columns) + "\n")


def test_report_has_a_row_for_each_file(spark, root):
    paths = pipeline.Paths.under(root)
    land(paths, "good.csv", NAMES)
    land(paths, "turned.csv", NAMES[::-1])
    land(paths, "more.csv", [*NAMES, "more"])
    land(paths, "less.csv", [c for c in NAMES if c != "user_id"])
    write_csv(bronze.date_path(paths.bronze, DAY), "crlf.csv", ",".join(NAMES) + "\r\n")
    write_csv(bronze.date_path(paths.bronze, DAY), "empty.csv", "")
    write_csv(bronze.date_path(paths.bronze, DAY), "quoted.csv", ",".join(f'"{c}"' for c in NAMES))
    got = {r["path"].split("/")[-1]: r for r in pipeline.header_report(spark, paths).collect()}
    assert len(got) == 6 and "empty.csv" not in got  # a file of no bytes has nothing to read
    assert {n for n, r in got.items() if r["passed"]} == {"good.csv", "crlf.csv", "quoted.csv"}
    assert got["turned.csv"]["reordered"] and not got["turned.csv"]["missing"]
    assert got["more.csv"]["extra"] == ["more"] and not got["more.csv"]["reordered"]
    assert got["less.csv"]["missing"] == ["user_id"]
    assert pipeline.header_report(spark, paths, ["2026-07-02"]).count() == 0


def test_files_read_right_by_name(spark, root):
    paths = pipeline.Paths.under(root)
    land(paths, "good.csv", NAMES, event_id="g")
    land(paths, "turned.csv", NAMES[::-1], event_id="t", amount="2.5")
    land(paths, "more.csv", ["more", *NAMES], event_id="m", user_id="bad")
    land(paths, "less.csv", [c for c in NAMES if c != "amount"], event_id="l")
    land(paths, "twice.csv", [*NAMES, "event_id"], event_id="w")
    with gzip.open(os.path.join(local_path(bronze.date_path(paths.bronze, DAY)), "z.csv.gz"), "wt") as f:
        f.write(",".join(NAMES[::-1]) + "\n" + ",".join({**VALUES, "event_id": "z"}[c] for c in NAMES[::-1]) + "\n")
    got = {r["event_id"]: r for r in headers.read_by_name(spark, paths.bronze).collect()}
    assert {k: (r["user_id"], r["product_id"], r["amount"]) for k, r in got.items()} == {
        "g": (1, 10, 1.5), "t": (1, 10, 2.5), "m": (None, 10, 1.5), "l": (1, 10, None),
        "w": (1, 10, 1.5), "z": (1, 10, 1.5)}
    assert {r["process_date"].isoformat() for r in got.values()} == {DAY}
    with pytest.raises(pipeline.GateError):  # by position such a date does not run
        pipeline.daily_run(spark, paths, DAY)
    pipeline.run_dates(spark, paths, [DAY], by_name=True)
    assert pipeline.silver_for(spark, paths, [DAY]).count() == 5


def test_nothing_to_read_by_name(spark, root):
    paths = pipeline.Paths.under(root)
    assert headers.read_by_name(spark, paths.bronze).count() == 0
    write_csv(bronze.date_path(paths.bronze, DAY), "empty.csv", "")
    df = headers.read_by_name(spark, paths.bronze)
    assert df.count() == 0 and df.columns == [*NAMES, "process_date"]
