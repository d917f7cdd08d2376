"""Exports in deliveries: the same rows, and no CSV is left when they are taken in."""

import os

from pyspark.sql import functions as F

from pulsekit.plans import registry
from pulsekit.session import ensure_checkpoint_dir
from pulsekit.sources import exports

SF = "/root/testdata/sf0.001"


def left(spark):
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    return [f for d, _, names in os.walk(top) for f in names if "/exports-" in d and f.endswith(".csv")]


def test_deliveries_give_the_rows_of_one(spark, monkeypatch):
    before = left(spark)
    one = registry.QUERIES["csv_export_scan"](spark, SF)
    monkeypatch.setattr(registry, "DELIVERY_BYTES", 1 << 20)
    many = registry.QUERIES["csv_export_scan"](spark, SF)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect())) and len(many.inputFiles()) > len(one.inputFiles())
    assert left(spark) == before


def test_header_is_found_among_the_first_records_of_splits(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n\n"x","y"\n"1","a\nb"\n' + '"2","%s"\n' % ("c\n" * 400) + "".join(f'"{i}","z"\n' for i in range(300)))
    (tmp_path / "b.csv").write_bytes("﻿x,y\n7,ü\n".encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        records, files = exports.csv_records(spark, str(tmp_path))
        got = {r["uri"].rsplit("/", 1)[1]: r["first"] for r in files.collect()}
        assert got == {"a.csv": '"x","y"', "b.csv": "x,y"} and records.count() == 303 + 2
        plan = files._jdf.queryExecution().optimizedPlan().toString()
        assert "seq" in plan and "= 0" in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
