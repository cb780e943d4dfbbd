"""The dimension counts cycles or rows."""

from __future__ import annotations

from fleetlake.operators.health import dim_equipment


def test_rows_without_a_cycle_count_as_rows_only(spark):
    silver = spark.createDataFrame([("FD001", 1, 1), ("FD001", 1, None), ("FD001", 1, 3), ("FD002", 1, None)], "dataset_id string, unit_id long, cycle long")
    for rows, expected in ((False, {"1_FD001": 2, "1_FD002": 0}), (True, {"1_FD001": 3, "1_FD002": 1})):
        dim = dim_equipment(silver, count_rows=rows)
        assert {r.equipment_key: r.total_operational_cycles for r in dim.collect()} == expected
