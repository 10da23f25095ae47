from pyspark.sql import functions as F

from beaconflow.operators import skew
from beaconflow.operators.stay import StayConfig
from beaconflow.plans.labelling import LabelPlan
from tests.stay_cases import MINUTE
from tests.test_streaming import records, rows_of


def test_wide_rows_are_dealt_by_their_number(spark, monkeypatch):
    df, plan = records(spark), LabelPlan(stay=StayConfig((30 * MINUTE,)), device=True)
    columns = ["seq", "imsi", "last_imei", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("area_onsite_stay"))))]
    whole = plan.label(df, {})
    monkeypatch.setattr(skew, "PART_ROWS", 20)
    parts = plan.label(df, {})
    assert parts.rdd.getNumPartitions() == 20
    assert rows_of(parts.select(columns)) == rows_of(whole.select(columns))
