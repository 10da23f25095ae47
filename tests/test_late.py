import random

import pytest

from beaconflow.operators.late import dwell_by_arrival
from beaconflow.operators.skew import Skew
from beaconflow.operators.stay import StayConfig
from beaconflow.streaming.labels import stay_step
from tests.stay_cases import CASES, MINUTE, millis

SCHEMA = "imsi string, seq long, ts_ms long, area string"


def walked(records, config):
    """(user, seq, area) -> label, one record after the other."""
    stays, out = {}, {}
    for user, seq, t, areas in sorted(records, key=lambda r: r[1]):
        for area, label in stay_step(stays.setdefault(user, {}), t, areas, config).items():
            out[user, seq, area] = label
    return out


def labels(spark, records, config, skew=None):
    rows = [(u, s, t, a) for u, s, t, areas in records for a in areas]
    out = dwell_by_arrival(spark.createDataFrame(rows, SCHEMA), config, skew=skew)
    assert out.columns == ["imsi", "seq", "ts_ms", "area", "stay"] or skew
    return {(r.imsi, r.seq, r.area): r.stay for r in out.collect()}


def disorder(n=3000, seed=1):
    rng, t, out = random.Random(seed), 10**9, []
    for seq in range(n):
        t += rng.choice([1, 5, 20, 90, 400]) * MINUTE // 10
        late = rng.choice([0, 0, 0, 10, 60, 150, 600]) * MINUTE // 5
        user = "hot" if rng.random() < 0.6 else f"u{rng.randrange(6)}"
        out.append((user, seq, t - late, rng.sample(["A", "B", "C", "D"], rng.randrange(0, 4))))
    return out


@pytest.mark.parametrize("match_max, threshold", [(True, True), (False, True), (True, False)])
def test_equals_the_walk_over_late_records(spark, match_max, threshold):
    records = disorder()
    config = StayConfig((10 * MINUTE, 20 * MINUTE, 45 * MINUTE), match_max, threshold, 30 * MINUTE)
    want = walked(records, config)
    assert labels(spark, records, config) == want
    assert len({v for v in want.values()}) > 3 and sum(v > 0 for v in want.values()) > 200


def test_a_hot_user_in_slices_gives_the_same(spark):
    records = disorder(seed=7)
    config = StayConfig((10 * MINUTE, 45 * MINUTE), timeout_ms=30 * MINUTE)
    assert labels(spark, records, config, Skew(10, 100)) == walked(records, config)


def test_golden_sequences_and_edge_cases(spark):
    for name, (limits, steps) in CASES.items():
        config = StayConfig(tuple(x * MINUTE for x in limits) if max(limits) < 1000 else limits, timeout_ms=30 * MINUTE)
        records = [(name, i, millis(time), list(areas)) for i, (time, areas) in enumerate(steps)]
        assert labels(spark, records, config) == walked(records, config)
    config = StayConfig((MINUTE,), timeout_ms=30 * MINUTE)
    assert labels(spark, [], config) == {}
    odd = [("u", 0, 0, ["A"]), ("u", 1, None, ["A"]), ("u", 2, 2 * MINUTE, ["A", "B"]), (None, 3, 5, ["A"]), (None, 4, 2 * MINUTE, ["A"])]
    got = labels(spark, odd, config)
    assert got == {("u", 0, "A"): 0, ("u", 1, "A"): 0, ("u", 2, "A"): MINUTE, ("u", 2, "B"): 0, (None, 3, "A"): 0, (None, 4, "A"): MINUTE}
    plan = dwell_by_arrival(spark.createDataFrame([("u", 0, 0, "A")], SCHEMA), config, skew=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
