import pyarrow as pa
import pytest

from beaconflow.session import arrow_batches

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_are_small_within_and_as_before_after(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    rows = spark.range(300).selectExpr("repeat('x', 1000) AS x").coalesce(1).mapInArrow(sizes, "n long")
    before = spark.conf.get(KEY)
    assert [r.n for r in rows.collect()] == [300]
    with pytest.raises(ZeroDivisionError), arrow_batches(spark, 50_000):
        with arrow_batches(spark, 1 << 20):  # the smaller one stays
            assert max(r.n for r in rows.collect()) <= 51
        assert spark.conf.get(KEY) == "50000b"
        raise ZeroDivisionError
    assert spark.conf.get(KEY) == before
