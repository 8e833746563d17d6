import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import columns as C


def test_the_formatter_wins_over_the_field(spark):
    df = spark.createDataFrame([(1, "q", "a")], "id int, quote string, author string")
    assert C.select_text(df, "quote").first().text == "q"
    row = C.select_text(df, "id", lambda d: F.concat_ws("-", d.quote, d.author), keep=("id",)).first()
    assert (row.id, row.text) == (1, "q-a")
    with pytest.raises(ValueError):
        C.select_text(df)


def test_added_columns_and_batches(spark):
    df = spark.range(5)
    rows = C.add_columns(df, {"x": F.col("id") + 1, "y": lambda d: d.id * 2}).collect()
    assert all(r.x == r.id + 1 and r.y == 2 * r.id for r in rows)

    def double(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pc.multiply(batch.column(0), 2)], ["z"])

    assert sorted(r.z for r in C.map_batches(df, double, "z bigint").collect()) == [0, 2, 4, 6, 8]
