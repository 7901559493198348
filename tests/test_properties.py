"""Property: split row frames equal the plain window for any keys, gaps,
duplicate keys and block sizes."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.operators import frames

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 300), st.integers(0, 9)), min_size=1, max_size=120)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, block=st.integers(5, 40), chunk=st.integers(1, 100), back=st.integers(1, 4))
def test_split_equals_plain(spark, rows, block, chunk, back):
    # unique order per key (the frames' contract): keep the first row per (key, order)
    seen, data = set(), []
    for k, o, v in rows:
        if (k, o) not in seen:
            seen.add((k, o))
            data.append((k, o, v))
    df = spark.createDataFrame(data, "k string, o long, v long")

    def build(w):
        return {"s": F.sum("v").over(w.rowsBetween(-back, 0)), "lag": F.lag("v", 1).over(w)}

    plain = frames.rows_frame(df, ["k"], ["o"], back, build, None).collect()
    split = frames.rows_frame(df, ["k"], ["o"], back, build, block, F.floor(F.col("o") / chunk)).collect()
    assert sorted(map(tuple, plain), key=repr) == sorted(map(tuple, split), key=repr)
    mb_plain = frames.max_before(df, ["k"], "o", "v", "m").collect()
    mb_split = frames.max_before(df, ["k"], "o", "v", "m", F.floor(F.col("o") / chunk)).collect()
    assert sorted(map(tuple, mb_plain), key=repr) == sorted(map(tuple, mb_split), key=repr)
