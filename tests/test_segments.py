from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pvspark.operators.segments import (
    fitting_width, ordered_lists, running_last, running_number, segment_of,
)

common = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
# One key is far busier than the others.
timeline = st.lists(
    st.tuples(
        st.sampled_from(["hot", "hot", "hot", "a", "b"]),
        st.integers(-50, 50),
        st.one_of(st.none(), st.integers(0, 9)),
    ),
    min_size=1,
    max_size=60,
)


def frame(spark, items, width):
    data = [(i, key, pos, state) for i, (key, pos, state) in enumerate(items)]
    df = spark.createDataFrame(data, "id INT, key STRING, pos BIGINT, state INT")
    return df.withColumn("segment", segment_of(F.col("pos"), width)), data


@common
@given(items=timeline, width=st.integers(1, 40), inclusive=st.booleans())
def test_running_last_equals_a_plain_scan(spark, items, width, inclusive):
    df, data = frame(spark, items, width)
    got = {
        r["id"]: r["last"]
        for r in running_last(df, ["key"], "segment", ["pos", "id"], "state", "last", inclusive).collect()
    }
    expected, current = {}, {}
    for i, key, pos, state in sorted(data, key=lambda r: (r[1], r[2], r[0])):
        before = current.get(key)
        if state is not None:
            current[key] = state
        expected[i] = current.get(key) if inclusive else before
    assert got == expected


@common
@given(items=timeline, width=st.integers(1, 40))
def test_running_number_counts_from_one(spark, items, width):
    df, data = frame(spark, items, width)
    got = {
        r["id"]: r["n"]
        for r in running_number(df, ["key"], "segment", ["pos", "id"], "n").collect()
    }
    expected, count = {}, {}
    for i, key, *_ in sorted(data, key=lambda r: (r[1], r[2], r[0])):
        count[key] = count.get(key, 0) + 1
        expected[i] = count[key]
    assert got == expected


@common
@given(items=timeline, longest=st.integers(1, 10))
def test_list_parts_join_to_the_whole(spark, items, longest):
    df, data = frame(spark, items, 40)
    lists = ordered_lists(
        df, ["key"], F.col("pos"), 40, ["pos", "id"], ["id"], "items", max_values=longest
    ).collect()
    assert all(len(r["items"]) <= longest for r in lists)
    for key in {key for _, key, *_ in data}:
        parts = sorted((r for r in lists if r["key"] == key), key=lambda r: r["part"])
        assert [r["part"] for r in parts] == list(range(len(parts)))
        whole = [item["id"] for r in parts for item in r["items"]]
        assert whole == [r[0] for r in sorted(data, key=lambda r: (r[2], r[0])) if r[1] == key]


def test_width_follows_the_busiest_key(spark):
    df = spark.range(1000).select(F.lit("hot").alias("key"), F.col("id").alias("pos"))
    assert fitting_width(df, ["key"], F.col("pos"), 1000, max_rows=100) == 100
    assert fitting_width(df, ["key"], F.col("pos"), 1000, max_rows=5000) == 1000
    assert fitting_width(df.where("pos < 0"), ["key"], F.col("pos"), 1000) == 1000
