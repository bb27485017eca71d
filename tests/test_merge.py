import pytest

from starload.operators.merge import DuplicateKeyError, dedupe_stored, merge_touched, merge_upsert

SCHEMA = "k string, q int, created_at long, updated_at long"


def test_replayed_line_keeps_created_at(spark):
    t = spark.createDataFrame([("a", 1, 100, 100), ("b", 2, 100, 100)], SCHEMA)
    s = spark.createDataFrame([("a", 5, 200, 200), ("c", 7, 200, 200)], SCHEMA)
    got = {r.k: r for r in merge_upsert(t, s, ["k"], preserve=["created_at"], order="updated_at").collect()}
    assert got["a"].q == 5 and got["a"].created_at == 100 and got["a"].updated_at == 200
    assert got["b"].q == 2 and got["c"].created_at == 200 and len(got) == 3


def test_null_in_source_overwrites(spark):
    t = spark.createDataFrame([("a", 1, 100, 100)], SCHEMA)
    s = spark.createDataFrame([("a", None, 200, 200)], SCHEMA)
    assert merge_upsert(t, s, ["k"]).first().q is None


def test_duplicate_source_key_latest_wins_or_raises(spark):
    t = spark.createDataFrame([], SCHEMA)
    s = spark.createDataFrame([("a", 1, 1, 10), ("a", 2, 1, 20)], SCHEMA)
    assert merge_upsert(t, s, ["k"], order="updated_at").first().q == 2
    with pytest.raises(DuplicateKeyError):
        merge_upsert(t, s, ["k"], strict=True)


def test_merge_twice_equals_once(spark):
    t = spark.createDataFrame([("a", 1, 100, 100)], SCHEMA)
    s = spark.createDataFrame([("a", 3, 200, 200), ("b", 4, 200, 200)], SCHEMA)
    once = merge_upsert(t, s, ["k"], preserve=["created_at"])
    twice = merge_upsert(once, s, ["k"], preserve=["created_at"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_partitioned_merge_equals_full_merge(spark):
    schema = "k string, d int, q int, created_at long"
    t = spark.createDataFrame([("a", 1, 1, 10), ("b", 1, 2, 10), ("c", 2, 3, 10), ("e", None, 9, 10)], schema)
    # 'a' is rewritten in place, 'b' moves from day 1 to day 3, 'z' is new, 'c' and 'e' are untouched
    s = spark.createDataFrame([("a", 1, 5, 20), ("b", 3, 6, 20), ("z", 3, 7, 20)], schema)
    full = merge_upsert(t, s, ["k"], preserve=["created_at"])
    part = merge_upsert(t, s, ["k"], preserve=["created_at"], partition_col="d")
    assert sorted(full.collect()) == sorted(part.collect())
    got = {r.k: (r.d, r.q, r.created_at) for r in part.collect()}
    assert got == {"a": (1, 5, 10), "b": (3, 6, 10), "c": (2, 3, 10), "e": (None, 9, 10), "z": (3, 7, 20)}


def test_only_days_with_a_key_in_common_are_joined(spark):
    schema = "k string, d int, q int, created_at long"
    t = spark.createDataFrame([("a", 1, 1, 10), ("b", 2, 2, 10), ("c", 2, 3, 10)], schema)
    new = spark.createDataFrame([("y", 3, 5, 20), ("z", 2, 6, 20)], schema)
    rows, parts = merge_touched(t, new, ["k"], ["created_at"], "d", deduped=True)
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString() and set(parts) == {2, 3}
    assert sorted(r.k for r in rows.collect()) == ["b", "c", "y", "z"]
    moved = spark.createDataFrame([("a", 3, 5, 20), ("y", 3, 5, 20), ("z", 2, 6, 20)], schema)  # 'a' comes from day 1
    rows, parts = merge_touched(t, moved, ["k"], ["created_at"], "d", deduped=True)
    assert set(parts) == {1, 2, 3}
    assert sorted(map(tuple, rows.collect())) == [("a", 3, 5, 10), ("b", 2, 2, 10), ("c", 2, 3, 10), ("y", 3, 5, 20), ("z", 2, 6, 20)]


def test_keys_are_shuffled_as_hashes(spark):
    rows = [("x", None, 1), (None, "x", 2), ("y", None, 1), ("y", None, 3)]  # nulls are skipped by the hash: the first two are equal there
    df = spark.createDataFrame(rows, "k string, o string, t int")
    got = dedupe_stored(df, ["k", "o"], "t")
    assert sorted(map(str, got.collect())) == sorted(map(str, dedupe_stored(df.where("t <> 1 or k <> 'y'"), ["k", "o"], "t").collect()))
    assert {(r.k, r.o, r.t) for r in got.collect()} == {("x", None, 1), (None, "x", 2), ("y", None, 3)}
    assert "xxhash64" in got._jdf.queryExecution().optimizedPlan().toString()


def test_partitioned_merge_random(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    row = st.tuples(st.sampled_from("abcdefgh"), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9),
                    st.integers(0, 5))
    schema = "k string, d int, q int, created_at long"

    @settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, max_size=8, unique_by=lambda r: r[0]), st.lists(row, max_size=6, unique_by=lambda r: r[0]))
    def check(target_rows, src_rows):
        t = spark.createDataFrame(target_rows, schema)
        s = spark.createDataFrame(src_rows, schema)
        full = merge_upsert(t, s, ["k"], preserve=["created_at"])
        part = merge_upsert(t, s, ["k"], preserve=["created_at"], partition_col="d")
        key = lambda r: tuple((v is None, v) for v in r)
        assert sorted(full.collect(), key=key) == sorted(part.collect(), key=key)

    check()
