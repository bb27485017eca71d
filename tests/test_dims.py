import datetime as dt

from pyspark.sql import functions as F

from starload.operators.dims import insert_ignore, scd2_apply, scd2_changes
from starload.plans.warehouse import load_customer, load_location
from starload.schemas import DIM_CUSTOMER, DIM_LOCATION, empty_frame

from rows import rows

T0 = 1704067200


def batch(spark, recs):
    return spark.createDataFrame(recs, "customer_id string, name string, updated_at long")


def apply(spark, dim, recs, **kw):
    return load_customer(dim, batch(spark, recs), **kw)


def ts(s):
    return dt.datetime.fromtimestamp(s, dt.timezone.utc).replace(tzinfo=None)


def check_intervals(dim_rows):
    """Exactly one Active row per key; intervals contiguous and non-overlapping."""
    by = {}
    for r in dim_rows:
        by.setdefault(r["customer_bk"], []).append(r)
    for vs in by.values():
        vs.sort(key=lambda r: (r["row_eff_time"], r["customer_id"]))
        assert sum(v["current_row_indicator"] == "Active" for v in vs) == 1
        assert vs[-1]["current_row_indicator"] == "Active" and vs[-1]["row_exp_time"] is None
        for a, b in zip(vs, vs[1:]):
            assert a["row_exp_time"] == b["row_eff_time"] and a["current_row_indicator"] == "Expired"


def test_unchanged_version_adds_nothing(spark):
    d = apply(spark, empty_frame(spark, DIM_CUSTOMER), [("C1", "Ann", T0)])
    d2 = apply(spark, d, [("C1", "Ann", T0 + 100)])
    assert d2.count() == 1


def test_a_b_a(spark):
    d = empty_frame(spark, DIM_CUSTOMER)
    for i, n in enumerate(["A", "B", "A"]):
        d = apply(spark, d, [("C1", n, T0 + i * 100)])
    r = rows(d, "row_eff_time")
    assert [x["customer_name"] for x in r] == ["A", "B", "A"]
    assert r[-1]["current_row_indicator"] == "Active"
    check_intervals(r)


def test_resent_version_current_vs_all(spark):
    for compare, expected in (("history", 2), ("current", 2), ("all", 3)):
        kw = dict(compare=compare)
        d = apply(spark, empty_frame(spark, DIM_CUSTOMER), [("C1", "v1", T0)], **kw)
        d = apply(spark, d, [("C1", "v2", T0 + 100)], **kw)
        d = apply(spark, d, [("C1", "v2", T0 + 100)], **kw)
        assert d.count() == expected, compare


def test_two_versions_in_one_batch(spark):
    d = apply(spark, empty_frame(spark, DIM_CUSTOMER), [("C1", "x", T0), ("C1", "y", T0 + 50)])
    r = rows(d, "row_eff_time")
    assert r[0]["customer_name"] == "x" and r[0]["current_row_indicator"] == "Expired"
    assert r[0]["row_exp_time"] == ts(T0 + 50)
    assert r[1]["customer_name"] == "y" and r[1]["current_row_indicator"] == "Active" and r[1]["row_exp_time"] is None


def test_equal_times_one_active(spark):
    d = apply(spark, empty_frame(spark, DIM_CUSTOMER), [("C1", "x", T0), ("C1", "y", T0)])
    assert d.where("current_row_indicator = 'Active'").count() == 1


def test_late_version_contiguous(spark):
    d = apply(spark, empty_frame(spark, DIM_CUSTOMER), [("C1", "a", T0)])
    d = apply(spark, d, [("C1", "c", T0 + 200)])
    d = apply(spark, d, [("C1", "b", T0 + 100)])  # arrives late, belongs between a and c
    r = rows(d, "row_eff_time")
    assert [x["customer_name"] for x in r] == ["a", "b", "c"]
    check_intervals(r)


def test_new_key_null_name_inserted(spark):
    d = apply(spark, empty_frame(spark, DIM_CUSTOMER), [("C9", None, T0)])
    assert d.count() == 1 and d.first().current_row_indicator == "Active"


def test_changes_eff_min_and_max(spark):
    src = batch(spark, [("C1", "n", T0 + 30), ("C1", "n", T0 + 10)])
    e = empty_frame(spark, DIM_CUSTOMER)
    lo = scd2_changes(e, src, "customer_bk", ["customer_name"], "updated_at", "customer_id", ["name"], compare="current").first()
    hi = scd2_changes(e, src, "customer_bk", ["customer_name"], "updated_at", "customer_id", ["name"],
                      compare="current", eff="max").first()
    assert lo.row_eff_time == ts(T0 + 10) and hi.row_eff_time == ts(T0 + 30)


def test_insert_ignore_null_place_once(spark):
    src = spark.createDataFrame([(None, "ID", 1.5, 2.0)], "place string, country string, latitude double, "
                                "longitude double").select(
        "place", "country", F.col("latitude").cast("decimal(12,5)").alias("latitude"),
        F.col("longitude").cast("decimal(12,5)").alias("longitude"))
    d = load_location(empty_frame(spark, DIM_LOCATION), src)
    d = load_location(d, src)
    assert d.count() == 1 and d.first().location_id == 1


def test_insert_ignore_appends_above_max(spark):
    t = spark.createDataFrame([(5, "x")], "k_id long, k string")
    s = spark.createDataFrame([("x",), ("z",), ("y",), ("z",)], "k string")
    got = sorted((r.k_id, r.k) for r in insert_ignore(t, s, ["k"], "k_id").collect())
    assert got == [(5, "x"), (6, "y"), (7, "z")]


def test_scd2_apply_generic_keys(spark):
    t = spark.createDataFrame([], "sk long, bk string, a string, row_eff_time timestamp, row_exp_time timestamp, "
                                  "current_row_indicator string, updated_at timestamp")
    s = spark.createDataFrame([("k", "1", T0)], "bk string, a string, t long")
    d = scd2_apply(t, s, "bk", ["a"], "t", "sk")
    assert [(r.sk, r.current_row_indicator) for r in d.collect()] == [(1, "Active")]


def names(dim):
    return [(r["customer_name"], r["row_eff_time"], r["current_row_indicator"]) for r in rows(dim, "row_eff_time", "customer_id")]


def test_runs_within_one_batch(spark):
    """A, B, A are three versions, sightings in between change nothing, and the last A is current."""
    recs = [("C1", n, T0 + t) for n, t in [("A", 0), ("A", 5), ("B", 10), ("B", 12), ("A", 20), ("A", 30), (None, 40), (None, 41), ("A", 50)]]
    d = apply(spark, empty_frame(spark, DIM_CUSTOMER), recs[::-1])
    assert names(d) == [("A", ts(T0), "Expired"), ("B", ts(T0 + 10), "Expired"), ("A", ts(T0 + 20), "Expired"), (None, ts(T0 + 40), "Expired"), ("A", ts(T0 + 50), "Active")]
    check_intervals(rows(d))


def test_replayed_batches_add_nothing(spark):
    first, second = [("C1", "A", T0), ("C2", "x", T0)], [("C1", "B", T0 + 10), ("C1", "A", T0 + 20), ("C1", "A", T0 + 25)]
    d = empty_frame(spark, DIM_CUSTOMER)
    for recs in (first, second):
        d = apply(spark, d, recs)
    want = names(d)
    assert [w[0] for w in want if w[1] > ts(T0)] == ["B", "A"] and len(want) == 4
    for recs in (first, first, second, first + second):
        d = apply(spark, d, recs)
        assert names(d) == want


def test_late_sightings_meet_the_version_of_their_time(spark):
    d = empty_frame(spark, DIM_CUSTOMER)
    for recs in ([("C1", "A", T0)], [("C1", "B", T0 + 100)], [("C1", "A", T0 + 50), ("C1", "B", T0 + 150)]):
        d = apply(spark, d, recs)
    assert [n for n, _, _ in names(d)] == ["A", "B"]  # A was valid at 50, B at 150
    d = apply(spark, d, [("C1", "C", T0 + 70), ("C1", "A", T0 - 10)])
    assert [(n, s) for n, _, s in names(d)] == [("A", "Expired"), ("A", "Expired"), ("C", "Expired"), ("B", "Active")]
    check_intervals(rows(d))
    again = apply(spark, d, [("C1", "C", T0 + 70), ("C1", "A", T0 - 10)])
    assert names(again) == names(d)


def test_sightings_at_the_same_time(spark):
    d = apply(spark, empty_frame(spark, DIM_CUSTOMER), [("C1", "B", T0)])
    d = apply(spark, d, [("C1", "A", T0), ("C1", "A", T0)])  # appended later, so it stands behind B
    assert [(n, s) for n, _, s in names(d)] == [("B", "Expired"), ("A", "Active")]
    for recs in ([("C1", "B", T0)], [("C1", "A", T0), ("C1", "B", T0)]):
        assert names(apply(spark, d, recs)) == names(d)
    assert [n for n, _, _ in names(apply(spark, d, [("C1", "B", T0 + 5)]))] == ["B", "A", "B"]


def test_rows_without_key_or_time_are_no_sightings(spark):
    assert apply(spark, empty_frame(spark, DIM_CUSTOMER), [(None, "A", T0), ("C1", "A", None)]).count() == 0


def test_expire_closes_each_version_when_the_next_begins(spark):
    """Five versions of one key, one of another."""
    from starload.operators.dims import scd2_expire

    recs = [("C1", n, T0 + i * 10) for i, n in enumerate(["a", "b", "a", "c", "d"])] + [("C2", "x", T0)]
    d = spark.createDataFrame(
        [(i + 1, bk, nm, ts(t), None, "Active", ts(t)) for i, (bk, nm, t) in enumerate(recs)],
        "customer_id long, customer_bk string, customer_name string, row_eff_time timestamp, "
        "row_exp_time timestamp, current_row_indicator string, updated_at timestamp")
    touched = spark.createDataFrame([("C1",), ("C2",)], "customer_bk string")
    got = {r.customer_id: (r.row_exp_time, r.current_row_indicator) for r in scd2_expire(d, touched, "customer_bk", "customer_id").collect()}
    assert got == {i: (ts(T0 + i * 10), "Expired") for i in range(1, 5)} | {5: (None, "Active"), 6: (None, "Active")}
    check_intervals(rows(scd2_expire(d, touched, "customer_bk", "customer_id"), "row_eff_time"))
