import datetime as dt

from starload.plans.calendar import apply_holidays, build_dim_date
from starload.plans.catalog import build_sku_catalog


def test_holidays_holiday_wins_and_blank_matches_nothing(spark):
    cal = build_dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    ev = spark.createDataFrame([("2024-01-02", "Zeta", True), ("2024-01-02", "Alpha", False),
                                ("2024-01-03", "Bday", False), ("", "Blank", True)],
                               "event_date string, event_name string, is_national_holiday boolean")
    out = {r.date_id: r for r in apply_holidays(cal, ev).collect()}
    assert (out[20240102].event_name, out[20240102].is_holiday) == ("Zeta", "Holiday")
    assert (out[20240103].event_name, out[20240103].is_holiday) == ("Bday", "Non-Holiday")
    assert (out[20240101].event_name, out[20240101].is_holiday) == ("-", "Non-Holiday")
    assert len(out) == 3 + 2


def test_catalogue_four_products(spark):
    # the original catalogue: four products with base prices 14.99, 19.99, 24.99, 26.99
    p = spark.createDataFrame([("Product A", 14.99), ("Product B", 19.99), ("Product C", 24.99),
                               ("Product D", 26.99)], "product_name string, base_price double")
    c = build_sku_catalog(p)
    r = sorted(c.collect(), key=lambda x: x.sku_id)
    assert len(r) == 64
    assert (r[0].sku_id, r[0].product_id, r[0].size, r[0].color) == ("SKU-0000", "P-0000", "S", "Black")
    assert str(r[0].price) == "12.99" and str(r[0].cogs) == "8.99"
    assert (r[-1].sku_id, r[-1].product_id, r[-1].size, r[-1].color, str(r[-1].price)) == \
        ("SKU-0063", "P-0003", "XL", "Pink", "28.99")
