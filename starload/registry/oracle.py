"""Oracle SQL (DuckDB dialect) for every registered query.

Independent re-statements of each operator's semantics in plain SQL, starting from the same bindings
(``starload.sources.bindings``).  Window functions without partitions are fine here: the oracle runs on one
machine at a small scale factor and is only the reference the Spark code is compared against.
"""

from __future__ import annotations

from starload.plans.calendar import DEFAULT_EVENT_NAME, DEFAULT_IS_HOLIDAY
from starload.functions.ids import CROCKFORD_ALPHABET as CROCKFORD
from starload.plans.catalog import COLORS, SIZES
from starload.plans.constraints import PRIMARY, REFERENCES, UNIQUE
from starload.sources.bindings import DAY, EPOCH_BASE, sql_with

LOC = ["place", "country", "latitude", "longitude"]
SKU_ATTRS = ["product_id", "product_name", "size", "color", "price", "cogs"]


def TS(x: str) -> str:
    return f"make_timestamp(cast({x} as bigint)*1000000)"


def DID(x: str) -> str:
    return f"cast(strftime({TS(x)}, '%Y%m%d') as int)"


def _nsafe(a: str, b: str, cols, cols_b=None) -> str:
    cols_b = cols_b or cols
    return " and ".join(f"{a}.{x} is not distinct from {b}.{y}" for x, y in zip(cols, cols_b))


def _order(cols) -> str:
    return ", ".join(f"{c} nulls first" for c in cols)


class Sql:
    """Accumulates named CTEs after the binding prefix."""

    def __init__(self):
        self.ctes: list[str] = []
        self.names: set[str] = set()

    def add(self, name: str, body: str) -> str:
        if name not in self.names:
            self.ctes.append(f"{name} as ({body})")
            self.names.add(name)
        return name

    def render(self, final: str) -> str:
        return sql_with(*self.ctes) + final


EMPTY = {
    "dim_location": "select cast(null as bigint) location_id, cast(null as varchar) country, cast(null as varchar) "
                    "place, cast(null as decimal(12,5)) longitude, cast(null as decimal(12,5)) latitude where false",
    "dim_device": "select cast(null as bigint) device_id, cast(null as varchar) device_name, cast(null as varchar) os,"
                  " cast(null as varchar) browser where false",
    "dim_channel": "select cast(null as bigint) channel_id, cast(null as varchar) traffic_source, "
                   "cast(null as varchar) referral_source where false",
    "dim_customer": "select cast(null as bigint) customer_id, cast(null as varchar) customer_bk, "
                    "cast(null as varchar) customer_name, cast(null as timestamp) row_eff_time, "
                    "cast(null as timestamp) row_exp_time, cast(null as varchar) current_row_indicator, "
                    "cast(null as timestamp) updated_at where false",
    "dim_sku": "select cast(null as bigint) sku_id, cast(null as varchar) sku_bk, cast(null as varchar) product_id, "
               "cast(null as varchar) product_name, cast(null as varchar) size, cast(null as varchar) color, "
               "cast(null as decimal(12,2)) price, cast(null as decimal(12,2)) cogs, "
               "cast(null as timestamp) row_eff_time, cast(null as timestamp) row_exp_time, "
               "cast(null as varchar) current_row_indicator, cast(null as timestamp) updated_at where false",
}


def empty(q: Sql, kind: str) -> str:
    return q.add(f"empty_{kind}", EMPTY[kind])


# ------------------------------------------------------------------------------------------ dimensions

def insert_ignore(q: Sql, name: str, prev: str, src: str, keys, sk: str, src_keys=None) -> str:
    src_keys = src_keys or keys
    sel = ", ".join(f"{s} as {k}" for s, k in zip(src_keys, keys))
    q.add(f"{name}_c", f"select distinct {sel} from {src}")
    q.add(f"{name}_n", f"select c.* from {name}_c c where not exists (select 1 from {prev} p where "
                       f"{_nsafe('p', 'c', keys)})")
    k = ", ".join(keys)
    return q.add(name, f"select {sk}, {k} from {prev} union all select (select coalesce(max({sk}),0) from {prev}) "
                       f"+ row_number() over (order by {_order(keys)}) as {sk}, {k} from {name}_n")


def scd2(q: Sql, name: str, prev: str, src: str, src_bk: str, src_attrs, bk: str, attrs, sk: str,
         compare="history", eff="min", recompute=True) -> str:
    a_sel = ", ".join(f"{s} as {a}" for s, a in zip(src_attrs, attrs))
    cols = ", ".join(attrs)
    if compare == "history":
        q.add(f"{name}_cand", f"select distinct {src_bk} as {bk}, {a_sel}, {TS('updated_at')} as row_eff_time from {src} "
                              f"where {src_bk} is not null and updated_at is not null")
        q.add(f"{name}_ev", f"select {bk}, {cols}, row_eff_time, max(seq) seq from (select {bk}, {cols}, row_eff_time, {sk} seq from {prev} "
                            f"union all select {bk}, {cols}, row_eff_time, null from {name}_cand) group by all")
        q.add(f"{name}_new", f"select {bk}, {cols}, row_eff_time from {name}_ev "
                             f"window w as (partition by {bk} order by row_eff_time, seq is null, seq, {_order(attrs)}) qualify "
                             f"seq is null and (row_number() over w = 1 or row({cols}) is distinct from lag(row({cols})) over w)")
    else:
        q.add(f"{name}_cand", f"select {src_bk} as {bk}, {a_sel}, {TS(f'{eff}(updated_at)')} as row_eff_time "
                              f"from {src} group by all")
        vers = prev if compare == "all" else f"(select * from {prev} where current_row_indicator = 'Active')"
        differs = " or ".join(f"c.{a} is distinct from v.{a}" for a in attrs)
        q.add(f"{name}_new", f"select distinct c.* from {name}_cand c left join {vers} v on c.{bk} = v.{bk} "
                             f"where v.{bk} is null or {differs}")
    q.add(f"{name}_k", f"select (select coalesce(max({sk}),0) from {prev}) + row_number() over (order by "
                       f"{_order([bk, 'row_eff_time', *attrs])}) as {sk}, * from {name}_new")
    q.add(f"{name}_all", f"select {sk}, {bk}, {cols}, row_eff_time, row_exp_time, current_row_indicator, updated_at "
                         f"from {prev} union all select {sk}, {bk}, {cols}, row_eff_time, cast(null as timestamp), "
                         f"'Active', row_eff_time from {name}_k")
    touched = f"select distinct {bk} from {name}_k" if recompute else f"select distinct {src_bk} as {bk} from {src}"
    q.add(f"{name}_t", touched)
    q.add(f"{name}_l", f"select *, lag(row_eff_time) over (partition by {bk} order by row_eff_time desc, {sk} desc) "
                       f"as nxt, coalesce({bk} in (select {bk} from {name}_t), false) as hit from {name}_all")
    if recompute:
        exp = "case when not hit then row_exp_time else nxt end"
        ind = ("case when not hit then current_row_indicator when nxt is null then 'Active' else 'Expired' end")
    else:
        close = "hit and row_exp_time is null and nxt is not null"
        exp = f"case when {close} then nxt else row_exp_time end"
        ind = f"case when {close} then 'Expired' else current_row_indicator end"
    return q.add(name, f"select {sk}, {bk}, {cols}, row_eff_time, {exp} as row_exp_time, "
                       f"{ind} as current_row_indicator, updated_at from {name}_l")


def customer(q: Sql, name: str, prev: str | None, src: str, **kw) -> str:
    return scd2(q, name, prev or empty(q, "dim_customer"), src, "customer_id", ["name"], "customer_bk",
                ["customer_name"], "customer_id", **kw)


def sku(q: Sql, name: str, prev: str | None, src: str, **kw) -> str:
    return scd2(q, name, prev or empty(q, "dim_sku"), src, "sku_id", SKU_ATTRS, "sku_bk", SKU_ATTRS, "sku_id", **kw)


def location(q: Sql, name: str, prev: str | None, src: str) -> str:
    return insert_ignore(q, name, prev or empty(q, "dim_location"), src, LOC, "location_id")


def device(q: Sql, name: str, prev: str | None, src: str) -> str:
    return insert_ignore(q, name, prev or empty(q, "dim_device"), src, ["device_name", "os", "browser"],
                         "device_id", ["device", "os", "browser"])


def channel(q: Sql, name: str, prev: str | None, src: str) -> str:
    return insert_ignore(q, name, prev or empty(q, "dim_channel"), src, ["traffic_source", "referral_source"],
                         "channel_id")


# ------------------------------------------------------------------------------------------------ facts

def fct_sales(q: Sql, name: str, src: str, loc: str, cust: str, skud: str, mode="active") -> tuple[str, str]:
    q.add(f"{name}_s", f"select * from {src} qualify row_number() over (partition by line_item_id "
                       f"order by updated_at desc) = 1")
    if mode == "active":
        cj = (f"left join (select * from {cust} where current_row_indicator = 'Active') c on "
              f"s.customer_id is not distinct from c.customer_bk and s.name is not distinct from c.customer_name")
        kj = (f"left join (select * from {skud} where current_row_indicator = 'Active') k on "
              f"{_nsafe('s', 'k', ['sku_id', *SKU_ATTRS], ['sku_bk', *SKU_ATTRS])}")
    else:
        t = TS("s.order_time")
        cj = (f"left join (select *, case when row_eff_time = min(row_eff_time) over (partition by customer_bk) "
              f"then null else row_eff_time end vf from {cust}) c on s.customer_id = c.customer_bk and "
              f"(c.vf is null or c.vf <= {t}) and (c.row_exp_time is null or {t} < c.row_exp_time)")
        kj = (f"left join (select *, case when row_eff_time = min(row_eff_time) over (partition by sku_bk) "
              f"then null else row_eff_time end vf from {skud}) k on s.sku_id = k.sku_bk and "
              f"(k.vf is null or k.vf <= {t}) and (k.row_exp_time is null or {t} < k.row_exp_time)")
    q.add(f"{name}_f", f"""select s.line_item_id, s.order_id, k.sku_id, c.customer_id, l.location_id,
        {DID('s.order_time')} order_date_id, {TS('s.order_time')} order_time, s.quantity,
        cast(s.price*s.quantity as decimal(18,2)) revenue, cast((s.price-s.cogs)*s.quantity as decimal(18,2))
        gross_profit, {TS('s.updated_at')} created_at, {TS('s.updated_at')} updated_at
        from {name}_s s left join {loc} l on {_nsafe('s', 'l', LOC)} {cj} {kj}""")
    ok = "sku_id is not null and customer_id is not null and location_id is not null"
    good = q.add(name, f"select * from {name}_f where {ok}")
    bad = q.add(f"{name}_bad", f"select * from {name}_f where not ({ok})")
    return good, bad


def fct_traffic(q: Sql, name: str, src: str, chn: str, dev: str) -> str:
    q.add(f"{name}_s", f"select * from {src} qualify row_number() over (partition by session_id "
                       f"order by visit_time desc) = 1")
    q.add(f"{name}_f", f"""select s.session_id, c.channel_id, d.device_id, {DID('s.visit_time')} visit_date_id,
        {TS('s.visit_time')} visit_time, s.page_views, cast(s.session_duration as decimal(18,2)) session_duration,
        s.clicks, s.transactions, {TS('s.visit_time')} created_at, {TS('s.visit_time')} updated_at
        from {name}_s s
        left join {chn} c on {_nsafe('s', 'c', ['traffic_source', 'referral_source'])}
        left join {dev} d on {_nsafe('s', 'd', ['device', 'os', 'browser'], ['device_name', 'os', 'browser'])}""")
    return q.add(name, f"select * from {name}_f where channel_id is not null and device_id is not null")


SALES_COLS = ["line_item_id", "order_id", "sku_id", "customer_id", "location_id", "order_date_id", "order_time",
              "quantity", "revenue", "gross_profit", "created_at", "updated_at"]
TRAFFIC_COLS = ["session_id", "channel_id", "device_id", "visit_date_id", "visit_time", "page_views",
                "session_duration", "clicks", "transactions", "created_at", "updated_at"]
SUMMARY_COLS = ["date_id", "unique_orders", "unique_customers", "quantity", "revenue", "gross_profit",
                "page_views", "num_sessions", "session_duration", "clicks", "transactions"]


def merge(q: Sql, name: str, target: str, src: str, keys, cols, preserve=()) -> str:
    on = " and ".join(f"s.{k} = t.{k}" for k in keys)
    sel = []
    for c in cols:
        if c in preserve:
            sel.append(f"case when t.__in then t.{c} else s.{c} end as {c}")
        else:
            sel.append(f"case when s.__in then s.{c} else t.{c} end as {c}")
    return q.add(name, f"select {', '.join(sel)} from (select *, true as __in from {src}) s full outer join "
                       f"(select *, true as __in from {target}) t on {on}")


def summary(q: Sql, name: str, sales: str, traffic: str, dates: str, cust: str) -> str:
    q.add(f"{name}_s", f"""select f.order_date_id date_id, count(distinct f.order_id) unique_orders,
        count(distinct c.customer_bk) unique_customers, cast(sum(f.quantity) as bigint) quantity,
        cast(sum(f.revenue) as decimal(18,2)) revenue, cast(sum(f.gross_profit) as decimal(18,2)) gross_profit
        from {sales} f left join {cust} c on f.customer_id = c.customer_id
        where f.order_date_id in (select date_id from {dates}) group by 1""")
    q.add(f"{name}_t", f"""select visit_date_id date_id, cast(sum(page_views) as bigint) page_views,
        count(distinct session_id) num_sessions, cast(sum(session_duration) as decimal(18,2)) session_duration,
        cast(sum(clicks) as bigint) clicks, cast(sum(transactions) as bigint) transactions
        from {traffic} where visit_date_id in (select date_id from {dates}) group by 1""")
    return q.add(name, f"""select s.date_id, s.unique_orders, s.unique_customers, s.quantity, s.revenue,
        s.gross_profit, t.page_views, coalesce(t.num_sessions, 0) num_sessions, t.session_duration, t.clicks,
        t.transactions from {name}_s s left join {name}_t t on s.date_id = t.date_id""")


def dates_of(q: Sql, name: str, src: str, col: str) -> str:
    return q.add(name, f"select distinct {DID(col)} as date_id from {src}")


def warehouse(q: Sql, prefix: str, prev: dict | None, orders: str, traffic: str) -> dict:
    """One batch (the SQL twin of ``run_batch``).  Returns CTE names of the new state."""
    p = prev or {}
    w = {
        "loc": location(q, f"{prefix}_loc", p.get("loc"), orders),
        "cust": customer(q, f"{prefix}_cust", p.get("cust"), orders),
        "sku": sku(q, f"{prefix}_sku", p.get("sku"), orders),
        "dev": device(q, f"{prefix}_dev", p.get("dev"), traffic),
        "chn": channel(q, f"{prefix}_chn", p.get("chn"), traffic),
    }
    s_new, _ = fct_sales(q, f"{prefix}_fs_new", orders, w["loc"], w["cust"], w["sku"])
    t_new = fct_traffic(q, f"{prefix}_ft_new", traffic, w["chn"], w["dev"])
    if prev:
        w["fs"] = merge(q, f"{prefix}_fs", p["fs"], s_new, ["line_item_id"], SALES_COLS, ["created_at"])
        w["ft"] = merge(q, f"{prefix}_ft", p["ft"], t_new, ["session_id"], TRAFFIC_COLS, ["created_at"])
    else:
        w["fs"], w["ft"] = s_new, t_new
    d = dates_of(q, f"{prefix}_dates", orders, "order_time")
    s = summary(q, f"{prefix}_sum_new", w["fs"], w["ft"], d, w["cust"])
    w["sum"] = merge(q, f"{prefix}_sum", p["sum"], s, ["date_id"], SUMMARY_COLS) if prev else s
    return w


# ------------------------------------------------------------------------------------------------ queries

def _sel(name: str, cols=None) -> str:
    return f"select {', '.join(cols) if cols else '*'} from {name}"


STG_COLS = ["line_item_id", "order_id", "sku_id", "product_id", "product_name", "size", "color", "price", "cogs",
            "quantity", "customer_id", "name", "country", "place", "latitude", "longitude", "order_time",
            "updated_at"]
WINDOW = 4 * 3600


def batch_key_sql(epoch: str) -> str:
    return f"strftime({TS(f'({epoch} // {WINDOW}) * {WINDOW}')}, '%Y%m%d%H%M')"


def queries() -> dict[str, str]:
    out: dict[str, str] = {}

    q = Sql()
    w = warehouse(q, "w", None, "stg_orders", "stg_traffic")
    out["daily_revenue_by_country"] = q.render(f"""select f.order_date_id date_id, l.country,
        count(*) lines, cast(sum(f.quantity) as bigint) quantity, cast(sum(f.revenue) as decimal(18,2)) revenue
        from {w['fs']} f join {w['loc']} l on f.location_id = l.location_id group by 1, 2""")

    out["ingest_orders"] = sql_with() + _sel("stg_orders")
    out["explode_items"] = sql_with() + _sel("stg_orders")
    out["landing_roundtrip"] = sql_with() + f"select *, {batch_key_sql('order_time')} as batch from stg_orders"
    out["ingest_traffic"] = sql_with() + _sel("stg_traffic")
    out["nest_orders"] = sql_with() + """select order_id, max(customer_id) customer_id, max(order_time) order_time,
        max(updated_at) updated_at, count(*) n_items, cast(sum(quantity) as bigint) quantity,
        string_agg(line_item_id, ',' order by line_item_id) line_item_ids from stg_orders group by order_id"""
    out["validate_orders"] = sql_with() + """select order_id,
        not (cast(order_id as bigint) % 97 = 0 or cast(order_id as bigint) % 89 = 0
             or cast(order_id as bigint) % 83 = 0) as is_valid,
        concat_ws('; ',
          case when cast(order_id as bigint) % 97 = 0 then 'missing customer_id' end,
          case when cast(order_id as bigint) % 83 = 0 then 'bad order_time' end,
          case when cast(order_id as bigint) % 89 = 0 then 'bad item field' end) as reason
        from (select distinct order_id from stg_orders)"""
    out["diagonal_union"] = sql_with() + """select * from orders_b1 union all by name
        select * exclude (name, latitude, longitude, place, country) from stg_orders_b2"""
    out["batch_window"] = sql_with() + f"""select {batch_key_sql('visit_time')} batch,
        {TS(f'(visit_time // {WINDOW}) * {WINDOW}')} window_start, count(*) sessions,
        cast(sum(page_views) as bigint) page_views from stg_traffic group by 1, 2"""

    cal_cols = """cast(strftime(d, '%Y%m%d') as int) as date_id, d as date,
        strftime(d, '%A, %-d %B %Y') as full_date_description, cast(year(d) as smallint) as "year",
        cast(quarter(d) as smallint) as "quarter", cast(month(d) as smallint) as "month",
        cast(day(d) as smallint) as "day", cast(isodow(d) as smallint) as day_of_week,
        strftime(d, '%A') as calendar_day_of_week, strftime(d, '%B') as calendar_month,
        case when isodow(d) in (6, 7) then 'Weekend' else 'Weekday' end as is_weekend"""
    sentinels = """union all select -1, null, 'Not Entered', null, null, null, null, null, null, null, null, null, null
        union all select -2, null, 'Error', null, null, null, null, null, null, null, null, null, null"""
    out["dim_date"] = sql_with() + f"""select {cal_cols}, '{DEFAULT_EVENT_NAME}' event_name,
        '{DEFAULT_IS_HOLIDAY}' is_holiday
        from (select cast(unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)),
              interval 1 day)) as date) d from orders) {sentinels}"""
    out["date_functions"] = sql_with() + f"""select event_id, {cal_cols.replace(' d as date,', '')}
        from (select event_id, cast(ts as date) d from events)"""
    out["dim_date_holidays"] = sql_with() + f"""select c.date_id, c.date, c.full_date_description, c.year, c.quarter,
        c.month, c.day, c.day_of_week, c.calendar_day_of_week, c.calendar_month, c.is_weekend,
        case when h.date_id is null then c.event_name else h.event_name end event_name,
        case when h.date_id is null then c.is_holiday else h.is_holiday end is_holiday
        from (select {cal_cols}, '{DEFAULT_EVENT_NAME}' event_name, '{DEFAULT_IS_HOLIDAY}' is_holiday
              from (select cast(unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)), interval 1 day))
                    as date) d from events) {sentinels}) c
        left join (select date_id, arg_min(event_name, r) event_name, arg_min(is_holiday, r) is_holiday from (
            select cast(replace(strftime(cast(ts as date), '%Y-%m-%d'), '-', '') as int) date_id,
              event_type event_name,
              case when event_type = 'purchase' then 'Holiday' else 'Non-Holiday' end is_holiday,
              (case when event_type = 'purchase' then 0 else 1 end, event_type) r
            from events) group by date_id) h on c.date_id = h.date_id"""

    q = Sql()
    l1 = location(q, "l1", None, "orders_b1")
    out["dim_location"] = q.render(_sel(location(q, "l2", l1, "stg_orders_b2")))
    q = Sql()
    d1 = device(q, "d1", None, "traffic_b1")
    out["dim_device"] = q.render(_sel(device(q, "d2", d1, "traffic_b2")))
    q = Sql()
    c1 = channel(q, "c1", None, "traffic_b1")
    out["dim_channel"] = q.render(_sel(channel(q, "c2", c1, "traffic_b2")))
    out["surrogate_keys"] = sql_with() + ("select line_item_id, row_number() over (order by line_item_id) sk "
                                          "from stg_orders")

    for kind, fn in (("customer", customer), ("sku", sku)):
        sfx = "" if kind == "customer" else "_sku"
        q = Sql()
        v1 = fn(q, "v1", None, "orders_b1")
        v2 = fn(q, "v2", v1, "stg_orders_b2")
        bk = "customer_bk" if kind == "customer" else "sku_bk"
        out[f"scd2_changes_{kind}"] = q.render("select *, cast(null as timestamp) row_exp_time, 'Active' "
                                                "current_row_indicator, row_eff_time updated_at from v2_new")
        out[f"scd2_{kind}"] = q.render(_sel(v2))
        out[f"scd2_expire{sfx}"] = q.render(f"select * from {v2} where {bk} in (select {bk} from v2_t)")

    q = Sql()
    q.add("wavering", f"select * replace (name || case when (order_time - {EPOCH_BASE}) // {5 * DAY} % 2 = 1 then ' v2' else '' end as name) from stg_orders")
    out["scd2_runs_customer"] = q.render(_sel(customer(q, "v1", None, "wavering")))
    q = Sql()
    q.add("wavering", f"select * replace (name || case when (order_time - {EPOCH_BASE}) // {5 * DAY} % 2 = 1 then ' v2' else '' end as name) from stg_orders")
    now: dict = {}
    pending = None
    for k in range(3):
        b = q.add(f"q{k}_b", f"select * from wavering where (order_time - {EPOCH_BASE}) // {10 * DAY} = {k}")
        lines = q.add(f"q{k}_lines", f"select *, 0 as attempts from {b}" + (f" union all select * from {pending}" if pending else ""))
        now |= {"loc": location(q, f"q{k}_loc", now.get("loc"), b), "cust": customer(q, f"q{k}_cust", now.get("cust"), b), "sku": sku(q, f"q{k}_sku", now.get("sku"), b)}
        good, bad = fct_sales(q, f"q{k}_f", lines, now["loc"], now["cust"], now["sku"])
        pending = q.add(f"q{k}_p", f"select * replace (attempts + 1 as attempts) from {lines} where line_item_id in (select line_item_id from {bad})")
        now["fs"] = merge(q, f"q{k}_fs", now["fs"], good, ["line_item_id"], SALES_COLS, ["created_at"]) if k else good
    out["quarantine_retry"] = q.render(f"""select line_item_id, customer_id, cast(null as varchar) reason, cast(null as int) attempts from {now['fs']}
        union all select p.line_item_id, null, concat_ws('; ', case when b.sku_id is null then 'no SKU version' end,
          case when b.customer_id is null then 'no customer version' end, case when b.location_id is null then 'no location' end), p.attempts
        from {pending} p join {bad} b using (line_item_id)""")
    q = Sql()
    q.add("late_orders", f"select * replace (cast(price * 1.25 as decimal(12,2)) as price, updated_at + {DAY // 2} as updated_at) "
                         f"from stg_orders where (order_time - {EPOCH_BASE}) // {DAY} % 10 = 3")
    v2 = sku(q, "v2", sku(q, "v1", None, "orders_b1"), "stg_orders_b2")
    out["scd2_replay_sku"] = q.render(_sel(sku(q, "v3", v2, "late_orders")))  # batches that come again leave no trace

    q = Sql()
    kw = dict(compare="all", eff="max", recompute=False)
    p1 = customer(q, "p1", None, "orders_b1", **kw)
    p2 = customer(q, "p2", p1, "stg_orders_b2", **kw)
    out["scd2_parity_all_versions"] = q.render(_sel(customer(q, "p3", p2, "stg_orders_b2", **kw)))

    q = Sql()
    w1 = warehouse(q, "w1", None, "orders_b1", "traffic_b1")
    _, bad = fct_sales(q, "u", "stg_orders_b2", w1["loc"], w1["cust"], w1["sku"])
    out["unresolved_keys"] = q.render(f"""select line_item_id, order_id, sku_id is null missing_sku_id,
        customer_id is null missing_customer_id, location_id is null missing_location_id from {bad}""")
    out["check_not_null"] = q.render("""select line_item_id, sku_id, customer_id, location_id from u_f
        where sku_id is null or customer_id is null or location_id is null""")
    w2 = warehouse(q, "w2", w1, "stg_orders_b2", "traffic_b2")
    out["merge_sales"] = q.render(_sel(w2["fs"]))
    out["merge_traffic"] = q.render(_sel(w2["ft"]))
    out["merge_summary"] = q.render(_sel(w2["sum"]))
    q.add("both_batches", "select * from orders_b1 union all by name select * from stg_orders_b2")
    asof, _ = fct_sales(q, "sales_asof", "both_batches", w2["loc"], w2["cust"], w2["sku"], mode="asof")
    out["fct_sales_asof"] = q.render(_sel(asof))
    out["check_foreign_key"] = q.render(f"""select f.* from {w1['fs']} f where f.customer_id is not null and
        not exists (select 1 from (select * from {w2['cust']} where current_row_indicator = 'Active') c
                    where c.customer_id = f.customer_id)""")
    out["touched_dates"] = sql_with() + f"select distinct {DID('order_time')} date_id from stg_orders"

    q = Sql()
    w = warehouse(q, "w", None, "stg_orders", "stg_traffic")
    out["fct_sales"] = q.render(_sel(w["fs"]))
    out["fct_traffic"] = q.render(_sel(w["ft"]))
    out["periodic_summary"] = q.render(_sel(w["sum"]))
    out["periodic_summary_parity"] = q.render(f"""select date_id, count(distinct order_id) unique_orders,
            count(distinct customer_id) unique_customers, count(distinct session_id) num_sessions,
            {', '.join(f"cast(round(sum({m})) as decimal(38,0)) {m}" for m in
                ('quantity', 'revenue', 'gross_profit', 'page_views', 'session_duration', 'clicks', 'transactions'))}
        from (select line.*, cast(strftime(order_time, '%Y%m%d') as int) as date_id from {w['fs']} line) of_day
        left join (select cast(strftime({TS('visit_time')}, '%Y%m%d') as int) as date_id, session_id, page_views,
                   session_duration, clicks, transactions from stg_traffic) visits using (date_id)
        where date_id in (select {DID('order_time')} from stg_orders)  -- lines of a day are paired with its sessions
        group by date_id""")

    out["summary_deltas"] = sql_with() + f"""select s.*, page_views, coalesce(num_sessions, 0) num_sessions, session_duration, clicks, transactions from (
          select {DID('seen')} date_id, count(distinct order_id) unique_orders, count(distinct customer_id) unique_customers, cast(sum(q) as bigint) quantity,
            cast(sum(price * q) as decimal(18,2)) revenue, cast(sum((price - cogs) * q) as decimal(18,2)) gross_profit
          from (select *, cast(order_id as bigint) % 3 = 0 and (order_time - {EPOCH_BASE}) // {6 * DAY} < 4 as again,
                  order_time + case when again then {DAY} else 0 end as seen, quantity + case when again then 1 else 0 end as q from stg_orders) group by 1) s
        left join (select {DID('visit_time')} date_id, cast(sum(page_views) as bigint) page_views, count(*) num_sessions,
            cast(sum(session_duration) as decimal(18,2)) session_duration, cast(sum(clicks) as bigint) clicks, cast(sum(transactions) as bigint) transactions
          from stg_traffic where (visit_time - {EPOCH_BASE}) // {6 * DAY} between 0 and 4 group by 1) using (date_id)"""

    faulty = {
        "dim_date": "select cast(strftime(d, '%Y%m%d') as int) date_id from range(date '2024-01-01', date '2024-01-21', interval 1 day) t(d) union all values (-1), (-2)",
        "dim_location": f"select * from {w['loc']} union all select * replace (-3 as location_id) from {w['loc']} where location_id = 3",
        "dim_customer": f"select * replace (case when customer_id % 211 <> 0 then customer_id end as customer_id) from {w['cust']}",
        "dim_sku": f"select * from {w['sku']} where sku_id % 97 <> 0",
        "dim_device": f"select device_id, case when device_id > 2 then device_name end device_name, case when device_id > 2 then os end os, "
                      f"case when device_id > 2 then browser end browser from {w['dev']}",
        "dim_channel": f"select * from {w['chn']} union all select * from {w['chn']} where channel_id = 1",
        "fct_sales": f"select * replace (case when cast(order_id as bigint) % 103 <> 0 then customer_id end as customer_id) from {w['fs']} f, "
                     f"lateral (select unnest(range(case when cast(order_id as bigint) % 101 = 0 then 2 else 1 end)) copy)",
        "fct_traffic": f"select * replace (case when cast(session_id as bigint) % 107 <> 0 then device_id end as device_id) from {w['ft']} f, "
                       f"lateral (select unnest(range(case when cast(session_id as bigint) % 109 = 0 then 2 else 1 end)) copy)",
        "fct_periodic_summary": f"select * from {w['sum']} union all select * from {w['sum']} where date_id % 10 = 4",
    }
    for t, body in faulty.items():
        q.add(f"x_{t}", body)
    text = lambda cols: " || '|' || ".join(f"coalesce(cast({c} as varchar), 'NULL')" for c in cols)
    found = []
    for t, cols in [(t, [c]) for t, c in PRIMARY.items()] + list(UNIQUE.items()):
        kind = "primary key" if [PRIMARY[t]] == cols else "unique"
        found.append(f"select '{t}' as \"table\", '{kind} ({', '.join(cols)})' as rule, {text(cols)} as key, count(*) n from x_{t} group by {', '.join(cols)} having count(*) > 1")
    for t, of in REFERENCES.items():
        for c, parent in of.items():
            found.append(f"select '{t}', 'foreign key ({c}) -> {parent}', cast({c} as varchar), count(*) from x_{t} f where {c} is not null and "
                         f"not exists (select 1 from x_{parent} p where p.{PRIMARY[parent]} = f.{c}) group by {c}")
    for t, cs in {t: {c, *REFERENCES.get(t, {})} for t, c in PRIMARY.items()}.items():
        found += [f"select '{t}', 'not null ({c})', coalesce(cast({PRIMARY[t]} as varchar), 'NULL'), count(*) from x_{t} where {c} is null group by {PRIMARY[t]}" for c in sorted(cs)]
    out["check_warehouse"] = q.render(" union all ".join(found))
    out["check_accepted_values"] = sql_with() + "select session_id, traffic_source from stg_traffic where traffic_source not in ('Organic', 'Paid')"
    out["batch_window_rows"] = sql_with() + f"""select session_id, visit_time,
        cast((visit_time - (select cast(epoch(min(cast(cast(ts as date) as timestamp))) as bigint) from events)) // {5 * DAY} as int) window_no from stg_traffic"""

    sizes = " union all ".join(f"select {i} si, '{s}' size, cast('{a}' as decimal(4,2)) adj"
                               for i, (s, a) in enumerate(SIZES))
    colors = " union all ".join(f"select {i} ci, '{c}' color" for i, c in enumerate(COLORS))
    out["sku_catalog"] = sql_with() + f"""select
        'SKU-' || lpad(cast(row_number() over (order by p.pno, s.si, c.ci) - 1 as varchar), greatest(4, length(cast(row_number() over (order by p.pno, s.si, c.ci) - 1 as varchar)))::int, '0') sku_id,
        'P-' || lpad(cast(p.pno - 1 as varchar), greatest(4, length(cast(p.pno - 1 as varchar)))::int, '0') product_id, p.product_name, s.size, c.color,
        cast(round(p.base_price + s.adj, 2) as decimal(12,2)) price,
        cast(round(p.base_price * 0.6, 2) as decimal(12,2)) cogs
        from (select product_name, base_price, row_number() over (order by product_name) pno from
              (select p_brand product_name, cast(min(p_retailprice) as decimal(12,2)) base_price from part group by 1)) p
        cross join ({sizes}) s cross join ({colors}) c"""
    out["random_sample"] = sql_with() + """select c_custkey, c_name, c_nationkey from customer
        order by md5(cast(c_custkey as varchar) || '42'), c_custkey limit 100"""
    swap = """(x % side) * side + (x // side + ('0x' || substr(md5((x % side)::varchar || '-' || i::varchar || '-' || key), 1, 15))::bigint % side) % side"""
    out["sample_per_group"] = sql_with() + f""", items as (select p_partkey, p_name, row_number() over (order by p_partkey) - 1 pos from part),
        n as (select count(*) m, cast(floor(sqrt(count(*) - 1)) as bigint) + 1 side from items),
        g as (select o_orderkey, least(n, m) k, o_orderkey::varchar || '-7' as key, m, side
              from (select l_orderkey o_orderkey, count(*) n from lineitem group by 1), n),
        p as (select g.*, cast(i + 1 as int) pick, i as first from g, lateral (select unnest(range(k)) i)),
        at0 as (select *, list_reduce(list_prepend(first, range(1, 7)), lambda x, i: {swap}) as pos from p)"""
    for step in range(12):  # positions outside the items are permuted again
        out["sample_per_group"] += f""", at{step + 1} as (select * replace (case when pos < m then pos else
          list_reduce(list_prepend(pos, range(1, 7)), lambda x, i: {swap}) end as pos) from at{step})"""
    out["sample_per_group"] += " select o_orderkey, pick, p_partkey, p_name from at12 join items using (pos)"
    out["sample_table"] = out["random_sample"]
    digits = " || ".join(f"substr('{CROCKFORD}', cast((ms // {32 ** (9 - i)}) % 32 as int) + 1, 1)"
                         for i in range(10))
    out["time_ordered_id"] = sql_with() + f"""select line_item_id, {digits} || upper(substr(md5(line_item_id), 1, 16))
        as tid from (select line_item_id, cast(order_time as bigint) * 1000 ms from stg_orders)"""
    out["stream_ingest"] = sql_with() + _sel("stg_traffic")
    out["stream_ingest_orders"] = sql_with() + _sel("stg_orders")
    out["stream_triggers"] = sql_with() + """select session_id, page_views, cast(null as varchar) reason, cast(1 as bigint) n from traffic_b2
          where cast(session_id as bigint) % 97 <> 0
        union all select session_id, page_views, null, 1 from traffic_b1
          where session_id not in (select session_id from traffic_b2 where cast(session_id as bigint) % 97 <> 0)
        union all select session_id, null, 'bad page_views', 1 from traffic_b2 where cast(session_id as bigint) % 97 = 0"""
    out["check_unique"] = sql_with() + """select order_id, sku_id, count(*) n from stg_orders
        group by 1, 2 having count(*) > 1"""
    return out
