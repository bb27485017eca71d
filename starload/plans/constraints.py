"""The warehouse's constraints: nine primary keys, three unique keys, eight references, and the columns that must not be null.

A store with constraints refuses a row; here they are checked over whole tables, in one pass, and violations come out as rows.
Every row yields what each rule of its table looks at (a key, a reference, the key of a row with a null), these are counted per
rule and value with partial aggregates, and one anti-join with all parents' keys finds the dangling references.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.plans.facts import CHANNEL_KEYS, DEVICE_KEYS, LOCATION_KEYS

# The constraints of the warehouse's tables.
PRIMARY = {"dim_date": "date_id", "dim_location": "location_id", "dim_customer": "customer_id", "dim_sku": "sku_id", "dim_device": "device_id",
           "dim_channel": "channel_id", "fct_sales": "line_item_id", "fct_traffic": "session_id", "fct_periodic_summary": "date_id"}
UNIQUE = {"dim_location": LOCATION_KEYS, "dim_device": DEVICE_KEYS, "dim_channel": CHANNEL_KEYS}
REFERENCES = {
    "fct_sales": {"sku_id": "dim_sku", "customer_id": "dim_customer", "location_id": "dim_location", "order_date_id": "dim_date"},
    "fct_traffic": {"channel_id": "dim_channel", "device_id": "dim_device", "visit_date_id": "dim_date"},
    "fct_periodic_summary": {"date_id": "dim_date"},
}


@dataclass(frozen=True)
class Rule:
    """``columns`` of ``table`` are a key ("primary key", "unique"), point to ``parent`` ("foreign key") or are set ("not null")."""

    kind: str
    table: str
    columns: tuple[str, ...]
    parent: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind} ({', '.join(self.columns)})" + (f" -> {self.parent}" if self.parent else "")


def warehouse_rules() -> list[Rule]:
    rules = [Rule("primary key", t, (c,)) for t, c in PRIMARY.items()]
    rules += [Rule("unique", t, tuple(cs)) for t, cs in UNIQUE.items()]
    rules += [Rule("foreign key", t, (c,), p) for t, of in REFERENCES.items() for c, p in of.items()]
    never_null = {(t, c) for t, c in PRIMARY.items()} | {(t, c) for t, of in REFERENCES.items() for c in of}
    return rules + [Rule("not null", t, (c,)) for t, c in sorted(never_null)]


def _key(columns: tuple[str, ...]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in columns])


def check_rules(tables: dict[str, DataFrame], rules: list[Rule], primary: dict[str, str]) -> DataFrame:
    """Violations (table, rule, key, n): a value that ``n`` rows of a key share, that ``n`` rows refer to in vain, or the primary key
    of ``n`` rows with a null.  Keys are written with ``|`` between columns and NULL for nulls.  In keys nulls are equal, as
    everywhere in the library; a null refers to nothing and is left to the rules of the kind "not null".  An empty result means
    that all constraints hold."""
    looked = []
    number = {r: n for n, r in enumerate(rules)}  # what is moved and counted names its rule by number
    for name, df in tables.items():
        of = [r for r in rules if r.table == name]
        what = lambda r: F.struct(F.lit(number[r]).alias("no"), _key((primary[name],) if r.kind == "not null" else r.columns).alias("key"))
        when = {"not null": lambda r: F.col(r.columns[0]).isNull(), "foreign key": lambda r: F.col(r.columns[0]).isNotNull()}
        each = [F.when(when[r.kind](r), what(r)) if r.kind in when else what(r) for r in of]
        if each:
            looked.append(df.select(F.explode(F.array(*each)).alias("x")).where("x is not null").select("x.*"))
    seen = looked[0]
    for more in looked[1:]:
        seen = seen.unionByName(more)
    counted = seen.groupBy("no", "key").agg(F.count(F.lit(1)).alias("n"))
    kind = lambda *kinds: F.col("no").isin([n for r, n in number.items() if r.kind in kinds])
    wrong = counted.where((kind("primary key", "unique") & (F.col("n") > 1)) | kind("not null"))
    references = [r for r in rules if r.kind == "foreign key" and r.table in tables]
    if references:
        parents = sorted({r.parent for r in references})
        keys = reduce(DataFrame.unionByName, [tables[p].select(F.lit(k).alias("__parent"), _key((primary[p],)).alias("__key")) for k, p in enumerate(parents)])
        to = F.coalesce(*[F.when(F.col("no") == number[r], F.lit(parents.index(r.parent))) for r in references])
        pointing = counted.where(kind("foreign key")).withColumn("__to", to)
        wrong = wrong.unionByName(pointing.join(keys, (F.col("__to") == F.col("__parent")) & (F.col("key") == F.col("__key")), "left_anti").drop("__to"))
    named = F.array(*[F.struct(F.lit(r.table).alias("table"), F.lit(r.name).alias("rule")) for r in rules])[F.col("no")]
    return wrong.select(named["table"].alias("table"), named["rule"].alias("rule"), F.array_join("key", "|", "NULL").alias("key"), "n")


def check_warehouse(tables: dict[str, DataFrame]) -> DataFrame:
    """All constraints of the warehouse over its tables, by name (see :func:`check_rules`)."""
    missing = set(PRIMARY) - set(tables)
    if missing:
        raise ValueError(f"tables missing: {sorted(missing)}")
    return check_rules({name: tables[name] for name in PRIMARY}, warehouse_rules(), PRIMARY)
