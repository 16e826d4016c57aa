"""Queries: parent rules, keyed writes, latest flags and constraint checks.

Orders stand for stored and submitted rows: finished and pending orders (F, P) are stored, open and
pending ones (O, P) are submitted, so pending orders are on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.catalog.base import Tables, ntz, query
from pulsemill.operators import audit, constraints, frames, merge, parents, sleep
from pulsemill.schema import APPEND, Table

KEY = ["o_orderkey"]
BY_TIME = ["o_orderdate", "o_orderkey"]
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _stored(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus <> 'O'")


def _submitted(t: Tables) -> DataFrame:
    """Submitted rows have a raised price and a new priority."""
    return t.orders.filter("o_orderstatus <> 'F'").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 100, "o_orderpriority": F.lit("new")}
    )


_SIDES = """
stored as (select * from orders where o_orderstatus <> 'O'),
submitted as (select * replace (o_totalprice + 100 as o_totalprice, 'new' as o_orderpriority)
  from orders where o_orderstatus <> 'F'),
old as (select * from stored qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1),
first_new as (select * from submitted
  qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1),
last_new as (select * from submitted
  qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
"""


def _one_per_customer(t: Tables) -> DataFrame:
    """A stored table with one row per customer, their first stored order."""
    return merge.first_per_key(_stored(t), ["o_custkey"], BY_TIME)


# Parent rows.


@query("""
select l_orderkey, l_linenumber, l_suppkey from lineitem
where l_linenumber in (6, 7) or l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'P')
""")
def filter_existing_parent(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_orderkey").alias("activity_id"), "l_linenumber", "l_suppkey", "l_partkey")
    stored = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("activity_id"))
    kept = parents.filter_existing_parent(rows, stored, "activity_id", F.col("l_linenumber").isin(6, 7))
    return kept.select(F.col("activity_id").alias("l_orderkey"), "l_linenumber", "l_suppkey")


def _line_frames(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("activity_id"), F.col("l_partkey").alias("frame_seq"), "l_linenumber"
    )


@query("""
select l_orderkey as activity_id, l_partkey as frame_seq, l_linenumber from lineitem
where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')
""")
def require_parent_or_fail(t: Tables) -> DataFrame:
    stored = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("activity_id"))
    return frames.require_parent_or_fail(_line_frames(t), stored)


@query("""
select l_orderkey as activity_id, l_partkey as frame_seq, l_linenumber from lineitem
where l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'F')
""")
def skip_already_loaded(t: Tables) -> DataFrame:
    activities = t.orders.select(
        F.col("o_orderkey").alias("activity_id"), (F.col("o_orderstatus") == "F").alias("ts_data_available")
    )
    return frames.skip_already_loaded(_line_frames(t), activities)


@query("""
with known as (select c_custkey, case when c_acctbal < 2000 then null else c_name end as full_name
  from customer where c_acctbal >= 0)
select c_custkey, full_name, full_name is null as must_update from known
union all select distinct o_custkey, null, true from orders where o_custkey not in (select c_custkey from known)
""")
def ensure_dimension_rows(t: Tables) -> DataFrame:
    name = F.when(F.col("c_acctbal") >= 2000, F.col("c_name")).alias("full_name")
    known = t.customer.filter("c_acctbal >= 0").select("c_custkey", name)
    facts = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return merge.ensure_dimension_rows(known, facts, "c_custkey", "full_name")


@query("""
with given as (select o_custkey, case when o_orderstatus <> 'P' then o_orderpriority end as full_name,
  cast(o_orderdate as date) as birth_date, o_orderdate, o_orderkey from orders),
chosen as (select * from given qualify row_number() over (partition by o_custkey order by (full_name is null),
  case when full_name is not null then o_orderdate end, case when full_name is not null then o_orderkey end,
  o_orderdate desc, o_orderkey desc) = 1)
select c.c_custkey, case when c.c_acctbal >= 0 then c.c_name else g.full_name end as full_name,
  case when c.c_acctbal < 0 then g.birth_date end as birth_date
from customer c left join chosen g on g.o_custkey = c.c_custkey
""")
def fill_missing_attributes(t: Tables) -> DataFrame:
    users = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("full_name"),
        F.lit(None).cast("date").alias("birth_date"),
    )
    given = t.orders.select(
        F.col("o_custkey").alias("c_custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("full_name"),
        F.col("o_orderdate").cast("date").alias("birth_date"),
        *BY_TIME,
    )
    return merge.fill_missing_attributes(users, given, "c_custkey", ["full_name", "birth_date"], BY_TIME, "full_name")


@query("select event_id, user_id, date_trunc('day', ts)::timestamp as start_ts, true as resolved from events")
def resolve_surrogate_key(t: Tables) -> DataFrame:
    night = F.date_trunc("day", F.col("ts").cast("timestamp"))
    children = t.events.select("event_id", "user_id", night.alias("start_ts"))
    key = sleep.sleep_key(F.col("user_id"), F.col("start_ts"))
    sessions = children.select("user_id", "start_ts").distinct().withColumn("sleep_id", key)
    resolved = sleep.resolve_surrogate_key(children, sessions, ["user_id", "start_ts"], "sleep_id")
    return resolved.select(
        "event_id", "user_id", ntz(F.col("start_ts")).alias("start_ts"), (F.col("sleep_id") == key).alias("resolved")
    )


@query("""
select l_orderkey, l_linenumber, l_suppkey from lineitem
where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')
""")
def enforce_foreign_key(t: Tables) -> DataFrame:
    child = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    parent = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey")
    return audit.foreign_key_violations(child, parent, ["l_orderkey"], ["o_orderkey"])


@query("""
with keyed as (select o_custkey, cast(year(o_orderdate) as integer) as y, * exclude (o_custkey) from orders),
old as (select o_custkey, y, o_totalprice as generic, o_totalprice as cycling, o_orderpriority as note from keyed
  where o_orderstatus = 'P' qualify row_number() over (partition by o_custkey, y order by o_orderdate, o_orderkey) = 1),
g as (select o_custkey, y, case when o_orderpriority <> '5-LOW' then o_totalprice end as generic from keyed
  where o_orderstatus = 'F'
  qualify row_number() over (partition by o_custkey, y order by o_orderdate desc, o_orderkey desc) = 1),
c as (select o_custkey, y, o_totalprice as cycling from keyed where o_orderstatus = 'O'
  qualify row_number() over (partition by o_custkey, y order by o_orderdate desc, o_orderkey desc) = 1)
select k.o_custkey, k.y, case when g.o_custkey is not null then g.generic else old.generic end as generic,
  case when c.o_custkey is not null then c.cycling else old.cycling end as cycling, old.note
from (select distinct o_custkey, y from keyed) k
left join old on old.o_custkey = k.o_custkey and old.y = k.y
left join g on g.o_custkey = k.o_custkey and g.y = k.y
left join c on c.o_custkey = k.o_custkey and c.y = k.y
""")
def merge_column_groups(t: Tables) -> DataFrame:
    keyed = t.orders.withColumn("y", F.year("o_orderdate"))
    keys = ["o_custkey", "y"]
    old = merge.first_per_key(keyed.filter("o_orderstatus = 'P'"), keys, BY_TIME).select(
        *keys,
        F.col("o_totalprice").alias("generic"),
        F.col("o_totalprice").alias("cycling"),
        F.col("o_orderpriority").alias("note"),
    )
    unsure = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    writers = {
        "generic": keyed.filter("o_orderstatus = 'F'").withColumn("generic", unsure),
        "cycling": keyed.filter("o_orderstatus = 'O'").withColumn("cycling", F.col("o_totalprice")),
    }
    groups = {"generic": ["generic"], "cycling": ["cycling"]}
    return merge.merge_column_groups(old, writers, groups, keys, BY_TIME)


@query("""
with result as (select c_custkey, case when c_acctbal >= 0 then c_custkey end as k from customer),
asked as (select distinct case when o_orderstatus <> 'P' then o_custkey end as k from orders)
select c_custkey, k from result where k in (select k from asked where k is not null)
  or (k is null and exists (select 1 from asked where k is null))
""")
def returning_rows(t: Tables) -> DataFrame:
    result = t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("k"))
    asked = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    return merge.returning_rows(result, asked, ["k"])


# Keyed writes.


@query("""
with stored as (select * from orders where o_orderstatus <> 'O'),
submitted as (
  select * replace ('new' as o_orderpriority) from orders where o_orderstatus <> 'F'
  union all select * replace ('new' as o_orderpriority) from orders where o_orderstatus = 'O' and o_orderkey % 97 = 0
), broken as (
  select o_custkey, 'key is stored' as rule from submitted where o_orderkey in (select o_orderkey from stored)
  union all select o_custkey, 'key is repeated' from submitted group by o_custkey, o_orderkey having count(*) > 1
), failed as (select o_custkey, max(rule) as rule from broken group by all)
select o_orderkey, o_custkey, o_orderpriority, null::varchar as rule from stored
union all select o_orderkey, o_custkey, o_orderpriority, null from submitted where o_custkey not in (select o_custkey from failed)
union all select null, o_custkey, null, rule from failed
""")
def insert_plain(t: Tables) -> DataFrame:
    """The orders of one customer are one statement."""
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    submitted = _submitted(t)
    submitted = submitted.unionByName(submitted.filter("o_orderstatus = 'O' and o_orderkey % 97 = 0"))
    table, failed = merge.insert_plain(_stored(t).select(*columns), submitted, ["o_orderkey"], ["o_custkey"])
    return table.unionByName(failed, allowMissingColumns=True)


@query(f"""
with {_SIDES}
select o_custkey, o_orderkey, o_totalprice, o_orderpriority from old
union all select o_custkey, o_orderkey, o_totalprice, o_orderpriority from first_new
  where o_custkey not in (select o_custkey from old)
""")
def insert_ignore(t: Tables) -> DataFrame:
    merged = merge.insert_ignore(_one_per_customer(t), _submitted(t), ["o_custkey"], BY_TIME)
    return merged.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")


_CUSTOMERS = "(select o_custkey from old union select o_custkey from last_new) k"


@query(f"""
with {_SIDES}
select o_custkey, o_orderkey, o_orderstatus, o_totalprice from last_new
union all select o_custkey, o_orderkey, o_orderstatus, o_totalprice from old
  where o_custkey not in (select o_custkey from last_new)
""")
def upsert_all(t: Tables) -> DataFrame:
    merged = merge.upsert(_one_per_customer(t), _submitted(t), ["o_custkey"], BY_TIME)
    return merged.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query(f"""
with {_SIDES}
select k.o_custkey, coalesce(old.o_orderkey, f.o_orderkey) as o_orderkey,
  coalesce(old.o_orderstatus, f.o_orderstatus) as o_orderstatus, coalesce(l.o_totalprice, old.o_totalprice) as o_totalprice
from {_CUSTOMERS} left join old using (o_custkey) left join first_new f using (o_custkey) left join last_new l using (o_custkey)
""")
def upsert_subset(t: Tables) -> DataFrame:
    merged = merge.upsert(
        _one_per_customer(t), _submitted(t), ["o_custkey"], BY_TIME, update_columns=["o_totalprice"]
    )
    return merged.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query(f"""
with {_SIDES}
select k.o_custkey, coalesce(old.o_orderkey, f.o_orderkey) as o_orderkey,
  coalesce(l.o_orderstatus, old.o_orderstatus) as o_orderstatus, coalesce(l.o_totalprice, old.o_totalprice) as o_totalprice
from {_CUSTOMERS} left join old using (o_custkey) left join first_new f using (o_custkey) left join last_new l using (o_custkey)
""")
def upsert_preserve_columns(t: Tables) -> DataFrame:
    merged = merge.upsert(_one_per_customer(t), _submitted(t), ["o_custkey"], BY_TIME, preserve=["o_orderkey"])
    return merged.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query(f"""
with {_SIDES},
newest as (select * from submitted qualify row_number() over
  (partition by o_custkey order by o_totalprice desc, o_orderdate, o_orderkey) = 1)
select k.o_custkey, case when old.o_custkey is null or n.o_totalprice > old.o_totalprice then n.o_orderkey
    else old.o_orderkey end as o_orderkey,
  case when old.o_custkey is null or n.o_totalprice > old.o_totalprice then n.o_totalprice
    else old.o_totalprice end as o_totalprice
from {_CUSTOMERS} left join old using (o_custkey) left join newest n using (o_custkey)
""")
def upsert_if_newer(t: Tables) -> DataFrame:
    merged = merge.upsert(_one_per_customer(t), _submitted(t), ["o_custkey"], BY_TIME, newer_on="o_totalprice")
    return merged.select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"""
with {_SIDES}
select k.o_custkey, old.o_orderkey, old.o_orderpriority, coalesce(l.o_totalprice, old.o_totalprice) as o_totalprice
from {_CUSTOMERS} left join old using (o_custkey) left join last_new l using (o_custkey)
""")
def merge_by_primary_key(t: Tables) -> DataFrame:
    partial = _submitted(t).select(
        "o_custkey", "o_totalprice", F.col("o_orderdate").alias("at_date"), F.col("o_orderkey").alias("at_key")
    )
    merged = merge.merge_by_primary_key(_one_per_customer(t), partial, ["o_custkey"], ["at_date", "at_key"])
    return merged.select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")


@query("""
select o_orderkey, case when o_orderstatus = 'O' then '2024-02-01' else '2024-01-01' end as created,
  case o_orderstatus when 'F' then '2024-01-01' when 'P' then '2020-05-05' else '2024-02-01' end as updated
from orders
""")
def stamp_audit_columns(t: Tables) -> DataFrame:
    first, second = (F.lit(f"2024-0{month}-01").cast("timestamp") for month in (1, 2))
    columns = ["o_orderkey", "o_totalprice"]
    stored = merge.stamp_audit_columns(_stored(t).select(*columns), first)
    stated = F.when(F.col("o_orderstatus") == "P", F.lit("2020-05-05").cast("timestamp"))
    sent = _submitted(t).select(*columns, stated.alias("update_ts"))
    merged = merge.upsert(stored, merge.stamp_audit_columns(sent, second), KEY, KEY, preserve=["create_ts"])
    return merged.select(
        "o_orderkey",
        F.date_format("create_ts", "yyyy-MM-dd").alias("created"),
        F.date_format("update_ts", "yyyy-MM-dd").alias("updated"),
    )


@query("""
with stored as (select * from orders where o_orderstatus <> 'O'),
sent as (select * from orders where o_orderstatus <> 'F'),
was as (select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1
  as latest from stored),
now as (select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1
  as latest from sent)
select o.o_custkey, o.o_orderkey, case when now.latest then true
  when o.o_custkey in (select o_custkey from sent) then false else was.latest end as latest
from orders o left join was using (o_orderkey) left join now using (o_orderkey)
""")
def maintain_latest_flag(t: Tables) -> DataFrame:
    columns = ["o_custkey", "o_orderkey", "o_orderdate"]
    none = _stored(t).select(*columns, F.lit(False).alias("latest")).limit(0)
    per, identity = ["o_custkey"], ["o_custkey", "o_orderkey"]
    stored = merge.maintain_latest_flag(none, _stored(t).select(*columns), per, identity, BY_TIME, "append")
    sent = _submitted(t).select(*columns)
    merged = merge.maintain_latest_flag(stored, sent, per, identity, BY_TIME, "update")
    return merged.select("o_custkey", "o_orderkey", "latest")


# Constraint checks.


@query("""
select l_returnflag, l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1
""")
def detect_duplicate_source_keys(t: Tables) -> DataFrame:
    return merge.duplicate_source_keys(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_returnflag"])


@query("""
select o_custkey, count(*) as n_latest from orders where o_orderstatus = 'O' group by all having count(*) > 1
""")
def enforce_unique_latest(t: Tables) -> DataFrame:
    flagged = t.orders.select("o_custkey", (F.col("o_orderstatus") == "O").alias("latest"))
    return audit.unique_latest_violations(flagged, ["o_custkey"])


@query("select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1")
def enforce_unique_key(t: Tables) -> DataFrame:
    return audit.unique_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
select 'event_id' as column_name, count(*) filter (event_id is null) as n_null from events
union all select 'kind', count(*) filter (event_type = 'click') from events
union all select 'reading', count(*) filter (value < 10) from events
""")
def enforce_not_null(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_id",
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"),
        F.when(F.col("value") >= 10, F.col("value")).alias("reading"),
    )
    return audit.null_counts(rows, ["event_id", "kind", "reading"])


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'P')
""")
def cascade_delete(t: Tables) -> DataFrame:
    child = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    deleted = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return audit.cascade_delete(child, deleted, ["l_orderkey"])


LINES = Table(
    "line",
    "l_orderkey bigint, l_linenumber bigint, l_linestatus string",
    ("l_orderkey", "l_linenumber"),
    APPEND,
    required=("l_linestatus",),
    parent=("order", "l_orderkey"),
)


@query("""
with rows as (
  select 'lines-' || (l_orderkey // 8) as file_name, l_orderkey, l_linenumber,
    case when l_orderkey % 50 = 0 and l_linenumber = 1 then null else l_linestatus end as l_linestatus from lineitem
  union all select 'lines-' || (l_orderkey // 8), l_orderkey, l_linenumber, l_linestatus from lineitem where l_orderkey % 70 = 1
)
select distinct file_name, 'line.l_linestatus is missing' as rule from rows where l_linestatus is null
union all select distinct file_name, 'line key is repeated' from (
  select file_name from rows group by file_name, l_orderkey, l_linenumber having count(*) > 1)
union all select distinct file_name, 'line has no order' from rows
  where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')
""")
def constraint_findings(t: Tables) -> DataFrame:
    """Files of eight orders with missing values, repeated keys and orders that do not exist."""
    file = F.concat(F.lit("lines-"), F.floor(F.col("l_orderkey") / 8).cast("string")).alias("file_name")
    lines = t.lineitem.select(file, "l_orderkey", "l_linenumber", "l_linestatus")
    gap = (F.col("l_orderkey") % 50 == 0) & (F.col("l_linenumber") == 1)
    rows = lines.withColumn("l_linestatus", F.when(~gap, F.col("l_linestatus")))
    rows = rows.unionByName(lines.filter("l_orderkey % 70 = 1"))
    parents = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return constraints.findings(rows, LINES, parents, plain=True, origin=["file_name"])
