"""I3-I9 and J1-J4 in batch form, over the change events and the orders."""

from pyspark.sql import functions as F

from tradewind.checks.registry import MODEL_SQL, query
from tradewind.operators import changes as C

# versions of every user: event_type is tracked, value follows in place
MODEL_SQL["m_versions"] = """
    with filled as (
        select user_id, ts, event_type,
               last_value(value ignore nulls) over (partition by user_id order by ts
                   rows between unbounded preceding and current row) as value
        from s_changes),
    flagged as (
        select *, event_type is distinct from lag(event_type) over w
                  or row_number() over w = 1 as is_new
        from filled window w as (partition by user_id order by ts)),
    runs as (
        select *, sum(is_new::int) over (partition by user_id order by ts
                     rows between unbounded preceding and current row) as run
        from flagged),
    collapsed as (
        select user_id, run, arg_max(event_type, ts) as event_type, max(ts) as ts,
               min(ts) as started, arg_max(struct_pack(v := value), ts).v as value
        from runs group by user_id, run)
    select user_id, ts, event_type, value, started as "__START_AT",
           lead(started) over (partition by user_id order by started) as "__END_AT"
    from collapsed"""


def versions(t, **options):
    return C.scd2(t.changes, ["user_id"], "ts", track_except=["value"],
                  ignore_null_updates=True, **options)


@query("i3_scd1_latest_row", """
    select * from s_changes qualify row_number() over (
        partition by user_id order by ts desc) = 1""")
def _(t):
    return C.scd1(t.changes, ["user_id"], "ts")


@query("i3_scd1_composite_key", """
    select user_id, event_type, max(ts) as ts, arg_max(value, ts) as value
    from s_changes where event_type <> 'error' group by user_id, event_type""")
def _(t):
    return C.scd1(t.changes.filter(F.col("event_type") != "error"),
                  ["user_id", "event_type"], "ts")


@query("i4_scd1_ignore_null_updates", """
    select user_id, max(ts) as ts, arg_max(event_type, ts) as event_type,
           arg_max(value, ts) filter (where value is not null) as value
    from s_changes group by user_id""")
def _(t):
    return C.scd1(t.changes, ["user_id"], "ts", ignore_null_updates=True)


@query("i5_scd2_versions", "select * from m_versions")
def _(t):
    return versions(t)


@query("i6_scd2_cut_keys", "select * from m_versions")
def _(t):
    """The same versions when every user is cut into stretches."""
    return versions(t, max_rows_per_key=60)


def _sequence_variant(t, sequence, **options):
    """The event changes with another sequence column, as one uncut and one cut table."""
    rows = t.changes.withColumn("seq", sequence).select("user_id", "seq", "event_type", "value")
    both = [C.scd2(rows, ["user_id"], "seq", track_except=["value"], ignore_null_updates=True,
                   max_rows_per_key=most, **options).withColumn("cut", F.lit(most < 1000))
            for most in (2_000_000, 60)]
    return both[0].unionByName(both[1])


@query("i6_text_sequence", """
    select user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as seq, event_type, value,
           strftime("__START_AT", '%Y-%m-%d %H:%M:%S.%f') as "__START_AT",
           strftime("__END_AT", '%Y-%m-%d %H:%M:%S.%f') as "__END_AT", cut
    from m_versions, (values (true), (false)) c(cut)""")
def _(t):
    """A text sequence orders as text, whether keys are cut or not."""
    return _sequence_variant(t, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("i6_null_sequence", """
    with kept as (select * from s_changes where event_type <> 'error'),
    filled as (
        select user_id, ts, event_type, last_value(value ignore nulls) over (
                   partition by user_id order by ts rows unbounded preceding) as value
        from kept),
    starts as (
        select *, lag(event_type) over (partition by user_id order by ts) as was from filled),
    spans as (
        select user_id, ts as start_at, lead(ts) over (partition by user_id order by ts) as end_at
        from starts where was is distinct from event_type)
    select s.user_id, f.ts as seq, f.event_type, f.value, s.start_at as "__START_AT",
           s.end_at as "__END_AT", cut
    from spans s join filled f on f.user_id = s.user_id and f.ts >= s.start_at
                                  and (s.end_at is null or f.ts < s.end_at),
         (values (true), (false)) c(cut)
    qualify row_number() over (partition by s.user_id, s.start_at, cut order by f.ts desc) = 1""")
def _(t):
    """Changes without a sequence are left out on request, alike for keys of every size."""
    return _sequence_variant(t, F.when(F.col("event_type") != "error", F.col("ts")),
                             on_missing_sequence="skip")


@query("i7_sequence_conflicts", """
    select review_id, max(review_answer_timestamp) as review_answer_timestamp,
           arg_max(review_score, review_answer_timestamp) as review_score
    from s_order_reviews group by review_id""")
def _(t):
    reviews = t.order_reviews.select("review_id", "review_answer_timestamp", "review_score")
    return C.scd1(reviews, ["review_id"], "review_answer_timestamp")


@query("i8_replayed_states", """
    select user_id, max(ts) as ts, arg_max(event_type, ts) as event_type,
           arg_max(value, ts) filter (where value is not null) as value
    from s_changes group by user_id""")
def _(t):
    """A replayed state, and one extended by overlapping changes, give the same table."""
    def state(df):
        return C.scd1_state(df, ["user_id"], "ts", ignore_null_updates=True)
    early = state(t.changes.filter(F.col("event_type") != "view"))
    everything = state(t.changes)
    merged = C.merge_states(early.unionByName(early).unionByName(everything), ["user_id"])
    return C.scd1_rows(merged, ["user_id"])


@query("i9_current_versions", """select * from m_versions where "__END_AT" is null""")
def _(t):
    return C.current(versions(t))


@query("i9_as_of_time", """
    select * from m_versions where "__START_AT" <= timestamp '2024-01-15 12:00:00'
       and ("__END_AT" is null or "__END_AT" > timestamp '2024-01-15 12:00:00')""")
def _(t):
    return C.as_of_time(versions(t), F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))


MERGED_SQL = """
    with old as (select order_id, customer_id, 'created' as order_status from s_orders
                 where order_status <> 'canceled'),
         new as (select order_id, customer_id, order_status from s_orders
                 where order_status <> 'shipped')
    select coalesce(o.order_id, n.order_id) as order_id,
           coalesce(o.customer_id, n.customer_id) as customer_id,
           coalesce(n.order_status, o.order_status) as order_status
    from old o full join new n on n.order_id = o.order_id"""


def merge_inputs(t):
    base = t.orders_placed.select("order_id", "customer_id", "order_status")
    target = base.filter("order_status <> 'canceled'").withColumn("order_status", F.lit("created"))
    return target, base.filter("order_status <> 'shipped'")


@query("j1_merge", MERGED_SQL)
def _(t):
    """Canceled orders are inserted, delivered ones updated, shipped ones left alone."""
    target, source = merge_inputs(t)
    return C.merge(target, source, ["order_id"], update_cols=["order_status"])


@query("j1_merge_update_only", MERGED_SQL + " where o.order_id is not null")
def _(t):
    target, source = merge_inputs(t)
    return C.merge(target, source, ["order_id"], ["order_status"], insert=False)


INCREMENT_SQL = """
    with loaded as (select order_id, customer_id, order_purchase_ts, 'loaded' as origin
                    from s_orders where order_purchase_ts < timestamp '2000-01-01')
    select * from loaded
    union all
    select order_id, customer_id, order_purchase_ts, 'new' from s_orders
    where order_purchase_ts > (select max(order_purchase_ts) from loaded)"""


@query("j2_incremental", INCREMENT_SQL)
def _(t):
    orders = t.orders_placed.select("order_id", "customer_id", "order_purchase_ts")
    loaded = orders.filter(F.col("order_purchase_ts") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return C.incremental(loaded.withColumn("origin", F.lit("loaded")),
                         orders.withColumn("origin", F.lit("new")),
                         ["order_id"], "order_purchase_ts")


@query("j3_snapshot_check", """
    with was as (select c_custkey, c_mktsegment as segment from customer where c_nationkey <> 3),
         now as (select c_custkey, case when c_acctbal > 5000 then 'GOLD' else c_mktsegment end
                 as segment from customer where c_nationkey <> 4)
    select w.*, timestamp '2024-01-01' as valid_from,
           case when n.segment <> w.segment then timestamp '2024-02-01' end as valid_to
    from was w left join now n on n.c_custkey = w.c_custkey
    union all
    select n.*, timestamp '2024-02-01', null from now n left join was w using (c_custkey)
    where w.segment is null or w.segment <> n.segment""")
def _(t):
    base = t.raw("customer").select("c_custkey", F.col("c_mktsegment").alias("segment"),
                                    "c_acctbal", "c_nationkey")
    was = base.filter("c_nationkey <> 3").select("c_custkey", "segment")
    now = base.filter("c_nationkey <> 4").select("c_custkey", F.when(
        F.col("c_acctbal") > 5000, "GOLD").otherwise(F.col("segment")).alias("segment"))

    def month(n):
        return F.lit(f"2024-0{n}-01").cast("timestamp_ntz")
    first = C.snapshot_check(None, was, ["c_custkey"], ["segment"], month(1))
    return C.snapshot_check(first, now, ["c_custkey"], ["segment"], month(2))
