"""Queries of streams with state over the shop's clicks; each equals a batch computation over all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.plans.base import Tables, query
from panelmill.sources.scratch import folder
from panelmill.streaming.stateful import once, replayed, sessions, within

#: Rows come up to so much later than they happened; steps of arrival; a row after which all windows are closed.
_DELAY, _STEPS, _END = "5 days", 4, "2025-01-01"


def _clicks(spark, d):
    """Clicks with a time, and one row at the end that moves the watermark past all others."""
    c = Tables(spark, d).clicks.where("ts is not null").select("click_id", F.col("ts").cast("timestamp").alias("ts"), "client_id", "kind", F.col("value"), F.month("arrived_at").alias("month"))
    last = spark.range(2).select((-1 - F.col("id")).alias("click_id"), F.expr(f"timestamp'{_END}' + make_dt_interval(cast(id as int) * 100)").alias("ts"), F.lit(-1).cast("bigint").alias("client_id"), F.lit("end").alias("kind"), F.lit(0.0).alias("value"), (F.col("id").cast("int") + 100).alias("month"))
    step = F.when(F.col("month") < 100, F.least(F.col("month") - 1, F.lit(_STEPS - 1))).otherwise(F.col("month") - 100 + _STEPS)
    return c.unionByName(last), step


@query("""with c as (select * from clicks where ts is not null qualify row_number() over (partition by click_id order by ts) = 1),
m as (select *, case when ts - lag(ts) over (partition by client_id order by ts) <= interval 30 minute then 0 else 1 end as fresh from c),
s as (select *, sum(fresh) over (partition by client_id order by ts rows unbounded preceding) as session from m)
select client_id, epoch_us(min(ts)) as began, epoch_us(max(ts)) as ended, count(*) as n, count(*) filter (kind = 'purchase') as purchases from s group by client_id, session""")
def click_sessions(spark, d):
    """Sessions of each client, 30 minutes apart, of clicks that came late, twice and out of order in four steps."""
    table, step = _clicks(spark, d)
    made = lambda rows: sessions(once(rows, "ts", ["click_id"], _DELAY), "ts", ["client_id"], "30 minutes", F.count_if(F.col("kind") == "purchase").alias("purchases"))
    out = replayed(table, step, _STEPS + 2, made, folder(spark, "sessions"))
    return out.where("client_id is null or client_id >= 0").select("client_id", F.unix_micros("start").alias("began"), F.unix_micros("end").alias("ended"), "n", "purchases")


@query("""with c as (select * from clicks where ts is not null qualify row_number() over (partition by click_id order by ts) = 1)
select a.client_id, a.click_id as error_id, b.click_id as purchase_id from c a join c b on a.client_id = b.client_id and b.ts > a.ts and b.ts <= a.ts + interval 10 minute where a.kind = 'error' and b.kind = 'purchase'""")
def errors_before_purchases(spark, d):
    """Two streams: each purchase with the client's errors in the ten minutes before it."""
    table, step = _clicks(spark, d)

    def made(rows):
        side = lambda kind, name: once(rows.where(F.col("kind") == kind).select("client_id", F.col("click_id").alias(f"{name}_id"), F.col("ts").alias(f"{name}_at")), f"{name}_at", [f"{name}_id"], _DELAY)
        return within(side("error", "error"), side("purchase", "purchase"), ["client_id"], "error_at", "purchase_at", "10 minutes").select("client_id", "error_id", "purchase_id")

    return replayed(table.where("kind in ('error', 'purchase')"), step, _STEPS, made, folder(spark, "pairs"))
