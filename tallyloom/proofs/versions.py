"""Proofs of versioned dimensions, on the events table read as daily snapshots of user status."""

from pyspark.sql import functions as F

from tallyloom.plans import scd
from tallyloom.proofs.common import AS_OF, event_day
from tallyloom.proofs.registry import proof

DAILY_SQL = """SELECT user_id, CAST(ts AS DATE) AS d, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS ts
               FROM events GROUP BY 1, 2"""

USER_VERSIONS_SQL = f"""
    SELECT user_id, status, d AS start_date,
           COALESCE(LEAD(d) OVER (PARTITION BY user_id ORDER BY d) - 1, DATE '2400-01-01') AS end_date
    FROM (SELECT * FROM ({DAILY_SQL}) QUALIFY status IS DISTINCT FROM LAG(status) OVER (PARTITION BY user_id ORDER BY d))"""


def daily_status(t):
    """Last event type per user and day."""
    return t.events.groupBy("user_id", event_day().alias("d")).agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("status"), F.max("ts").alias("loaded")
    )


def user_versions(t):
    built = scd.scd2_build(daily_status(t), ["user_id"], ["status"], "loaded")
    return built.select("user_id", "status", "start_date", "end_date", "hash_id")


@proof("x_scd2_build", USER_VERSIONS_SQL)
def x_scd2_build(t):
    return user_versions(t).drop("hash_id")


APPLY_DAY = "2024-01-20"


def first_part(t):
    """The dimension as it stood after the loads up to APPLY_DAY."""
    early = daily_status(t).where(F.col("d") <= F.lit(APPLY_DAY).cast("date"))
    return scd.scd2_build(early, ["user_id"], ["status"], "loaded").drop("loaded_at")


def second_part(t):
    late = daily_status(t).where(F.col("d") > F.lit(APPLY_DAY).cast("date"))
    return scd.scd2_build(late, ["user_id"], ["status"], "loaded").drop("loaded_at")


def _versions_sql(where):
    return f"""SELECT user_id, status, md5(concat_ws('|', user_id, status)) AS h, d AS start_date,
           COALESCE(LEAD(d) OVER (PARTITION BY user_id ORDER BY d) - 1, DATE '2400-01-01') AS end_date
    FROM (SELECT * FROM ({DAILY_SQL}) WHERE {where}
          QUALIFY status IS DISTINCT FROM LAG(status) OVER (PARTITION BY user_id ORDER BY d))"""


CLOSE_SQL = f"""WITH tgt AS ({_versions_sql(f"d <= DATE '{APPLY_DAY}'")}), src AS ({_versions_sql(f"d > DATE '{APPLY_DAY}'")}),
     cur AS (SELECT user_id, h, start_date FROM src WHERE end_date = DATE '2400-01-01'),
     closed AS (SELECT tgt.user_id, tgt.status, tgt.h, tgt.start_date,
                CASE WHEN tgt.end_date = DATE '2400-01-01' AND cur.h <> tgt.h THEN cur.start_date - 1 ELSE tgt.end_date END AS end_date
                FROM tgt LEFT JOIN cur USING (user_id))"""


@proof("wr_close_version", f"{CLOSE_SQL} SELECT user_id, status, start_date, end_date FROM closed")
def wr_close_version(t):
    return scd.close_versions(first_part(t), second_part(t), ["user_id"]).drop("hash_id")


# applying the later loads to the earlier dimension gives what one build over all loads gives
@proof("x_scd2_apply", USER_VERSIONS_SQL)
def x_scd2_apply(t):
    return scd.scd2_apply(first_part(t), second_part(t), ["user_id"]).drop("hash_id")


@proof(
    "wr_soft_delete",
    f"""WITH v AS ({USER_VERSIONS_SQL}), s AS (SELECT DISTINCT user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30')
        SELECT v.user_id, v.status, v.start_date,
               CASE WHEN s.user_id IS NULL THEN DATE '2024-01-30' ELSE v.end_date END AS end_date,
               CAST(CASE WHEN s.user_id IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_delete
        FROM v LEFT JOIN s USING (user_id)""",
)
def wr_soft_delete(t):
    live = user_versions(t).drop("hash_id").withColumn("is_delete", F.lit(0))
    last = t.events.where(event_day() == F.lit("2024-01-30").cast("date")).select("user_id")
    return scd.soft_delete(live, last, ["user_id"], "2024-01-30")


@proof(
    "x_scd2_presence",
    """WITH seen AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
            cal AS (SELECT DISTINCT d FROM seen),
            first_day AS (SELECT user_id, MIN(d) AS d0 FROM seen GROUP BY 1),
            grid AS (SELECT f.user_id, cal.d, CASE WHEN s.d IS NULL THEN 'DELETE' ELSE 'ACTIVE' END AS status
                     FROM first_day f JOIN cal ON cal.d >= f.d0 LEFT JOIN seen s ON s.user_id = f.user_id AND s.d = cal.d),
            chg AS (SELECT * FROM grid QUALIFY status IS DISTINCT FROM LAG(status) OVER (PARTITION BY user_id ORDER BY d))
       SELECT user_id, status, d AS start_date,
              COALESCE(LEAD(d) OVER (PARTITION BY user_id ORDER BY d) - 1, DATE '2400-01-01') AS end_date,
              CAST(CASE WHEN status = 'DELETE' THEN 1 ELSE 0 END AS INTEGER) AS is_delete FROM chg""",
)
def x_scd2_presence(t):
    days = t.events.select("user_id", event_day().alias("d"))
    return scd.scd2_presence(days, ["user_id"], "d", "2024-01-31")


@proof(
    "x_as_of",
    f"SELECT user_id, status FROM ({USER_VERSIONS_SQL}) WHERE DATE '{AS_OF}' BETWEEN start_date AND end_date",
)
def x_as_of(t):
    return scd.as_of(user_versions(t), AS_OF).select("user_id", "status")


@proof(
    "x_gaps_islands",
    """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
            n AS (SELECT user_id, d, d - CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS g FROM d),
            r AS (SELECT user_id, g, MIN(d) AS s FROM n GROUP BY 1, 2)
       SELECT user_id, MAX(s) AS run_start FROM r GROUP BY 1""",
)
def x_gaps_islands(t):
    return scd.start_of_last_run(t.events.select("user_id", event_day().alias("d")), ["user_id"], "d", "run_start")


@proof(
    "x_in_out_diff",
    """WITH a AS (SELECT DISTINCT user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-29'),
            b AS (SELECT DISTINCT user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30')
       SELECT user_id, 'OUT' AS in_out_type FROM a WHERE user_id NOT IN (SELECT user_id FROM b)
       UNION ALL SELECT user_id, 'IN' FROM b WHERE user_id NOT IN (SELECT user_id FROM a)""",
)
def x_in_out_diff(t):
    days = t.events.select("user_id", event_day().alias("d"))
    return scd.in_out_diff(days, ["user_id"], "d", "2024-01-29", "2024-01-30")
