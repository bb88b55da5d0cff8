"""Queries over the driver's tables, one for each relational operator, each with the same result in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import numeric, timefn
from ..operators import characterization, history, links, rows, series, stretches, summary
from ..sources import text_archive
from ..sources.staging import staged
from .proxies import INNOVATIONS, LIMITS, QUIET, RAW, READINGS, changes, changes_sql, innovations, quiet, raw, readings, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


CH = changes_sql()
QCH = changes_sql("quiet")


@query(f"WITH {READINGS} SELECT epoch, count(*) AS n_readings, count(DISTINCT ref) AS n_refs, min(delta_us) AS first_us FROM readings GROUP BY epoch")
def epoch_blocks(spark, sf_dir):
    return readings(spark, sf_dir).groupBy("epoch").agg(F.count(F.lit(1)).alias("n_readings"), F.countDistinct("ref").alias("n_refs"), F.min("delta_us").alias("first_us"))


@query(f"""WITH {RAW}, r AS (SELECT *, row_number() OVER (PARTITION BY ref, epoch, 600000000 - delta_us <= 10000000 ORDER BY us, event_id) AS rn FROM raw)
SELECT event_id, CASE WHEN 600000000 - delta_us <= 10000000 THEN 'late' WHEN rn > 1 THEN 'duplicate' ELSE 'accepted' END AS verdict FROM r""")
def refused_readings(spark, sf_dir):
    late = timefn.EPOCH_US - F.col("delta_us") <= 10_000_000
    w = Window.partitionBy("ref", "epoch", late).orderBy("us", "event_id")
    return raw(spark, sf_dir).select("event_id", F.when(late, "late").when(F.row_number().over(w) > 1, "duplicate").otherwise("accepted").alias("verdict"))


@query(f"""WITH {RAW}, m AS (SELECT event_id, us, us / 1e6 AS s, us / 1e6 / 86400.0::DOUBLE + 40587.0::DOUBLE AS mjd FROM raw)
SELECT event_id, mjd, mjd + 2400000.5::DOUBLE AS jd, abs(CAST(round_even((mjd - 40587.0::DOUBLE) * 86400.0::DOUBLE * 1e6, 0) AS BIGINT) - us) <= 2 AS returns,
CAST(us // 600000000 + 40587 * 144 AS BIGINT) AS epoch, CAST(us // 600000000 + 1 AS BIGINT) AS next_mark FROM m""")
def mjd_roundtrip(spark, sf_dir):
    mjd = timefn.us_to_mjd(F.col("us"))
    return raw(spark, sf_dir).select("event_id", mjd.alias("mjd"), timefn.mjd_to_jd(mjd).alias("jd"), (F.abs(timefn.mjd_to_us(mjd) - F.col("us")) <= 2).alias("returns"), (timefn.epoch_of_us(F.col("us")) + 40_587 * 144).alias("epoch"), timefn.next_epoch_of_us(F.col("us")).alias("next_mark"))


@query(f"""WITH {RAW}, j AS (SELECT event_id, us, (us // 1000000) / 86400.0::DOUBLE + 2440587.5::DOUBLE AS jd FROM raw)
SELECT event_id, jd, jd - 2400000.5::DOUBLE AS mjd, abs((jd - 2440587.5::DOUBLE) * 86400.0::DOUBLE - us // 1000000) < 0.001 AS returns, strftime(make_timestamp(us), '%Y-%m-%d %H:%M') AS minute,
'+' || CAST(phase // 1000 AS VARCHAR) || '.' || lpad(CAST(phase % 1000 AS VARCHAR), 3, '0') AS phase_text FROM j JOIN raw USING (event_id, us)""")
def jd_calendar(spark, sf_dir):
    """Julian days there and back, the civil minute, and a phase in femtoseconds as text."""
    seconds = F.floor(F.col("us") / 1_000_000)
    jd = timefn.unix_to_jd(seconds)
    minute = F.date_format(timefn.us_to_timestamp(F.col("us")), "yyyy-MM-dd HH:mm")
    return raw(spark, sf_dir).select("event_id", jd.alias("jd"), timefn.jd_to_mjd(jd).alias("mjd"), (F.abs(timefn.jd_to_unix(jd) - seconds) < 0.001).alias("returns"), minute.alias("minute"), numeric.signed_phase(F.col("phase")).alias("phase_text"))


@query(f"""WITH {READINGS} SELECT DISTINCT epoch, CAST((epoch + 5844528) // 144 AS VARCHAR) || '.' || lpad(CAST((epoch + 5844528) % 144 * 1000000 // 144 AS VARCHAR), 6, '0') AS mjd_text FROM readings""")
def epoch_texts(spark, sf_dir):
    return readings(spark, sf_dir).select("epoch", timefn.epoch_to_mjd_text(F.col("epoch") + 40_587 * 144).alias("mjd_text")).distinct()


@query(f"WITH {READINGS}, {CH} SELECT ref, epoch, change FROM ch")
def wrapped_change(spark, sf_dir):
    return changes(spark, sf_dir)


@query(f"WITH {READINGS}, {CH}, {LIMITS} SELECT ref, day, n, med, mad FROM limits")
def day_median_mad(spark, sf_dir):
    by_day = changes(spark, sf_dir).withColumn("day", series.day_of_epoch(F.col("epoch")))
    return series.median_mad(by_day, ["ref", "day"], "change")


@query(f"WITH {READINGS}, {CH}, {LIMITS} SELECT ref, day, round(lim, 6) AS lim FROM limits")
def day_outlier_limit(spark, sf_dir):
    return series.day_limits(changes(spark, sf_dir), ["ref"]).select("ref", "day", F.round("limit", 6).alias("lim"))


@query(f"WITH {QUIET}, {QCH}, {LIMITS} SELECT q.* FROM quiet q WHERE NOT EXISTS (SELECT 1 FROM limits l WHERE l.ref = q.ref AND l.day = q.epoch // 144 AND (l.mad > 10000 OR abs(l.med) > 25000))")
def drop_unusable_days(spark, sf_dir):
    q = quiet(spark, sf_dir)
    return series.drop_unusable_days(q, series.day_limits(series.one_epoch_changes(q, ["ref"]), ["ref"]), ["ref"])


@query(f"""WITH {QUIET}, {QCH}, {LIMITS}, j AS (SELECT ch.ref, ch.epoch, CASE WHEN abs(change - med) > lim THEN sign(change - med) ELSE 0 END AS s FROM ch JOIN limits l ON l.ref = ch.ref AND l.day = ch.epoch // 144)
SELECT q.ref, q.epoch, q.phase FROM quiet q LEFT JOIN j i ON i.ref = q.ref AND i.epoch = q.epoch LEFT JOIN j o ON o.ref = q.ref AND o.epoch = q.epoch + 1
WHERE NOT (CASE WHEN i.s IS NOT NULL AND o.s IS NOT NULL THEN i.s * o.s < 0 ELSE coalesce(i.s, o.s, 0) <> 0 END)""")
def drop_outliers(spark, sf_dir):
    q = quiet(spark, sf_dir)
    return series.drop_outliers(q, series.day_limits(series.one_epoch_changes(q, ["ref"]), ["ref"]), ["ref"]).select("ref", "epoch", "phase")


@query(f"""WITH {QUIET}, {QCH}, {LIMITS}, n AS (SELECT *, phase - lag(phase) OVER w AS s, epoch - lag(epoch) OVER w AS g FROM quiet WINDOW w AS (PARTITION BY ref ORDER BY epoch)),
j AS (SELECT n.*, coalesce(CAST(abs(s - g * med) > g * lim AS INT), 0) AS j FROM n LEFT JOIN limits l ON l.ref = n.ref AND l.day = n.epoch // 144)
SELECT ref, epoch, phase, CAST(sum(j) OVER (PARTITION BY ref ORDER BY epoch) AS BIGINT) AS piece FROM j""")
def split_at_jumps(spark, sf_dir):
    q = quiet(spark, sf_dir)
    return series.split_at_jumps(q, series.day_limits(series.one_epoch_changes(q, ["ref"]), ["ref"]), ["ref"]).select("ref", "epoch", "phase", "piece")


ISLANDS = """isl AS (SELECT ref, min(epoch) AS first, max(epoch) AS last, count(*) AS n FROM (SELECT ref, epoch, sum(f) OVER (PARTITION BY ref ORDER BY epoch) AS i FROM
(SELECT ref, epoch, coalesce(CAST(epoch - lag(epoch) OVER (PARTITION BY ref ORDER BY epoch) > 1 AS INT), 1) AS f FROM readings)) GROUP BY ref, i)"""


@query(f"WITH {READINGS}, {ISLANDS} SELECT * FROM isl")
def islands(spark, sf_dir):
    return series.islands(readings(spark, sf_dir), ["ref"])


@query(f"""WITH {READINGS}, {ISLANDS}, s AS (SELECT ref, first AS start, last + 1 AS stop, n > 3 AS long FROM isl),
m AS (SELECT *, coalesce(CAST(start - max(stop) OVER (PARTITION BY ref ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= 6 AS INT), 1) AS f FROM s),
i AS (SELECT *, sum(f) OVER (PARTITION BY ref ORDER BY start, stop) AS i FROM m) SELECT ref, min(start) AS first, max(stop) AS stop, bool_or(long) AS long FROM i GROUP BY ref, i""")
def joined_spans(spark, sf_dir):
    spans = series.islands(readings(spark, sf_dir), ["ref"]).select("ref", F.col("first").alias("start"), (F.col("last") + 1).alias("end"), (F.col("n") > 3).alias("open_ended"))
    return series.joined_spans(spans, ["ref"], 6).select("ref", F.col("start").alias("first"), F.col("end").alias("stop"), F.col("open_ended").alias("long"))


SLIDING = """f AS (SELECT ref, epoch, list(change) OVER (PARTITION BY ref ORDER BY epoch RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING) AS l FROM ch),
sp AS (SELECT ref, epoch, CAST(list_aggregate(l, 'median') AS DOUBLE) AS med, CAST(list_aggregate([abs(x - list_aggregate(l, 'median')) FOR x IN l], 'median') AS DOUBLE) AS mad FROM f WHERE len(l) >= 9),
vd AS (SELECT ref, epoch, mad > 10000 OR mad > greatest(10 * q, 5000) OR abs(med) > 25000 AS bad FROM sp JOIN (SELECT ref, median(mad) AS q FROM sp GROUP BY ref) USING (ref))"""
DENSE = f"{RAW}, readings AS (SELECT ref, epoch, phase // 8 AS phase FROM (SELECT ref, epoch // 12 AS epoch, phase, row_number() OVER (PARTITION BY ref, epoch // 12 ORDER BY us, event_id) AS rn FROM raw) WHERE rn = 1)"


def _dense(spark, sf_dir):
    """Two-hour buckets, so that frames of 25 hold enough changes."""
    r = raw(spark, sf_dir).select("ref", F.floor(F.col("epoch") / 12).cast("long").alias("epoch"), "us", "event_id", F.floor(F.col("phase") / 8).cast("long").alias("phase"))
    return series.one_epoch_changes(series.first_readings(r, ["ref"], ["us", "event_id"]), ["ref"])


@query(f"WITH {DENSE}, {CH}, {SLIDING} SELECT ref, epoch, med, mad FROM sp")
def sliding_mad(spark, sf_dir):
    return series.sliding_spread(_dense(spark, sf_dir), ["ref"])


def _spreads(spark, sf_dir):
    return staged(series.sliding_spread(_dense(spark, sf_dir), ["ref"]), "spreads")


@query(f"WITH {DENSE}, {CH}, {SLIDING} SELECT ref, epoch, bad FROM vd")
def clock_verdicts(spark, sf_dir):
    return series.verdicts(_spreads(spark, sf_dir), ["ref"])


@query(f"WITH {DENSE}, {CH}, {SLIDING} SELECT epoch, bool_and(bad) AS bad, count(*) AS n FROM vd GROUP BY epoch")
def agree_all(spark, sf_dir):
    v = series.verdicts(_spreads(spark, sf_dir), ["ref"])
    return v.groupBy("epoch").agg(F.bool_and("bad").alias("bad"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {READINGS}, v AS (SELECT ref, epoch, phase > 60000 AS bad FROM readings), i AS (SELECT *, sum(CAST(NOT bad AS INT)) OVER (PARTITION BY ref ORDER BY epoch) AS i,
max(CASE WHEN NOT bad THEN epoch END) OVER (PARTITION BY ref) AS g FROM v)
SELECT ref, min(epoch) AS first, max(epoch) + 1 AS stop, coalesce(max(g) < min(epoch), true) AS open_ended FROM i WHERE bad GROUP BY ref, i""")
def verdict_runs(spark, sf_dir):
    v = readings(spark, sf_dir).select("ref", "epoch", (F.col("phase") > 60_000).alias("bad"))
    return series.runs(v, ["ref"]).select("ref", F.col("start").alias("first"), F.col("end").alias("stop"), "open_ended")


@query(f"WITH {RAW} SELECT epoch, count(DISTINCT user_id) AS n_members FROM raw GROUP BY epoch HAVING count(DISTINCT user_id) >= 4")
def shared_epochs(spark, sf_dir):
    return series.shared_epochs(raw(spark, sf_dir), "user_id", 4)


@query(f"""WITH {RAW}, c AS (SELECT ref, epoch, count(*) AS n FROM raw GROUP BY ALL), f AS (SELECT *, coalesce(CAST(epoch - lag(epoch) OVER (PARTITION BY ref ORDER BY epoch) > 3 AS INT), 1) AS f FROM c),
i AS (SELECT *, sum(f) OVER (PARTITION BY ref ORDER BY epoch) AS i FROM f)
SELECT ref, min(epoch) AS first, max(epoch) AS last, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_epochs FROM i GROUP BY ref, i HAVING count(*) >= 0.5 * (max(epoch) - min(epoch) + 1)""")
def burst_density(spark, sf_dir):
    return series.dense_bursts(raw(spark, sf_dir), ["ref"], 3, 0.5)


@query(f"WITH {RAW}, c AS (SELECT user_id, ref, count(*) AS n FROM raw GROUP BY ALL) SELECT user_id, ref, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, ref) AS rn FROM c) WHERE rn = 1")
def top_reference(spark, sf_dir):
    return series.top_name(raw(spark, sf_dir), ["user_id"], "ref")


ALLAN = """x AS (SELECT ref, epoch, phase, unnest([1, 2, 4, 8, 16]) AS m FROM readings), al AS (SELECT a.ref, a.m, count(*) AS terms,
CAST(sum((c.phase - 2 * b.phase + a.phase) * (c.phase - 2 * b.phase + a.phase)) AS BIGINT) AS squares FROM x a JOIN x b ON b.ref = a.ref AND b.m = a.m AND b.epoch = a.epoch + a.m
JOIN x c ON c.ref = a.ref AND c.m = a.m AND c.epoch = a.epoch + 2 * a.m GROUP BY a.ref, a.m)"""


def _allan(spark, sf_dir):
    return links.allan_sums(readings(spark, sf_dir), ["ref"], [1, 2, 4, 8, 16], "phase")


@query(f"WITH {READINGS}, {ALLAN} SELECT ref, m, terms, squares FROM al")
def allan_sums(spark, sf_dir):
    return _allan(spark, sf_dir)


@query(f"WITH {READINGS}, {ALLAN} SELECT m, CAST(sum(terms) AS BIGINT) AS terms, round(CAST(sum(squares) AS DOUBLE) / sum(terms) / (2 * (m * 600.0::DOUBLE) * (m * 600.0::DOUBLE)), 6) AS variance FROM al GROUP BY m")
def allan_combined(spark, sf_dir):
    return links.allan_variances(_allan(spark, sf_dir), []).select("m", "terms", F.round("variance", 6).alias("variance"))


STEER = """st AS (SELECT event_type AS ref, epoch_us(ts) AS us, CAST(user_id % 8 AS DOUBLE) - 3 AS dx, (user_id % 4) / 4096.0::DOUBLE AS dy FROM events WHERE user_id % 5 = 0)"""


def _steering(spark, sf_dir):
    return raw(spark, sf_dir).where("user_id % 5 = 0").select("ref", F.col("us").alias("applied_us"), ((F.col("user_id") % 8).cast("double") - 3).alias("dx"), ((F.col("user_id") % 4) / F.lit(4096.0)).alias("dy"))


@query(f"""WITH {STEER}, e AS (SELECT *, CAST(ceil(us / 600000000.0::DOUBLE) AS BIGINT) AS epoch FROM st)
SELECT ref, epoch, round(sum(dx + dy * ((epoch * 600000000 - us) / 1e6)), 6) AS move, round(sum(dy), 9) AS rate FROM e GROUP BY ALL""")
def steering_window(spark, sf_dir):
    return links.steering_by_epoch(_steering(spark, sf_dir)).select("ref", "epoch", F.round("move", 6).alias("move"), F.round("rate", 9).alias("rate"))


@query(f"""WITH {READINGS}, {STEER}, r AS (SELECT ref, epoch, us AS m FROM readings)
SELECT r.ref, epoch, round(coalesce(sum(dx + dy * ((m - us) / 1e6)), 0), 6) AS within FROM r LEFT JOIN st ON st.ref = r.ref AND us > epoch * 600000000 AND us <= m GROUP BY r.ref, epoch, m""")
def steering_within(spark, sf_dir):
    r = readings(spark, sf_dir).select("ref", "epoch", F.col("us").alias("measured_us"))
    return links.steering_within(r, _steering(spark, sf_dir)).select("ref", "epoch", F.round("within", 6).alias("within"))


@query(f"""WITH {RAW}, {STEER}, pr AS (SELECT DISTINCT 'mc' || CAST(length(ref) % 10 AS VARCHAR) AS ref, CASE WHEN user_id % 3 = 0 THEN 'mc' || CAST(user_id % 10 AS VARCHAR) ELSE 'u' || CAST(user_id % 20 AS VARCHAR) END AS clock, epoch FROM raw),
e AS (SELECT 'mc' || CAST(length(ref) % 10 AS VARCHAR) AS ref, CAST(ceil(us / 600000000.0::DOUBLE) AS BIGINT) AS epoch, sum(dx + dy * ((CAST(ceil(us / 600000000.0::DOUBLE) AS BIGINT) * 600000000 - us) / 1e6)) AS move, sum(dy) AS rate FROM st GROUP BY ALL),
sp AS (SELECT ref, clock, min(epoch) AS f, max(epoch) AS l FROM pr WHERE ref <> clock GROUP BY ALL),
un AS (SELECT DISTINCT sp.ref, sp.clock, e.epoch FROM sp JOIN e ON (e.ref = sp.ref OR e.ref = sp.clock) AND e.epoch > f AND e.epoch <= l + 40),
al AS (SELECT *, true AS is_read FROM pr UNION ALL SELECT un.*, false FROM un ANTI JOIN pr ON pr.ref = un.ref AND pr.clock = un.clock AND pr.epoch = un.epoch)
SELECT al.ref, al.clock, al.epoch, is_read, round(CASE WHEN al.ref = al.clock THEN 0 ELSE coalesce(a.move, 0) - coalesce(b.move, 0) END, 6) AS move, round(CASE WHEN al.ref = al.clock THEN 0 ELSE coalesce(a.rate, 0) - coalesce(b.rate, 0) END, 9) AS rate
FROM al LEFT JOIN e a ON a.ref = al.ref AND a.epoch = al.epoch LEFT JOIN e b ON b.ref = al.clock AND b.epoch = al.epoch""")
def steered_series(spark, sf_dir):
    """What steering does to pairs of references, clocks and themselves, in their own epochs and in those without a reading."""
    named = F.concat(F.lit("mc"), (F.length("ref") % 10).cast("string"))
    user = F.col("user_id")
    clock = F.when(user % 3 == 0, F.concat(F.lit("mc"), (user % 10).cast("string"))).otherwise(F.concat(F.lit("u"), (user % 20).cast("string")))
    rows = staged(raw(spark, sf_dir).select(F.lit("a").alias("channel"), named.alias("ref"), clock.alias("clock"), "epoch").distinct(), "series")
    by_epoch = staged(links.steering_by_epoch(_steering(spark, sf_dir).withColumn("ref", named)), "steering")
    every = rows.withColumn("is_read", F.lit(True)).unionByName(links.steered_unread(rows, by_epoch, ["ref", "clock"], 40).withColumn("is_read", F.lit(False)))
    return links.steered(every, by_epoch, ["ref", "clock"]).select("ref", "clock", "epoch", "is_read", F.round("move", 6).alias("move"), F.round("rate", 9).alias("rate"))


@query("""WITH s AS (SELECT o_custkey AS k, o_orderdate AS d, o_orderkey AS o, o_orderpriority AS p, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS t FROM orders WHERE o_orderkey % 2 = 0),
h AS (SELECT k, d, o, last_value(p IGNORE NULLS) OVER w AS p, last_value(t IGNORE NULLS) OVER w AS t FROM s WINDOW w AS (PARTITION BY k ORDER BY d, o ROWS UNBOUNDED PRECEDING)),
u AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY k, d ORDER BY o DESC) = 1)
SELECT q.o_orderkey, u.p AS priority, u.t AS status FROM orders q ASOF LEFT JOIN u ON q.o_custkey = u.k AND q.o_orderdate >= u.d WHERE q.o_orderkey % 2 = 1""")
def settings_asof(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    entries = orders.where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("k"), "o_orderdate", "o_orderkey", F.col("o_orderpriority").alias("priority"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"))
    intervals = links.setting_intervals(entries, ["k"], ["priority", "status"], "o_orderdate", "o_orderkey")
    asked = orders.where("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_custkey").alias("k"), "o_orderdate")
    return links.settings_at(asked, intervals, ["k"], ["priority", "status"], "o_orderdate").select("o_orderkey", "priority", "status")


@query("""WITH e AS (SELECT o_custkey AS k, o_orderdate AS d, o_orderkey AS o, o_orderpriority AS p, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS t FROM orders),
h AS (SELECT k, d, o, last_value(p IGNORE NULLS) OVER w AS p, last_value(t IGNORE NULLS) OVER w AS t FROM e WINDOW w AS (PARTITION BY k ORDER BY d, o ROWS UNBOUNDED PRECEDING)),
u AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY k, d ORDER BY o DESC) = 1),
c AS (SELECT k, d, p, t, lag(p) OVER w AS op, lag(t) OVER w AS ot, row_number() OVER w AS n FROM u WINDOW w AS (PARTITION BY k ORDER BY d))
SELECT k, d AS at, p AS priority, t AS status, op AS old_priority, ot AS old_status FROM c
WHERE d > TIMESTAMP '1996-01-01' AND d <= TIMESTAMP '1999-06-30' AND (n = 1 OR p IS DISTINCT FROM op OR t IS DISTINCT FROM ot)""")
def settings_changes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    entries = orders.select(F.col("o_custkey").alias("k"), "o_orderdate", "o_orderkey", F.col("o_orderpriority").alias("priority"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"))
    intervals = links.setting_intervals(entries, ["k"], ["priority", "status"], "o_orderdate", "o_orderkey")
    return links.setting_changes(intervals, ["k"], ["priority", "status"], F.lit("1996-01-01").cast("timestamp"), F.lit("1999-06-30").cast("timestamp"))


@query("""WITH p AS (SELECT DISTINCT l_suppkey AS ref, l_partkey AS clock FROM lineitem), o AS (SELECT ref, clock, min(l_quantity) AS lim FROM p JOIN lineitem ON l_suppkey = ref AND l_partkey = clock WHERE l_partkey % 3 = 0 GROUP BY ALL),
r AS (SELECT s_suppkey AS ref, s_acctbal AS lim FROM supplier WHERE s_suppkey % 2 = 0) SELECT p.ref, p.clock, coalesce(o.lim, r.lim, 50.0) AS lim FROM p LEFT JOIN o USING (ref, clock) LEFT JOIN r ON r.ref = p.ref""")
def limit_fallback(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("ref"), F.col("l_partkey").alias("clock"), "l_quantity")
    own = lines.where("clock % 3 = 0").groupBy("ref", "clock").agg(F.min("l_quantity").alias("limit"))
    of_ref = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("ref"), F.col("s_acctbal").alias("limit"))
    return links.limits_with_fallback(lines.select("ref", "clock").distinct(), own, of_ref, F.lit(50.0)).withColumnRenamed("limit", "lim")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def configured_only(spark, sf_dir):
    config = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return links.configured(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), config, "o_custkey")[0]


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def unconfigured(spark, sf_dir):
    config = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return links.configured(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), config, "o_custkey")[1]


@query(f"WITH {RAW} SELECT ref, user_id AS clock, min(epoch) AS since FROM raw GROUP BY ALL")
def pair_registry(spark, sf_dir):
    return links.pair_registry(raw(spark, sf_dir).withColumnRenamed("user_id", "clock"))


PAIRS = """pr AS (SELECT ref, clock, min(epoch) AS since FROM (SELECT ref, 'u' || CAST(user_id % 20 AS VARCHAR) AS clock, epoch FROM raw UNION ALL SELECT a.ref, b.ref, a.epoch FROM readings a JOIN readings b ON a.epoch = b.epoch) GROUP BY ALL),
loc AS (SELECT DISTINCT n AS name, CASE WHEN length(n) % 4 = 1 THEN NULL ELSE length(n) % 2 END AS location FROM (SELECT ref AS n FROM pr UNION SELECT clock FROM pr))"""


def _pairs(spark, sf_dir):
    r = readings(spark, sf_dir)
    users = raw(spark, sf_dir).select("ref", F.concat(F.lit("u"), (F.col("user_id") % 20).cast("string")).alias("clock"), "epoch")
    refs = r.select("ref", "epoch").join(r.select(F.col("ref").alias("clock"), "epoch"), "epoch").select("ref", "clock", "epoch")
    pairs = links.pair_registry(users.unionByName(refs))
    names = pairs.select(F.col("ref").alias("name")).union(pairs.select("clock")).distinct()
    return pairs, names.select("name", F.when(F.length("name") % 4 != 1, F.length("name") % 2).alias("location"))


@query(f"""WITH {READINGS}, {PAIRS} SELECT a.ref AS r, a.clock AS s, p.clock AS c, greatest(p.since, a.since, b.since) AS since FROM pr p JOIN pr a ON a.clock = p.ref JOIN pr b ON b.ref = a.clock AND b.clock = a.ref
JOIN loc x ON x.name = p.ref JOIN loc y ON y.name = p.clock WHERE x.location = y.location""")
def triple_registry(spark, sf_dir):
    return links.triple_registry(*_pairs(spark, sf_dir))


@query(f"""WITH {INNOVATIONS} SELECT epoch, ref, clock, abs(nu) <= 5 * scale AS in_gate, CASE WHEN epoch % 3 = 0 THEN true ELSE scale % 97 <= 60 END AS in_rms_limit FROM nus""")
def measured_gates(spark, sf_dir):
    """The gate on innovations and the limit on rms, where there is one."""
    limit = F.when(F.col("epoch") % 3 != 0, 60)
    return innovations(spark, sf_dir).select("epoch", "ref", "clock", rows.in_gate(F.col("nu"), F.col("scale")).alias("in_gate"), rows.in_rms_limit(F.col("scale") % 97, limit).alias("in_rms_limit"))


@query(f"WITH {INNOVATIONS} SELECT epoch, a, b, total, value, round(scale, 6) AS scale, in_gate FROM tw")
def reciprocity(spark, sf_dir):
    return links.two_way(innovations(spark, sf_dir)).withColumn("scale", F.round("scale", 6))


@query(f"""WITH {INNOVATIONS}, f AS (SELECT epoch, ref, nu, scale FROM nus WHERE ref = clock AND abs(nu) > 5 * scale)
SELECT n.epoch, n.ref, n.clock, n.ref = n.clock OR abs(n.nu - f.nu) <= 3 * sqrt(n.scale * n.scale + f.scale * f.scale) AS excluded FROM nus n JOIN f ON f.epoch = n.epoch AND f.ref = n.ref""")
def self_test(spark, sf_dir):
    return links.self_test(innovations(spark, sf_dir))


@query(f"WITH {INNOVATIONS}, e AS (SELECT epoch, a AS ref, in_gate FROM tw UNION ALL SELECT epoch, b, in_gate FROM tw) SELECT epoch, ref, count(*) AS tested FROM e GROUP BY ALL HAVING count(*) >= 2 AND NOT bool_or(in_gate)")
def faulty_references(spark, sf_dir):
    return links.faulty_references(links.two_way(innovations(spark, sf_dir)))


@query(f"""WITH {INNOVATIONS} SELECT x.epoch, x.a, x.b, y.b AS c, round(x.value + y.value - z.value, 6) AS closure, abs(x.value + y.value - z.value) <= 5 * sqrt(x.scale * x.scale + y.scale * y.scale + z.scale * z.scale) AS in_gate
FROM tw x JOIN tw y ON y.epoch = x.epoch AND y.a = x.b JOIN tw z ON z.epoch = x.epoch AND z.a = x.a AND z.b = y.b""")
def triangles(spark, sf_dir):
    return links.triangles(links.two_way(innovations(spark, sf_dir))).withColumn("closure", F.round("closure", 6))


@query(f"""WITH {INNOVATIONS} SELECT x.epoch, x.clock, x.ref AS a, y.ref AS b, x.nu - y.nu - t.value AS d, CAST(round_even((x.nu - y.nu - t.value) / 200000, 0) AS BIGINT) AS periods
FROM nus x JOIN nus y ON y.epoch = x.epoch AND y.clock = x.clock AND x.ref < y.ref JOIN tw t ON t.epoch = x.epoch AND t.a = x.ref AND t.b = y.ref""")
def slip_d(spark, sf_dir):
    n = innovations(spark, sf_dir)
    return links.slip_differences(n, links.two_way(n))


@query(f"""WITH {INNOVATIONS}, z AS (SELECT epoch, ref, clock, CASE WHEN (epoch + length(clock)) % 3 > 0 THEN CAST(nu * 4 AS BIGINT) END AS z FROM nus), rt AS (SELECT epoch, ref AS r, clock AS s, CAST(scale AS BIGINT) AS t FROM nus),
tr AS (SELECT DISTINCT a.ref AS r, b.ref AS s, b.clock AS c FROM (SELECT DISTINCT ref FROM nus) a, (SELECT DISTINCT ref, clock FROM nus) b),
j AS (SELECT tr.*, sc.epoch, sc.z AS zsc, rs.z AS zrs, sr.z AS zsr, rt.t FROM tr JOIN z sc ON sc.ref = tr.s AND sc.clock = tr.c LEFT JOIN z rs ON rs.ref = tr.r AND rs.clock = tr.s AND rs.epoch = sc.epoch
LEFT JOIN z sr ON sr.ref = tr.s AND sr.clock = tr.r AND sr.epoch = sc.epoch LEFT JOIN rt ON rt.r = tr.r AND rt.s = tr.s AND rt.epoch = sc.epoch),
k AS (SELECT *, coalesce(zrs - zsr, 2 * zrs - t, t - 2 * zsr) AS u, CASE WHEN r = s THEN 'pair' WHEN zrs - zsr IS NOT NULL THEN 'both' WHEN 2 * zrs - t IS NOT NULL THEN 'out' WHEN t - 2 * zsr IS NOT NULL THEN 'back' END AS used FROM j)
SELECT r, s, c, epoch, CASE WHEN r = s THEN zsc ELSE zsc + CAST(round_even(u / 2.0::DOUBLE, 0) AS BIGINT) END AS dd, used FROM k WHERE zsc IS NOT NULL AND (r = s OR u IS NOT NULL)""")
def double_difference(spark, sf_dir):
    n = innovations(spark, sf_dir)
    seen = (F.col("epoch") + F.length("clock")) % 3 > 0  # a link has no reading in every third epoch or so
    z = n.select("ref", "clock", "epoch", F.when(seen, (F.col("nu") * 4).cast("long")).alias("z"))
    trip = n.select(F.col("ref").alias("r"), F.col("clock").alias("s"), "epoch", F.col("scale").cast("long").alias("round_trip"))
    pairs = n.select(F.col("ref").alias("s"), F.col("clock").alias("c")).distinct()
    sides = pairs.select(F.col("s").alias("r"), F.col("c").alias("s")).union(pairs.select(F.col("c").alias("r"), "s")).union(pairs.select(F.col("s").alias("r"), "s")).distinct()
    triples = sides.join(pairs, "s")  # a reference that has a link with s, or s itself
    return links.double_differences(triples, z, trip)


@query(f"""WITH {READINGS}, b AS (SELECT ref, epoch, list(phase) OVER w AS y, list(epoch) OVER w AS x FROM readings WINDOW w AS (PARTITION BY ref ORDER BY epoch ROWS 2 PRECEDING))
SELECT ref, epoch, round((y[1] + y[2] + y[3]) / 3.0::DOUBLE, 6) AS mean, round((y[3] - y[1]) / 2.0::DOUBLE, 6) AS slope, y[3] - 2 * y[2] + y[1] AS bend FROM b WHERE len(y) = 3 AND x[3] - x[1] = 2""")
def step_fit(spark, sf_dir):
    w = Window.partitionBy("ref").orderBy("epoch").rowsBetween(-2, 0)
    b = readings(spark, sf_dir).select("ref", "epoch", F.collect_list("phase").over(w).alias("y"), F.min("epoch").over(w).alias("x")).where((F.size("y") == 3) & (F.col("epoch") - F.col("x") == 2))
    y = lambda i: F.col("y")[i]
    return b.select("ref", "epoch", F.round((y(0) + y(1) + y(2)) / 3, 6).alias("mean"), F.round((y(2) - y(0)) / 2, 6).alias("slope"), (y(2) - 2 * y(1) + y(0)).alias("bend"))


@query("""WITH s AS (SELECT p_partkey, 1 + p_partkey % 3 AS n, 1.0::DOUBLE + p_partkey % 200 AS m FROM part), l AS (SELECT *, exp(-1.0::DOUBLE / m) AS l FROM s)
SELECT p_partkey, round(CASE n WHEN 1 THEN 1.0 WHEN 2 THEN 1 - l * l ELSE 1 - l * l * l END, 9) AS g, round(1e6 * CASE n WHEN 1 THEN 0.0 WHEN 2 THEN (1 - l) * (1 - l) / 600 ELSE 1.5 * (1 - l) * (1 - l) * (1 + l) / 600 END, 6) AS h,
round(1e9 * CASE n WHEN 3 THEN (1 - l) * (1 - l) * (1 - l) / 360000 ELSE 0.0 END, 6) AS k FROM l""")
def gains_table(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", numeric.gains(1 + F.col("p_partkey") % 3, F.lit(1.0) + F.col("p_partkey") % 200).alias("g"))
    return p.select("p_partkey", F.round("g.g", 9).alias("g"), F.round(1e6 * F.col("g.h"), 6).alias("h"), F.round(1e9 * F.col("g.k"), 6).alias("k"))


@query(f"""WITH {READINGS}, m AS (SELECT ref, epoch // 144 AS day, avg(epoch) AS me, avg(phase) AS ml, greatest(max(epoch) - min(epoch), 1) AS sp FROM readings GROUP BY ALL),
t AS (SELECT r.ref, m.day, (epoch - me) / sp AS t, phase - ml AS y FROM readings r JOIN m ON m.ref = r.ref AND m.day = r.epoch // 144),
s AS (SELECT ref, day, count(*) AS n, sum(t) AS t1, sum(t*t) AS t2, sum(t*t*t) AS t3, sum(t*t*t*t) AS t4, sum(y) AS y0, sum(y*t) AS y1, sum(y*t*t) AS y2, sum(y*y) AS yy FROM t GROUP BY ALL HAVING count(*) >= 6),
d AS (SELECT *, n*(t2*t4-t3*t3) - t1*(t1*t4-t3*t2) + t2*(t1*t3-t2*t2) AS w, y0*(t2*t4-t3*t3) - t1*(y1*t4-t3*y2) + t2*(y1*t3-t2*y2) AS a, n*(y1*t4-t3*y2) - y0*(t1*t4-t3*t2) + t2*(t1*y2-y1*t2) AS b, n*(t2*y2-y1*t3) - t1*(t1*y2-y1*t2) + y0*(t1*t3-t2*t2) AS c FROM s)
SELECT ref, day, n, round(sqrt(greatest(yy - a/w*y0 - b/w*y1 - c/w*y2, 0) / n), 2) AS rms FROM d""")
def quadratic_residual(spark, sf_dir):
    by_day = readings(spark, sf_dir).withColumn("day", series.day_of_epoch(F.col("epoch")))
    return links.quadratic_residual(by_day, ["ref", "day"], "phase").where("n >= 6").withColumn("rms", F.round("rms", 2))


@query("SELECT k, 'known' AS side FROM (SELECT l_orderkey AS k FROM lineitem WHERE l_quantity > 45 UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT k, 'left' FROM (SELECT o_orderkey AS k FROM orders EXCEPT SELECT l_orderkey FROM lineitem) UNION ALL SELECT k, 'both' FROM (SELECT o_orderkey AS k FROM orders INTERSECT SELECT l_orderkey FROM lineitem WHERE l_discount > 0.09)")
def set_ops(spark, sf_dir):
    """Each key's marks meet in one aggregate; its tasks follow the rows, so that none holds more of them as the tables grow."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    marked = lambda key, **marks: (F.col(key).alias("k"), *(marks.get(m, F.lit(False)).alias(m) for m in ("order", "line", "known", "high")))
    of_orders = orders.select(*marked("o_orderkey", order=F.lit(True), known=F.col("o_orderstatus") == "P"))
    of_lines = lines.select(*marked("l_orderkey", line=F.lit(True), known=F.col("l_quantity") > 45, high=F.col("l_discount") > 0.09))
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-(lines.count() + orders.count()) // 500_000))
    keys = of_orders.union(of_lines).repartition(parts, "k").groupBy("k").agg(*(F.coalesce(F.bool_or(m), F.lit(False)).alias(m) for m in ("order", "line", "known", "high")))
    order, line, known, high = (F.col(c) for c in ("order", "line", "known", "high"))
    sides = F.array(F.when(known, "known"), F.when(order & ~line, "left"), F.when(order & high, "both"))
    return keys.select("k", F.explode(sides).alias("side")).where("side IS NOT NULL")


@query(f"WITH {READINGS} SELECT ref, max(epoch) AS epoch, arg_max(phase, epoch) AS phase, arg_max(event_id, epoch) AS event_id FROM readings GROUP BY ref")
def last_row_per_series(spark, sf_dir):
    return series.newest_rows(readings(spark, sf_dir).select("ref", "epoch", "phase", "event_id"), ["ref"])


@query(f"""WITH {RAW}, l AS (SELECT event_id, 'das_a.' || ref || '.u' || CAST(user_id AS VARCHAR) || CASE WHEN user_id % 4 = 0 THEN ' held at ' ELSE ' rejected at ' END || strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S') || ': x' AS line FROM raw)
SELECT event_id, regexp_extract(line, '^das_a\\.([^.]+)\\.([^ ]+) rejected at (\\S+):', 1) AS ref, regexp_extract(line, '^das_a\\.([^.]+)\\.([^ ]+) rejected at (\\S+):', 2) AS clock,
CAST(epoch_us(CAST(regexp_extract(line, '^das_a\\.([^.]+)\\.([^ ]+) rejected at (\\S+):', 3) AS TIMESTAMP)) // 600000000 AS BIGINT) AS epoch FROM l WHERE regexp_matches(line, '^das_a\\.([^.]+)\\.([^ ]+) rejected at (\\S+):')""")
def rejection_log_parse(spark, sf_dir):
    from ..sources.logs import rejections

    what = F.when(F.col("user_id") % 4 == 0, " held at ").otherwise(" rejected at ")
    at = F.date_format(timefn.us_to_timestamp(F.col("us")), "yyyy-MM-dd'T'HH:mm:ss")
    lines = raw(spark, sf_dir).select("event_id", F.concat(F.lit("das_a."), "ref", F.lit(".u"), F.col("user_id").cast("string"), what, at, F.lit(": x")).alias("value"))
    return rejections(lines, "a", "event_id").select("event_id", F.element_at("names", 1).alias("ref"), F.element_at("names", 2).alias("clock"), "epoch")


@query(f"""WITH {RAW}, f AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'A' WHEN 1 THEN 'AN' WHEN 2 THEN 'PD' WHEN 3 THEN 'AA' WHEN 4 THEN 'Z' WHEN 5 THEN 'AU' WHEN 6 THEN 'NA' WHEN 7 THEN 'DP' ELSE '' END AS f FROM raw)
SELECT event_id, f AS flags, regexp_full_match(f, 'A?R?X?P?O?D?S?N?U?') AS is_valid, NOT (contains(f, 'D') AND contains(f, 'P')) AS is_written, contains(f, 'A') AND NOT contains(f, 'U') AS is_usable FROM f""")
def flag_grammar(spark, sf_dir):
    kinds = F.array(*(F.lit(f) for f in ("A", "AN", "PD", "AA", "Z", "AU", "NA", "DP", "")))
    f = raw(spark, sf_dir).select("event_id", F.get(kinds, (F.col("event_id") % 9).cast("int")).alias("flags"))
    return f.select("event_id", "flags", rows.valid_flags(F.col("flags")).alias("is_valid"), rows.is_written(F.col("flags")).alias("is_written"), rows.is_usable(F.col("flags")).alias("is_usable"))


@query()
def bad_stretches(spark, sf_dir):
    """Two-hour buckets of all readings; by spans of 40 buckets the clock is quiet, or quartz, without signal, far off."""
    b, kind = F.col("epoch"), F.floor(F.col("epoch") / 40) % 8
    common = F.pmod(F.xxhash64(b), F.lit(16_000))
    phase = F.when(kind == 2, common).when(kind == 4, F.col("phase")).when(kind == 6, F.pmod(b * 30_000 + F.col("phase") % 100, F.lit(200_000))).otherwise(F.col("phase") % 100)
    r = raw(spark, sf_dir).select("ref", F.lit("c").alias("clock"), F.floor(F.col("epoch") / 12).cast("long").alias("epoch"), "us", "event_id", "phase")
    first = series.first_readings(r, ["ref", "clock"], ["us", "event_id"])
    c = series.one_epoch_changes(first.withColumn("phase", phase.cast("long")), ["ref", "clock"])
    return stretches.bad_stretches(c, 6)


def _deployment(spark, sf_dir):
    """Readings and setup of four references that measure each other and eleven clocks whose phases drift, with the events' gaps.

    Every event is a reading: where several fall on one pair and epoch, each goes to a channel of its own.
    """
    r = raw(spark, sf_dir).select(F.concat(F.lit("mc"), (F.col("user_id") % 4).cast("string")).alias("ref"), (F.col("user_id") % 15).alias("n"), "epoch", "delta_us", "event_id")
    clock = F.when(F.col("n") < 4, F.concat(F.lit("mc"), F.col("n").cast("string"))).otherwise(F.concat(F.lit("u"), F.col("n").cast("string")))
    epoch = F.floor(F.col("epoch") / 24).cast("long")
    phase = F.pmod(F.col("n") * epoch * 40 + F.col("event_id") % 5, F.lit(200_000)).cast("long")
    channel = F.concat(F.lit("a"), F.row_number().over(Window.partitionBy("ref", "n", epoch).orderBy("event_id")).cast("string"))
    data = r.select(channel.alias("channel"), "ref", clock.alias("clock"), epoch.alias("epoch"), (F.col("delta_us") % 1_000_000).alias("delta_us"), phase.alias("phase"), F.lit(3).alias("rms"), "event_id")
    first = series.first_readings(data, ["channel", "ref", "clock"], ["event_id"])
    value = F.struct(F.lit(2).alias("states"), F.lit(20.0).alias("m"), F.lit(30.0).alias("m_sigma"), F.lit(50.0).alias("sigma0"), F.lit(40).alias("gap_limit"), F.lit(12).alias("breaks_at"), F.lit(144.0).alias("fraction_epochs"), F.lit(0.5).alias("fraction_limit"), F.lit(50).alias("rms_limit"))
    written = staged(first.drop("event_id"), "readings")
    return written, history.Setup(written.select("clock").distinct().withColumn("settings", value))


@query()
def pair_history(spark, sf_dir):
    return history.pair_history(*_deployment(spark, sf_dir))


@query()
def triple_history(spark, sf_dir):
    data, setup = _deployment(spark, sf_dir)
    pairs = staged(history.pair_history(data, setup), "pairs")
    known = links.pair_registry(pairs.where("z IS NOT NULL"))
    return history.triple_history(pairs, history.known_triples(known, setup).drop("since"), setup)


@query()
def noise_models(spark, sf_dir):
    from ..operators import noise

    values = readings(spark, sf_dir).select(F.lit("c").alias("clock"), "ref", F.lit(0).alias("piece"), "epoch", (F.col("phase") % 1000).cast("double").alias("value"))
    return noise.characterize(values, 144)


@query(f"""WITH {READINGS}, s AS (SELECT ref, epoch, phase / 1000.0::DOUBLE AS nu, row_number() OVER (PARTITION BY ref ORDER BY epoch) AS n FROM readings),
r AS (WITH RECURSIVE r AS (SELECT ref, n, epoch, nu, sqrt(greatest((1 - 0.125) * 100.0 ** 2 + 0.125 * nu ** 2, 4.0)) AS scale, CASE WHEN nu > 100 THEN 0.125 ELSE 0.0 END::DOUBLE AS f FROM s WHERE n = 1
 UNION ALL SELECT s.ref, s.n, s.epoch, s.nu, sqrt(greatest((1 - 0.125) * r.scale ** 2 + 0.125 * s.nu ** 2, 4.0)), (1 - 0.125) * r.f + CASE WHEN s.nu > 100 THEN 0.125 ELSE 0 END FROM r JOIN s ON s.ref = r.ref AND s.n = r.n + 1) SELECT * FROM r)
SELECT ref, max(n) AS n, round(arg_max(scale, n), 6) AS scale, round(arg_max(f, n), 6) AS reject_fraction FROM r GROUP BY ref""")
def scale_fold(spark, sf_dir):
    r = readings(spark, sf_dir).select("ref", "epoch", (F.col("phase") / 1000).alias("nu"))
    n = r.groupBy("ref").agg(F.count(F.lit(1)).alias("n"))
    folded = series.folded_scale(r, ["ref"], "nu", 100).drop("n").join(n, "ref")
    return folded.select("ref", "n", F.round("scale", 6).alias("scale"), F.round("reject_fraction", 6).alias("reject_fraction"))


@query()
def scale_fold_all(spark, sf_dir):
    """The same fold as its operator gives it."""
    r = readings(spark, sf_dir).select("ref", "epoch", (F.col("phase") / 1000).alias("nu"))
    return series.folded_scale(r, ["ref"], "nu", 100).withColumn("scale", F.round("scale", 6)).withColumn("reject_fraction", F.round("reject_fraction", 6))


REJECTS = f"""{RAW}, rj AS (SELECT 'u' || CAST(user_id % 10 AS VARCHAR) AS clock, ref, epoch // 3 + 100000 * (user_id % 3) AS epoch FROM raw),
sh AS (SELECT epoch FROM rj GROUP BY epoch HAVING count(DISTINCT clock) >= 3)"""


def _rejects(spark, sf_dir):
    """Every event is a rejection; each third of the users has a span of time of its own, so that not every epoch is shared."""
    epoch = F.floor(F.col("epoch") / 3).cast("long") + 100_000 * (F.col("user_id") % 3)
    return raw(spark, sf_dir).select(F.concat(F.lit("u"), (F.col("user_id") % 10).cast("string")).alias("clock"), F.array("ref").alias("refs"), epoch.alias("epoch"))


@query(f"""WITH {REJECTS}, c AS (SELECT clock, epoch, count(*) AS n FROM rj WHERE epoch NOT IN (SELECT epoch FROM sh) GROUP BY ALL),
f AS (SELECT *, coalesce(CAST(epoch - lag(epoch) OVER (PARTITION BY clock ORDER BY epoch) - 1 >= 8 AS INT), 1) AS f FROM c), i AS (SELECT *, sum(f) OVER (PARTITION BY clock ORDER BY epoch) AS i FROM f)
SELECT clock, min(epoch) AS first, max(epoch) + 1 AS stop, CAST(sum(n) AS BIGINT) AS rejections, count(*) AS rejected_epochs FROM i GROUP BY clock, i HAVING max(epoch) + 1 - min(epoch) >= 8 AND count(*) >= 0.2 * (max(epoch) + 1 - min(epoch))""")
def reject_stretches(spark, sf_dir):
    from ..operators import rejects

    none = spark.createDataFrame([], "clock string, start long, end long, open_ended boolean")
    found = rejects.reject_stretches(_rejects(spark, sf_dir), none, 8, 0.2, 3)
    # without disabled spans every burst is a stretch, as bursts are at least so far apart
    return found.select("clock", F.col("start").alias("first"), F.col("end").alias("stop"), "rejections", "rejected_epochs")


@query(f"""WITH {REJECTS}, f AS (SELECT *, coalesce(CAST(epoch - lag(epoch) OVER (ORDER BY epoch) - 1 >= 8 AS INT), 1) AS f FROM sh), i AS (SELECT *, sum(f) OVER (ORDER BY epoch) AS i FROM f),
sp AS (SELECT min(epoch) AS first, max(epoch) + 1 AS stop FROM i GROUP BY i), h AS (SELECT sp.*, rj.* FROM rj JOIN sp ON rj.epoch >= first AND rj.epoch < stop),
tc AS (SELECT first, ref, count(*) AS n FROM h GROUP BY first, ref), t AS (SELECT *, row_number() OVER (PARTITION BY first ORDER BY n DESC, ref) AS rn FROM tc), m AS (SELECT first, max(n) AS most FROM (SELECT first, epoch, count(DISTINCT clock) AS n FROM h GROUP BY ALL) GROUP BY first)
SELECT h.first, h.stop, any_value(m.most) AS most_clocks, any_value(t.ref) AS reference, any_value(t.n) AS through_reference, count(*) AS rejections FROM h JOIN t ON t.first = h.first AND rn = 1 JOIN m ON m.first = h.first GROUP BY h.first, h.stop""")
def shared_stretches(spark, sf_dir):
    from ..operators import rejects

    found = rejects.shared_stretches(_rejects(spark, sf_dir), 8, 3)
    return found.select(F.col("start").alias("first"), F.col("end").alias("stop"), "most_clocks", "reference", "through_reference", "rejections")


MEASURED = f"""{RAW}, ms AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS channel, 'mc' || CAST(user_id % 12 AS VARCHAR) AS ref,
 CASE WHEN user_id % 7 = 0 THEN 'mc' || CAST(user_id % 9 AS VARCHAR) ELSE ref || CAST(user_id % 13 AS VARCHAR) END AS clock FROM raw)"""


def _measured(spark, sf_dir):
    """Pairs that are measured; twelve names of references, of which ten are references' own, and clocks that are references too."""
    user = F.col("user_id")
    clock = F.when(user % 7 == 0, F.concat(F.lit("mc"), (user % 9).cast("string"))).otherwise(F.concat("ref", (user % 13).cast("string")))
    return raw(spark, sf_dir).select(F.when(F.col("event_id") % 2 == 0, "a").otherwise("b").alias("channel"), F.concat(F.lit("mc"), (user % 12).cast("string")).alias("ref"), clock.alias("clock"))


@query(f"""WITH {MEASURED} SELECT channel, clock, string_agg(DISTINCT ref, ',' ORDER BY ref) AS refs FROM ms
WHERE regexp_full_match(ref, 'mc[0-9]') AND NOT regexp_full_match(clock, 'mc[0-9]') AND NOT starts_with(clock, 'v') GROUP BY ALL""")
def measured_clocks(spark, sf_dir):
    return summary.references_of(_measured(spark, sf_dir), ["v"]).withColumn("refs", F.array_join("refs", ","))


@query(f"WITH {MEASURED} SELECT DISTINCT 'das_' || channel || '.' || ref || '.' || clock AS name, 'das_' || channel || '.' || ref || '.' || ref || '.' || clock AS local_name FROM ms")
def series_names(spark, sf_dir):
    channel, ref, clock = (F.col(c) for c in ("channel", "ref", "clock"))
    return _measured(spark, sf_dir).select(summary.series_name(channel, [ref, clock]).alias("name"), summary.series_name(channel, [ref, ref, clock]).alias("local_name")).distinct()


@query(f"""WITH {RAW}, f AS (SELECT epoch, event_id % 3 = 0 AS of_pair, CASE event_id % 7 WHEN 0 THEN 'A' WHEN 1 THEN 'AN' WHEN 2 THEN 'PD' WHEN 3 THEN 'R' WHEN 4 THEN 'P' WHEN 5 THEN 'RD' ELSE 'AU' END AS f FROM raw)
SELECT 'a' AS channel, epoch, count(*) FILTER (of_pair) AS pairs, count(*) FILTER (NOT of_pair) AS triples, count(*) FILTER (contains(f, 'A')) AS accepted, count(*) FILTER (NOT contains(f, 'A')) AS held FROM f WHERE f <> 'PD' GROUP BY epoch""")
def epoch_counts(spark, sf_dir):
    flags = F.array(*(F.lit(f) for f in ("A", "AN", "PD", "R", "P", "RD", "AU")))
    rows = raw(spark, sf_dir).select(F.lit("a").alias("channel"), "epoch", F.get(flags, (F.col("event_id") % 7).cast("int")).alias("flags"), (F.col("event_id") % 3 == 0).alias("of_pair"))
    return summary.epoch_counts(rows.where("of_pair"), rows.where("NOT of_pair"))


@query(f"""WITH {READINGS}, d AS (SELECT ref, phase - lag(phase) OVER w AS change, epoch - lag(epoch) OVER w AS gap FROM readings WINDOW w AS (PARTITION BY ref ORDER BY epoch)),
rt AS (SELECT ref, median(change) / 600.0::DOUBLE AS rate FROM d WHERE gap = 1 GROUP BY ref)
SELECT r.ref, r.epoch, round(phase - coalesce(rate * (delta_us / 1e6::DOUBLE), 0.0::DOUBLE), 4) AS value FROM readings r LEFT JOIN rt ON rt.ref = r.ref WHERE r.delta_us % 5 <> 0""")
def offset_join(spark, sf_dir):
    r = staged(readings(spark, sf_dir), "readings")
    offsets = r.where("delta_us % 5 <> 0").select("ref", "epoch", (F.col("delta_us") / F.lit(1e6)).alias("offset_s"))
    values = r.select("ref", "epoch", F.col("phase").cast("double").alias("value"))
    return characterization.to_epoch_start(values, offsets, ["ref"], ["ref"]).withColumn("value", F.round("value", 4))


REPORT = ORACLES["reject_stretches"]
_MJD = "CAST(({0} + 5844528) // 144 AS VARCHAR) || '.' || lpad(CAST(({0} + 5844528) % 144 * 1000000 // 144 AS VARCHAR), 6, '0')"


@query(f"""WITH st AS ({REPORT}) SELECT clock || ' ' || {_MJD.format("first")} || ' ' || {_MJD.format("stop")} || ' ' || printf('%.1f', (stop - first) / 6.0::DOUBLE) || ' ' || CAST(rejections AS VARCHAR) || ' ' || CAST(rejected_epochs AS VARCHAR) || ' 0' AS line FROM st""")
def reject_report(spark, sf_dir):
    found = reject_stretches(spark, sf_dir).withColumnsRenamed({"first": "start", "stop": "end"})
    mjd = 40_587 * timefn.EPOCHS_PER_DAY
    dated = found.select("clock", (F.col("start") + mjd).alias("start"), (F.col("end") + mjd).alias("end"), F.lit(False).alias("open_ended"), "rejections", "rejected_epochs", F.lit(0).alias("replaced"))
    return summary.reject_stretch_lines(dated)


def _states(rows):
    """Every column of a state, made of a reading; buffers of none to three values."""
    n, v = F.col("event_id"), F.col("phase") / 7
    none = F.lit(None)
    buffer = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct((F.col("epoch") - 4 + i).alias("epoch"), (v * i).alias("value")))
    return rows.select(
        F.lit("a").alias("channel"), "*", (F.col("phase") * 1000 - n % 100_000_000).alias("x_fs"), F.when(n % 3 > 0, v / 1e9).alias("y"), F.when(n % 3 > 1, -v / 1e15).alias("d"), F.when(n % 5 > 0, v).alias("innovation_scale"),
        (n % 11 - 5).alias("step_offset"), *((n % k).alias(c) for k, c in ((99, "epochs_in_segment"), (9, "epochs_since_accept"), (4, "consecutive_rejects"))), (v % 1).alias("reject_fraction"), F.slice(buffer, F.lit(1), (n % 4).cast("int")).alias("buffer"),
        F.lit(2).alias("filter_states"), F.when(n % 2 > 0, F.lit(20.5)).otherwise(none).alias("time_constant"), F.lit(30.0).alias("scale_time_constant"), F.when(n % 2 > 0, "A").otherwise("RXU").alias("flags"),
    )


_READ_BACK = """phase * 1000 - event_id % 100000000 AS x_fs, CASE WHEN event_id % 3 > 0 THEN phase / 7.0::DOUBLE / 1e9::DOUBLE END AS y, CASE WHEN event_id % 5 > 0 THEN phase / 7.0::DOUBLE END AS innovation_scale,
CAST(event_id % 11 - 5 AS BIGINT) AS step_offset, CAST(event_id % 4 AS BIGINT) AS n_buffer, CASE WHEN event_id % 4 > 0 THEN phase / 7.0::DOUBLE * (event_id % 4) END AS newest, CASE WHEN event_id % 4 > 0 THEN epoch - 4 + event_id % 4 END AS newest_epoch, CASE WHEN event_id % 2 > 0 THEN 'A' ELSE 'RXU' END AS flags"""


def _read_back(rows, *columns):
    last = F.try_element_at("buffer", F.lit(-1))
    return rows.select(*columns, "x_fs", "y", "innovation_scale", "step_offset", F.size("buffer").cast("long").alias("n_buffer"), last["value"].alias("newest"), last["epoch"].alias("newest_epoch"), "flags")


@query(f"""WITH {READINGS} SELECT ref, epoch, CASE WHEN event_id % 6 > 0 THEN us END AS measured_us, CASE WHEN event_id % 6 > 0 THEN delta_us / 1e6::DOUBLE END AS offset_s,
CASE WHEN event_id % 6 > 0 THEN phase END AS measured_phase, CASE WHEN event_id % 6 > 0 THEN phase - 200000 * (event_id % 3) END AS z, {_READ_BACK} FROM readings""")
def pair_rows_text(spark, sf_dir):
    """Every reading written as a fixed-width row of a pair and read back."""
    read = F.col("event_id") % 6 > 0
    given = lambda value: F.when(read, value)
    measured = readings(spark, sf_dir).select("ref", F.lit("c").alias("clock"), "epoch", "event_id", "phase", given(F.col("us")).alias("measured_us"), given(F.col("phase")).alias("measured_phase"), given(F.lit(3)).alias("rms"), given(-F.col("event_id") % 3).alias("cycle_count"), given(F.col("phase") - 200_000 * (F.col("event_id") % 3)).alias("z"))
    text = text_archive.encode(_states(measured), "meas").select("channel", "ref", "clock", "value")
    return _read_back(text_archive.decode(text, "meas"), "ref", "epoch", "measured_us", "offset_s", "measured_phase", "z")


@query(f"WITH {READINGS} SELECT ref AS s, epoch, CASE WHEN event_id % 6 > 0 THEN phase - 7 END AS z, CASE WHEN event_id % 6 > 0 THEN '110' END AS components_used, CASE WHEN event_id % 6 > 0 THEN phase / 3.0::DOUBLE END AS innovation, {_READ_BACK} FROM readings WHERE epoch % 144 < 72")
def triple_rows_text(spark, sf_dir):
    """The same for rows of triples, of which only the half days that are asked for are read."""
    given = lambda value: F.when(F.col("event_id") % 6 > 0, value)
    measured = readings(spark, sf_dir).select(F.lit("r").alias("r"), F.col("ref").alias("s"), F.lit("c").alias("c"), "epoch", "event_id", "phase", given(F.col("phase") - 7).alias("z"), given(F.col("phase") / 3).alias("innovation"), given(F.lit(2.5)).alias("double_difference_sigma"), given(F.lit("110")).alias("components_used"))
    text = text_archive.encode(_states(measured), "ddiff").select("channel", "r", "s", "c", "value")
    return _read_back(text_archive.decode(text, "ddiff").where("epoch % 144 < 72"), "s", "epoch", "z", "components_used", "innovation")
