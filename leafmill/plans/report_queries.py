"""Reports, incremental runs and relational standards over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import scoring as Q
from leafmill.plans.aggregate_queries import _SCALED, _quality_sql
from leafmill.plans.registry import query
from leafmill.session import materialize, table
from leafmill.streaming import incremental as I


@query(f"SELECT coalesce(l, 'all') AS lang, coalesce(s, 'all') AS source, count(*) AS n, sum({_SCALED.format('q')})::BIGINT AS quality FROM (SELECT coalesce(lang, '?') AS l, coalesce(source, '?') AS s, q FROM documents JOIN ({_quality_sql('documents', 'doc_id')}) USING (doc_id)) GROUP BY ROLLUP (l, s)")
def r_quality_rollup(spark, d):
    scored = table(spark, d, "documents").select(F.coalesce("lang", F.lit("?")).alias("l"), F.coalesce("source", F.lit("?")).alias("s"), Q.scaled(Q.page_quality(F.col("text"))).alias("q"))
    return scored.rollup("l", "s").agg(F.count("*").alias("n"), F.sum("q").alias("quality")).select(F.coalesce("l", F.lit("all")).alias("lang"), F.coalesce("s", F.lit("all")).alias("source"), "n", "quality")


@query("SELECT coalesce(extraction_method, 'all') AS method, coalesce(grade, 'all') AS grade, count(*) AS n FROM (SELECT coalesce(extraction_method, '?') AS extraction_method, coalesce(quality_score.grade, '?') AS grade FROM extraction_result) GROUP BY CUBE (extraction_method, grade)")
def r_quality_cube(spark, d):
    rows = table(spark, d, "extraction_result").select(F.coalesce("extraction_method", F.lit("?")).alias("m"), F.coalesce("quality_score.grade", F.lit("?")).alias("g"))
    return rows.cube("m", "g").agg(F.count("*").alias("n")).select(F.coalesce("m", F.lit("all")).alias("method"), F.coalesce("g", F.lit("all")).alias("grade"), "n")


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN coalesce(text, '') = '' THEN 'failed' WHEN quality_score.overall < 4 THEN 'poor' ELSE 'ok' END AS status FROM extraction_result) GROUP BY 1")
def r_run_summary(spark, d):
    status = F.when(F.coalesce("text", F.lit("")) == "", "failed").when(F.col("quality_score.overall") < 4, "poor").otherwise("ok")
    return table(spark, d, "extraction_result").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query()
def r_approx_distinct(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("parts"), F.percentile_approx("l_quantity", 0.5).alias("median"))


# ---- incremental runs


@query("SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, props FROM events) GROUP BY 1")
def i_dedup_state(spark, d):
    seen = table(spark, d, "events").select("user_id", "event_type", "props").dropDuplicates()
    return seen.groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT file_id, count(*) AS n, max(result_id) AS newest FROM extraction_result WHERE file_id IN (SELECT file_id FROM extraction_result WHERE loaded_at >= TIMESTAMPTZ '2024-01-01 00:00:00+00') GROUP BY 1")
def i_regroup_changed(spark, d):
    runs = table(spark, d, "extraction_result")
    again = I.changed_groups(runs, runs.filter(F.col("loaded_at") < F.lit("2024-01-01 00:00:00").cast("timestamp")), "result_id", "file_id")
    return again.groupBy("file_id").agg(F.count("*").alias("n"), F.max("result_id").alias("newest"))


@query("WITH o AS (SELECT file_id, result_id, processed_at, metadata.journal AS v FROM extraction_result WHERE coalesce(metadata.journal, '') <> '') SELECT file_id, result_id, old, v AS new FROM (SELECT *, lag(v) OVER (PARTITION BY file_id ORDER BY processed_at, result_id) AS old FROM o) WHERE old IS NOT NULL AND old <> v")
def i_contact_history(spark, d):
    from leafmill.operators.sequences import change_log

    rows = table(spark, d, "extraction_result").select("file_id", F.struct("processed_at", "result_id").alias("at"), "result_id", F.col("metadata.journal").alias("v"))
    return change_log(rows, ["file_id"], "at", "result_id", "v").select("file_id", F.col("at.result_id").alias("result_id"), "old", "new")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def i_tumbling(spark, d):
    """The same plan in a stream: the events are read as files by the available-now trigger into a complete result."""
    source = table(spark, d, "events")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    counts = I.tumbling(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", "event_type")
    import uuid

    from leafmill.session import shared_dir

    home = f"{shared_dir(spark)}/tumbling-{uuid.uuid4().hex}"
    rows = f"{home}/rows"
    # Complete mode writes the whole result with every batch; only the last batch counts.
    run = counts.writeStream.outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{home}/state").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(rows)).start()
    run.awaitTermination()
    out = spark.read.parquet(rows)
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


@query("SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, count(*) AS n FROM (SELECT user_id, ts, sum(CASE WHEN gap IS NULL OR gap >= 3600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events)) GROUP BY user_id, s")
def i_session(spark, d):
    rows = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    grouped = rows.groupBy("user_id", F.session_window("ts", "1 hour")).agg(F.count("*").alias("n"))
    return grouped.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("started"), "n")


# ---- relational standards

_CENTS = "round({} * 100)::BIGINT"
_cents = lambda c: F.round(c * 100).cast("bigint")


@query(f"SELECT l_returnflag, l_linestatus, sum(l_quantity)::BIGINT AS sum_qty, sum({_CENTS.format('l_extendedprice')})::BIGINT AS sum_base, sum({_CENTS.format('l_extendedprice * (1 - l_discount)')})::BIGINT AS sum_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY 1, 2")
def tpch_q1(spark, d):
    rows = table(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("2001-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("bigint").alias("sum_qty"), F.sum(_cents(F.col("l_extendedprice"))).alias("sum_base"), F.sum(_cents(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("sum_disc"), F.count("*").alias("n"))


_REVENUE = f"sum({_CENTS.format('l_extendedprice * (1 - l_discount)')})::BIGINT"


def _rev():
    return F.sum(_cents(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("revenue")


@query(f"SELECT l_orderkey, {_REVENUE} AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1998-03-15' AND l_shipdate > TIMESTAMP '1998-03-15' GROUP BY 1 ORDER BY revenue DESC, l_orderkey LIMIT 10")
def tpch_q3(spark, d):
    day = F.lit("1998-03-15").cast("timestamp_ntz")
    c = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    o = table(spark, d, "orders").filter(F.col("o_orderdate") < day).select("o_orderkey", "o_custkey")
    line = table(spark, d, "lineitem").filter(F.col("l_shipdate") > day)
    joined = line.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("l_orderkey").agg(_rev()).orderBy(F.desc("revenue"), "l_orderkey").limit(10)


@query(f"SELECT n_name, {_REVENUE} AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1")
def tpch_q5(spark, d):
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("1996-01-01", "1998-01-01"))
    o = table(spark, d, "orders").filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)).select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name")
    joined = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey"))).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(_rev())


@query(f"SELECT sum({_CENTS.format('l_extendedprice * l_discount')})::BIGINT AS revenue FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24")
def tpch_q6(spark, d):
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("1997-01-01", "1998-01-01"))
    rows = table(spark, d, "lineitem").filter((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi) & F.col("l_discount").between(0.05, 0.07) & (F.col("l_quantity") < 24))
    return rows.agg(F.sum(_cents(F.col("l_extendedprice") * F.col("l_discount"))).alias("revenue"))


@query(f"SELECT c_custkey, c_name, n_name, {_REVENUE} AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey WHERE l_returnflag = 'R' GROUP BY 1, 2, 3 ORDER BY revenue DESC, c_custkey LIMIT 20")
def tpch_q10(spark, d):
    line = table(spark, d, "lineitem").filter("l_returnflag = 'R'")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    sums = line.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(_rev())
    best = sums.orderBy(F.desc("revenue"), "o_custkey").limit(20)
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return best.join(c, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "n_name", "revenue")


@query("SELECT 'written' AS step, count(*) AS n FROM events UNION ALL SELECT 'read', count(*) FROM events")
def k_round_trip(spark, d):
    events = table(spark, d, "events")
    again = materialize(events, "events")
    return events.agg(F.count("*").alias("n")).select(F.lit("written").alias("step"), "n").union(again.agg(F.count("*").alias("n")).select(F.lit("read").alias("step"), "n"))
