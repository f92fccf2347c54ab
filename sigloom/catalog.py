"""Named queries over the driver's tables and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.functions import codecs, kernels
from sigloom.operators import aggregates, catalogs, joins, metrics, predicates, windows
from sigloom.plans import reports
from sigloom.sources import container, views
from sigloom.streaming import processors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The views that most oracles start from, as ``sigloom.sources.views`` makes them.
SIGNAL = """signal AS (SELECT event_type AS recording, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS t,
 CAST(round(value * 100) AS BIGINT) AS v FROM events)"""
RECON = "recon AS (SELECT recording, t, (v >> 3) << 3 AS v FROM signal)"
PAIRS = f"{SIGNAL}, {RECON}, pairs AS (SELECT s.recording, s.t, s.v AS x, r.v AS y FROM signal s JOIN recon r USING (recording, t))"
ENTRIES = "entries AS (SELECT source || '/' || doc_id AS path, source, doc_id, n_chars AS size, sha256(text) AS sha256 FROM documents)"
FIRST = "firsts AS (SELECT *, min(path) OVER (PARTITION BY sha256) AS first_path FROM entries)"


def query(name: str, sql: str | None = None):
    """Register a query, with its oracle where SQL can express it."""

    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.signal(read(spark, sf_dir, "events"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = signal(spark, sf_dir)
    return metrics.paired(s, views.strip_low_bits(s))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogs.entries(read(spark, sf_dir, "documents"))


# --- statistics ---------------------------------------------------------------------------------


@query(
    "signal_channel_stats",
    f"""WITH {SIGNAL} SELECT recording, count(*) AS n, min(v) AS v_min, max(v) AS v_max, round(avg(v), 6) AS v_mean,
 round(stddev_pop(v), 6) AS v_std, round(median(v), 6) AS v_median, round(mad(v), 6) AS v_mad FROM signal GROUP BY recording""",
)
def signal_channel_stats(spark, sf_dir):
    return aggregates.channel_stats(signal(spark, sf_dir))


@query(
    "robust_summary",
    """SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.05), 6) AS p5, round(quantile_cont(value, 0.5), 6) AS p50,
 round(quantile_cont(value, 0.95), 6) AS p95, min(value) AS min, max(value) AS max FROM events GROUP BY event_type""",
)
def robust_summary(spark, sf_dir):
    return aggregates.robust_summary(read(spark, sf_dir, "events"), "value", "event_type")


_RANKED = """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, {} FROM r GROUP BY event_type"""


@query("percentile_nearest_rank", _RANKED.format("max(CASE WHEN r = least(CAST(floor(0.05 * n) AS BIGINT), n - 1) THEN value END) AS p5, max(CASE WHEN r = least(CAST(floor(0.5 * n) AS BIGINT), n - 1) THEN value END) AS p50, max(CASE WHEN r = least(CAST(floor(0.95 * n) AS BIGINT), n - 1) THEN value END) AS p95"))
def percentile_nearest_rank(spark, sf_dir):
    return aggregates.ranked_percentiles(read(spark, sf_dir, "events"), "value", "event_type", {"p5": 0.05, "p50": 0.5, "p95": 0.95})


@query("latency_percentiles", _RANKED.format("max(CASE WHEN r = n // 2 THEN value END) AS p50, max(CASE WHEN r = CAST(floor(0.95 * n) AS BIGINT) THEN value END) AS p95, max(CASE WHEN r = CAST(floor(0.99 * n) AS BIGINT) THEN value END) AS p99, max(value) AS max"))
def latency_percentiles(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    p = aggregates.ranked_percentiles(e, "value", "event_type", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, rule="plain")
    return p.join(e.groupBy("event_type").agg(F.max("value").alias("max")), "event_type")


@query(
    "histogram_30",
    """WITH s AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type)
SELECT event_type, CAST(CASE WHEN hi > lo THEN least(floor((value - lo) / (hi - lo) * 30), 29) ELSE 0 END AS INTEGER) AS bin, count(*) AS n FROM events JOIN s USING (event_type) GROUP BY 1, 2""",
)
def histogram_30(spark, sf_dir):
    return aggregates.histogram(read(spark, sf_dir, "events"), "value", "event_type")


@query(
    "entropy_bits",
    f"""WITH {SIGNAL}, c AS (SELECT recording, v >> 4 AS s, count(*) AS c FROM signal GROUP BY 1, 2)
SELECT recording, round(abs(log2(sum(c)) - sum(c * log2(c)) / sum(c)), 6) AS bits, count(*) AS symbols, CAST(sum(c) AS BIGINT) AS n FROM c GROUP BY recording""",
)
def entropy_bits(spark, sf_dir):
    return aggregates.entropy(signal(spark, sf_dir).withColumn("s", F.shiftright("v", 4)), "s", "recording")


@query(
    "mutual_information",
    """WITH j AS (SELECT event_type, user_id % 8 AS a, CAST(floor(value / 50) AS BIGINT) AS b, count(*) AS c FROM events GROUP BY 1, 2, 3),
w AS (SELECT *, sum(c) OVER (PARTITION BY event_type, a) AS ca, sum(c) OVER (PARTITION BY event_type, b) AS cb, sum(c) OVER (PARTITION BY event_type) AS n FROM j)
SELECT event_type, round(sum(c / n * log2(c * n / (ca * cb))), 6) AS bits FROM w GROUP BY event_type""",
)
def mutual_information(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 8).alias("a"), F.floor(F.col("value") / 50).alias("b"))
    return aggregates.mutual_information(e, "a", "b", "event_type")


@query(
    "symbol_utilisation",
    """SELECT event_type, round(count(DISTINCT user_id % 64) * 100.0 / 64, 6) AS used_pct, round(kurtosis_pop(user_id % 64), 4) AS kurtosis FROM events GROUP BY event_type""",
)
def symbol_utilisation(spark, sf_dir):
    return aggregates.utilisation(read(spark, sf_dir, "events").withColumn("s", F.col("user_id") % 64), "s", 64, "event_type")


@query(
    "patient_spread",
    """WITH m AS (SELECT event_type, user_id, avg(value) AS m FROM events GROUP BY 1, 2)
SELECT event_type, count(*) AS groups, round(avg(m), 6) AS mean, round(stddev_pop(m), 6) AS std, round(min(m), 6) AS min, round(max(m), 6) AS max, round(max(m) - min(m), 6) AS range FROM m GROUP BY event_type""",
)
def patient_spread(spark, sf_dir):
    return aggregates.spread(read(spark, sf_dir, "events"), "value", "user_id", "event_type")


@query(
    "best_f1_threshold",
    """WITH e AS (SELECT event_type, CAST(floor(value / 10) AS BIGINT) AS score, sum(CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END) AS tp, count(*) AS n FROM events GROUP BY 1, 2),
c AS (SELECT *, sum(tp) OVER (PARTITION BY event_type ORDER BY score DESC) AS ctp, sum(n) OVER (PARTITION BY event_type ORDER BY score DESC) AS cn, sum(tp) OVER (PARTITION BY event_type) AS p FROM e),
f AS (SELECT *, round(CASE WHEN p + cn > 0 THEN 2.0 * ctp / (cn + p) ELSE 0 END, 9) AS f1 FROM c),
b AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY f1 DESC, score DESC) AS k FROM f)
SELECT event_type, score AS threshold, round(f1, 6) AS f1, round(CASE WHEN p > 0 THEN ctp / p ELSE 0 END, 6) AS sensitivity FROM b WHERE k = 1""",
)
def best_f1_threshold(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", F.floor(F.col("value") / 10).alias("score"), (F.col("user_id") % 3 == 0).cast("int").alias("truth"))
    return aggregates.best_f1(e, "score", "truth", "event_type")


@query(
    "activity_buckets",
    f"""WITH {SIGNAL}, w AS (SELECT recording, t // 50 AS seq, sqrt(avg(CAST(v * v AS DOUBLE))) AS rms, bool_or(v > 40000) AS marked FROM signal GROUP BY 1, 2),
m AS (SELECT recording, quantile_cont(rms, 0.5) AS mid FROM w GROUP BY recording)
SELECT recording, CASE WHEN marked THEN 'seizure' WHEN rms > mid THEN 'active' ELSE 'quiet' END AS activity, count(*) AS n, round(avg(rms), 4) AS mean, round(stddev_pop(rms), 4) AS std
FROM w JOIN m USING (recording) GROUP BY 1, 2""",
)
def activity_buckets(spark, sf_dir):
    s = signal(spark, sf_dir)
    w = s.groupBy("recording", F.floor(F.col("t") / 50).alias("seq")).agg(F.sqrt(F.avg((F.col("v") * F.col("v")).cast("double"))).alias("rms"), F.bool_or(F.col("v") > 40000).alias("marked"))
    mid = w.groupBy("recording").agg(F.percentile("rms", F.lit(0.5)).alias("mid"))
    kind = F.when(F.col("marked"), "seizure").when(F.col("rms") > F.col("mid"), "active").otherwise("quiet")
    return w.join(mid, "recording").groupBy("recording", kind.alias("activity")).agg(F.count("*").alias("n"), F.round(F.avg("rms"), 4).alias("mean"), F.round(F.stddev_pop("rms"), 4).alias("std"))


_RESULTS = """results AS (SELECT o_orderkey AS input, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'skipped' END AS status, o_orderpriority AS grp,
 CAST(round(o_totalprice * 100) AS BIGINT) AS raw_bytes, CAST(round(o_totalprice) AS BIGINT) % 100000 AS packed_bytes FROM orders)"""


def _results(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("skipped")
    return o.select(F.col("o_orderkey").alias("input"), status.alias("status"), F.col("o_orderpriority").alias("grp"), F.round(F.col("o_totalprice") * 100).cast("long").alias("raw_bytes"), (F.round("o_totalprice").cast("long") % 100000).alias("packed_bytes"))


@query(
    "batch_summary",
    f"""WITH {_RESULTS} SELECT grp, count(*) AS total, CAST(count_if(status = 'success') AS BIGINT) AS success, CAST(count_if(status = 'failed') AS BIGINT) AS failed, CAST(count_if(status = 'skipped') AS BIGINT) AS skipped,
 CAST(coalesce(sum(raw_bytes) FILTER (status = 'success'), 0) AS BIGINT) AS raw_bytes, CAST(coalesce(sum(packed_bytes) FILTER (status = 'success'), 0) AS BIGINT) AS packed_bytes,
 round(CASE WHEN coalesce(sum(packed_bytes) FILTER (status = 'success'), 0) > 0 THEN CAST(sum(raw_bytes) FILTER (status = 'success') AS DOUBLE) / sum(packed_bytes) FILTER (status = 'success') ELSE 0 END, 6) AS ratio FROM results GROUP BY grp""",
)
def batch_summary(spark, sf_dir):
    return aggregates.batch_summary(_results(spark, sf_dir), "grp")


@query(
    "run_statistics",
    f"""WITH {_RESULTS}, s AS (SELECT grp, CAST(sum(raw_bytes) AS DOUBLE) / sum(packed_bytes) AS ratio FROM results WHERE status = 'success' GROUP BY grp HAVING sum(packed_bytes) > 0)
SELECT grp, round(ratio, 6) AS ratio, round(greatest(16.0 / ratio - 6.63, 0), 6) AS gap_bits, round((1 - (16.0 / ratio - 6.63) / (16 - 6.63)) * 100, 4) AS gap_pct FROM s""",
)
def run_statistics(spark, sf_dir):
    ok = _results(spark, sf_dir).where("status = 'success'").groupBy("grp").agg(F.sum("raw_bytes").alias("raw"), F.sum("packed_bytes").alias("packed")).where("packed > 0")
    s = ok.select("grp", (F.col("raw").cast("double") / F.col("packed")).alias("ratio"))
    gap = aggregates.run_gap(F.col("ratio"))
    return s.select("grp", F.round("ratio", 6).alias("ratio"), F.round(gap["gap_bits"], 6).alias("gap_bits"), F.round(gap["gap_pct"], 4).alias("gap_pct"))


@query(
    "paper_aggregate",
    f"""WITH {_RESULTS}, r AS (SELECT grp, status, input, CASE WHEN status = 'success' AND packed_bytes > 0 THEN raw_bytes END AS raw, CASE WHEN status = 'success' AND packed_bytes > 0 THEN packed_bytes END AS packed FROM results),
c AS (SELECT *, CAST(raw AS DOUBLE) / packed AS cr FROM r)
SELECT grp, count(cr) AS ok, CAST(count_if(status = 'failed') AS BIGINT) AS errors, CAST(count_if(cr IS NOT NULL AND input % 5 <> 0) AS BIGINT) AS bit_perfect, CAST(sum(raw) AS BIGINT) AS raw_bytes, CAST(sum(packed) AS BIGINT) AS packed_bytes, round(CAST(sum(raw) AS DOUBLE) / sum(packed), 6) AS ratio_of_sums, round(avg(cr), 4) AS mean_of_ratios,
 round(stddev_pop(cr), 4) AS std, round(min(cr), 6) AS min, round(max(cr), 6) AS max, round(median(cr), 6) AS median, round(quantile_cont(cr, 0.05), 6) AS p5, round(quantile_cont(cr, 0.95), 6) AS p95 FROM c GROUP BY grp""",
)
def paper_aggregate(spark, sf_dir):
    return aggregates.paper_aggregate(_results(spark, sf_dir).withColumn("exact", F.col("input") % 5 != 0), "grp")


@query(
    "run_totals",
    f"""WITH {_RESULTS}, g AS (SELECT CAST(count_if(status = 'success') AS BIGINT) AS files_ok, CAST(count_if(status = 'failed') AS BIGINT) AS files_error, CAST(count_if(status = 'skipped') AS BIGINT) AS files_skipped, CAST(coalesce(sum(raw_bytes) FILTER (status = 'success'), 0) AS BIGINT) AS bytes_in, CAST(coalesce(sum(packed_bytes) FILTER (status = 'success'), 0) AS BIGINT) AS bytes_out FROM results)
SELECT *, round(CASE WHEN bytes_out > 0 THEN bytes_in / bytes_out ELSE 0 END, 4) AS compression_ratio FROM g""",
)
def run_totals(spark, sf_dir):
    return reports.run_totals(_results(spark, sf_dir).withColumnRenamed("packed_bytes", "compressed_bytes"))


@query("audit_lines", f"""WITH {_RESULTS} SELECT input, concat_ws('  ', rpad('FILE', 9, ' '), 'idx=' || input, CASE WHEN contains(grp, ' ') THEN 'path="' || grp || '"' ELSE 'path=' || grp END, 'state=' || status, 'bytes=' || CASE WHEN status = 'success' THEN raw_bytes END) AS line FROM results""")
def audit_lines(spark, sf_dir):
    r = _results(spark, sf_dir)
    fields = {"idx": F.col("input"), "path": F.col("grp"), "state": F.col("status"), "bytes": F.when(F.col("status") == "success", F.col("raw_bytes"))}
    return r.select("input", reports.audit_line(F.lit("FILE"), fields).alias("line"))


@query("state_counts", f"WITH {_RESULTS} SELECT CAST(count_if(status = 'pending') AS BIGINT) AS pending, CAST(count_if(status = 'in_progress') AS BIGINT) AS in_progress, CAST(count_if(status = 'success') AS BIGINT) AS success, CAST(count_if(status = 'failed') AS BIGINT) AS failed, CAST(count_if(status = 'quarantined') AS BIGINT) AS quarantined FROM results")
def state_counts(spark, sf_dir):
    return aggregates.state_counts(_results(spark, sf_dir), "status", ("pending", "in_progress", "success", "failed", "quarantined"))


@query(
    "noise_profile",
    f"""WITH {SIGNAL} SELECT recording, count(*) AS n, CAST(trunc(quantile_cont(v, 0.5)) AS BIGINT) AS p50, CAST(trunc(quantile_cont(v, 0.05)) AS BIGINT) AS p5, CAST(trunc(quantile_cont(v, 0.95)) AS BIGINT) AS p95 FROM signal GROUP BY ROLLUP (recording)""",
)
def noise_profile(spark, sf_dir):
    return aggregates.rollup_percentiles(signal(spark, sf_dir), "v", "recording")


@query(
    "head_to_head",
    """WITH g AS (SELECT l_returnflag AS codec, round(avg(l_quantity), 6) AS cr, round(avg(l_discount), 6) AS prd, round(median(l_tax), 6) AS latency FROM lineitem GROUP BY 1)
SELECT *, cr = max(cr) OVER () AS best_cr, prd = min(prd) OVER () AS best_prd, latency = min(latency) OVER () AS best_latency FROM g""",
)
def head_to_head(spark, sf_dir):
    return aggregates.head_to_head(read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("codec"), F.col("l_quantity").alias("cr"), F.col("l_discount").alias("prd"), F.col("l_tax").alias("latency")))


@query(
    "normalised_frequencies",
    """WITH n AS (SELECT event_type, user_id % 400 AS s, count(*) AS c FROM events GROUP BY 1, 2), a AS (SELECT DISTINCT event_type, unnest(range(0, 400)) AS s FROM events),
c AS (SELECT a.event_type, a.s, coalesce(c, 0) AS c FROM a LEFT JOIN n ON a.event_type = n.event_type AND a.s = n.s),
f AS (SELECT *, CASE WHEN c = 0 THEN 1 ELSE greatest(CAST(floor(CAST(c AS DOUBLE) / CAST(sum(c) OVER (PARTITION BY event_type) AS DOUBLE) * (4096 - count_if(c = 0) OVER (PARTITION BY event_type))) AS BIGINT), 1) END AS f FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY c DESC, s) AS k, sum(f) OVER (PARTITION BY event_type) AS total FROM f)
SELECT event_type, s, c, CAST(CASE WHEN k = 1 THEN f + 4096 - total ELSE f END AS BIGINT) AS f FROM k""",
)
def normalised_frequencies(spark, sf_dir):
    return aggregates.normalised_frequencies(read(spark, sf_dir, "events").withColumn("s", F.col("user_id") % 400), "s", 4096, "event_type", 400)


@query(
    "modality_vote",
    """WITH l(recording, label) AS (VALUES (1, 'EEG Fp1-REF'), (1, 'C3-A2'), (1, 'Status'), (2, 'I'), (2, 'V1'), (2, 'x'), (3, 'I'), (3, 'ch1'), (4, 'Resp belt'), (4, 'AIRFLOW'), (4, 'ECG'), (5, 'EMG chin'), (5, 'EOG left')),
k AS (SELECT recording, CASE WHEN upper(label) LIKE '%EEG%' THEN 'eeg' WHEN upper(label) LIKE '%ECG%' THEN 'ecg' WHEN upper(label) LIKE '%EMG%' THEN 'emg' WHEN upper(label) LIKE '%EOG%' THEN 'eog'
 WHEN upper(label) LIKE '%RESP%' OR upper(label) LIKE '%AIRFLOW%' THEN 'resp' WHEN list_has_any(regexp_split_to_array(upper(label), '[-_/\\s]+'), ['C3', 'A2']) THEN 'eeg' WHEN label IN ('I', 'V1') THEN 'lead' END AS k FROM l),
c AS (SELECT recording, count(*) AS n, CAST(count_if(k = 'eeg') AS BIGINT) AS eeg, CAST(count_if(k = 'ecg') AS BIGINT) + CASE WHEN CAST(count_if(k = 'lead') AS BIGINT) >= 2 THEN CAST(count_if(k = 'lead') AS BIGINT) ELSE 0 END AS ecg, CAST(count_if(k = 'emg') AS BIGINT) AS emg, CAST(count_if(k = 'eog') AS BIGINT) AS eog, CAST(count_if(k = 'resp') AS BIGINT) AS resp FROM k GROUP BY 1)
SELECT CAST(recording AS BIGINT) AS recording, n, CASE WHEN 2 * eeg > n THEN 'eeg' WHEN 2 * ecg > n THEN 'ecg' WHEN 2 * emg > n THEN 'emg' WHEN 2 * eog > n THEN 'eog' WHEN 2 * resp > n THEN 'resp' ELSE 'untyped' END AS modality FROM c""",
)
def modality_vote(spark, sf_dir):
    rows = [(1, "EEG Fp1-REF"), (1, "C3-A2"), (1, "Status"), (2, "I"), (2, "V1"), (2, "x"), (3, "I"), (3, "ch1"), (4, "Resp belt"), (4, "AIRFLOW"), (4, "ECG"), (5, "EMG chin"), (5, "EOG left")]
    return aggregates.vote_modality(spark.createDataFrame(rows, "recording long, label string"))


# --- metrics ------------------------------------------------------------------------------------

_METRICS = PAIRS + """, g AS (SELECT recording, count(*) AS n, sum(CAST(x AS DOUBLE) * x) AS sxx, sum(CAST(x - y AS DOUBLE) * (x - y)) AS sdd, corr(x, y) AS r, stddev_pop(x) AS sx, stddev_pop(y) AS sy,
 avg(x) AS mx, max(abs(x - y)) AS me, bool_and(x = y) AS lossless FROM pairs GROUP BY recording)"""
_METRIC_COLUMNS = """recording, n, round({prd}, 6) AS prd, round(CASE WHEN sxx - n * mx * mx > 1e-12 THEN 100 * sqrt(sdd / (sxx - n * mx * mx)) ELSE 0 END, 6) AS prdn, round(r, 6) AS r,
 round({snr}, 6) AS snr_db, round(sqrt(sdd / n), 6) AS rmse, CAST(me AS DOUBLE) AS max_error, lossless"""
_PLAIN = {"prd": "100 * sqrt(sdd) / sqrt(sxx)", "snr": "10 * log10(sxx / sdd)"}
_GUARDED = {"prd": "100 * sqrt(sdd / (sxx + 1e-12))", "snr": "10 * log10(sxx / (sdd + 1e-12))"}

for _dialect in metrics.DIALECTS:

    @query(f"metrics_{_dialect}", f"WITH {_METRICS} SELECT {_METRIC_COLUMNS.format(**(_GUARDED if _dialect == 'guarded' else _PLAIN))} FROM g")
    def _metrics(spark, sf_dir, dialect=_dialect):
        return metrics.metrics(pairs(spark, sf_dir), dialect)


@query(
    "contract_levels",
    f"""WITH {_METRICS}, m AS (SELECT recording, 100 * sqrt(sdd) / sqrt(sxx) AS prd, r, lossless FROM g), l(level, max_prd, min_r) AS (VALUES ('L', 0.0, 1.0), ('C', 9.0, 0.95), ('M', 20.0, 0.85), ('A', 40.0, 0.70))
, v AS (SELECT recording, level, list_filter([CASE WHEN level = 'L' AND NOT lossless THEN 'bit_exact' END, CASE WHEN prd > max_prd THEN 'prd' END, CASE WHEN level <> 'L' AND (isnan(r) OR r < min_r - 1e-6) THEN 'r' END], lambda x: x IS NOT NULL) AS v FROM m, l)
SELECT recording, level, array_to_string(v, ',') AS violated, len(v) = 0 AS passed FROM v""",
)
def contract_levels(spark, sf_dir):
    m = metrics.metrics(pairs(spark, sf_dir), "capped", digits=15).withColumn("snr_db", F.lit(None).cast("double"))
    return metrics.check_contract(m).select("recording", "level", F.array_join("violations", ",").alias("violated"), "passed")


@query(
    "batch_gate",
    f"""WITH {_METRICS}, l(level, max_prd, min_r) AS (VALUES ('A', 25.0, 0.85), ('M', 15.0, 0.92), ('C', 9.0, 0.96), ('L', 0.001, 0.9999))
SELECT recording, level, 100 * sqrt(sdd) / sqrt(sxx) <= max_prd AND r >= min_r AS passed FROM g, l""",
)
def batch_gate(spark, sf_dir):
    m = metrics.metrics(pairs(spark, sf_dir), "strict", digits=12)
    return metrics.gate(m)


@query(
    "rate_distortion",
    f"""WITH {SIGNAL}, b AS (SELECT unnest(range(0, 9)) AS bits), p AS (SELECT recording, bits, v AS x, (v >> CAST(bits AS INTEGER)) << CAST(bits AS INTEGER) AS y FROM signal, b)
SELECT recording, bits, round(100 * sqrt(sum(CAST(x - y AS DOUBLE) * (x - y))) / sqrt(sum(CAST(x AS DOUBLE) * x)), 6) AS prd, round(corr(x, y), 6) AS r FROM p GROUP BY 1, 2""",
)
def rate_distortion(spark, sf_dir):
    each = signal(spark, sf_dir).select("recording", "t", F.col("v").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(8).cast("long"))).alias("bits"))
    cut = each.withColumn("y", F.expr("shiftleft(shiftright(x, cast(bits as int)), cast(bits as int))"))
    return metrics.metrics(cut, "strict", ("recording", "bits")).select("recording", "bits", "prd", "r")


# --- windows and kernels ------------------------------------------------------------------------


@query("window_tumbling", f"WITH {SIGNAL} SELECT recording, t // 250 AS seq, count(*) AS n, min(t) AS t_first, CAST(sum(v) AS BIGINT) AS v_sum, min(v) AS v_min, max(v) AS v_max FROM signal GROUP BY 1, 2")
def window_tumbling(spark, sf_dir):
    return windows.tumbling(signal(spark, sf_dir), 250)


@query(
    "bias_cancel",
    f"""WITH {SIGNAL} SELECT recording, t, v, v - (CAST(coalesce(sum(v) OVER (PARTITION BY recording ORDER BY t ROWS BETWEEN 32 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) >> 5) AS residual FROM signal""",
)
def bias_cancel(spark, sf_dir):
    return windows.blocked(signal(spark, sf_dir), windows.bias_cancel, windows.BIAS_CONTEXT)


_LPC = (120_000_000, -40_000_000, 20_000_000, 5_000_000)


@query(
    "lpc_residual",
    f"""WITH {SIGNAL} SELECT recording, t, v, v - (CAST({" + ".join(f"coalesce(lag(v, {k + 1}) OVER w, 0) * {c}" for k, c in enumerate(_LPC))} AS BIGINT) >> 27) AS residual FROM signal WINDOW w AS (PARTITION BY recording ORDER BY t)""",
)
def lpc_residual(spark, sf_dir):
    return windows.blocked(signal(spark, sf_dir), lambda s: windows.lpc_residual(s, list(_LPC)), len(_LPC))


_LIFT = """d{n} AS (SELECT recording, t, v, CASE WHEN t % 2 = 1 THEN v - ((lag(v) OVER w + coalesce(lead(v) OVER w, lag(v) OVER w)) >> 1) END AS d FROM {src} WINDOW w AS (PARTITION BY recording ORDER BY t)),
s{n} AS (SELECT recording, t, CASE WHEN t % 2 = 1 THEN d ELSE v + ((coalesce(lag(d) OVER w, lead(d) OVER w, 0) + coalesce(lead(d) OVER w, lag(d) OVER w, 0) + 2) >> 2) END AS v FROM d{n} WINDOW w AS (PARTITION BY recording ORDER BY t)),
a{n} AS (SELECT recording, t // 2 AS t, v FROM s{n} WHERE t % 2 = 0)"""


@query("lifting_forward", f"WITH {SIGNAL}, {_LIFT.format(n=1, src='signal')} SELECT recording, CASE WHEN t % 2 = 1 THEN 'detail' ELSE 'approx' END AS band, t // 2 AS idx, v FROM s1")
def lifting_forward(spark, sf_dir):
    return windows.blocked(signal(spark, sf_dir), windows.lifting_forward, 4, 4, place="2 * idx + CASE WHEN band = 'detail' THEN 1 ELSE 0 END")


@query("lifting_round_trip", f"WITH {SIGNAL} SELECT recording, t, v FROM signal")
def lifting_round_trip(spark, sf_dir):
    return windows.lifting_inverse(windows.lifting_forward(signal(spark, sf_dir)))


@query(
    "lifting_cascade",
    f"""WITH {SIGNAL}, {_LIFT.format(n=1, src='signal')}, {_LIFT.format(n=2, src='a1')}, {_LIFT.format(n=3, src='a2')}
{" UNION ALL ".join(f"SELECT recording, 'l{n}_detail' AS band, t // 2 AS idx, v FROM s{n} WHERE t % 2 = 1" for n in (1, 2, 3))} UNION ALL SELECT recording, 'l3_approx', t, v FROM a3""",
)
def lifting_cascade(spark, sf_dir):
    return windows.lifting_levels(signal(spark, sf_dir), 3)


@query("first_difference", f"WITH {SIGNAL} SELECT recording, t, v, v - coalesce(lag(v) OVER (PARTITION BY recording ORDER BY t), 0) AS delta FROM signal")
def first_difference(spark, sf_dir):
    return windows.blocked(signal(spark, sf_dir), windows.first_difference, 1)


@query(
    "run_length",
    """WITH s AS (SELECT user_id AS recording, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS t, CAST(CASE WHEN value > 20 THEN 1 ELSE 0 END AS BIGINT) AS v FROM events),
n AS (SELECT *, CASE WHEN v = lag(v) OVER (PARTITION BY recording ORDER BY t) THEN 0 ELSE 1 END AS new FROM s),
r AS (SELECT *, sum(new) OVER (PARTITION BY recording ORDER BY t) AS run FROM n),
i AS (SELECT *, row_number() OVER (PARTITION BY recording, run ORDER BY t) - 1 AS k FROM r)
SELECT recording, min(t) AS t_first, min(v) AS v, count(*) AS length FROM i GROUP BY recording, run, k // 4""",
)
def run_length(spark, sf_dir):
    s = views.signal(read(spark, sf_dir, "events"), "user_id").drop("v").withColumn("x", F.lit(0)).drop("x")
    e = read(spark, sf_dir, "events").withColumn("value", F.when(F.col("value") > 20, 0.01).otherwise(0.0))
    s = views.signal(e, "user_id")
    return windows.runs(s, cap=4)


_BITS = """b AS (SELECT recording, t, k AS bit, (v >> k) & 1 AS a, (lead(v) OVER (PARTITION BY recording, k ORDER BY t) >> k) & 1 AS b FROM signal, (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS k)),
m AS (SELECT recording, bit, avg(a) AS m, count(*) AS n, sum(a) AS sa, sum(a * b) AS sab, sum(CASE WHEN b IS NOT NULL THEN a END) AS sa1, sum(b) AS sb FROM b GROUP BY 1, 2),
r AS (SELECT recording, bit, round(CASE WHEN sa - n * m * m > 1e-12 THEN (sab - m * (sa1 + sb) + (n - 1) * m * m) / (sa - n * m * m) ELSE 0 END, 6) AS r1 FROM m)"""


@query("bit_autocorrelation", f"WITH {SIGNAL}, {_BITS} SELECT recording, bit, r1 FROM r")
def bit_autocorrelation(spark, sf_dir):
    return windows.bit_autocorrelation(signal(spark, sf_dir))


@query("noise_bits", f"""WITH {SIGNAL}, {_BITS}, c AS (SELECT recording, bit, count(*) AS n, count(DISTINCT (v >> CAST(bit AS INTEGER)) & 1) AS held FROM signal, (SELECT unnest(range(0, 10)) AS bit) GROUP BY 1, 2)
SELECT recording, CASE WHEN max(n) < 64 THEN 0 ELSE coalesce(min(CASE WHEN abs(r1) >= 0.05 OR held < 2 THEN bit END), 10) END AS noise_bits FROM r JOIN c USING (recording, bit) GROUP BY recording""")
def noise_bits(spark, sf_dir):
    return windows.noise_bits(signal(spark, sf_dir))


@query("strip_guard", f"WITH {SIGNAL} SELECT recording, CAST(count_if(v & 7 <> 0) AS BIGINT) AS dirty, CAST(count_if(v & 7 <> 0) AS BIGINT) = 0 AS stripped FROM signal GROUP BY recording")
def strip_guard(spark, sf_dir):
    return kernels.strip_guard(signal(spark, sf_dir), 3)


@query(
    "timestamp_gaps",
    """WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events), s AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM e)
SELECT user_id, event_id, us, step, CASE WHEN step IS NULL THEN 'start' WHEN step <= 0 THEN 'regression' WHEN step > 20000000000 + 5000000 THEN 'gap' ELSE 'ok' END AS state FROM s""",
)
def timestamp_gaps(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return windows.gaps(e, "user_id", "us", "event_id", 20_000_000_000, 5_000_000)


@query(
    "sessions",
    """WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events), s AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM e),
b AS (SELECT user_id, event_id, sum(CASE WHEN step <= 0 OR step > 20005000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS session FROM s)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, min(event_id) AS first_event FROM b GROUP BY 1, 2""",
)
def sessions(spark, sf_dir):
    return windows.break_sessions(timestamp_gaps(spark, sf_dir), "user_id", "event_id").groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query(
    "sequence_gaps",
    """WITH s AS (SELECT o_custkey % 50 AS stream, o_orderkey AS seq, lag(o_orderkey) OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS had FROM orders) SELECT stream, had + 1 AS first_missing, seq - 1 AS last_missing FROM s WHERE seq > had + 1""",
)
def sequence_gaps(spark, sf_dir):
    return windows.sequence_gaps(read(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("stream"), F.col("o_orderkey").alias("seq")), "stream", "seq")


@query("moving_average", f"WITH {SIGNAL} SELECT recording, t, v, round(sum(v) OVER (PARTITION BY recording ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5.0, 6) AS ma FROM signal")
def moving_average(spark, sf_dir):
    return windows.blocked(signal(spark, sf_dir), lambda s: windows.moving_average(s, 5), 2, 2)


@query(
    "energy_strata",
    """WITH r AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events),
s AS (SELECT *, greatest((n - 20) // 10, 1) AS stride FROM r),
k AS (SELECT *, CASE WHEN r < 10 THEN 'low' WHEN r >= greatest(n - 10, 10) THEN 'high' WHEN (r - 10) % stride = 0 AND (r - 10) / stride < 10 THEN 'middle' END AS stratum FROM s)
SELECT event_type, event_id, value, stratum FROM k WHERE stratum IS NOT NULL""",
)
def energy_strata(spark, sf_dir):
    return windows.strata(read(spark, sf_dir, "events").select("event_type", "event_id", "value"), "event_type", "value", "event_id")


@query("window_depth", f"WITH {SIGNAL}, w AS (SELECT recording, t // 20 AS seq, count(*) AS n FROM signal GROUP BY 1, 2) SELECT recording, seq, n, CASE WHEN n >= 32 THEN 3 WHEN n >= 16 THEN 2 WHEN n >= 8 THEN 1 ELSE 0 END AS depth FROM w")
def window_depth(spark, sf_dir):
    return windows.tumbling(signal(spark, sf_dir), 20).select("recording", "seq", "n", windows.depth(F.col("n")).alias("depth"))


@query("zigzag", f"WITH {SIGNAL}, d AS (SELECT recording, t, v - coalesce(lag(v) OVER (PARTITION BY recording ORDER BY t), 0) AS delta FROM signal) SELECT recording, t, delta, CASE WHEN delta >= 0 THEN 2 * delta ELSE -2 * delta - 1 END AS z, delta AS back FROM d")
def zigzag(spark, sf_dir):
    d = windows.first_difference(signal(spark, sf_dir))
    return d.select("recording", "t", "delta", kernels.zigzag(F.col("delta")).alias("z")).withColumn("back", kernels.unzigzag(F.col("z")))


@query(
    "rice_size",
    f"""WITH {SIGNAL}, d AS (SELECT recording, v - coalesce(lag(v) OVER (PARTITION BY recording ORDER BY t), 0) AS delta FROM signal), z AS (SELECT recording, CASE WHEN delta >= 0 THEN 2 * delta ELSE -2 * delta - 1 END AS z FROM d),
k AS (SELECT recording, CASE WHEN avg(z) FILTER (z > 0) >= 1 THEN least(CAST(floor(log2(avg(z) FILTER (z > 0))) AS INTEGER), 31) ELSE 0 END AS k FROM z GROUP BY recording)
SELECT recording, k, count(*) AS n, CAST(3 + ceil(sum((z >> k) + 1 + k) / 8) AS BIGINT) AS bytes FROM z JOIN k USING (recording) GROUP BY recording, k""",
)
def rice_size(spark, sf_dir):
    return kernels.rice_size(windows.first_difference(signal(spark, sf_dir)), "delta", "recording")


_TENSOR = "tensor AS (SELECT vec_id, unnest(range(0, 64)) AS dim, CAST(round(unnest(embedding) * 1000) AS BIGINT) AS x FROM embeddings)"


def tensor(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("dim", "x"))
    return e.select("vec_id", F.col("dim").cast("long").alias("dim"), F.round(F.col("x").cast("float") * F.lit(1000).cast("float")).cast("long").alias("x"))


@query(
    "walsh_hadamard",
    f"""WITH {_TENSOR} SELECT vec_id, dim // 32 * 32 + k AS dim, CAST(sum(x * (1 - 2 * (bit_count(CAST((dim % 32) & k AS INTEGER)) % 2))) AS BIGINT) AS y FROM tensor, (SELECT unnest(range(0, 32)) AS k) GROUP BY 1, 2""",
)
def walsh_hadamard(spark, sf_dir):
    return kernels.walsh_hadamard(tensor(spark, sf_dir), "vec_id", "dim", "x")


@query("walsh_hadamard_round_trip", f"WITH {_TENSOR} SELECT vec_id, dim, x FROM tensor")
def walsh_hadamard_round_trip(spark, sf_dir):
    """Both ways within each vector's row: nothing is grouped, so a task's memory does not follow its rows."""
    whole = lambda x: F.round(x.cast("float") * F.lit(1000).cast("float")).cast("long")
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", whole).alias("x"))
    back = F.slice(kernels.hadamard(kernels.hadamard(F.col("x")), inverse=True), F.lit(1), F.size("x"))
    each = e.select("vec_id", F.posexplode(back).alias("dim", "y"))
    return each.select("vec_id", F.col("dim").cast("long").alias("dim"), F.round("y").cast("long").alias("x"))


@query(
    "fsq_levels",
    f"""WITH {_TENSOR}, s AS (SELECT vec_id, CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) - min(x) AS DOUBLE) AS span FROM tensor GROUP BY 1),
q AS (SELECT vec_id, dim, x, lo, span, CAST(CASE WHEN span <= 0 THEN 4 ELSE greatest(least(floor((x - lo) / span * 8), 7), 0) END AS INTEGER) AS s FROM tensor JOIN s USING (vec_id))
SELECT vec_id, dim, x, s, round(lo + (s + 0.5) * (span + 1e-8) / 8, 6) AS y FROM q""",
)
def fsq_levels(spark, sf_dir):
    return kernels.fsq(tensor(spark, sf_dir), "vec_id", "x", 8).withColumn("y", F.round("y", 6))


@query(
    "fsq_rate_distortion",
    f"""WITH {_TENSOR}, s AS (SELECT vec_id, CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) - min(x) AS DOUBLE) AS span FROM tensor GROUP BY 1), l AS (SELECT unnest([2, 4, 8, 16, 32]) AS levels),
q AS (SELECT levels, x, lo, span, CASE WHEN span <= 0 THEN levels // 2 ELSE greatest(least(floor((x - lo) / span * levels), levels - 1), 0) END AS s FROM tensor JOIN s USING (vec_id), l)
SELECT CAST(levels AS INTEGER) AS levels, round(sqrt(avg(power(x - (lo + (s + 0.5) * (span + 1e-8) / levels), 2))), 5) AS rmse FROM q GROUP BY 1""",
)
def fsq_rate_distortion(spark, sf_dir):
    t = tensor(spark, sf_dir)
    span = t.groupBy("vec_id").agg(F.min("x").cast("double").alias("lo"), (F.max("x") - F.min("x")).cast("double").alias("span"))
    q = t.join(span, "vec_id").withColumn("levels", F.explode(F.array(*(F.lit(n) for n in (2, 4, 8, 16, 32)))))
    x, lo, span, n = F.col("x").cast("double"), F.col("lo"), F.col("span"), F.col("levels")
    s = F.when(span <= 0, F.floor(n / 2)).otherwise(F.greatest(F.least(F.floor((x - lo) / span * n), n - 1), F.lit(0)))
    return q.withColumn("e", x - (lo + (s + 0.5) * (span + 1e-8) / n)).groupBy("levels").agg(F.round(F.sqrt(F.avg(F.col("e") * F.col("e"))), 5).alias("rmse"))


@query(
    "klt_covariance",
    f"""WITH {_TENSOR} SELECT a.dim AS i, b.dim AS j, round(covar_samp(a.x, b.x), 4) AS cov FROM tensor a JOIN tensor b USING (vec_id) WHERE a.dim <= b.dim GROUP BY 1, 2""",
)
def klt_covariance(spark, sf_dir):
    t = tensor(spark, sf_dir)
    b = t.select("vec_id", F.col("dim").alias("j"), F.col("x").alias("y"))
    return t.withColumnRenamed("dim", "i").join(b, "vec_id").where("i <= j").groupBy("i", "j").agg(F.round(F.covar_samp("x", "y"), 4).alias("cov"))


@query("calibrate", f"WITH {SIGNAL} SELECT recording, t, round((v - (-32768)) * ((3276.7 - (-3276.8)) / (32767 - (-32768))) + (-3276.8), 6) AS phys FROM signal")
def calibrate(spark, sf_dir):
    return signal(spark, sf_dir).select("recording", "t", F.round(kernels.calibrate(F.col("v"), F.lit(-32768), F.lit(32767), F.lit(-3276.8), F.lit(3276.7)), 6).alias("phys"))


# --- byte-level kernels: decode(encode(x)) has to be the input ----------------------------------

_ARRAYS = f"WITH {SIGNAL} SELECT recording, t // 250 AS seq, md5(string_agg(v, ',' ORDER BY t)) AS digest FROM signal GROUP BY 1, 2"


def _digest(w: DataFrame) -> DataFrame:
    return w.select("recording", "seq", F.md5(F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").cast("binary")).alias("digest"))


def _round_trip(name: str, there: Callable, back: Callable, many: bool = False):
    """Both ways in one pass, so a task has one Python worker; with ``many`` the way back takes many windows."""

    def both(rows: list[np.ndarray]) -> list[np.ndarray]:
        coded = list(map(there, rows))
        return back(coded) if many else list(map(back, coded))

    @query(name, _ARRAYS)
    def run(spark, sf_dir):
        return _digest(codecs.over_windows(windows.arrays(signal(spark, sf_dir), 250), both, many=True))


_round_trip("codec_window_round_trip", codecs.encode_window, codecs.decode_windows, many=True)
_round_trip("codec_rice_round_trip", codecs.rice_encode, codecs.rice_decode)
_round_trip("bias_round_trip", codecs.bias_cancel, codecs.bias_restore_all, many=True)
_round_trip("lpc_round_trip", codecs.fixed_residual, codecs.fixed_restore_all, many=True)
_round_trip("codec_sparse_round_trip", codecs.sparse_encode, codecs.sparse_decode)
_round_trip("klt_lifting_round_trip", codecs.rotate, codecs.unrotate)
_round_trip("codec_run_length_round_trip", codecs.runs_pack, codecs.runs_unpack)


@query(
    "codec_levels_error",
    f"WITH {SIGNAL}, w AS (SELECT recording, t // 250 AS seq, min(v) AS lo, max(v) AS hi FROM signal GROUP BY 1, 2) SELECT recording, seq, true AS within FROM w",
)
def codec_levels_error(spark, sf_dir):
    """A lossy packet's values are within half a level of the samples."""
    w = windows.arrays(signal(spark, sf_dir), 250)
    back = codecs.over_windows(w, lambda x: codecs.decode_levels(codecs.encode_levels(x.astype(float), 64)), "samples array<double>").withColumnRenamed("samples", "y")
    half = (F.array_max("samples") - F.array_min("samples")) / 128 + 1e-6
    far = F.aggregate(F.zip_with("samples", "y", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda m, e: F.greatest(m, e))
    return w.join(back, ["recording", "seq"]).select("recording", "seq", (far <= half).alias("within"))


_WINDOWS = f"""{SIGNAL}, w AS (SELECT recording, t // 250 AS seq, t % 250 AS i, v AS x, (v >> 3) << 3 AS y, (v >> 8) << 8 AS z, count(*) OVER s AS n, avg(v) OVER s AS mx, avg((v >> 3) << 3) OVER s AS my, avg((v >> 8) << 8) OVER s AS mz
 FROM signal WINDOW s AS (PARTITION BY recording, t // 250)), k AS (SELECT unnest(range(0, 126)) AS k)"""


def _power(y: str, size: str = "n") -> str:
    """Spectra p and q of each window and of ``y``, under a Hann window and without their means."""
    turn = f"2 * pi() * ((k * i) % {size}) / {size}"
    part = lambda v, f: f"sum(({v} - m{v}) * (0.5 - 0.5 * cos(2 * pi() * i / n)) * {f}({turn}))"
    return f"""e AS (SELECT recording, seq, n, 250.0 * sum(pow(0.5 - 0.5 * cos(2 * pi() * i / n), 2)) AS e FROM w WHERE n > 1 GROUP BY 1, 2, 3),
d AS (SELECT recording, seq, n, k, {part("x", "cos")} AS xc, {part("x", "sin")} AS xs, {part(y, "cos")} AS yc, {part(y, "sin")} AS ys FROM w JOIN k ON k <= {size} // 2 WHERE n > 1 GROUP BY 1, 2, 3, 4),
f AS (SELECT recording, seq, n, k, (xc * xc + xs * xs) / e * (CASE WHEN k > 0 AND 2 * k < n THEN 2 ELSE 1 END) AS p, (yc * yc + ys * ys) / e * (CASE WHEN k > 0 AND 2 * k < n THEN 2 ELSE 1 END) AS q FROM d JOIN e USING (recording, seq, n))"""


_BAND = ", ".join(f"round(CASE WHEN coalesce(sqrt(sum(xx) FILTER (hz >= {lo} AND hz < {hi})), 0) > 1e-12 THEN 100 * sqrt(sum(dd) FILTER (hz >= {lo} AND hz < {hi})) / sqrt(sum(xx) FILTER (hz >= {lo} AND hz < {hi})) ELSE 0 END, 6) AS {name}" for name, (lo, hi) in codecs.BANDS.items())


@query(
    "band_prd",
    f"""WITH {_WINDOWS}, d AS (SELECT recording, seq, n, k, sum(x * cos(2 * pi() * ((k * i) % n) / n)) AS a, sum(x * sin(2 * pi() * ((k * i) % n) / n)) AS b, sum((x - y) * cos(2 * pi() * ((k * i) % n) / n)) AS c, sum((x - y) * sin(2 * pi() * ((k * i) % n) / n)) AS d FROM w JOIN k ON k <= n // 2 GROUP BY 1, 2, 3, 4),
f AS (SELECT recording, seq, k * 250.0 / n AS hz, a * a + b * b AS xx, c * c + d * d AS dd FROM d) SELECT recording, seq, {_BAND} FROM f GROUP BY 1, 2""",
)
def band_prd(spark, sf_dir):
    """PRD of the stripped signal within each frequency band, window by window."""
    w = windows.arrays(signal(spark, sf_dir), 250)
    names = list(codecs.BANDS)
    got = codecs.over_windows(w, lambda x: np.array(list(codecs.band_prd(x, (x >> 3) << 3, 250.0).values())), "prd array<double>")
    return got.select("recording", "seq", *(F.round(F.col("prd")[k], 6).alias(n) for k, n in enumerate(names)))


@query(
    "psd_divergence",
    f"""WITH {_WINDOWS}, {_power("z")}, g AS (SELECT recording, seq, (p + 1e-12) / sum(p + 1e-12) OVER s AS p, (q + 1e-12) / sum(q + 1e-12) OVER s AS q FROM f WINDOW s AS (PARTITION BY recording, seq)),
h AS (SELECT recording, seq, sum(p * ln(p / q)) AS kl FROM g GROUP BY 1, 2), every AS (SELECT DISTINCT recording, seq FROM w)
SELECT recording, seq, round(coalesce(kl, 0), 9) AS divergence FROM every LEFT JOIN h USING (recording, seq)""",
)
def psd_divergence(spark, sf_dir):
    w = windows.arrays(signal(spark, sf_dir), 250)
    got = codecs.over_windows(w, lambda x: np.array([codecs.psd_divergence(x, (x >> 8) << 8, 250.0)]), "d array<double>")
    return got.select("recording", "seq", F.round(F.col("d")[0], 9).alias("divergence"))


@query(
    "high_pass",
    f"""WITH RECURSIVE c AS (SELECT 1 / (1 + sqrt(2) * g + g * g) AS norm, 2 * (g * g - 1) / (1 + sqrt(2) * g + g * g) AS a1, (1 - sqrt(2) * g + g * g) / (1 + sqrt(2) * g + g * g) AS a2 FROM (SELECT tan(pi() * 0.5 / 250) AS g)),
h(j, y, y1) AS (SELECT 0, norm, CAST(0 AS DOUBLE) FROM c UNION ALL SELECT j + 1, (CASE j + 1 WHEN 1 THEN -2 WHEN 2 THEN 1 ELSE 0 END) * norm - a1 * y - a2 * y1, y FROM h, c WHERE j < 249),
{_WINDOWS}, o AS (SELECT a.recording, a.seq, a.i, sum(b.x * h.y) AS y FROM w a JOIN w b ON a.recording = b.recording AND a.seq = b.seq AND b.i <= a.i JOIN h ON h.j = a.i - b.i GROUP BY 1, 2, 3),
u AS (SELECT recording, seq, sum(y * y) AS out FROM o GROUP BY 1, 2), v AS (SELECT recording, seq, sum(CAST(x AS DOUBLE) * x) AS whole FROM w GROUP BY 1, 2) SELECT recording, seq, round(CASE WHEN whole > 0 THEN out / whole ELSE 0 END, 9) AS passed FROM u JOIN v USING (recording, seq)""",
)
def high_pass(spark, sf_dir):
    """Share of each window's energy that the filter lets pass."""
    w = windows.arrays(signal(spark, sf_dir), 250)
    energy = lambda rows: [np.array([float((y @ y) / max(x.astype(float) @ x, 1e-300))]) for x, y in zip(rows, codecs.high_pass_all(rows, 0.5, 250.0), strict=True)]
    got = codecs.over_windows(w, energy, "passed array<double>", many=True)
    return got.select("recording", "seq", F.round(F.col("passed")[0], 9).alias("passed"))


@query(
    "float_lifting",
    f"""WITH {_WINDOWS}, d AS (SELECT *, CASE WHEN i % 2 = 1 THEN x - (lag(x) OVER o + coalesce(lead(x) OVER o, lag(x) OVER o)) / 2 END AS d FROM w WINDOW o AS (PARTITION BY recording, seq ORDER BY i))
SELECT recording, seq, CASE WHEN i % 2 = 1 THEN 'detail' ELSE 'approx' END AS band, i // 2 AS idx, CASE WHEN i % 2 = 1 THEN d ELSE x + (coalesce(lag(d) OVER o, lead(d) OVER o, 0) + coalesce(lead(d) OVER o, lag(d) OVER o, 0)) / 4 END AS v FROM d WINDOW o AS (PARTITION BY recording, seq ORDER BY i)""",
)
def float_lifting(spark, sf_dir):
    w = windows.arrays(signal(spark, sf_dir), 250).withColumn("half", F.ceil(F.size("samples") / 2))
    got = codecs.over_windows(w, lambda x: np.concatenate(codecs.float_lift(x)), "bands array<double>").select("recording", "seq", "half", F.posexplode("bands").alias("at", "v"))
    low = F.col("at") < F.col("half")
    return got.select("recording", "seq", F.when(low, "approx").otherwise("detail").alias("band"), F.when(low, F.col("at")).otherwise(F.col("at") - F.col("half")).alias("idx"), "v")


def _whole(rows: list[np.ndarray]) -> list[np.ndarray]:
    return [np.rint(x).astype(np.int64) for x in rows]


_round_trip("float_lifting_round_trip", lambda x: _whole([codecs.float_unlift(*codecs.float_lift(x))])[0], lambda x: x)


@query("float_lpc_round_trip", _ARRAYS)
def float_lpc_round_trip(spark, sf_dir):
    """Residuals by weights from the first 256 samples, and the samples that they give back."""

    def there_and_back(rows: list[np.ndarray]) -> list[np.ndarray]:
        c = [codecs.float_coefficients(x.astype(float), 8) for x in rows]
        return _whole(codecs.float_restore_all([codecs.float_residual(x, k) for x, k in zip(rows, c, strict=True)], c))

    return _digest(codecs.over_windows(windows.arrays(signal(spark, sf_dir), 250), there_and_back, many=True))


# --- joins --------------------------------------------------------------------------------------

_STARTS = "starts AS (SELECT o_custkey % 100 AS stream, o_orderkey AS start, o_orderkey * 10 AS payload FROM orders WHERE o_orderkey % 3 = 0)"
_POINTS = "points AS (SELECT o_custkey % 100 AS stream, o_orderkey AS at FROM orders WHERE o_orderkey % 3 <> 0)"


def _starts(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("stream", F.col("o_custkey") % 100)
    starts = o.where("o_orderkey % 3 = 0").select("stream", F.col("o_orderkey").alias("start"), (F.col("o_orderkey") * 10).alias("payload"))
    return o.where("o_orderkey % 3 <> 0").select("stream", F.col("o_orderkey").alias("at")), starts


@query("join_as_of", f"WITH {_STARTS}, {_POINTS} SELECT p.stream, p.at, s.payload FROM points p ASOF LEFT JOIN starts s ON p.stream = s.stream AND p.at >= s.start")
def join_as_of(spark, sf_dir):
    return joins.as_of(*_starts(spark, sf_dir), "stream", "at", "start", "payload")


@query(
    "join_next_or_last",
    f"""WITH {_STARTS}, {_POINTS}, l AS (SELECT stream, max_by(payload, start) AS last FROM starts GROUP BY 1)
SELECT p.stream, p.at, coalesce(s.payload, l.last) AS payload FROM points p ASOF LEFT JOIN starts s ON p.stream = s.stream AND p.at <= s.start LEFT JOIN l ON l.stream = p.stream""",
)
def join_next_or_last(spark, sf_dir):
    return joins.next_or_last(*_starts(spark, sf_dir), "stream", "at", "start", "payload")


@query(
    "join_range_overlap",
    f"""WITH {SIGNAL}, w AS (SELECT recording, t // 250 AS seq, min(t) AS start, max(t) + 1 AS stop FROM signal GROUP BY 1, 2),
n AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1), r AS (SELECT event_type AS recording, event_id, event_id * 7919 % n AS lo, event_id * 7919 % n + user_id * 3 AS hi FROM events JOIN n USING (event_type))
SELECT r.recording, event_id, seq FROM r JOIN w ON r.recording = w.recording AND start < hi AND stop > lo WHERE lo < hi""",
)
def join_range_overlap(spark, sf_dir):
    w = windows.tumbling(signal(spark, sf_dir), 250).select("recording", "seq", F.col("t_first").alias("start"), (F.col("t_first") + F.col("n")).alias("stop"))
    e = read(spark, sf_dir, "events")
    counts = e.groupBy("event_type").agg(F.count("*").alias("n"))
    size = counts.agg(F.count("*").alias("recordings"), F.sum(F.ceil(F.col("n") / 250)).alias("windows")).first()
    e = e.join(F.broadcast(counts) if size["recordings"] <= joins.MOST_BROADCAST else counts, "event_type").withColumn("lo", F.col("event_id") * 7919 % F.col("n"))
    r = e.select(F.col("event_type").alias("recording"), "event_id", "lo", (F.col("lo") + F.col("user_id") * 3).alias("hi"))
    return joins.overlaps(r, w, "recording", 250, ["recording", "event_id", "seq"], size["windows"] or 0)


@query("gather_rows", "WITH n AS (SELECT count(*) AS n FROM embeddings), w AS (SELECT pos, (pos * 37) % n AS vec_id FROM n, (SELECT unnest(range(0, 3 * (SELECT n FROM n))) AS pos)) SELECT pos, vec_id, label FROM w JOIN embeddings USING (vec_id)")
def gather_rows(spark, sf_dir):
    """Three requests for each row there is, over all of the ids."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label")
    n = rows.count()
    wanted = spark.range(3 * n).select(F.col("id").alias("pos"), (F.col("id") * 37 % max(n, 1)).alias("vec_id"))
    return joins.gather(wanted, rows, "vec_id")


@query("chunk_location", "SELECT vec_id, vec_id // 64 AS chunk, vec_id % 64 AS \"offset\" FROM embeddings")
def chunk_location(spark, sf_dir):
    return joins.locate(read(spark, sf_dir, "embeddings").select("vec_id"), "vec_id", 64)


@query("resume_pending", f"WITH {_RESULTS} SELECT c_custkey AS input FROM customer WHERE c_custkey NOT IN (SELECT input FROM results WHERE status = 'success')")
def resume_pending(spark, sf_dir):
    return joins.pending(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("input")), _results(spark, sf_dir).select("input", "status"), "input")


@query("split_stems", "SELECT source AS subject, CASE WHEN CAST(substr(source, 4) AS INTEGER) % 5 = 0 THEN 'val' ELSE 'train' END AS part, count(*) AS stems FROM documents GROUP BY 1, 2")
def split_stems(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    subjects = d.select(F.col("source").alias("subject")).distinct().withColumn("part", F.when(F.substring("subject", 4, 9).cast("int") % 5 == 0, "val").otherwise("train"))
    return subjects.join(d.select(F.col("source").alias("subject"), "doc_id"), "subject").groupBy("subject", "part").agg(F.count("*").alias("stems"))


@query("split_leakage", "WITH s AS (SELECT sha256(text) AS sha256, CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END AS part FROM documents) SELECT sha256, count(DISTINCT part) AS parts FROM s GROUP BY 1 HAVING count(DISTINCT part) > 1")
def split_leakage(spark, sf_dir):
    s = read(spark, sf_dir, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.when(F.col("doc_id") % 5 == 0, "val").otherwise("train").alias("part"))
    return joins.leaked(s, "sha256", "part")


@query("attach_labels", "SELECT doc_id, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def attach_labels(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", "source").join(read(spark, sf_dir, "labels"), "doc_id", "left")


@query("registry_pins", f"WITH {ENTRIES}, p AS (SELECT path, CASE WHEN doc_id % 50 = 0 THEN sha256('x') ELSE sha256 END AS pin FROM entries) SELECT path, pin, sha256 FROM p JOIN entries USING (path) WHERE pin <> sha256")
def registry_pins(spark, sf_dir):
    e = entries(spark, sf_dir)
    odd = F.split("path", "/")[1].cast("long") % 50 == 0
    pins = e.select("path", F.when(odd, F.sha2(F.lit("x").cast("binary"), 256)).otherwise(F.col("sha256")).alias("pin"))
    return pins.join(e.select("path", "sha256"), "path").where("pin <> sha256")


@query(
    "manifest_verify",
    f"""WITH {ENTRIES}, m AS (SELECT path, CASE WHEN doc_id % 7 = 1 THEN size + 1 ELSE size END AS size, CASE WHEN doc_id % 7 = 2 THEN 'x' ELSE sha256 END AS sha FROM entries WHERE doc_id % 7 <> 3), f AS (SELECT path, size AS fsize, sha256 AS fsha FROM entries WHERE doc_id % 7 <> 4)
SELECT coalesce(m.path, f.path) AS path, CASE WHEN f.path IS NULL THEN 'missing' WHEN m.path IS NULL THEN 'extra' WHEN size <> fsize THEN 'size' WHEN sha <> fsha THEN 'hash' ELSE 'ok' END AS status FROM m FULL JOIN f ON m.path = f.path""",
)
def manifest_verify(spark, sf_dir):
    k = F.split("path", "/")[1].cast("long") % 7
    e = entries(spark, sf_dir)
    m = e.where(k != 3).select("path", F.when(k == 1, F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(k == 2, "x").otherwise(F.col("sha256")).alias("sha256"))
    return joins.verify(m, e.where(k != 4), "path")


@query("mask_overlap", f"WITH {SIGNAL} SELECT recording, t // 100 AS seq, bool_or(v > 20000) AS marked FROM signal GROUP BY 1, 2")
def mask_overlap(spark, sf_dir):
    s = signal(spark, sf_dir)
    mask = s.select("recording", "t", (F.col("v") > 20000).alias("m"))
    return s.join(mask, ["recording", "t"]).groupBy("recording", F.floor(F.col("t") / 100).alias("seq")).agg(F.bool_or("m").alias("marked"))


@query("keep_overrides", "SELECT event_type, CASE WHEN event_type LIKE 'c%' THEN 7 ELSE count(*) END AS bits FROM events GROUP BY 1")
def keep_overrides(spark, sf_dir):
    fresh = read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("bits"))
    return joins.keep_overrides(fresh, fresh.where("event_type LIKE 'c%'").withColumn("bits", F.lit(7).cast("long")), "event_type", "bits")


@query("recording_verify", f"WITH {SIGNAL} SELECT recording, count(*) = max(t) + 1 AS whole, bool_and(v >= 0) AS valid FROM signal GROUP BY recording")
def recording_verify(spark, sf_dir):
    return signal(spark, sf_dir).groupBy("recording").agg((F.count("*") == F.max("t") + 1).alias("whole"), F.bool_and(F.col("v") >= 0).alias("valid"))


# --- catalogs -----------------------------------------------------------------------------------


@query("content_dedup", f"WITH {ENTRIES}, {FIRST} SELECT path, size, sha256, first_path, path <> first_path AS dedup FROM firsts")
def content_dedup(spark, sf_dir):
    return catalogs.first_seen(entries(spark, sf_dir))


@query("archive_offsets", f"WITH {ENTRIES}, {FIRST} SELECT path, CAST(coalesce(sum(CASE WHEN path <> first_path THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM firsts")
def archive_offsets(spark, sf_dir):
    e = catalogs.first_seen(entries(spark, sf_dir)).withColumn("archive", catalogs.top_folder(F.col("path")))
    return catalogs.offsets(e, "archive", "path").select("path", "offset")


@query("dataset_rollup", f"WITH {ENTRIES}, {FIRST} SELECT source AS dataset, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, CAST(coalesce(sum(size) FILTER (path = first_path), 0) AS BIGINT) AS unique_bytes FROM firsts GROUP BY 1")
def dataset_rollup(spark, sf_dir):
    return catalogs.rollup(catalogs.first_seen(entries(spark, sf_dir)))


_PATHS = "paths AS (SELECT doc_id, source || '/' || lang || doc_id || CASE doc_id % 5 WHEN 0 THEN '.edf' WHEN 1 THEN '.GZ' WHEN 2 THEN '.txt' WHEN 3 THEN '' ELSE '.png' END AS path FROM documents)"


def _paths(spark, sf_dir):
    k = F.col("doc_id") % 5
    ext = F.when(k == 0, ".edf").when(k == 1, ".GZ").when(k == 2, ".txt").when(k == 3, "").otherwise(".png")
    return read(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("/"), "lang", F.col("doc_id").cast("string"), ext).alias("path"))


@query(
    "pack_method",
    f"""WITH {_PATHS}, e AS (SELECT doc_id, path, lower(regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1)) AS e FROM paths)
SELECT doc_id, path, CASE WHEN e IN ('edf', 'bdf') THEN 'lml' WHEN e IN ('lml', 'lmq', 'lma', 'gz', 'zst', 'zip', '7z', 'png', 'jpg', 'jpeg', 'mp4', 'avi') THEN 'store' ELSE 'secondary' END AS method FROM e""",
)
def pack_method(spark, sf_dir):
    return _paths(spark, sf_dir).withColumn("method", catalogs.method(F.col("path")))


@query("dataset_detect", f"WITH {_PATHS} SELECT doc_id, CASE WHEN lower(path) LIKE '%src1/%' THEN 'src1/' WHEN lower(path) LIKE '%/en%' THEN '/en' WHEN lower(path) LIKE '%fr%' THEN 'fr' END AS dataset FROM paths")
def dataset_detect(spark, sf_dir):
    return _paths(spark, sf_dir).select("doc_id", catalogs.dataset(F.col("path"), ("src1/", "/en", "fr")).alias("dataset"))


@query(
    "stem_validation",
    "WITH s AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '-x' WHEN 1 THEN 'a/b' WHEN 2 THEN 'a..b' WHEN 3 THEN '' WHEN 4 THEN '~h' ELSE 'ok' || doc_id END AS stem FROM documents) SELECT doc_id, doc_id % 6 = 5 AS safe FROM s",
)
def stem_validation(spark, sf_dir):
    k = F.col("doc_id") % 6
    stem = F.when(k == 0, "-x").when(k == 1, "a/b").when(k == 2, "a..b").when(k == 3, "").when(k == 4, "~h").otherwise(F.concat(F.lit("ok"), F.col("doc_id").cast("string")))
    return read(spark, sf_dir, "documents").select("doc_id", catalogs.is_safe_stem(stem).alias("safe"))


@query("human_size", "SELECT doc_id, n_chars, CASE WHEN n_chars < 1024 THEN printf('%.1f B', CAST(n_chars AS DOUBLE)) WHEN n_chars < 1048576 THEN printf('%.1f KB', n_chars / 1024.0) WHEN n_chars < 1073741824 THEN printf('%.1f MB', n_chars / 1048576.0) ELSE printf('%.1f GB', n_chars / 1073741824.0) END AS size FROM documents")
def human_size(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", "n_chars", catalogs.human_size(F.col("n_chars")).alias("size"))


@query("stale_streams", "SELECT user_id, max(epoch_us(ts)) AS updated, greatest(1706600000000000 - max(epoch_us(ts)), 0) > 3600000000 AS stale FROM events GROUP BY 1")
def stale_streams(spark, sf_dir):
    e = read(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("updated"))
    return e.withColumn("stale", F.greatest(F.lit(1706600000000000) - F.col("updated"), F.lit(0)) > 3600000000)


@query("group_fingerprint", f"WITH {ENTRIES} SELECT source, substr(sha256(string_agg(path, chr(10) ORDER BY path)), 1, 16) AS fingerprint FROM entries GROUP BY 1")
def group_fingerprint(spark, sf_dir):
    return catalogs.fingerprint(entries(spark, sf_dir).withColumn("source", catalogs.top_folder(F.col("path"))), "path", "source")


@query("first_wins", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY lang, doc_id % 40 ORDER BY doc_id) AS k FROM documents) SELECT lang || doc_id % 40 AS stem, doc_id, source FROM r WHERE k = 1")
def first_wins(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.concat("lang", (F.col("doc_id") % 40).cast("string")).alias("stem"), "doc_id", "source")
    return catalogs.first_wins(d, "stem", "doc_id")


@query("sorted_unique_paths", f"WITH {ENTRIES} SELECT DISTINCT source AS folder FROM entries ORDER BY 1")
def sorted_unique_paths(spark, sf_dir):
    return entries(spark, sf_dir).select(catalogs.top_folder(F.col("path")).alias("folder")).distinct().orderBy("folder")


@query("best_and_worst", f"WITH {_RESULTS}, r AS (SELECT input, CAST(raw_bytes AS DOUBLE) / packed_bytes AS cr FROM results WHERE status = 'success' AND packed_bytes > 0) SELECT arg_max(input, cr) AS best, arg_min(input, cr) AS worst, round(max(cr), 6) AS best_cr, round(min(cr), 6) AS worst_cr FROM r")
def best_and_worst(spark, sf_dir):
    r = _results(spark, sf_dir).where("status = 'success' AND packed_bytes > 0").withColumn("cr", F.col("raw_bytes").cast("double") / F.col("packed_bytes"))
    return r.agg(F.max_by("input", "cr").alias("best"), F.min_by("input", "cr").alias("worst"), F.round(F.max("cr"), 6).alias("best_cr"), F.round(F.min("cr"), 6).alias("worst_cr"))


@query("top_failures", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10")
def top_failures(spark, sf_dir):
    return read(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(10)


@query("seeded_sample", "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 25")
def seeded_sample(spark, sf_dir):
    return catalogs.seeded_sample(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 25)


@query("epoch_sample", "WITH n AS (SELECT count(*) AS n FROM embeddings) SELECT k AS draw, (k * 7919) % n AS vec_id FROM (SELECT unnest(range(0, 1500)) AS k), n")
def epoch_sample(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return catalogs.epoch(e, "vec_id", 1500).select("draw", "vec_id")


@query(
    "evenly_spaced",
    "WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT DISTINCT event_type, event_id FROM r, (SELECT unnest(range(0, 12)) AS i) WHERE r = i * (n - 1) // 11",
)
def evenly_spaced(spark, sf_dir):
    return catalogs.evenly_spaced(read(spark, sf_dir, "events").select("event_type", "event_id"), "event_type", "event_id", 12)


@query("capped_windows", "WITH b AS (SELECT source, doc_id, n_chars, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) SELECT source, doc_id, n_chars, CAST(least(20000 - before, n_chars) AS BIGINT) AS take FROM b WHERE before < 20000 AND n_chars > 0")
def capped_windows(spark, sf_dir):
    return catalogs.capped(read(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), "source", "doc_id", "n_chars", 20000)


@query("set_operations", "SELECT 'both' AS kind, count(*) AS n FROM (SELECT doc_id FROM documents WHERE doc_id % 2 = 0 INTERSECT SELECT doc_id FROM labels) UNION ALL SELECT 'only', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT 'any', count(*) FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels)")
def set_operations(spark, sf_dir):
    d, lab = read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels").select("doc_id")
    count = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    return count(d.where("doc_id % 2 = 0").intersect(lab), "both").unionByName(count(d.subtract(lab), "only")).unionByName(count(d.union(lab).distinct(), "any"))


@query(
    "channel_resolve",
    """SELECT * FROM (VALUES ('EEG Fp1-REF', 'Fp1'), ('t7', 'T3'), ('P8', 'T6'), ('C3..', 'C3'), ('FP1-F7', 'Fp1'), ('Cz (REF)', 'Cz'), ('A10', NULL), ('EDF Annotations', NULL), ('Fp1-0', 'Fp1'), ('EEG-O2', 'O2'), ('xx-C4', 'C4'), ('Oz', NULL)) t(label, channel)""",
)
def channel_resolve(spark, sf_dir):
    labels = ("EEG Fp1-REF", "t7", "P8", "C3..", "FP1-F7", "Cz (REF)", "A10", "EDF Annotations", "Fp1-0", "EEG-O2", "xx-C4", "Oz")
    return spark.createDataFrame([(x,) for x in labels], "label string").withColumn("channel", catalogs.resolve_channel(F.col("label")))


# --- sources and streams ------------------------------------------------------------------------


@query("source_ramp", "SELECT s AS seq, CAST(c AS INTEGER) AS channel, t, s * 1000 + c * 100 + t AS v FROM (SELECT unnest(range(0, 4)) AS s), (SELECT unnest(range(0, 3)) AS c), (SELECT unnest(range(0, 50)) AS t)")
def source_ramp(spark, sf_dir):
    return views.ramp(spark, channels=3, samples=50, n_windows=4)


@query(
    "sniff_format",
    "SELECT * FROM (VALUES ('4C4D4C4352595054', 'LMLCRYPT'), ('42435331', 'BCS1'), ('4C4D4C3100', 'LML1'), ('4C4D4131', 'LMA1'), ('4C4D4132', 'LMA2'), ('4C4D5143', 'LMQC'), ('4C515432', 'LQT2'), ('4C515433', 'LQT3'), ('4C51545001', 'LQTP1'), ('00', NULL), ('4C51545002', NULL)) t(head, profile)",
)
def sniff_format(spark, sf_dir):
    heads = "4C4D4C4352595054 42435331 4C4D4C3100 4C4D4131 4C4D4132 4C4D5143 4C515432 4C515433 4C51545001 00 4C51545002".split()
    return spark.createDataFrame([(h,) for h in heads], "head string").withColumn("profile", views.sniff(F.unhex("head")))


@query("operation_events", "SELECT event_id, CASE WHEN event_id % 10 = 3 THEN 'log' ELSE 'progress' END AS kind, CASE WHEN event_id % 10 <> 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS current, CASE WHEN event_id % 10 = 3 THEN 'not json ' || event_id END AS message FROM events")
def operation_events(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    line = F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("not json "), F.col("event_id").cast("string"))).otherwise(F.concat(F.lit('{"type":"progress","current":'), k, F.lit("}")))
    return views.operation_events(read(spark, sf_dir, "events").select("event_id", line.alias("line"))).select("event_id", "kind", "current", "message")


_ARRIVALS = "a AS (SELECT event_type AS key, event_id AS arrival, CASE WHEN event_id % 23 = 0 THEN event_id - 40 ELSE event_id END AS seq FROM events)"


def _arrivals(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("key"), F.col("event_id").alias("arrival"), F.when(F.col("event_id") % 23 == 0, F.col("event_id") - 40).otherwise(F.col("event_id")).alias("seq"))


@query(
    "sequence_verdicts",
    f"""WITH {_ARRIVALS}, m AS (SELECT *, max(seq) OVER (PARTITION BY key ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM a)
SELECT key, seq, CASE WHEN top IS NULL THEN 'first' WHEN seq <= top THEN 'repeat' WHEN seq > top + 1 THEN 'gap' ELSE 'ok' END AS verdict, CASE WHEN seq > top + 1 THEN seq - top - 1 ELSE 0 END AS missing FROM m""",
)
def sequence_verdicts(spark, sf_dir):
    return processors.sequence_verdicts(_arrivals(spark, sf_dir))


@query(
    "count_windows",
    """WITH a AS (SELECT event_type AS key, event_id AS arrival, CASE WHEN event_id % 97 = 0 THEN event_id - 90 ELSE event_id END AS ts, event_id % 7 AS v FROM events),
m AS (SELECT *, max(ts) OVER (PARTITION BY key ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM a),
b AS (SELECT *, sum(CASE WHEN ts <= top OR ts - top > 22 THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY arrival) AS piece FROM m),
k AS (SELECT *, (row_number() OVER (PARTITION BY key, piece ORDER BY arrival) - 1) // 8 AS k FROM b WHERE top IS NULL OR ts > top),
g AS (SELECT key, piece, k, count(*) AS n, min(ts) AS ts_first, CAST(sum(v) AS BIGINT) AS v_sum, min(arrival) AS first_at FROM k GROUP BY 1, 2, 3),
s AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY first_at) - 1 AS seq FROM g)
SELECT key, seq, n, ts_first, v_sum FROM s WHERE n = 8""",
)
def count_windows(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    rows = e.select(F.col("event_type").alias("key"), F.col("event_id").alias("arrival"), F.when(F.col("event_id") % 97 == 0, F.col("event_id") - 90).otherwise(F.col("event_id")).alias("ts"), (F.col("event_id") % 7).alias("v"))
    return processors.count_windows(rows, 8, 17, 5)


@query(
    "operation_progress",
    """WITH e AS (SELECT user_id AS key, event_id AS arrival, event_id AS ts, CASE event_type WHEN 'error' THEN 'error' ELSE event_type END AS state FROM events),
x AS (SELECT key, min_by(state, ts) AS ended FROM e WHERE state IN ('done', 'error') GROUP BY 1), g AS (SELECT key, count(*) AS events, max(ts) AS last_ts, max_by(state, ts) AS last FROM e GROUP BY 1)
SELECT key, events, last_ts, coalesce(ended, last) AS last_state, ended IS NOT NULL AS done FROM g LEFT JOIN x USING (key)""",
)
def operation_progress(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("arrival"), F.col("event_id").alias("ts"), F.col("event_type").alias("state"))
    return processors.progress(e)


@query("provenance_chain", f"WITH {SIGNAL}, w AS (SELECT recording, t // 250 AS seq, sha256(string_agg(v, ',' ORDER BY t)) AS node FROM signal GROUP BY 1, 2) SELECT recording, seq, node, lag(node) OVER (PARTITION BY recording ORDER BY seq) AS parent FROM w")
def provenance_chain(spark, sf_dir):
    return catalogs.provenance(windows.arrays(signal(spark, sf_dir), 250))


@query("layout_violations", "WITH w AS (SELECT l_returnflag AS recording, l_orderkey * 10 + l_linenumber AS seq, 21 AS channels, CASE WHEN l_orderkey % 500 = 7 THEN 249 ELSE 250 END AS length, 250000 AS rate FROM lineitem GROUP BY ALL), f AS (SELECT recording, min_by(length, seq) AS first FROM w GROUP BY 1) SELECT recording, seq, length FROM w JOIN f USING (recording) WHERE length <> first")
def layout_violations(spark, sf_dir):
    w = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("recording"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.lit(21).alias("channels"), F.when(F.col("l_orderkey") % 500 == 7, 249).otherwise(250).alias("length"), F.lit(250000).alias("rate")).distinct()
    return processors.check_layout(w).select("recording", "seq", "length")


@query("delivery_receipts", "WITH r AS (SELECT user_id % 64 * 1000 + CAST(floor(value) AS BIGINT) AS token, event_id AS seq FROM events) SELECT token, min(seq) AS seq FROM r GROUP BY 1")
def delivery_receipts(spark, sf_dir):
    r = read(spark, sf_dir, "events").select((F.col("user_id") % 64 * 1000 + F.floor("value")).alias("token"), F.col("event_id").alias("seq"))
    return processors.deliver(r)


# --- more of the inventory ----------------------------------------------------------------------


@query(
    "block_float",
    f"""WITH {_TENSOR}, s AS (SELECT vec_id, max(abs(CAST(x AS DOUBLE))) / 127 AS scale FROM tensor GROUP BY 1)
SELECT vec_id, dim, CAST(CASE WHEN scale > 0 THEN floor(x / scale + 0.5) ELSE 0 END AS INTEGER) AS mantissa, round(CASE WHEN scale > 0 THEN floor(x / scale + 0.5) ELSE 0 END * scale, 6) AS y FROM tensor JOIN s USING (vec_id)""",
)
def block_float(spark, sf_dir):
    return kernels.block_float(tensor(spark, sf_dir), "vec_id", "x").select("vec_id", "dim", "mantissa", F.round("y", 6).alias("y"))


@query(
    "residual_quantiser",
    f"""WITH {_TENSOR}, a AS (SELECT vec_id, CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) - min(x) AS DOUBLE) AS span FROM tensor GROUP BY 1),
q AS (SELECT vec_id, dim, x, CASE WHEN span <= 0 THEN 2 ELSE greatest(least(floor((x - lo) / span * 4), 3), 0) END AS s, lo, span FROM tensor JOIN a USING (vec_id)),
y AS (SELECT *, lo + (s + 0.5) * (span + 1e-8) / 4 AS y FROM q), r AS (SELECT vec_id, min(x - y) AS rlo, max(x - y) - min(x - y) AS rspan FROM y GROUP BY 1),
z AS (SELECT vec_id, x, y, y + rlo + (CASE WHEN rspan <= 0 THEN 4 ELSE greatest(least(floor((x - y - rlo) / rspan * 8), 7), 0) END + 0.5) * (rspan + 1e-8) / 8 AS y2 FROM y JOIN r USING (vec_id))
SELECT vec_id, round(sqrt(avg((x - y) * (x - y))), 4) AS rmse_1, round(sqrt(avg((x - y2) * (x - y2))), 4) AS rmse_2 FROM z GROUP BY 1""",
)
def residual_quantiser(spark, sf_dir):
    q = kernels.two_stage(tensor(spark, sf_dir), "vec_id", "x", 4, 8)
    rmse = lambda y: F.round(F.sqrt(F.avg((F.col("x") - F.col(y)) * (F.col("x") - F.col(y)))), 4)
    return q.groupBy("vec_id").agg(rmse("y").alias("rmse_1"), rmse("y2").alias("rmse_2"))


@query("container_round_trip", f"WITH {SIGNAL} SELECT recording, CAST(t // 100 AS BIGINT) AS seq, md5(string_agg(v, ',' ORDER BY t)) AS digest FROM signal GROUP BY 1, 2")
def container_round_trip(spark, sf_dir):
    """Whole recordings as containers, opened again window by window. A recording is cut into segments
    of 90 windows, a container each, so a long one is many tasks."""
    w = windows.arrays(signal(spark, sf_dir), 9000).select(F.concat_ws("/", "recording", F.col("seq").cast("string")).alias("name"), F.array("samples").alias("channels"))
    packed = container.pack_rows(w, 100, 250_000).select(F.col("name").alias("path"), "content")
    back = packed.mapInArrow(container._decode(None, None), container.SCHEMA)
    at = F.substring_index("path", "/", -1).cast("long") * 90 + F.col("seq")
    return _digest(back.select(F.substring_index("path", "/", 1).alias("recording"), at.alias("seq"), "samples"))


@query("finite_rows", "SELECT event_type, CAST(count_if(value > 1) AS BIGINT) AS usable, CAST(count_if(NOT (value > 1)) AS BIGINT) AS refused FROM events GROUP BY 1")
def finite_rows(spark, sf_dir):
    x = F.when(F.col("value") > 1, F.col("value")).otherwise(F.lit(float("nan")))
    ok = predicates.is_finite(F.col("x"))
    return read(spark, sf_dir, "events").withColumn("x", x).groupBy("event_type").agg(F.count_if(ok).alias("usable"), F.count_if(~ok).alias("refused"))


@query("status_lines", "SELECT event_id, CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'done' ELSE 'progress' END AS kind, user_id AS current FROM events")
def status_lines(spark, sf_dir):
    stage = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "finished").otherwise("running")
    line = F.to_json(F.struct(stage.alias("stage"), F.col("user_id").alias("count")))
    return predicates.translate_status(read(spark, sf_dir, "events").select("event_id", line.alias("line"))).select("event_id", "kind", "current")


@query("strict_ids", f"WITH {ENTRIES} SELECT doc_id, doc_id % 4 = 0 AS valid FROM entries")
def strict_ids(spark, sf_dir):
    k = F.col("doc_id") % 4
    sha = F.sha2(F.col("text").cast("binary"), 256)
    bad = F.when(k == 1, F.upper(F.concat(F.lit("ABCDEF"), F.substring(sha, 7, 58)))).when(k == 2, F.substring(sha, 1, 63)).when(k == 3, F.concat(sha, F.lit("0"))).otherwise(sha)
    return read(spark, sf_dir, "documents").select("doc_id", predicates.is_hash(bad).alias("valid"))


@query("clock_relation", "SELECT event_id, event_id % 3 <> 1 AS valid FROM events")
def clock_relation(spark, sf_dir):
    k = F.col("event_id") % 3
    offset, doubt = F.when(k != 0, F.lit(5)), F.when(k == 2, F.lit(1))
    return read(spark, sf_dir, "events").select("event_id", predicates.all_or_none(offset, doubt).alias("valid"))


@query("mirror_paths", f"WITH {_PATHS} SELECT doc_id, 'out/' || regexp_replace(path, '\\.[A-Za-z0-9]+$', '') || '.lml' AS target FROM paths")
def mirror_paths(spark, sf_dir):
    return _paths(spark, sf_dir).select("doc_id", predicates.mirror(F.col("path"), "out", "lml").alias("target"))


@query(
    "channel_grid",
    "WITH m AS (SELECT unnest(range(0, 21)) AS slot), c AS (SELECT event_type AS recording, user_id % 25 AS slot, min(event_id) AS idx FROM events GROUP BY 1, 2), r AS (SELECT DISTINCT event_type AS recording FROM events) SELECT r.recording, m.slot, coalesce(idx, -1) AS idx, idx IS NULL AS was_missing FROM r, m LEFT JOIN c ON c.recording = r.recording AND c.slot = m.slot",
)
def channel_grid(spark, sf_dir):
    c = read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("recording"), (F.col("user_id") % 25).alias("slot")).agg(F.min("event_id").alias("idx"))
    return catalogs.channel_grid(c, 21)


@query(
    "first_violations",
    f"""WITH {_METRICS}, m AS (SELECT recording, 100 * sqrt(sdd) / sqrt(sxx) AS prd FROM g), l(level, max_prd) AS (VALUES ('L', 0.0), ('C', 9.0), ('M', 20.0), ('A', 40.0))
SELECT level, 'prd' AS violation, min(recording) AS first_seen, count(*) AS times FROM m, l WHERE prd > max_prd GROUP BY 1
UNION ALL SELECT 'L', 'bit_exact', min(recording), count(*) FROM g WHERE NOT lossless HAVING count(*) > 0""",
)
def first_violations(spark, sf_dir):
    m = metrics.metrics(pairs(spark, sf_dir), "capped", digits=15).withColumn("r", F.lit(1.0))
    return metrics.first_violations(metrics.check_contract(m))


@query(
    "holdout_summary",
    """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events),
s AS (SELECT event_type, value, CASE WHEN r * 10 < n THEN 'low' WHEN r * 10 >= n * 9 THEN 'high' ELSE 'middle' END AS energy FROM r)
SELECT event_type, energy, count(*) AS n, round(avg(value), 6) AS mean FROM s GROUP BY GROUPING SETS ((event_type, energy), (event_type), ())""",
)
def holdout_summary(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return aggregates.energy_summary(e, "event_type", "value", "event_id")


@query("import_receipts", "WITH s AS (SELECT sha256(text) AS source_hash, source || '/' || doc_id AS path, doc_id FROM documents), k AS (SELECT source_hash FROM s WHERE doc_id % 3 = 0) SELECT source_hash, min(path) AS path FROM s WHERE source_hash NOT IN (SELECT source_hash FROM k) GROUP BY 1")
def import_receipts(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    s = d.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("source_hash"), F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"))
    return reports.receipts(s.select("source_hash", "path"), s.where("doc_id % 3 = 0").select("source_hash"))


@query("field_dispositions", "SELECT event_id, CASE event_type WHEN 'click' THEN 'exact' WHEN 'error' THEN 'quarantined' ELSE 'unsupported' END AS disposition FROM events")
def field_dispositions(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("field"))
    return reports.dispositions(e, ["click"], ["error"]).select("event_id", "disposition")


@query(
    "seizure_preservation",
    f"""WITH {_WINDOWS}, {_power("z")}, b AS (SELECT recording, seq, avg(p) FILTER (hz BETWEEN 8 AND 30) AS ph, avg(p) FILTER (hz BETWEEN 0.5 AND 4) AS pl, avg(q) FILTER (hz BETWEEN 8 AND 30) AS qh, avg(q) FILTER (hz BETWEEN 0.5 AND 4) AS ql FROM (SELECT *, k * 250.0 / n AS hz FROM f) GROUP BY 1, 2),
s AS (SELECT recording, coalesce(ph, 1e-30) / (coalesce(pl, 1e-30) + 1e-30) > 1 AS a, coalesce(qh, 1e-30) / (coalesce(ql, 1e-30) + 1e-30) > 1 AS b FROM b),
r AS (SELECT DISTINCT recording FROM w)
SELECT recording, CAST(count_if(a) AS BIGINT) AS events, CAST(count_if(a AND b) AS BIGINT) AS kept, CAST(count_if(NOT a AND b) AS BIGINT) AS invented FROM r LEFT JOIN s USING (recording) GROUP BY 1""",
)
def seizure_preservation(spark, sf_dir):
    """Windows whose ratio of band powers marks a seizure, before and after low bits are cleared."""
    w = windows.arrays(signal(spark, sf_dir), 250)
    score = codecs.over_windows(w, lambda x: np.array([codecs.band_ratio(x, 250.0), codecs.band_ratio((x >> 8) << 8, 250.0)]), "score array<double>")
    s = score.select("recording", (F.col("score")[0] > 1).alias("a"), (F.col("score")[1] > 1).alias("b"))
    return s.groupBy("recording").agg(F.count_if("a").alias("events"), F.count_if(F.col("a") & F.col("b")).alias("kept"), F.count_if(~F.col("a") & F.col("b")).alias("invented"))


@query(
    "spectral_fidelity",
    f"""WITH {_WINDOWS}, {_power("z", "250")}, m AS (SELECT recording, k, avg(xx / e) AS p, avg(zz / e) AS q FROM (SELECT d.recording, k, e, xc * xc + xs * xs AS xx, yc * yc + ys * ys AS zz FROM d JOIN e USING (recording, seq, n)) GROUP BY 1, 2),
b AS (SELECT recording, CAST(k AS DOUBLE) AS hz, abs(10 * log10((q + 1e-30) / (p + 1e-30))) AS db FROM m),
l AS (SELECT *, sum(db) OVER (PARTITION BY recording ORDER BY hz ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5 AS level FROM b) SELECT recording, round(avg(db), 6) AS db, min(hz) FILTER (level > 0.05 AND hz >= 0.3) AS f3db FROM l GROUP BY 1""",
)
def spectral_fidelity(spark, sf_dir):
    """Error in dB of the average spectrum after low bits are cleared, and where it leaves a twentieth of a dB."""
    w = windows.arrays(signal(spark, sf_dir), 250)
    got = codecs.over_windows(w, lambda x: codecs.window_spectra(x, (x >> 8) << 8, 250, 250.0), "power array<double>")
    half = (F.size("power") / 2).cast("int")
    pairs = F.arrays_zip(F.slice("power", F.lit(1), half).alias("p"), F.slice("power", half + 1, half).alias("q"))
    each = got.where(F.size("power") > 0).select("recording", F.posexplode(pairs).alias("k", "s")).select("recording", F.col("k").cast("double").alias("hz"), F.col("s")["p"].alias("p"), F.col("s")["q"].alias("q"))
    return metrics.spectral_bandwidth(each, "recording", limit=0.05).select("recording", F.round("db", 6).alias("db"), "f3db")


@query(
    "contract_codec",
    f"""WITH {_METRICS}, d AS (SELECT recording, v - coalesce(lag(v) OVER (PARTITION BY recording ORDER BY t), 0) AS delta FROM signal), z AS (SELECT recording, CASE WHEN delta >= 0 THEN 2 * delta ELSE -2 * delta - 1 END AS z FROM d),
k AS (SELECT recording, CASE WHEN avg(z) FILTER (z > 0) >= 1 THEN least(CAST(floor(log2(avg(z) FILTER (z > 0))) AS INTEGER), 31) ELSE 0 END AS k FROM z GROUP BY recording),
b AS (SELECT recording, CAST(3 + ceil(sum((z >> k) + 1 + k) / 8) AS BIGINT) AS bytes FROM z JOIN k USING (recording) GROUP BY recording),
m AS (SELECT recording, 100 * sqrt(sdd) / sqrt(sxx) AS prd, r, CAST(n AS DOUBLE) * 2 / bytes AS cr, lossless FROM g JOIN b USING (recording)),
l(mode, max_prd, min_r, min_cr, max_cr) AS (VALUES ('lossless', 0.0, 1.0, 3.0, 10.0), ('neural', 20.0, 0.80, 200.0, 600.0))
SELECT recording, mode, round(cr, 6) AS cr, array_to_string(list_filter([CASE WHEN mode = 'lossless' AND NOT lossless THEN 'lossless' END, CASE WHEN prd > max_prd + 1e-9 THEN 'prd' END, CASE WHEN isnan(r) OR r < min_r - 1e-9 THEN 'r' END, CASE WHEN cr < min_cr THEN 'cr' END, CASE WHEN cr > max_cr THEN 'cr' END], lambda x: x IS NOT NULL), ',') AS violated FROM m, l""",
)
def contract_codec(spark, sf_dir):
    m = metrics.metrics(pairs(spark, sf_dir), "strict", digits=15)
    size = kernels.rice_size(windows.first_difference(signal(spark, sf_dir)), "delta", "recording")
    m = m.join(size.select("recording", (F.col("n").cast("double") * 2 / F.col("bytes")).alias("cr")), "recording")
    return metrics.codec_contract(m).select("recording", "mode", F.round("cr", 6).alias("cr"), F.array_join("violations", ",").alias("violated"))


@query(
    "token_runs",
    f"""WITH {_TENSOR}, s AS (SELECT vec_id, CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) - min(x) AS DOUBLE) AS span FROM tensor GROUP BY 1),
q AS (SELECT vec_id, dim, CAST(CASE WHEN span <= 0 THEN 2 ELSE greatest(least(floor((x - lo) / span * 4), 3), 0) END AS BIGINT) AS v FROM tensor JOIN s USING (vec_id)),
n AS (SELECT *, CASE WHEN v = lag(v) OVER (PARTITION BY vec_id ORDER BY dim) THEN 0 ELSE 1 END AS new FROM q)
SELECT vec_id, CAST(sum(new) AS BIGINT) AS runs, round(1 - CAST(sum(new) AS DOUBLE) * 2 / count(*), 6) AS saving FROM n GROUP BY 1""",
)
def token_runs(spark, sf_dir):
    """Runs of quantised tokens, and what writing value and length of each saves."""
    q = kernels.fsq(tensor(spark, sf_dir), "vec_id", "x", 4).select(F.col("vec_id").alias("recording"), F.col("dim").alias("t"), F.col("s").cast("long").alias("v"))
    r = windows.runs(q).groupBy("recording").agg(F.count("*").alias("runs"), F.sum("length").alias("n"))
    return r.select(F.col("recording").alias("vec_id"), "runs", F.round(1 - F.col("runs").cast("double") * 2 / F.col("n"), 6).alias("saving"))


@query("record_gaps", "WITH r AS (SELECT event_type AS recording, event_id / 4.0 AS onset FROM events), s AS (SELECT *, onset - lag(onset) OVER (PARTITION BY recording ORDER BY onset) AS step FROM r) SELECT recording, CAST(onset AS DOUBLE) AS onset, CAST(step AS DOUBLE) AS step FROM s WHERE abs(step - 0.25) > 0.001")
def record_gaps(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("recording"), (F.col("event_id") / 4).alias("onset"))
    return windows.record_gaps(e, "recording", "onset", 0.25)


@query("recording_stems", "WITH p AS (SELECT source || '/' || doc_id || (CASE doc_id % 3 WHEN 0 THEN '.lml' WHEN 1 THEN '_labels.npz' ELSE '.edf' END) AS path, doc_id FROM documents) SELECT path, CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS VARCHAR) END AS stem, CASE WHEN doc_id % 3 = 1 THEN CAST(doc_id AS VARCHAR) END AS label_of FROM p")
def recording_stems(spark, sf_dir):
    kind = F.when(F.col("doc_id") % 3 == 0, ".lml").when(F.col("doc_id") % 3 == 1, "_labels.npz").otherwise(".edf")
    p = read(spark, sf_dir, "documents").select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), kind).alias("path"))
    return p.select("path", catalogs.recording_stem(F.col("path")).alias("stem"), catalogs.label_stem(F.col("path")).alias("label_of"))


_NAMED = f"[{', '.join(repr(c) for c in catalogs.MONTAGE)}]"


@query(
    "channel_selection",
    f"""WITH c AS (SELECT c_nationkey % 3 AS recording, c_custkey AS idx, c_custkey % 3 = 2 AS pair, {_NAMED}[1 + c_custkey * 7 % 17] AS one, {_NAMED}[1 + (c_custkey * 5 + 3) % 21] AS two FROM customer),
a AS (SELECT recording, one AS channel, min(idx) AS idx FROM c GROUP BY 1, 2), b AS (SELECT recording, two AS channel, min(idx) AS idx FROM c WHERE pair AND two NOT IN ('A1', 'A2') GROUP BY 1, 2),
u AS (SELECT * FROM a UNION ALL SELECT b.* FROM b ANTI JOIN a USING (recording, channel)) SELECT * FROM u WHERE recording IN (SELECT recording FROM u GROUP BY 1 HAVING count(*) >= 16)""",
)
def channel_selection(spark, sf_dir):
    """Montage channels from labels with prefixes and references, and from pairs for those without one."""
    montage = F.array(*map(F.lit, catalogs.MONTAGE))
    one, two = F.get(montage, (F.col("c_custkey") * 7 % 17).cast("int")), F.get(montage, ((F.col("c_custkey") * 5 + 3) % 21).cast("int"))
    label = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("EEG "), one, F.lit("-REF"))).when(F.col("c_custkey") % 3 == 1, F.upper(one)).otherwise(F.concat(one, F.lit("-"), two))
    return catalogs.select_channels(read(spark, sf_dir, "customer").select((F.col("c_nationkey") % 3).alias("recording"), F.col("c_custkey").alias("idx"), label.alias("label")))


@query(
    "evidence_ledger",
    """WITH r AS (SELECT user_id AS stream, event_id, event_type AS issue, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT stream, event_id, issue, CAST(0 AS BIGINT) AS suppressed FROM r WHERE r <= 16 UNION ALL SELECT stream, NULL, 'overflow', n - 16 FROM r WHERE r = 17""",
)
def evidence_ledger(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("stream"), "event_id", F.col("event_type").alias("issue"))
    return processors.evidence(e, "stream", "event_id", 16)


@query(
    "receipt_ledger",
    """WITH r AS (SELECT event_type AS key, event_id AS seq, CAST(user_id % 64 * 1000 + CAST(floor(value) AS BIGINT) AS VARCHAR) AS token FROM events), f AS (SELECT key, token, min(seq) AS first FROM r GROUP BY 1, 2),
p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY first) AS place FROM f)
SELECT key, seq, token, CASE WHEN place > 100 THEN 'full' WHEN seq > first THEN 'duplicate' ELSE 'accepted' END AS verdict FROM r JOIN p USING (key, token)""",
)
def receipt_ledger(spark, sf_dir):
    r = read(spark, sf_dir, "events").select(F.col("event_type").alias("key"), F.col("event_id").alias("seq"), (F.col("user_id") % 64 * 1000 + F.floor("value")).cast("string").alias("token"))
    return processors.admit(r, 100)


@query("principal_axes")
def principal_axes(spark, sf_dir):
    """Eigenvectors have no SQL; a test holds them against the covariance that they come from."""
    axes = aggregates.principal_axes(tensor(spark, sf_dir), "vec_id", "dim", "x")
    return axes.select("component", F.round("variance", 4).alias("variance"), "dim", F.round("weight", 6).alias("weight"))
