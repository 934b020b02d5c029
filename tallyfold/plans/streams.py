"""Streaming queries, run over what is available and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import words as W
from tallyfold.plans.fixtures import Tables
from tallyfold.plans.registry import query
from tallyfold.plans.text import TOKEN_SQL
from tallyfold.session import materialize, scratch_path
from tallyfold.sources.streams import stream_table, stream_text_dir
from tallyfold.streaming import jobs as J
from tallyfold.streaming import runner
from tallyfold.streaming.arrivals import stream_out_of_order

ARRIVAL_CHUNKS = 5


def _stream(t: Tables, name: str) -> DataFrame:
    # As a pattern, because a stream source takes a single file only by pattern.
    pattern = f"{t.sf_dir}/{{{name}.parquet}}"
    table = t.spark.read.parquet(t.path(name))
    stream = stream_table(t.spark, pattern, table.schema)
    return stream


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _clean_sql(source: str, keep: str) -> str:
    return rf"""
 select {keep} lower(regexp_replace(unnest(regexp_split_to_array(text, '[\t\n\v\f\r ]+')),
  '[^a-zA-Z0-9]', '', 'g')) as word from {source}"""


@query("stream_text_dir", f"""
select word, count(*) as n from (select unnest(regexp_extract_all(text, '{TOKEN_SQL}')) as word
 from conversations) group by word""")
def stream_text_queries(t: Tables):
    folder = scratch_path(t.spark, "lines")
    t["conversations"].select("text").write.text(folder)
    lines = stream_text_dir(t.spark, folder)
    return runner.run_changelog(W.word_count(lines, "value"), "textdir").groupBy("word").agg(
        F.max("n").alias("n")
    )


@query("stream_word_count", f"""
select word, count(*) as n from ({_clean_sql('documents', '')}) where word <> '' group by word""")
def stream_word_count(t: Tables):
    counts = J.word_counts(_stream(t, "documents"), "text", ordered=False)
    return runner.run_complete(counts, "words").orderBy(F.desc("n"), "word")


@query("stream_window_word_count", f"""
with e as (select ts, event_type || '-x ' || props as text from events),
w as ({_clean_sql('e', 'ts,')}),
s as (select time_bucket(interval '15 seconds', ts) - i * interval '15 seconds' as start, word
 from w, range(2) r(i) where word <> '')
select start, start + interval '30 seconds' as "end", word, count(*) as n from s group by start, word""")
def stream_window_word_count(t: Tables):
    events = J.event_time(_stream(t, "events"), "ts")
    lines = events.select("ts", F.concat("event_type", F.lit("-x "), "props").alias("text"))
    counts = J.window_word_counts(lines, "text", "ts", ordered=False)
    final = runner.run_complete(counts, "windows").orderBy("start", F.desc("n"), "word")
    return _naive(final, "start", "end")


@query("stream_letter_changelog", f"""
select lower(substring(word, 1, 1)) as letter, count(*) as n
from (select unnest(regexp_extract_all(text, '{TOKEN_SQL}')) as word from documents)
where regexp_matches(word, '^\\p{{L}}') group by 1 order by 1""")
def stream_letter_changelog(t: Tables):
    """The update log, reduced to the last count per letter."""
    log = runner.run_changelog(J.letter_changelog(_stream(t, "documents"), "text"), "letters")
    return W.compact_counts(log, "letter")


@query("stream_passthrough", "select event_id, event_type, value, props from events")
def stream_passthrough(t: Tables):
    events = _stream(t, "events").select("event_id", "event_type", "value", "props")
    return runner.run_append(J.passthrough(events), "copy")


@query("stream_filter_to_files", "select event_type, value from events where value > 100")
def stream_filter_to_files(t: Tables):
    chosen = J.over_threshold(_stream(t, "events"), "value", 100, "event_type", "value")
    return runner.run_append(chosen, "filtered", "csv", sep=";")


def closed_windows_sql(delay: str = "3 seconds") -> str:
    return f"""
w as (select time_bucket(interval '10 seconds', ts) - i * interval '10 seconds' as start, event_type
 from events, range(6) r(i)),
closed as (select start, start + interval '1 minute' as "end", count(*) as n,
 cast(sum(cast(event_type like '%lic%' as int)) as bigint) as n_matched from w group by start
 having start + interval '1 minute' <= (select max(ts) from events) - interval '{delay}')"""


@query("stream_sliding_cond_count", f"with {closed_windows_sql()} select * from closed")
def stream_sliding_cond_count(t: Tables):
    events = J.event_time(_stream(t, "events"), "ts")
    counts = J.sliding_cond_counts(events, "ts", "event_type", "%lic%")
    return _naive(runner.run_append(counts, "sliding"), "start", "end")


def in_chunks(t: Tables, view: str, run: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``run(stream, root)`` once for each fifth of the arrivals, with one checkpoint.

    The arrivals are written once, each fifth to as many files as there are tasks; a run
    starts after the files of its fifth have been moved to where the stream looks.
    """
    spark, folder, root = t.spark, scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "runs")
    rows = materialize(t[view], "arrivals-in")
    last = rows.agg(F.max("arrival_seq").alias("last")).first()["last"]
    chunk = F.floor(F.col("arrival_seq") / F.lit(last // ARRIVAL_CHUNKS + 1))
    rows.withColumn("chunk", chunk).write.partitionBy("chunk").parquet(f"{folder}-written")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(path(folder))
    stream = stream_table(spark, f"{folder}/*", rows.schema)
    for i in range(ARRIVAL_CHUNKS):
        files.rename(path(f"{folder}-written/chunk={i}"), path(f"{folder}/part-{i}"))
        result = run(stream, root)
    return result


@query("late_data_drop", f"""
with c as (select ts, arrival_seq // ((select max(arrival_seq) from v_late) // {ARRIVAL_CHUNKS} + 1) as k
 from v_late),
m as (select k, max(ts) as top from c group by k),
marks as (select r.i as k, max(top) - interval '2 hours' as mark
 from range({ARRIVAL_CHUNKS}) r(i) left join m on m.k < r.i group by r.i)
select date_trunc('hour', ts)::timestamp as start, count(*) as n from c join marks on c.k = marks.k
where mark is null or date_trunc('hour', ts)::timestamp + interval '1 hour' > mark group by 1
having start + interval '1 hour' <= (select max(ts) from events) - interval '2 hours'""")
def late_data_drop(t: Tables):
    """Hourly counts of the rows that a two-hour watermark lets through.

    Each run goes on with the watermark at which the one before it stopped.
    """
    def run(arrivals: DataFrame, root: str) -> DataFrame:
        counts = J.event_time(arrivals, "ts").withWatermark("ts", "2 hours").groupBy(
            F.window("ts", "1 hour")).agg(F.count("*").alias("n"))
        flat = counts.select(F.col("window.start").alias("start"), "n")
        return runner.run_append(flat, "late", root=root)

    return _naive(in_chunks(t, "v_late", run), "start")


@query("stream_out_of_order", """
select event_id, event_type, ts, previous_time from (select *, max(ts) over (
 partition by event_type order by arrival_seq rows between unbounded preceding and 1 preceding)
 as previous_time from v_arrivals) where ts < previous_time""")
def stream_out_of_order_query(t: Tables):
    found = in_chunks(t, "v_arrivals", lambda arrivals, root: stream_out_of_order(
        arrivals, "ts", "arrival_seq", ["event_type"], compact_every=4, root=root))
    return found.select("event_id", "event_type", "ts", "previous_time")


@query("multi_sink", """
select 'titles' as sink, count(*) as n, sum(event_id)::bigint as ids from events
union all select 'large', count(*), sum(event_id)::bigint from events where value > 100""")
def multi_sink(t: Tables):
    results = runner.multi_sink(_stream(t, "events"), [
        ("titles", lambda b: b.select("event_id", "event_type")),
        ("large", lambda b: b.filter("value > 100").select("event_id", "value")),
    ])
    counts = [
        df.agg(F.lit(name).alias("sink"), F.count("*").alias("n"), F.sum("event_id").alias("ids"))
        for name, df in results.items()
    ]
    return counts[0].unionByName(counts[1])


@query("watched_branches", f"""
with {closed_windows_sql('2 days')}
select 'large' as branch, count(*) as n, sum(event_id)::bigint as total from events where value > 100
union all select 'windows', count(*), sum(n)::bigint from closed""")
def watched_branches(t: Tables):
    """A filter and a window over the same arrivals, as two running queries watched together.

    Arrivals come in fifths, and each run goes on from the checkpoints of both branches. They
    are out of order by less than the watermark, so no row is too late.
    """
    def run(arrivals: DataFrame, root: str) -> DataFrame:
        events = J.event_time(arrivals, "ts")
        results = runner.run_all([
            runner.Branch("large", J.over_threshold(events, "value", 100, "event_id"), fmt="csv"),
            runner.Branch("windows", J.sliding_cond_counts(events, "ts", "event_type", "%lic%", "2 days")),
        ], root=root)
        totals = [
            results[name].agg(F.lit(name).alias("branch"), F.count("*").alias("n"), F.sum(of).alias("total"))
            for name, of in (("large", "event_id"), ("windows", "n"))
        ]
        return totals[0].unionByName(totals[1])

    return in_chunks(t, "v_arrivals", run)
