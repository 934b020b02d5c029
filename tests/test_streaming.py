import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from tallyfold.operators import words as W
from tallyfold.operators.ordered import out_of_order
from tallyfold.sources import streams as S
from tallyfold.sources.schemas import ARTICLE_MESSAGE
from tallyfold.streaming import jobs as J
from tallyfold.streaming import runner
from tallyfold.streaming.arrivals import stream_out_of_order

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def folder(spark, tmp_path):
    """Writes frames one after the other as files of one stream folder."""
    def write(*frames, fmt="parquet"):
        for frame in frames:
            frame.coalesce(1).write.mode("append").format(fmt).save(str(tmp_path / "in"))
        return str(tmp_path / "in")

    return write


def test_word_counts_equal_batch(spark, rows, folder):
    parts = [rows("value string", ("A b-b, ž b",)), rows("value string", ("a !! bb",))]
    lines = S.stream_text_dir(spark, folder(*parts, fmt="text"), max_files_per_trigger=1)
    final = runner.run_complete(J.word_counts(lines), "words")
    batch = W.count_by(W.clean_words(parts[0].unionByName(parts[1]), "value"), "word")
    assert values(final) == values(batch) == [("a", 2), ("b", 1), ("bb", 2)]


def test_changelog_grows_and_compacts(spark, rows, folder):
    path = folder(rows("value string", ("to be or",)), rows("value string", ("not to be",)), fmt="text")
    log = runner.run_changelog(J.letter_changelog(S.stream_text_dir(spark, path, 1)), "letters")
    assert values(log.select("letter", "n")) == [("b", 1), ("b", 2), ("n", 1), ("o", 1), ("t", 1), ("t", 2)]
    assert values(W.compact_counts(log, "letter")) == [("b", 2), ("n", 1), ("o", 1), ("t", 2)]


def test_empty_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    lines = S.stream_text_dir(spark, str(tmp_path / "none"))
    assert runner.run_complete(J.word_counts(lines), "none").count() == 0
    assert runner.run_changelog(J.letter_changelog(lines), "none").count() == 0
    assert runner.multi_sink(lines, [("x", lambda b: b)])["x"].count() == 0


def test_window_edges(spark, rows, folder):
    at = [0, 15, 29, 30]
    frame = rows("ts timestamp, text string", *[(T0 + dt.timedelta(seconds=s), "w w") for s in at])
    stream = S.stream_table(spark, folder(frame), frame.schema)
    got = runner.run_complete(J.window_word_counts(stream, "text", "ts"), "windows")
    starts = {(r["start"] - T0).total_seconds(): r["n"] for r in got.collect()}
    assert starts == {-15: 2, 0: 6, 15: 6, 30: 2}


def test_windows_close_with_a_watermark(spark, rows, folder):
    frame = rows("ts timestamp, text string", *[(T0 + dt.timedelta(seconds=s), "w") for s in (0, 100)])
    stream = S.stream_table(spark, folder(frame), frame.schema)
    counts = J.window_word_counts(stream, "text", "ts", watermark="5 seconds", ordered=False)
    assert len(values(runner.run_append(counts, "closed"))) == 2


def test_sliding_counts_and_nulls(spark, rows, folder):
    frame = rows("ts timestamp, content string", (T0, "x válka"), (T0, None), (T0, "mír"),
                 (T0 + dt.timedelta(seconds=60), None), (T0 + dt.timedelta(hours=1), "x"))
    stream = S.stream_table(spark, folder(frame), frame.schema)
    got = runner.run_append(J.sliding_cond_counts(stream, "ts", "content", "%válka%"), "sliding")
    by_start = {(r["start"] - T0).total_seconds(): (r["n"], r["n_matched"]) for r in got.collect()}
    assert by_start[0] == (3, 1) and by_start[10] == (1, None) and by_start[-50] == (3, 1)
    assert 3600 - 50 not in by_start  # still open at the end


def test_multi_sink_reads_once(spark, rows, folder):
    frame = rows("title string, comment_count int", ("a", 100), ("b", 101))
    stream = S.stream_table(spark, folder(frame, frame), frame.schema, 1)
    got = runner.multi_sink(stream, [
        ("titles", lambda b: b.select("title")), ("large", lambda b: b.filter("comment_count > 100"))])
    assert values(got["titles"]) == [("a",)] * 2 + [("b",)] * 2
    assert values(got["large"]) == [("b", 101)] * 2


def test_out_of_order_across_batches(spark, rows, folder):
    data = [(i, (i * 37) % 101, "hot" if i % 3 else "k%d" % (i % 5)) for i in range(120)]
    schema = "seq long, t long, key string"
    frames = [rows(schema, *data[i : i + 20]) for i in range(0, 120, 20)]
    path = folder(*frames)
    whole = rows(schema, *data)
    for keys in ([], ["key"]):
        stream = S.stream_table(spark, path, whole.schema, 1)
        got = stream_out_of_order(stream, "t", "seq", keys, rows_per_bucket=5, compact_every=2)
        assert values(got) == values(out_of_order(whole, "t", "seq", keys))


def test_first_seen(spark, rows, folder):
    frame = rows("ts timestamp, url string", (T0, "a"), (T0, "a"), (T0, "b"))
    stream = S.stream_table(spark, folder(frame, frame), frame.schema, 1)
    assert values(runner.run_append(J.first_seen(stream, "url", "ts", "1 hour"), "seen"), "url") == [("a",), ("b",)]


def test_messages_from_files(spark, rows, folder):
    """The parsing half of the Kafka sources, fed by files."""
    lines = rows("value string", ('{"title": "t", "comment_count": 120}',), ("oops",),
                 ('{"title": "u", "comment_count": "x"}',), ("{}",))
    raw = S.raw_values(S.stream_text_dir(spark, folder(lines, fmt="text")))
    typed = S.typed_messages(raw, ARTICLE_MESSAGE)
    got = runner.run_append(typed, "typed")
    assert values(got, "title", "comment_count") == sorted([("t", 120), ("u", None), (None, None)], key=repr)
    assert got.filter("ts is null").count() == 0


def test_filter_to_csv(spark, rows, folder):
    frame = rows("title string, comment_count int", ("a;b", 101), ("c", 100))
    stream = S.stream_table(spark, folder(frame), frame.schema)
    chosen = J.over_threshold(stream, "comment_count", 100, "title", "comment_count")
    assert values(runner.run_append(chosen, "csv", "csv", sep=";")) == [("a;b", 101)]


def test_kafka_options():
    assert S.kafka_options("k:9092", "t", "g") == {
        "kafka.bootstrap.servers": "k:9092", "subscribe": "t", "startingOffsets": "latest",
        "kafka.group.id": "g",
    }
    assert "kafka.group.id" not in S.kafka_options("k:9092", "t")


def test_socket_reader(spark):
    """Built only: the connection is made when a query starts."""
    lines = S.stream_socket(spark, "localhost", 9999)
    assert lines.isStreaming and lines.columns == ["value"]


def test_console(spark, rows, folder):
    frame = rows("value string", ("a",))
    runner.run_console(J.passthrough(S.stream_table(spark, folder(frame), frame.schema)))


def test_runs_go_on_where_they_stopped(spark, rows, folder, tmp_path):
    frame, root, out = rows("title string, n int", ("a", 1)), str(tmp_path / "root"), str(tmp_path / "csv")
    more = rows("title string, n int", ("b", 2), ("c", 3))
    lists = []
    for part in (frame, more):
        stream = S.stream_table(spark, folder(part), frame.schema)
        rows_ = runner.run_append(stream, "x", "csv", root=root, path=out, sep=";")
        log = runner.run_changelog(stream, "x", root=root + "-log")
        last = runner.run_complete(stream.groupBy("title").count(), "x", root=root + "-complete")
        sinks = runner.multi_sink(stream, [
            runner.Sink("all", lambda b: b, "json", out + "-all"), ("few", lambda b: b.filter("n > 2"))],
            root=root + "-sinks")
        lists.append((values(rows_), values(log, "title"), values(last), values(sinks["all"]), values(sinks["few"])))
    assert lists[0] == ([("a", 1)], [("a",)], [("a", 1)], [("a", 1)], [])
    every = [("a", 1), ("b", 2), ("c", 3)]
    assert lists[1] == (every, [("a",), ("b",), ("c",)], [(x, 1) for x in "abc"], every, [("c", 3)])
    assert spark.read.option("sep", ";").csv(out).count() == 3
    assert {r["batch"] for r in log.collect()} == {0, 1}


def test_complete_mode_keeps_two_results(spark, rows, folder, tmp_path):
    frames = [rows("value string", (f"w{i}",)) for i in range(5)]
    stream = S.stream_table(spark, folder(*frames), frames[0].schema, 1)
    assert runner.run_complete(stream.groupBy("value").count(), "x", root=str(tmp_path / "r")).count() == 5
    assert len(runner.written_batches(spark, str(tmp_path / "r/out"))) == 2


def test_branches_with_a_window(spark, rows, folder, tmp_path):
    frame = rows("ts timestamp, content string, n int", (T0, "x", 1), (T0, "y", 200),
                 (T0 + dt.timedelta(hours=1), "x", 300))
    path = folder(frame)
    source = lambda: S.stream_table(spark, path, frame.schema)
    got = runner.run_all([
        runner.Branch("print", source().select("content"), fmt="console"),
        runner.Branch("large", source().filter("n > 100").select("n"), fmt="csv", path=str(tmp_path / "large")),
        runner.Branch("windows", J.sliding_cond_counts(source(), "ts", "content", "%x%")),
    ], root=str(tmp_path / "runs"))
    assert values(got["large"]) == [(200,), (300,)] and (T0 in {r["start"] for r in got["windows"].collect()})


def test_a_failing_branch_stops_the_others(spark, rows, folder, tmp_path):
    """The second branch dies while the first, which never ends, is the one waited for."""
    frame = rows("n int", (1,), (0,))
    path = folder(frame)
    source = lambda: S.stream_table(spark, path, frame.schema)
    bad = source().select(F.when(F.col("n") == 0, F.raise_error(F.lit("bad row"))).otherwise(F.col("n")).alias("n"))
    before = {q.id for q in spark.streams.active}
    with pytest.raises(runner.BranchFailed, match="bad row") as failure:
        runner.run_all([runner.Branch("good", source()), runner.Branch("bad", bad)],
                       trigger={"processingTime": "1 second"}, root=str(tmp_path / "runs"))
    assert failure.value.branch == "bad"
    assert {q.id for q in spark.streams.active} == before
    again = runner.run_all([runner.Branch("good", source())], root=str(tmp_path / "runs"))
    assert values(again["good"]) == [(0,), (1,)]  # goes on from its checkpoint, no row twice


def test_a_branch_that_cannot_start(spark, rows, folder, tmp_path):
    frame = rows("n int", (1,))
    source = S.stream_table(spark, folder(frame), frame.schema)
    before = {q.id for q in spark.streams.active}
    with pytest.raises(Exception, match="(?i)mode"):  # counts without a watermark cannot be appended
        runner.run_all([runner.Branch("good", source), runner.Branch("bad", source.groupBy("n").count())],
                       trigger={"processingTime": "1 second"}, root=str(tmp_path / "runs"))
    assert {q.id for q in spark.streams.active} == before
    with pytest.raises(ValueError):
        runner.run_all([runner.Branch("a", source), runner.Branch("a", source)], root=str(tmp_path / "same"))


def test_rolled_text_from_a_stream(spark, rows, folder, tmp_path):
    frame = rows("value string", *[(f"line {i}",) for i in range(25)])
    stream = S.stream_table(spark, folder(frame), frame.schema)
    out = str(tmp_path / "rolled")
    assert runner.run_append(stream, "x", "text", path=out, maxRecordsPerFile=10).count() == 25
    files = [p for p in (tmp_path / "rolled").iterdir() if p.name.startswith("part")]
    assert sorted(len(p.read_text().splitlines()) for p in files) == [5, 10, 10]


def test_null_keys_keep_their_state(spark, rows, folder):
    schema = "seq long, t long, key string"
    frames = [rows(schema, (1, 5, None), (2, 9, "a")), rows(schema, (3, 4, None), (4, 8, "a"))]
    stream = S.stream_table(spark, folder(*frames), frames[0].schema, 1)
    got = stream_out_of_order(stream, "t", "seq", ["key"])
    assert values(got, "seq") == values(out_of_order(frames[0].union(frames[1]), "t", "seq", ["key"]), "seq") == [(3,), (4,)]


def test_event_time_is_an_instant(rows):
    df = rows("ts timestamp_ntz", (T0,))
    assert dict(J.event_time(df, "ts").dtypes) == {"ts": "timestamp"}
    assert J.event_time(df, "ts").select(F.unix_seconds("ts")).first()[0] == 1704067200
