import pytest

from pyspark.sql import functions as F

from plumbline.operators.payload import parse_events
from plumbline.sources.log import append_batch, commits, has_versions, load_version
from plumbline.sources.streams import kafka_events, replay_events
from plumbline.sources.tables import load_table, minutes_between
from plumbline.streaming.batches import replace_batch
from plumbline.streaming.ingest import block_on, deal_files, start_batch_ingest, start_ingest


def line(user, second, kind="click"):
    return f'{{"user_id":"{user}","event_type":"{kind}","timestamp":"2024-01-01T00:0{second // 60}:{second % 60:02d}Z","page":"/home","value":{second}.0}}'


@pytest.fixture
def places(tmp_path):
    replay = tmp_path / "replay"
    replay.mkdir()
    return replay, str(tmp_path / "bronze"), str(tmp_path / "log")


def run(spark, places, **options):
    replay, sink, log = places
    query = start_ingest(replay_events(spark, str(replay)), sink, log, interval=None, **options)
    assert block_on(query, 120)
    return spark.read.parquet(sink)


def rows(df):
    columns = ["user_id", "event_type", "page", "value", "event_timestamp", "event_minute"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_stream_equals_batch_and_restarts_add_nothing(spark, places):
    replay = places[0]
    (replay / "a.txt").write_text("\n".join([*(line(f"u{i}", i * 30) for i in range(6)), "not json"]) + "\n")
    first = rows(run(spark, places))
    assert first == rows(parse_events(spark.read.text(str(replay))))
    assert rows(run(spark, places)) == first
    (replay / "b.txt").write_text(line("late", 5) + "\n")
    again = rows(run(spark, places))
    assert len(again) == len(first) + 1
    assert {r[0] for r in again} - {r[0] for r in first} == {"late"}


def test_unreadable_payloads_land_in_the_default_partition(spark, places):
    (places[0] / "a.txt").write_text("not json\n" + line("u", 1) + "\n")
    run(spark, places)
    from pathlib import Path

    folders = {p.name for p in Path(places[1]).iterdir() if p.is_dir() and "=" in p.name}
    assert folders == {"event_minute=__HIVE_DEFAULT_PARTITION__", "event_minute=2024-01-01-00-00"}


def test_gathered_minutes_are_few_files_and_the_same_rows(spark, places):
    for part in range(4):
        (places[0] / f"{part}.txt").write_text("\n".join(line(f"u{part}{i}", i) for i in range(50)) + "\n")
    found = run(spark, places, files_per_minute=2)
    assert rows(found) == rows(parse_events(spark.read.text(str(places[0]))))
    from pathlib import Path

    files = [p for p in Path(places[1]).rglob("*.parquet") if "2024-01-01-00-00" in str(p)]
    assert 1 <= len(files) <= 2


def test_copies_in_one_minute_are_dealt_out(spark):
    from pyspark.sql import functions as F

    from plumbline.streaming.ingest import spread_minutes

    bronze = parse_events(spark.createDataFrame([(line("same", 1),)] * 400, "value string"))
    held = spread_minutes(bronze, 8).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 400 and max(r["count"] for r in held) < 400


def test_continuous_trigger_runs_until_stopped(spark, places):
    (places[0] / "a.txt").write_text(line("u", 1) + "\n")
    query = start_ingest(replay_events(spark, str(places[0])), places[1], places[2], interval="1 second")
    try:
        query.processAllAvailable()
        assert not block_on(query, 0.1)
    finally:
        query.stop()
    assert spark.read.parquet(places[1]).count() == 1


def test_kafka_source_asks_for_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_events(spark, "nowhere:9092")


def batches(spark, places, **options):
    replay, sink, log = places
    assert block_on(start_batch_ingest(replay_events(spark, str(replay)), sink, log, interval=None, **options), 120)
    return load_version(spark, sink)


def test_batches_equal_the_parsed_rows_and_have_versions(spark, places):
    replay, sink, _ = places
    (replay / "a.txt").write_text("\n".join([*(line(f"u{i}", i * 30) for i in range(6)), "not json"]) + "\n")
    first = rows(batches(spark, places, rows_per_file=2))
    assert first == rows(parse_events(spark.read.text(str(replay))))
    assert rows(batches(spark, places)) == first
    (replay / "b.txt").write_text(line("late", 5) + "\n")
    assert len(rows(batches(spark, places))) == len(first) + 1
    assert rows(load_table(spark, sink, version=0)) == first
    assert [(r.batch_id, r.n_rows) for r in commits(spark, sink).orderBy("batch_id").collect()] == [(0, 7), (1, 1)]
    with pytest.raises(LookupError, match="newest is 1"):
        load_table(spark, sink, version=2)


def test_files_hold_about_as_many_rows_whatever_the_minutes(spark):
    lines = [line("same", 1)] * 400 + [line(f"u{i}", 60 + i * 7) for i in range(60)] + ["broken"] * 30
    bronze = parse_events(spark.createDataFrame([(x,) for x in lines], "value string").repartition(3))
    dealt = deal_files(bronze, 50)
    files = dealt.groupBy(F.spark_partition_id().alias("file")).agg(F.count("*").alias("n"), F.collect_set("event_minute").alias("minutes")).collect()
    assert sum(f.n for f in files) == 490 and max(f.n for f in files) < 150
    assert sum(f.minutes == ["2024-01-01-00-00"] for f in files) == 8
    assert rows(dealt) == rows(bronze)
    assert deal_files(bronze.limit(0), 50).count() == 0


def test_scans_skip_files_and_batches(spark, tmp_path):
    path = str(tmp_path / "log")
    for k in range(3):
        append_batch(spark.createDataFrame([(k, f"2024-01-0{k + 1}-00-00")], "a int, event_minute string"), path)
    replace_batch(spark.createDataFrame([(9, "2024-01-09-00-00")], "a int, event_minute string"), path, 7)
    assert [r.a for r in load_version(spark, path).orderBy("a").collect()] == [0, 1, 2]
    plan = minutes_between(load_table(spark, path, version=1), "2024-01-01", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "GreaterThanOrEqual(event_minute" in plan
    assert load_table(spark, path).count() == 4  # without versions in mind, all that lies there


def test_a_failed_batch_is_no_part_of_any_version(spark, places, monkeypatch):
    from plumbline.streaming import ingest

    replay, sink, log = places
    (replay / "a.txt").write_text(line("u", 1) + "\n" + line("v", 2) + "\n")
    real = ingest.append_batch

    def lost(rows, path, batch_id):
        replace_batch(rows.limit(1), path, batch_id)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "append_batch", lost)
    with pytest.raises(Exception, match="lost"):
        block_on(start_batch_ingest(replay_events(spark, str(replay)), sink, log, interval=None), 120)
    assert not has_versions(spark, sink)
    monkeypatch.setattr(ingest, "append_batch", real)
    assert batches(spark, places).count() == 2
