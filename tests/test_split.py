import datetime
import decimal
import math
import random
import struct

import pytest
from conftest import SF_ORACLE
from pyspark.sql import functions as F

from plumbline.catalog.base import table
from plumbline.operators import levels, split
from plumbline.operators.split import in_share, side_sizes, split_at_fraction, split_at_time, train_test


def marked(df):
    return {r.id for r in df.where("is_ref").select("id").collect()}


def frame(spark, keys, kind="bigint"):
    rows = [(at, key) for at, key in enumerate(keys)]
    return spark.createDataFrame(rows, f"id bigint, key {kind}").repartition(3)


@pytest.mark.parametrize("read_rows", [0, 4, 1 << 16])
@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.99, 1.0])
def test_cut_equals_sorting(spark, monkeypatch, read_rows, fraction):
    monkeypatch.setattr(split, "_READ_ROWS", read_rows)
    monkeypatch.setattr(split, "_PASS_BITS", 3)
    source = random.Random(1)
    keys = [source.choice([None, -5, 0, 3, source.randrange(-(2**62), 2**62)]) for _ in range(200)]
    expected = sorted(range(200), key=lambda i: (keys[i] is not None, keys[i] or 0, i))
    got = marked(split_at_fraction(frame(spark, keys), ["key", "id"], fraction))
    assert got == set(expected[: math.floor(200 * fraction)])


def test_extreme_longs(spark):
    keys = [-(2**63), 2**63 - 1, 0, -1, 2**62, -(2**62)]
    assert marked(split_at_fraction(frame(spark, keys), ["key", "id"])) == {0, 5, 3}


def test_dates_and_timestamps(spark):
    days = [datetime.date(2024, 1, d) for d in (5, 1, 3, 2)]
    assert marked(split_at_fraction(frame(spark, days, "date"), ["key"])) == {1, 3}
    times = [datetime.datetime(1969, 12, 31, 23, 59, 59, us) for us in (5, 1, 3, 2)]
    for kind in ("timestamp", "timestamp_ntz"):
        assert marked(split_at_fraction(frame(spark, times, kind), ["key"])) == {1, 3}


def test_unsortable_order_is_refused(spark):
    for kind in ("array<bigint>", "string collate utf8_lcase"):
        with pytest.raises(TypeError):
            split_at_fraction(frame(spark, [], kind), ["key"])


def all_cuts(spark, df, keys, sort):
    """Splits at several places agree with sorting; ties by id."""
    expected = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, sort(keys[i]) if keys[i] is not None else 0, i))
    for fraction in (0.05, 0.35, 0.5, 0.8):
        assert marked(split_at_fraction(df, ["key", "id"], fraction)) == set(expected[: math.floor(len(keys) * fraction)])


@pytest.mark.parametrize("read_rows", [0, 1 << 16])
def test_doubles(spark, monkeypatch, read_rows):
    monkeypatch.setattr(split, "_READ_ROWS", read_rows)
    source = random.Random(4)
    edge = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf, math.nan, None, 1.0, 1.0000000000000002, 0.9999999999999999]
    keys = edge + [-k for k in edge if k is not None] + [source.uniform(-1, 1) * 10.0 ** source.randint(-320, 300) for _ in range(60)]
    keys += [2.0**k * j for k in range(-1074, 1023, 97) for j in (1, -1)] + [math.nextafter(2.0**k, 0) for k in range(-1000, 1023, 53)]
    all_cuts(spark, frame(spark, keys, "double"), keys, lambda x: (math.isnan(x), 0 if math.isnan(x) else x))


def test_bits_of_doubles(spark):
    source = random.Random(5)
    values = [2.0**k for k in range(-1074, 1024)] + [math.nextafter(2.0**k, 3e308) for k in range(-1074, 1023)] + [math.nextafter(2.0**k, 0) for k in range(-1073, 1024)]
    values += [struct.unpack("<d", struct.pack("<q", source.getrandbits(63) % (2047 << 52)))[0] for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", levels.bits_of(F.col("v")).alias("b"), levels.bits_of(-F.col("v")).alias("n"))
    for v, b, n in df.collect():
        assert b == struct.unpack("<q", struct.pack("<d", v))[0] == -n
        assert levels.double_of(b) == v and levels.double_of(n) == -v


@pytest.mark.parametrize("read_rows", [0, 1 << 16])
@pytest.mark.parametrize("kind", ["decimal(38,0)", "decimal(38,10)", "decimal(18,18)", "decimal(9,2)", "decimal(38,38)"])
def test_decimals(spark, monkeypatch, read_rows, kind):
    monkeypatch.setattr(split, "_READ_ROWS", read_rows)
    precision, scale = map(int, kind[8:-1].split(","))
    source = random.Random(6)
    numbers = [0, 1, -1, 10**precision - 1, 1 - 10**precision] + [source.randrange(1 - 10**precision, 10**precision) for _ in range(40)]
    numbers += [source.randrange(-100, 100) for _ in range(20)] + [source.choice([1, -1]) * (10**source.randrange(precision) + source.randrange(3)) for _ in range(30)]
    with decimal.localcontext(prec=60):
        keys = [None, None, *[decimal.Decimal(k % 10**precision if k > 0 else -(-k % 10**precision)).scaleb(-scale) for k in numbers]]
    all_cuts(spark, frame(spark, keys, kind), keys, lambda x: x)


@pytest.mark.parametrize("read_rows", [0, 3, 1 << 16])
@pytest.mark.parametrize("kind", ["string", "binary"])
def test_texts(spark, monkeypatch, read_rows, kind):
    monkeypatch.setattr(split, "_READ_ROWS", read_rows)
    source = random.Random(7)
    begin = ["", "a" * 5000, "long common beginning, ünd mehr 日本語 "]
    keys = [None, "", "\0", "a", "a\0", "a\0\0b", "\U0010ffff", "\uffff", "é", "e\u0301", "z" * 7, "z" * 8, "z" * 14]
    keys += [source.choice(begin) + "".join(source.choices("ab\0é", k=source.randint(0, 9))) for _ in range(120)]
    if kind == "binary":
        keys = [None if k is None else bytearray(k.encode()) + bytes([source.randrange(256)]) for k in keys]
    all_cuts(spark, frame(spark, keys, kind), keys, lambda x: bytes(x) if kind == "binary" else x.encode())


def test_booleans(spark):
    keys = [True, False, None, True, False, True]
    all_cuts(spark, frame(spark, keys, "boolean"), keys, int)


def test_rows_are_neither_sorted_nor_shuffled(spark):
    df = table(spark, SF_ORACLE, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    for order in (["o_orderpriority", "o_orderkey"], ["o_totalprice"]):
        plan = split_at_fraction(df, order)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan


def test_ties_are_broken_by_the_whole_row_in_any_layout(spark):
    # one key holds most of the table
    df = frame(spark, [1] * 10 + [7] * 90)
    first = marked(split_at_fraction(df, ["key"]))
    assert len(first) == 50 and set(range(10)) <= first
    for parts in (1, 7, 50):
        assert marked(split_at_fraction(df.repartition(parts), ["key"])) == first


def test_copies_across_the_cut_are_counted_out(spark):
    df = spark.createDataFrame([(1, "a")] * 30 + [(1, "b")] * 3 + [(0, "z")] * 5, "key int, name string").repartition(4)
    halves = split_at_fraction(df, ["key"])
    sizes = side_sizes(halves).first()
    assert (sizes.n_rows, sizes.n_ref, sizes.n_cur) == (38, 19, 19)
    assert halves.where("is_ref and name = 'z'").count() == 5
    assert halves.columns == ["key", "name", "is_ref"]


def test_small_tables(spark):
    assert marked(split_at_fraction(frame(spark, [4]), ["key"])) == set()
    empty = split_at_fraction(frame(spark, [4]).where("key > 9"), ["key"])
    assert side_sizes(empty).first().n_rows == 0


def test_pinned_halves_of_events(spark):
    halves = split_at_fraction(table(spark, SF_ORACLE, "events"), ["ts", "event_id"])
    found = halves.where("is_ref").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("s")).first()
    assert (found.n, found.s) == (5000, 12497500)


def test_split_adds_no_shuffle_and_no_sort(spark):
    halves = split_at_fraction(table(spark, SF_ORACLE, "events"), ["ts", "event_id"])
    plan = halves._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_time_cut(spark):
    times = [datetime.datetime(2024, 1, d) for d in (1, 2, 3)] + [None]
    assert marked(split_at_time(frame(spark, times, "timestamp"), "key", datetime.datetime(2024, 1, 2))) == {0, 3}


def test_hash_split(spark):
    events = table(spark, SF_ORACLE, "events").select("event_id")
    train, test = train_test(events, "event_id")
    found = test.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("s")).first()
    assert (found.n, found.s) == (2063, 10444285)
    assert train.count() == 10000 - 2063
    other = {r.event_id for r in events.repartition(9).where(in_share(F.col("event_id"), 0.2)).collect()}
    assert other == {r.event_id for r in test.collect()}
    assert events.where(in_share(F.lit(None), 0.2)).count() in (0, 10000)
