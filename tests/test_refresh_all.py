import os

import pytest

from touchline.config import AttributionConfig
from touchline.plans.models import Models
from touchline.sources.scan import raw_events
from touchline.sources.snapshots import Generation
from touchline.streaming.refresh_all import TABLES, build_all, refresh_all

CFG = AttributionConfig(as_of="2030-01-01 00:00:00")
SF = "/root/testdata/sf0.001"


def rows(df):
    columns = sorted(df.columns)
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*columns).collect())


def test_refreshed_tables_equal_full_ones(spark, scratch):
    raw = raw_events(spark, SF)
    late = "event_timestamp % 13 = 0 AND event_date IN ('20240103', '20240110', '20240111')"
    build_all(spark, scratch, raw.where(f"NOT ({late})"), CFG)
    before = Generation(spark, scratch)
    assert refresh_all(spark, scratch, raw.where(late), CFG) == 2
    after = Generation(spark, scratch)
    for name, df in Models(raw, CFG).materialize().tables().items():
        assert rows(after.read(name)) == rows(df), name
    # Untouched dates keep their files: only those that late events reach were written.
    days = {f"{r[0][:4]}-{r[0][4:6]}-{r[0][6:]}" for r in raw.where(late).select("event_date").distinct().collect()}
    assert days and {d for d, g in after.places["int_touchpoints"].items() if g != [1]} == days
    for name in ("int_user_journeys", "mart_attribution_comparison"):
        new = {d for d, g in after.places[name].items() if g == [2]}
        assert new and all("2024-01-03" <= d <= "2024-01-25" for d in new)
        assert new < set(after.places[name])
    # Nothing new changes nothing; the older generation is still whole.
    assert refresh_all(spark, scratch, raw.limit(0), CFG) is None
    assert rows(before.read("int_touchpoints")) != rows(after.read("int_touchpoints"))


def test_a_refresh_that_fails_shows_nothing_and_can_be_repeated(spark, scratch, monkeypatch):
    raw = raw_events(spark, SF).where("user_pseudo_id IN ('1', '2', '3')")
    late = "event_date = '20240108'"
    build_all(spark, scratch, raw.where(f"NOT ({late})"), CFG)
    before = {n: rows(Generation(spark, scratch).read(n)) for n in ("stg_ga4_events", "int_touchpoints")}
    with monkeypatch.context() as m:
        m.setattr(Generation, "commit", lambda self: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            refresh_all(spark, scratch, raw.where(late), CFG)
    assert {n: rows(Generation(spark, scratch).read(n)) for n in before} == before
    refresh_all(spark, scratch, raw.where(late), CFG)
    for name, df in Models(raw, CFG).tables().items():
        assert rows(Generation(spark, scratch).read(name)) == rows(df), name


def test_appended_columns_are_null_in_older_partitions(spark, scratch):
    one = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, a int")
    g = Generation(spark, scratch)
    g.replace("t", one, "d")
    g.commit()
    g = Generation(spark, scratch)
    g.replace("t", spark.createDataFrame([("2024-01-02", 3, "x")], "d string, a int, b string"), "d", {"2024-01-02"})
    with pytest.raises(ValueError):
        g.append("t", one, "d")
    g.commit()
    g = Generation(spark, scratch)
    assert sorted(map(tuple, g.read("t").collect())) == [("2024-01-01", 1, None), ("2024-01-02", 3, "x")]
    assert [tuple(r) for r in g.read("t", {"2024-01-01"}).collect()] == [("2024-01-01", 1, None)]
    with pytest.raises(ValueError, match="column a"):
        g.replace("t", spark.createDataFrame([("2024-01-03", "text")], "d string, a string"), "d")
    assert os.path.isdir(f"{scratch}/t/generation=1")


def test_tables_are_the_eight_models(spark):
    assert set(TABLES) == set(Models(raw_events(spark, SF), CFG).tables())


def test_journeys_are_written_without_a_shuffle_by_date(spark, scratch, monkeypatch):
    from touchline.sources import sinks
    asked = {}
    write = sinks.write_clustered
    monkeypatch.setattr(sinks, "write_clustered", lambda df, path, *a, **kw: (asked.update({path.split("/")[-2]: kw.get("rebalance", True)}), write(df, path, *a, **kw)))
    raw = raw_events(spark, SF).where("user_pseudo_id IN ('1', '2', '3')")
    build_all(spark, scratch, raw, CFG)
    assert {n for n, rebalanced in asked.items() if not rebalanced} == {"int_user_journeys"} and set(asked) == set(TABLES)
    assert rows(Generation(spark, scratch).read("int_user_journeys")) == rows(Models(raw, CFG).journeys)
