import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from rodaje.sources import readers, sinks, web
from rodaje.streaming import events as stream


def test_csv_readers(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_bytes("código;anio\n02;2010\n03;x\n".encode("latin-1"))
    assert readers.sniff_separator(spark, str(path)) == ";"
    df = readers.csv_text(spark, str(path), ";", "ISO-8859-1")
    assert df.columns == ["código", "anio"] and rows(df) == [("02", "2010"), ("03", "x")]
    assert readers.probe(df, ["anio", "otra"], ["anio"]).columns == ["anio", "otra"]
    with pytest.raises(ValueError, match="falta"):
        readers.probe(df, [], ["falta"])
    plain = tmp_path / "b.csv"
    plain.write_text("id,v\n02,1.5\n")
    assert rows(readers.csv_typed(spark, str(plain), "id string, v double")) == [("02", 1.5)]
    assert rows(readers.csv_inferred(spark, str(plain))) == [(2, 1.5)]


def test_zip_of_csvs(spark, tmp_path, rows):
    with zipfile.ZipFile(tmp_path / "y.zip", "w") as z:
        z.writestr("2024-01.csv", "a,b\n1,x\n2,y\n")
        z.writestr("2024-02.csv", "b,c\nz,9\n")
        z.writestr("leeme.txt", "no")
    with zipfile.ZipFile(tmp_path / "z.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("grande.csv", "\ufeffa,b\r\n" + "".join(f'{i},"año, {i}\n otra"\r\n' for i in range(30_000)))
        z.writestr("vacio.csv", "")
    big = readers.zip_of_csvs(spark, str(tmp_path / "z.zip"), ["a", "b"])
    assert big.count() == 30_000 and big.where("a = '12345'").first().b == "año, 12345\n otra"
    df = readers.zip_of_csvs(spark, str(tmp_path / "y.zip"), ["a", "b"])
    assert rows(df.select("miembro", "a", "b")) == [("2024-01.csv", "1", "x"), ("2024-01.csv", "2", "y"), ("2024-02.csv", None, "z")]


def test_merged_parquet_and_json(spark, tmp_path, rows):
    sinks.write_parquet(spark.sql("select 1 as a"), str(tmp_path / "p/x"))
    sinks.write_parquet(spark.sql("select 2 as a, 'z' as b"), str(tmp_path / "p/y"))
    assert rows(readers.parquet_glob(spark, str(tmp_path / "p/*"), merge=True).select("a", "b")) == [(1, None), (2, "z")]
    (tmp_path / "j.json").write_text('{"a": 1}\n{"a"\n')
    assert rows(readers.json_lines(spark, str(tmp_path / "j.json"), "a int")) == [(1,), (None,)]


def test_partitions_are_replaced_one_by_one(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.write_partitions(spark.sql("select * from values (1, 'a'), (2, 'b') as t(v, m)"), path, "m")
    sinks.write_partitions(spark.sql("select 9 as v, 'b' as m"), path, "m")
    assert rows(spark.read.parquet(path).select("v", "m")) == [(1, "a"), (9, "b")]


def test_snapshot_only_when_changed(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.sql("select * from values (1, 'a', 0.5D), (2, null, null) as t(k, v, x)")
    assert sinks.write_snapshot(df, path, "2026-01-01")
    assert not sinks.write_snapshot(df.orderBy(F.desc("k")).repartition(3), path, "2026-01-02")
    assert sinks.write_snapshot(df.unionByName(df.limit(1)), path, "2026-01-03")
    assert {r[0] for r in spark.read.parquet(path).select("capturado").distinct().collect()} == {date(2026, 1, 1), date(2026, 1, 3)}


def test_row_json(spark):
    df = spark.sql("select 1.23456D as x, cast('NaN' as double) as n, date'2026-01-02' as d, 'a\"b' as s, cast(null as int) as z")
    assert sinks.row_json(df).first()[0] == '[1.2346,null,"2026-01-02","a\\"b",null]'


@pytest.mark.parametrize(
    ("url", "allowed"),
    [("https://x.ar/", True), ("https://x.ar/privado/a", False), ("https://x.ar/privado/si/a", True), ("https://x.ar/a.pdf", False), ("https://x.ar/a.pdf?x=1", True), ("https://x.ar/igual", True)],
)
def test_robots(url, allowed):
    robots = "User-agent: otro\nDisallow: /\n\nUser-agent: *\nDisallow: /privado/ # no\nAllow: /privado/si\nDisallow: /*.pdf$\nDisallow: /igual\nAllow: /igual\nDisallow:\n"
    assert web.robots_allow(url, robots) is allowed
    assert not web.robots_allow(url, robots, "otro")


@pytest.mark.parametrize("path", ["a/b_c.parquet", "x__y/z.csv", "año 2026/%.txt"])
def test_asset_names_round_trip(path):
    name = web.asset_name(path)
    assert "/" not in name and web.path_of_asset(name) == path


def test_stream_closes_windows_and_drops_repeats(spark, tmp_path, rows):
    data = spark.sql(
        "select * from values (1, timestamp_ntz'2026-01-01 00:05:00', 'a', 1.0D), (1, timestamp_ntz'2026-01-01 00:05:00', 'a', 1.0D), (2, timestamp_ntz'2026-01-01 00:50:00', 'a', 2.5D), (3, timestamp_ntz'2026-01-01 02:00:00', 'b', 1.0D) as t(event_id, ts, event_type, value)"
    )
    data.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))
    out = stream.run_once(stream.windowed(source), str(tmp_path / "run"))
    assert rows(out.select(F.date_format("desde", "HH"), "event_type", "n", F.col("total").cast("double"))) == [("00", "a", 2, 3.5)]


def test_upsert_latest(spark, rows):
    old = spark.sql("select * from values ('a', 1, 10), ('b', 1, 20) as t(k, t, v)")
    new = spark.sql("select * from values ('a', 2, 11), ('c', 1, null) as t(k, t, v)")
    assert rows(stream.upsert_latest(new, old, ["k"], "t").select("k", "t", "v")) == [("a", 2, 11), ("b", 1, 20), ("c", 1, None)]


def test_stream_state_and_upserts_over_several_batches(spark, tmp_path, rows):
    data = [(1, "2026-01-01 00:00:00", "a"), (1, "2026-01-01 05:00:00", "b"), (2, "2026-01-01 00:00:00", "c"), (1, "2026-01-02 00:00:00", "d"), (2, "2026-01-01 01:00:00", "e"), (None, None, "f")]
    df = spark.createDataFrame(data, "u long, t string, k string").select("u", F.to_timestamp("t").alias("ts"), "k")
    for i, part in enumerate((df.where("k in ('a', 'c')"), df.where("k in ('b', 'e')"), df.where("k in ('d', 'f')"))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{i}"))
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in/*"))
    totals = stream.run_updates(stream.sessions(source, "u", "ts", 6 * 3600), ["u"], "events")
    assert rows(totals) == [(1, 3, 2), (2, 2, 1)]
    newest = stream.run_upserts(source.where("u is not null"), ["u"], "ts")
    assert rows(newest.select("u", "k")) == [(1, "d"), (2, "e")]
