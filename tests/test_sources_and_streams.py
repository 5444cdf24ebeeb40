import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.operators import panel, series
from ebbflow.sources import dumps, payloads
from ebbflow.streaming import live

#: The two layouts of the files.
HEADER_A = ["Ressources-Remplois", "PERIODE", "Business Line", "Segmentation niveau 2", "CODE SEGMENTATION COMMERCIAL", "IDENTIF. NATIONAL -B35T", "CODE TYPE COMPTE -B35M", "Rubriques", "DATE OUVERTURE COMPTE -B35M", "CTRVL KDA", "SOLDE REPORTING FRENCH / DEV CPTE"]
HEADER_B = ["Ressources-Remplois", "PERIODE", "Business Line", "CODE TYPE COMPTE -B35M", "IDENTIF. NATIONAL -B35T", "Rubriques", "DATE OUVERTURE COMPTE -B35M", "CTRVL KDA", "SOLDE REPORTING FRENCH / DEV CPTE"]


def dump(header, rows, sep):
    return "\n".join(["Titre du rapport", sep.join(header), *[sep.join(r.get(h, "") for h in header) for r in rows], ""])


def row(client, label, kda, kind="Ressources"):
    return {HEADER_A[0]: kind, HEADER_A[5]: client, HEADER_A[6]: "700", HEADER_A[7]: label, HEADER_A[8]: "12/23/2015", HEADER_A[9]: kda, HEADER_A[10]: "1.00"}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("dumps")
    rows = [row("C1", "Comptes à vue DINARS", "1,234.50"), row("C2", "Épargne", "10"), row("", "x", "1"), row("C3", "x", "5", "Remplois")]
    for name, encoding, header, sep in (("DAV_072019.txt", "cp1252", HEADER_A, "\t"), ("DAV_082019.txt", "utf-8-sig", HEADER_B, ";"), ("DAV_092019.text", "utf-16", HEADER_A, "\t"), ("DAV_102019.txt", "utf-8", HEADER_B, "\t"), ("DAV_112019.txt", "utf-8", ["nothing"], ",")):
        (at / name).write_bytes(dump(header, rows, sep).encode(encoding))
    return at


def test_dumps_of_any_layout(spark, folder):
    cells = dumps.read_dumps(spark, str(folder))
    kinds = {r.file.rsplit("/", 1)[1]: (r.encoding, r.delimiter, r.missing) for r in cells.collect()}
    assert {k: v[:2] for k, v in kinds.items()} == {"DAV_072019.txt": ("cp1252", "\t"), "DAV_082019.txt": ("utf-8-sig", ";"), "DAV_092019.text": ("utf-16", "\t"), "DAV_102019.txt": ("utf-8", "\t")}
    assert kinds["DAV_082019.txt"][2] == ["seg2", "seg_commercial", "currency"]
    got = panel.in_scope(dumps.records(cells))
    assert sorted((r.client_id, r.month_int, r.segment, r.ctrvl_kda) for r in got.collect()) == sorted((c, 2019 * 12 + m, s, v) for m in (6, 7, 8, 9) for c, s, v in (("C1", "vue_dinars", 1234.5), ("C2", "epargne", 10.0)))
    assert panel.in_scope(dumps.records(cells), ["epargne"]).count() == 4


def test_panel_sink_prunes(spark, folder, tmp_path):
    rows = dumps.records(dumps.read_dumps(spark, str(folder))).withColumn("account_id", panel.account_key("client_id", "type_compte"))
    dumps.write_panel(panel.build(rows), str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p")).where("segment = 'epargne'")
    assert back.count() == 4 and "PartitionFilters: [isnotnull(segment" in back._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert {r.account_id for r in back.collect()} == {"C2|700"}


def test_unions_and_scores(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "m int, a string"), spark.createDataFrame([(2, 3.0)], "m int, b double")
    assert dumps.unioned([a, b]).where("a is null or b is null").count() == 2
    scores = spark.createDataFrame([(1, "v1", 0.5)], "asof_month int, version string, wal double")
    path = str(tmp_path / "scores")
    assert [dumps.append_scores(scores, path), dumps.append_scores(scores, path)] == [1, 0] and spark.read.parquet(path).count() == 1


def sdmx(keys, flat=False):
    times = [{"id": "2015-M01"}, {"id": "2015-M02"}, {"id": "2015-03"}]
    obs = {"0": ["1.5"], "1": ["x"], "2": [2]}
    sets = {"observations": {f"0:0:{k}": v for k, v in obs.items()}} if flat else {"series": {"0:0": {"observations": obs}}}
    return json.dumps({"data": {"structures": [{"dimensions": {"observation": [{"id": "TIME_PERIOD", "values": times}]}}], "dataSets": [sets]}})


def test_payloads(spark):
    df = spark.createDataFrame([("a", sdmx(0)), ("b", sdmx(0, True)), ("c", "{}")], "k string, payload string")
    assert sorted(map(tuple, payloads.sdmx(df).collect())) == [(k, p, v) for k in "ab" for p, v in (("2015-01", 1.5), ("2015-03", 2.0))]
    df = spark.createDataFrame([('[{"page":1},[{"date":"2020","value":1.5},{"date":"2021","value":null}]]',), ('[{"message":"bad"}]',)], "payload string")
    assert [tuple(r) for r in payloads.indicator(df).collect()] == [("2020", 1.5)]
    html = '<p>x</p>[{"date":"2016-01-01","buyRate":174.5,"sellRate":175.5,"officialBuyRate":117,"officialSellRate":119},{"date":"bad","buyRate":1}] {"date":"2024-06-02","buyRate":1,"sellRate":3,"officialBuyRate":1,"officialSellRate":1,"usdBuyRate":222,"usdSellRate":224}'
    got = payloads.quotes(spark.createDataFrame([(html,)], "html string")).orderBy("day").collect()
    assert [(str(r.day), r.parallel, r.official, r.usd) for r in got] == [("2016-01-01", 175.0, 118.0, None), ("2024-06-02", 2.0, 1.0, 223.0)]
    sheet = spark.createDataFrame([("2015M01", "50.5"), ("Notes", "1"), ("2015M02", "n/a")], "p string, v string")
    assert [tuple(r) for r in payloads.price_sheet(sheet, "p", "v").collect()] == [("2015-01", 50.5)]


def finished(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_bars_equal_batch(spark, tmp_path):
    rows = [("k", f"2024-01-01 00:{m:02d}:{s:02d}", float(m * 60 + s), m * 60 + s) for m in range(12) for s in (0, 30)]
    ticks = spark.createDataFrame(rows, "key string, ts string, value double, tie int").withColumn("ts", F.col("ts").cast("timestamp"))
    ticks.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ticks.schema).parquet(str(tmp_path / "in"))
    finished(live.tumbling_bars(stream, "5 minutes", "1 minute").writeStream.format("memory").queryName("bars").outputMode("complete").trigger(availableNow=True).start())
    got = sorted((r.o, r.hi, r.lo, r.c, r.n) for r in spark.table("bars").collect())
    want = series.bars(ticks.withColumn("w", F.window("ts", "5 minutes").start), ["w"])
    assert got == sorted((r.o, r.hi, r.lo, r.c, r.n) for r in want.collect())


def test_online_alarm_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=100), 4 + rng.normal(size=60)])
    df = spark.createDataFrame([("a", t, float(v)) for t, v in enumerate(x)], "series_id string, t long, x double")
    for k in range(4):
        df.where(f"t div 40 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    live.keep_typed_state(spark)
    finished(live.online_cusum(stream).writeStream.format("memory").queryName("alarms").trigger(availableNow=True).start())
    got = {r.t for r in spark.table("alarms").where("changepoint = 1").collect()}
    assert got == {r.t for r in series.cusum(df).where("changepoint = 1").collect()} and got


def test_new_files_are_taken_once(spark, folder, tmp_path):
    for _ in range(2):
        finished(live.ingest(spark, str(folder), str(tmp_path / "store"), str(tmp_path / "check")))
    assert spark.read.parquet(str(tmp_path / "store")).count() == 12


def test_new_months_are_scored_once(spark, tmp_path):
    spark.createDataFrame([(1, 2.0), (2, 3.0)], "asof_month int, wal double").write.parquet(str(tmp_path / "in"))
    for k in range(2):
        stream = spark.readStream.schema("asof_month int, wal double").parquet(str(tmp_path / "in"))
        finished(live.score_new_months(stream, lambda df: df.withColumn("version", F.lit("v")), str(tmp_path / "out"), str(tmp_path / f"c{k}")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_sinks_read_back(spark, tmp_path):
    from ebbflow.sources import dumps

    rows = spark.createDataFrame([("a", 24000, 1.5), ("b", 24000, None), ("a", 24013, 2.0)], "series string, month_int int, value double")
    dumps.write_series(rows, f"{tmp_path}/series")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/series").select(*rows.columns).collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    dumps.write_months(rows, f"{tmp_path}/months")
    back = spark.read.option("header", True).csv(f"{tmp_path}/months")
    assert sorted((int(r.year), int(r.month), r.series) for r in back.collect()) == [(2000, 1, "a"), (2000, 1, "b"), (2001, 2, "a")]
    table = spark.createDataFrame([(0, 5, 0.1, 0.2, 0.15, 0.25)], "bin int, n long, mean_p double, mean_y double, w_mean_p double, w_mean_y double")
    dumps.write_calibration(table, f"{tmp_path}/bins")
    assert spark.read.option("header", True).csv(f"{tmp_path}/bins").columns == ["bin", "n", "predicted", "actual", "weighted_actual"]


def test_online_regimes_follow_a_switch(spark, tmp_path):
    """Two levels by turns, over several batches of files: the state's probability follows the level."""
    import random

    rng = random.Random(6)
    rows = [("s", t, rng.gauss(4.0 if t // 12 % 2 else 0.0, 0.5)) for t in range(180)]
    df = spark.createDataFrame(rows, "series_id string, t long, x double")
    for k in range(3):
        df.where(f"t >= {60 * k} and t < {60 * (k + 1)}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    live.keep_typed_state(spark)
    finished(live.online_regimes(stream).writeStream.format("memory").queryName("regimes").trigger(availableNow=True).start())
    got = {r.t: r.p1 for r in spark.table("regimes").collect()}
    assert len(got) == 180 and all(got[t] is None for t in range(47))
    high = [got[t] for t in range(60, 180) if t // 12 % 2 and t % 12 > 1]
    low = [got[t] for t in range(60, 180) if not t // 12 % 2 and t % 12 > 1]
    assert min(high) > 0.9 and max(low) < 0.1 or min(low) > 0.9 and max(high) < 0.1


def test_a_stopped_stream_goes_on_bit_for_bit(spark, tmp_path):
    """A query that stops after each file gives the numbers of the batch fold, of long series and of one that stays below its warm-up."""
    rng = np.random.default_rng(8)
    live.keep_typed_state(spark)
    rows = [(s, t, float(rng.normal(3.0 * (t // 20 % 2), 1.0))) for s, n in (("a", 120), ("b", 118), ("c", 10)) for t in range(n)]
    df = spark.createDataFrame(rows, "series_id string, t long, x double")
    for k in range(3):
        df.where(f"t div 40 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for name, online in (("breaks", live.online_cusum), ("regimes", live.online_regimes)):
            stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
            finished(online(stream).writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True).start())
    got = {(r.series_id, r.t): r.p1 for r in spark.read.parquet(str(tmp_path / "regimes")).collect()}
    want = {(r.series_id, r.t): r.p1 for r in series.adaptive(df).collect()}
    assert len(got) == len(rows) and all(v == (want[k] if k[1] >= 47 else None) for k, v in got.items())
    breaks = {(r.series_id, r.t) for r in spark.read.parquet(str(tmp_path / "breaks")).where("changepoint = 1").collect()}
    assert breaks == {(r.series_id, r.t) for r in series.cusum(df).where("changepoint = 1 and t >= 23 and series_id != 'c'").collect()} and breaks


@pytest.mark.parametrize("field, cell", [
    ("client_id", "Identif. National -B35T"), ("periode", "Période"), ("ressources", "Ressource"), ("business_line", "BUSINESS"), ("seg2", "Segmentation niveau 2"),
    ("seg_commercial", "Segmentation commerciale"), ("type_compte", "CODE TYPE COMPTE"), ("rubrique", "Rubriques"), ("date_ouverture", "Ouverture"), ("ctrvl_kda", "ctrvl"),
    ("solde", "SOLDE REPORTING"), ("currency", "Devise"),
])
def test_each_header_word(field, cell):
    assert dumps.resolve(["x", cell]) == {field: 1}


def test_short_headers_are_found():
    header = ["IDENTIF. NATIONAL", "PERIODE", "RESSOURCE", "BUSINESS", "SEGMENTATION COMMERCIALE", "OUVERTURE", "CTRVL", "DEVISE"]
    assert sorted(dumps.resolve(header).values()) == list(range(8))
