"""Raw file reader: header dropped, file line numbers across many splits."""

from cirrus.plans.normalize import normalize
from cirrus.sources.raw import first_records, read_raw, supported_raw_line


def _write(tmp_path, year, station, n):
    d = tmp_path / "data" / year
    d.mkdir(parents=True, exist_ok=True)
    lines = ['"STATION","DATE","SOURCE"']
    for i in range(n):
        lines.append(f'"{station}","1901-01-01T{i % 24:02d}:00:00","4","60.0","25.0","5.0","N, X","FM-12","99999","V020",'
                     f'"270,1,N,{i:04d},1","99999,9,9,N","010000,1,N,9","+{i % 300:04d},1","+0000,1","10100,1","extra"')
    (d / f"{station}.csv").write_text("\n".join(lines) + "\n")


def test_line_numbers_across_splits(spark, tmp_path):
    _write(tmp_path, "1901", "A", 300)
    _write(tmp_path, "1901", "B", 5)
    _write(tmp_path, "1902", "A", 7)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")  # many splits per file
    try:
        raw = read_raw(spark, str(tmp_path / "data"))
        rows = raw.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by_file = {}
    for r in rows:
        by_file.setdefault(r.source_file.split("data/")[1], []).append(r)
    assert sorted(by_file) == ["1901/A.csv", "1901/B.csv", "1902/A.csv"]
    a = sorted(by_file["1901/A.csv"], key=lambda r: r.row_number)
    assert [r.row_number for r in a] == list(range(2, 302))
    for r in a:  # line n holds reading n-2
        assert f",{r.row_number - 2:04d},1" in r.raw_line
    assert len(by_file["1901/B.csv"]) == 5
    one_year = read_raw(spark, str(tmp_path / "data"), year="1902").count()
    assert one_year == 7
    assert read_raw(spark, str(tmp_path / "data"), year="1901", station="B").count() == 5
    assert first_records(raw, 10).count() == 10


def test_supported_line_drops_surplus_columns(spark, tmp_path):
    _write(tmp_path, "1901", "C", 3)
    raw = supported_raw_line(read_raw(spark, str(tmp_path / "data")))
    line = raw.collect()[0].raw_line
    assert "extra" not in line
    readings, dead = normalize(raw)
    assert dead.count() == 0
    r = readings.orderBy("row_number").collect()
    assert [x.row_number for x in r] == [2, 3, 4]
    assert r[0].name == "N, X" and len(r[0].columns) == 16


def test_line_numbers_with_small_arrow_batches(spark, tmp_path):
    _write(tmp_path, "1901", "A", 50)
    _write(tmp_path, "1901", "B", 3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # splits continue across batches
    try:
        rows = read_raw(spark, str(tmp_path / "data")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    a = sorted(r.row_number for r in rows if r.source_file.endswith("A.csv"))
    assert a == list(range(2, 52))
    assert sorted(r.row_number for r in rows if r.source_file.endswith("B.csv")) == [2, 3, 4]
    for r in rows:
        if r.source_file.endswith("A.csv"):
            assert f",{r.row_number - 2:04d},1" in r.raw_line


def test_missing_year_or_station_reads_as_empty(spark, tmp_path):
    _write(tmp_path, "1901", "A", 3)
    assert read_raw(spark, str(tmp_path / "data"), year="1999").count() == 0
    assert read_raw(spark, str(tmp_path / "data"), year="1901", station="NOPE").count() == 0
    assert read_raw(spark, str(tmp_path / "data"), year="1901", station="A").count() == 3
