from __future__ import annotations

import gzip

import pytest
from pyspark.sql import DataFrameWriter

from clickloom import schemas
from clickloom.plans import lake
from clickloom.sources import raw_csv
from clickloom.sources import tables as sources
from clickloom.workload import adapter

HEADER = ",".join(schemas.RAW.names)
LINE = "2019-{m}-01 10:00:00 UTC,view,p{m},c1,u1,s1,,,1.5"


def write(folder, name, month="10", header=HEADER, line=LINE, lines=1):
    body = "\n".join([header] + [line.format(m=month)] * lines) + "\n"
    path = folder / name
    if name.endswith(".gz"):
        path.write_bytes(gzip.compress(body.encode()))
    else:
        path.write_text(body)
    return str(path)


@pytest.fixture
def months(tmp_path):
    write(tmp_path, "2019-Oct.csv", "10")
    write(tmp_path, "2019-Nov-part.csv.gz", "11")
    write(tmp_path, "2019-Dec.csv", "12")
    write(tmp_path, "2020-Jan.csv", "01")
    write(tmp_path, "notes.csv")
    write(tmp_path, "2019-Foo.csv")
    return str(tmp_path)


def names(frame):
    return [r["name"] for r in frame.collect()]


def test_profiles_and_windows(spark, months):
    assert names(raw_csv.select_files(spark, months)) == ["2019-Oct.csv"]
    assert names(raw_csv.select_files(spark, months, "replay")) == ["2019-Nov-part.csv.gz"]
    assert len(names(raw_csv.select_files(spark, months, "all"))) == 4
    window = raw_csv.select_files(spark, months, start="2019-11", end="2020-01")
    assert names(window) == ["2019-Nov-part.csv.gz", "2019-Dec.csv", "2020-Jan.csv"]


@pytest.mark.parametrize(
    "asked",
    [
        dict(start="2019-10"),
        dict(start="2020-01", end="2019-10"),
        dict(start="2019-13", end="2019-13"),
        dict(start="soon", end="later"),
        dict(profile="weekly"),
    ],
)
def test_bad_windows(asked):
    with pytest.raises(ValueError):
        raw_csv.window_bounds(**asked)


def test_no_file_or_no_folder(spark, months, tmp_path):
    with pytest.raises(FileNotFoundError):
        raw_csv.read_window(spark, months, start="2021-01", end="2021-02")
    with pytest.raises(FileNotFoundError):
        raw_csv.read_window(spark, str(tmp_path / "absent"))


def test_training_must_not_read_the_replay_source(spark, months):
    replay = f"{months}/2019-Nov-part.csv.gz"
    for folder in (months, replay, f"{months}/below"):
        with pytest.raises(ValueError):
            raw_csv.forbid_replay_source(folder, replay)
    raw_csv.forbid_replay_source("/elsewhere", replay)


def test_typed_scan_of_plain_and_gzip(spark, months):
    frame = raw_csv.read_window(spark, months, "all")
    assert frame.schema == schemas.RAW
    rows = frame.collect()
    assert len(rows) == 4 and {r["price"] for r in rows} == {1.5}
    assert {r["brand"] for r in rows} == {None}


def test_columns_are_found_by_name(spark, tmp_path):
    order = list(reversed(schemas.RAW.names))
    line = ",".join(reversed((LINE + "").split(",")))
    write(tmp_path, "2019-Oct.csv")
    write(tmp_path, "2019-Oct-b.csv", header=",".join(order + ["extra"]), line=line + ",9")
    rows = raw_csv.read_window(spark, str(tmp_path), "all").collect()
    assert {r["product_id"] for r in rows} == {"p10"} and len(rows) == 2
    paths = [str(tmp_path / n) for n in ("2019-Oct.csv", "2019-Oct-b.csv")]
    audit = {r["file"]: r for r in raw_csv.audit_headers(spark, paths).collect()}
    assert audit["2019-Oct.csv"]["in_order"] and audit["2019-Oct.csv"]["complete"]
    assert not audit["2019-Oct-b.csv"]["in_order"]
    assert audit["2019-Oct-b.csv"]["extra"] == ["extra"]


def test_missing_column_and_bad_price_fail(spark, tmp_path):
    write(tmp_path, "2019-Oct.csv", header="event_time,event_type", line="a,b")
    with pytest.raises(ValueError, match="missing: product_id"):
        raw_csv.read_window(spark, str(tmp_path))
    write(tmp_path, "2019-Oct.csv", line=LINE.replace("1.5", "cheap"))
    with pytest.raises(Exception):
        raw_csv.read_window(spark, str(tmp_path)).collect()


def test_first_rows_follow_the_file(spark, tmp_path):
    lines = [LINE.format(m="10").replace("p10", f"p{i}") for i in range(50)]
    (tmp_path / "2019-Nov.csv").write_text("\n".join([HEADER, *lines]))
    head = raw_csv.first_rows(spark, str(tmp_path / "2019-Nov.csv"), 7).collect()
    assert [r["product_id"] for r in head] == [f"p{i}" for i in range(7)]


def test_bronze_without_order_columns_uses_its_stored_order(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    line = "2019-10-01 10:00:00 UTC,view,p1,c1,u1,s1,,{brand},1.5"
    lines = [line.format(brand=brand) for brand in ("early", "late", "last")]
    (raw / "2019-Oct.csv").write_text("\n".join([HEADER, *lines]))
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    lake.ingest(spark, str(raw), bronze, keep_order=False)
    assert sources.read_table(spark, bronze).columns == schemas.BRONZE.names
    lake.refine(spark, bronze, silver)
    assert [r["brand"] for r in sources.read_table(spark, silver).collect()] == ["early"]


def test_raw_to_silver_keeps_the_first_copy(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    line = "2019-10-01 10:00:00 UTC,view,p1,c1,u1,s1,,{brand},1.5"
    for name, brand in (("2019-Oct-a.csv", "early"), ("2019-Oct-b.csv", "late")):
        (raw / name).write_text(f"{HEADER}\n{line.format(brand=brand)}\n")
    (raw / "2019-Oct-c.csv").write_text(
        f"{HEADER}\n{line.format(brand='x').replace('view', 'click')}\n"
        f"{line.format(brand='x').replace('1.5', '-1')}\n"
    )
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    counts = lake.ingest(spark, str(raw), bronze)
    assert counts == {"input_rows": 4, "rejected_rows": 1, "output_rows": 3}
    assert lake.refine(spark, bronze, silver) == {
        "input_rows": 3, "rejected_rows": 1, "duplicate_rows": 1, "output_rows": 1,
    }
    table = sources.read_table(spark, silver)
    assert table.columns == schemas.SILVER.names
    assert table.first()["brand"] == "early"
    with pytest.raises(FileExistsError):
        lake.refine(spark, bronze, silver)
    with pytest.raises(FileNotFoundError):
        sources.read_table(spark, str(tmp_path / "absent"))


def _jobs(spark, action):
    """What ``action`` gives and how many jobs it ran."""
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    try:
        out = action()
    finally:
        jobs = len(context.statusTracker().getJobIdsForGroup("counted"))
        context.setLocalProperty("spark.jobGroup.id", None)
    return out, jobs


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    names = ["event_time", "event_type", "product_id", "price"]
    paths = []
    for i in range(8):
        path = tmp_path / f"2019-oct-{i} x.csv{'.gz' if i == 7 else ''}"
        head = ",".join(names[i % 2 :]) if i != 3 else '"event, time",event_type'
        text = ("\n" if i == 5 else "") + head + "\n" + "1,2,3,4\n" * (200_000 if i == 6 else 3)
        if i == 7:
            path.write_bytes(gzip.compress(text.encode()))
        else:
            path.write_text(text if i != 4 else "")
        paths.append(str(path))
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        found, jobs = _jobs(spark, lambda: raw_csv.header_columns(spark, paths))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost
    want = {p: names[i % 2 :] for i, p in enumerate(paths)}
    want |= {paths[3]: ["event, time", "event_type"], paths[4]: []}
    assert found == want and jobs == 1


@pytest.mark.parametrize("most", [0, 1000])
def test_first_rows_of_many_splits(spark, tmp_path, most):
    path = tmp_path / "2019-oct.csv"
    names = list(schemas.RAW.names)
    lines = [",".join("1.5" if n == "price" else f"{n}{i}" for n in names) for i in range(3000)]
    path.write_text("\n".join([",".join(names), *lines]) + "\n")
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        for n in (0, 1, 700):
            rows = raw_csv.first_rows(spark, str(path), n, most)
            assert [r["user_id"] for r in rows.collect()] == [f"user_id{i}" for i in range(n)]
            plan = rows._jdf.queryExecution().toString()
            assert ("Sort" in plan or "TakeOrdered" in plan) == (n > most)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)


def test_monthly_files_in_pieces_hold_all_rows_in_order(spark):
    sf_dir = "/root/testdata/sf0.001"
    raw = adapter.raw(spark, sf_dir).collect()
    folder = adapter.monthly_csv(spark, sf_dir, rows_per_piece=7)
    paths = [r["path"] for r in raw_csv.select_files(spark, folder, "all").collect()]
    assert len(paths) == adapter.CSV_FILES and len(raw) // 7 > len(paths)
    for number, path in enumerate(paths):
        own = [r for r in raw if r["input_order"] % adapter.CSV_FILES == number]
        own.sort(key=lambda r: r["input_order"])
        found = raw_csv.first_rows(spark, path, len(own) + 1).collect()
        assert [tuple(r) for r in found] == [tuple(r)[:-1] for r in own]


def test_no_task_sorts_a_whole_monthly_file(spark, monkeypatch):
    """The tasks that write grow in number with the rows, their share does not."""
    seen = []
    written = DataFrameWriter.csv

    def count(writer, path, **options):
        seen.append(writer._df.rdd.glom().map(len).collect())
        return written(writer, path, **options)

    monkeypatch.setattr(DataFrameWriter, "csv", count)
    adapter.monthly_csv(spark, "/root/testdata/sf0.001", rows_per_piece=20)
    assert len(seen[0]) > adapter.CSV_FILES and max(seen[0]) <= 40
