import time
from pathlib import Path

from tillroll.__main__ import main
from tillroll.plans.run import run
from tillroll.plans.warehouse import Warehouse
from tillroll.sources.rejects import read_rejects
from tillroll.streaming.ingest import ingest_new_files

ROWS = [
    {"invoice_no": "I1", "customer_id": "C9"},
    {"invoice_no": "I2", "customer_id": "C8", "price": "0"},
    {"invoice_no": "I3", "customer_id": "C8", "invoice_date": "23/4/2022"},
    {"invoice_no": "I4", "customer_id": "C9", "shopping_mall": " Kanyon "},
]


def test_run_and_dry_run(spark, csv_file, json_file, tmp_path):
    csv = csv_file("in.csv", *ROWS)
    calendar = json_file("h.json", [{"date": "2022-04-23"}])
    root, rejects = str(tmp_path / "w"), str(tmp_path / "rejected")

    dry = run(spark, csv, calendar, root, rejects_root=rejects, dry_run=True)
    assert dry["status"] == "success" and dry["dry_run"], dry
    assert dry["counts"] == {
        "dim_time": 2, "dim_customer": 2, "dim_product": 1, "dim_store": 2, "dim_payment": 1,
    }
    assert dry["rejected_rows"] == 1
    assert set(dry["timing_seconds"]) == {"read", "validate", "transform_dimensions", "total"}
    assert not Warehouse(spark, root).exists("fact_sales")
    assert read_rejects(spark, f"{rejects}/load_id={dry['load_id']}").first().invoice_no == "I2"

    full = run(spark, csv, calendar, root, rejects_root=rejects)
    assert full["status"] == "success", full
    assert full["counts"] == {
        "dim_time": 2, "dim_customer": 2, "dim_product": 8, "dim_store": 10, "dim_payment": 3,
        "fact_sales": 3, "fact_daily_summary": 3,
    }
    assert set(full["timing_seconds"]) == {"read", "validate", "load", "verify", "total"}
    sales = Warehouse(spark, root).read("fact_sales").orderBy("sale_id").collect()
    assert [r.invoice_no for r in sales] == ["I1", "I3", "I4"]

    again = run(spark, csv, calendar, root, rejects_root=rejects)
    assert again["counts"] == full["counts"] and again["files"] == 0
    # Nothing of the work is left but what the tables need.
    data = {p.name.split("-")[0] for p in (tmp_path / "w" / "data").iterdir()}
    assert not data & {"staged", "customers", "new", "summary", "touched", "days"}

    # A glob that gains a file loads that file only.
    csv_file("more.csv", ROWS[0])
    more = run(spark, str(tmp_path / "*.csv"), calendar, root, rejects_root=rejects)
    assert (more["files"], more["counts"]["fact_sales"]) == (1, 4)
    assert more["counts"]["dim_customer"] == 2

    # An explicit id replaces what it had loaded.
    for _ in range(2):
        named = run(spark, csv_file("named.csv", ROWS[0]), calendar, root, load_id="mine")
        assert named["counts"]["fact_sales"] == 5


def test_failures_are_reported(spark, csv_file, json_file, tmp_path):
    calendar = json_file("h.json", [])
    csv = csv_file("short.csv", {}, header=["a", "b"])
    wrong = run(spark, csv, calendar, str(tmp_path / "w"))
    assert (wrong["status"], wrong["failed_step"]) == ("failed", "validate")
    assert "schema_errors" in wrong["error"]
    csv_file("good.csv", ROWS[0])
    mixed = run(spark, str(tmp_path / "*.csv"), calendar, str(tmp_path / "w"))
    assert mixed["status"] == "success" and mixed["counts"]["fact_sales"] == 1
    assert [p[-9:] for p in mixed["rejected_files"]] == ["short.csv"]
    missing = run(spark, str(tmp_path / "none.csv"), calendar, str(tmp_path / "w"))
    assert (missing["status"], missing["failed_step"]) == ("failed", "read")
    bad = run(spark, csv_file("in.csv", {}), calendar, str(tmp_path / "w"), source="ftp")
    assert bad["failed_step"] == "read" and "source must be" in bad["error"]


def test_stream_takes_each_file_once(spark, warehouse, csv_file, holidays, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    csv_file("landing/a.csv", ROWS[0], ROWS[1])
    (tmp_path / "landing" / "notes.txt").write_text("not a delivery")
    ingest_new_files(warehouse, landing, holidays, checkpoint)
    assert warehouse.read("fact_sales").count() == 1
    ingest_new_files(warehouse, landing, holidays, checkpoint)
    assert warehouse.read("fact_sales").count() == 1
    csv_file("landing/later/b.csv", ROWS[2])
    csv_file("landing/c.csv", ROWS[3], {"customer_id": "C9", "invoice_date": "6/3/2022"})
    ingest_new_files(warehouse, landing, holidays, checkpoint, max_files=1)
    assert warehouse.read("fact_sales").count() == 4
    people = {r.customer_id: r for r in warehouse.read("dim_customer").collect()}
    assert people["C9"].total_transactions == 3
    assert str(people["C9"].first_purchase_date) == "2022-03-06"
    folders = list((tmp_path / "warehouse" / "rejected").glob("load_id=stream-*-0000000000"))
    rejected = read_rejects(spark, str(folders[0]))
    assert [r.invoice_no for r in rejected.collect()] == ["I2"]


def test_two_streams_under_one_name(spark, warehouse, csv_file, holidays, tmp_path):
    csv_file("one/a.csv", ROWS[0], ROWS[2])
    csv_file("two/b.csv", ROWS[3])
    for folder in ("one", "two", "one"):
        ingest_new_files(warehouse, str(tmp_path / folder), holidays, str(tmp_path / f"c-{folder}"))
    assert warehouse.read("fact_sales").count() == 3
    # A checkpoint that starts anew finds its files loaded.
    ingest_new_files(warehouse, str(tmp_path / "one"), holidays, str(tmp_path / "c-new"))
    assert warehouse.read("fact_sales").count() == 3


def test_a_bad_file_is_set_aside_alone(spark, warehouse, csv_file, holidays, tmp_path):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    csv_file("in/a.csv", ROWS[0])
    csv_file("in/bad.csv", {}, header=["a", "b"])
    ingest_new_files(warehouse, landing, holidays, checkpoint)
    assert warehouse.read("fact_sales").count() == 1
    csv_file("in/c.csv", ROWS[2])
    ingest_new_files(warehouse, landing, holidays, checkpoint)
    assert warehouse.read("fact_sales").count() == 2
    wrong = spark.read.json(str(tmp_path / "warehouse" / "rejected" / "wrong_files" / "*"))
    assert [r.path[-7:] for r in wrong.collect()] == ["bad.csv"]


def test_a_bad_file_does_not_move_the_other_rows(
    spark, warehouse, csv_file, json_file, holidays, tmp_path, monkeypatch
):
    """The rows are staged once; beside them only the bad file's name is written."""
    for folder in ("in", "in2"):
        csv_file(f"{folder}/a.csv", ROWS[0], ROWS[2])
        csv_file(f"{folder}/bad.csv", ROWS[3], header=["a"] * 10)
    writer = type(spark.range(1).write)
    parquet, written = writer.parquet, []

    def write(self, path, *rest, **named):
        parquet(self, path, *rest, **named)
        label = path.rsplit("/", 1)[1].rsplit("-", 1)[0]
        if label in ("staged", "left-out"):
            written.append((label, spark.read.parquet(path).count()))

    monkeypatch.setattr(writer, "parquet", write)
    ingest_new_files(warehouse, str(tmp_path / "in"), holidays, str(tmp_path / "c"))
    # Five lines with the headers.
    assert written == [("staged", 5), ("left-out", 1)]
    assert warehouse.read("fact_sales").count() == 2
    written.clear()
    calendar, root = json_file("h.json", []), str(tmp_path / "w")
    summary = run(spark, str(tmp_path / "in2" / "*.csv"), calendar, root)
    assert summary["status"] == "success" and summary["counts"]["fact_sales"] == 2
    assert written == [("staged", 5), ("left-out", 1)]


def test_a_stream_leaves_no_shuffle_files(spark, warehouse, csv_file, holidays, tmp_path):
    """What its jobs shuffled goes with them, not when the driver collects its garbage."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    folders = [Path(str(folder)) for folder in folders]

    def kept():
        return {file.name for folder in folders for file in folder.rglob("shuffle_*.data")}

    csv_file("in/a.csv", *ROWS)
    csv_file("in/bad.csv", {}, header=["a", "b"])
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(setting, "false"), kept()
    ingest_new_files(warehouse, str(tmp_path / "in"), holidays, str(tmp_path / "c"))
    assert spark.conf.get(setting, "false") == before
    # Executors are told to delete them, and do so a moment later.
    for _ in range(50):
        if kept() <= files:
            break
        time.sleep(0.1)
    assert kept() <= files
    assert warehouse.read("fact_sales").count() == 3


def test_command_line(spark, csv_file, json_file, tmp_path, capsys):
    root = str(tmp_path / "w")
    assert main(["tables", "check", "--warehouse", root]) == 1
    assert main(["tables", "create", "--warehouse", root, "--empty"]) == 0
    assert Warehouse(spark, root).read("dim_store").count() == 0
    assert main(["tables", "seed", "--warehouse", root]) == 0
    assert main(["tables", "check", "--warehouse", root]) == 0
    given = ["run", "--csv", csv_file("in.csv", *ROWS), "--warehouse", root, "--holidays"]
    assert main([*given, json_file("h.json", [])]) == 0
    assert '"fact_sales": 3' in capsys.readouterr().out
    assert main([*given, str(tmp_path / "none.json")]) == 1
    assert main(["tables", "drop", "--warehouse", root]) == 0
    assert not Warehouse(spark, root).exists("fact_sales")
