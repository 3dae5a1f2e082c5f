import gzip

import pytest
from pyspark.errors import AnalysisException

from lagfield.operators import panel as P
from lagfield.plans.workflow import zero_filled_file
from lagfield.sources import io as IO

HEADER = "periodo\tcustomer_id\tproduct_id\tplan_precios_cuidados\tcust_request_qty\tcust_request_tn\ttn\n"
LINES = ["202001\t1\t10\t0\t3\t2.0\t2.0", "202003\t1\t10\t1\t1\t4.0\t3.5", "202002\t2\t20\t0\t1\t5.0\t5.0"]


@pytest.fixture
def sell_in(tmp_path):
    path = tmp_path / "sell-in.txt.gz"
    with gzip.open(path, "wt") as f:
        f.write(HEADER + "\n".join(LINES) + "\n")
    return str(path)


def test_read_sell_in(spark, sell_in):
    df = IO.read_sell_in(spark, sell_in)
    assert dict(df.dtypes)["tn"] == "double" and dict(df.dtypes)["periodo"] == "int"
    assert sorted(r.tn for r in df.collect()) == [2.0, 3.5, 5.0]


def test_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "p.txt").write_text("product_id\tsku_size\tcat1\tcat2\tcat3\tbrand\n1\t5\ta\tb\tc\td\n")
    row = IO.read_delimited(spark, str(tmp_path / "p.txt"), IO.PRODUCTS, "\t").first()
    assert (row.product_id, row.cat1, row.brand, row.sku_size) == (1, "a", "d", "5")


def test_sniffed_types(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2.5\n2,3.5\n")
    assert dict(IO.read_delimited(spark, str(tmp_path / "x.csv")).dtypes) == {"a": "int", "b": "double"}


def test_zero_filled_csv_round_trip(spark, sell_in, tmp_path):
    out = str(tmp_path / "filled")
    zero_filled_file(spark, sell_in, out, as_csv=True)
    assert next((tmp_path / "filled").glob("*.csv.gz"))
    back = IO.read_panel(spark, out)
    want = P.zero_fill(IO.read_sell_in(spark, sell_in))
    cols = [*P.GRAIN, "plan_flag", "request_tn", "tn"]
    assert sorted(map(tuple, back.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    lines = []
    for part in sorted((tmp_path / "filled").glob("part-*")):
        with gzip.open(part, "rt") as f:
            lines += [tuple(map(int, x.split(",")[:3])) for x in f.read().splitlines()[1:]]
    assert lines == sorted(lines)


def test_panel_table_is_split_by_month(spark, sell_in, tmp_path):
    out = str(tmp_path / "panel")
    zero_filled_file(spark, sell_in, out)
    assert {p.name for p in (tmp_path / "panel").glob("periodo=*")} == {"periodo=202001", "periodo=202002", "periodo=202003"}
    one = spark.read.parquet(out).where("periodo = 202002")
    assert "PartitionFilters: [isnotnull(periodo" in one._jdf.queryExecution().executedPlan().toString()
    # both products are alive and both customers have started
    assert one.count() == 4


def test_run_log_grows_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    IO.append_log(spark.createDataFrame([("a", 0.25)], "experimento string, wape double"), path)
    IO.append_log(spark.createDataFrame([("b", 0.20, "x")], "experimento string, wape double, top string"), path)
    got = {r.experimento: (r.wape, r.top) for r in IO.read_log(spark, path).collect()}
    assert got == {"a": (0.25, None), "b": (0.20, "x")}
    IO.append_log(spark.createDataFrame([("c", 1)], "experimento string, n int"), path)
    IO.append_log(spark.createDataFrame([("d", 2**40)], "experimento string, n bigint"), path)
    IO.append_log(spark.createDataFrame([("e", 1.5)], "experimento string, n double"), path)
    assert {r.experimento: r.n for r in IO.read_log(spark, path).collect()} == {"a": None, "b": None, "c": 1.0, "d": float(2**40), "e": 1.5}
    both = IO.combined_log(spark.createDataFrame([(1,)], "n int"), spark.createDataFrame([("z", 2)], "s string, n bigint"))
    assert both.count() == 2


def test_manifest(spark, tmp_path):
    payload = {"winner": "lags_raw", "anchors": [1, 2], "tn_total": 1.5}
    IO.write_manifest(spark, str(tmp_path / "m"), payload)
    assert IO.read_manifest(spark, str(tmp_path / "m")) == payload


def test_medoids_by_cut(spark, tmp_path):
    rows = [(201810, 1, [1.0, 2.0]), (201912, 1, [3.0])]
    IO.write_medoids(spark.createDataFrame(rows, "cut int, medoid_id int, seq array<double>"), str(tmp_path / "m"))
    assert [r.seq for r in IO.read_medoids(spark, str(tmp_path / "m"), 201912).collect()] == [[3.0]]
    again = spark.createDataFrame([(201912, 1, [4.0])], "cut int, medoid_id int, seq array<double>")
    IO.write_medoids(again, str(tmp_path / "m"))
    assert [r.seq for r in IO.read_medoids(spark, str(tmp_path / "m"), 201912).collect()] == [[4.0]]
    assert [r.seq for r in IO.read_medoids(spark, str(tmp_path / "m"), 201810).collect()] == [[1.0, 2.0]]


def test_finished_results(spark, tmp_path):
    path = str(tmp_path / "done")
    assert IO.finished(spark, path, IO.FORECAST).count() == 0
    spark.createDataFrame([(1, 2.0)], IO.FORECAST).write.parquet(path)
    assert IO.finished(spark, path, IO.FORECAST).count() == 1


def test_missing_segment_map_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        IO.read_segments(spark, str(tmp_path / "none.csv"), 201810)


def test_named_table(spark):
    IO.as_table(spark.range(3), "three")
    assert spark.sql("SELECT sum(id) AS s FROM three").first().s == 3
