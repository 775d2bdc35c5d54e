"""Files written here, read by the scans."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from millrace.sources import files, generators, matrix_market
from millrace.sources.storage import materialize, scratch_path, shared_root


def test_csv_keeps_missing_fields_and_nan(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('name,n,x\na,1,1.5\n"b, c",,NaN\n,3,\n')
    got = files.read_csv(spark, str(path), "name string, n int, x double").collect()
    assert got[0].asDict() == {"name": "a", "n": 1, "x": 1.5}
    assert got[1]["name"] == "b, c" and got[1]["n"] is None and got[1]["x"] != got[1]["x"]
    assert got[2]["name"] is None and got[2]["x"] is None


def test_cities_sum(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text("city,state,population\nA,NY,5\nB,CA,7\nC,NY,1\nD,,9\n")
    from millrace.operators.aggregates import grouped_total, total

    cities = files.read_csv(spark, str(path), "city string, state string, population bigint")
    assert total(cities, "population").first()["total"] == 22
    assert [tuple(r) for r in grouped_total(cities, "state", "population").collect()] == [("CA", 7), ("NY", 6)]


def test_json_lines_with_missing_keys_and_broken_lines(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    records = [
        {"series_id": "S1", "name": "n", "data": [["202001", 1.5], ["202002", None]]},
        {"name": "no id", "data": [["202001", 3]]},
    ]
    path.write_text("\n".join([*map(json.dumps, records), "{broken"]) + "\n")
    read = files.read_json_lines(spark, str(path), "series_id string, name string, data array<array<string>>").cache()
    assert read.where("_corrupt_record is not null").count() == 1
    got = files.series_pairs(read.where("_corrupt_record is null")).collect()
    assert [tuple(r) for r in got] == [("S1", "n", "202001", 1.5), ("S1", "n", "202002", None), (None, "no id", "202001", 3.0)]


def test_months_are_pruned_before_reading(spark):
    path = scratch_path(spark, "months")
    df = spark.range(100).select("id", F.when(F.col("id") < 40, "202001").otherwise("202002").alias("m"))
    files.write_by_month(df, path, "m")
    kept = files.read_months(spark, path, "id bigint, m string", "m", "202002")
    assert kept.count() == 60
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    assert [r["m"] for r in files.list_months(spark, path, "id bigint, m string", "m").collect()] == ["202001", "202002"]


def test_a_hot_month_is_cut_over_several_files(spark):
    path = scratch_path(spark, "hot")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), F.when(F.col("id") % 3 == 0, F.lit("a")).otherwise(F.lit("b")).alias("m"))
        files.write_by_month(df, path, "m")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    count = spark.read.parquet(path).where("m = 'b'").select("_metadata.file_path").distinct().count()
    assert count > 1


def test_labels_come_from_folders(spark, tmp_path):
    for label in ("yes", "no"):
        (tmp_path / label).mkdir()
        for i in range(3):
            (tmp_path / label / f"{i}.wav").write_bytes(bytes([i]) * (i + 1))
    (tmp_path / "README.md").write_text("no clip")
    got = files.read_labelled_binaries(spark, str(tmp_path), "*.wav")
    assert sorted((r["label"], r["length"], bytes(r["content"])) for r in got.collect())[0] == ("no", 1, b"\0")
    assert got.groupBy("label").count().count() == 2


def test_file_names(spark, tmp_path):
    (tmp_path / "202001.csv").write_text("v\n1\n")
    (tmp_path / "202002.csv").write_text("v\n2\n3\n")
    read = files.with_file_name(spark.read.schema("v int").option("header", True).csv(str(tmp_path)))
    assert sorted((r["file_name"], r["v"]) for r in read.collect()) == [("202001.csv", 1), ("202002.csv", 2), ("202002.csv", 3)]


def test_manifest(spark, tmp_path):
    path = tmp_path / "plan.json"
    path.write_text(json.dumps({"files": {"a.txt": "1" * 32, "b.txt": "2" * 32}}))
    assert sorted(map(tuple, files.read_manifest(spark, str(path)).collect())) == [("a.txt", "1" * 32), ("b.txt", "2" * 32)]


def test_matrix_text(spark, tmp_path):
    (tmp_path / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n%\n3 3 4\n1 1 5\n3 1 2\n2 2 1\n3 3 3\n")
    (tmp_path / "genes.tsv").write_text("id1\tMT-A\nid2\tB\nid3\tC\n")
    (tmp_path / "barcodes.tsv").write_text("AA-1\nCC-1\nBB-1\n")
    got = sorted(map(tuple, matrix_market.read_matrix(spark, str(tmp_path)).collect()))
    assert got == [("AA-1", "C", 2.0), ("AA-1", "MT-A", 5.0), ("BB-1", "C", 3.0), ("CC-1", "B", 1.0)]


def test_matrix_text_cut_into_many_splits(spark, tmp_path):
    barcodes = [f"cell{i:04d}" for i in range(2000)]
    (tmp_path / "matrix.mtx").write_text(
        "%%MatrixMarket matrix coordinate integer general\n%c\n1 2000 2000\n"
        + "".join(f"1 {i + 1} {i + 1}\n" for i in range(2000))
    )
    (tmp_path / "genes.tsv").write_text("g\n")
    (tmp_path / "barcodes.tsv").write_text("\n".join(barcodes) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got = matrix_market.read_matrix(spark, str(tmp_path)).toPandas()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 2000
    assert (got["cell"] == got["value"].astype(int).map(lambda v: barcodes[v - 1])).all()


def test_matrix_without_banner_is_refused(spark, tmp_path):
    for name in ("matrix.mtx", "genes.tsv", "barcodes.tsv"):
        (tmp_path / name).write_text("1 1 1\n")
    with pytest.raises(ValueError, match="banner"):
        matrix_market.read_matrix(spark, str(tmp_path))


def test_compressed_sizes(spark):
    df = spark.createDataFrame([(1, b"a" * 5000), (2, b""), (3, None)], "id int, p binary")
    got = {r["id"]: (r["in_bytes"], r["out_bytes"]) for r in files.compressed_sizes(df, "id", "p", workers=2).collect()}
    assert got[1] == (5000, len(gzip.compress(b"a" * 5000, 1, mtime=0))) and got[2][0] == 0 and 3 not in got


def test_gzip_files_per_worker(spark):
    lines = spark.range(1000).select(F.concat(F.lit("line "), "id").alias("value"))
    path = scratch_path(spark, "gz")
    sizes = files.write_gzip(lines, path, 3)
    assert sizes.count() == 3 and files.read_lines(spark, path).count() == 1000


def test_generated_transactions(spark):
    customers = spark.range(50, 450).withColumnRenamed("id", "CustomerId")
    made = generators.transactions(customers, "CustomerId").toPandas()
    assert sorted(made["TransactionId"]) == list(range(100_000, 100_000 + len(made)))
    per = made["CustomerId"].value_counts()
    assert len(per) == 400 and 3.0 < per.mean() < 4.1
    assert abs(made["Amount"].mean()) < 20 and 185 < made["Amount"].std() < 215
    again = generators.transactions(customers.repartition(7), "CustomerId").toPandas()
    assert made.sort_values("TransactionId")["Amount"].tolist() == again.sort_values("TransactionId")["Amount"].tolist()


def test_random_payloads_have_their_sizes(spark):
    got = generators.random_payloads(spark, [10, 2500], piece=1000)
    sizes = {r["payload"]: r["n"] for r in got.groupBy("payload").agg(F.sum(F.length("content")).alias("n")).collect()}
    assert sizes == {0: 10, 1: 2500}


def test_materialize_cuts_lineage_and_keeps_types(spark):
    df = spark.createDataFrame([(1, [1.5], {"a": 1})], "i int, v array<double>, m map<string,int>")
    kept = materialize(df)
    assert kept.dtypes == df.dtypes and kept.collect() == df.collect()
    assert "parquet" in kept._jdf.queryExecution().executedPlan().toString().lower()
    assert shared_root(spark) in kept.inputFiles()[0].replace("file://", "")


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())
