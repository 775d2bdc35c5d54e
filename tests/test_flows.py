"""Flows on small files in the original formats."""

import json

import numpy as np
import pandas as pd
import pytest

from millrace.plans import flows


def test_stock(spark, tmp_path):
    draw = np.random.default_rng(0)
    days = pd.bdate_range("2019-01-01", "2020-06-30")
    volume = 1e6 + np.cumsum(draw.normal(0, 2e4, len(days)))
    pd.DataFrame({"Date": days.strftime("%Y-%m-%d"), "Open": 1.0, "Volume": volume}).to_csv(tmp_path / "spy.csv", index=False)
    got = flows.stock(spark, str(tmp_path / "spy.csv"), str(tmp_path / "out"), "20190301", ["linear", "svm"])
    features = got["features"].toPandas()
    assert features["yyyymm"].min() == "201903" and len(features) == (days >= "2019-03-01").sum()
    held_out = {r["kind"]: r["r2"] for r in got["held_out"].collect()}
    assert held_out["linear"] > 0.5
    assert got["scores"].groupBy("kind").count().collect()[0]["count"] == features["yyyymm"].nunique()


@pytest.fixture(scope="module")
def churn_files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("churn")
    draw = np.random.default_rng(1)
    n = 300
    age = draw.integers(20, 70, n)
    customers = pd.DataFrame(
        {
            "RowNumber": range(n), "CustomerId": range(1000, 1000 + n), "Surname": "x",
            "CreditScore": draw.integers(400, 850, n), "Geography": draw.choice(["France", "Spain"], n),
            "Gender": draw.choice(["Female", "Male"], n), "Age": age, "Tenure": draw.integers(0, 10, n),
            "Balance": draw.uniform(0, 1e5, n), "NumOfProducts": draw.integers(1, 4, n), "HasCrCard": draw.integers(0, 2, n),
            "IsActiveMember": draw.integers(0, 2, n), "EstimatedSalary": draw.uniform(1e4, 1e5, n),
            "Exited": (age + draw.normal(0, 5, n) > 50).astype(int),
        }
    )
    customers.to_csv(folder / "customers.csv", index=False)
    pd.DataFrame(
        {"TransactionId": range(5, 905), "CustomerId": draw.integers(1000, 1250, 900), "Amount": draw.normal(0, 200, 900)}
    ).to_csv(folder / "transactions.csv", index=False)
    return folder, customers


def test_churn(spark, churn_files, tmp_path):
    folder, customers = churn_files
    got = flows.churn(
        spark, str(folder / "customers.csv"), str(folder / "transactions.csv"), str(tmp_path), ["logistic"], draws=2
    )
    joined = spark.read.parquet(f"{tmp_path}/joined")
    assert joined.count() == 900 and "Amount" in joined.columns
    features = got["features"].toPandas()
    assert features["CustomerId"].max() < 1250 and features["Gender_Male"].isin([-1, 1]).all()
    assert features["Balance"].between(0, 1).all() and set(features["HasCrCard"]) == {-1, 1}
    assert got["area"].first()["auc"] > 0.85
    assert got["results"].count() == len(features) - int(0.8 * len(features))
    assert got["sweep"].count() == 101 and got["report"].where("label = 'accuracy'").first()["f1"] > 0.7


def test_weather(spark, tmp_path):
    records = [
        {"series_id": "STEO.ZWHD_PAC.M", "name": "Pacific", "data": [["202001", 2.0], ["201901", 4.005], ["202002", 1]]},
        {"series_id": "STEO.ZWCD_PAC.M", "name": "Pacific", "data": [["202007", 9.0]]},
        {"series_id": "STEO.OTHER.M", "name": "Other", "data": [["202007", 9.0]]},
        {"category_id": 7, "name": "no series"},
    ]
    (tmp_path / "steo.txt").write_text("\n".join(map(json.dumps, records)))
    got = {r["dataset"]: r for r in flows.weather(spark, str(tmp_path / "steo.txt")).collect()}
    assert set(got) == {"Heating Degree Days", "Cooling Degree Days"}
    heating = got["Heating Degree Days"]
    assert (heating["m1"], heating["m2"], heating["m3"]) == (3.0, 1.0, None)


def test_video_labels(spark, tmp_path):
    draw = np.random.default_rng(3)
    centres = draw.integers(40, 200, (8, 12))

    def frames(videos, seed):
        rng = np.random.default_rng(seed)
        rows = []
        for v in range(videos):
            labels = [int(l) for l in sorted(rng.choice(8, 2, replace=False))]
            for _ in range(rng.integers(3, 8)):
                x = np.clip(centres[labels].mean(axis=0) + rng.normal(0, 3, 12), 0, 255).astype(np.uint8)
                rows.append((f"v{v}", labels, bytes(x[:9]), bytes(x[9:])))
        return spark.createDataFrame(rows, "id string, labels array<int>, rgb binary, audio binary")

    frames(60, 1).write.parquet(str(tmp_path / "train"))
    frames(30, 2).write.parquet(str(tmp_path / "validate"))
    got = flows.video_labels(spark, str(tmp_path / "train"), str(tmp_path / "validate"), str(tmp_path / "out"))
    totals = got["totals"].orderBy("ridge").collect()
    assert [r["ridge"] for r in totals] == [0.0, 1.0, 10.0, 100.0, 500.0]
    for r in totals:
        assert r["true_positive"] + r["false_positive"] == 30 * 5
        assert r["true_positive"] + r["false_negative"] == 30 * 2
    assert totals[0]["true_positive"] >= 50


def test_single_cell(spark, tmp_path):
    draw = np.random.default_rng(4)
    kinds = np.repeat([0, 1, 2], 20)
    rates = np.full((3, 45), 1.0)
    for k in range(3):
        rates[k, k * 12 : k * 12 + 12] = 12.0
    table = draw.poisson(rates[kinds])
    folder = tmp_path / "matrix"
    folder.mkdir()
    names = [f"g{i}" for i in range(44)] + ["g0"]  # one symbol occurs twice
    (folder / "genes.tsv").write_text("".join(f"id{i}\t{n}\n" for i, n in enumerate(names)))
    (folder / "barcodes.tsv").write_text("".join(f"c{i:02d}\n" for i in range(60)))
    entries = [(g + 1, c + 1, table[c, g]) for c in range(60) for g in range(45) if table[c, g]]
    (folder / "matrix.mtx").write_text(
        f"%%MatrixMarket matrix coordinate integer general\n%\n45 60 {len(entries)}\n"
        + "".join(f"{g} {c} {v}\n" for g, c, v in entries)
    )
    got = flows.single_cell(
        spark, str(folder), str(tmp_path / "out"), min_genes=5, max_flagged_pct=50.0, near=8, components=5,
        max_mean=9.0, min_dispersion=-0.5,
    )
    clusters = got["clusters"].toPandas()
    clusters["kind"] = clusters["cell"].str[1:].astype(int).map(lambda i: kinds[i])
    assert (clusters.groupby("group")["kind"].nunique() == 1).all()
    assert got["modularity"].first()["modularity"] > 0.4
    genes = {r["gene"] for r in got["genes"].collect()}
    assert {"g0", "g0-1"} <= genes
    best = got["ranksum_markers"].where("rank = 1").toPandas().set_index("group")["gene"]
    for group, gene in best.items():
        kind = clusters[clusters["group"] == group]["kind"].iloc[0]
        assert int(gene[1:]) // 12 == kind
    assert got["t_markers"].count() == 25 * clusters["group"].nunique()
    assert got["logistic_markers"].count() > 0 and got["expression"].where("fraction > 1").count() == 0


def test_small_flows(spark, tmp_path):
    (tmp_path / "cities.csv").write_text("city,state,population\nA,NY,5\nB,CA,7\nC,NY,1\n")
    got = flows.cities(spark, str(tmp_path / "cities.csv"))
    assert got["total"].first()["total"] == 13
    assert [tuple(r) for r in got["by_state"].collect()] == [("CA", 7), ("NY", 6)]
    (tmp_path / "titles.csv").write_text('show,title,cast\n1,One,"Kate Mara, Don Cheadle"\n2,Two,\n3,Three,Don Cheadle\n')
    path = str(tmp_path / "titles.csv")
    found = flows.titles(spark, path, ["Kate Mara", "Don Cheadle"])
    assert sorted(map(tuple, found.collect())) == [("Don Cheadle", "One"), ("Don Cheadle", "Three"), ("Kate Mara", "One")]
    assert flows.title_record(spark, path, "Three")["show"] == "3"
    with pytest.raises(LookupError):
        flows.title_record(spark, path, "Four")
