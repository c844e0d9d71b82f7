"""The four command-line stages on the E1 fixture written as CSV files."""

import pytest

from affinity.__main__ import main
from conftest import E1_ROWS


def write(path, header, rows):
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(str(x) for x in r) + "\n")


def test_cli_stages_round_trip(spark, scratch):
    data = f"{scratch}/data"
    import os

    os.makedirs(data)
    write(f"{data}/customers.csv", "customer_id,age", [(c, 30) for c in "ABCD"])
    write(f"{data}/articles.csv", "article_id,name", [("0101", "x"), ("0202", "y"), ("0303", "z")])
    write(
        f"{data}/transactions_train.csv",
        "t_dat,customer_id,article_id,price,till",
        [(t, c, a, p, 1) for _, t, c, a, p in E1_ROWS],
    )
    main(["lookups", "--data", data], spark)
    paths = main(["prepare", "--data", data, "--holdout-days", "7", "--strengths", "0:0,0.1:1"], spark)
    assert spark.read.parquet(paths["transactions"]).count() == 8
    out = main(["train", "--data", data, "--model-name", "mf", "--model-version", "v1",
                "--t-discount-strength", "0.1", "--price-discount-strength", "1.0",
                "--num-latent-features", "2", "--epochs", "2", "--learning-rate", "0.03",
                "--val-perc", "0.1"], spark)
    assert out["steps"] == 2
    res = main(["score", "--data", data, "--model-name", "mf", "--model-version", "v1",
                "--epoch-number", "1", "--evaluation-k", "2", "--sample-size", "10"], spark)
    sub = {r.customer_id: r.prediction for r in spark.read.option("header", True).csv(res["submission"]).collect()}
    # holdout customers: A (modelled) and C (new, fallback); A's recent 0101 purchase is kept eligible
    assert set(sub) == {"A", "C"}
    assert all(len(v.split(" ")) == 2 for v in sub.values())
    assert 0.0 <= res["map"] <= 1.0


def test_cli_scores_every_customer_in_submission_mode(spark, scratch):
    import os

    data = f"{scratch}/data"
    os.makedirs(data)
    write(f"{data}/customers.csv", "customer_id", [(c,) for c in "ABCD"])
    write(f"{data}/articles.csv", "article_id", [("0101",), ("0202",), ("0303",)])
    write(
        f"{data}/transactions_train.csv",
        "t_dat,customer_id,article_id,price,till",
        [(t, c, a, p, 1) for _, t, c, a, p in E1_ROWS],
    )
    main(["lookups", "--data", data], spark)
    main(["prepare", "--data", data, "--submission"], spark)
    main(["train", "--data", data, "--model-name", "mf", "--model-version", "s", "--train",
          "submission/train", "--num-latent-features", "2", "--epochs", "1", "--val-perc", "0.1"], spark)
    res = main(["score", "--data", data, "--model-name", "mf", "--model-version", "s", "--epoch-number", "0",
                "--holdout", "lookups/customer_ids",
                "--purchase-history", "submission/customer_days_since_last_purchase",
                "--purchase-cutoffs", "submission/days_between_purchase", "--evaluation-k", "3"], spark)
    assert "map" not in res
    sub = spark.read.option("header", True).csv(res["submission"])
    assert sorted(r.customer_id for r in sub.collect()) == ["A", "B", "C", "D"]


def test_cli_areas_logs_and_plain_tables(spark, scratch):
    """Training from a CSV table, scoring from CSV tables, dev and submission results side by side."""
    import os

    data = f"{scratch}/data"
    os.makedirs(f"{data}/dev")
    write(f"{data}/train.csv", "weight,article_int,customer_int", [(1.0, 0, 0), (2.0, 1, 0), (1.0, 1, 1)])
    write(f"{data}/dev/hold.csv", "article_int,customer_int,count", [(0, 1, 1)])
    write(f"{data}/everyone.csv", "customer_int", [(0,), (1,), (2,)])
    write(f"{data}/hist.csv", "customer_int,article_int,days_since_last_purchase", [(0, 0, 3)])
    write(f"{data}/cuts.csv", "article_int,p50", [(0, 5.0)])
    spark.createDataFrame([(c, i) for i, c in enumerate("ABC")], "customer_id string, customer_int long").write.parquet(
        f"{data}/lookups/customer_ids")
    spark.createDataFrame([("0101", 0), ("0202", 1)], "article_id string, article_int long").write.parquet(
        f"{data}/lookups/article_ids")
    name = ["--data", data, "--model-name", "mf", "--model-version", "v2"]
    main(["train", *name, "--train", "train.csv", "--num-latent-features", "1", "--epochs", "2",
          "--val-perc", "0.1", "--init-scale", "0.1", "--n-rows", "3", "--log-param-changes"], spark)
    changes = spark.read.parquet(f"{data}/training_logs/param_changes")
    assert {r.parameter for r in changes.collect()} == {
        "customer_factors", "customer_intercepts", "article_factors", "article_intercepts", "global_intercept"
    }
    from affinity.sources.writers import load_params

    params = load_params(spark, f"{data}/saved_models", "mf", "v2")
    assert (params["train_n_rows"], params["num_customers"], params["num_articles"]) == (3, 2, 2)
    tables = ["--purchase-history", "hist.csv", "--purchase-cutoffs", "cuts.csv", "--evaluation-k", "2"]
    dev = main(["score", *name, "--epoch-number", "1", "--holdout", "dev/hold.csv", *tables], spark)
    sub = main(["score", *name, "--epoch-number", "1", "--holdout", "everyone.csv", *tables], spark)
    assert "/dev/" in dev["submission"] and 0.0 <= dev["map"] <= 1.0
    assert "/submission/" in sub["submission"] and "map" not in sub
    assert spark.read.option("header", True).csv(dev["submission"]).count() == 1
    assert spark.read.option("header", True).csv(sub["submission"]).count() == 3


@pytest.mark.parametrize(
    "args",
    [["prepare", "--holdout-days", "-1"], ["prepare", "--price-discount-strength", "2"],
     ["prepare", "--t-discount-strength", "-0.1"], ["score", "--epoch-number", "-1"],
     ["train", "--val-perc", "0.5"], ["score", "--evaluation-k", "0"]],
)
def test_cli_ranges(args, capsys):
    with pytest.raises(SystemExit):
        main([args[0], "--data", "x", *args[1:]], None)
    assert "is not between" in capsys.readouterr().err
