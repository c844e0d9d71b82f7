"""End-to-end round trip: prepare (C7) -> train (M4 job) -> score (R6) at sf0.001."""

from pyspark.sql import functions as F

from affinity.plans.prepare_job import prepare_lookups, prepare_training_data
from affinity.plans.score_job import score_saved
from affinity.plans.train_job import train
from affinity.sources import starschema as X
from affinity.sources.writers import read_metrics, read_weighted_interactions
from conftest import SF_SMALL


def test_prepare_train_score_round_trip(spark, scratch):
    data = f"{scratch}/data"
    c_path, a_path = prepare_lookups(X.customers(spark, SF_SMALL), X.articles(spark, SF_SMALL), data)
    paths = prepare_training_data(
        spark, X.transactions(spark, SF_SMALL), spark.read.parquet(c_path), spark.read.parquet(a_path),
        data, holdout_days=365, t_discount_strength=0.001, price_discount_strength=1.0,
    )
    for key in ("prices", "days_between_purchase", "customer_days_since_last_purchase", "train",
                "train_new_users", "holdout", "holdout_new_users"):
        assert spark.read.parquet(paths[key]).count() >= 0
    tx = spark.read.parquet(paths["transactions"])
    assert tx.count() == X.transactions(spark, SF_SMALL).count()
    weights = read_weighted_interactions(spark, paths["train"], 0.001, 1.0)
    assert weights.where(F.col("weight") <= 0).count() == 0
    assert weights.groupBy("customer_int", "article_int").count().where("count > 1").count() == 0

    model = train(spark, weights, f"{scratch}/runs", "mf", "v1", num_latent_features=3,
                  learning_rate=0.03, batch_size=2000, epochs=2, validation_share=0.05, seed=1,
                  snapshot_every=1, log_param_changes=True)
    assert model.step >= 2
    epochs = read_metrics(spark, f"{scratch}/runs/training_logs", "epochs")
    assert epochs.where("model = 'mf' AND version = 'v1'").count() == 2
    batches = read_metrics(spark, f"{scratch}/runs/training_logs", "batches").count()
    assert batches == model.step

    result = score_saved(spark, data, f"{scratch}/runs/saved_models", "mf", "v1", 1,
                         f"{scratch}/predictions", k=12, sample_size=50)
    assert 0.0 <= result["map"] <= 1.0
    holdout_customers = spark.read.parquet(paths["holdout"]).select("customer_int").distinct().count()
    assert result["n_customers"] == holdout_customers
    sub = spark.read.option("header", True).csv(result["submission"])
    assert sub.count() == holdout_customers
    assert sub.where(F.size(F.split("prediction", " ")) != 12).count() == 0


def test_newest_date_comes_from_the_write(spark, scratch, monkeypatch):
    """The prepare job does not scan the purchases again for their newest date; with none there is no holdout."""
    from affinity.operators import prepare as P

    c_path, a_path = prepare_lookups(X.customers(spark, SF_SMALL), X.articles(spark, SF_SMALL), scratch)
    maps = spark.read.parquet(c_path), spark.read.parquet(a_path)
    tx = X.transactions(spark, SF_SMALL)
    newest = tx.agg(F.max("t_dat")).first()[0]
    with monkeypatch.context() as m:
        m.setattr(P, "max_date", lambda *_: (_ for _ in ()).throw(AssertionError("scanned again")))
        paths = prepare_training_data(spark, tx, *maps, f"{scratch}/a", holdout_days=30)
    held = spark.read.parquet(paths["transactions"]).where(F.col("t_dat") > F.date_sub(F.lit(newest), 30))
    counted = spark.read.parquet(paths["holdout"]).agg(F.sum("count")).first()[0]
    assert counted == held.count() > 0
    empty = prepare_training_data(spark, tx.limit(0), *maps, f"{scratch}/b", holdout_days=30)
    assert spark.read.parquet(empty["holdout"]).count() == 0


def test_weights_are_dealt_to_tasks_by_their_number(spark, scratch, monkeypatch):
    """A task of the weight variants holds a bounded number of rows, whatever the session's shuffle partitions."""
    from affinity.plans import prepare_job

    c_path, a_path = prepare_lookups(X.customers(spark, SF_SMALL), X.articles(spark, SF_SMALL), scratch)
    maps = spark.read.parquet(c_path), spark.read.parquet(a_path)
    tx, options = X.transactions(spark, SF_SMALL), {"holdout_days": 30, "strengths": [(0.0, 0.0), (0.001, 1.0)]}
    found = []
    for name, most in (("a", 10**9), ("b", 400)):
        monkeypatch.setattr(prepare_job, "WEIGHTS_PER_TASK", most)
        paths = prepare_training_data(spark, tx, *maps, f"{scratch}/{name}", **options)
        found.append(read_weighted_interactions(spark, paths["train"], 0.001, 1.0))
    files = found[1].groupBy(F.input_file_name()).count().collect()
    assert len(files) > 8 and max(r["count"] for r in files) <= 400
    key = ["customer_int", "article_int", F.round("weight", 9).alias("w")]
    plain, dealt = ({tuple(r) for r in w.select(*key).collect()} for w in found)
    assert plain == dealt and len(plain) == found[0].count() == found[1].count()
