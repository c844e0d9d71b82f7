"""Epochs as one job each (``epoch_tasks``): what the steps one by one give, by several tasks."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import epoch_tasks as T
from affinity.operators import factors as M
from affinity.session import checkpoint_dir

FIT = dict(k=3, l2=0.05, lr=0.03, epochs=2, batch_share=1 / 5, validation_share=0.1, seed=5, init_scale=0.3)


@pytest.fixture(scope="module")
def pairs(spark):
    """Sparse ids and a customer in nearly all batches; pairs without weight, without one id, without both."""
    rows = [(c, a, float(1 + (c + a) % 3)) for c in range(1, 60) for a in range(40) if (7 * c + 3 * a) % 17 == 0]
    rows += [(0, a, 2.0) for a in range(40)] + [(-5, 10**12, 1.5), (3, 900, 0.0), (61, 901, None)]
    rows += [(None, 0, 1.0), (None, 777, 2.0), (4, None, 1.0), (500, None, 3.0), (None, None, 1.0)]
    return spark.createDataFrame(rows, "customer_int long, article_int long, weight double").repartition(3).persist()


def values(model):
    table = M.to_params(model)
    return {(r.side, r.id): [v for n, v in sorted(r.asDict().items()) if n not in ("side", "id")] for r in table.collect()}


def step_by_step(monkeypatch, pairs, **options):
    with monkeypatch.context() as m:
        m.setattr(T, "tasks_for", lambda *_: 0)
        return M.fit_log_link_factors(pairs, **{**FIT, **options})


def same(a, b):
    found, want = values(a), values(b)
    assert found.keys() == want.keys()
    assert all(found[key] == pytest.approx(want[key], abs=1e-10) for key in want)
    assert (a.step, a.intercept) == (b.step, pytest.approx(b.intercept, abs=1e-11))
    assert np.allclose(a.history, b.history, rtol=1e-10)


@pytest.mark.parametrize("max_exponent", [None, 0.5])
def test_an_epoch_of_one_job_gives_what_its_steps_give(monkeypatch, pairs, max_exponent):
    whole = step_by_step(monkeypatch, pairs, max_exponent=max_exponent)
    monkeypatch.setattr(M, "logged_step", lambda *_: (_ for _ in ()).throw(AssertionError("a step is a job")))
    for per_task in (10, 1000):  # several tasks, and one
        monkeypatch.setattr(T, "PAIRS_PER_TASK", per_task)
        same(M.fit_log_link_factors(pairs, max_exponent=max_exponent, **FIT), whole)


def test_the_jobs_of_a_fit_do_not_grow_with_its_steps(spark, pairs):
    context = spark.sparkContext
    jobs = {}
    for n in (12, 60):
        context.setJobGroup(f"fit-{n}", "")
        M.fit_log_link_factors(pairs, **{**FIT, "epochs": 1, "batch_share": 1 / n})
        jobs[n] = len(context.statusTracker().getJobIdsForGroup(f"fit-{n}"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[60] <= jobs[12] + 2


def test_batches_without_pairs_move_nothing_but_the_momentum(monkeypatch, spark):
    few = spark.createDataFrame([(1, 1, 2.0), (2, 1, 1.0), (2, 2, 3.0)], "customer_int int, article_int int, weight double")
    options = {"batch_share": 1 / 9, "validation_share": 0.0, "epochs": 1}
    monkeypatch.setattr(T, "PAIRS_PER_TASK", 0.1)
    found = M.fit_log_link_factors(few, **{**FIT, **options})
    assert found.customers.schema["id"].dataType.simpleString() == "int"
    want = step_by_step(monkeypatch, few, **options)
    assert found.step == want.step == 9
    found.history, want.history = [h[:2] for h in found.history], [h[:2] for h in want.history]
    same(found, want)


def test_logs_of_batches_come_without_their_models(monkeypatch, pairs):
    logs = {True: [], False: []}
    for models, log in logs.items():
        def on_batch(epoch, batch, found, model, log=log):
            log.append((epoch, batch, found, model is None))
        M.fit_log_link_factors(pairs, on_batch=on_batch, batch_models=models, **{**FIT, "epochs": 1, "batch_share": 1 / 9})
    assert [x[:2] for x in logs[False]] == [x[:2] for x in logs[True]] == [(0, b) for b in range(9)]
    assert all(x[3] for x in logs[False]) and not any(x[3] for x in logs[True])
    for one, other in zip(logs[False], logs[True]):
        assert one[2] == pytest.approx(other[2], rel=1e-10)


def test_a_diverging_epoch_is_an_error(pairs):
    with pytest.raises(FloatingPointError, match="diverged in step 1:"):
        M.fit_log_link_factors(pairs, **{**FIT, "init_scale": 40.0})


def test_an_epoch_leaves_only_its_rows(spark, pairs):
    base = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    model = M.fit_log_link_factors(pairs, **FIT)
    new = [f for f in set(os.listdir(base)) - before if f.startswith("affinity-fit")]
    assert len(new) == 1 and os.listdir(f"{base}/{new[0]}") == ["final"]
    assert model.customers.where(F.col("f0").isNull()).count() == 0


def test_large_batches_and_tables_stay_with_jobs(spark):
    assert T.tasks_for(spark, 100, 10_000, 10_000) == 1
    slots = T.tasks_for(spark, 100, T.MOST_PAIRS, 10_000)
    assert 1 <= slots <= (os.cpu_count() or 1)
    assert T.tasks_for(spark, 100, T.MOST_PAIRS * (os.cpu_count() + 1), 10_000) == 0
    assert T.tasks_for(spark, 100, 10_000, T.MOST_ROWS * (os.cpu_count() + 1)) == 0
    assert T.tasks_for(spark, T.FEW_STEPS, 10_000, 10_000) == 0


def test_rows_that_missed_steps_are_replayed_as_dense_steps():
    options = {"beta1": 0.9, "beta2": 0.999, "lr": 0.1, "eps": 1e-8, "terms": 395}
    rng = np.random.default_rng(1)

    def rows():
        r = T.Rows(None, 2, 0, options)
        r.ids, r.last = np.arange(6), np.zeros(6, np.int64)
        r.p, r.m, r.v = (np.random.default_rng(2).normal(size=(6, 2)), np.zeros((6, 2)), np.zeros((6, 2)))
        return r

    lazy, dense = rows(), rows()
    for step in range(1, 40):
        at = np.flatnonzero(rng.random(6) < 0.2)
        grad = rng.normal(size=(len(at), 2))
        lazy.catch_up(at, step - 1)
        lazy.adam(at, grad, step)
        full = np.zeros((6, 2))
        full[at] = grad
        dense.adam(np.arange(6), full, step)
    lazy.catch_up(np.arange(6), 39)
    for one, other in zip((lazy.p, lazy.m, lazy.v), (dense.p, dense.m, dense.v)):
        assert np.allclose(one, other, rtol=1e-12, atol=1e-14)
