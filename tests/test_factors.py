"""E10, finite differences, fit properties, snapshot round trip."""

import math
import random

import pytest
from pyspark.sql import functions as F

from affinity.operators import factors as M
from affinity.sources.writers import load_model, save_model


def table(spark, rows, k):
    cols = ", ".join(f"f{i} double" for i in range(k))
    return spark.createDataFrame(rows, f"id long, {cols}, bias double")


def test_e10_one_gradient(spark):
    cu, ar = table(spark, [(0, 0.1, 0.0)], 1), table(spark, [(0, 0.2, 0.0)], 1)
    pairs = spark.createDataFrame([(0, 0, 1.0)], "customer_int long, article_int long, weight double")
    model = M.Model(M.with_moments(cu, 1), M.with_moments(ar, 1), 0.0, 1)
    cg, ag = M.gradients(pairs, model)
    c, a = cg.first(), ag.first()
    p = math.exp(0.02)
    assert p == pytest.approx(1.020201, abs=1e-6)
    assert c.g_f0 == pytest.approx(0.008244, abs=1e-6) and a.g_f0 == pytest.approx(0.004122, abs=1e-6)
    assert c.g_bias == pytest.approx(0.041219, abs=1e-6) and a.g_bias == pytest.approx(0.041219, abs=1e-6)
    loss = M.losses(pairs, cu, ar, 0.0, 1, 0.02).first()
    assert loss.pred_loss == pytest.approx((p - 1) ** 2)
    assert loss.penalty_loss == pytest.approx(0.02 * (0.1 + 0.2))


def test_e10_penalty_adds_lambda_sign(spark):
    cu, ar = table(spark, [(0, 0.1, 0.0)], 1), table(spark, [(0, 0.2, 0.0)], 1)
    pairs = spark.createDataFrame([(0, 0, 1.0)], "customer_int long, article_int long, weight double")
    cfg = M.AdamConfig(lr=1.0, beta1=0.0, beta2=0.0, eps=0.0)  # step = sign(grad)
    model = M.Model(M.with_moments(cu, 1), M.with_moments(ar, 1), 0.0, 1)
    cg, _ = M.gradients(pairs, model)
    upd = M.adam_update(model.customers, cg, 1, 1, cfg, 0.02, 0.1).first()
    # with beta2 = 0 the Adam moment v equals the squared gradient: 0.008244 + 0.02
    assert math.sqrt(upd.v_f0) == pytest.approx(0.008244 + 0.02, abs=1e-6)


def test_finite_differences(spark):
    rnd = random.Random(1)
    k = 2
    cu_rows = [(c, rnd.uniform(-0.3, 0.3), rnd.uniform(-0.3, 0.3), rnd.uniform(-0.1, 0.1)) for c in range(4)]
    ar_rows = [(a, rnd.uniform(-0.3, 0.3), rnd.uniform(-0.3, 0.3), rnd.uniform(-0.1, 0.1)) for a in range(4)]
    pairs = spark.createDataFrame(
        [(c, a, float(rnd.randint(1, 3))) for c in range(4) for a in range(4) if (c + a) % 3],
        "customer_int long, article_int long, weight double",
    )
    g0 = 0.1
    model = M.Model(M.with_moments(table(spark, cu_rows, k), k), M.with_moments(table(spark, ar_rows, k), k), g0, k)
    cg, ag = M.gradients(pairs, model)
    grads = {r.id: r for r in cg.collect()}

    def loss(rows):
        return M.losses(pairs, table(spark, rows, k), table(spark, ar_rows, k), g0, k, 0.0).first().pred_loss

    h = 1e-6
    for c, col, name in [(1, 1, "g_f0"), (2, 2, "g_f1"), (3, 3, "g_bias")]:
        up = [list(r) for r in cu_rows]
        dn = [list(r) for r in cu_rows]
        up[c][col] += h
        dn[c][col] -= h
        num = (loss([tuple(r) for r in up]) - loss([tuple(r) for r in dn])) / (2 * h)
        assert grads[c][name] == pytest.approx(num, rel=1e-4, abs=1e-7)
    total = sum(r.g_bias for r in grads.values())
    assert total == pytest.approx(sum(r.g_bias for r in ag.collect()))


@pytest.fixture(scope="module")
def synthetic(spark):
    rnd = random.Random(2)
    rows = {(rnd.randint(0, 59), rnd.randint(0, 39)) for _ in range(900)}
    return spark.createDataFrame(
        [(c, a, float(1 + (c * a) % 3)) for c, a in sorted(rows)],
        "customer_int long, article_int long, weight double",
    )


def test_fit_loss_falls(synthetic):
    model = M.fit_log_link_factors(synthetic, k=3, l2=0.0, lr=0.05, epochs=4, batch_size=400,
                                   validation_share=0.1, seed=3)
    train_losses = [h[1] for h in model.history]
    assert train_losses[-1] < train_losses[0]
    assert all(not math.isnan(h[2]) for h in model.history)


def test_fit_independent_of_partitioning(synthetic):
    kw = dict(k=2, l2=0.02, lr=0.05, epochs=2, batch_size=300, validation_share=0.05, seed=4, init_scale=0.1)
    a = M.fit_log_link_factors(synthetic.coalesce(1), **kw)
    b = M.fit_log_link_factors(synthetic.repartition(5), pairs_per_file=100, **kw)
    ra = {r.id: r for r in a.customers.collect()}
    rb = {r.id: r for r in b.customers.collect()}
    assert set(ra) == set(rb)
    for i in ra:
        assert ra[i].f0 == pytest.approx(rb[i].f0, abs=1e-9)
        assert ra[i].bias == pytest.approx(rb[i].bias, abs=1e-9)
    assert a.intercept == pytest.approx(b.intercept, abs=1e-12)


def test_snapshot_round_trip_scores_identically(spark, synthetic, scratch):
    model = M.fit_log_link_factors(synthetic, k=2, lr=0.05, epochs=1, batch_size=10_000, seed=5)
    save_model(model, scratch, "mf", "v1", 0, train_loss=1.0)
    loaded, state = load_model(spark, scratch, "mf", "v1", 0)
    assert state["train_loss"] == 1.0 and loaded.step == model.step
    a = M.pair_scores(synthetic, model.customers, model.articles, model.intercept, 2)
    b = M.pair_scores(synthetic, loaded.customers, loaded.articles, loaded.intercept, 2)
    ja = {(r.customer_int, r.article_int): r.score for r in a.collect()}
    jb = {(r.customer_int, r.article_int): r.score for r in b.collect()}
    assert ja == jb


def test_snapshot_changes_counts(spark):
    before = table(spark, [(0, 0.1, 0.5), (1, 0.2, 0.5)], 1)
    after = table(spark, [(0, 0.1, 0.6), (1, 0.3, 0.50001)], 1)
    got = {r.parameter: r.num_values_changed for r in M.snapshot_changes(before, after, 1, 1e-4).collect()}
    assert got == {"customer_factors": 1, "customer_intercepts": 1}


def test_fixed_factors_formula(spark):
    ids = spark.createDataFrame([(3,), (3,), (20000,)], "customer_int long")
    got = {r.id: r for r in M.fixed_factors(ids, "customer_int", 2).collect()}
    assert got[3].f1 == ((3 * 7919 + 104729) % 2001 - 1000) / 2000.0
    assert got[20000].bias == ((20000 * 31) % 101 - 50) / 500.0
    assert len(got) == 2


def test_a13_duplicate_pairs_sum_into_one_target(spark):
    cu, ar = table(spark, [(0, 0.1, 0.0)], 1), table(spark, [(0, 0.2, 0.0)], 1)
    dup = spark.createDataFrame([(0, 0, 0.4), (0, 0, 0.6)], "customer_int long, article_int long, weight double")
    one = spark.createDataFrame([(0, 0, 1.0)], "customer_int long, article_int long, weight double")
    a = M.losses(dup, cu, ar, 0.0, 1, 0.0).first()
    b = M.losses(one, cu, ar, 0.0, 1, 0.0).first()
    assert a.pred_loss == pytest.approx(b.pred_loss) and a.n_pairs == 1


def test_fit_same_without_broadcast_joins(spark, synthetic):
    kw = dict(k=2, l2=0.02, lr=0.05, epochs=1, batch_size=10_000, validation_share=0.05, seed=6)
    a = M.fit_log_link_factors(synthetic, **kw)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = M.fit_log_link_factors(synthetic, **kw)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ra = {r.id: r.f1 for r in a.articles.collect()}
    rb = {r.id: r.f1 for r in b.articles.collect()}
    assert ra.keys() == rb.keys() and all(abs(ra[i] - rb[i]) < 1e-9 for i in ra)


def plain_fit(rows, k, l2, lr, epochs, n_batches, share, seed, scale):
    """The fit written out with numpy over dense parameters: hash split, hash batches, Adam."""
    import hashlib

    import numpy as np

    def h(*parts):
        return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16)

    def normal(*parts):
        u1, u2 = (h(*parts, "n1") + 1.0) / 4294967297.0, h(*parts, "n2") / 4294967296.0
        return math.sqrt(-2.0 * math.log(u1)) * math.cos(6.283185307179586 * u2) * scale

    ordered = sorted(rows, key=lambda r: (h(r[0], r[1], seed, "val"), r[0], r[1]))
    n_val = int(share * len(rows))
    val, train = ordered[:n_val], ordered[n_val:]
    names = [f"f{i}" for i in range(k)] + ["bias"]
    cs, as_ = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    ci, ai = {c: i for i, c in enumerate(cs)}, {a: i for i, a in enumerate(as_)}
    par = [
        np.array([[normal("customer", c, x, seed) for x in names] for c in cs]),
        np.array([[normal("article", a, x, seed) for x in names] for a in as_]),
        np.array([normal("global", seed)]),
    ]
    m, v, t = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par], 0
    for epoch in range(epochs):
        for b in range(n_batches):
            batch = [r for r in train if h(r[0], r[1], seed, epoch) % n_batches == b]
            c = np.array([ci[r[0]] for r in batch], dtype=int)
            a = np.array([ai[r[1]] for r in batch], dtype=int)
            w = np.array([r[2] for r in batch])
            u, x = par[0][c], par[1][a]
            p = np.exp((u[:, :k] * x[:, :k]).sum(1) + u[:, k] + x[:, k] + par[2][0])
            d = 2 * (p - w) * p
            g = [np.zeros_like(q) for q in par]
            np.add.at(g[0], c, np.column_stack([d[:, None] * x[:, :k], d]))
            np.add.at(g[1], a, np.column_stack([d[:, None] * u[:, :k], d]))
            g[2][0] = d.sum()
            for side, present in ((0, np.unique(c)), (1, np.unique(a))):
                f = par[side][present, :k]
                g[side][present, :k] += l2 * f / np.sqrt((f * f).sum())
            t += 1
            for i in range(3):
                m[i] = 0.9 * m[i] + 0.1 * g[i]
                v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
                par[i] = par[i] - lr * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    loss = 0.0
    for r in val:
        u, x = par[0][ci[r[0]]], par[1][ai[r[1]]]
        loss += (math.exp(u[:k] @ x[:k] + u[k] + x[k] + par[2][0]) - r[2]) ** 2
    return cs, as_, par, loss / max(1, n_val)


@pytest.mark.parametrize("batches", [{"batch_share": 1 / 3}, {"batch_size": 1000}])
def test_fit_equals_the_loop_written_out(synthetic, batches):
    n = 3 if "batch_share" in batches else 1
    rows = [(r.customer_int, r.article_int, r.weight) for r in synthetic.collect()]
    kw = dict(k=2, l2=0.02, lr=0.03, epochs=2, seed=9, init_scale=0.3)
    model = M.fit_log_link_factors(synthetic, validation_share=0.1, **batches, **kw)
    cs, as_, par, val = plain_fit(rows, 2, 0.02, 0.03, 2, n, 0.1, 9, 0.3)
    for df, ids, want in ((model.customers, cs, par[0]), (model.articles, as_, par[1])):
        got = {r.id: [r.f0, r.f1, r.bias] for r in df.collect()}
        assert sorted(got) == ids
        assert all(got[i] == pytest.approx(want[j], abs=1e-7) for j, i in enumerate(ids))
    assert model.intercept == pytest.approx(par[2][0], abs=1e-8)
    assert model.history[-1][2] == pytest.approx(val, rel=1e-6)
    assert model.step == 2 * n


def test_initial_parameters_are_normal(spark):
    ids = spark.range(0, 4000).withColumnRenamed("id", "c")
    for scale in (1.0, 0.2):
        x = [r.f0 for r in M.init_factors(ids, "c", 1, 5, "customer", scale).collect()]
        mean = sum(x) / len(x)
        sd = math.sqrt(sum((v - mean) ** 2 for v in x) / len(x))
        assert abs(mean) < 0.06 * scale and abs(sd - scale) < 0.05 * scale and max(x) > 2.5 * scale
    draws = [M.init_intercept(s) for s in range(400)]
    assert max(draws) > 1.8 and abs(sum(draws) / 400) < 0.2


def test_exponent_bound_holds_in_gradient_and_losses(spark):
    cu, ar = table(spark, [(0, 3.0, 0.0)], 1), table(spark, [(0, 3.0, 0.0)], 1)
    pairs = spark.createDataFrame([(0, 0, 1.0)], "customer_int long, article_int long, weight double")
    model = M.Model(M.with_moments(cu, 1), M.with_moments(ar, 1), 0.0, 1, max_exponent=2.0)
    cg, _ = M.gradients(pairs, model)
    row = cg.first()
    assert row.g_f0 == 0.0 and row.loss == pytest.approx((math.exp(2) - 1) ** 2)
    bounded = M.losses(pairs, cu, ar, 0.0, 1, 0.0, max_exponent=2.0).first()
    free = M.losses(pairs, cu, ar, 0.0, 1, 0.0).first()
    assert bounded.pred_loss == pytest.approx((math.exp(2) - 1) ** 2)
    assert free.pred_loss == pytest.approx((math.exp(9) - 1) ** 2)


def test_divergence_is_an_error(spark):
    cu, ar = table(spark, [(0, 30.0, 0.0)], 1), table(spark, [(0, 30.0, 0.0)], 1)
    pairs = spark.createDataFrame([(0, 0, 1.0)], "customer_int long, article_int long, weight double")
    model = M.Model(M.with_moments(cu, 1), M.with_moments(ar, 1), 0.0, 1)
    with pytest.raises(FloatingPointError, match="diverged"):
        M.gradient_step(pairs, model, 0.0, M.AdamConfig())


def test_fit_leaves_only_its_final_state(spark, synthetic):
    import os

    from affinity.session import checkpoint_dir

    base = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    model = M.fit_log_link_factors(synthetic, k=1, lr=0.05, epochs=2, batch_share=0.5, seed=1, init_scale=0.1)
    new = [f for f in set(os.listdir(base)) - before if f.startswith("affinity-fit")]
    assert len(new) == 1 and len(os.listdir(f"{base}/{new[0]}")) == 1
    assert model.customers.count() > 0


@pytest.mark.parametrize(
    "bad", [{"k": 0}, {"lr": 0.0}, {"l2": -1.0}, {"validation_share": 1.0}, {"batch_share": 0.0}, {"max_exponent": 0.0}]
)
def test_fit_parameters_are_checked(synthetic, bad):
    with pytest.raises(ValueError):
        M.fit_log_link_factors(synthetic, **{"epochs": 1, **bad})


@pytest.fixture(scope="module")
def sparse_pairs(spark):
    """Ids that take part in few batches only, and one customer in nearly all of them."""
    rnd = random.Random(5)
    rows = {(rnd.randint(1, 60), rnd.randint(0, 50)) for _ in range(80)} | {(0, a) for a in range(25)}
    return spark.createDataFrame(
        [(c, a, float(1 + (c + a) % 3)) for c, a in sorted(rows)], "customer_int long, article_int long, weight double"
    )


@pytest.mark.parametrize("window", [4, 64])
def test_thirty_steps_with_absent_rows_equal_the_dense_update(sparse_pairs, window):
    rows = [(r.customer_int, r.article_int, r.weight) for r in sparse_pairs.collect()]
    kw = dict(k=2, l2=0.02, lr=0.03, epochs=2, seed=9, init_scale=0.3)
    model = M.fit_log_link_factors(sparse_pairs, validation_share=0.1, batch_share=1 / 15, window=window, **kw)
    cs, as_, par, val = plain_fit(rows, 2, 0.02, 0.03, 2, 15, 0.1, 9, 0.3)
    assert model.step == 30
    for df, ids, want in ((model.customers, cs, par[0]), (model.articles, as_, par[1])):
        got = {r.id: [r.f0, r.f1, r.bias] for r in df.collect()}
        assert sorted(got) == ids
        assert all(got[i] == pytest.approx(want[j], abs=1e-9) for j, i in enumerate(ids))
    assert model.intercept == pytest.approx(par[2][0], abs=1e-10)
    assert model.history[-1][2] == pytest.approx(val, rel=1e-8)


def test_a_step_reads_and_writes_the_rows_of_its_batch_only(spark, sparse_pairs, scratch):
    """Rows in the store: every entity once, and a batch's slot holds that batch's entities."""
    from affinity.operators.param_log import ParamLog

    pairs = sparse_pairs.withColumn("_batch", F.pmod(F.col("customer_int") + F.col("article_int"), F.lit(10)).cast("int"))
    uses = M.batches_of(pairs, "customer_int", "article_int", "weight")
    state = M.with_moments(M.init_factors(pairs, "customer_int", 2, 1, "customer"), 2).withColumn("side", F.lit("c"))
    state = state.unionByName(M.with_moments(M.init_factors(pairs, "article_int", 2, 1, "article"), 2).withColumn("side", F.lit("a")))
    log = ParamLog(spark, scratch, M.param_names(2), M.AdamConfig(lr=0.1), ["side", "id"], window=3)
    n = state.count()
    log.begin(0, state, uses, 10, 0, n)
    model = M.Model(None, None, 0.0, 2)
    for b in range(10):
        batch = pairs.where(F.col("_batch") == b).drop("_batch")
        now = log.read(b)
        there = {(r.side, r.id) for r in now.collect()}
        assert there == {("c", r[0]) for r in batch.collect()} | {("a", r[1]) for r in batch.collect()}
        model, _ = M.logged_step(batch, log, b, model, 0.02, log.cfg, n)
        live = log.live(b, model.step)
        assert live.count() == n == live.select("side", "id").distinct().count()


def test_interrupted_fit_equals_the_whole_one(spark, synthetic, scratch):
    import shutil

    from affinity.plans.train_job import train
    from affinity.sources.writers import complete_epochs, read_metrics

    kw = dict(num_latent_features=2, l2_lambda=0.02, learning_rate=0.05, batch_share=0.5, validation_share=0.1,
              seed=7, init_scale=0.2, snapshot_every=1)
    whole = train(spark, synthetic, f"{scratch}/whole", "mf", "v1", epochs=3, **kw)
    train(spark, synthetic, f"{scratch}/parts", "mf", "v1", epochs=2, **kw)
    models = f"{scratch}/parts/saved_models"
    assert complete_epochs(spark, models, "mf", "v1") == [0, 1]
    shutil.rmtree(f"{models}/mf__v1/epoch=1/state")  # as if the second epoch's snapshot was interrupted
    assert complete_epochs(spark, models, "mf", "v1") == [0]
    parts = train(spark, synthetic, f"{scratch}/parts", "mf", "v1", epochs=3, resume=True, **kw)
    assert parts.step == whole.step and parts.intercept == pytest.approx(whole.intercept, abs=1e-12)
    for side in ("customers", "articles"):
        a = {r.id: list(r.asDict().values()) for r in getattr(whole, side).collect()}
        b = {r.id: list(r.asDict().values()) for r in getattr(parts, side).collect()}
        assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-12) for i in a)
    logs = [
        sorted((r.epoch_number, round(r.pred_loss, 8)) for r in read_metrics(spark, f"{scratch}/{run}/training_logs", "batches").collect())
        for run in ("whole", "parts")
    ]
    assert logs[0] == logs[1] and len(logs[0]) == 6
    epochs = read_metrics(spark, f"{scratch}/parts/training_logs", "epochs")
    assert sorted(r.epoch_number for r in epochs.collect()) == [0, 1, 2] and len(parts.history) == 3
    with pytest.raises(ValueError):
        train(spark, synthetic, f"{scratch}/parts", "mf", "v1", epochs=4, resume=True, **{**kw, "num_latent_features": 3})


def test_resume_without_a_snapshot_starts_anew(spark, synthetic, scratch):
    from affinity.plans.train_job import train

    kw = dict(num_latent_features=1, learning_rate=0.05, batch_share=1.0, epochs=1, seed=7, init_scale=0.2)
    a = train(spark, synthetic, f"{scratch}/a", "mf", "v1", resume=True, **kw)
    again = train(spark, synthetic, f"{scratch}/a", "mf", "v1", resume=True, **kw)  # nothing is left to do
    assert a.step == again.step == 1 and a.intercept == again.intercept


@pytest.mark.parametrize("n_batches", [1, 62, 63, 200, 300])
def test_batches_of_an_entity_in_bits_and_lists(spark, n_batches):
    """Up to four words of bits, and the list beyond, give the sorted batches of each entity; a pair without weight none."""
    rows = [(c, a, 0.0 if (c + a) % 7 == 0 else 1.0, (31 * c + 17 * a) % n_batches) for c in range(20) for a in range(30)]
    pairs = spark.createDataFrame(rows, "customer_int long, article_int long, weight double, _batch int")
    found = M.batches_of(pairs, "customer_int", "article_int", "weight", n_batches)
    want = {}
    for c, a, w, b in rows:
        if w > 0:
            want.setdefault(("c", c), set()).add(b)
            want.setdefault(("a", a), set()).add(b)
    assert {(r.side, r.id): r.uses for r in found.collect()} == {k: sorted(v) for k, v in want.items()}
    lists = any("collect_set" in line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert lists == (n_batches > 248)
