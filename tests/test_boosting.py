"""Leaf-wise boosting: one tree against a plain version, both ways of growing it, patience, written models."""

import math
import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskforge.operators import boosting as B
from riskforge.operators.ranking import auc_ks

RULES = dict(leaves=6, min_rows=4, l1=0.1, l2=0.1, feature_share=1.0, row_share=1.0, max_bins=16, weight="w")


@pytest.fixture(scope="module")
def rows():
    rnd = np.random.default_rng(1)
    x = np.round(rnd.normal(size=(240, 3)), 1)
    y = (x[:, 0] * x[:, 1] + 0.4 * x[:, 2] + rnd.normal(scale=0.4, size=240) > 0.2).astype(int)
    return x, y, np.where(np.arange(240) % 4 == 3, "val", "train")


@pytest.fixture(scope="module")
def table(spark, rows):
    x, y, split = rows
    return spark.createDataFrame([(*map(float, r), int(t), str(p), 1.0 + int(t)) for r, t, p in zip(x, y, split)],
                                 "a double, b double, c double, y int, split string, w double").repartition(3).persist()


def plain_tree(x, g, h, edges, leaves, least, l1, l2):
    """Best-first growth that tries every split of every leaf; {leaf rows: value}."""
    score = lambda r: max(abs(g[r].sum()) - l1, 0.0) ** 2 / (h[r].sum() + l2)

    def best(r):
        top = (0.0, None)
        for f in range(x.shape[1]):
            for e in edges[f]:
                low = x[r, f] <= e
                a, b = r[low], r[~low]
                if min(len(a), len(b)) >= least:
                    gain = score(a) + score(b) - score(r)
                    if gain > top[0] + 1e-12:
                        top = (gain, (a, b))
        return top

    open_ = [(np.arange(len(x)), best(np.arange(len(x))))]
    while len(open_) < leaves:
        i = max(range(len(open_)), key=lambda j: open_[j][1][0])
        if open_[i][1][1] is None:
            break
        _, (_, pair) = open_.pop(i)
        open_ += [(r, best(r)) for r in pair]
    return {tuple(r): -math.copysign(max(abs(g[r].sum()) - l1, 0.0), g[r].sum()) / (h[r].sum() + l2) for r, _ in open_}


@pytest.mark.parametrize("local_rows", [0, 40, 1 << 17])
def test_one_tree_equals_a_plain_tree(spark, table, rows, monkeypatch, local_rows):
    monkeypatch.setattr(B, "LOCAL_ROWS", local_rows)
    monkeypatch.setattr(B, "TASK_ROWS", (50, 1 << 22))           # several tasks
    x, y, split = rows
    train = split == "train"
    x, y, w = x[train], y[train], 1.0 + y[train]
    model = B.fit(table.where("split = 'train'"), ["a", "b", "c"], rounds=1, rate=1.0, **RULES)
    p = (w * y).sum() / w.sum()
    assert model.start == pytest.approx(math.log(p / (1 - p)))
    grain = lambda v: np.rint(v * B.GRAIN) / B.GRAIN
    edges = B._edges(table.where("split = 'train'"), ["a", "b", "c"], 16)
    want = plain_tree(x, grain((p - y) * w), grain(p * (1 - p) * w), edges, 6, 4, 0.1, 0.1)
    t = model.trees[0]
    tree = B.Tree([{"a": 0, "b": 1, "c": 2}.get(f, -1) for f in t["feature"]], [], t["left"], t["right"], t["value"])
    leaf = tree.leaf_of(x, t["threshold"])
    got = {tuple(np.flatnonzero(leaf == v)): t["value"][v] for v in set(leaf.tolist())}
    assert got.keys() == want.keys() and len(got) == 6
    assert all(got[k] == pytest.approx(want[k]) for k in got)
    assert all(t["n"][v] == len(np.flatnonzero(leaf == v)) for v in set(leaf.tolist()))


def test_patience_keeps_the_best_prefix_and_models_are_written(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "CUT_ROUNDS", 3)
    model = B.fit(table, ["a", "b", "c"], rounds=40, rate=0.5, patience=5, **dict(RULES, row_share=0.8, feature_share=0.7))
    assert model.rounds == int(np.argmax(model.curve)) + 1
    assert len(model.curve) == 40 or len(model.curve) == model.rounds + 5
    # the reported AUC of the best round is that of the kept trees' scores
    val = model.transform(table.where("split = 'val'")).select("y", "score").toPandas()
    pairs = val.score[val.y == 1].to_numpy()[:, None] - val.score[val.y == 0].to_numpy()[None, :]
    assert max(model.curve) == pytest.approx(((pairs > 0) + 0.5 * (pairs == 0)).mean(), abs=2e-3)
    model.save(spark, str(tmp_path / "m"))
    again = B.BoostedModel.load(spark, str(tmp_path / "m"))
    a, b = (m.transform(table).agg(F.sum("score"), F.min("score")).first() for m in (model, again))
    assert a == b and again.split_counts() == model.split_counts()
    assert B.fit(table, ["a", "b", "c"], rounds=40, rate=0.5, patience=5, **dict(RULES, row_share=0.8, feature_share=0.7)).trees == model.trees


def test_edges_of_training_data(spark, table):
    one = table.withColumn("y", F.lit(1))
    model = B.fit(one, ["a"], rounds=2, **RULES)                 # a single class: no split, scores near 1
    assert model.transform(one).agg(F.min("score")).first()[0] > 0.99
    gaps = table.withColumn("a", F.when(F.col("b") > 0, F.col("a"))).withColumn("b", F.lit(float("nan")))
    assert B.fit(gaps, ["a", "b"], rounds=2, **RULES).transform(gaps).where("score IS NULL OR isnan(score)").count() == 0
    assert B.fit(table.where("split = 'train'"), ["a"], rounds=3, **RULES).rounds == 3      # no validation rows: all rounds


def test_small_tables_of_a_pass_meet_at_the_driver(spark, table, monkeypatch):
    """Every pass of eight tasks took a second stage to add up tables of a few hundred kilobytes; the trees are the same."""
    monkeypatch.setattr(B, "TASK_ROWS", (10, 1 << 22))
    monkeypatch.setattr(B, "LOCAL_ROWS", 0)
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()

    def fit(group):
        sc.setJobGroup(group, group)
        model = B.fit(table, list("abc"), rounds=2, **RULES)
        return model.trees, sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group))

    trees, few = fit("boost-driver")
    monkeypatch.setattr(B, "DRIVER_BYTES", 0)
    again, many = fit("boost-tree")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert trees == again
    assert few < many


def test_only_scores_are_kept_between_rounds(rows):
    """Gradients are made anew in every pass; kept, they were 25 of 63 bytes a row, written and read with every round."""
    x, y, split = rows
    block = {"x": np.zeros((len(y), 3), np.uint8), "y": y.astype(float), "w": np.ones(len(y)), "val": split == "val", "key": np.arange(len(y))}
    kept = B._advance(None, 0.0)(block)
    assert set(kept) == {*block, "raw"}
    made = B._gradients(1, 0.5)(kept)
    assert made["g"] == pytest.approx(0.5 - y, abs=1e-6) and not (made["use"] & block["val"]).any()


def test_one_partition_makes_many_rounds_in_a_job(spark, table, monkeypatch):
    """Every round was a job or more, however few the rows: most of its time was the start of Python tasks."""
    calls, grow = [], B.grow
    monkeypatch.setattr(B, "grow", lambda *a, **k: calls.append(1) or grow(*a, **k))      # the driver's own calls

    def fit():
        calls.clear()
        model = B.fit(table, list("abc"), rounds=25, patience=25, **dict(RULES, row_share=0.8, feature_share=0.7))
        return model.trees, model.curve, len(calls)

    *alone, led = fit()
    monkeypatch.setattr(B, "LOCAL_ROWS", 40)
    *spread, led_spread = fit()
    assert alone == spread and len(alone[1]) == 25
    assert led == 0 and led_spread == 25


def _split_over_tasks(monkeypatch, at_once, rounds_a_job=3):
    monkeypatch.setattr(B, "LOCAL_ROWS", 0)
    monkeypatch.setattr(B, "TASK_ROWS", (50, 1 << 22))
    monkeypatch.setattr(B, "GANG_ROWS", 0 if at_once else 1 << 20, raising=False)
    monkeypatch.setattr(B, "GANG_ROUNDS", rounds_a_job, raising=False)


@pytest.mark.parametrize("split, features, share", [("all", "abc", 0.7), ("train", "abc", 1.0), ("all", "a", 1.0)])
def test_tasks_at_once_make_many_rounds_in_a_job(spark, table, monkeypatch, split, features, share):
    """Every round over several tasks was five jobs or more, two of them shuffles of its rows; the trees are the same."""
    calls, grow = [], B.grow
    monkeypatch.setattr(B, "grow", lambda *a, **k: calls.append(1) or grow(*a, **k))      # the driver's own calls
    data = table if split == "all" else table.where("split = 'train'")

    def fit(at_once):
        _split_over_tasks(monkeypatch, at_once)
        calls.clear()
        model = B.fit(data, list(features), rounds=8, patience=8, **dict(RULES, row_share=share, feature_share=share))
        return model.trees, model.curve, len(calls)

    *passes, led = fit(False)
    *at_once, led_at_once = fit(True)
    assert passes == at_once and len(at_once[0]) and led == 8 and led_at_once == 0


def test_tasks_at_once_end_with_training(spark, table, monkeypatch):
    """They stop at the round that the patience ends with, one job or several, and where no split is left."""
    given = []
    real = B._together
    monkeypatch.setattr(B, "_together", lambda *a: given.append(a[1]) or real(*a))
    rules = dict(RULES, row_share=0.8, feature_share=0.7)

    def fit(at_once, data, rounds_a_job=1, **more):
        _split_over_tasks(monkeypatch, at_once, rounds_a_job)
        given.clear()
        model = B.fit(data, list("abc"), **more)
        return model.trees, model.curve, model.rounds

    args = dict(rounds=60, rate=0.9, patience=3, **rules)
    want = fit(False, table, **args)
    assert len(want[1]) == want[2] + 3 < 60
    for rounds_a_job in (4, 100):
        assert fit(True, table, rounds_a_job, **args) == want
        assert given == list(range(0, len(want[1]) + 1, rounds_a_job))
    one = table.withColumn("y", F.lit(1))
    assert fit(True, one, 100, rounds=60, **RULES) == fit(False, one, rounds=60, **RULES)


def test_tasks_at_once_without_rows_take_part(spark, monkeypatch):
    """Equal rows lie in one task: others have none, and still add their empty tables."""
    rows = [(float(i % 3), float(i % 2), int(i % 5 < i % 3), "val" if i % 4 == 3 else "train", 1.0) for i in range(300)]
    data = spark.createDataFrame(rows, "a double, b double, y int, split string, w double")

    def fit(at_once):
        _split_over_tasks(monkeypatch, at_once)
        model = B.fit(data, ["a", "b"], rounds=5, **dict(RULES, row_share=0.6, feature_share=0.5))
        return model.trees, model.curve

    assert fit(True) == fit(False)


def test_a_failed_job_of_tasks_at_once_is_made_up_by_passes(spark, table, monkeypatch):
    together = B._together

    def broken(plan, first, *rest):
        def run(blocks):
            raise ValueError("lost")
        return run if first else together(plan, first, *rest)

    def fit(at_once):
        _split_over_tasks(monkeypatch, at_once, 4)
        model = B.fit(table, list("abc"), rounds=9, patience=9, **dict(RULES, row_share=0.8))
        return model.trees, model.curve

    want = fit(False)
    monkeypatch.setattr(B, "_together", broken)
    assert fit(True) == want


def test_tables_are_handed_over_as_files(tmp_path, monkeypatch):
    def task(me):
        mail = B._Mail(str(tmp_path), me, 3)
        first = mail.sum(np.full((2, 2), 1.0 + me))
        top = mail.sum_at_first(np.array([float(me)]))
        return first.tolist(), top, mail.sum(np.array([10.0 * me])).tolist()

    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(task, range(3)))
    assert [g[0] for g in got] == [[[6.0, 6.0], [6.0, 6.0]]] * 3 and [g[2] for g in got] == [[30.0]] * 3
    assert got[0][1] == [3.0] and got[1][1] is None and got[2][1] is None
    assert sorted(os.listdir(tmp_path)) == ["2-0", "2-1", "2-2"]          # what all have read is gone
    monkeypatch.setattr(B, "MAIL_SECONDS", 0.01)
    with pytest.raises(TimeoutError):
        B._Mail(str(tmp_path / "alone"), 0, 2).sum(np.zeros(1))
    assert [B._mounted(p) for p in ("file:/a/b c%20", "file:///a/b", "/a", "hdfs://h/a", "s3a://b/a")] == ["/a/b c%20", "/a/b", "/a", None, None]


def test_gradients_beyond_four_bytes_are_dealt_whole():
    v = np.array([3.0, -5000.25])
    assert B._grains(v[:1]).dtype == np.int32
    assert (B._grains(v) / B.GRAIN == v).all()


def _random_tree(rnd, leaves, features):
    tree, open_ = B.Tree(), [0]
    tree.add(0.0, 1)
    while len(open_) < leaves:
        v = open_.pop(rnd.integers(len(open_)))
        tree.feature[v], tree.cut[v] = int(rnd.integers(features)), int(rnd.integers(255))
        tree.left[v], tree.right[v] = tree.add(0.0, 1), tree.add(0.0, 1)
        open_ += [tree.left[v], tree.right[v]]
    return tree


@pytest.mark.parametrize("leaves", [1, 2, 31, 32, 33, 64, 65])
def test_leaves_of_bins_are_found_by_one_lookup_a_feature(leaves):
    """Every row was sent down the tree node by node, a quarter of a round's time."""
    rnd = np.random.default_rng(leaves)
    x = rnd.integers(0, 256, (2000, 5)).astype(np.uint8)
    tree = _random_tree(rnd, leaves, 5)
    walked = tree.leaf_of(x.astype(float))
    assert (tree.leaf_of(x) == walked).all()
    if leaves <= 64:
        assert (tree._leaf_of_bins(x) == walked).all()


def test_one_task_counts_only_children_that_can_be_split():
    """A task that has all rows counted the children of every open leaf, and those of the last split."""
    rnd = np.random.default_rng(3)
    x = rnd.integers(0, 16, (2, 500)).astype(np.uint8)
    g, h = np.rint(rnd.normal(size=500) * B.GRAIN) / B.GRAIN, np.ones(500)
    penalty, asked = B.Penalty(0.1, 0.1, 5), []

    def sums(keep):
        t = [np.bincount(x[i][keep], w, 16) for i in range(2) for w in (g[keep], h[keep], np.ones(keep.sum()))]
        return np.array(t).reshape(2, 3, 16).transpose(0, 2, 1)

    def tables(tree, nodes, _):
        asked.append(len(nodes))
        at = tree.leaf_of(x.T)
        return np.array([sums(at == v) for v in nodes]), None

    wide = B.grow(tables, [0, 1], penalty, 8, 0.1)[0]
    many = sum(asked)
    asked.clear()
    assert B.grow(tables, [0, 1], penalty, 8, 0.1, ahead=False)[0] == wide == B._grow_rows(x, g, h, [0, 1], penalty, 8, 0.1, 16)
    assert asked == [1] * 7 and many > 7             # the root and a child of all splits but the last


def test_rows_are_scored_by_bins_of_the_thresholds(spark, monkeypatch):
    """Every batch walked every split of every tree by its values; bins of the thresholds give the same scores to the last bit."""
    rnd = np.random.default_rng(5)
    trees = []
    for _ in range(12):
        t = {k: [] for k in ("feature", "threshold", "left", "right", "value", "gain", "n")}

        def add(depth, t=t):
            v = len(t["n"])
            split = depth < 4 and rnd.random() < 0.9
            for k, x in zip(t, ("ab"[rnd.integers(2)] if split else None, float(rnd.integers(-3, 4)) if split else None, -1, -1,
                                float(rnd.normal()), 0.0, 1)):
                t[k].append(x)
            if split:
                t["left"][v], t["right"][v] = add(depth + 1), add(depth + 1)
            return v
        add(0)
        trees.append(t)
    model = B.BoostedModel(["a", "b", "unused"], 0.25, trees)
    values = [None, float("nan"), float("inf"), float("-inf"), -0.0, *np.arange(-4.0, 4.5, 0.5).tolist()]
    df = spark.createDataFrame([(a, b, 1.0) for a in values for b in values], "a double, b double, unused double")

    def plain(a, b):
        raw, row = 0.25, {"a": a, "b": b}
        for t in trees:
            v = 0
            while t["left"][v] >= 0:
                x = row[t["feature"][v]]
                v = t["left"][v] if x is not None and x <= t["threshold"][v] else t["right"][v]
            raw += t["value"][v]
        return 1.0 / (1.0 + np.exp(-raw))

    got = [r["score"] for r in model.transform(df).collect()]
    assert got == [plain(a, b) for a in values for b in values]
    cuts, binned = model.binned()
    assert [c.tolist() for c in cuts] == [sorted({c for t in trees for f, c in zip(t["feature"], t["threshold"]) if f == k}) for k in model.features]
    # more thresholds than a byte holds
    many = {"feature": ["a", None, None], "left": [1, -1, -1], "right": [2, -1, -1], "value": [0.0, -1.0, 1.0], "gain": [1.0, 0.0, 0.0], "n": [2, 1, 1]}
    wide = B.BoostedModel(["a"], 0.0, [dict(many, threshold=[float(i), None, None]) for i in range(300)])
    up = [r["score"] for r in wide.transform(spark.createDataFrame([(-1.0,), (149.5,), (400.0,)], "a double")).collect()]
    assert up[0] < 1e-9 and up[1] == 0.5 and up[2] > 1 - 1e-9


def test_rows_are_scored_once_for_their_metrics(spark):
    """The filter of the histogram on the score was made below the projection, which scored every row twice."""
    tree = {"feature": ["a", None, None], "threshold": [0.5, None, None], "left": [1, -1, -1], "right": [2, -1, -1], "value": [0.0, -1.0, 1.0],
            "gain": [1.0, 0.0, 0.0], "n": [2, 1, 1]}
    df = spark.createDataFrame([(float(i % 2), i % 2) for i in range(20)], "a double, y int")
    model = B.BoostedModel(["a"], 0.0, [tree])
    got = auc_ks(model.transform(df), F.col("y"), F.col("score")).collect()
    assert got[0]["auc"] == 1.0 and got[0]["n"] == 20
    plan = model.transform(df).where(F.col("score").isNotNull()).groupBy("score").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
