"""Curve metrics on clustered continuous scores against a direct numpy computation."""

import numpy as np
import pytest

from eventfeat.operators.evaluate import classification_metrics, threshold_sweep


def _brute(y, s):
    order = np.argsort(-s, kind="stable")
    y, s = y[order], s[order]
    P, N = y.sum(), (1 - y).sum()
    tps, fps, prev_tp, prev_fp = [], [], [], []
    tp = fp = 0
    i = 0
    while i < len(s):
        j = i
        while j < len(s) and s[j] == s[i]:
            j += 1
        prev_tp.append(tp); prev_fp.append(fp)
        tp += y[i:j].sum(); fp += (1 - y[i:j]).sum()
        tps.append(tp); fps.append(fp)
        i = j
    tps, fps, ptp, pfp = map(np.array, (tps, fps, prev_tp, prev_fp))
    roc = np.sum((fps - pfp) / N * (tps + ptp) / (2 * P))
    prec = tps / (tps + fps)
    prec0 = np.where(ptp + pfp == 0, prec, ptp / np.maximum(ptp + pfp, 1))
    pr = np.sum((tps - ptp) / P * (prec + prec0) / 2)
    ap = np.sum((tps - ptp) / P * prec)
    return roc, pr, ap


def test_curve_metrics_exact_on_clustered_scores(spark):
    rng = np.random.default_rng(3)
    n = 4000
    y = (rng.random(n) < 0.3).astype(int)
    # 70% of scores squeezed into [0.40, 0.41), plus exact ties
    s = np.where(rng.random(n) < 0.7, 0.40 + rng.random(n) * 0.01, rng.random(n))
    s[:300] = 0.405
    s = s + y * 0.002
    df = spark.createDataFrame([(int(a), float(b), int(b >= 0.5)) for a, b in zip(y, s)], "y int, s double, pred int")
    got = classification_metrics(df, "y", "pred", "s").first()
    roc, pr, ap = _brute(y, s)
    assert got["roc_auc"] == pytest.approx(roc, abs=1e-12)
    assert got["pr_auc"] == pytest.approx(pr, abs=1e-12)
    assert got["average_precision"] == pytest.approx(ap, abs=1e-12)
    tp = int(((s >= 0.5) & (y == 1)).sum()); fp = int(((s >= 0.5) & (y == 0)).sum())
    assert (got["tp"], got["fp"]) == (tp, fp)


def test_threshold_sweep_first_best_wins(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.6), (0, 0.55), (0, 0.2), (1, 0.52)], "y int, p double")
    rows = {r["threshold"]: r for r in threshold_sweep(df, "y", "p", [0.5, 0.51, 0.7]).collect()}
    # 0.5 and 0.51 give identical counts -> identical F2; the first listed wins
    assert rows[0.5]["is_best"] == 1 and rows[0.51]["is_best"] == 0
    assert rows[0.5]["tp"] == 3 and rows[0.5]["fp"] == 1
