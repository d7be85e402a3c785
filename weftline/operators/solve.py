"""Weight calibration: raking, linear, entropy, boxed entropy, and sparse gates.

The unknowns of the convex solvers are one number per target. They live on the driver; the weights are a closed
expression of them (``d * exp(x . b)`` and the like), so an iteration is one aggregation over the rows, no state is
shuffled and no lineage grows. Only the gate solver keeps a state per column: within one task, or, for a large matrix,
on the executors and every few epochs in the checkpoint folder.

Features are numeric columns, one per target, for up to some hundred targets (the second moments of all pairs of
targets go to the driver); :func:`entropy_wide` takes them as long rows and never forms these. Null features count as
zero. Every fit reports the errors of its own weights, measured on the rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.exprs import ordered_sum
from weftline.session import cut


@dataclass
class Fit:
    """Weights as a column of the input, and how they were found."""

    weight: Column
    path: list[str] = field(default_factory=list)
    iterations: int = 0
    errors: np.ndarray | None = None
    converged: bool = True


def _x(features: list[str]) -> list[Column]:
    return [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]


def _dot(features: list[str], b: np.ndarray) -> Column:
    return functools.reduce(operator.add, [x * F.lit(float(v)) for x, v in zip(_x(features), b)])


def totals(df: DataFrame, features: list[str], w: Column) -> np.ndarray:
    row = df.agg(*[F.coalesce(F.sum(x * w), F.lit(0.0)) for x in _x(features)]).first()
    return np.array(list(row), float)


def moments(df: DataFrame, features: list[str], w: Column) -> tuple[np.ndarray, np.ndarray, float]:
    """``sum w x``, ``sum w x x'`` and ``sum w``; each partition sends one row per entry, ``m * m`` in all."""
    m = len(features)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = np.zeros((m + 1, m + 1))
        for b in batches:
            a = np.column_stack([np.ones(len(b)), b[[f"f{i}" for i in range(m)]].to_numpy(float)])
            g += a.T @ (b["w"].to_numpy(float)[:, None] * a)
        i, j = np.indices(g.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": g.ravel()})

    parts = df.select(w.alias("w"), *[x.alias(f"f{i}") for i, x in enumerate(_x(features))]).mapInPandas(run, "i long, j long, v double")
    g = np.zeros((m + 1, m + 1))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # (m + 1)^2 rows
        g[r["i"], r["j"]] = r["v"]
    return g[0, 1:], g[1:, 1:], g[0, 0]


#: Most distinct feature rows that are raked or balanced on the driver; beyond, every round is an aggregation.
RAKE_ROWS = 100_000


def rake(df: DataFrame, features: list[str], targets: list[float], weight: str, iterations: int = 2000, tol: float = 1e-6, rows: int = RAKE_ROWS) -> Fit:
    """Multiplicative raking: each row moves by its targets' factors, with its feature shares as exponents.

    Rows with equal features move alike, so the rounds run over the distinct feature rows and their summed weights.
    """
    y = np.array(targets, float)
    xs = [F.greatest(x, F.lit(0.0)) for x in _x(features)]
    whole = functools.reduce(operator.add, xs)
    log_f = np.zeros(len(y))

    def w_of(lf: np.ndarray) -> Column:
        e = functools.reduce(operator.add, [x * F.lit(float(v)) for x, v in zip(xs, lf)])
        return F.col(weight) * F.when(whole > 0, F.exp(e / whole)).otherwise(F.lit(1.0))

    distinct = cut(df.groupBy(*[x.alias(f) for x, f in zip(_x(features), features)]).agg(F.sum(F.col(weight).cast("double")).alias(weight)))
    if distinct.count() <= rows:
        a = np.array([list(r) for r in distinct.select(*features, weight).collect()], float).reshape(-1, len(y) + 1)
        x, d = a[:, :-1], np.nan_to_num(a[:, -1])
        up = np.maximum(x, 0.0)
        share = up / np.where(up.sum(axis=1) > 0, up.sum(axis=1), 1.0)[:, None]
        sums = lambda lf: (d * np.exp(share @ lf)) @ x
    else:
        sums = lambda lf: totals(distinct, features, w_of(lf))

    done, met = 0, False
    for done in range(1, iterations + 1):
        step = np.log(np.maximum(y, 1e-300)) - np.log(sums(log_f) + 1e-10)
        log_f = log_f + step
        if met := bool(np.abs(step).max() < tol):
            break
    return Fit(w_of(log_f), ["rake"], done, sums(log_f) - y, met)


def relative_errors(errors: np.ndarray, targets) -> np.ndarray:
    """Absolute errors over ``max(|target|, 1)``."""
    return np.abs(errors) / np.maximum(np.abs(np.array(targets, float)), 1.0)


def linear(df: DataFrame, features: list[str], targets: list[float], weight: str, tol: float = 1e-6) -> Fit:
    """Linear calibration ``d (1 + x . l)``: one pass for the moments, a small solve, one map. Weights may be negative.

    Features that depend on each other are solved in the least-squares sense; the fit has converged if the totals of
    its weights, measured on the rows, are within ``tol`` of the targets.
    """
    s, g, _ = moments(df, features, F.col(weight).cast("double"))
    scale = np.sqrt(np.maximum(np.diag(g), 1e-300))
    lam = np.linalg.lstsq(g / np.outer(scale, scale), (np.array(targets, float) - s) / scale, rcond=1e-12)[0] / scale
    w = F.col(weight) * (F.lit(1.0) + _dot(features, lam))
    errors = totals(df, features, w) - np.array(targets, float)
    return Fit(w, ["linear"], 1, errors, bool((relative_errors(errors, targets) <= tol).all()))


def entropy(df: DataFrame, features: list[str], targets: list[float], weight: str, box: float = 0.0, iterations: int = 60, tol: float = 1e-9, rows: int = RAKE_ROWS) -> Fit:
    """Positive weights nearest to the baseline in relative entropy, by Newton steps with halving.

    Rows with equal features move alike, so the steps run over the distinct feature rows, on the driver if there are at
    most ``rows`` of them, else by aggregations.
    With ``box`` > 0 each total may be off by ``box * max(|target|, 1)``: the dual gains an absolute-value term, which
    is minimised by coordinate steps on the quadratic model.
    """
    t = np.array(targets, float)
    scale = np.maximum(np.maximum(np.abs(t), np.abs(totals(df, features, F.col(weight).cast("double")))), 1.0)
    ts, slack = t / scale, box * np.maximum(np.abs(t), 1.0) / scale
    beta = np.zeros(len(t))

    def w_of(b: np.ndarray) -> Column:
        return F.col(weight) * F.exp(F.least(F.greatest(_dot(features, b / scale), F.lit(-700.0)), F.lit(700.0)))

    distinct = cut(df.groupBy(*[x.alias(f) for x, f in zip(_x(features), features)]).agg(F.sum(F.col(weight).cast("double")).alias(weight)))
    local = np.nan_to_num(np.array([list(r) for r in distinct.collect()], float).reshape(-1, len(t) + 1)) if distinct.count() <= rows else None

    def sums(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        if local is None:
            return moments(distinct, features, w_of(b))
        x, d = local[:, :-1], local[:, -1]
        w = d * np.exp(np.clip(x @ (b / scale), -700.0, 700.0))
        return w @ x, (x * w[:, None]).T @ x, float(w.sum())

    def state(b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        s, g, n = sums(b)
        return n - ts @ b + slack @ np.abs(b), s / scale - ts, g / np.outer(scale, scale)

    f, grad, hess = state(beta)
    n = 0
    for n in range(1, iterations + 1):
        violation = np.where(beta != 0, np.abs(grad + slack * np.sign(beta)), np.maximum(np.abs(grad) - slack, 0))
        if violation.max() < tol:
            break
        h = hess + 1e-12 * np.eye(len(t))
        if box:
            z = beta.copy()
            for _ in range(200):
                for j in range(len(t)):
                    q = grad[j] + h[j] @ (z - beta) - h[j, j] * z[j]
                    z[j] = -np.sign(q) * max(abs(q) - slack[j], 0) / h[j, j]
            step = z - beta
        else:
            step = -np.linalg.lstsq(h, grad, rcond=1e-14)[0]
        for _ in range(30):
            f2, g2, h2 = state(beta + step)
            if np.isfinite(f2) and f2 <= f + 1e-12 * max(1.0, abs(f)):
                break
            step = step / 2
        else:
            break
        beta, f, grad, hess = beta + step, f2, g2, h2
    w = w_of(beta)
    errors = totals(df, features, w) - t
    ok = bool((relative_errors(errors, t) <= box + 1e-6).all())
    return Fit(w, ["entropy" if not box else f"entropy within {box:g}"], n, errors, ok)


def simplex(c: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """A vertex that minimises ``c . x`` with ``a x = b`` and ``x >= 0``, or null if there is none; two phases, Bland's rule."""
    m, n = a.shape
    sign = np.where(b < 0, -1.0, 1.0)
    t = np.hstack([a * sign[:, None], np.eye(m), (b * sign)[:, None]])
    basis = list(range(n, n + m))

    def run(cost: np.ndarray, usable: int) -> None:
        pivots = 0
        while True:
            reduced = cost[:usable] - cost[basis] @ t[:, :usable]
            better = np.nonzero(reduced < -1e-10)[0]
            if not len(better):
                return
            # the steepest column at first, the first one after many pivots, which cannot cycle
            enter = int(better[reduced[better].argmin()] if pivots < 200 else better[0])
            pivots += 1
            up = t[:, enter] > 1e-12
            if not up.any():
                return
            ratio = np.where(up, t[:, -1] / np.where(up, t[:, enter], 1.0), np.inf)
            rows = np.nonzero(ratio <= ratio.min() + 1e-12)[0]
            leave = min(rows, key=lambda i: basis[i])
            t[leave] /= t[leave, enter]
            others = np.arange(m) != leave
            t[others] -= np.outer(t[others, enter], t[leave])
            basis[leave] = enter

    run(np.concatenate([np.zeros(n), np.ones(m)]), n + m)
    if sum(t[i, -1] for i, j in enumerate(basis) if j >= n) > 1e-7 * max(1.0, np.abs(b).max(initial=0.0)):
        return None
    for i, j in enumerate(basis):  # artificial columns that stayed at zero
        if j >= n:
            k = next((k for k in range(n) if abs(t[i, k]) > 1e-9 and k not in basis), None)
            if k is not None:
                t[i] /= t[i, k]
                others = np.arange(m) != i
                t[others] -= np.outer(t[others, k], t[i])
                basis[i] = k
    run(np.concatenate([c, np.full(m, 1e9)]), n)
    x = np.zeros(n + m)
    x[basis] = t[:, -1]
    return x[:n]


def minimax(df: DataFrame, features: list[str], targets: list[float], weight: str, rounds: int = 500, tol: float = 1e-9) -> Fit:
    """Non-negative weights with the least largest relative error, by linear programming with generated columns.

    The program has a row pair per target and a column per distinct feature row. The driver holds only the columns
    generated so far; a round finds the distinct feature row that would improve the solution most, one aggregation. The
    solution has weight on at most ``2 m + 1`` feature rows; all table rows with these features share it in proportion to
    their weights. ``errors`` are measured on the rows; ``iterations`` counts the rounds.
    """
    y = np.array(targets, float)
    scale = np.maximum(np.abs(y), 1.0)
    m = len(y)
    rows = cut(df.groupBy(*[x.alias(f) for x, f in zip(_x(features), features)]).agg(F.sum(F.col(weight).cast("double")).alias(weight)).where(F.col(weight) > 0))
    start = rows.agg(*[fn(F.struct(F.col(f), *features)).alias(f"{k}{i}") for i, f in enumerate(features) for k, fn in (("a", F.max), ("b", F.min))]).first()
    held: list[tuple] = []
    for s0 in (start or ()):
        if s0 is not None and tuple(s0)[1:] not in held:
            held.append(tuple(s0)[1:])
    n, w, rhs = 0, np.zeros(0), np.tile(y / scale, 2)
    for n in range(1, rounds + 1):
        x = np.array(held, float).reshape(-1, m).T / scale[:, None]
        # x w - t + s = y, x w + t - r = y
        k = x.shape[1]
        a = np.block([[x, -np.ones((m, 1)), np.eye(m), np.zeros((m, m))], [x, np.ones((m, 1)), np.zeros((m, m)), -np.eye(m)]])
        cost = np.zeros(k + 1 + 2 * m)
        cost[k] = 1.0
        sol = simplex(cost, a, rhs)
        w = sol[:k]
        # prices: least squares on the columns in use gives the dual at a non-degenerate vertex
        used = np.nonzero(sol > 1e-12)[0]
        price = np.linalg.lstsq(a[:, used].T, cost[used], rcond=None)[0]
        if (price @ a > cost + 1e-7).any():
            price = dual(a, cost, rhs)
        p = (price[:m] + price[m:]) / scale
        gain = _dot(features, p)
        best = rows.select(gain.alias("gain"), *features).agg(F.max(F.struct("gain", *features)).alias("b")).first()["b"]
        if best is None or best["gain"] <= tol or tuple(best)[1:] in held:
            break
        held.append(tuple(best)[1:])
    spread = [(r, v) for r, v in zip(held, w) if v > 1e-12]
    share = F.lit(0.0)
    if spread:
        mass = {tuple(r[f] for f in features): r[weight] for r in rows.where(functools.reduce(operator.or_, [functools.reduce(operator.and_, [F.col(f) == F.lit(float(v)) for f, v in zip(features, r)]) for r, _ in spread])).collect()}  # at most 2 m + 1 rows
        for r, v in spread:
            same = functools.reduce(operator.and_, [x == F.lit(float(c)) for x, c in zip(_x(features), r)])
            share = F.when(same, F.lit(float(v / mass[r]))).otherwise(share)
    out = F.col(weight) * share
    errors = totals(df, features, out) - y
    return Fit(out, ["minimax"], n, errors, bool((relative_errors(errors, y) <= 1e-6).all()))


def dual(a: np.ndarray, c: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Prices ``p`` that maximise ``b . p`` with ``p a <= c``, by the simplex method on ``p = u - v`` with slacks."""
    n = a.shape[1]
    sol = simplex(np.concatenate([-b, b, np.zeros(n)]), np.hstack([a.T, -a.T, np.eye(n)]), c)
    m = a.shape[0]
    return sol[:m] - sol[m : 2 * m]


def densify(estimates: np.ndarray, baseline: np.ndarray, targets: np.ndarray, bound: float) -> float:
    """The largest share of the baseline that can be blended in while every relative error stays within ``bound``.

    Errors are linear in the share, so each target gives one limit.
    """
    scale = np.maximum(np.abs(targets), 1.0)
    e0, e1 = (estimates - targets) / scale, (baseline - targets) / scale
    share = 1.0
    for a, b in zip(e0, e1):
        for bnd in (bound, -bound):
            if (b - bnd) * np.sign(bnd) > 0 and b != a:
                share = min(share, (bnd - a) / (b - a))
    return float(min(max(share, 0.0), 1.0))


def calibrate(df: DataFrame, features: list[str], targets: list[float], weight: str, method: str = "rake", approximate: bool = True, max_error: float = 0.1, exact: float = 1e-6) -> Fit:
    """Dispatch with fall-backs; ``path`` records what was tried, ``converged`` and ``errors`` what came of it.

    ``linear`` that does not meet its targets goes on to ``rake``. ``entropy`` goes on to the minimax program, taken if
    it meets the targets; where an approximate fit is allowed and the least largest error is within ``max_error``, to
    entropy within that box, then to the minimax weights with as much of the baseline blended in as the bound allows,
    then to the minimax weights; otherwise the fit that failed is returned as not converged. ``rake`` has no fall-back.
    """
    y = np.array(targets, float)
    if method == "linear":
        fit = linear(df, features, targets, weight)
        if fit.converged:
            return fit
        after = rake(df, features, targets, weight)
        after.path.insert(0, "linear failed")
        return after
    if method == "entropy":
        fit = entropy(df, features, targets, weight)
        if fit.converged:
            return fit
        lp = minimax(df, features, targets, weight)
        lp.path.insert(0, "entropy failed")
        if lp.converged:
            return lp
        least = float(relative_errors(lp.errors, y).max())
        if not approximate or least > max_error:
            fit.path.append(f"least error {least:.3g}")
            return fit
        boxed = entropy(df, features, targets, weight, box=max_error)
        if boxed.converged:
            boxed.path.insert(0, "entropy failed")
            return boxed
        share = densify(lp.errors + y, totals(df, features, F.col(weight).cast("double")), y, max_error)
        if share > 0:
            blend = lp.weight * (1 - share) + F.col(weight) * share
            errors = totals(df, features, blend) - y
            return Fit(blend, [*lp.path, f"blended {share:.3g}"], lp.iterations, errors, bool((relative_errors(errors, y) <= max_error + 1e-9).all()))
        lp.converged = True
        return lp
    return rake(df, features, targets, weight)


def feature_rows(long: DataFrame, base: DataFrame, row: str, j: str, x: str, weight: str) -> DataFrame:
    """One row per table row: ``row, weight, idx, val``, its non-zero features as two arrays; rows without any have empty ones."""
    e = long.where(F.col(x) != 0).groupBy(row).agg(F.array_sort(F.collect_list(F.struct(F.col(j).cast("int").alias("j"), F.col(x).cast("double").alias("x")))).alias("e"))
    none = F.array().cast("array<struct<j:int,x:double>>")
    e = base.select(row, F.col(weight).cast("double").alias(weight)).join(e, row, "left").withColumn("e", F.coalesce("e", none))
    return e.select(row, weight, F.transform("e", lambda z: z["j"]).alias("idx"), F.transform("e", lambda z: z["x"]).alias("val"))


def _flat(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a batch: row number, target number and value."""
    size = b["idx"].map(len).to_numpy()
    if not size.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.repeat(np.arange(len(b)), size), np.concatenate(b["idx"].to_list()).astype(np.int64), np.concatenate(b["val"].to_list()).astype(float)


def entropy_wide(rows: DataFrame, targets: np.ndarray, weight: str, iterations: int = 60, tol: float = 1e-9, cg: int = 200) -> tuple[np.ndarray, np.ndarray, bool]:
    """Entropy balancing for many targets on :func:`feature_rows`: multipliers, errors of the totals, and whether they are met.

    Newton steps with halving whose systems are solved by preconditioned conjugate gradients: the matrix of second
    moments is only ever multiplied with a vector, in a pass over the rows that returns one number per target and
    partition, so the driver holds a few vectors of one number per target. The weights are
    ``d * exp(sum of val * multiplier)``, see :func:`wide_weight`.
    """
    y = np.asarray(targets, float)
    m = len(y)
    rows = cut(rows)

    def over(b1: np.ndarray, v: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
        """Totals, and the product of the second moments with ``v`` (or their diagonal), and the sum of the weights."""
        held = rows.sparkSession.sparkContext.broadcast((b1, v))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            beta, vec = held.value
            g, h, n = np.zeros(m), np.zeros(m), 0.0
            for b in batches:
                at, idx, val = _flat(b)
                w = b[weight].to_numpy(float) * np.exp(np.clip(np.bincount(at, val * beta[idx], len(b)), -700, 700))
                n += w.sum()
                g += np.bincount(idx, val * w[at], m)
                h += np.bincount(idx, val * val * w[at] if vec is None else val * (w * np.bincount(at, val * vec[idx], len(b)))[at], m)
            j = np.nonzero(g != 0)[0] if not h.any() else np.nonzero((g != 0) | (h != 0))[0]
            yield pd.DataFrame({"j": np.append(j, -1), "g": np.append(g[j], n), "h": np.append(h[j], 0.0)})

        got = rows.mapInPandas(run, "j long, g double, h double").groupBy("j").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()  # one row per target
        held.destroy()
        j, gs, hs = (got[c].to_numpy() for c in "jgh")
        g, h = np.zeros(m), np.zeros(m)
        g[j[j >= 0]], h[j[j >= 0]] = gs[j >= 0], hs[j >= 0]
        return g, h, float(gs[j < 0].sum())

    beta = np.zeros(m)
    s, diag, n = over(beta)
    unit = np.maximum(np.maximum(np.abs(y), np.abs(s)), 1.0)
    f = n - y @ beta
    for _ in range(iterations):
        grad = s - y
        if (np.abs(grad) / unit).max(initial=0.0) < tol:
            break
        pre = 1 / np.maximum(diag, 1e-12 * max(diag.max(initial=0.0), 1e-300))
        step, r = np.zeros(m), -grad
        z = pre * r
        p, rz, start = z, r @ z, np.sqrt(np.abs(r @ z))
        for _ in range(cg):
            _, hp, _ = over(beta, p)
            curve = p @ hp
            if curve <= 0:
                break
            a = rz / curve
            step, r = step + a * p, r - a * hp
            z = pre * r
            rz, last = r @ z, rz
            if np.sqrt(abs(rz)) < 0.01 * start:
                break
            p = z + (rz / last) * p
        for _ in range(30):
            s2, diag2, n2 = over(beta + step)
            f2 = n2 - y @ (beta + step)
            if np.isfinite(f2) and f2 <= f + 1e-12 * max(1.0, abs(f)):
                break
            step = step / 2
        else:
            break
        beta, s, diag, f = beta + step, s2, diag2, f2
    return beta, s - y, bool((relative_errors(s - y, y) <= 1e-6).all())


def wide_weight(rows: DataFrame, beta: np.ndarray, row: str, weight: str) -> DataFrame:
    """``row, w``: the weights of :func:`entropy_wide` for its multipliers."""
    held = rows.sparkSession.sparkContext.broadcast(beta)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at, idx, val = _flat(b)
            yield pd.DataFrame({row: b[row], "w": b[weight].to_numpy(float) * np.exp(np.clip(np.bincount(at, val * held.value[idx], len(b)), -700, 700))})

    return rows.mapInPandas(run, f"{row} {dict(rows.dtypes)[row]}, w double")


#: Most matrix entries that one task fits by itself (32 bytes each); beyond, closed columns are fitted apart from open ones.
LOCAL_ENTRIES = 2_000_000
#: Most entries of open columns that one task holds as arrays (12 bytes each, and 80 for a column); beyond, every epoch is a pass over the open columns.
HELD_ENTRIES = 30_000_000
#: Epochs from one sorting out of closed columns to the next: at first, at most (they double), and where every epoch is a pass.
EPOCHS_FIRST, EPOCHS_MOST, EPOCHS_KEPT = 50, 1000, 10
#: Most that the penalty on all open gates together pushes (nothing but closed gates has a loss of about 1).
PUSH_MOST = 3.0
_GATE_STATE = ("lw", "la", "m1", "v1", "m2", "v2")


def sparse_gates(
    matrix: DataFrame, weights: DataFrame, targets: DataFrame, penalty: float, epochs: int = 5000, rate: float = 0.1, temperature: float = 0.5, tol: float = 1e-4, patience: int = 200,
    local: int = LOCAL_ENTRIES, held: int = HELD_ENTRIES, folder: str | None = None, every: int = 500,
) -> DataFrame:
    """Sparse reweighting with stretched gates: ``col_id, w, gate, active``.

    ``matrix``: ``target_idx, col_id, val``; ``weights``: ``col_id, w``; ``targets``: ``target_idx, value`` and, if it
    has the column, ``mass`` (a target's factor in the loss). Loss is the mean over targets of
    ``mass * ((estimate - value + 1) / (value + 1))^2`` plus ``penalty`` times the expected number of open gates. It is
    minimised by Adam until, over ``patience`` epochs, the least loss has fallen by no more than ``tol`` of itself and as
    many gates stayed open; over ``epochs`` epochs at most. Gates use their expected openings, so the fit is
    reproducible.

    While the penalty on the open gates comes to more than ``PUSH_MOST``, its slope on them is that of this much in all:
    otherwise the gates of some 100,000 columns would all close before the weights of the needed ones have grown, though
    a few open ones have a far smaller loss. Losses have the whole penalty, and the fit ends under it.

    Up to ``local`` entries are fitted in one task. Beyond, each column holds its entries as arrays, its logarithmic
    weight, gate logit and Adam moments, and closed columns are sorted out every so many epochs. A closed column weighs
    nothing, never opens again, and its logit depends on itself alone, so all closed columns go through these epochs in
    parallel, each task summing up their expected openings. The open ones, soon few, are fitted in one task, or, beyond
    ``held`` entries, by two passes an epoch. The losses and the epoch at which the fit ends are those of one task.

    With ``folder`` (shared by all executors) the fit is written there every ``every`` epochs: the columns' state, the
    losses (``epoch, loss, open``) and the targets (``epoch, target_idx, estimate, value, relative_error``). A later call
    with the same problem goes on from the last state, or returns at once if that had settled; another penalty, rate,
    temperature, mass or target value is an error (:func:`compare_signatures`), another number of epochs is not.
    """
    lo, hi = -0.1, 1.1
    listed = (targets if "mass" in targets.columns else targets.withColumn("mass", F.lit(1.0))).select("target_idx", "value", "mass").orderBy("target_idx").collect()  # one row per target
    ids = [r["target_idx"] for r in listed]
    y, mass = np.array([r["value"] for r in listed], float), np.array([r["mass"] for r in listed], float)
    n = max(len(y), 1)
    shift = temperature * np.log(-lo / hi)
    spark = matrix.sparkSession
    where = spark.createDataFrame(list(enumerate(ids)), f"_pos int, target_idx {dict(targets.dtypes)['target_idx']}")
    flat = cut(matrix.join(F.broadcast(where), "target_idx").join(weights, "col_id").select("col_id", "_pos", F.col("val").cast("double").alias("val"), F.log(F.greatest("w", F.lit(1e-12))).alias("lw")))  # as long as the list of targets above
    gate = F.least(F.greatest(F.lit(1.0) / (1 + F.exp(-F.col("la"))) * (hi - lo) + lo, F.lit(0.0)), F.lit(1.0))
    given = dict(flat.dtypes)["col_id"]

    def settled(history: list[tuple[float, int]]) -> bool:
        if len(history) <= patience:
            return False
        last = history[-patience:]
        return min(x for x, _ in last) >= min(x for x, _ in history[:-patience]) * (1 - tol) and len({n for _, n in last}) == 1

    def loss_slope(est: np.ndarray) -> tuple[float, np.ndarray]:
        r = (est - y + 1) / (y + 1)
        return float((mass * r * r).sum() / n), 2 * mass * r / (y + 1) / n

    def pushed(p_open: float) -> float:
        return min(penalty, PUSH_MOST / max(p_open, 1e-300))

    def step(b: dict, g: np.ndarray, t: int, push: float) -> None:
        w = np.exp(b["lw"])
        sig = 1 / (1 + np.exp(-b["la"]))
        raw = sig * (hi - lo) + lo
        z = np.clip(raw, 0, 1)
        active = 1 / (1 + np.exp(-(b["la"] - shift)))
        slopes = {"lw": g * w * z, "la": g * w * np.where((raw > 0) & (raw < 1), (hi - lo) * sig * (1 - sig), 0) + np.where(z > 0, push, penalty) * active * (1 - active)}
        for p, m, v in (("lw", "m1", "v1"), ("la", "m2", "v2")):
            b[m] = 0.9 * b[m] + 0.1 * slopes[p]
            b[v] = 0.999 * b[v] + 0.001 * slopes[p] * slopes[p]
            b[p] = b[p] - rate * (b[m] / (1 - 0.9**t)) / (np.sqrt(b[v] / (1 - 0.999**t)) + 1e-8)

    def opened(b: dict) -> tuple[np.ndarray, float, int, float]:
        """Weights, expected number of open gates, open gates, and the former of the latter."""
        z = np.clip(1 / (1 + np.exp(-b["la"])) * (hi - lo) + lo, 0, 1)
        active = 1 / (1 + np.exp(-(b["la"] - shift)))
        return np.exp(b["lw"]) * z, float(active.sum()), int((z > 0).sum()), float(active[z > 0].sum())

    numbers = ", ".join(f"{c} double" for c in _GATE_STATE)

    def in_one_task(state: DataFrame, first: int, last: int, before: list) -> tuple[DataFrame, list, bool]:
        def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rows = [*batches]
            if not rows:
                return
            x = pd.concat(rows, ignore_index=True).sort_values(["col_id", "_pos"], ignore_index=True)
            col, names = pd.factorize(x["col_id"])
            pos, val = x["_pos"].to_numpy(), x["val"].to_numpy(float)
            lead = np.unique(col, return_index=True)[1]
            b = {c: x[c].to_numpy(float)[lead] for c in _GATE_STATE}
            history, done = list(before), 0
            for t in range(first, last + 1):
                w, p, k, q = opened(b)
                main, slope = loss_slope(np.bincount(pos, val * w[col], len(y)))
                history.append((main + penalty * p, k))
                done += 1
                if settled(history):
                    break
                step(b, np.bincount(col, val * slope[pos], len(names)), t, pushed(q))
            yield pd.DataFrame({"col_id": names, "kind": 0} | b)
            news = history[len(before):]
            yield pd.DataFrame({"col_id": pd.Series([names[0]] * done), "kind": range(1, done + 1), "lw": [a for a, _ in news], "la": [float(k) for _, k in news]} | dict.fromkeys(_GATE_STATE[2:], 0.0))

        out = cut(flat.drop("lw").join(state, "col_id").repartition(1).mapInPandas(fit, f"col_id {given}, kind int, {numbers}"))
        news = [(r["lw"], int(r["la"])) for r in out.where("kind > 0").orderBy("kind").collect()]  # one row per epoch
        return out.where("kind = 0").drop("kind"), news, settled([*before, *news])

    def closing(shut: DataFrame, first: int, last: int) -> tuple[DataFrame, np.ndarray]:
        """Closed columns (``col_id, la, m2, v2``) over epochs, and per epoch the sum of their expected openings."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            p, name = np.zeros(last - first + 1), None
            for x in batches:
                la, m, v = (x[c].to_numpy(float) for c in ("la", "m2", "v2"))
                for i, t in enumerate(range(first, last + 1)):
                    active = 1 / (1 + np.exp(shift - la))
                    p[i] += active.sum()
                    slope = penalty * active * (1 - active)
                    m = 0.9 * m + 0.1 * slope
                    v = 0.999 * v + 0.001 * slope * slope
                    la = la - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
                name = x["col_id"].iloc[:1] if len(x) else name
                yield x.assign(kind=0, la=la, m2=m, v2=v)
            if name is not None:
                yield pd.DataFrame({"col_id": name.repeat(len(p)).to_numpy(), "la": p, "m2": 0.0, "v2": 0.0, "kind": range(1, len(p) + 1)})

        out = cut(shut.mapInPandas(run, f"col_id {given}, la double, m2 double, v2 double, kind int"))
        p = np.zeros(last - first + 1)
        for r in out.where("kind > 0").groupBy("kind").agg(ordered_sum("la").alias("p")).collect():  # one row per epoch
            p[r["kind"] - 1] = r["p"]
        return out.where("kind = 0").drop("kind"), p

    def held_fit(s: DataFrame, first: int, last: int, before: list, closed: np.ndarray) -> tuple[DataFrame, list]:
        """Open columns in one task, which holds a batch's entries as arrays."""

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, names = [], []
            for x in batches:
                if x.num_rows:
                    size = pc.list_value_length(x.column("idx")).to_numpy()
                    parts.append(({c: x.column(c).to_numpy() for c in _GATE_STATE}, x.column("idx").flatten().to_numpy(), x.column("val").flatten().to_numpy(zero_copy_only=False), size, np.cumsum(size) - size))
                    names.append(x.column("col_id"))
            history, news, slope, q = list(before), [], None, 0.0
            for t in range(first, last + 1):
                est, p, k, q, push = np.zeros(len(y)), 0.0, 0, 0.0, pushed(q)
                for b, idx, val, size, lead in parts:
                    if slope is not None:
                        step(b, np.add.reduceat(val * slope[idx], lead), t - 1, push)
                    w, p1, k1, q1 = opened(b)
                    est += np.bincount(idx, val * np.repeat(w, size), len(y))
                    p, k, q = p + p1, k + k1, q + q1
                main, slope = loss_slope(est)
                news.append((main + penalty * (p + closed[t - first]), k))
                history.append(news[-1])
                if settled(history):
                    break
            else:
                for b, idx, val, _, lead in parts:
                    step(b, np.add.reduceat(val * slope[idx], lead), last, pushed(q))
            for name, (b, *_) in zip(names, parts):
                yield pa.RecordBatch.from_pydict({"col_id": name, "kind": np.zeros(len(name), np.int32)} | b)
            if names:
                yield pa.RecordBatch.from_pydict({"col_id": pa.nulls(len(news), names[0].type), "kind": np.arange(1, len(news) + 1, dtype=np.int32), "lw": np.array([a for a, _ in news]), "la": np.array([float(k) for _, k in news])} | dict.fromkeys(_GATE_STATE[2:], np.zeros(len(news))))

        out = cut(s.repartition(1).sortWithinPartitions("col_id").mapInArrow(fit, f"col_id {given}, kind int, {numbers}"))
        return out.where("kind = 0").drop("kind"), [(r["lw"], int(r["la"])) for r in out.where("kind > 0").orderBy("kind").collect()]  # one row per epoch

    def passes_fit(s: DataFrame, first: int, last: int, before: list, closed: np.ndarray) -> tuple[DataFrame, list]:
        """Open columns where they are, two passes an epoch."""

        def update(slope: np.ndarray, t: int, push: float) -> Callable:
            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for x in batches:
                    at, idx, val = _flat(x)
                    b = {c: x[c].to_numpy(float) for c in _GATE_STATE}
                    step(b, np.bincount(at, val * slope[idx], len(x)), t, push)
                    yield x.assign(**b)

            return run

        def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            est, p, k, q = np.zeros(len(y)), 0.0, 0, 0.0
            for x in batches:
                at, idx, val = _flat(x)
                w, p1, k1, q1 = opened({c: x[c].to_numpy(float) for c in _GATE_STATE})
                est += np.bincount(idx, val * w[at], len(y))
                p, k, q = p + p1, k + k1, q + q1
            yield pd.DataFrame({"pos": np.arange(-3, len(y)), "v": np.concatenate([[q, float(k), p], est])})

        news, kept = [], []
        for t in range(first, last + 1):
            got = s.mapInPandas(add_up, "pos int, v double").groupBy("pos").agg(F.sum("v").alias("v")).orderBy("pos").toArrow()["v"].to_numpy()  # one number per target
            main, slope = loss_slope(got[3:])
            news.append((main + penalty * (got[2] + closed[t - first]), int(got[1])))
            if settled([*before, *news]):
                break
            s = s.mapInPandas(update(slope, t, pushed(got[0])), s.schema).persist()
            kept.append(s)
        state = cut(s.select("col_id", *_GATE_STATE))
        for k in kept:
            k.unpersist()
        return state, news

    entries: DataFrame | None = None

    def spread(state: DataFrame, first: int, last: int, before: list) -> tuple[DataFrame, list, bool]:
        nonlocal entries
        if entries is None:
            e = flat.groupBy("col_id").agg(F.array_sort(F.collect_list(F.struct("_pos", "val"))).alias("e"))
            entries = e.select("col_id", F.transform("e", lambda x: x["_pos"]).alias("idx"), F.transform("e", lambda x: x["val"]).alias("val"))
        tasks = 4 * spark.sparkContext.defaultParallelism
        history, length, is_open, of_shut = list(before), EPOCHS_FIRST, gate > 0, ("col_id", "la", "m2", "v2")
        # a gate closes while its logit falls; from then on only the penalty moves it, down: it stays closed, and no other column matters to it
        ajar, shut = state.where(is_open), state.where(~is_open).select(*of_shut)
        n_shut = shut.count()
        while first <= last and not settled(history):
            s = cut(entries.join(ajar, "col_id").select("col_id", "idx", "val", *_GATE_STATE))
            entries = s.select("col_id", "idx", "val")
            n_held = s.agg(F.coalesce(F.sum(F.size("idx")), F.lit(0))).first()[0]
            end = min(last, first + (length if n_held <= held else EPOCHS_KEPT) - 1)
            after, p = closing(shut, first, end)
            if n_held:
                got, news = (held_fit if n_held <= held else passes_fit)(s, first, end, history, p)
            else:
                got, news, main = s.select("col_id", *_GATE_STATE), [], loss_slope(np.zeros(len(y)))[0]
                while len(news) < len(p) and not settled([*history, *news]):
                    news.append((main + penalty * p[len(news)], 0))
            history += news
            if settled(history):  # the last of these epochs made no step
                after = closing(shut, first, first + len(news) - 2)[0] if len(news) > 1 else shut
            ajar, fresh = got.where(is_open), got.where(~is_open).select(*of_shut)
            n_fresh = fresh.count()
            shut = after.unionByName(fresh).repartition(tasks, "col_id") if 10 * n_fresh > n_shut else after.unionByName(fresh.coalesce(1)) if n_fresh else after
            first, length, n_shut = first + len(news), min(2 * length, EPOCHS_MOST), n_shut + n_fresh
            spark.sparkContext._jvm.System.gc()  # files of earlier states are deleted when the driver collects its garbage
        state = ajar.unionByName(shut.select("col_id", *[F.col(c) if c in of_shut else F.lit(0.0).alias(c) for c in _GATE_STATE]))
        return state, history[len(before):], settled(history)

    signature = {"penalty": penalty, "rate": rate, "temperature": temperature, "targets": hashlib.sha256(repr([(str(i), float(a), float(b)) for i, a, b in zip(ids, y, mass)]).encode()).hexdigest(), "epochs": epochs}
    history: list[tuple[float, int]] = []
    state, done = None, False
    if folder:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/log")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            log = spark.read.parquet(f"{folder}/log").orderBy("epoch").collect()  # one row per epoch
            old = json.loads(spark.read.text(f"{folder}/signature").first()[0])
            differ = compare_signatures(old, signature, ("penalty", "rate", "temperature", "targets"))
            if differ["fatal"]:
                raise ValueError(f"the fit in {folder} is of another problem: {', '.join(differ['fatal'])}")
            history = [(r["loss"], r["open"]) for r in log]
            state = spark.read.parquet(f"{folder}/state/epoch={len(history)}")
            done = settled(history)
    if state is None:
        state = flat.groupBy("col_id").agg(F.first("lw").alias("lw")).select("col_id", "lw", F.lit(2.0).alias("la"), *[F.lit(0.0).alias(c) for c in _GATE_STATE[2:]])
        if folder:
            spark.createDataFrame([(json.dumps(signature),)], "s string").coalesce(1).write.mode("overwrite").text(f"{folder}/signature")
    run = in_one_task if flat.count() <= local else spread
    while not done and len(history) < epochs:
        first = len(history) + 1
        state, news, done = run(state, first, min(epochs, first + every - 1) if folder else epochs, history)
        history += news
        if not news:
            break
        if folder:
            at = len(history)
            state.write.mode("overwrite").parquet(f"{folder}/state/epoch={at}")
            state = spark.read.parquet(f"{folder}/state/epoch={at}")
            est = flat.drop("lw").join(state.select("col_id", (F.exp("lw") * gate).alias("w")), "col_id").groupBy("_pos").agg(F.sum(F.col("val") * F.col("w")).alias("estimate"))
            told = where.join(est, "_pos", "left").join(targets.select("target_idx", "value"), "target_idx").select(F.lit(at).alias("epoch"), "target_idx", F.coalesce("estimate", F.lit(0.0)).alias("estimate"), "value")
            told.withColumn("relative_error", F.try_divide(F.col("estimate") - F.col("value"), F.abs("value"))).write.mode("append").parquet(f"{folder}/targets")
            spark.createDataFrame([(first + i, float(a), int(k)) for i, (a, k) in enumerate(news)], "epoch int, loss double, open long").coalesce(1).write.mode("append").parquet(f"{folder}/log")
    return state.select("col_id", (F.exp("lw") * gate).alias("w"), gate.alias("gate"), (gate > 0).alias("active"))


def target_loss(df: DataFrame, estimate: str, target: str) -> DataFrame:
    """Sum of squared relative errors, share within 10%, median and largest absolute relative error."""
    e = F.when(F.col(target) != 0, (F.col(estimate) - F.col(target)) / F.abs(F.col(target)))
    return df.select(e.alias("e")).agg(F.sum(F.col("e") * F.col("e")).alias("loss"), F.avg((F.abs("e") <= 0.1).cast("double")).alias("within_10"), F.percentile(F.abs("e"), 0.5).alias("median"), F.max(F.abs("e")).alias("largest"))


def compare_signatures(old: dict, new: dict, fatal: tuple[str, ...]) -> dict[str, list[str]]:
    """Keys that differ between two checkpoint signatures, as fatal and soft."""
    differ = [k for k in sorted({*old, *new}) if old.get(k) != new.get(k)]
    return {"fatal": [k for k in differ if k in fatal], "soft": [k for k in differ if k not in fatal]}
