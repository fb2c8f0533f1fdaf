"""ARMA state-space recursions over blocks of a series (numpy, many at once).

An ARMA(p, q) series is the first component of a state of ``SIZE`` numbers
with a companion transition and shocks (1, theta). Its one-step prediction
errors depend on the state at the start of a stretch in an affine way, so a
block of rows is summed up without knowing that state:

    end state     = phi @ start + g
    sum(v^2 / F)  = s0 - 2 s1 . start + start . s2 . start

together with sum(log F) and the row count; F, the variance of the prediction
errors in units of the shocks, does not depend on the data. Blocks in order are
then chained exactly, which gives the likelihood of the whole series.
"""

from __future__ import annotations

import numpy as np

SIZE = 6                       # max(p, q + 1) for p + q <= 5
WIDTH = 2 * SIZE * SIZE + 2 * SIZE + 3
LOG_2PI = float(np.log(2 * np.pi))


def padded(values, n: int) -> np.ndarray:
    out = np.zeros(n)
    out[:len(values)] = values
    return out


def steps_back(coef: np.ndarray) -> bool:
    """Whether 1 - sum(coef_k z^k) has all roots outside the unit circle
    (partial coefficients of the step-down recursion inside (-1, 1))."""
    a = np.trim_zeros(np.asarray(coef, float), "b")
    while len(a):
        last = a[-1]
        if not abs(last) < 1 - 1e-6:
            return False
        a = (a[:-1] + last * a[-2::-1]) / (1 - last * last)
    return True


def admissible(ar: np.ndarray, ma: np.ndarray) -> bool:
    """Stationary and invertible."""
    return bool(np.isfinite(ar).all() and np.isfinite(ma).all()
                and steps_back(ar) and steps_back(-np.asarray(ma)))


def moved(ar: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The transition applied to columns ``x`` (lanes, SIZE, k)."""
    out = ar[:, :, None] * x[:, :1]
    out[:, :-1] += x[:, 1:]
    return out


def moved_cov(ar: np.ndarray, p: np.ndarray) -> np.ndarray:
    return moved(ar, moved(ar, p).transpose(0, 2, 1))


def start_cov(ar: np.ndarray, shock: np.ndarray) -> np.ndarray:
    """Stationary state covariance by doubling."""
    a = moved(ar, np.broadcast_to(np.eye(SIZE), (len(ar), SIZE, SIZE)))
    p = shock[:, :, None] * shock[:, None]
    for _ in range(60):
        more = a @ p @ a.transpose(0, 2, 1)
        p = p + more
        if not (np.abs(more) > 1e-17 * np.abs(p).max((1, 2), keepdims=True)).any():
            break
        a = a @ a
    return p


def cov_step(ar: np.ndarray, q: np.ndarray, p: np.ndarray):
    f = p[:, 0, 0]
    gain = moved(ar, p[:, :, :1])[:, :, 0] / f[:, None]
    return f, gain, moved_cov(ar, p) + q - f[:, None, None] * gain[:, :, None] * gain[:, None]


def block_elements(y: np.ndarray, length: np.ndarray, start: np.ndarray, ar: np.ndarray,
                   ma: np.ndarray) -> np.ndarray:
    """Elements (lanes, WIDTH) of blocks ``y`` (lanes, longest) of ``length``
    rows, the first being row ``start`` of its series; ``ar`` (lanes, SIZE)
    and ``ma`` (lanes, SIZE - 1) are the coefficients."""
    lanes = len(y)
    shock = np.concatenate([np.ones((lanes, 1)), ma], 1)
    q = shock[:, :, None] * shock[:, None]
    with np.errstate(all="ignore"):
        p = start_cov(ar, shock)
        settled = False
        for t in range(int(start.max(initial=0))):
            new = cov_step(ar, q, p)[2]
            new = np.where((start > t)[:, None, None], new, p)
            settled = not (np.abs(new - p) > 1e-15).any() and bool((start > t).all())
            p = new
            if settled:
                break
        g, phi = np.zeros((lanes, SIZE)), np.broadcast_to(np.eye(SIZE), (lanes, SIZE, SIZE))
        s0, s1, logs = np.zeros(lanes), np.zeros((lanes, SIZE)), np.zeros(lanes)
        s2 = np.zeros((lanes, SIZE, SIZE))
        steady = False
        for t in range(y.shape[1]):
            if not steady:
                f, gain, new = cov_step(ar, q, p)
                steady = not (np.abs(new - p) > 1e-15).any()
                p = new
            live = length > t
            weight = np.where(live, 1 / f, 0)
            v, h = y[:, t] - g[:, 0], phi[:, 0]
            s0 = s0 + weight * v * v
            s1 = s1 + (weight * v)[:, None] * h
            s2 = s2 + weight[:, None, None] * h[:, :, None] * h[:, None]
            logs = logs + np.where(live, np.log(f), 0)
            step_g = moved(ar, g[:, :, None])[:, :, 0] + gain * v[:, None]
            step_phi = moved(ar, phi) - gain[:, :, None] * h[:, None]
            if live.all():
                g, phi = step_g, step_phi
            else:
                g = np.where(live[:, None], step_g, g)
                phi = np.where(live[:, None, None], step_phi, phi)
    return np.concatenate([phi.reshape(lanes, -1), s2.reshape(lanes, -1), g, s1,
                           s0[:, None], logs[:, None], length[:, None]], 1)


def chained(elements: np.ndarray) -> tuple[float, float, int, np.ndarray]:
    """(sum v^2/F, sum log F, rows, end state) of blocks in order."""
    n2 = SIZE * SIZE
    state, s0, logs, rows = np.zeros(SIZE), 0.0, 0.0, 0
    for e in elements:
        phi, s2 = e[:n2].reshape(SIZE, SIZE), e[n2:2 * n2].reshape(SIZE, SIZE)
        g, s1 = e[2 * n2:2 * n2 + SIZE], e[2 * n2 + SIZE:2 * n2 + 2 * SIZE]
        s0 += e[-3] - 2 * s1 @ state + state @ s2 @ state
        logs += e[-2]
        rows += int(e[-1])
        state = phi @ state + g
    return s0, logs, rows, state


def log_likelihood(s0: float, logs: float, n: int) -> float:
    """Gaussian log-likelihood at the best shock variance, s0 / n."""
    return -0.5 * (n * (np.log(s0 / n) + LOG_2PI + 1) + logs) if n and s0 > 0 else float("nan")


# ------------------------------------------------------------------ Newton steps

def stencil(k: int, width: float) -> np.ndarray:
    """Moves of ``k`` parameters that give gradient and Hessian: none, one up,
    one down, two up."""
    eye = np.eye(k) * width
    two = [eye[i] + eye[j] for i in range(k) for j in range(i)]
    return np.array([np.zeros(k), *eye, *(-eye), *two])


def newton_move(values: np.ndarray, k: int, width: float) -> np.ndarray:
    """The Newton step from the values at the stencil; none where the values
    are not those of a bowl."""
    if not np.isfinite(values).all():
        return np.zeros(k)
    here, up, down, two = values[0], values[1:k + 1], values[k + 1:2 * k + 1], values[2 * k + 1:]
    slope = (up - down) / (2 * width)
    hess = np.diag((up + down - 2 * here) / width ** 2)
    at = 0
    for i in range(k):
        for j in range(i):
            hess[i, j] = hess[j, i] = (two[at] - up[i] - up[j] + here) / width ** 2
            at += 1
    try:
        np.linalg.cholesky(hess)
    except np.linalg.LinAlgError:
        return np.zeros(k)
    return -np.linalg.solve(hess, slope)


# ------------------------------------------------------------------ forecasts

def forecast_path(ar: np.ndarray, ma: np.ndarray, state: np.ndarray, mean: float, d: int,
                  tail: list[float], horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """(levels, variances in units of the shock variance) of ``horizon`` steps:
    the state is moved on, psi weights give the variances, and both are summed
    up ``d`` times from the last values ``tail`` (level, then first difference)."""
    x, psi = np.zeros(horizon), np.zeros(horizon)
    a, r = state.copy(), np.concatenate([[1.0], ma])
    for h in range(horizon):
        x[h], psi[h] = mean + a[0], r[0]
        a, r = (moved(ar[None], s[None, :, None])[0, :, 0] for s in (a, r))
    for k in range(d):
        x, psi = tail[d - 1 - k] + np.cumsum(x), np.cumsum(psi)
    return x, np.cumsum(psi * psi)
