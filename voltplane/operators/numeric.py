"""Numerical kernels for grouped Arrow or pandas functions: what has no form in column expressions. numpy only."""

from __future__ import annotations

import numpy as np

TWO_PI = 2 * np.pi


# ---- least squares ---------------------------------------------------------------------------------------------------------------------


def nnls(a: np.ndarray, b: np.ndarray, steps: int | None = None, tol: float = 1e-10) -> np.ndarray:
    """Non-negative least squares by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    gram, right = a.T @ a, a.T @ b
    for _ in range(steps or 5 * n):
        gradient = right - gram @ x
        gradient[passive] = -np.inf
        best = int(np.argmax(gradient))
        if passive.all() or gradient[best] <= tol * max(1.0, np.abs(right).max()):
            break
        passive[best] = True
        while True:
            at = np.flatnonzero(passive)
            z = np.zeros(n)
            z[at] = np.linalg.lstsq(gram[np.ix_(at, at)], right[at], rcond=None)[0]
            low = at[z[at] <= 0]
            if not len(low):
                break
            share = min(x[i] / (x[i] - z[i]) for i in low if x[i] - z[i] > 0) if any(x[i] - z[i] > 0 for i in low) else 0.0
            x = x + share * (z - x)
            passive[at[x[at] <= tol]] = False
            x[~passive] = 0
            if not passive.any():
                break
        x = z if passive.any() else x
    return np.maximum(x, 0)


def minimise(residuals, start: np.ndarray, steps: int = 60, tol: float = 1e-7) -> tuple[np.ndarray, np.ndarray, float]:
    """Levenberg-Marquardt with a numerical Jacobian: the parameters, their covariance, and the sum of squares."""
    p, damping = np.asarray(start, float), 1e-2
    r = residuals(p)
    cost = float(r @ r)

    def jacobian(p, r):
        out = np.empty((len(r), len(p)))
        for k in range(len(p)):
            h = 1e-6 * max(1.0, abs(p[k]))
            q = p.copy()
            q[k] += h
            out[:, k] = (residuals(q) - r) / h
        return out

    j = jacobian(p, r)
    for _ in range(steps):
        gram, gradient = j.T @ j, j.T @ r
        step = -np.linalg.lstsq(gram + damping * np.diag(np.maximum(np.diag(gram), 1e-12)), gradient, rcond=None)[0]
        trial = p + step
        new = residuals(trial)
        new_cost = float(new @ new)
        if np.isfinite(new_cost) and new_cost < cost:
            done = cost - new_cost <= tol * cost
            p, r, cost, damping = trial, new, new_cost, max(damping / 5, 1e-12)
            if done:
                break
            j = jacobian(p, r)
        else:
            damping *= 4
            if damping > 1e12:
                break
    freedom = max(1, len(r) - len(p))
    return p, np.linalg.pinv(j.T @ j) * cost / freedom, cost


def weighted_line(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float, float]:
    """Slope, intercept and standard error of the slope."""
    total = w.sum()
    mx, my = (w @ x) / total, (w @ y) / total
    sxx = w @ (x - mx) ** 2
    slope = (w @ ((x - mx) * (y - my))) / sxx
    left = y - my - slope * (x - mx)
    return float(slope), float(my - slope * mx), float(np.sqrt((w @ left**2) / max(1, len(x) - 2) / sxx))


# ---- clocks ----------------------------------------------------------------------------------------------------------------------------


def gcc_phat(ref: np.ndarray, x: np.ndarray, fs: float, band: tuple[float, float] | None = None, most_lag: float | None = None, strong: float = 4.0) -> tuple[float, float]:
    """Delay of x against ref in seconds, and how far the peak of the whitened correlation stands above its best rival.

    Only bins in the band whose cross power exceeds `strong` times the median count.
    """
    n = 1 << int(np.ceil(np.log2(len(ref) + len(x))))
    cross = np.fft.rfft(x - x.mean(), n) * np.conj(np.fft.rfft(ref - ref.mean(), n))
    f = np.fft.rfftfreq(n, 1 / fs)
    use = np.ones(len(f), bool) if band is None else (f >= band[0]) & (f <= band[1])
    size = np.abs(cross)
    if use.any():
        use &= size > strong * np.median(size[use])
    white = np.where(use, cross / np.maximum(size, 1e-300), 0)
    c = np.fft.irfft(white, n)
    lags = np.concatenate((np.arange(n // 2), np.arange(-(n - n // 2), 0)))
    allowed = np.abs(lags) <= (len(ref) - 1 if most_lag is None else int(most_lag * fs))
    c = np.where(allowed, c, -np.inf)
    k = int(np.argmax(c))
    a, b, d = c[(k - 1) % n], c[k], c[(k + 1) % n]
    bend = a - 2 * b + d
    shift = 0.5 * (a - d) / bend if np.isfinite(bend) and bend != 0 else 0.0
    far = (np.abs((lags - lags[k] + n // 2) % n - n // 2) > 3) & np.isfinite(c)
    rival = c[far].max() if far.any() else 0.0
    return float((lags[k] + shift) / fs), float(b / rival) if rival > 0 else float("inf")


def frames(x: np.ndarray, n: int, hop: int) -> np.ndarray:
    count = 1 + (len(x) - n) // hop if len(x) >= n else 0
    return x[np.arange(count)[:, None] * hop + np.arange(n)]


def welch(x: np.ndarray, y: np.ndarray, fs: float, n: int, hop: int | None = None, keep: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Frequencies, Sxx, Syy and Sxy = mean conj(X) Y over Hann frames without their mean."""
    hop = hop or n // 2
    w = 0.5 - 0.5 * np.cos(TWO_PI * np.arange(n) / n)
    fx, fy = (np.fft.rfft((v - v.mean(axis=1, keepdims=True)) * w, axis=1) for v in (frames(x, n, hop), frames(y, n, hop)))
    if keep is not None:
        fx, fy = fx[keep], fy[keep]
    return np.fft.rfftfreq(n, 1 / fs), (np.abs(fx) ** 2).mean(0), (np.abs(fy) ** 2).mean(0), (np.conj(fx) * fy).mean(0)


def phase_delay(ref: np.ndarray, x: np.ndarray, fs: float, prior: float = 0.0, band: tuple[float, float] = (20.0, 4000.0), n: int = 4096) -> tuple[float, float]:
    """Delay from the slope of the cross-spectrum's phase, weighted by the coherence; and its standard error."""
    f, sxx, syy, sxy = welch(ref, x, fs, n)
    use = (f >= band[0]) & (f <= band[1])
    gamma = np.clip(np.abs(sxy[use]) ** 2 / np.maximum(sxx[use] * syy[use], 1e-300), 0, 1 - 1e-9)
    phase = np.unwrap(np.angle(sxy[use] * np.exp(1j * TWO_PI * f[use] * prior)))
    slope, _, error = weighted_line(f[use], phase, gamma / (1 - gamma))
    return float(prior - slope / TWO_PI), float(error / TWO_PI)


def estimate_delay(ref: np.ndarray, x: np.ndarray, fs: float, band: tuple[float, float] = (20.0, 4000.0), n: int = 4096, passes: int = 4) -> tuple[float, float]:
    """Coarse delay by correlation, whole samples cut off, the rest by phase, until the rest lies below half a sample."""
    whole = int(round(gcc_phat(ref, x, fs, band)[0] * fs))
    total, error = whole / fs, float("nan")
    for _ in range(passes):
        a, b = (ref[: len(ref) - whole], x[whole:]) if whole >= 0 else (ref[-whole:], x[: len(x) + whole])
        m = min(len(a), len(b))
        rest, error = phase_delay(a[:m], b[:m], fs, 0.0, band, min(n, 1 << int(np.log2(m))))
        total = whole / fs + rest
        step = int(round(rest * fs))
        if not step:
            break
        whole += step
    return float(total), error


def shifted(x: np.ndarray, tau: float, fs: float) -> np.ndarray:
    """x earlier by tau seconds, by a ramp of phase."""
    f = np.fft.rfftfreq(len(x), 1 / fs)
    return np.fft.irfft(np.fft.rfft(x) * np.exp(1j * TWO_PI * f * tau), len(x))


def notched(x: np.ndarray, fs: float, f0: float, q: float = 30.0) -> np.ndarray:
    """A second-order notch run forward and backward, so that no phase is left; in blocks, whose last two values go on to the next."""
    w = TWO_PI * f0 / fs
    alpha = np.sin(w) / (2 * q)
    b, a = np.array([1, -2 * np.cos(w), 1]) / (1 + alpha), np.array([1, -2 * np.cos(w) / (1 + alpha), (1 - alpha) / (1 + alpha)])

    width = 64
    # the recursion's answers, over a block, to an input of one and to a one in either of the two values before it
    answers = np.zeros((3, width + 2))
    answers[0, 2], answers[1, 1], answers[2, 0] = 1, 1, 1
    for k in range(2, width + 2):
        answers[:, k] -= a[1] * answers[:, k - 1] + a[2] * answers[:, k - 2]
    to_input, to_last, to_first = answers[:, 2:]
    inside = np.array([[to_input[i - j] if i >= j else 0.0 for j in range(width)] for i in range(width)])

    def run(v):
        before = np.concatenate(([v[0], v[0]], v))
        fed = b[0] * v + b[1] * before[1:-1] + b[2] * before[:-2]
        blocks = np.pad(fed, (0, -len(fed) % width)).reshape(-1, width) @ inside.T
        y1 = y2 = v[0]
        for block in blocks:
            block += to_last * y1 + to_first * y2
            y1, y2 = block[-1], block[-2]
        return blocks.ravel()[: len(v)]

    if not len(x):
        return np.zeros(0)
    return run(run(np.asarray(x, float))[::-1])[::-1]


# ---- sines -----------------------------------------------------------------------------------------------------------------------------


def sine_fit(y: np.ndarray, t: np.ndarray, freqs: np.ndarray, trend: bool = True) -> tuple[np.ndarray, float]:
    """Complex amplitudes of all the frequencies together on any times, and the RMS of what is left."""
    columns = [f(TWO_PI * w * t) for w in np.atleast_1d(freqs) for f in (np.cos, np.sin)]
    columns += [np.ones_like(t)] + ([t - t.mean()] if trend else [])
    d = np.stack(columns, axis=1)
    p = np.linalg.lstsq(d, y, rcond=None)[0]
    n = len(np.atleast_1d(freqs))
    return p[: 2 * n : 2] - 1j * p[1 : 2 * n : 2], float(np.sqrt(np.mean((y - d @ p) ** 2)))


def sine_frequency(y: np.ndarray, fs: float, f0: float, steps: int = 12) -> tuple[float, complex, float]:
    """Frequency, amplitude and residual of one sine, by linearising in the frequency; a step is at most 5 %."""
    t, f = np.arange(len(y)) / fs, f0
    for _ in range(steps):
        amp, _ = sine_fit(y, t, np.array([f]))
        a, b = amp[0].real, -amp[0].imag
        c, s = np.cos(TWO_PI * f * t), np.sin(TWO_PI * f * t)
        d = np.stack((c, s, np.ones_like(t), t - t.mean(), t * (b * c - a * s)), axis=1)
        change = np.clip(np.linalg.lstsq(d, y, rcond=None)[0][-1] / TWO_PI, -0.05 * f, 0.05 * f)
        f += change
        if abs(change) < 1e-9 * f:
            break
    amp, rms = sine_fit(y, t, np.array([f]))
    return float(f), complex(amp[0]), rms


# ---- models of spectra -----------------------------------------------------------------------------------------------------------------


def _voigt(f: np.ndarray, z: np.ndarray, m: int) -> tuple[float, np.ndarray]:
    """How far the resistances of a chain of m fixed time constants, with a series resistance and an inductance, keep one sign (1: all); and the chain's spectrum."""
    w, size = TWO_PI * f, np.abs(z)
    tau = np.geomspace(1 / w.max(), 1 / w.min(), m)
    design = np.column_stack((np.ones(len(f)), 1j * w / w.max(), 1 / (1 + 1j * np.outer(w, tau))))
    scaled, target = design / size[:, None], z / size
    p = np.linalg.lstsq(np.vstack((scaled.real, scaled.imag)), np.concatenate((target.real, target.imag)), rcond=None)[0]
    plus, minus = np.clip(p[2:], 0, None).sum(), np.clip(-p[2:], 0, None).sum()
    return float(1 - minus / plus) if plus > 0 else 0.0, design @ p


def kramers_kronig(f: np.ndarray, z: np.ndarray, mu_limit: float = 0.85, most: int | None = None) -> tuple[int, float, float, np.ndarray]:
    """The Voigt chain that a Kramers-Kronig consistent spectrum follows: (elements, mu, largest residual %, model).

    As many elements as keep mu, the share by which their resistances agree in sign, at mu_limit or above: chains of fewer leave structure, chains
    of more follow the noise. Numbers from an element a decade on, which is the least that a spectrum needs, are doubled; between the largest of
    them that mu allows and the next the number is found by halving. Where mu allows none, the first is taken.
    """
    top = most or max(4, len(f) // 2)
    rungs = [min(top, 1 + int(np.ceil(np.log10(f.max() / f.min()))))]
    while rungs[-1] < top:
        rungs.append(min(2 * rungs[-1], top))
    tried = {m: _voigt(f, z, m) for m in rungs}
    allowed = [m for m in rungs if tried[m][0] >= mu_limit]
    low = high = allowed[-1] if allowed else rungs[0]
    if allowed and low < top:
        high = rungs[rungs.index(low) + 1]
    while high - low > 1:
        middle = (low + high) // 2
        tried[middle] = _voigt(f, z, middle)
        low, high = (middle, high) if tried[middle][0] >= mu_limit else (low, middle)
    mu, model = tried[low]
    return low, mu, float(100 * np.max(np.abs(z - model) / np.abs(z))), model


def relaxation_times(f: np.ndarray, z: np.ndarray, ridge: float = 1e-3, per_decade: int = 10) -> tuple[np.ndarray, np.ndarray, float]:
    """Non-negative distribution of relaxation times with a ridge: (tau, gamma, series resistance)."""
    w = TWO_PI * f
    tau = np.logspace(np.log10(1 / w.max()), np.log10(1 / w.min()), max(8, int(per_decade * np.log10(f.max() / f.min()))))
    kernel = np.log(tau[1] / tau[0]) / (1 + 1j * w[:, None] * tau)
    size = np.abs(z)
    rows = np.concatenate((kernel.real, kernel.imag)) / np.concatenate((size, size))[:, None]
    series = np.concatenate((np.ones(len(f)), np.zeros(len(f)))) / np.concatenate((size, size))
    bend = np.diff(np.eye(len(tau)), 2, axis=0) * np.sqrt(ridge)
    a = np.concatenate((np.concatenate((rows, series[:, None]), axis=1), np.concatenate((bend, np.zeros((len(bend), 1))), axis=1)))
    x = nnls(a, np.concatenate((z.real / size, z.imag / size, np.zeros(len(bend)))))
    return tau, x[:-1], float(x[-1])


def circuit(f: np.ndarray, p: np.ndarray, arcs: int) -> np.ndarray:
    """Series resistance, inductance, and arcs of (R, tau, n); all but the exponents as logarithms."""
    w = TWO_PI * f
    z = np.exp(p[0]) + 1j * w * np.exp(p[1])
    for k in range(arcs):
        r, tau, n = np.exp(p[2 + 3 * k]), np.exp(p[3 + 3 * k]), 1 / (1 + np.exp(-p[4 + 3 * k]))
        z = z + r / (1 + (1j * w * tau) ** n)
    return z


def fit_circuit(f: np.ndarray, z: np.ndarray, arcs: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Parameters (as in circuit()), their standard deviations, and the corrected Akaike criterion; several starts."""
    size = np.abs(z)
    spread = max(z.real.max() - z.real.min(), 1e-6)
    edge = 1 / (TWO_PI * np.exp(np.log(f.min()) + (np.arange(arcs) + 1) / (arcs + 1) * np.log(f.max() / f.min())))
    best = None
    for scale in (1.0, 0.2):
        start = [np.log(max(z.real.min(), 1e-9)), np.log(1e-9)]
        for k in range(arcs):
            start += [np.log(spread / arcs), np.log(edge[::-1][k] * scale), 1.5]

        def residuals(p):
            with np.errstate(over="ignore", invalid="ignore"):
                d = (circuit(f, np.clip(p, -60, 30), arcs) - z) / size
            return np.nan_to_num(np.concatenate((d.real, d.imag)), nan=1e6, posinf=1e6, neginf=-1e6)

        p, covariance, cost = minimise(residuals, np.array(start))
        if best is None or cost < best[2]:
            best = p, np.sqrt(np.maximum(np.diag(covariance), 0)), cost
    n, k = 2 * len(f), len(best[0]) + 1
    score = n * np.log(max(best[2], 1e-300) / n) + 2 * k + 2 * k * (k + 1) / max(1, n - k - 1)
    return best[0], best[1], float(score)


def select_circuit(f: np.ndarray, z: np.ndarray, most_arcs: int = 2) -> tuple[int, np.ndarray, np.ndarray]:
    found = [(fit_circuit(f, z, a), a) for a in range(1, most_arcs + 1) if len(f) > 2 + 3 * a]
    (p, sd, _), arcs = min(found, key=lambda x: x[0][2])
    return arcs, p, sd


def _damped_steps(gram: np.ndarray, gradient: np.ndarray, damping: np.ndarray) -> np.ndarray:
    """The steps of minimise() for a stack of problems. The inverse serves where no singular value is small enough to be cut off, the eigenvectors where one may be."""
    k = gram.shape[1]
    a = gram.copy()
    a[:, range(k), range(k)] += damping[:, None] * np.maximum(np.diagonal(gram, axis1=1, axis2=2), 1e-12)
    try:
        inverse = np.linalg.inv(a)
    except np.linalg.LinAlgError:
        inverse = np.full_like(a, np.nan)
    step = -np.matmul(inverse, gradient[:, :, None])[:, :, 0]
    condition = np.trace(a, axis1=1, axis2=2) * np.trace(inverse, axis1=1, axis2=2)
    poor = np.flatnonzero(~((condition > 0) & (condition < 1e13)))
    if len(poor):
        value, vector = np.linalg.eigh(a[poor])
        size = np.abs(value)
        with np.errstate(divide="ignore"):
            over = np.where(size > np.finfo(float).eps * k * size.max(axis=1, keepdims=True), 1 / value, 0.0)
        step[poor] = -np.matmul(vector, over[:, :, None] * np.matmul(vector.swapaxes(1, 2), gradient[poor][:, :, None]))[:, :, 0]
    return step


def minimise_stack(residuals, jacobian, start: np.ndarray, steps: int = 60, tol: float = 1e-7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """minimise() step by step over a stack of problems at once, a row of start each, with its results.

    residuals(rows, p) gives a row of residuals a problem; jacobian(rows, p, r) their derivatives, a row a parameter. A problem that is done is left out of the steps that follow.
    """
    p, damping, rows = start.copy(), np.full(len(start), 1e-2), np.arange(len(start))
    r = residuals(rows, p)
    cost = np.einsum("ij,ij->i", r, r)
    j = jacobian(rows, p, r)
    gram, gradient = np.matmul(j, j.swapaxes(1, 2)), np.matmul(j, r[:, :, None])[:, :, 0]
    freedom = max(1, r.shape[1] - start.shape[1])
    for _ in range(steps):
        if not len(rows):
            break
        trial = p[rows] + _damped_steps(gram[rows], gradient[rows], damping[rows])
        new = residuals(rows, trial)
        new_cost = np.einsum("ij,ij->i", new, new)
        better = np.isfinite(new_cost) & (new_cost < cost[rows])
        done = better & (cost[rows] - new_cost <= tol * cost[rows])
        up, worse = rows[better], rows[~better]
        p[up], cost[up], damping[up] = trial[better], new_cost[better], np.maximum(damping[up] / 5, 1e-12)
        damping[worse] *= 4
        on = better & ~done
        if on.any():
            j = jacobian(rows[on], trial[on], new[on])
            gram[rows[on]], gradient[rows[on]] = np.matmul(j, j.swapaxes(1, 2)), np.matmul(j, new[on][:, :, None])[:, :, 0]
        rows = rows[~done & (better | (damping[rows] <= 1e12))]
    return p, np.linalg.pinv(gram) * (cost / freedom)[:, None, None], cost


def _arc(log_x: np.ndarray, r: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """r / (1 + (j x)^n), real and imaginary part."""
    m = np.exp(n * log_x)
    a, b = 1 + m * np.cos(n * (np.pi / 2)), m * np.sin(n * (np.pi / 2))
    over = r / (a * a + b * b)
    return a * over, -b * over


def fit_circuits(f: np.ndarray, z: np.ndarray, arcs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """fit_circuit() of spectra over the same frequencies, a row of z each; none may have gaps, zeros or values beyond all scales."""
    count, width, log_w, size = len(z), len(f), np.log(TWO_PI * f), np.abs(z)
    low = z.real.min(axis=1)
    spread = np.maximum(z.real.max(axis=1) - low, 1e-6)
    edge = 1 / (TWO_PI * np.exp(np.log(f.min()) + (np.arange(arcs) + 1) / (arcs + 1) * np.log(f.max() / f.min())))
    start = np.empty((2, count, 2 + 3 * arcs))
    start[:, :, 0], start[:, :, 1] = np.log(np.maximum(low, 1e-9)), np.log(1e-9)
    for i, scale in enumerate((1.0, 0.2)):
        for k in range(arcs):
            start[i, :, 2 + 3 * k], start[i, :, 3 + 3 * k], start[i, :, 4 + 3 * k] = np.log(spread / arcs), np.log(edge[::-1][k] * scale), 1.5
    both, over = np.concatenate((z.real / size, z.imag / size), axis=1), 1 / size

    def exponent(q):
        return 1 / (1 + np.exp(-q))

    def residuals(rows, p):
        at = rows % count
        p = np.clip(p, -60, 30)[:, :, None]
        out = np.empty((len(rows), 2 * width))
        re, im = out[:, :width], out[:, width:]
        re[:], im[:] = np.exp(p[:, 0]), np.exp(p[:, 1] + log_w)
        for k in range(2, 2 + 3 * arcs, 3):
            a, b = _arc(log_w + p[:, k + 1], np.exp(p[:, k]), exponent(p[:, k + 2]))
            re += a
            im += b
        re *= over[at]
        im *= over[at]
        out -= both[at]
        return out

    def jacobian(rows, p, r):
        """Differences as in minimise(): a parameter moves one element only."""
        h = 1e-6 * np.maximum(1.0, np.abs(p))
        q, p = np.clip(p + h, -60, 30)[:, :, None], np.clip(p, -60, 30)[:, :, None]
        out = np.zeros((len(rows), p.shape[1], 2 * width))
        re, im = out[:, :, :width], out[:, :, width:]
        grown = np.expm1(q - p)
        re[:, 0] = np.exp(p[:, 0]) * grown[:, 0]
        im[:, 1] = np.exp(p[:, 1] + log_w) * grown[:, 1]
        for k in range(2, 2 + 3 * arcs, 3):
            size, n, x = np.exp(p[:, k]), exponent(p[:, k + 2]), log_w + p[:, k + 1]
            a, b = _arc(x, size, n)
            re[:, k], im[:, k] = a * grown[:, k], b * grown[:, k]
            for moved, (c, d) in ((k + 1, _arc(log_w + q[:, k + 1], size, n)), (k + 2, _arc(x, size, exponent(q[:, k + 2])))):
                re[:, moved], im[:, moved] = c - a, d - b
        scale = over[rows % count][:, None, :] / h[:, :, None]
        re *= scale
        im *= scale
        return out

    p, covariance, cost = minimise_stack(residuals, jacobian, start.reshape(2 * count, -1))
    best = np.arange(count) + count * (cost[count:] < cost[:count])
    n, k = 2 * width, p.shape[1] + 1
    score = n * np.log(np.maximum(cost[best], 1e-300) / n) + 2 * k + 2 * k * (k + 1) / max(1, n - k - 1)
    return p[best], np.sqrt(np.maximum(np.diagonal(covariance[best], axis1=1, axis2=2), 0)), score


def select_circuits(f: np.ndarray, z: np.ndarray, most_arcs: int = 2, block: int = 256) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """select_circuit() of spectra over the same frequencies, a row of z each. They are fitted in blocks, whose derivatives fit a core's cache; a spectrum with gaps, zeros or values beyond all scales alone."""
    plain = ((np.abs(z) > 1e-100) & (np.abs(z) < 1e100)).all(axis=1)
    out = [None if ok else select_circuit(f, row, most_arcs) for ok, row in zip(plain, z, strict=True)]
    tried = [a for a in range(1, most_arcs + 1) if len(f) > 2 + 3 * a]
    places = np.flatnonzero(plain)
    for some in (places[i : i + block] for i in range(0, len(places), block)):
        found = [fit_circuits(f, z[some], a) for a in tried]
        chosen = np.argmin([score for _, _, score in found], axis=0)
        for at, (i, c) in enumerate(zip(some, chosen, strict=True)):
            out[i] = tried[c], found[c][0][at], found[c][1][at]
    return out


def modulus_from_phase(f: np.ndarray, z: np.ndarray) -> np.ndarray:
    """|Z| as its phase implies it (the integral over ln w with its first correction), at the level of the data's median."""
    order = np.argsort(f)
    lw, phase = np.log(TWO_PI * f[order]), np.unwrap(np.angle(z[order]))
    slope = np.gradient(phase, lw)
    area = np.concatenate(([0], np.cumsum(0.5 * (phase[1:] + phase[:-1]) * np.diff(lw))))
    ln = 2 / np.pi * area - np.pi / 6 * slope
    ln += np.median(np.log(np.abs(z[order])) - ln)
    out = np.empty_like(ln)
    out[order] = np.exp(ln)
    return out


# ---- fields ----------------------------------------------------------------------------------------------------------------------------


def matern(x: np.ndarray, y: np.ndarray, lx: float, ly: float) -> np.ndarray:
    d = np.sqrt(5 * (((x[:, None, 0] - y[None, :, 0]) / lx) ** 2 + ((x[:, None, 1] - y[None, :, 1]) / ly) ** 2))
    return (1 + d + d * d / 3) * np.exp(-d)


def field(x: np.ndarray, v: np.ndarray, sd: np.ndarray, at: np.ndarray, scales: tuple[float, ...] = (0.1, 0.2, 0.4, 0.8)) -> tuple[np.ndarray, np.ndarray]:
    """A Gaussian process through values at places: mean and sd elsewhere. Length scales, as shares of the extent, by marginal likelihood."""
    extent = np.maximum(x.max(0) - x.min(0), 1e-9)
    mean, power = v.mean(), max(v.var(), 1e-12)
    best = None
    for sx in scales:
        for sy in scales:
            k = power * matern(x, x, sx * extent[0], sy * extent[1]) + np.diag(sd**2 + 1e-6 * power)
            low = np.linalg.cholesky(k)
            a = np.linalg.solve(low, v - mean)
            likelihood = -0.5 * a @ a - np.log(np.diag(low)).sum()
            if best is None or likelihood > best[0]:
                best = likelihood, sx, sy, low, a
    _, sx, sy, low, a = best
    cross = np.linalg.solve(low, power * matern(x, at, sx * extent[0], sy * extent[1]))
    return mean + cross.T @ a, np.sqrt(np.maximum(power - (cross**2).sum(0), 0))


def thin_plate(x: np.ndarray, v: np.ndarray, at: np.ndarray, clip: float = 15.0) -> tuple[np.ndarray, str]:
    """Values at other places from a few sensors, and how: a thin-plate spline from four, a plane from three, else their mean; kept within `clip` of the sensors' range."""
    if len(x) < 3:
        return np.full(len(at), v.mean() if len(v) else np.nan), "mean" if len(v) else "none"
    flat = np.concatenate((np.ones((len(x), 1)), x), axis=1)
    there = np.concatenate((np.ones((len(at), 1)), at), axis=1)
    if len(x) == 3:
        out, how = there @ np.linalg.lstsq(flat, v, rcond=None)[0], "plane"
    else:
        k = _plate_kernel(x, x)
        whole = np.block([[k, flat], [flat.T, np.zeros((3, 3))]])
        weights = np.linalg.lstsq(whole, np.concatenate((v, np.zeros(3))), rcond=None)[0]
        out, how = _plate_kernel(at, x) @ weights[:-3] + there @ weights[-3:], "spline"
    return np.clip(out, v.min() - clip, v.max() + clip), how


def _plate_kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = ((a[:, None] - b[None]) ** 2).sum(-1)
    return 0.5 * square * np.log(np.maximum(square, 1e-300))


# ---- schedules and pairs of channels --------------------------------------------------------------------------------------------------


def kept_windows(f: np.ndarray, start: np.ndarray, stop: np.ndarray, snr: np.ndarray, near: float = 0.02, most_overlap: float = 0.5) -> np.ndarray:
    """Which windows stay: of neighbours in frequency within `near` the one with the higher SNR; then, from the highest SNR down, those that
    overlap no earlier one by more than a share of the shorter of both. Of equals the lower frequency, then the earlier place, stays."""
    order = np.lexsort((np.arange(len(f)), f))
    best: list[int] = []
    for i in order:
        if best and f[i] <= f[best[-1]] * (1 + near):
            if snr[i] > snr[best[-1]]:
                best[-1] = i
        else:
            best.append(i)
    kept: list[int] = []
    for i in sorted(best, key=lambda i: -snr[i]):
        held = np.array(kept, int)
        shared = np.minimum(stop[i], stop[held]) - np.maximum(start[i], start[held])
        if not (shared > most_overlap * np.minimum(stop[i] - start[i], stop[held] - start[held])).any():
            kept.append(i)
    out = np.zeros(len(f), bool)
    out[kept] = True
    return out


def joint_sine(ref: np.ndarray, x: np.ndarray, fs: float, f0: float, steps: int = 12) -> tuple[float, complex, complex]:
    """One frequency for both channels, and their amplitudes at it: the frequency's step is the mean of both linearised fits, by their power."""
    t, f = np.arange(len(ref)) / fs, f0
    for _ in range(steps):
        c, s = np.cos(TWO_PI * f * t), np.sin(TWO_PI * f * t)
        base = np.stack((c, s, np.ones_like(t), t - t.mean()), axis=1)
        up = down = 0.0
        for y in (ref, x):
            a, b = np.linalg.lstsq(base, y, rcond=None)[0][:2]
            tangent = t * (b * c - a * s)
            tangent = tangent - base @ np.linalg.lstsq(base, tangent, rcond=None)[0]
            up, down = up + tangent @ y, down + tangent @ tangent
        change = np.clip(up / max(down, 1e-300) / TWO_PI, -0.05 * f, 0.05 * f)
        f += change
        if abs(change) < 1e-9 * f:
            break
    return float(f), complex(sine_fit(ref, t, np.array([f]))[0][0]), complex(sine_fit(x, t, np.array([f]))[0][0])


def causal_delay(f: np.ndarray, z: np.ndarray, bound: float = 2e-7, n: int = 81, elements: int = 8) -> tuple[float, float]:
    """The delay within +-bound that a Voigt chain of so many elements explains best when it is taken out of z, and the RMS residual left, relative to |z|."""
    w, size = TWO_PI * f, np.abs(z)
    tau = np.logspace(np.log10(1 / w.max()), np.log10(1 / w.min()), elements)
    design = np.concatenate((np.ones((len(f), 1)), 1 / (1 + 1j * w[:, None] * tau)), axis=1) / size[:, None]
    both = np.concatenate((design.real, design.imag))
    q = np.linalg.qr(both)[0]
    best = (np.inf, 0.0)
    for d in np.linspace(-bound, bound, n):
        y = z * np.exp(1j * w * d) / size
        y = np.concatenate((y.real, y.imag))
        best = min(best, (float(np.sqrt(np.mean((y - q @ (q.T @ y)) ** 2))), float(d)))
    return best[1], best[0]


def relaxation_posterior(f: np.ndarray, z: np.ndarray, noise: float = 0.01, width: float = 0.5, per_decade: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Relaxation times under a smooth Gaussian prior: (tau, non-negative mode, standard deviation, series resistance).

    The prior is a squared exponential over ln tau of that width; the mode is the non-negative least-squares solution of data and prior together.
    """
    w, size = TWO_PI * f, np.abs(z)
    tau = np.logspace(np.log10(1 / w.max()), np.log10(1 / w.min()), max(8, int(per_decade * np.log10(f.max() / f.min()))))
    step = np.log(tau[1] / tau[0])
    kernel = step / (1 + 1j * w[:, None] * tau)
    a = np.concatenate((kernel.real, kernel.imag)) / np.tile(size * noise, 2)[:, None]
    one = np.concatenate((np.ones(len(f)), np.zeros(len(f)))) / np.tile(size * noise, 2)
    y = np.concatenate((z.real, z.imag)) / np.tile(size * noise, 2)
    scale = max(float(np.ptp(z.real)), 1e-12)
    gap = np.log(tau)[:, None] - np.log(tau)
    prior = scale**2 * np.exp(-0.5 * (gap / width) ** 2) + 1e-6 * scale**2 * np.eye(len(tau))
    root = np.linalg.inv(np.linalg.cholesky(prior))
    rows = np.concatenate((np.concatenate((a, one[:, None]), axis=1), np.concatenate((root, np.zeros((len(tau), 1))), axis=1)))
    x = nnls(rows, np.concatenate((y, np.zeros(len(tau)))))
    spread = np.sqrt(np.maximum(np.diag(np.linalg.pinv(rows.T @ rows)), 0))
    return tau, x[:-1], spread[:-1], float(x[-1])
