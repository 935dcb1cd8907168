"""Keypoints, matches, homographies and photometric agreement."""

from __future__ import annotations

import numpy as np

from twinframe.kernels.pixels import area_resize, filtered, gaussian, gradients, gray


#: Keypoints of an image, and samples of a search for a homography, at most.
KEYPOINTS, ROUNDS = 4000, 5000
#: Rows of descriptors compared at a time, and samples fitted at a time.
BLOCK, BATCH = 256, 100


def keypoints(image: np.ndarray, most: int = KEYPOINTS, patch: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Harris corners (x, y) that are local maxima, strongest first, and their descriptors: gradient orientations in 4 x 4 cells of a patch, normalised."""
    smooth = filtered(gray(image), gaussian(3))
    gx, gy = gradients(smooth)
    window = gaussian(7, 1.5)
    xx, yy, xy = filtered(gx * gx, window), filtered(gy * gy, window), filtered(gx * gy, window)
    strength = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
    padded = np.pad(strength, 2, constant_values=-np.inf)
    best = np.lib.stride_tricks.sliding_window_view(padded, (5, 5)).max(axis=(2, 3))
    half = patch // 2
    ok = (strength == best) & (strength > 1e-4 * max(float(strength.max(initial=0)), 1e-12))
    ok[:half] = ok[-half:] = False
    ok[:, :half] = ok[:, -half:] = False
    ys, xs = np.nonzero(ok)
    order = np.argsort(-strength[ys, xs], kind="stable")[:most]
    ys, xs = ys[order], xs[order]
    size, turn = np.hypot(gx, gy), np.floor((np.arctan2(gy, gx) + np.pi) / (2 * np.pi) * 8).astype(int) % 8
    out = np.zeros((len(xs), 128))
    weight = np.outer(gaussian(patch, half), gaussian(patch, half))
    cell = (np.arange(patch) * 4 // patch)[:, None] * 4 + (np.arange(patch) * 4 // patch)[None, :]
    for i, (y, x) in enumerate(zip(ys, xs, strict=True)):
        where = np.s_[y - half : y + half, x - half : x + half]
        out[i] = np.bincount((cell * 8 + turn[where]).ravel(), (size[where] * weight).ravel(), 128)
    for clip in (0.2, 1):
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
        out = np.minimum(out, clip)
    return np.stack([xs, ys], axis=1).astype(np.float64), out


def ratio_matches(a: np.ndarray, b: np.ndarray, ratio: float = 0.75, mutual: bool = False) -> np.ndarray:
    """Pairs (i, j) whose nearest neighbour is clearly nearer than the second; mutual: in both directions."""
    if len(a) < 2 or len(b) < 2:
        return np.zeros((0, 2), int)

    def oneway(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out, squares = [], (y**2).sum(1)[None]
        for at in range(0, len(x), BLOCK):
            part = x[at : at + BLOCK]
            d = np.sqrt(np.clip((part**2).sum(1)[:, None] + squares - 2 * part @ y.T, 0, None))
            two = np.argpartition(d, 1, axis=1)[:, :2]
            near = np.take_along_axis(d, two, 1)
            two = np.take_along_axis(two, np.argsort(near, axis=1, kind="stable"), 1)
            near = np.sort(near, axis=1)
            good = np.flatnonzero(near[:, 0] < ratio * near[:, 1])
            out.append(np.stack([at + good, two[good, 0]], axis=1))
        return np.concatenate(out)

    there = oneway(a, b)
    if not mutual:
        return there
    back = {(int(i), int(j)) for j, i in oneway(b, a)}
    return np.array([p for p in there if (int(p[0]), int(p[1])) in back], int).reshape(-1, 2)


def fit_homographies(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """The normalised direct linear transform of each set of points (sets x points x 2); nan where there is none."""

    def norm(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mid = p.mean(axis=1, keepdims=True)
        s = np.sqrt(2) / np.maximum(np.linalg.norm(p - mid, axis=2).mean(axis=1), 1e-12)
        t = np.zeros((len(p), 3, 3))
        t[:, 0, 0] = t[:, 1, 1] = s
        t[:, :2, 2] = -s[:, None] * mid[:, 0]
        t[:, 2, 2] = 1
        back = np.zeros_like(t)
        back[:, 0, 0] = back[:, 1, 1] = 1 / s
        back[:, :2, 2] = mid[:, 0]
        back[:, 2, 2] = 1
        return (p - mid) * s[:, None, None], t, back

    (p, tp, _), (q, _, back) = norm(src), norm(dst)
    x, y, u, v = p[..., 0], p[..., 1], q[..., 0], q[..., 1]
    o, z = np.ones_like(x), np.zeros_like(x)
    a = np.concatenate([np.stack([x, y, o, z, z, z, -u * x, -u * y, -u], 2), np.stack([z, z, z, x, y, o, -v * x, -v * y, -v], 2)], 1)
    # of many points only the 9 x 9 factor is needed; four points have a null vector beyond their 8 rows
    h = back @ np.linalg.svd(np.linalg.qr(a, "r") if a.shape[1] > 9 else a)[2][:, -1].reshape(-1, 3, 3) @ tp
    last = h[:, 2:, 2:]
    return np.where(np.abs(last) > 1e-12, h / np.where(np.abs(last) > 1e-12, last, 1), np.nan)


def fit_homography(src: np.ndarray, dst: np.ndarray) -> np.ndarray | None:
    """The normalised direct linear transform."""
    try:
        h = fit_homographies(src[None], dst[None])[0]
    except np.linalg.LinAlgError:
        return None
    return h if np.isfinite(h).all() else None


def project(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    q = np.c_[p, np.ones(len(p))] @ np.swapaxes(h, -1, -2)
    return q[..., :2] / np.where(np.abs(q[..., 2:]) < 1e-12, 1e-12, q[..., 2:])


def homography(src: np.ndarray, dst: np.ndarray, seed: int, threshold: float = 5.0, rounds: int = ROUNDS, confidence: float = 0.999) -> tuple[np.ndarray | None, np.ndarray, float]:
    """Seeded random sample consensus from src to dst: the matrix, the inlier mask and their root mean square error (infinite without a fit).

    Sampling ends once a sample of inliers only, at the best share of inliers so far, has been drawn with `confidence`; after `rounds` samples at the latest.
    """
    none = None, np.zeros(len(src), bool), float("inf")
    if len(src) < 4:
        return none
    rng, best, done, needed = np.random.default_rng(seed), none[1], 0, float(rounds)
    while done < min(rounds, needed):
        size = min(BATCH, rounds - done)
        done += size
        pick = rng.random((size, len(src))).argpartition(3, axis=1)[:, :4]
        try:
            h = fit_homographies(src[pick], dst[pick])
        except np.linalg.LinAlgError:
            continue
        good = np.linalg.norm(project(h, src) - dst, axis=2) <= threshold
        count = good.sum(axis=1)
        if count.max() > best.sum():
            best = good[count.argmax()]
            clean = (best.sum() / len(src)) ** 4
            needed = np.log(1 - confidence) / np.log1p(-clean) if clean < 1 else 0.0
    if best.sum() < 4:
        return none
    h = fit_homography(src[best], dst[best])
    if h is None:
        return none
    error = np.linalg.norm(project(h, src) - dst, axis=1)
    good = error <= threshold
    return h, good, float(np.sqrt((error[good] ** 2).mean())) if good.any() else float("inf")


def sample(image: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bilinear values; outside, the nearest border pixel."""
    h, w = image.shape
    x, y = np.clip(x, 0, w - 1), np.clip(y, 0, h - 1)
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    x1, y1, fx, fy = np.minimum(x0 + 1, w - 1), np.minimum(y0 + 1, h - 1), x - x0, y - y0
    return (image[y0, x0] * (1 - fx) + image[y0, x1] * fx) * (1 - fy) + (image[y1, x0] * (1 - fx) + image[y1, x1] * fx) * fy


def warp_to_reference(reference: np.ndarray, extracted: np.ndarray, h: np.ndarray) -> np.ndarray:
    """extracted in the reference's frame, h mapping reference to extracted coordinates."""
    ys, xs = np.mgrid[0 : reference.shape[0], 0 : reference.shape[1]]
    at = project(h, np.stack([xs.ravel(), ys.ravel()], 1).astype(float))
    return np.rint(sample(extracted.astype(float), at[:, 0], at[:, 1])).reshape(reference.shape).clip(0, 255).astype(np.uint8)


def ssim(x: np.ndarray, y: np.ndarray) -> float:
    """Mean structural similarity, Gaussian window of 11 and 1.5; 0 where shapes differ."""
    if x.shape != y.shape:
        return 0.0
    k, c1, c2 = gaussian(11, 1.5), (0.01 * 255) ** 2, (0.03 * 255) ** 2
    x, y = x.astype(float), y.astype(float)
    mx, my = filtered(x, k), filtered(y, k)
    vx, vy, cov = filtered(x * x, k) - mx * mx, filtered(y * y, k) - my * my, filtered(x * y, k) - mx * my
    return float(np.clip((((2 * mx * my + c1) * (2 * cov + c2)) / ((mx * mx + my * my + c1) * (vx + vy + c2))).mean(), -1, 1))


def gradient_ssim(x: np.ndarray, y: np.ndarray) -> float:
    return ssim(*(np.hypot(*gradients(i)).clip(0, 255).astype(np.uint8) for i in (x, y))) if x.shape == y.shape else 0.0


def ncc(x: np.ndarray, y: np.ndarray) -> float:
    """Zero-mean normalised correlation; 0 where shapes differ."""
    if x.shape != y.shape:
        return 0.0
    a, b = x - x.mean(), y - y.mean()
    return float(np.clip((a * b).sum() / (np.sqrt((a * a).sum() * (b * b).sum()) + 1e-12), -1, 1))


def ecc_align(reference: np.ndarray, image: np.ndarray, rounds: int = 100, eps: float = 1e-6) -> np.ndarray:
    """image moved onto reference by an affine map that raises the enhanced correlation coefficient (Evangelidis and Psarakis, 2008); the image itself where that fails."""
    t, i = filtered(reference, gaussian(3)), filtered(image, gaussian(3))
    gy, gx = np.gradient(i)
    ys, xs = (m.ravel().astype(float) for m in np.mgrid[0 : t.shape[0], 0 : t.shape[1]])
    p, last = np.array([1.0, 0, 0, 0, 1.0, 0]), -1.0
    flat = t.ravel() - t.mean()
    try:
        for _ in range(rounds):
            x, y = p[0] * xs + p[1] * ys + p[2], p[3] * xs + p[4] * ys + p[5]
            w = sample(i, x, y)
            w = w - w.mean()
            dx, dy = sample(gx, x, y), sample(gy, x, y)
            g = np.stack([dx * xs, dx * ys, dx, dy * xs, dy * ys, dy], 1)
            g -= g.mean(axis=0)
            rho = float(flat @ w / (np.linalg.norm(flat) * np.linalg.norm(w) + 1e-12))
            if abs(rho - last) < eps:
                break
            last = rho
            inverse = np.linalg.inv(g.T @ g)
            gt, gw = g.T @ flat, g.T @ w
            down = float(flat @ w - gt @ inverse @ gw)
            scale = float(w @ w - gw @ inverse @ gw) / down if down > 0 else np.sqrt(float(w @ w - gw @ inverse @ gw) / max(float(flat @ flat - gt @ inverse @ gt), 1e-12))
            p = p + inverse @ (g.T @ (scale * flat - w))
            if not np.isfinite(p).all() or np.abs(p).max() > 1e6:
                return image
    except np.linalg.LinAlgError:
        return image
    moved = sample(image.astype(float), p[0] * xs + p[1] * ys + p[2], p[3] * xs + p[4] * ys + p[5])
    return np.rint(moved).reshape(t.shape).clip(0, 255).astype(np.uint8)


def resized_to(image: np.ndarray, like: np.ndarray) -> np.ndarray:
    return area_resize(image, *like.shape[:2])
