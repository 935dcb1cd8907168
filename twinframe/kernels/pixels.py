"""Decoding, colour, geometry and contrast."""

from __future__ import annotations

import struct
import zlib

import numpy as np

PNG_MAGIC = bytes.fromhex("89504E470D0A1A0A")
# First row, first column, row step and column step of the seven passes of an interlaced PNG.
ADAM7 = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))
#: Rows whose filters are undone together.
BAND = 256


def encode_png(image: np.ndarray, level: int = 3) -> bytes:
    """A PNG of 8-bit gray or colour (BGR in, RGB out), unfiltered rows."""
    h, w = image.shape[:2]
    rows = image if image.ndim == 2 else image[:, :, ::-1]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rows.reshape(h, -1)], axis=1).tobytes()

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", w, h, 8, 0 if image.ndim == 2 else 2, 0, 0, 0)
    return PNG_MAGIC + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, level)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray | None:
    """Pixels of 8 bits of any PNG: gray (alpha dropped), BGR or BGRA; palettes become colours, 16 bits their upper eight. None for anything else."""
    if not data.startswith(PNG_MAGIC):
        return None
    at, body, parts = 8, [], {}
    try:
        while at + 8 <= len(data):
            size, kind = struct.unpack(">I4s", data[at : at + 8])
            part = data[at + 8 : at + 8 + size]
            if kind == b"IDAT":
                body.append(part)
            else:
                parts.setdefault(kind, part)
            at += 12 + size
        w, h, depth, kind, _, _, interlaced = struct.unpack(">IIBBBBB", parts[b"IHDR"])
        channels = {0: 1, 3: 1, 4: 2, 2: 3, 6: 4}[kind]
        raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
        image = np.zeros((h, w, channels), np.uint8)
        for y, x, down, right in ADAM7 if interlaced else ((0, 0, 1, 1),):
            rows, columns = len(range(y, h, down)), len(range(x, w, right))
            if rows and columns:
                stride = 1 + (columns * channels * depth + 7) // 8
                image[y::down, x::right] = _samples(_filtered_rows(raw[: rows * stride].reshape(rows, stride), max(1, channels * depth // 8)), depth, columns, channels, kind != 3)
                raw = raw[rows * stride :]
        if kind == 3:
            palette = np.frombuffer(parts[b"PLTE"], np.uint8).reshape(-1, 3)
            if b"tRNS" in parts:
                alpha = np.frombuffer(parts[b"tRNS"].ljust(len(palette), b"\xff")[: len(palette)], np.uint8)
                palette = np.concatenate([palette, alpha[:, None]], axis=1)
            image = palette[image[:, :, 0]]
    except (struct.error, zlib.error, KeyError, TypeError, ValueError, IndexError):
        return None
    if image.shape[2] <= 2:
        return np.ascontiguousarray(image[:, :, 0])
    return np.ascontiguousarray(image[:, :, [2, 1, 0, 3][: image.shape[2]]])


def unpacked(rows: np.ndarray, depth: int, n: int) -> np.ndarray:
    """The first n values of `depth` bits (1, 2, 4 or 8) of each row of bytes, high bits first."""
    if depth == 8:
        return rows[:, :n]
    bits = np.unpackbits(rows, axis=1).reshape(len(rows), -1, depth)[:, :n]
    return (bits << np.arange(depth - 1, -1, -1, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)


def _samples(rows: np.ndarray, depth: int, w: int, channels: int, spread: bool) -> np.ndarray:
    if depth == 16:
        rows, depth = rows[:, ::2], 8
    values = unpacked(rows, depth, w * channels)
    return (values * (255 // ((1 << depth) - 1)) if spread else values).reshape(len(rows), w, channels)


def _filtered_rows(raw: np.ndarray, channels: int) -> np.ndarray:
    """The rows (filter kind, then bytes) without their filters; runs of rows that need their left and upper neighbours go together."""
    kinds, out = raw[:, 0], np.zeros((len(raw), raw.shape[1] - 1), np.uint8)
    if kinds.max(initial=0) > 4:
        raise ValueError("no such filter")
    y, before = 0, np.zeros(raw.shape[1] - 1, np.uint8)
    while y < len(raw):
        n = 1
        if kinds[y] > 2:
            while n < BAND and y + n < len(raw) and kinds[y + n] > 0:
                n += 1
            out[y : y + n] = _unfiltered_band(kinds[y : y + n], raw[y : y + n, 1:], before, channels)
        else:
            out[y] = _unfiltered(int(kinds[y]), raw[y, 1:], before, channels)
        y += n
        before = out[y - 1]
    return out


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, channels: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 1:
        return np.cumsum(line.reshape(-1, channels), axis=0, dtype=np.uint8).ravel()
    if kind == 2:
        return line + above
    return _unfiltered_band(np.array([kind]), line[None], above, channels)[0]


def _unfiltered_band(kinds: np.ndarray, lines: np.ndarray, above: np.ndarray, channels: int) -> np.ndarray:
    """A diagonal at a time: a pixel depends on the diagonals before its own only, so all pixels of one are found together."""
    n, w = len(lines), lines.shape[1] // channels
    y, x = np.mgrid[:n, :w]
    todo = np.zeros((w + n - 1, n, channels), np.int16)
    todo[x + y, y] = lines.reshape(n, w, channels)
    done = np.zeros((w + n + 1, n + 1, channels), np.int16)
    done[1 : w + 1, 0] = above.reshape(w, channels)
    for d in range(w + n - 1):
        lo, hi = max(0, d - w + 1), min(n, d + 1)
        left, up, corner, kind = done[d + 1, lo + 1 : hi + 1], done[d + 1, lo:hi], done[d, lo:hi], kinds[lo:hi, None]
        to_left, to_up, to_corner = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        nearest = np.where((to_left <= to_up) & (to_left <= to_corner), left, np.where(to_up <= to_corner, up, corner))
        guess = np.where(kind == 4, nearest, np.where(kind == 3, (left + up) >> 1, np.where(kind == 2, up, np.where(kind == 1, left, 0))))
        done[d + 2, lo + 1 : hi + 1] = (todo[d, lo:hi] + guess) & 255
    return done[x + y + 2, y + 1].reshape(n, -1).astype(np.uint8)


def colour(image: np.ndarray) -> np.ndarray:
    """Any image as BGR; alpha is dropped."""
    return np.repeat(image[:, :, None], 3, axis=2) if image.ndim == 2 else image[:, :, :3]


def gray(image: np.ndarray) -> np.ndarray:
    if image.ndim == 2:
        return image
    weighed = image[:, :, 0] * 0.114 + image[:, :, 1] * 0.587 + image[:, :, 2] * 0.299
    return np.rint(weighed).clip(0, 255).astype(np.uint8)


def filtered(image: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """A separable filter with mirrored borders (the edge pixel is not repeated)."""
    r = len(kernel) // 2
    out = image.astype(np.float64)
    for axis in (0, 1):
        pad = [(0, 0)] * out.ndim
        pad[axis] = (r, r)
        padded = np.pad(out, pad, "reflect" if out.shape[axis] > r else "edge")
        windows = np.lib.stride_tricks.sliding_window_view(padded, len(kernel), axis)
        out = windows @ kernel
    return out


def gaussian(size: int, sigma: float | None = None) -> np.ndarray:
    sigma = sigma or 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    x = np.arange(size) - size // 2
    k = np.exp(-(x**2) / (2 * sigma**2))
    return k / k.sum()


def gradients(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = np.pad(image.astype(np.float64), 1, "reflect" if min(image.shape) > 1 else "edge")
    gx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
    gy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
    return gx, gy


def spread(seed: np.ndarray, within: np.ndarray) -> np.ndarray:
    """All of `within` that is joined to `seed` over eight neighbours."""
    out = seed & within
    while True:
        p = np.pad(out, 1)
        wider = within & (p[:-2, :-2] | p[:-2, 1:-1] | p[:-2, 2:] | p[1:-1, :-2] | p[1:-1, 1:-1] | p[1:-1, 2:] | p[2:, :-2] | p[2:, 1:-1] | p[2:, 2:])
        if (wider == out).all():
            return out
        out = wider


def edges(image: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """Canny edges: gradient maxima along the gradient, strong ones and the weak ones joined to them."""
    gx, gy = gradients(image)
    size = np.abs(gx) + np.abs(gy)
    p = np.pad(size, 1)
    near = lambda dy, dx: p[1 + dy : p.shape[0] - 1 + dy, 1 + dx : p.shape[1] - 1 + dx]
    ax, ay, same = np.abs(gx), np.abs(gy), gx * gy >= 0
    flat, steep = ay < 0.4142 * ax, ay > 2.4142 * ax
    first = np.where(flat, near(0, -1), np.where(steep, near(-1, 0), np.where(same, near(-1, -1), near(-1, 1))))
    second = np.where(flat, near(0, 1), np.where(steep, near(1, 0), np.where(same, near(1, 1), near(1, -1))))
    ridge = (size > first) & (size >= second)
    return spread(ridge & (size > high), ridge & (size > low))


def edge_density(image: np.ndarray) -> float:
    smooth = np.rint(filtered(gray(image), gaussian(3))).astype(np.uint8)
    return float(edges(smooth).mean())


def area_resize(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Each target pixel is the mean of the source area it covers; where an axis grows, linear interpolation."""
    out = image.astype(np.float64)
    for axis, size in ((0, h), (1, w)):
        n = out.shape[axis]
        if size <= n:
            border = np.arange(size + 1) * n / size
            weights = np.clip(np.minimum(border[1:, None], np.arange(1, n + 1)) - np.maximum(border[:-1, None], np.arange(n)), 0, None) * size / n
        else:
            at = np.clip((np.arange(size) + 0.5) * n / size - 0.5, 0, n - 1)
            lo = np.floor(at).astype(int)
            weights = np.zeros((size, n))
            weights[np.arange(size), lo] = 1 - (at - lo)
            weights[np.arange(size), np.minimum(lo + 1, n - 1)] += at - lo
        out = np.moveaxis(np.tensordot(weights, out, (1, axis)), 0, axis)
    return np.rint(out).clip(0, 255).astype(np.uint8)


def letterbox(image: np.ndarray, side: int, multiple: int = 16, mode: str = "edge", constant: tuple[int, int, int] = (114, 114, 114)) -> tuple[np.ndarray, float, tuple[int, int, int, int]]:
    """Fitted to `side` (also enlarged) and padded to a multiple on both axes: image, scale, (top, bottom, left, right). mode: edge, reflect, constant or none."""
    h, w = image.shape[:2]
    scale = side / max(h, w)
    nh, nw = max(1, round(h * scale)), max(1, round(w * scale))
    out = area_resize(colour(image), nh, nw)
    if mode == "none":
        return out, scale, (0, 0, 0, 0)
    ph, pw = -nh % multiple, -nw % multiple
    pads = (ph // 2, ph - ph // 2, pw // 2, pw - pw // 2)
    if mode == "constant":
        full = np.empty((nh + ph, nw + pw, 3), np.uint8)
        full[:] = constant
        full[pads[0] : pads[0] + nh, pads[2] : pads[2] + nw] = out
        return full, scale, pads
    mode = "edge" if mode == "edge" or min(nh, nw) <= max(pads) else "reflect"
    return np.pad(out, ((pads[0], pads[1]), (pads[2], pads[3]), (0, 0)), mode), scale, pads


def auto_trim(image: np.ndarray, least_area: float = 0.2, margin: float = 0.01) -> tuple[np.ndarray, tuple[int, int, int, int]]:
    """The image cut to the box of its edges plus a margin, and the removed (top, bottom, left, right); unchanged where the box is a small part of it."""
    h, w = image.shape[:2]
    found = edges(np.rint(filtered(gray(image), gaussian(5))).astype(np.uint8))
    ys, xs = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
    if not len(ys) or (ys[-1] - ys[0] + 1) * (xs[-1] - xs[0] + 1) < least_area * h * w:
        return image, (0, 0, 0, 0)
    my, mx = round(h * margin), round(w * margin)
    top, bottom = max(0, int(ys[0]) - my), min(h, int(ys[-1]) + 1 + my)
    left, right = max(0, int(xs[0]) - mx), min(w, int(xs[-1]) + 1 + mx)
    return image[top:bottom, left:right], (top, h - bottom, left, w - right)


def clahe(channel: np.ndarray, clip: float = 2.0, grid: int = 8) -> np.ndarray:
    """Contrast-limited equalisation by tiles, blended between tile centres."""
    h, w = channel.shape
    th, tw = -(-h // grid), -(-w // grid)
    padded = np.pad(channel, ((0, th * grid - h), (0, tw * grid - w)), "symmetric" if min(h, w) >= max(th * grid - h, tw * grid - w) else "edge")
    tiles = padded.reshape(grid, th, grid, tw).swapaxes(1, 2).reshape(grid * grid, th * tw)
    counts = np.stack([np.bincount(t, minlength=256) for t in tiles]).astype(np.float64)
    limit = max(1.0, clip * th * tw / 256)
    over = np.clip(counts - limit, 0, None).sum(axis=1, keepdims=True)
    table = np.cumsum(np.minimum(counts, limit) + over / 256, axis=1) * 255 / (th * tw)
    table = table.reshape(grid, grid, 256)
    y, x = np.clip((np.arange(h) + 0.5) / th - 0.5, 0, grid - 1), np.clip((np.arange(w) + 0.5) / tw - 0.5, 0, grid - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, grid - 1), np.minimum(x0 + 1, grid - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    pick = lambda a, b: table[a[:, None], b[None, :], channel]
    out = (1 - fy) * ((1 - fx) * pick(y0, x0) + fx * pick(y0, x1)) + fy * ((1 - fx) * pick(y1, x0) + fx * pick(y1, x1))
    return np.rint(out).clip(0, 255).astype(np.uint8)


def lab_clahe(image: np.ndarray, clip: float = 2.0, grid: int = 8) -> np.ndarray:
    """Equalised lightness (CIE L*a*b*, D65); colours keep their a and b."""
    bgr = colour(image).astype(np.float64) / 255
    linear = np.where(bgr > 0.04045, ((bgr + 0.055) / 1.055) ** 2.4, bgr / 12.92)[:, :, ::-1]
    m = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]])
    white = np.array([0.950456, 1.0, 1.088754])
    xyz = linear @ m.T / white
    f = np.where(xyz > 0.008856, np.cbrt(xyz), 7.787 * xyz + 16 / 116)
    light = 116 * f[:, :, 1] - 16
    lifted = clahe(np.rint(light * 2.55).clip(0, 255).astype(np.uint8), clip, grid) / 2.55
    fy = (lifted + 16) / 116
    g = np.stack([fy + f[:, :, 0] - f[:, :, 1], fy, fy - (f[:, :, 1] - f[:, :, 2])], axis=2)
    back = np.where(g**3 > 0.008856, g**3, (g - 16 / 116) / 7.787) * white @ np.linalg.inv(m).T
    back = np.clip(back, 0, 1)
    srgb = np.where(back > 0.0031308, 1.055 * back ** (1 / 2.4) - 0.055, 12.92 * back)
    return np.rint(srgb[:, :, ::-1] * 255).clip(0, 255).astype(np.uint8)


def hash_block(image: np.ndarray) -> np.ndarray:
    """The 63 low-frequency cosine coefficients (8 x 8 of 32 x 32, row by row, without the mean)."""
    small = area_resize(gray(image), 32, 32).astype(np.float64)
    k, n = np.arange(32)[:, None], np.arange(32)[None, :]
    basis = np.cos(np.pi * (2 * n + 1) * k / 64) * np.where(k == 0, np.sqrt(1 / 32), np.sqrt(2 / 32))
    return (basis @ small @ basis.T)[:8, :8].ravel()[1:]


def hsv_histogram(image: np.ndarray, bins: tuple[int, int, int] = (16, 8, 8)) -> np.ndarray:
    """Shares of hue (0-180), saturation and value bins."""
    b, g, r = (colour(image)[:, :, i].astype(np.float64) for i in range(3))
    top, low = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    span = np.where(top > low, top - low, 1)
    hue = np.where(top == r, (g - b) / span, np.where(top == g, 2 + (b - r) / span, 4 + (r - g) / span)) * 30 % 180
    hue = np.where(top > low, np.rint(hue) % 180, 0)
    saturation = np.where(top > 0, np.rint(255 * (top - low) / np.where(top > 0, top, 1)), 0)
    place = [np.minimum((v * n // limit).astype(int), n - 1) for v, n, limit in ((hue, bins[0], 180), (saturation, bins[1], 256), (top, bins[2], 256))]
    counts = np.bincount((place[0] * bins[1] + place[1]).ravel() * bins[2] + place[2].ravel(), minlength=bins[0] * bins[1] * bins[2])
    return counts / max(1, counts.sum())
