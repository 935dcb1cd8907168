"""Image files to pixels and back: JPEG, BMP, GIF and TIFF beside the PNG of `pixels`, numpy and the standard library only."""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from array import array
from collections import Counter

import numpy as np

from twinframe.kernels import pixels

#: Pixels up to which a file is decoded; a header that claims more is taken as damage.
MOST_PIXELS = 1 << 28
#: What damage raises in the decoders.
DAMAGE = (struct.error, zlib.error, ValueError, IndexError, KeyError, TypeError, OverflowError)

# The example quantisation tables of the JPEG standard, luma and chroma, row by row.
LUMA = (
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
)
CHROMA = (
    17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99,
    *[99] * 32,
)

#: Places of the coefficients of a block, row by row, in the order in which files hold them: diagonals in turning directions.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
_K, _X = np.mgrid[:8, :8]
COSINES = np.where(_K == 0, np.sqrt(0.125), 0.5) * np.cos((2 * _X + 1) * _K * np.pi / 16)


def kind_of(data: bytes) -> str | None:
    """jpg, png, gif, bmp or tif by the leading bytes; None for anything that decode() does not read."""
    for head, kind in ((b"\xff\xd8\xff", "jpg"), (pixels.PNG_MAGIC, "png"), (b"GIF87a", "gif"), (b"GIF89a", "gif"), (b"BM", "bmp"), (b"II*\0", "tif"), (b"MM\0*", "tif")):
        if data.startswith(head):
            return kind
    return None


def decode(data: bytes) -> np.ndarray | None:
    """Gray, BGR or BGRA pixels of 8 bits; the first picture of a GIF or TIFF. None for unknown types and damaged files."""
    reader = {"png": pixels.decode_png, "jpg": decode_jpeg, "gif": decode_gif, "bmp": decode_bmp, "tif": decode_tiff}.get(kind_of(data))
    try:
        return reader(data) if reader else None
    except DAMAGE:
        return None


def _sized(w: int, h: int) -> None:
    if not 0 < w * h <= MOST_PIXELS:
        raise ValueError("no such picture")


# JPEG: baseline, extended and progressive Huffman files of 8 bits


def decode_jpeg(data: bytes) -> np.ndarray | None:
    """Chroma is enlarged by a triangle filter. A file that ends early keeps what it holds; arithmetic and lossless files are not read."""
    at, quant, trees, parts, every, transform = 2, {}, {}, [], 0, None
    shape = progressive = None
    while at + 4 <= len(data):
        if data[at] != 0xFF or data[at + 1] in (0x00, 0x01, 0xFF) or 0xD0 <= data[at + 1] <= 0xD8:
            at += 1
            continue
        marker = data[at + 1]
        if marker == 0xD9:
            break
        body = data[at + 4 : at + 2 + struct.unpack_from(">H", data, at + 2)[0]]
        at += 4 + len(body)
        if marker == 0xDB:
            _read_quant(body, quant)
        elif marker == 0xC4:
            _read_trees(body, trees)
        elif marker == 0xDD:
            every = struct.unpack(">H", body[:2])[0]
        elif marker == 0xEE and body[:5] == b"Adobe":
            transform = body[11]
        elif marker in (0xC0, 0xC1, 0xC2):
            progressive = marker == 0xC2
            depth, h, w, n = struct.unpack_from(">BHHB", body)
            _sized(w, h)
            if depth != 8:
                return None
            shape, parts = (h, w), [_Component(*body[6 + 3 * k : 9 + 3 * k]) for k in range(n)]
            tall, wide = max(p.v for p in parts), max(p.h for p in parts)
            for p in parts:
                p.lay(h, w, tall, wide)
        elif 0xC3 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            return None
        elif marker == 0xDA:
            end = re.compile(rb"\xff+[^\x00\xd0-\xd7\xff]").search(data, at)
            stop = end.start() if end else len(data)
            _read_scan(body, data[at:stop], parts, trees, every, progressive)
            at = stop
    if shape is None:
        return None
    planes = [_enlarged(p.plane(quant[p.table]), p, shape, tall, wide) for p in parts]
    return _from_planes(planes, transform, bytes(p.name for p in parts))


class _Component:
    def __init__(self, name: int, sampling: int, table: int) -> None:
        self.name, self.h, self.v, self.table = name, sampling >> 4, sampling & 15, table

    def lay(self, h: int, w: int, tall: int, wide: int) -> None:
        self.size = -(-h * self.v // tall), -(-w * self.h // wide)
        self.own = -(-self.size[0] // 8), -(-self.size[1] // 8)
        self.units = -(-h // (8 * tall)), -(-w // (8 * wide))
        self.blocks = self.units[0] * self.v, self.units[1] * self.h
        self.coefficients = array("i", bytes(4 * 64 * self.blocks[0] * self.blocks[1]))

    def plane(self, quant: np.ndarray) -> np.ndarray:
        rows, columns = self.blocks
        straight = np.zeros((rows * columns, 64))
        straight[:, ZIGZAG] = np.frombuffer(self.coefficients, np.int32).reshape(-1, 64) * quant
        blocks = COSINES.T @ straight.reshape(-1, 8, 8) @ COSINES + 128
        whole = blocks.reshape(rows, columns, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, columns * 8)
        return np.rint(whole[: self.size[0], : self.size[1]]).clip(0, 255)


def _read_quant(body: bytes, quant: dict) -> None:
    at = 0
    while at < len(body):
        wide, name = body[at] >> 4, body[at] & 15
        kind = ">u2" if wide else "u1"
        quant[name] = np.frombuffer(body, kind, 64, at + 1).astype(np.int64)
        at += 1 + 64 * (1 + bool(wide))


def _read_trees(body: bytes, trees: dict) -> None:
    """Every tree as a list over the next 16 bits: code length * 256 + symbol, zero where no code begins so."""
    at = 0
    while at + 17 <= len(body):
        counts, name = body[at + 1 : at + 17], body[at]
        at += 17
        look: list[int] = []
        for length, n in enumerate(counts, 1):
            for symbol in body[at : at + n]:
                look += [length << 8 | symbol] * (1 << (16 - length))
            at += n
        trees[name] = (look + [0] * (65536 - len(look)))[:65536]


def _read_scan(head: bytes, body: bytes, parts: list[_Component], trees: dict, every: int, progressive: bool) -> None:
    n = head[0]
    first, last, shifts = head[1 + 2 * n : 4 + 2 * n]
    named = {p.name: k for k, p in enumerate(parts)}
    chosen = [(named[head[1 + 2 * k]], head[2 + 2 * k]) for k in range(n)]
    state = {k: (parts[k].coefficients, trees.get(t >> 4), trees.get(16 | t & 15)) for k, t in chosen}
    if n == 1:
        k = chosen[0][0]
        rows, columns = parts[k].own
        each = [[(k, 64 * (y * parts[k].blocks[1] + x))] for y in range(rows) for x in range(columns)]
    else:
        rows, columns = parts[chosen[0][0]].units
        each = [
            [(k, 64 * ((my * parts[k].v + y) * parts[k].blocks[1] + mx * parts[k].h + x)) for k, _ in chosen for y in range(parts[k].v) for x in range(parts[k].h)]
            for my in range(rows)
            for mx in range(columns)
        ]
    step = every or len(each)
    for i, piece in enumerate(re.split(rb"\xff+[\xd0-\xd7]", body) if every else [body]):
        units = [u for unit in each[i * step : (i + 1) * step] for u in unit]
        bits = np.frombuffer(piece.replace(b"\xff\x00", b"\xff") + bytes(8), np.uint8).astype(np.int64)
        words = (bits[:-3] << 24 | bits[1:-2] << 16 | bits[2:-1] << 8 | bits[3:]).tolist()
        try:
            if progressive:
                _progressive(words, units, state, first, last, shifts >> 4, shifts & 15)
            else:
                _sequential(words, units, state)
        except IndexError:  # the piece ends early
            continue


def _sequential(words: list[int], units: list[tuple[int, int]], state: dict) -> None:
    p, before = 0, dict.fromkeys(state, 0)
    for part, base in units:
        out, dc, ac = state[part]
        code = dc[words[p >> 3] >> (16 - (p & 7)) & 0xFFFF]
        if not code:
            raise IndexError
        p += code >> 8
        size = code & 255
        if size:
            v = (words[p >> 3] >> (16 - (p & 7)) & 0xFFFF) >> (16 - size)
            p += size
            before[part] += v if v >> (size - 1) else v - (1 << size) + 1
        out[base] = before[part]
        k = 1
        while k < 64:
            code = ac[words[p >> 3] >> (16 - (p & 7)) & 0xFFFF]
            if not code:
                raise IndexError
            p += code >> 8
            size = code & 15
            k += code >> 4 & 15
            if not size:
                if code & 255 != 0xF0:
                    break
                k += 1
                continue
            v = (words[p >> 3] >> (16 - (p & 7)) & 0xFFFF) >> (16 - size)
            p += size
            if k > 63:
                raise IndexError
            out[base + k] = v if v >> (size - 1) else v - (1 << size) + 1
            k += 1


def _progressive(words: list[int], units: list[tuple[int, int]], state: dict, first: int, last: int, done: int, shift: int) -> None:
    p, idle, before, one = 0, 0, dict.fromkeys(state, 0), 1 << shift

    def bits(n: int) -> int:
        nonlocal p
        v = (words[p >> 3] >> (16 - (p & 7)) & 0xFFFF) >> (16 - n)
        p += n
        return v

    def symbol(tree: list[int]) -> int:
        nonlocal p
        code = tree[words[p >> 3] >> (16 - (p & 7)) & 0xFFFF]
        if not code:
            raise IndexError
        p += code >> 8
        return code & 255

    def signed(size: int) -> int:
        v = bits(size)
        return v if v >> (size - 1) else v - (1 << size) + 1

    def refine(out: array, i: int) -> None:
        if bits(1) and not abs(out[i]) & one:
            out[i] += one if out[i] > 0 else -one

    for part, base in units:
        out, dc, ac = state[part]
        if first == 0:
            if done:
                out[base] |= bits(1) << shift
                continue
            size = symbol(dc)
            before[part] += signed(size) if size else 0
            out[base] = before[part] << shift
            continue
        k = first
        if not done:
            if idle:
                idle -= 1
                continue
            while k <= last:
                code = symbol(ac)
                run, size = code >> 4, code & 15
                if size:
                    k += run
                    if k > 63:
                        raise IndexError
                    out[base + k] = signed(size) * one
                elif run < 15:
                    idle = (1 << run) + (bits(run) if run else 0) - 1
                    break
                else:
                    k += 15
                k += 1
            continue
        while not idle and k <= last:
            code = symbol(ac)
            run, size, value = code >> 4, code & 15, 0
            if size:
                value = one if bits(1) else -one
            elif run < 15:
                idle = (1 << run) + (bits(run) if run else 0)
                break
            while k <= last:
                i = base + k
                k += 1
                if out[i]:
                    refine(out, i)
                elif run:
                    run -= 1
                else:
                    out[i] = value
                    break
        if idle:
            idle -= 1
            for i in range(base + k, base + last + 1):
                if out[i]:
                    refine(out, i)


def _enlarged(plane: np.ndarray, part: _Component, shape: tuple[int, int], tall: int, wide: int) -> np.ndarray:
    for axis, times in ((0, tall / part.v), (1, wide / part.h)):
        if times == 2:
            ahead, behind = np.moveaxis(np.pad(plane, [(1, 1) if a == axis else (0, 0) for a in (0, 1)], "edge"), axis, 0), np.moveaxis(plane, axis, 0)
            pairs = np.stack([3 * behind + ahead[:-2], 3 * behind + ahead[2:]], axis=1) / 4
            plane = np.moveaxis(pairs.reshape(-1, behind.shape[1]), 0, axis)
        elif times != 1:
            places = (np.arange(shape[axis]) / times).astype(int).clip(0, plane.shape[axis] - 1)
            plane = np.take(plane, places, axis)
    return plane[: shape[0], : shape[1]]


def _from_planes(planes: list[np.ndarray], transform: int | None, names: bytes) -> np.ndarray | None:
    if len(planes) == 1:
        return np.rint(planes[0]).clip(0, 255).astype(np.uint8)
    if len(planes) not in (3, 4):
        return None
    a, b, c = planes[:3]
    if transform or (transform is None and len(planes) == 3 and names != b"RGB"):
        b, c = b - 128, c - 128
        a, b, c = a + 1.402 * c, a - 0.344136 * b - 0.714136 * c, a + 1.772 * b
    red, green, blue = a, b, c
    if len(planes) == 4:  # files with Adobe's marker hold inverted inks
        inks = [x.clip(0, 255) if transform is not None else 255 - x for x in (red, green, blue)]
        black = planes[3] if transform is not None else 255 - planes[3]
        red, green, blue = (x * black / 255 for x in inks)
    return np.rint(np.stack([blue, green, red], axis=2)).clip(0, 255).astype(np.uint8)


def encode_jpeg(image: np.ndarray, quality: int = 95) -> bytes:
    """A baseline JPEG of gray or BGR pixels; chroma at half size, Huffman codes made for the picture."""
    h, w = image.shape[:2]
    scale = 5000 / max(1, quality) if quality < 50 else 200 - 2 * min(100, quality)
    tables = [np.floor((np.array(t) * scale + 50) / 100).clip(1, 255)[ZIGZAG] for t in (LUMA, CHROMA)]
    if image.ndim == 2:
        groups = [(_coefficients(_padded(image.astype(float), 8), tables[0])[:, None], 0)]
    else:
        blue, green, red = (_padded(image[:, :, k].astype(float), 16) for k in range(3))
        y = 0.299 * red + 0.587 * green + 0.114 * blue
        small = [((x - y) / s + 128).reshape(y.shape[0] // 2, 2, y.shape[1] // 2, 2).mean(axis=(1, 3)) for x, s in ((blue, 1.772), (red, 1.402))]
        rows, columns = y.shape[0] // 16, y.shape[1] // 16
        four = _coefficients(y, tables[0]).reshape(rows, 2, columns, 2, 64).transpose(0, 2, 1, 3, 4).reshape(-1, 4, 64)
        groups = [(four, 0), *((_coefficients(s, tables[1])[:, None], 1) for s in small)]
    for blocks, _ in groups:
        flat = blocks.reshape(-1, 64)
        flat[1:, 0] -= flat[:-1, 0].copy()
    blocks = np.concatenate([g for g, _ in groups], axis=1)
    chroma = np.concatenate([np.full(g.shape[1], c) for g, c in groups])
    body, trees = _entropy_coded(blocks.reshape(-1, 64), np.tile(chroma, len(blocks)))

    def segment(marker: int, data: bytes) -> bytes:
        return struct.pack(">BBH", 0xFF, marker, len(data) + 2) + data

    n = len(groups)
    kinds = [c for _, c in groups]
    frame = struct.pack(">BHHB", 8, h, w, n) + b"".join(bytes([k + 1, 0x22 if n == 3 and k == 0 else 0x11, kinds[k]]) for k in range(n))
    scan = bytes([n]) + b"".join(bytes([k + 1, 0x11 * kinds[k]]) for k in range(n)) + bytes([0, 63, 0])
    quant = b"".join(segment(0xDB, bytes([c]) + tables[c].astype(np.uint8).tobytes()) for c in sorted(set(kinds)))
    codes = b"".join(segment(0xC4, bytes([name]) + bytes(counts) + bytes(symbols)) for name, (counts, symbols) in sorted(trees.items()))
    start = segment(0xE0, b"JFIF\0" + struct.pack(">HBHHBB", 0x0101, 0, 1, 1, 0, 0))
    return b"\xff\xd8" + start + quant + segment(0xC0, frame) + codes + segment(0xDA, scan) + body + b"\xff\xd9"


def _padded(plane: np.ndarray, to: int) -> np.ndarray:
    return np.pad(plane, [(0, -plane.shape[0] % to), (0, -plane.shape[1] % to)], "edge")


def _coefficients(plane: np.ndarray, quant: np.ndarray) -> np.ndarray:
    rows, columns = plane.shape[0] // 8, plane.shape[1] // 8
    blocks = (plane - 128).reshape(rows, 8, columns, 8).transpose(0, 2, 1, 3).reshape(-1, 8, 8)
    return np.rint((COSINES @ blocks @ COSINES.T).reshape(-1, 64)[:, ZIGZAG] / quant).astype(np.int64)


def _entropy_coded(blocks: np.ndarray, chroma: np.ndarray) -> tuple[bytes, dict]:
    """The coded blocks (differences first) and the trees by name: 0 and 1 for first coefficients, 16 and 17 for the others."""
    size_of = np.zeros(1 << 12, np.int64)
    for k in range(12):
        size_of[1 << k :] = k + 1
    rows, places = np.nonzero(blocks[:, 1:])
    places += 1
    fresh = np.concatenate([[True], rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, bool)
    gap = places - np.where(fresh, 0, np.concatenate([[0], places[:-1]])[: len(places)]) - 1
    value = blocks[rows, places]
    last = np.zeros(len(blocks), np.int64)
    np.maximum.at(last, rows, places)
    short = np.nonzero(last < 63)[0]
    long_gap = gap // 16
    far = np.repeat(np.arange(len(rows)), long_gap)
    first = blocks[:, 0]
    # tokens: block, order in the block, tree, symbol, value
    tokens = [
        (np.arange(len(blocks)), np.zeros(len(blocks), np.int64), chroma, size_of[np.abs(first)], first),
        (rows[far], places[far] * 2 - 1, 16 + chroma[rows[far]], np.full(len(far), 0xF0), np.zeros(len(far), np.int64)),
        (rows, places * 2, 16 + chroma[rows], gap % 16 * 16 + size_of[np.abs(value)], value),
        (short, np.full(len(short), 200), 16 + chroma[short], np.zeros(len(short), np.int64), np.zeros(len(short), np.int64)),
    ]
    block, order, tree, symbol, value = (np.concatenate(x) for x in zip(*tokens, strict=True))
    sort = np.lexsort((order, block))
    tree, symbol, value = tree[sort], symbol[sort], value[sort]
    size = np.where(tree < 16, symbol, symbol & 15)
    codes, lengths, trees = np.zeros(len(tree), np.int64), np.zeros(len(tree), np.int64), {}
    for name in np.unique(tree):
        here = tree == name
        counts, symbols, by_symbol = _tree(Counter(symbol[here].tolist()))
        trees[int(name)] = counts, symbols
        table = np.zeros((256, 2), np.int64)
        for s, pair in by_symbol.items():
            table[s] = pair
        codes[here], lengths[here] = table[symbol[here]].T
    whole = codes << size | np.where(value < 0, value + (1 << size) - 1, value)
    total = lengths + size
    ends = np.cumsum(total)
    owner = np.repeat(np.arange(len(total)), total)
    bits = whole[owner] >> (ends[owner] - 1 - np.arange(len(owner))) & 1
    bits = np.concatenate([bits, np.ones(-len(bits) % 8, np.int64)])
    return np.packbits(bits.astype(np.uint8)).tobytes().replace(b"\xff", b"\xff\x00"), trees


def _tree(counted: Counter) -> tuple[list[int], list[int], dict[int, tuple[int, int]]]:
    """Codes of at most 16 bits, none of ones alone: how many of each length, symbols in order, and each symbol's code and length."""
    heap = [(n, s, (s,)) for s, n in counted.items()] + [(0, -1, (-1,))]
    heapq.heapify(heap)
    depth = Counter()
    while len(heap) > 1:
        (n, a, x), (m, b, y) = heapq.heappop(heap), heapq.heappop(heap)
        for s in x + y:
            depth[s] += 1
        heapq.heappush(heap, (n + m, min(a, b), x + y))
    many = Counter(depth.values())
    for i in range(max(many), 16, -1):  # two leaves too deep move up beside a split leaf
        while many[i]:
            j = max(k for k in range(1, i - 1) if many[k])
            many[i] -= 2
            many[i - 1] += 1
            many[j + 1] += 2
            many[j] -= 1
    many[max(k for k in many if many[k])] -= 1
    counts = [many[k] for k in range(1, 17)]
    symbols = sorted(counted, key=lambda s: (depth[s], s))
    out, code, at = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for s in symbols[at : at + n]:
            out[s] = code, length
            code += 1
        at += n
        code <<= 1
    return counts, symbols, out


# BMP


def decode_bmp(data: bytes) -> np.ndarray | None:
    """1 to 32 bits a pixel, without run lengths. An alpha channel is dropped, as its bytes are often void."""
    offset, head = struct.unpack_from("<II", data, 10)
    if head == 12:
        w, h, _, depth = struct.unpack_from("<HHHH", data, 18)
        packed, used = 0, 0
    else:
        w, h, _, depth, packed = struct.unpack_from("<iiHHI", data, 18)
        used = struct.unpack_from("<I", data, 46)[0]
    _sized(w, abs(h))
    if packed not in (0, 3):
        return None
    stride = (w * depth + 31) // 32 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), offset).reshape(abs(h), stride)
    rows = rows if h < 0 else rows[::-1]
    if depth <= 8:
        step = 3 if head == 12 else 4
        n = used or 1 << depth
        palette = np.frombuffer(data, np.uint8, n * step, 14 + head).reshape(n, step)[:, :3]
        image = palette[pixels.unpacked(rows, depth, w)]
        flat = (palette[:, :1] == palette).all()
        return np.ascontiguousarray(image[:, :, 0] if flat else image)
    if depth == 24:
        return np.ascontiguousarray(rows[:, : w * 3].reshape(-1, w, 3))
    kind, masks = ("<u2", (0x1F, 0x3E0, 0x7C00)) if depth == 16 else ("<u4", (0xFF, 0xFF00, 0xFF0000))
    if packed == 3:
        masks = struct.unpack_from("<III", data, 54)[::-1]
    values = np.ascontiguousarray(rows).view(kind)[:, :w].astype(np.int64)
    planes = [(values & m) // (m & -m) * 255 // (m // (m & -m)) for m in masks]
    return np.stack(planes, axis=2).astype(np.uint8)


def encode_bmp(image: np.ndarray) -> bytes:
    """24 bits a pixel, or 8 with a gray palette; as in `encode_png`, alpha has no place."""
    h, w = image.shape[:2]
    depth = 8 if image.ndim == 2 else 24
    rows = np.ascontiguousarray(image[::-1]).reshape(h, -1)
    body = np.pad(rows, [(0, 0), (0, -rows.shape[1] % 4)]).tobytes()
    palette = b"" if depth == 24 else np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, axis=1).tobytes()
    start = 54 + len(palette)
    return struct.pack("<2sIII", b"BM", start + len(body), 0, start) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, depth, 0, len(body), 2835, 2835, 0, 0) + palette + body


# GIF and TIFF


def _lzw(data: bytes, bits: int, from_top: bool) -> bytes:
    """LZW with a clear and an end code; from_top: codes run from the highest bit down and widen one code early."""
    clear, out, buffer, held, at = 1 << bits, [], 0, 0, 0
    table, width, before = [], bits + 1, None
    singles = [bytes([k]) for k in range(clear)] + [b"", b""]
    while True:
        while held < width:
            if at == len(data):
                return b"".join(out)
            buffer = buffer << 8 | data[at] if from_top else buffer | data[at] << held
            held, at = held + 8, at + 1
        held -= width
        if from_top:
            code, buffer = buffer >> held, buffer & (1 << held) - 1
        else:
            code, buffer = buffer & (1 << width) - 1, buffer >> width
        if code == clear:
            table, width, before = list(singles), bits + 1, None
            continue
        if code == clear + 1:
            return b"".join(out)
        if before is None:
            table = table or list(singles)
            entry = table[code]
        else:
            entry = table[code] if code < len(table) else before + before[:1]
            if len(table) < 4096:
                table.append(before + entry[:1])
        out.append(entry)
        before = entry
        if len(table) + from_top >= 1 << width and width < 12:
            width += 1


def decode_gif(data: bytes) -> np.ndarray | None:
    """The first picture on its canvas, in BGR; transparency is dropped."""
    w, h, flags, ground = struct.unpack_from("<HHBB", data, 6)
    _sized(w, h)
    at, palette = 13, None

    def colours(flags: int) -> np.ndarray:
        n = 2 << (flags & 7)
        return np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)[:, ::-1]

    if flags & 0x80:
        palette = colours(flags)
        at += palette.size
    while data[at] != 0x2C:
        if data[at] != 0x21:
            return None
        at += 2
        while data[at]:
            at += 1 + data[at]
        at += 1
    left, top, wide, tall, flags = struct.unpack_from("<HHHHB", data, at + 1)
    _sized(wide, tall)
    at += 10
    canvas = np.zeros((h, w, 3), np.uint8)
    if palette is not None and ground < len(palette):
        canvas[:] = palette[ground]
    if flags & 0x80:
        palette = colours(flags)
        at += palette.size
    bits, body = data[at], []
    at += 1
    while data[at]:
        body.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    places = np.frombuffer(_lzw(b"".join(body), bits, False)[: wide * tall].ljust(wide * tall, b"\0"), np.uint8).reshape(tall, wide)
    if flags & 0x40:
        order = np.concatenate([np.arange(s, tall, d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])
        places = places[np.argsort(order)]
    part = canvas[top : top + tall, left : left + wide]
    part[:] = palette[places][: part.shape[0], : part.shape[1]]
    return canvas


def decode_tiff(data: bytes) -> np.ndarray | None:
    """Strips of 1, 4, 8 or 16 bits a sample: plain, LZW, deflate or run lengths; gray, palette or RGB with samples side by side."""
    end = "<" if data[:2] == b"II" else ">"
    at = struct.unpack_from(end + "I", data, 4)[0]
    tags = {}
    for k in range(struct.unpack_from(end + "H", data, at)[0]):
        name, kind, n = struct.unpack_from(end + "HHI", data, at + 2 + 12 * k)
        letter = {1: "B", 3: "H", 4: "I"}.get(kind)
        if letter:
            place = at + 10 + 12 * k
            if n * struct.calcsize(letter) > 4:
                place = struct.unpack_from(end + "I", data, place)[0]
            tags[name] = struct.unpack_from(f"{end}{n}{letter}", data, place)
    w, h, depth, packed, light, samples = (tags.get(t, (d,))[0] for t, d in ((256, 0), (257, 0), (258, 1), (259, 1), (262, 1), (277, 1)))
    _sized(w, h)
    if 273 not in tags or tags.get(284, (1,))[0] != 1 or packed not in (1, 5, 8, 32946, 32773) or light > 3 or depth not in (1, 4, 8, 16):
        return None
    stride, per = (w * samples * depth + 7) // 8, min(h, tags.get(278, (h,))[0])
    body = b""
    for k, (place, size) in enumerate(zip(tags[273], tags[279], strict=True)):
        rows = min(per, h - k * per)
        strip = data[place : place + size]
        if packed == 5:
            strip = _lzw(strip, 8, True)
        elif packed in (8, 32946):
            strip = zlib.decompress(strip)
        elif packed == 32773:
            strip = _unpacked_runs(strip)
        body += strip[: rows * stride].ljust(rows * stride, b"\0")
    rows = np.frombuffer(body, np.uint8)[: h * stride].reshape(h, stride)
    if depth == 16:
        values = rows.view(end + "u2").reshape(h, w, samples)
    else:
        values = pixels.unpacked(rows, depth, w * samples).reshape(h, w, samples)
    if tags.get(317, (1,))[0] == 2:
        values = np.cumsum(values, axis=1, dtype=np.uint16 if depth == 16 else np.uint8)
    if light == 3:
        table = (np.array(tags[320]).reshape(3, -1) >> 8).astype(np.uint8)
        return np.stack([table[k][values[:, :, 0]] for k in (2, 1, 0)], axis=2)
    values = (values >> 8 if depth == 16 else values * (255 // ((1 << depth) - 1))).astype(np.uint8)
    if light == 2:
        return np.ascontiguousarray(values[:, :, [2, 1, 0, 3][: min(4, samples)]])
    return np.ascontiguousarray(255 - values[:, :, 0] if light == 0 else values[:, :, 0])


def _unpacked_runs(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            at += 2 + n
        else:
            if n > 128:
                out.append(data[at + 1 : at + 2] * (257 - n))
            at += 2
    return b"".join(out)
