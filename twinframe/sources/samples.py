"""Containers and pictures made from rows, for checks without document files."""

from __future__ import annotations

import io
import struct
import zipfile

import numpy as np

from twinframe.kernels import pixels
from twinframe.sources.containers import END, FREE, OLE_MAGIC


def picture(values: list[float], side: int = 64) -> np.ndarray:
    """64 numbers as a colour picture: their 8 x 8 block, enlarged, with one channel reversed."""
    block = np.array(values, float).reshape(8, 8)
    span = max(float(np.ptp(block)), 1e-9)
    gray = ((block - block.min()) / span * 255).astype(np.uint8)
    wide = pixels.area_resize(gray, side, side)
    return np.stack([wide, wide[::-1], np.rint(wide * 0.5).astype(np.uint8)], axis=2)


def zip_document(files: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, data in files.items():
            archive.writestr(zipfile.ZipInfo(name, (2020, 1, 1, 0, 0, 0)), data)
    return out.getvalue()


def compound_document(streams: dict[str, bytes], folder: str = "BinData") -> bytes:
    """A compound file with one folder of streams: 512-byte sectors, streams under 4096 bytes in the small-stream area."""
    sectors: list[bytes] = []
    table: list[int] = []

    def store(data: bytes) -> int:
        if not data:
            return END
        first, n = len(sectors), -(-len(data) // 512)
        for k in range(n):
            sectors.append(data[k * 512 : (k + 1) * 512].ljust(512, b"\0"))
            table.append(first + k + 1 if k + 1 < n else END)
        return first

    mini, mini_table, starts = b"", [], {}
    for name, data in streams.items():
        if len(data) < 4096:
            first, n = len(mini_table), -(-len(data) // 64)
            mini += data.ljust(n * 64, b"\0")
            mini_table += [first + k + 1 if k + 1 < n else END for k in range(n)]
            starts[name] = first if n else END
        else:
            starts[name] = store(data)
    root_start = store(mini)
    mini_start = store(struct.pack(f"<{len(mini_table)}I", *mini_table).ljust(-(-len(mini_table) * 4 // 512) * 512, b"\xff")) if mini_table else END

    def entry(name: str, kind: int, right: int, child: int, start: int, size: int) -> bytes:
        text = name.encode("utf-16-le")[:62]
        return text.ljust(64, b"\0") + struct.pack("<HBBIII", len(text) + 2, kind, 1, FREE, right, child) + bytes(36) + struct.pack("<IQ", start, size)

    names = list(streams)
    rows = [entry("Root Entry", 5, FREE, 1, root_start, len(mini)), entry(folder, 1, FREE, 2 if names else FREE, 0, 0)]
    rows += [entry(n, 2, 3 + k if k + 1 < len(names) else FREE, FREE, starts[n], len(streams[n])) for k, n in enumerate(names)]
    body = b"".join(rows)
    directory = store(body.ljust(-(-len(body) // 512) * 512, b"\0"))
    n_fat = 1
    while n_fat * 128 < len(table) + n_fat:
        n_fat += 1
    places = [len(sectors) + k for k in range(n_fat)]
    words = (table + [0xFFFFFFFD] * n_fat + [FREE] * (n_fat * 128))[: n_fat * 128]
    fat = struct.pack(f"<{len(words)}I", *words)
    header = OLE_MAGIC + bytes(16) + struct.pack("<HHHHH6xIIIIIIIII", 0x3E, 3, 0xFFFE, 9, 6, 0, n_fat, directory, 0, 4096, mini_start, -(-len(mini_table) * 4 // 512), END, 0)
    if n_fat > 109:
        raise ValueError("too large for a sample")
    return (header + struct.pack("<109I", *(places + [FREE] * (109 - n_fat)))).ljust(512, b"\0") + b"".join(sectors) + fat
