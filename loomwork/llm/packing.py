"""Packed rows for numpy work between shuffles: a column of bytes holds the entries that one task sends to one part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

PACKED = "part int, docs binary, who binary, pos binary"


def pack(values: np.ndarray) -> bytes:
    """Values as byte planes, compressed: sorted or small numbers leave little in the upper planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T if len(values) else np.empty(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()


def split_by(part: np.ndarray):
    """(part, places of its entries) for each part that occurs."""
    order = np.argsort(part, kind="stable")
    names, starts = np.unique(part[order], return_index=True)
    for name, begin, end in zip(names, starts, [*starts[1:], len(part)]):
        yield int(name), order[begin:end]


def entries(part: np.ndarray, doc: np.ndarray, pos: np.ndarray, names: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    """Packed rows of entries (document, position, ...): ``doc`` counts within ``names`` (rows of id and tag)."""
    rows = {"part": [], "docs": [], "who": [], "pos": [], **{k: [] for k in more}}
    for number, at in split_by(part):
        present, local = np.unique(doc[at], return_inverse=True)
        rows["part"].append(number)
        rows["docs"].append(pack(names[present].ravel()))
        rows["who"].append(pack(local.astype(np.uint32)))
        rows["pos"].append(pack(pos[at].astype(np.uint32)))
        for key, values in more.items():
            rows[key].append(pack(values[at]))
    return pa.RecordBatch.from_arrays(
        [pa.array(v, pa.int32() if k == "part" else pa.binary()) for k, v in rows.items()], names=list(rows))


def read_entries(table: pa.Table, **more) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(doc, pos, names, more) of all rows of ``table``; ``doc`` counts within ``names``, one row per document."""
    docs = [unpack(d, np.int64).reshape(-1, 2) for d in table.column("docs").to_pylist()]
    whos = [unpack(w, np.uint32) for w in table.column("who").to_pylist()]
    shift = np.cumsum([0, *map(len, docs)])
    names = np.concatenate(docs) if docs else np.empty((0, 2), np.int64)
    doc = np.concatenate([w.astype(np.int64) + s for w, s in zip(whos, shift)]) if whos else np.empty(0, np.int64)
    # the same document comes from several senders
    names, place = np.unique(names, axis=0, return_inverse=True) if len(names) else (names, np.empty(0, np.int64))
    gathered = {k: np.concatenate([unpack(v, kind) for v in table.column(k).to_pylist()]) if docs else np.empty(0, kind)
                for k, kind in {"pos": np.uint32, **more}.items()}
    return place.ravel()[doc], gathered.pop("pos").astype(np.int64), names, gathered
