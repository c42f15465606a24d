"""Gathering places by document: buckets of anything else send their places to
buckets of documents, packed in one row per pair of buckets, so that the number
of rows grows with the data and not with documents times buckets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from .common import runs

PACKED = "home int, ids binary, marks binary, counts binary, places binary"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(ids: np.ndarray, marks: np.ndarray, places: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket of documents (id, mark) for places, rows of a matrix
    of 32-bit integers."""
    home = ((ids.view(np.uint64) * _MIX ^ marks.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((marks, ids, home))
    home, ids, marks, places = home[order], ids[order], marks[order], places[order].astype(np.int32)
    edges = np.append(runs(home), len(home))
    rows = []
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        lead = runs(ids[s:e], marks[s:e])
        counts = np.diff(np.append(lead, e - s)).astype(np.int32)
        rows.append((int(home[s]), ids[s:e][lead].tobytes(), marks[s:e][lead].tobytes(), counts.tobytes(), places[s:e].tobytes()))
    kinds = [pa.int32()] + [pa.binary()] * 4
    cols = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["home", "ids", "marks", "counts", "places"])


def unpack(parts: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(id, mark, its places in order) of each document of a bucket."""
    got = []
    for b in parts:
        for r in b.to_pylist():
            counts = np.frombuffer(r["counts"], np.int32)
            got.append((np.repeat(np.frombuffer(r["ids"], np.int64), counts), np.repeat(np.frombuffer(r["marks"], np.int64), counts), np.frombuffer(r["places"], np.int32).reshape(-1, width)))
    if not got:
        return
    ids, marks, places = map(np.concatenate, zip(*got, strict=True))
    del got
    order = np.lexsort((*places.T[::-1], marks, ids))
    ids, marks, places = ids[order], marks[order], places[order]
    edges = np.append(runs(ids, marks), len(ids))
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(ids[s]), int(marks[s]), places[s:e]
