"""A shuffle of many small numeric entries by key, packed into one row per task, part and batch."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.arrow import map_batches

Fields = dict[str, np.ndarray]
# Parts a shuffle partition holds; a task has the entries of one part in memory at a time.
PARTS_EACH = 4
# Answers a task gathers before it sends them to be merged.
HELD = 1 << 20

_PACKED = "part int, entries binary, direct binary"
_SHARES = "part int, share binary"


def _pack(fields: Fields, kinds: dict[str, str]) -> bytes:
    return b"".join([np.ascontiguousarray(fields[name], kind).tobytes() for name, kind in kinds.items()])


def _unpack(payloads: list[bytes], kinds: dict[str, str]) -> Fields:
    width = sum(np.dtype(kind).itemsize for kind in kinds.values())
    parts: dict[str, list[np.ndarray]] = {name: [np.zeros(0, kind)] for name, kind in kinds.items()}
    for payload in payloads:
        n, at = len(payload) // width, 0
        for name, kind in kinds.items():
            parts[name].append(np.frombuffer(payload, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(arrays) for name, arrays in parts.items()}


def _dealt(fields: Fields, key: str, kinds: dict[str, str], parts: int) -> list[tuple[int, bytes]]:
    """(part, packed fields) for each part that has any; parts are ranges of the spread 64-bit key."""
    part = ((fields[key].view(np.uint64) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    order = np.argsort(part.astype(np.uint32), kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    sorted_fields = {name: values[order] for name, values in fields.items()}
    return [(k, _pack({m: v[cuts[k] : cuts[k + 1]] for m, v in sorted_fields.items()}, kinds))
            for k in range(parts) if cuts[k] < cuts[k + 1]]


def by_key(
    rows: DataFrame,
    entries: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[Fields, Fields]]],
    answers: Callable[[Fields], Fields],
    kinds: dict[str, str],
    result_kinds: dict[str, str],
    result: T.StructType,
    merged: Callable[[Fields], Fields] | None = None,
) -> DataFrame:
    """Brings entries with equal keys together and returns the answers to them.

    ``entries`` gives batches of fields, the first of ``kinds`` a spread 64-bit
    key, and with each batch answers that are known without a shuffle.
    ``answers`` gets all entries of a part of the keys. Each answer is a row of
    ``result``, whose columns are the ``result_kinds``. Parts follow the number of
    shuffle partitions, so a task's memory follows input over partitions.

    ``merged`` makes one of all answers with the same first column, a spread 64-bit
    number. They go through a second packed shuffle by it, so that the rows returned
    are as many as these numbers, over however many parts their keys are spread.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = n * PARTS_EACH
    key = next(iter(kinds))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fields, known in entries(batches):
            rows = [(k, payload, b"") for k, payload in _dealt(fields, key, kinds, parts)]
            size = len(next(iter(known.values())))
            for at in range(0, size, 65536):
                share = {m: v[at : at + 65536] for m, v in known.items()}
                payload = _pack(share, result_kinds)
                # The part follows from the content: a task that runs again deals its answers alike.
                rows.append((zlib.crc32(payload) % parts, b"", payload))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                     pa.array([r[2] for r in rows], pa.binary())], names=["part", "entries", "direct"])

    def as_batch(fields: Fields) -> pa.RecordBatch:
        kind = {T.LongType: np.int64, T.IntegerType: np.int32}
        arrays = [pa.array(fields[name].astype(kind[type(f.dataType)])) for name, f in zip(result_kinds, result)]
        return pa.RecordBatch.from_arrays(arrays, names=result.names)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[Fields]:
        waiting, current = [], None

        def settle() -> Iterator[Fields]:
            if waiting:
                answered = answers(_unpack(waiting, kinds))
                waiting.clear()
                if len(next(iter(answered.values()))):
                    yield answered

        for batch in batches:
            for part, payload, direct in zip(*(c.to_pylist() for c in batch.columns)):
                if part != current:
                    yield from settle()
                    current = part
                if payload:
                    waiting.append(payload)
                if direct:
                    yield _unpack([direct], result_kinds)
        yield from settle()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(as_batch, found(batches))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent() -> pa.RecordBatch:
            one = merged({name: np.concatenate([h[name] for h in held]) for name in result_kinds})
            ids, payloads = zip(*_dealt(one, next(iter(result_kinds)), result_kinds, parts))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int32()), pa.array(payloads, pa.binary())], names=["part", "share"])

        for fields in found(batches):
            held.append(fields)
            size += len(next(iter(fields.values())))
            if size >= HELD:
                yield sent()
                held, size = [], 0
        if held:
            yield sent()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, current = [], None
        for batch in batches:
            for part, share in zip(*(c.to_pylist() for c in batch.columns)):
                if part != current and waiting:
                    yield as_batch(merged(_unpack(waiting, result_kinds)))
                    waiting = []
                current = part
                waiting.append(share)
        if waiting:
            yield as_batch(merged(_unpack(waiting, result_kinds)))

    def by_part(packed: DataFrame) -> DataFrame:
        return packed.repartitionById(n, (F.col("part") % n).cast("int")).sortWithinPartitions("part")

    dealt = by_part(map_batches(rows, pack, _PACKED))
    if merged is None:
        return map_batches(dealt, answer, result)
    return map_batches(by_part(map_batches(dealt, shares, _SHARES)), total, result)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """The starts of the runs of equal values, and the end."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]))
