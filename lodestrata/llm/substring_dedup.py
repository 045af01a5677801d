"""Repeated substrings by refinement of buckets of positions.

Positions with equal q-grams are one bucket. A bucket's name together with the
name of the bucket at a later offset names a bucket of longer strings: names for
q and offset q give names for 2q, which are used again for 4q, and so on up to
256 bytes, and 256 bytes at offset 144 give the 400 bytes asked for. Names are
made from names alone, so a task refines its own texts without others; what needs
a shuffle is which buckets have a second position. Buckets without one are
dropped as early as that can be told:

1. Coarse buckets, only at anchors. The anchor of a 400-byte string is the position
   of the least 16-gram among its first 144, and the 256 bytes from there on lie in
   the string: if these are alone, so is the string. Strings that follow each other
   mostly have the same anchor. With each anchor goes the name of all of them
   together: if that is shared, all are repeated and settled at once.
2. Fine buckets: the single 400-byte strings at anchors whose bucket is shared but
   has members that differ, as at the ends of copied passages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.arrow import map_batches
from lodestrata.llm.packed import Fields, by_key, runs
from lodestrata.llm.shingles import mix, slices
from lodestrata.llm.tables import likely_rows, numbered, stored

# Fixed relation of the three: SPAN - WINDOW + 1 covers HALF, and SPAN is at most twice HALF.
SPAN, HALF, WINDOW, GRAM = 400, 256, 144, 16
# Entries a task packs at once.
CHUNK = 1 << 19
_U = np.uint64
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_FACTORS = mix(np.arange(1001, 1033, dtype=np.uint64)) | _U(1)


def bucket_names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the GRAM-byte and of the HALF-byte buckets of all positions that have so many bytes after them."""
    names, q, grams = _BYTE[data], 1, None
    while q < HALF and len(names) > q:
        longer = names[:-q] * _FACTORS[q.bit_length()]
        longer += names[q:]
        longer ^= longer >> _U(29)
        names, q = longer, 2 * q
        if q == GRAM:
            grams = names
    return (grams if grams is not None else names[:0]), (names if q == HALF else names[:0])


def anchors(grams: np.ndarray, n_windows: int) -> np.ndarray:
    """For each string's start the position of the least gram among WINDOW positions, of equals the first.

    It depends on the string alone, and never goes back from one start to the next.
    """
    weights = grams[: n_windows + WINDOW - 1] * _FACTORS[31]
    least = (weights & _U(0xFFFFFFFF00000000)) | np.arange(len(weights), dtype=_U)
    have = 1
    while have < WINDOW:
        step = min(have, WINDOW - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return (least & _U(0xFFFFFFFF)).astype(np.int64)


def coarse(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket name at the anchor, name of all its strings, first start, last start) for each anchor."""
    n_windows = len(data) - SPAN + 1
    if n_windows <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(_U), none.astype(_U), none, none
    grams, halves = bucket_names(data)
    chosen = anchors(grams, n_windows)
    cuts = runs(chosen)
    first, last = cuts[:-1], cuts[1:] - 1
    at = chosen[first]
    end = last + SPAN - HALF
    whole = mix(halves[first] * _FACTORS[20] + halves[np.minimum(first + HALF, end)])
    whole = mix(whole * _FACTORS[21] + halves[end] + (last - first).astype(_U) * _FACTORS[22])
    whole = mix(whole + (at - first).astype(_U))
    return mix(halves[at]), whole, first, last


_COARSE = {"key": "<u8", "whole": "<u8", "owner": "<u8", "first": "<u4", "last": "<u4", "weight": "u1"}
_FOUND = {"owner": "<i8", "first": "<u4", "last": "<u4", "fine": "u1"}
_FINE = {"key": "<u8", "owner": "<u8", "first": "<u4", "weight": "u1"}
_NONE = {name: np.zeros(0, kind) for name, kind in _FOUND.items()}
_RANGES = T.StructType([
    T.StructField("owner", T.LongType()), T.StructField("first", T.LongType()),
    T.StructField("last", T.LongType()), T.StructField("fine", T.IntegerType()),
])
# Weights: an entry for one string; one that stands for several equal ones; one for a bucket that is mixed.
ONE, SEVERAL, MIXED = 1, 2, 3


def _take(fields: Fields, where: np.ndarray) -> Fields:
    return {name: values[where] for name, values in fields.items()}


def _ranges(fields: Fields, settled: np.ndarray, fine: np.ndarray) -> Fields:
    where = np.concatenate((np.flatnonzero(settled), np.flatnonzero(fine)))
    out = {name: fields[name][where] for name in ("owner", "first", "last")}
    out["owner"] = out["owner"].view(np.int64)
    out["fine"] = np.repeat(np.array([0, 1], np.uint8), [int(settled.sum()), int(fine.sum())])
    return out


def judge_coarse(fields: Fields) -> tuple[Fields, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(fields by key and whole name without repeats, size of the bucket, mixed, shared whole name, first of it)."""
    order = np.lexsort((fields["last"], fields["first"], fields["owner"], fields["whole"], fields["key"]))
    fields = _take(fields, order)
    same = np.zeros(len(order), bool)
    if len(order):
        same[1:] = np.all([fields[c][1:] == fields[c][:-1] for c in ("key", "whole", "owner", "first")], axis=0)
        # Copies of a whole text bring the same entry again; one that stands for several stays.
        same &= fields["weight"] == ONE
    fields = _take(fields, ~same)
    n = len(fields["key"])
    cuts = runs(fields["key"])
    starts = np.zeros(n, bool)
    starts[:1] = True
    starts[1:] = (fields["key"][1:] != fields["key"][:-1]) | (fields["whole"][1:] != fields["whole"][:-1])
    inner = np.flatnonzero(starts)
    if not n:
        empty = np.zeros(0, bool)
        return fields, np.zeros(0, np.int64), empty, empty, empty
    weight = fields["weight"].astype(np.int64)
    size = np.repeat(np.add.reduceat(weight, cuts[:-1]), np.diff(cuts))
    kinds = np.repeat(np.add.reduceat(starts.astype(np.int64), cuts[:-1]), np.diff(cuts))
    mixed = (kinds > 1) | np.repeat(np.maximum.reduceat(weight, cuts[:-1]) == MIXED, np.diff(cuts))
    shared = np.repeat(np.add.reduceat(weight, inner) > 1, np.diff(np.append(inner, n)))
    return fields, size, mixed, shared, starts


def settle_coarse(fields: Fields) -> tuple[Fields, Fields]:
    """What a task can tell of its own entries, and the entries others must still hear of."""
    fields, size, mixed, shared, starts = judge_coarse(fields)
    alone = size == 1
    known = _ranges(fields, ~alone & shared, ~alone & mixed & (~shared | starts))
    cuts = runs(fields["key"])[:-1]
    heads = np.zeros(len(size), bool)
    heads[cuts] = len(size) > 0
    weight = np.where(alone, ONE, np.where(mixed, MIXED, SEVERAL)).astype(np.uint8)
    return _take(fields | {"weight": weight}, alone | heads), known


def answer_coarse(fields: Fields) -> Fields:
    fields, size, mixed, shared, starts = judge_coarse(fields)
    repeated = size > 1
    one, several = fields["weight"] == ONE, fields["weight"] == SEVERAL
    # The head of a mixed bucket was asked for by its own task only, and those of its name may not be.
    inner = np.flatnonzero(starts)
    kin = np.diff(np.append(inner, len(starts)))
    met = (fields["weight"] == MIXED) & (np.repeat(kin, kin) > 1)
    return _ranges(fields, repeated & ((shared & one) | met), repeated & mixed & ((one & (~shared | starts)) | several))


def _fine_groups(fields: Fields) -> tuple[Fields, np.ndarray]:
    order = np.lexsort((fields["weight"], fields["first"], fields["owner"], fields["key"]))
    fields = _take(fields, order)
    same = np.zeros(len(order), bool)
    if len(order):
        same[1:] = np.all([fields[c][1:] == fields[c][:-1] for c in ("key", "owner", "first")], axis=0)
        same[1:] &= (fields["weight"][1:] == ONE)
    fields = _take(fields, ~same)
    cuts = runs(fields["key"])
    if not len(fields["key"]):
        return fields, np.zeros(0, np.int64)
    return fields, np.repeat(np.add.reduceat(fields["weight"].astype(np.int64), cuts[:-1]), np.diff(cuts))


def settle_fine(fields: Fields) -> tuple[Fields, Fields]:
    fields, size = _fine_groups(fields)
    repeated = size > 1
    heads = np.zeros(len(size), bool)
    heads[runs(fields["key"])[:-1]] = len(size) > 0
    weight = np.where(repeated, SEVERAL, ONE).astype(np.uint8)
    fields = fields | {"weight": weight, "last": fields["first"]}
    known = _ranges(fields, repeated, np.zeros(len(size), bool))
    sent = _take(fields, ~repeated | heads)
    sent.pop("last")
    return sent, known


def answer_fine(fields: Fields) -> Fields:
    fields, size = _fine_groups(fields)
    return _ranges(fields | {"last": fields["first"]}, (size > 1) & (fields["weight"] == ONE), np.zeros(len(size), bool))


def _chunks(parts: Iterator[Fields], settle) -> Iterator[tuple[Fields, Fields]]:
    waiting, size = [], 0

    def joined() -> tuple[Fields, Fields]:
        return settle({name: np.concatenate([w[name] for w in waiting]) for name in waiting[0]})

    for fields in parts:
        waiting.append(fields)
        size += len(fields["key"])
        if size >= CHUNK:
            yield joined()
            waiting, size = [], 0
    if waiting:
        yield joined()


def _coarse_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Fields, Fields]]:
    def parts() -> Iterator[Fields]:
        for batch in batches:
            owners = np.asarray(batch.column(0))
            for at, end, data, offsets in slices(batch.column(1)):
                for k in range(at, end):
                    key, whole, first, last = coarse(data[offsets[k - at] : offsets[k - at + 1]])
                    if len(key):
                        yield {"key": key, "whole": whole, "owner": np.full(len(key), owners[k]).view(_U),
                               "first": first.astype(np.uint32), "last": last.astype(np.uint32),
                               "weight": np.full(len(key), ONE, np.uint8)}

    return _chunks(parts(), settle_coarse)


def _expand(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All starts of some ranges, each once."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    lengths = last - first + 1
    out = np.repeat(first - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(int(lengths.sum()))
    return np.unique(out)


def _fine_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Fields, Fields]]:
    def parts() -> Iterator[Fields]:
        for batch in batches:
            owners = np.asarray(batch.column(0))
            firsts, lasts = batch.column(2), batch.column(3)
            for at, end, data, offsets in slices(batch.column(1)):
                for k in range(at, end):
                    _, halves = bucket_names(data[offsets[k - at] : offsets[k - at + 1]])
                    starts = _expand(np.asarray(firsts[k].values, np.int64), np.asarray(lasts[k].values, np.int64))
                    yield {"key": mix(halves[starts] * _FACTORS[23] + halves[starts + SPAN - HALF]),
                           "owner": np.full(len(starts), owners[k]).view(_U),
                           "first": starts.astype(np.uint32), "weight": np.full(len(starts), ONE, np.uint8)}

    return _chunks(parts(), settle_fine)


def repeated_starts(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """(owner, first, last): ranges of starts of 400-byte strings that start elsewhere too.

    ``rows`` has row and text, ``reps`` the owner (a 64-bit digest of the text) of one
    row for each different text. Equal texts count as one.
    """
    texts = rows.filter(F.octet_length("text") >= SPAN).select(F.xxhash64("text").alias("owner"), "text")
    found = stored(
        by_key(texts, _coarse_entries, answer_coarse, _COARSE, _FOUND, _RANGES), "substring-coarse")
    open_ranges = found.filter("fine = 1").groupBy("owner").agg(F.collect_list(F.struct("first", "last")).alias("r"))
    asked = stored(reps.join(open_ranges, "owner").select("row", "owner", "r.first", "r.last"), "substring-open")
    # Sorted, so that a task that runs again cuts the same chunks.
    texts = likely_rows(rows.select("row", "text"), asked).join(asked, "row").sortWithinPartitions("row").select(
        "owner", "text", "first", "last")
    fine = by_key(texts, _fine_entries, answer_fine, _FINE, _FOUND, _RANGES)
    return found.filter("fine = 0").unionByName(fine).select("owner", "first", "last")


def merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, end) of the bytes that strings with these ranges of starts cover."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(last[order] + SPAN)
    new = np.concatenate(([True], first[1:] > end[:-1]))
    starts = np.flatnonzero(new)
    return first[starts], end[np.append(starts[1:], len(first)) - 1]


_CUT = "row long, starts array<long>, ends array<long>, n_removed long, kept_sha256 string, kept binary"
_OUT = ["n_bytes", "starts", "ends", "n_removed", "kept_sha256", "kept"]


def _removed(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, texts, firsts, lasts = batch.columns
        for low in range(0, batch.num_rows, 1024):
            out = []
            for k in range(low, min(batch.num_rows, low + 1024)):
                data = memoryview(texts[k].as_buffer())
                starts, ends = merged(np.asarray(firsts[k].values, np.int64), np.asarray(lasts[k].values, np.int64))
                edges = np.concatenate(([0], np.stack([starts, ends], 1).ravel(), [len(data)])).tolist()
                kept = [data[a:b] for a, b in zip(edges[::2], edges[1::2])]
                digest = hashlib.sha256()
                for piece in kept:
                    digest.update(piece)
                out.append((rows[k].as_py(), starts.tolist(), ends.tolist(), int((ends - starts).sum()),
                            digest.hexdigest(), b"".join(kept) if with_text else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out), (
                    pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.string(), pa.binary()))],
                names=["row", "starts", "ends", "n_removed", "kept_sha256", "kept"])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, starts and ends of removed runs, n_removed, kept_sha256, kept.

    A byte is removed if some 400-byte string that covers it starts anywhere else
    too, in the same text or another, whatever is left of that one. ``kept`` has the
    remaining bytes if ``with_text``: they need not be valid UTF-8.

    A null text is empty; texts under 400 bytes lose nothing. Repeated rows and ids
    are texts of their own, so a text that comes twice is removed in both. Null ids
    stay. Other columns are not read. Strings are compared by 64-bit names.
    """
    rows, own_ids = numbered(docs, id_col, text_col)
    labelled = stored(
        rows.select("row", "id", F.xxhash64("text").alias("owner"), F.sha2("text", 256).alias("digest"),
                    F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")), "substring-rows")
    groups = stored(
        labelled.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("row"),
                                       F.min("owner").alias("owner")), "substring-texts")
    ranges = repeated_starts(rows, groups.select("row", "owner")).groupBy("owner").agg(
        F.collect_list(F.struct("first", "last")).alias("r"))
    # Copies lose all their bytes and need no ranges.
    found = stored(groups.filter("copies = 1").join(ranges, "owner").select("row", "r.first", "r.last"), "substring-ranges")
    again = groups.filter("copies > 1 AND digest IS NOT NULL").select("digest")
    copied = again.select("digest", F.lit(True).alias("copied"))
    texts = rows.select("row", "text")
    # Only texts that lose a part of their bytes are read again and shuffled.
    cut = map_batches(likely_rows(texts, found).join(found, "row").select("row", "text", "first", "last"),
                      lambda batches: _removed(batches, with_text), _CUT)
    # Texts that come twice lose all their bytes, others none.
    gone = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= SPAN)
    none, nothing = F.array().cast("array<long>"), hashlib.sha256().hexdigest()
    done = labelled.join(copied, "digest", "left").join(cut, "row", "left").select(
        "row", "id", "n_bytes",
        F.when(gone, F.array(F.lit(0).cast("long"))).otherwise(F.coalesce("starts", none)).alias("starts"),
        F.when(gone, F.array("n_bytes")).otherwise(F.coalesce("ends", none)).alias("ends"),
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "digest", F.lit(nothing))).alias("kept_sha256"),
        "kept", gone.alias("gone"))
    if with_text:
        whole = F.when(F.col("gone"), F.lit("")).otherwise(F.coalesce("text", F.lit(""))).cast("binary")
        done = done.join(texts, "row").withColumn("kept", F.coalesce("kept", whole))
    return done.select(F.col("id").alias(id_col), *_OUT)
