"""Documents as token ids in binary files, each id in the fewest bits that hold the vocabulary.

A file holds whole documents, in the order of their ids, over all files in the
order of the files' numbers:

    block 0, block 1, ...   ``BLOCK`` ids each (the last fewer), packed, and a line feed after each block
    index                   for each document its id (signed 64 bits, the lowest number for null) and the
                            end of its ids in the file (64 bits); then the offset of each block (64 bits);
                            a line feed
    trailer                 ``TRAILER`` and a line feed

All numbers are little-endian. Line feeds come from Spark's writer of lines, which
commits the files on any file system; offsets count them, nothing looks for them.
Ids ``i`` to ``j`` of a file lie in blocks ``i // BLOCK`` to ``(j - 1) // BLOCK``.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.llm.arrow import map_batches
from lodestrata.llm.bit_packing import bits_for, pack, packed_size, unpack
from lodestrata.llm.tables import stored
from lodestrata.session import work_dir

BLOCK = 4096
# Bytes of the texts whose ids make a file.
FILE_BYTES = 1 << 24
END = 1
MAGIC, VERSION = b"LSTOKENS", 1
# Magic, version, bits, block size, file number, documents, ids, blocks, offset of the index, 0 or 1 for a line feed's sake.
TRAILER = struct.Struct("<8sIIIIQQQQ")
NULL_ID = -(1 << 63)
# Distinct words whose ids a worker remembers, and how many new ones it encodes at once.
REMEMBERED, _AT_ONCE = 400_000, 1024
# The bytes at which a text may be parted without a change to its ids.
_BLANKS = b" \t\n\r"
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(_BLANKS)] = True
_TEXT_BYTES = 2 << 20
# The steps before the merges for which words may be parted further, where no match of the pattern can go on.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
# Kinds of bytes. Next to others (controls, what is no ASCII) nothing is parted, but next to the letters of Latin-1.
_OTHER, _LETTER, _DIGIT, _MARK, _QUOTE = range(5)
_KIND = np.array([_OTHER if b < 33 or b > 126 else _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else
                  _QUOTE if b == 39 else _MARK for b in range(256)], np.uint8)
_PARTED = np.zeros((5, 5), bool)
_PARTED[_LETTER, [_DIGIT, _MARK, _QUOTE]] = _PARTED[_DIGIT, 1:] = _PARTED[_MARK, [_LETTER, _DIGIT]] = True
_PARTED[_QUOTE, _DIGIT] = True
_PARTED = _PARTED.reshape(-1)
# Words that are one match each, so one end of a word in the ids.
_ONE_MATCH = "^(?:[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[0-9]|[!-/:-@\\[-`{-~]+)$"


class _Known:
    """Words and their ids, side by side."""

    def __init__(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.words, self.ids, self.sizes = words, ids, sizes
        self.starts = np.cumsum(sizes) - sizes

    def joined(self, other: _Known) -> _Known:
        return _Known(pa.concat_arrays([self.words, other.words]), np.concatenate((self.ids, other.ids)),
                      np.concatenate((self.sizes, other.sizes)))

    def taken(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words ``at``, one after the other, and how many each has."""
        sizes = self.sizes[at]
        return self.ids[np.repeat(self.starts[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())], sizes


def _places(data: bytes, part: bytes) -> Iterator[int]:
    at = data.find(part)
    while at >= 0:
        yield at
        at = data.find(part, at + 1)


class Encoder:
    """Ids of texts. Words between blanks are encoded once and remembered, since none of the tokenizer's steps crosses a blank.

    With the steps of ``_NORMALIZER`` and ``_PRE_TOKENIZER`` words are also parted where
    letters, digits and marks meet, A-Z are lower-cased first, and words that are one match
    each are encoded many at once: the last id of each is one that ends a word.
    """

    def __init__(self, model: str, end: int) -> None:
        # A task has one core: the library's own threads would only take memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_str(model), end
        self.known = _Known(pa.array([], pa.binary()), np.zeros(0, np.uint32), np.zeros(0, np.int64))
        self.added = self.tokenizer.get_added_tokens_decoder()
        self.ends = self._ends()

    def _ends(self) -> np.ndarray | None:
        """Whether each id ends a word; none if the tokenizer's steps are others than those known here."""
        steps, model = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer), self.tokenizer.model
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in self.added.values()) or (
            self.tokenizer.post_processor is not None or None in steps
        ) or [json.loads(s.__getstate__()) for s in steps] != [_NORMALIZER, _PRE_TOKENIZER]:
            return None
        suffix = getattr(model, "end_of_word_suffix", None)
        if not suffix:
            return None
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        ends[[i for token, i in self.tokenizer.get_vocab(False).items() if token.endswith(suffix)]] = True
        return ends

    def _each(self, words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(words), _AT_ONCE):
            part = words.slice(at, _AT_ONCE).to_pylist()
            found = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            yield np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _together(self, words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """As ``_each``, for words that are one match each."""
        for at in range(0, len(words), _AT_ONCE):
            part = words.slice(at, _AT_ONCE)
            ids = np.array(self.tokenizer.encode_batch_fast(
                [" ".join(part.to_pylist())], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part):
                yield ids, np.diff(ends, prepend=0)
            else:
                yield from self._each(part)

    def _encoded(self, words: pa.Array, single: int) -> _Known:
        """The first ``single`` words are one match each."""
        texts = words.cast(pa.string())
        parts = [(np.zeros(0, np.uint32), np.zeros(0, np.int64)), *self._together(texts[:single]), *self._each(texts[single:])]
        ids, sizes = zip(*parts)
        return _Known(words, np.concatenate(ids), np.concatenate(sizes))

    def _vocabulary(self, words: pa.Array) -> _Known:
        """The ids of distinct words, the end id after the last."""
        at = pc.fill_null(pc.index_in(words, self.known.words), -1).to_numpy().astype(np.int64)
        fresh, old = np.flatnonzero(at < 0), at >= 0
        if len(self.known.words) + len(fresh) > REMEMBERED:
            ids, sizes = self.known.taken(at[old])
            self.known = _Known(self.known.words.take(pa.array(at[old])), ids, sizes)
            at[old] = np.arange(len(sizes))
        one = np.zeros(len(fresh), bool)
        if self.ends is not None:
            one = pc.match_substring_regex(words.take(pa.array(fresh)).cast(pa.string()), _ONE_MATCH).to_numpy(zero_copy_only=False)
        fresh = np.concatenate((fresh[one], fresh[~one]))
        at[fresh] = len(self.known.words) + np.arange(len(fresh))
        self.known = self.known.joined(self._encoded(words.take(pa.array(fresh)), int(one.sum())))
        ids, sizes = self.known.taken(at)
        return _Known(words, np.append(ids, np.uint32(self.end)), np.append(sizes, 1))

    def _parted(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes with the same ids, where a word may begin within another)."""
        if self.ends is None or not len(data):
            return data, np.zeros(len(data), bool)
        kinds = _KIND[data]
        # The letters U+00C0 to U+00FF are two bytes each; U+00D7 and U+00F7 are none.
        after = np.append(data[1:], np.uint8(0))
        latin = np.flatnonzero((data == 0xC3) & (after & 0xC0 == 0x80) & (after != 0x97) & (after != 0xB7))
        kinds[latin] = kinds[latin + 1] = _LETTER
        cut = np.zeros(len(data), bool)
        cut[1:] = _PARTED[kinds[:-1] * np.uint8(5) + kinds[1:]]
        # No mark that would join the letter may follow.
        capital = (data - np.uint8(65) < 26) & ((after < 0x80) | (after == 0xC3))
        lower = data + capital * np.uint8(32)
        if self.added:
            # Added tokens are looked for in the text as it is, before all other steps.
            folded = data.tobytes().lower()
            for token in {t.content.encode() for t in self.added.values()}:
                for at in _places(folded, token.lower()):
                    lower[at : at + len(token)] = data[at : at + len(token)]
                    cut[at + 1 : at + len(token)] = False
        return lower, cut

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text, with the end id)."""
        cuts = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
        cuts = cuts - cuts[0]
        data, begins = self._parted(data)
        inside = ~_IS_BLANK[data]
        begins[:1] |= inside[:1]
        begins[1:] |= inside[1:] & ~inside[:-1]
        heads = cuts[:-1][cuts[:-1] < len(data)]
        begins[heads] = inside[heads]
        starts = np.flatnonzero(begins)
        offsets = np.append(np.cumsum(inside, dtype=np.int32)[starts] - 1, inside.sum()).astype(np.int32)
        words = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
        vocabulary = self._vocabulary(words.dictionary)
        text = np.searchsorted(cuts, starts, "right") - 1
        per_text = np.bincount(text, minlength=len(texts))
        # The end id is one more word, after the last of each text.
        order = np.insert(words.indices.to_numpy().astype(np.int64), np.cumsum(per_text), len(words.dictionary))
        ids, taken = vocabulary.taken(order)
        ends = np.cumsum(per_text + 1)
        counted = np.concatenate(([0], np.cumsum(taken)))[ends]
        return ids, np.diff(np.concatenate(([0], counted)))


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + _TEXT_BYTES, "right")))
        yield at, to
        at = to


def _model(path: str) -> tuple[str, int]:
    """(the tokenizer's file, how many ids it has)."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        model = file.read()
    return model, Tokenizer.from_str(model).get_vocab_size()


def _bounds(rows: DataFrame, file_bytes: int) -> list[tuple[int, int]]:
    """The first (id, row) of each file; only these two numbers of each row are shuffled, and a pair for each file reaches the driver."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = rows.select("id", "row").repartitionByRange(max(1, -(-size // file_bytes)), "id", "row")
    firsts = dealt.groupBy(F.spark_partition_id().alias("file")).agg(F.min(F.struct("id", "row")).alias("first"))
    return sorted((r.first.id, r.first.row) for r in firsts.select("first").collect())


def write(
    docs: DataFrame, path: str, tokenizer: str, end: int = END, id_col: str = "doc_id", text_col: str = "text",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Writes the ids of all documents to files under ``path``, which must not exist yet.

    Texts are encoded where they lie; only packed ids are shuffled, into ranges of ids
    of equally many documents, with ``file_bytes`` of text on average.
    Null ids come first, rows of equal ids by a digest of the text. A null text has the end id only.
    """
    model, size = _model(tokenizer)
    bits = bits_for(max(size, end + 1))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(F.col(text_col)).alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    firsts = _bounds(rows, file_bytes)
    files = max(1, len(firsts))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, end)
        for batch in batches:
            numbers = [max(0, bisect_right(firsts, key) - 1) for key in zip(*(batch.column(k).to_pylist() for k in (0, 1)))]
            texts = batch.column(2)
            for at, to in _slices(texts):
                ids, counts = encoder.encode(texts.slice(at, to - at))
                parts = np.split(ids, np.cumsum(counts)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[at:to], pa.int32()), batch.column(0).slice(at, to - at),
                     batch.column(1).slice(at, to - at), pa.array([pack(p, bits) for p in parts], pa.binary()),
                     pa.array(counts, pa.int64())], ["file", "id", "row", "ids", "n"])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, number = _FileWriter(bits), 0
        for batch in batches:
            number = batch.column(0)[0].as_py()
            for key, ids, n in zip(batch.column(1).to_pylist(), batch.column(3), batch.column(4).to_pylist()):
                yield from _lines(writer.add(key, unpack(ids.as_buffer(), n, bits)))
        if writer.keys:
            yield from _lines(writer.close(number))

    encoded = map_batches(rows, encode, "file int, id long, row long, ids binary, n long")
    dealt = encoded.repartitionById(files, "file").sortWithinPartitions("id", "row", "n")
    map_batches(dealt, lines, "line binary").select(F.col("line").cast("string").alias("value")).write.text(path)


def _lines(parts: Sequence[bytes]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["line"])


class _FileWriter:
    """The lines of one file, block by block."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.keys: list[int] = []
        self.ends: list[int] = []
        self.offsets: list[int] = []
        self.at = self.n = 0
        self.held: list[np.ndarray] = []
        self.waiting = 0

    def add(self, key: int, ids: np.ndarray) -> list[bytes]:
        self.n += len(ids)
        self.keys.append(key)
        self.ends.append(self.n)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting < BLOCK:
            return []
        ids = np.concatenate(self.held)
        full = len(ids) // BLOCK * BLOCK
        self.held, self.waiting = [ids[full:]], len(ids) - full
        return [self._block(ids[at : at + BLOCK]) for at in range(0, full, BLOCK)]

    def _block(self, ids: np.ndarray) -> bytes:
        self.offsets.append(self.at)
        line = pack(ids, self.bits)
        self.at += len(line) + 1
        return line

    def close(self, number: int) -> list[bytes]:
        lines = [self._block(np.concatenate(self.held))] if self.waiting else []
        index = b"".join(np.array(x, kind).tobytes() for x, kind in (
            (self.keys, "<i8"), (self.ends, "<u8"), (self.offsets, "<u8")))
        trailer = TRAILER.pack(
            MAGIC, VERSION, self.bits, BLOCK, number, len(self.keys), self.n, len(self.offsets), self.at)
        return [*lines, index, trailer]


class TokenFile:
    """A file's bytes (or a map of them into memory), read from any place without reading the rest."""

    def __init__(self, data) -> None:
        self.data = memoryview(data)
        at = len(self.data) - TRAILER.size - 1
        if at < 0:
            raise ValueError("no token file: too short")
        magic, version, self.bits, self.block, self.number, docs, self.n_ids, blocks, start = TRAILER.unpack(
            self.data[at : at + TRAILER.size])
        if magic != MAGIC or version != VERSION:
            raise ValueError("no token file of this version")
        self.keys = np.frombuffer(self.data, "<i8", docs, start)
        self.ends = np.frombuffer(self.data, "<u8", docs, start + 8 * docs).astype(np.int64)
        self.offsets = np.frombuffer(self.data, "<u8", blocks, start + 16 * docs).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; only their blocks are looked at."""
        if not 0 <= start <= stop <= self.n_ids:
            raise IndexError(f"ids {start} to {stop} of {self.n_ids}")
        if start == stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        parts = []
        for k in range(first, last + 1):
            count = min(self.block, self.n_ids - k * self.block)
            at = int(self.offsets[k])
            parts.append(unpack(self.data[at : at + packed_size(count, self.bits)], count, self.bits))
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's document ``k``."""
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))

    def __len__(self) -> int:
        return len(self.keys)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, first, n_tokens, ids_crc32) of every document of the files; ``first`` is its place in its file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(content.as_buffer())
                firsts = np.concatenate(([0], file.ends[:-1]))
                for at in range(0, len(file), 4096):
                    to = min(len(file), at + 4096)
                    # The documents' blocks are unpacked at once, then parted.
                    ids = file.ids(int(firsts[at]), int(file.ends[to - 1])).astype("<u4")
                    cuts = np.append(firsts[at:to], file.ends[to - 1]) - firsts[at]
                    crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
                    keys = file.keys[at:to]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(to - at, file.number), pa.int64()),
                         pa.array(keys, pa.int64(), mask=keys == NULL_ID),
                         pa.array(firsts[at:to], pa.int64()), pa.array(np.diff(cuts), pa.int64()),
                         pa.array(crcs, pa.int64())],
                        ["file", "doc_id", "first", "n_tokens", "ids_crc32"])

    return map_batches(files, run, "file long, doc_id long, first long, n_tokens long, ids_crc32 long")


def manifest(documents: DataFrame) -> DataFrame:
    """(file, file_start, n_ids): where the ids of each file begin among those of all; one row a file."""
    totals = documents.groupBy("file").agg(F.sum("n_tokens").alias("n_ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("file_start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def token_index(
    docs: DataFrame, tokenizer: str, end: int = END, id_col: str = "doc_id", text_col: str = "text",
    path: str | None = None, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file): writes the documents' ids and tells from the files where each lies.

    ``start`` counts the ids of all documents before, in ascending order of ids; null
    ids come first, rows of equal ids in the order of a digest of their texts. Null and empty
    texts have the end id only. Other columns of ``docs`` are not looked at. No documents, no files and no rows.
    """
    spark = docs.sparkSession
    path = path or work_dir(spark, "tokens")
    write(docs, path, tokenizer, end, id_col, text_col, file_bytes)
    documents = stored(read(spark, path), "token-documents")
    starts = manifest(documents).select("file", "file_start")
    return documents.join(starts, "file").select(
        "doc_id", (F.col("file_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32", "file")
