"""SentencePiece ids of whole texts and back, with work shared between words by their prefixes.

A text is cut where no piece of the vocabulary can cross: before a run of word
marks and at line feeds. The distinct marked words of a batch are sorted, which is
their trie read depth-first: going from one word to the next keeps the forward
results of the common prefix and only extends them.

Forward results: for a unigram model the best score of each prefix (Viterbi); for
a byte-pair model the last piece of the encoding of each prefix. The latter is
enough, as a sequence of pieces is what the merges give exactly if each piece
encodes to itself and each two neighbours encode to themselves, so the last piece
before position i is the one whose predecessor, already known, it can follow.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestrata.llm.arrow import map_batches

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Bounds of a Python worker's memory: words and pairs it remembers, characters it cuts at once.
MOST_WORDS, MOST_PAIRS, SLICE_CHARS = 250_000, 500_000, 1 << 19


class Vocabulary:
    """Pieces and scores of a model file's content."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(processor.vocab_size())
        self.pieces = [processor.id_to_piece(i) for i in ids]
        special = {i for i in ids if processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in ids if processor.is_byte(i)}
        self.unknown = processor.unk_id()
        self.ids = {self.pieces[i]: i for i in ids if i not in special and not processor.is_byte(i)}
        self.scores = [processor.get_score(i) for i in ids]
        # Ends of pieces: with the id of the piece that is just that, or -1.
        self.tails = {p[k:]: -1 for p in self.ids for k in range(1, len(p))} | self.ids
        self.lengths = [len(p) for p in self.pieces]
        self.packed = [array("i", [i]).tobytes() for i in ids]
        self.surface = [
            b"" if i in special else bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.encode()
            for i, p in enumerate(self.pieces)
        ]
        self.surface[self.unknown] = " ⁇ ".encode()
        self.surface = [x.replace(MARK.encode(), b" ") for x in self.surface]
        self.bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        self.spans = np.concatenate(([0], np.cumsum([len(x) for x in self.surface])))
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a word mark after other characters: words can't be cut before marks")
        self.cut = "\n" if not any("\n" in p for p in self.ids) else ""

    def fallback(self, char: str) -> bytes:
        """The ids of a character that is no piece."""
        if len(self.byte_ids) == 256:
            return b"".join([self.packed[self.byte_ids[b]] for b in char.encode()])
        return self.packed[self.unknown]

    def trace(self, word: str, last: list[int]) -> bytes:
        """The ids of a word from the last pieces of its prefixes; -1 stands for a character that is no piece."""
        packed, lengths, parts, end = self.packed, self.lengths, [], len(word)
        while end:
            piece = last[end]
            if piece >= 0:
                parts.append(packed[piece])
                end -= lengths[piece]
            else:
                parts.append(self.fallback(word[end - 1]))
                end -= 1
        parts.reverse()
        return b"".join(parts)


class BytePairs:
    """Forward results of a byte-pair model: the last piece of each prefix, -1 for a character that is no piece."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.follows: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.size = len(vocabulary.pieces)
        by_score = sorted(vocabulary.ids.values(), key=lambda i: (-vocabulary.scores[i], i))
        self.rank = {piece: k for k, piece in enumerate(by_score)}

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """What the merges make of some characters, best score first, then leftmost; and the last two merged."""
        parts, ids, rank, last = list(text), self.v.ids, self.rank, None
        while len(parts) > 1:
            best, at = len(rank), -1
            for k in range(len(parts) - 1):
                piece = ids.get(parts[k] + parts[k + 1])
                if piece is not None and rank[piece] < best:
                    best, at = rank[piece], k
            if at < 0:
                break
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def _halves(self, piece: int) -> tuple[int, int] | None:
        """The pieces whose merge makes this one; (-1, -1) for one character, None if merges don't reach it."""
        if piece not in self.halves:
            text = self.v.pieces[piece]
            parts, last = self.merged(text)
            whole = parts == [text]
            self.halves[piece] = (
                (self.v.ids.get(last[0], -1), self.v.ids.get(last[1], -1)) if whole and last
                else (-1, -1) if whole else None)
        return self.halves[piece]

    def _may_follow(self, left: int, piece: int) -> bool:
        """Whether the merges leave the border between these two alone.

        The merges inside both are undone, latest first. At each step the two symbols
        at the border must not form a piece that would have been merged before the
        merge undone last; of equal merges the left one comes first.
        """
        pieces, ids, rank = self.v.pieces, self.v.ids, self.rank
        limit = len(rank)
        while True:
            joined = ids.get(pieces[left] + pieces[piece])
            if joined is not None and rank[joined] < limit:
                return False
            inner, outer = self._halves(left)[1], self._halves(piece)[0]
            if inner < 0 and outer < 0:
                return True
            if outer < 0 or inner >= 0 and rank[left] > rank[piece]:
                limit, left = rank[left], inner
            else:
                limit, piece = rank[piece] + 1, outer

    def _fits(self, left: int, piece: int) -> bool:
        key = left * self.size + piece
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) >= MOST_PAIRS:
                self.follows.clear()
            known = self.follows[key] = self._halves(piece) is not None and self._may_follow(left, piece)
        return known

    def walk(self, words: Iterable[str]) -> Iterator[bytes]:
        """The ids of each of the sorted words.

        ``last`` has the last piece of each prefix of the current word. Exactly one
        piece is the last one of a prefix, so the first that fits is it.
        """
        tails, follows, size, v = self.v.tails, self.follows, self.size, self.v
        last, before = [-1], ""
        for word in words:
            shared = _shared(word, before)
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                begin = end - 1
                while begin >= 0:
                    piece = tails.get(word[begin:end])
                    if piece is None:
                        begin = -1
                        break
                    if piece >= 0:
                        left = last[begin]
                        if left < 0:
                            fits = self._halves(piece) is not None
                        else:
                            fits = follows.get(left * size + piece)
                            if fits is None:
                                fits = self._fits(left, piece)
                        if fits:
                            last.append(piece)
                            break
                    begin -= 1
                if begin < 0:
                    last.append(-1)
            yield v.trace(word, last)
            before = word


class Unigrams:
    """Forward results of a unigram model: the best score of each prefix and its last piece."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        normal = [vocabulary.scores[i] for i in vocabulary.ids.values()]
        self.penalty = min(normal, default=0.0) - 10.0

    def walk(self, words: Iterable[str]) -> Iterator[bytes]:
        """The ids of each of the sorted words; of equal scores the longest last piece counts."""
        tails, scores, v = self.v.tails, self.v.scores, self.v
        best, last, before = [0.0], [-1], ""
        for word in words:
            shared = _shared(word, before)
            del best[shared + 1 :], last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                found, begin = None, end - 1
                while begin >= 0:
                    piece = tails.get(word[begin:end])
                    if piece is None:
                        break
                    if piece >= 0 and (found is None or best[begin] + scores[piece] >= found[0]):
                        found = best[begin] + scores[piece], piece
                    begin -= 1
                if word[end - 1] not in v.ids:
                    score = best[end - 1] + self.penalty
                    if found is None or score > found[0]:
                        found = score, -1
                best.append(found[0])
                last.append(found[1])
            yield v.trace(word, last)
            before = word


def _shared(word: str, before: str) -> int:
    """The length of the common prefix: the depth at which two words part in the trie."""
    for k, (a, b) in enumerate(zip(word, before)):
        if a != b:
            return k
    return min(len(word), len(before))


FORWARD = {"bpe": BytePairs, "unigram": Unigrams}


class Codec:
    def __init__(self, model: bytes, kind: str = "bpe") -> None:
        self.v = Vocabulary(model)
        self.forward = FORWARD[kind](self.v)
        self.known: dict[str, bytes] = {}
        line = self.v.cut
        # A run of blanks with what follows it, or a line feed with what follows it.
        self.token = re.compile(f" +[^ {line}]*" + (f"|{line}[^ {line}]*" if line else ""))

    def learn(self, tokens: Iterable[str]) -> None:
        """Encodes the words not yet known, as one depth-first walk over their trie."""
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        new = sorted(set(tokens).difference(self.known))
        marked = (token.replace(" ", MARK) for token in new)
        self.known.update(zip(new, self.forward.walk(marked)))

    def tokens(self, text: str) -> Iterator[list[str]]:
        """The words of a marked text, at most a slice at a time."""
        at = 0
        while len(text) - at > SLICE_CHARS:
            cut = text.find(" ", at + SLICE_CHARS)
            while cut > 0 and text[cut - 1] == " ":
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield self.token.findall(text, at, cut)
            at = cut
        yield self.token.findall(text, at)

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of each text as 32-bit numbers; texts are joined to slices that share one walk."""
        out: list[bytes | None] = [None] * len(texts)
        waiting, size = [], 0

        def settle() -> None:
            self.learn(t for _, words in waiting for t in words)
            for k, words in waiting:
                out[k] = (out[k] or b"") + b"".join(map(self.known.__getitem__, words))
            waiting.clear()

        for k, text in enumerate(texts):
            if text is None:
                continue
            out[k] = b""
            if text:
                for words in self.tokens(" " + text.replace(MARK, " ")):
                    waiting.append((k, words))
                    size += 8 * len(words)
                    if size > SLICE_CHARS:
                        settle()
                        size = 0
        settle()
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of the lists of ids that ``offsets`` parts; ids that are no piece count as unknown."""
        v = self.v
        ids = np.where((ids < 0) | (ids >= len(v.surface)), v.unknown, ids)
        lengths = v.spans[ids + 1] - v.spans[ids]
        ends = np.cumsum(lengths)
        shift = v.spans[ids] - (ends - lengths)
        data = v.bytes[np.repeat(shift, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
        cuts = np.concatenate(([0], ends))[offsets].tolist()
        texts = [data[x:y].decode("utf-8", errors="replace") for x, y in zip(cuts, cuts[1:])]
        return [t[1:] if t.startswith(" ") else t for t in texts]


def read_model(path: str = MODEL_PATH) -> bytes:
    """The content of a model file. The driver reads it; tasks get its half megabyte with their code."""
    with open(path, "rb") as file:
        return file.read()


def _ids_array(parts: list[bytes | None]) -> pa.Array:
    lengths = [len(p) // 4 if p else 0 for p in parts]
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join([p for p in parts if p]), np.int32))
    missing = pa.array([p is None for p in parts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=missing)


# Rows of text that go through at once; their number bounds a task's memory.
STEP_ROWS = 512


def encode(
    docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
    model: bytes | None = None, kind: str = "bpe",
) -> DataFrame:
    """The ``keep`` columns, ``ids`` (array of int) and ``n_tokens`` of every row. Nothing is shuffled.

    The ids are those of the SentencePiece library for the model: of its byte-pair
    encoding with ``kind="bpe"``, of its unigram encoding with ``kind="unigram"``,
    for models without text normalisation that put a mark before the text. A null
    text has null ids and no tokens, an empty one an empty list. Repeated rows and
    null ids stay. Kept columns called ``ids`` or ``n_tokens`` are not allowed.
    """
    if {"ids", "n_tokens"} & set(keep):
        raise ValueError("ids and n_tokens are the names of results")
    model = model or read_model()
    chosen = docs.select(*[docs[c] for c in keep], docs[text_col].alias("__text"))
    schema = T.StructType([
        *chosen.schema.fields[:-1],
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
    ])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What a task learns goes with it: the worker serves other operators afterwards.
        codec = Codec(model, kind)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(at, STEP_ROWS)
                out = codec.encode(part.column(part.num_columns - 1).to_pylist())
                counts = pa.array([len(x) // 4 if x else 0 for x in out], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], _ids_array(out), counts], names=schema.names)

    return map_batches(chosen, encoded, schema)


def decode(
    rows: DataFrame, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",), into: str = "decoded",
    model: bytes | None = None,
) -> DataFrame:
    """The ``keep`` columns and the text of the ids, null for null ids.

    For what ``encode`` made this is the text itself, with every word mark U+2581
    in it turned into a blank, as the library does.
    """
    model = model or read_model()
    chosen = rows.select(*[rows[c] for c in keep], rows[ids_col].alias("__ids"))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField(into, T.StringType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            for at in range(0, batch.num_rows, STEP_ROWS):
                part, some = batch.slice(at, STEP_ROWS), lists.slice(at, STEP_ROWS)
                lengths = np.asarray(some.value_lengths().fill_null(0), np.int64)
                offsets = np.concatenate(([0], np.cumsum(lengths)))
                texts = codec.decode(np.asarray(some.flatten().fill_null(-1), np.int64), offsets)
                column = pa.array(texts, pa.string(), mask=np.asarray(some.is_null()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], column], names=schema.names)

    return map_batches(chosen, decoded, schema)
