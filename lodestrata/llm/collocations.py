"""Phrases whose words stand together more often than by chance, counted by tries of candidates.

A phrase can only be frequent if its parts are. 64-bit codes of the phrases whose
parts are frequent are summed over all tasks: a sum is never below the count of its
phrase, so codes below the limit take out phrases safely. The codes that stay fill a
bit filter of fixed size, by which tasks find the phrases themselves. The candidates
with the highest sums, which make up most of all occurrences, go into a trie of bounded
size that is sent to all tasks. A task moves the states of all positions of its texts
on, a word at a time, and counts the accepting ones; the sums over the tasks are
exact. Candidates beyond that bound are rare: their occurrences are summed by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.arrow import map_batches
from lodestrata.llm.double_array import DoubleArray, digits
from lodestrata.llm.packed import Fields, by_key, runs
from lodestrata.llm.shingles import mix
from lodestrata.llm.tables import stored

WORDS, LEAST, TOP, SCALE = 3, 10, 2000, 1_000_000
# A candidate goes if a longer phrase has so many percent of its occurrences.
COVERED = 50
UNKNOWN = "und"
# Phrases of the trie, which the driver builds and a task holds in memory (some 100 bytes each).
TRIE_PHRASES = 250_000
# Bits of a filter of frequent codes: 8 MB whatever the input. With more codes it lets more pass.
FILTER_BITS = 1 << 26
# Bytes of text that a task takes apart at once, and codes it holds before it gives them out.
CHUNK, HELD = 2 << 20, 1 << 20
_U = np.uint64
_SPREAD = 0x9E3779B97F4A7C15
_GATHERED = pow(_SPREAD, -1, 1 << 64)

# Bytes that part words, and bytes that part pieces.
_BLANK, _BREAK = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANK)] = 1
_KIND[list(_BREAK)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=_U)) | _U(1)


class Chunk:
    """The words of some texts: ``words`` (binary), ``joined`` (same piece as the word before) and ``lang`` numbers."""

    def __init__(self, texts: pa.Array, langs: list[str]) -> None:
        cuts = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
        cuts = cuts - cuts[0]
        kind = _KIND[data]
        inside = kind == 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = cuts[:-1][cuts[:-1] < len(data)]
        begins[heads] = inside[heads]
        starts = np.flatnonzero(begins)
        offsets = np.append(np.cumsum(inside, dtype=np.int32)[starts] - 1, inside.sum()).astype(np.int32)
        letters = _LOWER[data[inside]]
        self.words = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        text = np.searchsorted(cuts, starts, "right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        self.joined = np.zeros(len(starts), bool)
        self.joined[1:] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        self.langs = sorted(set(langs))
        number = {lang: k for k, lang in enumerate(self.langs)}
        self.lang = np.array([number[x] for x in langs], np.int64)[text]

    def codes(self) -> np.ndarray:
        """A number for each word and its language."""
        parts = self.words.dictionary_encode()
        by_lang = _hashed(pa.array(self.langs, pa.binary())) + _U(1)
        return mix(_hashed(parts.dictionary)[parts.indices.to_numpy()] ^ by_lang[self.lang])


def _hashed(words: pa.Array) -> np.ndarray:
    """A 64-bit number for each word, from its bytes and their places."""
    if not len(words):
        return np.zeros(0, _U)
    cuts = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
    sizes = np.diff(cuts)
    place = np.arange(len(data)) - np.repeat(cuts[:-1] - cuts[0], sizes)
    powers = np.cumprod(np.full(int(sizes.max()) + 1, _SPREAD, _U))
    ends = np.concatenate((np.zeros(1, _U), np.cumsum(mix(_BYTE[data] * powers[place]))))
    # The wrapped sums of all bytes before give those of each word.
    return mix(ends[cuts[1:] - cuts[0]] - ends[cuts[:-1] - cuts[0]] + sizes.astype(_U))


def chunks(batch: pa.RecordBatch) -> Iterator[Chunk]:
    """The texts (column 0) with their languages (column 1) in slices of some ``CHUNK`` bytes, whole texts each."""
    texts, langs = batch.column(0), batch.column(1).to_pylist()
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + CHUNK, "right")))
        yield Chunk(texts.slice(at, to - at), langs[at:to])
        at = to


class Filter:
    """A set of codes as bits; codes that were never put in may pass, others never fail."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def passes(self, codes: np.ndarray) -> np.ndarray:
        found = np.ones(len(codes), bool)
        for at in _places(codes):
            found &= (self.bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1
        return found


def _places(codes: np.ndarray) -> list[np.ndarray]:
    last = _U(FILTER_BITS - 1)
    return [codes & last, (codes >> _U(32)) & last]


def filter_of(codes: DataFrame) -> Filter:
    """The filter of a table of codes (code). Its bits are put together by Spark; ``FILTER_BITS`` of them reach the driver."""
    last = FILTER_BITS - 1
    places = codes.select(F.explode(F.array(
        F.col("code").bitwiseAND(last), F.shiftrightunsigned("code", 32).bitwiseAND(last))).alias("place"))
    width = 4096 * 8
    rows = places.select((F.col("place") / width).cast("int").alias("bucket"), (F.col("place") % width).alias("bit"))
    maps = rows.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, own in maps.collect():
        bits[bucket * 4096 : (bucket + 1) * 4096] = np.frombuffer(own, np.uint8)
    return Filter(bits)


def _phrases(chunk: Chunk, frequent: list[Filter], level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 .. ``level`` words (first word's position, code) of phrases whose parts pass the filters of their lengths.

    Lengths without a filter pass.
    """
    words = chunk.codes()
    at, codes = np.arange(len(words)), words
    for length in range(1, level + 1):
        if length > 1:
            # A phrase of this length is one that passed, and one that passed and starts a word later.
            if length - 2 < len(frequent):
                passed = frequent[length - 2].passes(codes)
                at, codes = at[passed], codes[passed]
            follows = np.flatnonzero((at[1:] == at[:-1] + 1) & chunk.joined[at[1:] + length - 2])
            at = at[follows]
            codes = mix(codes[follows] + words[at + length - 1] * _U(2 * length + 1))
        yield at, codes


_COUNTED = {"key": "<u8", "n": "<u4"}


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    cuts = runs(keys)
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    return keys[cuts[:-1]], np.add.reduceat(counts.astype(np.int64), cuts[:-1])


def frequent_codes(texts: DataFrame, filters: list, levels: tuple[int, ...], least: int) -> DataFrame:
    """(code, n) of the phrases of so many words whose codes come ``least`` times or more; ``filters`` are of shorter ones."""
    nothing = {"code": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)}

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Fields, Fields]]:
        known = [f.value for f in filters]
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for chunk in chunks(batch):
                for length, (_, codes) in enumerate(_phrases(chunk, known, max(levels)), 1):
                    if length in levels:
                        held.append(codes)
                        size += len(codes)
                if size >= HELD:
                    yield _counted(held), nothing
                    held, size = [], 0
        if size:
            yield _counted(held), nothing

    def answers(fields: Fields) -> Fields:
        keys, sums = _summed(fields["key"], fields["n"])
        often = sums >= least
        return {"code": keys[often].view(np.int64), "n": sums[often]}

    row = T.StructType([T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])
    return by_key(texts, entries, answers, _COUNTED, {"code": "<i8", "n": "<i8"}, row)


def _counted(held: list[np.ndarray]) -> Fields:
    keys, counts = np.unique(np.concatenate(held), return_counts=True)
    return {"key": keys, "n": counts.astype(np.uint32)}


def most_frequent(codes: DataFrame, most: int) -> DataFrame:
    """The codes with the highest sums, ``most`` at most; codes of equal sums stay or go together."""
    sums = codes.groupBy("n").count()
    so_far = F.sum("count").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0))
    cut = sums.withColumn("so_far", so_far).filter(F.col("so_far") > most).agg(F.max("n")).first()[0]
    return codes if cut is None else codes.filter(F.col("n") > cut)


_PLACES = ("w1", "w2", "w3")


_FOUND = ["lang", *_PLACES, "n", "hot"]


class _Found:
    """The distinct phrases that a task has found, by their codes, with their counts."""

    def __init__(self) -> None:
        self.codes = np.zeros(0, _U)
        self.slots = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.hot: list[np.ndarray] = []
        self.rows: list[list[pa.Array]] = []

    def add(self, chunk: Chunk, length: int, at: np.ndarray, codes: np.ndarray, chosen: Filter) -> None:
        codes, first, counts = np.unique(codes, return_index=True, return_counts=True)
        place = np.searchsorted(self.codes, codes)
        known = place < len(self.codes)
        known[known] = self.codes[place[known]] == codes[known]
        self.counts[self.slots[place[known]]] += counts[known]
        new = ~known
        at, n = at[first[new]], len(self.counts)
        words = [chunk.words.take(pa.array(at + k)) for k in range(length)]
        words += [pa.nulls(len(at), pa.binary())] * (len(_PLACES) - length)
        self.rows.append([pa.array(chunk.langs, pa.string()).take(pa.array(chunk.lang[at])), *words])
        self.hot.append(chosen.passes(codes[new]))
        self.codes = np.insert(self.codes, place[new], codes[new])
        self.slots = np.insert(self.slots, place[new], n + np.arange(len(at)))
        self.counts = np.concatenate((self.counts, counts[new]))

    def given_out(self) -> Iterator[pa.RecordBatch]:
        at = 0
        for (lang, *words), hot in zip(self.rows, self.hot):
            # What is for the trie is counted there.
            counts = np.where(hot, 0, self.counts[at : at + len(hot)])
            at += len(hot)
            yield pa.RecordBatch.from_arrays(
                [lang, *[w.cast(pa.string()) for w in words], pa.array(counts), pa.array(hot)], _FOUND)
        self.__init__()


def candidates(texts: DataFrame, filters: list, hot) -> DataFrame:
    """(lang, w1, w2, w3, n, hot): each phrase that passes, once; and a row without words for each language's number of words.

    Phrases whose codes pass ``hot`` are for the trie and come uncounted; of the others n is the exact count.
    Of two phrases of a task with one 64-bit code only one is seen.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chosen = [f.value for f in filters], hot.value
        found = _Found()
        total: dict[str, int] = {}
        for batch in batches:
            for chunk in chunks(batch):
                for k, size in enumerate(np.bincount(chunk.lang, minlength=len(chunk.langs)).tolist()):
                    total[chunk.langs[k]] = total.get(chunk.langs[k], 0) + size
                for length, (at, codes) in enumerate(_phrases(chunk, known, WORDS), 1):
                    passed = known[length - 1].passes(codes)
                    found.add(chunk, length, at[passed], codes[passed], chosen)
                if len(found.counts) >= HELD:
                    yield from found.given_out()
        yield from found.given_out()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), *[pa.nulls(len(total), pa.string())] * len(_PLACES),
             pa.array(list(total.values()), pa.int64()), pa.array([False] * len(total), pa.bool_())], _FOUND)

    rows = map_batches(texts, run, "lang string, w1 string, w2 string, w3 string, n long, hot boolean")
    return rows.groupBy("lang", *_PLACES, "hot").agg(F.sum("n").alias("n"))


class PhraseTrie:
    """A trie of phrases: the language, then the words, as numbers of its own vocabulary in base 256."""

    def __init__(self, phrases: pa.Table) -> None:
        columns = [phrases.column(c).cast(pa.large_binary()).combine_chunks() for c in _PLACES]
        self.langs = pc.unique(phrases.column("lang")).to_pylist()
        self.words = pc.unique(pa.chunked_array(columns)).drop_null()
        self.digits = max(1, -(-(max(len(self.words), len(self.langs)) - 1).bit_length() // 8))
        numbers = [pc.index_in(phrases.column("lang"), pa.array(self.langs, pa.string()))]
        numbers += [pc.index_in(c, self.words) for c in columns]
        parts = [digits(pc.fill_null(x, -1).to_numpy().astype(np.int64), self.digits) for x in numbers]
        sequences = np.column_stack(parts).astype(np.int16)
        self.size = len(sequences)
        self.trie = DoubleArray(sequences, (sequences >= 0).sum(axis=1))
        self.ids = phrases.column("id").to_numpy()
        self.words = self.words.cast(pa.binary())

    def _roots(self, langs: list[str]) -> np.ndarray:
        """The state after each language, or -1."""
        numbers = digits(np.array([self.langs.index(x) if x in self.langs else -1 for x in langs]), self.digits)
        states, known = np.zeros(len(langs), np.int64), numbers[:, 0] >= 0
        for k in range(self.digits):
            states, _ = self.trie.step(states, np.maximum(numbers[:, k], 0))
        return np.where(known, states, -1)

    def count(self, chunk: Chunk) -> np.ndarray:
        """How often each phrase comes, in the order of the table; the states of all positions move on at once."""
        counts = np.zeros(self.size, np.int64)
        if not len(chunk.words) or not self.size:
            return counts
        word = pc.fill_null(pc.index_in(chunk.words, self.words), -1).to_numpy().astype(np.int64)
        states = self._roots(chunk.langs)[chunk.lang]
        at = np.flatnonzero((word >= 0) & (states >= 0))
        states = states[at]
        for length in range(len(_PLACES)):
            for k in reversed(range(self.digits)):
                states, there = self.trie.step(states, (word[at + length] >> (8 * k)) & 255)
                at, states = at[there], states[there]
            ends = self.trie.accept[states]
            counts += np.bincount(ends[ends >= 0], minlength=self.size)
            following = at + length + 1 < len(word)
            at, states = at[following], states[following]
            goes_on = chunk.joined[at + length + 1] & (word[at + length + 1] >= 0)
            at, states = at[goes_on], states[goes_on]
        return counts


def phrase_counts(texts: DataFrame, trie) -> DataFrame:
    """(id, f): the exact number of occurrences of the phrases of a trie that was sent to all tasks."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Fields, Fields]]:
        own = trie.value
        counts = np.zeros(own.size, np.int64)
        for batch in batches:
            for chunk in chunks(batch):
                counts += own.count(chunk)
        there = np.flatnonzero(counts)
        # Counts beyond 32 bits are given out in shares.
        while len(there):
            share = np.minimum(counts[there], (1 << 32) - 1)
            yield ({"key": own.ids[there].astype(_U) * _U(_SPREAD), "n": share.astype(np.uint32)},
                   {"id": np.zeros(0, np.int64), "f": np.zeros(0, np.int64)})
            counts[there] -= share
            there = there[counts[there] > 0]

    def answers(fields: Fields) -> Fields:
        keys, sums = _summed(fields["key"], fields["n"])
        return {"id": (keys * _U(_GATHERED)).view(np.int64), "f": sums}

    row = T.StructType([T.StructField("id", T.LongType()), T.StructField("f", T.LongType())])
    return by_key(texts, entries, answers, _COUNTED, {"id": "<i8", "f": "<i8"}, row)


def counted_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
    trie_phrases: int = TRIE_PHRASES,
) -> tuple[DataFrame, DataFrame]:
    """((lang, w1, w2, w3, f) of all phrases of 1 to 3 words with ``least`` occurrences, (lang, n) of all words)."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    short = stored(frequent_codes(texts, [], (1, 2), least), "codes")
    filters = [context.broadcast(filter_of(short))]
    filters = [filters[0], filters[0]]
    long = stored(frequent_codes(texts, filters, (3,), least), "codes")
    filters.append(context.broadcast(filter_of(long)))
    hot = context.broadcast(filter_of(most_frequent(short.unionByName(long), trie_phrases)))
    found = stored(candidates(texts, filters, hot), "phrases").withColumn("id", F.monotonically_increasing_id())
    for sent in (*filters[1:], hot):
        sent.unpersist()
    phrases = found.filter("w1 is not null")
    uncounted = stored(phrases.filter("hot").drop("n", "hot"), "trie")
    trie = context.broadcast(PhraseTrie(uncounted.toArrow()))
    counts = stored(phrase_counts(texts, trie), "counts")
    trie.unpersist()
    columns = ["lang", *_PLACES, "f"]
    frequent = uncounted.join(counts, "id").select(columns).unionByName(
        phrases.filter(~F.col("hot")).withColumnRenamed("n", "f").select(columns)).filter(F.col("f") >= least)
    return stored(frequent, "frequent"), found.filter("w1 is null").select("lang", "n")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), exact in 38 digits: ``SCALE`` at most, as no part is rarer than the whole."""
    a, left, right = (c.cast("decimal(19,0)") for c in (a, left, right))
    scaled = (a * a).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    product = (left * right).cast("decimal(38,0)")
    # Without its remainder the quotient is whole, so that no digit is rounded.
    return ((scaled - scaled % product) / product).cast("long")


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of the phrases of two words or more, by their lowest cut."""
    phrase = F.concat_ws(" ", *_PLACES)
    counts = frequent.select("lang", phrase.alias("phrase"), "f")
    size = sum((F.col(w).isNotNull().cast("int") for w in _PLACES), F.lit(0))
    whole = frequent.filter("w2 is not null").select(
        "lang", phrase.alias("phrase"), size.alias("size"), F.col("f").alias("a"), F.array(*_PLACES).alias("words"))
    cuts = whole.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({
        "first": F.array_join(F.slice("words", F.lit(1), F.col("cut")), " "),
        "rest": F.array_join(F.slice("words", F.col("cut") + 1, F.col("size") - F.col("cut")), " ")}).drop("words")
    for part, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(count)), ["lang", part])
    lowest = cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r"))).groupBy(
        "lang", "phrase", "size", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    return lowest.select("lang", "phrase", "size", "a", "low.l", "low.r", "low.score")


def covered(frequent: DataFrame, percent: int = COVERED) -> DataFrame:
    """(lang, phrase) of the pairs that lie inside a phrase of three words with ``percent`` of their occurrences."""
    longer = frequent.filter("w3 is not null").select(
        "lang", F.explode(F.array(F.concat_ws(" ", "w1", "w2"), F.concat_ws(" ", "w2", "w3"))).alias("phrase"),
        "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    pairs = frequent.filter("w2 is not null and w3 is null").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "f")
    return pairs.join(longer, ["lang", "phrase"]).filter(F.col("longer") * 100 >= F.col("f") * percent).select(
        "lang", "phrase")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
    trie_phrases: int = TRIE_PHRASES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two and three words of each language.

    Words are what blanks and tabs part, in lower case A-Z; a phrase does not cross
    ``.,;:!?`` or a line's end. ``a`` is the phrase's count, ``l`` and ``r`` those of its
    parts at the cut with the lowest score, ``n`` the number of the language's words.
    A null text is empty, a null language is ``und``. Repeated rows count each, ids and
    other columns are not looked at. Equal scores are in order of ``a``, then of the
    phrase's bytes, so reruns agree. Texts without a frequent phrase give no rows.
    """
    frequent, totals = counted_phrases(docs, text_col, lang_col, least, trie_phrases)
    left = scored(frequent).join(covered(frequent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = rf"""
    WITH pieces AS (
        SELECT doc_id, coalesce(lang, '{UNKNOWN}') AS lang, unnest(list_transform(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?
-
]'), lambda p: regexp_extract_all(p, '[^ 	]+'))) AS ws FROM documents),
    starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS pos FROM pieces WHERE len(ws) > 0),
    grams AS (SELECT lang, ws, pos, unnest(range(1, 1 + least({WORDS}, len(ws) - pos + 1))) AS size FROM starts),
    counts AS (
        SELECT lang, array_to_string(ws[pos:pos + size - 1], ' ') AS phrase, size, count(*) AS f FROM grams GROUP BY ALL),
    often AS (SELECT *, string_split(phrase, ' ') AS ws FROM counts WHERE f >= {LEAST}),
    totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY 1),
    cut AS (SELECT *, unnest(range(1, size)) AS k FROM often WHERE size > 1),
    judged AS (
        SELECT cut.lang, cut.phrase, cut.f AS a, x.f AS l, y.f AS r, k,
               (CAST({SCALE} AS HUGEINT) * cut.f * cut.f) // (CAST(x.f AS HUGEINT) * y.f) AS score
        FROM cut JOIN often x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.ws[1:k], ' ')
        JOIN often y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.ws[k + 1:], ' ')),
    lowest AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (
        SELECT lang, phrase, max(f) AS longer FROM (
            SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, f FROM often WHERE size = 3
            UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), f FROM often WHERE size = 3) GROUP BY ALL)
    SELECT lowest.lang, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank,
           lowest.phrase, a, l, r, n, CAST(score AS BIGINT) AS score
    FROM lowest JOIN totals ON totals.lang = lowest.lang
    LEFT JOIN inside ON inside.lang = lowest.lang AND inside.phrase = lowest.phrase
    WHERE longer IS NULL OR 100 * longer < {COVERED} * a
    QUALIFY rank <= {TOP}"""
