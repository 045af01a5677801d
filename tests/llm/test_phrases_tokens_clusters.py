"""Collocations, token files and centroid clustering against plain versions."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import re
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers

from lodestrata.llm import bit_packing, centroids, collocations, queries, token_files
from lodestrata.llm.double_array import DoubleArray, digits

SF_DIR = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("word_bpe_49k.json")
MODEL_TEXT = token_files._model(MODEL)[0]


def plain_collocations(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, *words[k : k + size]) for k in range(len(words) - size + 1))
    often = {p: c for p, c in f.items() if c >= least and len(p) > 2}
    found = {}
    for (lang, *words), a in often.items():
        if len(words) == 2 and any(
                100 * c >= collocations.COVERED * a for (x, *ws), c in often.items()
                if x == lang and len(ws) == 3 and words in (ws[:2], ws[1:])):
            continue
        cuts = [(10**6 * a * a // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.setdefault(lang, []).append(
            (-score, -a, " ".join(words).encode(), f[lang, *words[:k]], f[lang, *words[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, own in found.items() for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1))


def phrase_rows():
    rng = np.random.default_rng(5)
    words = ["New", "york", "ÉTÉ", "city", "a", "b\x00", "漢字", "le", "x" * 300]
    rows = [(" ".join(rng.choice(words, 12, p=[.2, .2, .1, .1, .1, .1, .1, .05, .05])), lang)
            for lang in ("en", "fr", None, "und", "") for _ in range(25)]
    rows += [("new york city. New\tyork, city; a!a?a\nb\rnew\x0byork", "en")] * 12
    return rows + [(None, "en"), ("", "fr"), (" \t\n", None), ("city " * 4000, "en"), ("lonely", "xx")]


@pytest.mark.parametrize("trie_phrases", [collocations.TRIE_PHRASES, 30, 0])
def test_collocations(spark, trie_phrases):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "text string, lang string").withColumns(
        {c: F.lit("clash") for c in ("rank", "phrase", "w1", "n", "id", "f", "score", "hot")})
    found = collocations.collocations(df, least=5, top=40, trie_phrases=trie_phrases)
    assert sorted(tuple(r) for r in found.collect()) == plain_collocations(rows, 5, 40)


def test_collocations_of_nothing(spark, empty):
    assert collocations.collocations(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.sets(st.lists(st.integers(0, 255), min_size=1, max_size=6).map(tuple), min_size=1, max_size=80))
def test_double_array(sequences):
    rows = sorted(sequences)
    table = np.array([[*r, *[-1] * (6 - len(r))] for r in rows])
    trie = DoubleArray(table, np.array([len(r) for r in rows]))

    def accepted(sequence):
        state = np.zeros(1, np.int64)
        for symbol in sequence:
            state, there = trie.step(state, np.array([symbol]))
            if not there[0]:
                return -1
        return trie.accept[state[0]]

    assert [accepted(r) for r in rows] == list(range(len(rows)))
    assert all((accepted(r[:-1]) >= 0) == (r[:-1] in sequences) for r in rows if len(r) > 1)
    assert all(accepted((*r, 7)) == (rows.index((*r, 7)) if (*r, 7) in sequences else -1) for r in rows)


def test_digits():
    assert digits(np.array([0, 255, 256, 70000, -1]), 3).tolist() == [
        [0, 0, 0], [0, 0, 255], [0, 1, 0], [1, 17, 112], [-1, -1, -1]]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 32).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, (1 << b) - 1), max_size=70))))
def test_packing(case):
    bits, numbers = case
    packed = bit_packing.pack(np.array(numbers, np.uint32), bits)
    assert len(packed) == math.ceil(len(numbers) * bits / 8)
    assert bit_packing.unpack(packed, len(numbers), bits).tolist() == numbers
    whole = sum(n << (bits * k) for k, n in enumerate(numbers))
    assert int.from_bytes(packed, "little") == whole


def test_packing_refuses_large_numbers():
    with pytest.raises(ValueError):
        bit_packing.pack(np.array([8], np.uint32), 3)
    assert [bit_packing.bits_for(n) for n in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def plain_tokens(rows):
    tokenizer = Tokenizer.from_file(MODEL)
    found, at = [], 0
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        found.append((key, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return found


def test_tokens_of_the_table(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    found = queries.op12_token_ids(spark, SF_DIR).orderBy("start").collect()
    assert [tuple(r) for r in found] == plain_tokens(rows)


def test_token_edges(spark, docs, empty, tmp_path):
    special = [
        (50, "a<|endoftext|>b <|startoftext|>"), (51, "don't  STOP now İΣ ς"), (52, "é ́ \x85\x0b\x0c\x1c"),
        (53, "x" * 5000), (54, "\r\n\t 12 3.4 !!! 漢字😀"), (-3, "'s 't'RE"), (0, "\x00"),
    ]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(special, "doc_id long, text string"))
    path = str(tmp_path / "ids")
    found = token_files.token_index(df.withColumns({c: F.lit(1) for c in ("id", "row", "ids", "n", "file")}),
                                    MODEL, path=path, file_bytes=8000)
    assert found.select("file").distinct().count() > 3
    got = [tuple(r)[:4] for r in found.orderBy("start").collect()]
    starts = dict.fromkeys(s for _, s, _, _ in got)
    assert [k is None for k, *_ in got] == sorted((k is None for k, *_ in got), reverse=True)
    keys = [k for k, *_ in got if k is not None]
    assert keys == sorted(keys) and len(starts) == len(got)
    plain = plain_tokens(df.collect())
    assert Counter((k, n, c) for k, _, n, c in got) == Counter((k, n, c) for k, _, n, c in plain)
    assert all(s + n == t for (_, s, n, _), (_, t, _, _) in zip(got, got[1:]))
    content = spark.read.format("binaryFile").load(path + "/part-*").orderBy(F.desc("length")).first().content
    file = token_files.TokenFile(content)
    whole = file.ids(0, file.n_ids)
    rng = np.random.default_rng(1)
    for a, b in np.sort(rng.integers(0, file.n_ids + 1, (40, 2)), axis=1):
        assert (file.ids(a, b) == whole[a:b]).all()
    assert (np.concatenate([file.document(k) for k in range(len(file))]) == whole).all()
    with pytest.raises(IndexError):
        file.ids(0, file.n_ids + 1)
    with pytest.raises(ValueError):
        token_files.TokenFile(content[:-5])
    assert token_files.token_index(empty, MODEL).count() == 0


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, add_special_tokens):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)


def encoded(encoder, texts):
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


def test_few_texts_reach_the_tokenizer():
    encoder = token_files.Encoder(MODEL_TEXT, 1)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    forms = [f"{w}{m}" for k in range(300) for m in ("", ".", ",", "!?", "7") for w in (f"wé{'ab' * (k % 17)}{'c' * k}", f"W{'d' * k}")]
    texts = [" ".join(forms[k : k + 50]) for k in range(0, len(forms), 50)]
    plain = Tokenizer.from_file(MODEL)
    assert encoded(encoder, texts) == [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    # One for each different word before.
    assert counted.texts < 10


PIECES = [*"abJSé×ß0159'.,<=>|! \t\n", "É", "'S", "'re", "'LL", "\u030c", "\u0301", "\u0338", "\u0344", "\u20e3", "\u212a", "\u037e",
          "\u0130", "\u0345", "\x0b", "\x85", "\u3000", "\x00", "漢", "½", "😀", "<|endoftext|>", "<|EndOfText|>", "<|", "endoftext", "|>"]


ENCODER = token_files.Encoder(MODEL_TEXT, 1)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=9).map("".join), min_size=1, max_size=30))
def test_parted_words(texts):
    assert ENCODER.ends is not None
    assert encoded(ENCODER, texts) == [[*e.ids, 1] for e in ENCODER.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_other_steps_part_nothing():
    tokenizer = Tokenizer.from_str(MODEL_TEXT)
    tokenizer.normalizer = normalizers.NFC()
    encoder = token_files.Encoder(tokenizer.to_str(), 1)
    texts = ["Don't STOP, it's 12.", "a<|endoftext|>B"]
    assert encoder.ends is None
    assert encoded(encoder, texts) == [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def plain_clusters(rows, k, rounds):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    points = np.array([v for _, v in kept])
    centres = points[:k].copy()
    for step in range(rounds + 1):
        squares = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
        own = squares.argmin(axis=1)
        if step < rounds:
            for c in set(own.tolist()):
                centres[c] = points[own == c].sum(axis=0) // (own == c).sum()
    best = squares.min(axis=1)
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]
    return sorted(((kept[j][0], int(own[j]), int(best[j]), int(best[own == own[j]].sum()), int(best.sum()),
                    digest[own[j]]) for j in range(len(kept))), key=str)


def test_clusters(spark):
    rng = np.random.default_rng(2)
    near = rng.normal(size=(30, 64))
    rows = [(i, (near[i % 30] + rng.normal(scale=.3, size=64)).tolist()) for i in range(700)]
    rows += [(1000 + i, near[0].tolist()) for i in range(40)] + [(5, near[1].tolist()), (5, near[1].tolist())]
    rows += [(None, near[2].tolist()), (None, near[3].tolist()), (2000, None), (2001, []), (2002, [1.0] * 63),
             (2003, [1.0] * 63 + [None]), (2004, [1.0] * 63 + [float("nan")]), (2005, [1.0] * 63 + [float("inf")]),
             (2006, [0.0] * 64), (2007, [-5000.5] * 64), (2008, [1.0] * 65)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("x") for c in ("id", "vector", "cluster", "distance", "block")}).repartition(3)
    found = sorted((tuple(r) for r in centroids.clustered(df).collect()), key=str)
    assert found == plain_clusters(rows, 40, 5)
    few = df.filter("vec_id < 3")
    assert sorted((tuple(r) for r in centroids.clustered(few).collect()), key=str) == plain_clusters(rows[:3], 40, 5)
    assert centroids.clustered(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="63 bits"):
        centroids.clustered(df.withColumn("embedding", F.array_repeat(F.lit(1e9), 64))).count()


def test_heaps_take_out_what_expired():
    rng = np.random.default_rng(3)
    cluster, key = rng.integers(0, 7, 500), rng.normal(size=500)
    heaps = centroids.Heaps(cluster, key, 8)
    drift = rng.normal(size=8)
    again = centroids.Heaps.from_bytes(memoryview(heaps.to_bytes()), 500, 8)
    assert set(again.rows[again.expired(drift)].tolist()) == set(np.flatnonzero(key < drift[cluster]).tolist())


def test_few_vectors_are_looked_at_again(spark):
    """Once the centroids hardly move, most vectors stay in their heaps."""
    rng = np.random.default_rng(4)
    near = rng.normal(size=(40, 64))
    vectors = np.floor(256 * (near[np.arange(4000) % 40] + rng.normal(scale=.02, size=(4000, 64)))).astype(np.int64)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<long>")
    blocks = spark.createDataFrame(centroids._blocks(rows, 64).toPandas())
    start = vectors[:40]
    state = centroids.begin(blocks, start, 64)
    sums = centroids._changes(state, 40, 64)
    moved = sums[:, 1:] // sums[:, :1]
    state = centroids.advance(blocks, state, moved, centroids.drifts(start, moved), 64)
    assert state.agg(F.sum("n_scanned")).first()[0] < 400
