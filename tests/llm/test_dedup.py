"""The operators on copies against plain versions of what they compute."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from lodestrata.llm import components, cover_tree, exact_dedup, ngram_join, shingles, substring_dedup, tables
from lodestrata.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def groups_of(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def sets_of(texts):
    fold = {c: c + 32 for c in range(65, 91)}
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
        yield {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_by_hand(texts):
    """(set size, component as a place) of each text."""
    sets = list(sets_of(texts))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    found = groups_of(links, range(len(sets)))
    return [(len(s), found[i]) for i, s in enumerate(sets)]


def removed_by_hand(texts, span=400):
    data, seen = [(t or "").encode() for t in texts], {}
    for text in data:
        for k in range(len(text) - span + 1):
            seen[text[k:k + span]] = seen.get(text[k:k + span], 0) + 1
    for text in data:
        gone = np.zeros(len(text), bool)
        for k in range(len(text) - span + 1):
            if seen[text[k:k + span]] > 1:
                gone[k:k + span] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        yield len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def test_ngram_join_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    wanted = near_by_hand([t for _, t in rows])
    expected = {rows[k][0]: (n, min(r for r, (_, c) in zip((i for i, _ in rows), wanted) if c == group))
                for k, (n, group) in enumerate(wanted)}
    found = {r[0]: (r[1], r[2]) for r in QUERIES["op5_ngram_jaccard"](spark, SF_DIR).collect()}
    assert found == expected


def test_ngram_join_edges(docs, texts, empty):
    wanted = near_by_hand([t for _, t, *_ in texts])
    ids = [i for i, *_ in texts]
    least = [min((ids[m] for m, (_, c) in enumerate(wanted) if c == group and ids[m] is not None), default=None)
             for _, group in wanted]
    expected = sorted((str(i), n, str(c)) for i, (n, _), c in zip(ids, wanted, least))
    found = sorted((str(r[0]), r[1], str(r[2])) for r in ngram_join.near_copies(docs).collect())
    assert found == expected
    assert ngram_join.near_copies(empty).count() == 0


def test_ngram_join_splits_large_groups(spark, monkeypatch):
    """Many near copies around the limit of similarity, in blocks of a few sets."""
    monkeypatch.setattr(ngram_join, "BLOCK", 200)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for _ in range(90):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    wanted = near_by_hand(texts)
    found = ngram_join.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == dict(enumerate(wanted))
    assert len({c for _, c in wanted}) > 1


def test_trie_finds_what_all_pairs_find():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 30)) for _ in range(60)] + [np.arange(5)] * 2 + [np.zeros(0, np.int64)]
    trie = ngram_join.Trie(sets)
    for probe in sets:
        mask = np.zeros(61, bool)
        mask[probe] = True
        allowed = np.full(len(sets), 12)
        found = dict(trie.walk(mask, np.arange(len(sets)), allowed))
        plain = {k: int(mask[s].sum()) for k, s in enumerate(trie.sets) if len(s) - mask[s].sum() <= 12}
        assert found == plain


def test_word_hashes_follow_words():
    import pyarrow as pa

    texts = ["a b", None, "", "A\tb c", "x" * 3000, "b a"]
    (_, _, data, offsets), = shingles.slices(pa.array(texts))
    hashes, lengths, starts = shingles.words(data, offsets)
    assert starts.tolist() == [0, 2, 2, 2, 5, 6, 8]
    assert hashes[0] == hashes[2] == hashes[7] and hashes[1] == hashes[3] == hashes[6]
    assert len(set(hashes.tolist())) == 4 and lengths.tolist() == [1, 1, 1, 1, 1, 3000, 1, 1]


def test_substrings_equal_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    wanted = dict(zip((r[0] for r in rows), removed_by_hand([r[1] for r in rows])))
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op10_suffix_array_dedup"](spark, SF_DIR).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    assert found == wanted and any(w[2] for w in wanted.values())


def test_substring_edges(docs, texts, empty):
    wanted = sorted((str(i), *w) for (i, *_), w in zip(texts, removed_by_hand([t for _, t, *_ in texts])))
    removed = substring_dedup.remove_repeats(docs, with_text=True)
    found = removed.select("doc_id", "n_bytes", "n_removed", F.size("starts"), "kept_sha256").collect()
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in found) == wanted
    assert all(hashlib.sha256(r[0]).hexdigest() == r[1] for r in removed.select("kept", "kept_sha256").collect())
    short = substring_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", F.size("starts"), "kept_sha256")
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in short.collect()) == wanted
    assert substring_dedup.remove_repeats(empty).count() == 0


def starts_by_tasks(texts, tasks):
    """(text, start) of all repeated strings, with the entries of each task settled on their own."""
    data = [np.frombuffer(t, np.uint8) for t in texts]

    def joined(parts):
        return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}

    def entries(k):
        key, whole, first, last = substring_dedup.coarse(data[k])
        return {"key": key, "whole": whole, "owner": np.full(len(key), k, np.uint64), "first": first.astype(np.uint32),
                "last": last.astype(np.uint32), "weight": np.full(len(key), substring_dedup.ONE, np.uint8)}

    sent, found = zip(*(substring_dedup.settle_coarse(joined([entries(k) for k in task])) for task in tasks))
    found = joined([*found, substring_dedup.answer_coarse(joined(sent))])
    ranges = list(zip(*(found[c].tolist() for c in ("owner", "first", "last", "fine"))))
    asked = [(k, s) for k, first, last, fine in ranges if fine for s in range(first, last + 1)]
    repeated = {(k, s) for k, first, last, fine in ranges if not fine for s in range(first, last + 1)}
    names = {}
    for k, s in set(asked):
        names.setdefault(texts[k][s : s + substring_dedup.SPAN], []).append((k, s))
    return repeated.union(*(places for places in names.values() if len(places) > 1))


def test_repeats_over_tasks():
    rng = np.random.default_rng(3)

    def letters(n):
        return rng.integers(97, 123, n, np.uint8).tobytes()

    for _ in range(20):
        passage = letters(900)
        texts = [letters(20) + passage + letters(20), letters(20) + passage[rng.integers(20, 200) : -rng.integers(20, 200)] + letters(10),
                 letters(30) + passage + letters(30), passage[rng.integers(20, 200) :] + letters(1)]
        places = {}
        for k, t in enumerate(texts):
            for s in range(len(t) - substring_dedup.SPAN + 1):
                places.setdefault(t[s : s + substring_dedup.SPAN], set()).add((k, s))
        for n in (3, 4):
            plain = set()
            for p in ({x for x in p if x[0] < n} for p in places.values()):
                plain |= p if len(p) > 1 else set()
            # Of the first task's texts only one is heard of elsewhere, as the head of a mixed bucket.
            for tasks in ([[0, 1], [2]], [[0], [1, 2]], [[0, 2], [1]], [[0], [1], [2]]):
                assert starts_by_tasks(texts[:n], [*tasks, *([3] for _ in range(n - 3))]) == plain


def test_row_filter_keeps_what_is_meant(spark, monkeypatch):
    keys, rows = spark.range(-50, 5000, 7).toDF("row"), spark.range(-100, 6000).select(F.col("id").alias("row"), F.lit("x").alias("text"))
    wanted = {r.row for r in keys.collect()}
    found = [r.row for r in tables.likely_rows(rows, keys).collect()]
    assert wanted <= set(found) and len(found) == len(set(found)) < len(wanted) + 10
    monkeypatch.setattr(tables, "FILTER_BITS", 64)
    assert wanted <= {r.row for r in tables.likely_rows(rows, keys).collect()}
    assert tables.likely_rows(rows, keys.limit(0)).isEmpty()


def exact_by_hand(rows):
    keys = [hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest() for _, t in rows]
    for (i, _), key in zip(rows, keys):
        group = [(-len(t or ""), j is None, j) for (j, t), k in zip(rows, keys) if k == key]
        keep = min(group, key=lambda g: (g[0], g[1], g[2] or 0))[2]
        yield str(i), str(keep), len(group), i == keep, key


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda b: F.substring(F.sha2(b, 256), 1, 1)])
def test_exact_dedup_edges(spark, docs, texts, tmp_path, digest):
    """Also with a digest of one character, where only the full bytes tell texts apart."""
    docs.repartition(3).write.parquet(f"{tmp_path}/docs")
    found = exact_dedup.exact_dedup(spark, f"{tmp_path}/docs", digest=digest, batch_bytes=1)
    wanted = sorted(exact_by_hand([(i, t) for i, t, *_ in texts]))
    assert sorted((str(r[0]), str(r[1]), *tuple(r)[2:]) for r in found.collect()) == wanted


def test_exact_dedup_state_goes_on(spark, tmp_path):
    """A later run over more files keeps the state of the earlier one."""
    schema = "id long, chars int, locator string, digest string"
    source = f"{tmp_path}/in"

    def state():
        stream = spark.readStream.schema(schema).parquet(source)
        found = exact_dedup.run_state(stream, f"{tmp_path}/state")
        return {r.digest: (r.keep_id, r.group_size, r.locator) for r in found.collect()}

    spark.createDataFrame([(5, 3, "f1", "a"), (6, 3, "f1", "b")], schema).write.parquet(source)
    assert state() == {"a": (5, 1, "f1"), "b": (6, 1, "f1")}
    spark.createDataFrame([(4, 3, "f2", "a"), (7, 9, "f2", "b")], schema).write.mode("append").parquet(source)
    assert state() == {"a": (4, 2, "f2"), "b": (7, 2, "f2")}


def test_exact_dedup_of_nothing(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/none")
    assert exact_dedup.exact_dedup(spark, f"{tmp_path}/none").count() == 0


def vectors_by_hand(vectors):
    def usable(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if usable(v) else None for v in vectors]
    links = [(i, j) for i in range(len(unit)) for j in range(i) if unit[i] is not None and unit[j] is not None
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95]
    found = groups_of(links, range(len(unit)))
    return [(sum(k in pair for pair in links), found[k]) for k in range(len(unit))]


def test_vectors_equal_all_pairs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    wanted = vectors_by_hand([r.embedding for r in rows])
    found = QUERIES["op6_embedding_near_dedup"](spark, SF_DIR).orderBy("vec_id").collect()
    ids = [r.vec_id for r in rows]
    assert [(r.n_links, r.component_id) for r in found] == [(n, ids[c]) for n, c in wanted]
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_vector_edges_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 7)
    rng = np.random.default_rng(2)
    near = [(np.array([1.0, 0, 0, 0]) + rng.normal(0, 0.12, 4)).tolist() for _ in range(30)]
    plain = [rng.normal(0, 1, 4).tolist() for _ in range(30)]
    odd = [None, [], [0.0] * 4, [1.0, None, 0.0, 0.0], [float("nan"), 1.0, 0.0, 0.0],
           [float("inf"), 1.0, 0.0, 0.0],
           [2.0, 0.0, 0.0, 0.0], [1e-200, 0.0, 0.0, 0.0], [1.0, 0.0], [2.0, 0.0]]
    vectors = near + plain + odd
    # Tiny numbers have a direction too, though the plain norm of them underflows.
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r[0]: (r[1], r[2]) for r in cover_tree.near_vectors(df).collect()}
    tiny = len(near) + len(plain) + 7
    assert found[tiny][0] == found[tiny - 1][0]
    for k, pair in enumerate(vectors_by_hand(vectors[:tiny] + [[1.0, 0, 0, 0]] + vectors[tiny + 1:])):
        assert found[k] == pair, k
    assert cover_tree.near_vectors(df.limit(0)).count() == 0


def test_vectors_are_shuffled_once_and_meet_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 16)
    monkeypatch.setattr(cover_tree, "BROADCAST", 40 * 6 * 8, raising=False)
    plans, write = [], DataFrameWriter.parquet

    def spy(writer, *args, **options):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    rng = np.random.default_rng(5)
    loose = np.concatenate([rng.normal(0, 1, (120, 6)), rng.normal(0, 1, 6) + rng.normal(0, 0.35, (60, 6))])
    vectors = np.concatenate([loose, np.repeat(loose[:1], 40, 0)]).astype(np.float32).tolist()
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    found = {r[0]: (r[1], r[2]) for r in cover_tree.near_vectors(df).collect()}
    assert [found[k] for k in range(len(vectors))] == vectors_by_hand(vectors)
    # Not a copy of it for each block that its own is compared with.
    assert sum("FlatMapGroupsInArrow" in p for p in plans) == 1 and not any("Generate" in p for p in plans)
    assert sum("MapInArrow" in p and "NestedLoopJoin" in p for p in plans) > 2


@pytest.mark.parametrize(("width", "groups", "spread"), [(64, 20, 0.3), (64, 3, 0.1), (4, 5, 0.5), (200, 30, 0.05), (1, 2, 0.1)])
def test_blocks_met_in_a_task_equal_all_pairs(width, groups, spread):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(groups, width))
    blocks = [cover_tree.unit(centres[rng.integers(0, groups, 300)] + spread * rng.normal(size=(300, width))) for _ in range(2)]
    blocks.append(blocks[0][::2])
    rows = np.split(np.arange(750), [300, 600])
    trees, met, links, edges = [cover_tree.Tree(x, cover_tree.cover(x)) for x in blocks], cover_tree.Met(0.95), np.zeros(750, int), []
    at, out = [met.sent(r) for r in rows], []
    for i in range(3):
        met.pass_by(rows[i])
        for j in range(i, 3):
            met.meet(trees[i], trees[j], at[j], i == j)
        out.append(met.went())
    for batch in [*out, met.stayed()]:
        row, n, other = (c.to_pylist() for c in batch.columns)
        np.add.at(links, row, n)
        edges += [(a, b) for a, b in zip(row, other) if a != b]
    x = np.concatenate(blocks)
    near = (x @ x.T >= 0.95) & ~np.eye(750, dtype=bool)
    assert links.tolist() == near.sum(1).tolist()
    assert groups_of(edges, range(750)) == groups_of(zip(*(v.tolist() for v in np.nonzero(near))), range(750))


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    found = {r[0]: r[1] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == groups_of(links, nodes)


def test_hits_of_a_set_are_one_row_over_any_number_of_parts(spark):
    """They were a row for each part of the n-grams, so their number grew with the partitions as well."""
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words)] * 2 + [" ".join([*words[:390], *[f"x{k}" for k in range(10)]]), "alone in the world of words"]
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("2", "24"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            counts = ngram_join.shared_counts(rows, 5, 75)
            assert "Aggregate" not in counts._jdf.queryExecution().optimizedPlan().toString()
            found.append(sorted(tuple(r) for r in counts.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len({owner for owner, _ in found[0]}) == len(found[0]) == 2
