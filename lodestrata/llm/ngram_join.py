"""Documents whose sets of word n-grams are alike, by a join over prefix trees.

All sets are put in one order of their n-grams, rare ones first, and kept in a
trie. A probe walks the trie once: sets that begin alike share the count of what
they have in common with it, and a subtree is left as soon as what remains is too
short to reach the similarity.

Before that, documents that can have no partner are set aside, exactly:

1. Equal sets become one.
2. If two sets are alike, their first 25 % + k n-grams by hash share k n-grams at
   least. Sets with fewer shared ones are out; k is 5 % of the set.
3. All n-grams of the rest are counted. A set needs 75 % shared n-grams to stay.

What is left is nearly all copies. It is joined in two steps, so that a large
group of copies costs a link each and not a pair each: first every set with one
other set of its bucket (a bucket is an n-gram that is early in the order of its
sets), then only sets that could be alike and are not connected yet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.arrow import map_batches, ship
from lodestrata.llm.components import components
from lodestrata.llm.packed import Fields, by_key, runs
from lodestrata.llm.shingles import mix, shingle_sets
from lodestrata.llm.tables import numbered, stored, with_rows

WORDS, PERCENT = 5, 75
# N-grams of the sets in one block of a trie task, and entries a task packs at once.
BLOCK, CHUNK = 100_000, 1 << 18
_U = np.uint64


def _least_overlap(n, percent: int):
    """What a set of n must share with any partner: ceil(n * percent / 100)."""
    return (n * percent + 99) // 100


def _extra(n):
    return np.maximum(1, n // 20)


def _signature(grams: np.ndarray) -> tuple[int, int]:
    return tuple(int(np.add.reduce(mix(grams + _U(k)))) - (1 << 63) for k in (1, 2))


def measured(rows: DataFrame, words: int) -> DataFrame:
    """(row, n, s1, s2): the size of each set and a 128-bit signature of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), *_signature(s)) for s in shingle_sets(batch.column(1), words)]
            columns = zip(*found) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=["row", "n", "s1", "s2"])

    return map_batches(rows.select("row", "text"), run, "row long, n long, s1 long, s2 long")


_ENTRY = {"key": "<u8", "owner": "<i8", "weight": "u1"}
_HITS = {"owner": "<i8", "hits": "<u4"}
_HITS_ROW = T.StructType([T.StructField("owner", T.LongType()), T.StructField("hits", T.LongType())])


def _counted(fields: Fields) -> tuple[Fields, np.ndarray]:
    order = np.lexsort((fields["weight"], fields["owner"], fields["key"]))
    fields = {k: v[order] for k, v in fields.items()}
    same = np.zeros(len(order), bool)
    same[1:] = (fields["key"][1:] == fields["key"][:-1]) & (fields["owner"][1:] == fields["owner"][:-1])
    # Copies bring the same entry again; an entry that stands for several stays.
    same &= fields["weight"] == 1
    fields = {k: v[~same] for k, v in fields.items()}
    if not len(fields["key"]):
        return fields, np.zeros(0, np.int64)
    cuts = runs(fields["key"])
    return fields, np.repeat(np.add.reduceat(fields["weight"].astype(np.int64), cuts[:-1]), np.diff(cuts))


def _hits(owners: np.ndarray) -> Fields:
    owner, hits = np.unique(owners, return_counts=True)
    return {"owner": owner, "hits": hits.astype(np.uint32)}


def _summed(fields: Fields) -> Fields:
    """One row for each owner, however many parts of the keys it has hits in."""
    owner, at = np.unique(fields["owner"], return_inverse=True)
    return {"owner": owner, "hits": np.bincount(at, fields["hits"], len(owner)).astype(np.uint32)}


def _settle(fields: Fields) -> tuple[Fields, Fields]:
    """N-grams that a task sees twice count at once; one entry tells others of them."""
    fields, size = _counted(fields)
    repeated = size > 1
    heads = np.zeros(len(size), bool)
    heads[runs(fields["key"])[:-1]] = len(size) > 0
    known = _hits(fields["owner"][repeated])
    fields["weight"] = np.where(repeated, 2, 1).astype(np.uint8)
    return {k: v[~repeated | heads] for k, v in fields.items()}, known


def _answer(fields: Fields) -> Fields:
    fields, size = _counted(fields)
    return _hits(fields["owner"][(size > 1) & (fields["weight"] == 1)])


def shared_counts(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(owner, hits): how many of the first n-grams of a set other sets have among their first ones."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Fields, Fields]]:
        keys, owners, size = [], [], 0

        def joined() -> tuple[Fields, Fields]:
            fields = {"key": np.concatenate(keys), "owner": np.concatenate(owners)}
            return _settle(fields | {"weight": np.ones(len(fields["key"]), np.uint8)})

        for batch in batches:
            for grams in shingle_sets(batch.column(0), words):
                n = len(grams)
                if n:
                    # A copy, so that the rest of the set is let go.
                    first = grams[: n - _least_overlap(n, percent) + int(_extra(n)) + 1].copy()
                    keys.append(first)
                    owners.append(np.full(len(first), _signature(grams)[0]))
                    size += len(first)
            if size >= CHUNK:
                yield joined()
                keys, owners, size = [], [], 0
        if size:
            yield joined()

    return by_key(rows.select("text"), entries, _answer, _ENTRY, _HITS, _HITS_ROW, _summed)


def _grams(rows: DataFrame, words: int) -> DataFrame:
    """(row, n, grams) with all n-grams of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = list(shingle_sets(part.column(1), words))
                lengths = [len(s) for s in sets]
                offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths, pa.int64()), lists], names=["row", "n", "grams"])

    return map_batches(rows.select("row", "text"), run, "row long, n long, grams array<long>")


class Trie:
    """Sets as sorted ranks, in lexicographic order: each shares a prefix with the one before it."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.order = np.array(order, np.int64)
        self.sets = [sets[i] for i in order]
        self.shared = np.zeros(len(order), np.int64)
        for k in range(1, len(order)):
            a, b = self.sets[k - 1], self.sets[k]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.shared[k] = differ[0] if len(differ) else m

    def walk(self, mask: np.ndarray, wanted: np.ndarray, misses: np.ndarray) -> Iterator[tuple[int, int]]:
        """(position, common n-grams) of the wanted sets with no more misses than allowed.

        ``counts`` has the overlap for each depth of the current path. The part of it
        that the next set shares is kept, and a set whose shared part has too many
        misses already is passed over without a look at the rest of it.
        """
        counts, before = np.zeros(1, np.int64), -1
        for k, allowed in zip(wanted.tolist(), misses.tolist()):
            depth = int(self.shared[before + 1 : k + 1].min()) if before >= 0 else 0
            depth = min(depth, len(counts) - 1)
            counts, before, ranks, step = counts[: depth + 1], k, self.sets[k], 32
            while depth - counts[-1] <= allowed and depth < len(ranks):
                more = counts[-1] + np.cumsum(mask[ranks[depth : depth + step]])
                counts = np.concatenate((counts, more))
                depth, step = len(counts) - 1, step * 4
            if depth == len(ranks) and depth - counts[-1] <= allowed:
                yield k, int(counts[-1])


def linked_in(table: pa.Table, percent: int) -> pa.Table:
    """Links between sets of one task that are alike and in different components yet; no more than make them one.

    Columns: role (0: in the trie, 1: probe, 2: both), component, node, n, and the
    n-grams with their counts, in order.
    """
    role, label, node, n = (table.column(c).to_numpy() for c in ("role", "component", "node", "n"))
    table = table.combine_chunks()
    lists = table.column("grams").chunk(0) if table.num_rows else None
    flat = lists.flatten()
    counts, grams = np.asarray(flat.field(0)), np.asarray(flat.field(1))
    order = np.lexsort((grams, counts))
    new = np.concatenate(([True], (np.diff(grams[order]) != 0) | (np.diff(counts[order]) != 0))) if len(order) else order
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new) - 1
    ends = np.cumsum(np.asarray(lists.value_lengths()))
    sets = np.split(ranks, ends[:-1])
    label, found = label.copy(), []
    members = np.flatnonzero(role != 1)
    trie = Trie([sets[i] for i in members])
    rows = members[trie.order]
    lengths = np.array([len(s) for s in trie.sets])
    mask = np.zeros(int(ranks.max()) + 1 if len(ranks) else 1, bool)
    place = {int(r): k for k, r in enumerate(rows)}
    for probe in np.flatnonzero(role != 0).tolist():
        after = place[probe] + 1 if role[probe] == 2 else 0
        mask[sets[probe]] = True
        least = ((n[probe] + n[rows]) * percent + 100 + percent - 1) // (100 + percent)
        misses = lengths - least
        possible = (misses >= 0) & (np.minimum(len(sets[probe]), lengths) >= least)
        while after < len(rows):
            wanted = after + np.flatnonzero(possible[after:] & (label[rows[after:]] != label[probe]))
            for k, common in trie.walk(mask, wanted, misses[wanted]):
                if 100 * common >= percent * (n[probe] + n[rows[k]] - common):
                    found.append((int(node[probe]), int(node[rows[k]])))
                    label[label == label[rows[k]]] = label[probe]
                    after = k + 1
                    break
            else:
                break
        mask[sets[probe]] = False
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _blocks(total: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(total / BLOCK)).cast("int")


def _block_of(node: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(node), blocks).cast("int")


_TASK = ["part", "one", "two"]


def _run(tasks: DataFrame, percent: int) -> DataFrame:
    ship(tasks.sparkSession)
    return tasks.groupBy(*_TASK).applyInArrow(lambda table: linked_in(table, percent), "a long, b long")


def star_links(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each set against the first of its bucket; a pivot's partners are parted into blocks."""
    sized = stars.join(sets.select(F.col("row").alias("node"), "n", "grams"), "node")
    blocks = stored(sized.groupBy("pivot").agg(_blocks(F.sum(F.size("grams"))).alias("blocks")), "shingle-blocks")
    members = sized.join(blocks, "pivot").select(
        F.col("pivot").alias("part"), _block_of(F.col("node"), F.col("blocks")).alias("one"), F.lit(0).alias("two"),
        F.lit(0).alias("role"), F.col("node").alias("component"), "node", "n", "grams")
    probes = blocks.join(sets, blocks.pivot == sets.row).select(
        F.col("pivot").alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("one"),
        F.lit(0).alias("two"), F.lit(1).alias("role"), F.col("pivot").alias("component"),
        F.col("pivot").alias("node"), "n", "grams")
    return _run(members.unionByName(probes), percent)


def rest_links(clusters: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links in clusters that are not one component yet.

    ``clusters`` has node, cluster and component. The largest component of a cluster
    is its base; the sets of the others are compared with each other and with the
    base, block by block. Sets of the base are not compared with each other.
    """
    sized = clusters.join(sets.select(F.col("row").alias("node"), "n", "grams"), "node")
    by_component = stored(
        sized.groupBy("cluster", "component").agg(F.sum(F.size("grams")).alias("size")), "shingle-components")
    shape = by_component.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("components"), F.max(F.struct("size", "component")).alias("base"),
        F.sum("size").alias("size"),
    ).filter("components > 1").select(
        "cluster", F.col("base.component").alias("base"), _blocks(F.col("base.size")).alias("base_blocks"),
        _blocks(F.col("size") - F.col("base.size")).alias("rest_blocks"))
    open_sets = sized.join(stored(shape, "shingle-open"), "cluster")
    columns = ["component", "node", "n", "grams"]
    base = open_sets.filter("component = base").select(
        F.col("cluster").alias("part"), F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("one"),
        (-1 - _block_of(F.col("node"), F.col("base_blocks"))).alias("two"), F.lit(0).alias("role"), *columns)
    own = _block_of(F.col("node"), F.col("rest_blocks"))
    rest = open_sets.filter("component <> base").withColumn("own", own)
    against = rest.select(
        F.col("cluster").alias("part"), F.col("own").alias("one"),
        F.explode(F.sequence(-F.col("base_blocks"), F.lit(-1))).alias("two"), F.lit(1).alias("role"), *columns)
    other = rest.select("*", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("other"))
    among = other.select(
        F.col("cluster").alias("part"), F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("role"),
        *columns)
    return _run(base.unionByName(against).unionByName(among), percent)


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``.

    Words are runs of non-blank characters, A-Z folded; a set has the distinct runs
    of ``words`` words, or all words of a shorter text. Two documents link when
    ``100 * common >= percent * union``; ``component_id`` is the least id that links
    lead to. Texts that are null, empty or blank have no n-grams and no links.

    Repeated rows, and repeated or null ids, are documents of their own; of a
    component with null ids the least other id counts. N-grams are compared by
    64-bit hashes. Other columns are not read.
    """
    rows, own_ids = numbered(docs, id_col, text_col)
    named = row_groups(rows, words, percent)
    if own_ids:
        return named.withColumnRenamed("row", id_col)
    with_ids = named.join(rows.select("row", "id"), "row")
    names = with_ids.groupBy("component_id").agg(F.min("id").alias("least_id"))
    return with_ids.join(names, "component_id").select(
        F.col("id").alias(id_col), "n_shingles", F.col("least_id").alias("component_id"))


def first_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` without all but one row of each component of ``near_copies``.

    The row with the least id stays, nulls last; of equal ids the one with the least
    digest of its text, and of equal texts any one row. Other columns may have any
    names and come back as they are.
    """
    whole, own_ids = with_rows(docs, id_col)
    doc_id, text = F.col("doc").getField(id_col), F.col("doc").getField(text_col)
    found = row_groups(whole.select("row", text.alias("text")), words, percent)
    if own_ids:
        kept = found.filter(F.col("row") == F.col("component_id")).select("row")
    else:
        keys = whole.select("row", F.struct(
            doc_id.isNull().alias("no_id"), doc_id.alias("id"), F.sha2(text, 256).alias("digest"), "row").alias("key"))
        kept = found.join(keys, "row").groupBy("component_id").agg(F.min("key")["row"].alias("row")).select("row")
    return whole.join(kept, "row", "left_semi").select("doc.*")


def row_groups(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(row, n_shingles, component_id) of (row, text); ``component_id`` is the least row of the component."""
    all_sets = stored(measured(rows, words), "shingle-sets")
    groups = stored(
        all_sets.filter("n > 0").groupBy("s1", "s2").agg(F.min("row").alias("rep"), F.min("n").alias("n")),
        "shingle-groups")
    hits = shared_counts(rows, words, percent)
    likely = groups.join(hits, groups.s1 == hits.owner).filter(F.expr("hits >= greatest(1, n div 20)")).select("rep")
    # The list grows with the input: it is never broadcast, and the plan is the same at every size.
    chosen = rows.join(stored(likely, "shingle-likely").hint("merge"), F.col("row") == F.col("rep"))
    grams = stored(_grams(chosen, words), "shingle-grams")
    single = grams.select("row", F.explode("grams").alias("gram"))
    often = single.groupBy("gram").agg(F.count(F.lit(1)).cast("int").alias("df")).filter("df > 1")
    listed = single.join(often, "gram").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("grams"))
    sizes = grams.select("row", "n")
    least = F.expr(f"(n * {percent} + 99) div 100")
    sets = stored(listed.join(sizes, "row").filter(F.size("grams") >= least), "shingle-shared")
    early = F.col("n") - least + 1 - (F.col("n") - F.size("grams"))
    first = sets.select("row", F.explode(F.slice("grams", F.lit(1), early.cast("int"))).alias("g")).select("row", "g.gram")
    pivots = first.groupBy("gram").agg(F.min("row").alias("pivot"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    stars = stored(
        first.join(pivots, "gram").filter("row <> pivot").select("pivot", F.col("row").alias("node")).distinct(),
        "shingle-stars")
    links = stored(star_links(stars, sets, percent), "shingle-links")
    of_cluster = components(stars.select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    joined = components(links)
    clusters = of_cluster.withColumnRenamed("component", "cluster").join(joined, "node", "left").select(
        "node", "cluster", F.coalesce("component", "node").alias("component"))
    more = stored(rest_links(stored(clusters, "shingle-clusters"), sets, percent), "shingle-links")
    final = components(links.unionByName(more))
    reps = groups.select("s1", "s2", "rep").join(final, F.col("rep") == F.col("node"), "left").select(
        "s1", "s2", F.coalesce("component", "rep").alias("least"))
    return all_sets.join(reps, ["s1", "s2"], "left").select(
        "row", F.col("n").alias("n_shingles"), F.coalesce("least", "row").alias("component_id"))
