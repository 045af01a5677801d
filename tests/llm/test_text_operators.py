"""Operators on single texts, lines, addresses and sources."""

import hashlib
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestrata.llm import license_scan, line_dedup, mixing, ngram_join, quality, sentencepiece_codec as codec, url_filter
from lodestrata.llm.license_texts import KNOWN_LICENSES
from lodestrata.llm.queries import ORACLE, QUERIES
from tools.compare import canonical

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, SF_DIR)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, result.fetchall())


def test_licenses(spark, docs, empty):
    mit, other = KNOWN_LICENSES["MIT"], KNOWN_LICENSES["ISC"]
    rows = [
        (1, "Copyright (c) 2020 Someone\n" + mit), (2, mit.upper().replace("LICENSE", "LICENCE")),
        (3, re.sub(r"[,.]", " ; ", mit) + "\n© 1999 X\nAll rights reserved."), (4, mit + " extra"), (5, other),
        (6, None), (7, ""), (8, "Copyright 2001 Y"), (None, mit),
    ]
    found = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"))
    names = {r.doc_id: (r.license_id, r.n_words) for r in found.collect()}
    assert [names[k][0] for k in range(1, 9)] == ["MIT", "MIT", "MIT", None, "ISC", None, None, None]
    assert names[None][0] == "MIT" and [names[k][1] for k in (6, 7, 8)] == [0, 0, 0]
    # Titles may be there or not, and copyright lines need no sign and no year.
    bare, bsd = license_scan.KNOWN_LICENSES["MIT"], license_scan.KNOWN_LICENSES["BSD-3-Clause"]
    rows = [(1, bare), (2, f"The MIT License (MIT)\n\nCopyright Jane Doe\n\n{bare}"),
            (3, f"MIT License\nPortions Copyright: 2020 X\nCopyright\n{bare}"), (4, f"My License\n{bare}"),
            (5, f"BSD 3-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n{bsd}"),
            (6, bsd.replace("the above copyright notice", "the above\n  copyright notice")),
            (7, bsd.replace("copyright notice", "notice"))]
    found = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r.license_id for r in found.orderBy("doc_id").collect()] == [
        "MIT", "MIT", "MIT", None, "BSD-3-Clause", "BSD-3-Clause", None]
    assert license_scan.license_scan(docs).count() == docs.count()
    assert license_scan.license_scan(empty).count() == 0


def test_line_dedup(spark, docs, empty):
    rows = [(k, f"menu\nown {k}\n\n menu \r", "a") for k in range(19)] + [(19, "menu\nmenu", "a"), (20, None, "a")]
    rows += [(30 + k, f"menu\nline {k}", "small") for k in range(3)] + [(40 + k, f"menu\nx {k}", None) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_lines", F.lit("old"))
    found = {r.doc_id: r for r in line_dedup.drop_boilerplate(df).collect()}
    assert found[0].text == "own 0\n" and (found[0].n_lines, found[0].n_dropped) == (4, 2)
    # A page of boilerplate only loses all its lines.
    assert found[19].text == "" and (found[19].n_lines, found[19].n_dropped) == (2, 2)
    assert found[20].text is None and found[20].n_lines == 0
    assert found[31].text == "menu\nline 1" and found[41].text == "x 1"
    # Copies of a page are one page of their host: their lines are no boilerplate, the menu on them is.
    rows = [(k, f"menu\nnews of {k}", "a") for k in range(12)] + [(100 + k, "menu\ncopied\ntext", "a") for k in range(40)]
    names = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"__host": F.lit(1), "__site_lines": F.lit(2), "kept": F.lit(3), "doc": F.lit(4), "n_dropped": F.lit("x")})
    found = line_dedup.drop_boilerplate(names).collect()
    assert {r.text for r in found if r.doc_id >= 100} == {"copied\ntext"} and len(found) == 52
    assert {r.n_dropped for r in found} == {1} and {(r["__host"], r.kept, r.doc) for r in found} == {(1, 3, 4)}
    cleaned = line_dedup.drop_boilerplate(docs)
    assert cleaned.columns == [*docs.columns, "n_lines", "n_dropped"] and cleaned.count() == docs.count()
    assert line_dedup.drop_boilerplate(empty).count() == 0


def test_mix_shares_words_by_target(spark, docs, empty):
    rng = random.Random(1)
    rows = [(k, " ".join(["w"] * rng.randrange(1, 60)), s) for k, s in enumerate(rng.choices("abcde", [60, 20, 12, 6, 2], k=900))]
    rows += [(9000, None, "a"), (9001, "", None), (9002, "x y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(df).withColumnRenamed("doc_id", "i").collect()
    source = {i: s for i, _, s in rows}
    target, taken, sizes = {}, Counter(), Counter()
    for r in found:
        target[source[r.i]] = r.target
        taken[source[r.i]] += r.taken
        sizes[source[r.i]] += r.size
        assert r.taken <= 2 * r.size and r.source_size >= r.size
    assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1e-6
    assert all(t <= 2 * sizes[s] + 1e-9 for s, t in target.items())
    assert all(abs(taken[s] - t) <= 120 for s, t in target.items())
    copies = Counter(r.doc_id for r in mixing.mixed(df).collect())
    assert all(copies[r.i] * r.size == r.taken for r in found)
    assert mixing.mix(docs).count() == docs.count() and mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_mix_is_the_same_in_slices(spark, monkeypatch):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = sorted(map(tuple, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "SLICE_ROWS", 9)
    assert sorted(map(tuple, mixing.mix(df).collect())) == before


@pytest.mark.parametrize("repeated", [False, True])
def test_mix_holds_when_files_are_split_otherwise(spark, monkeypatch, tmp_path, repeated):
    """Cores come or go between the reads: the same rows are taken."""
    rows = [(k // (1 + repeated), " ".join([f"w{k}"] * (k % 7 + 1)), "ab"[k % 3 == 0]) for k in range(240)]
    path, cores = str(tmp_path / "docs"), "spark.sql.leafNodeDefaultParallelism"
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6).write.parquet(path)
    plain = mixing.fair_queue

    def queue_then_more_cores(*args, **options):
        out = plain(*args, **options)
        spark.conf.set(cores, "8")
        return out

    monkeypatch.setattr(mixing, "fair_queue", queue_then_more_cores)
    spark.conf.set(cores, "1")
    try:
        found = Counter(r.text for r in mixing.mixed(spark.read.parquet(path)).collect())
    finally:
        spark.conf.unset(cores)
    monkeypatch.undo()
    taken = {(r.doc_id, r.size): r.taken // r.size for r in mixing.mix(spark.read.parquet(path)).collect()}
    assert found == Counter({t: taken[i, len(t.split())] for i, t, _ in rows if taken[i, len(t.split())]})


@pytest.mark.parametrize("url, wanted", [
    (None, ("", "", None, "allow")), ("no scheme casino", ("", "", None, "block")),
    ("http://X.Example.ORG/es/a?b", ("x.example.org", "/es/a", "example.org/es/", "block")),
    ("http://example.org/en/12", ("example.org", "/en/12", "example.org/en/1", "block")),
    ("http://example.org", ("example.org", "", None, "allow")),
    ("https://badexample.org/es/", ("badexample.org", "/es/", "org/", "allow")),
    ("http://a.com/fr/casino", ("a.com", "/fr/casino", "com/fr/", "allow")),
    ("http://a.com/de/x", ("a.com", "/de/x", "com/de/", "block")),
    ("http://casinos.net/", ("casinos.net", "/", None, "allow")), ("http://b.net/CASINO#x", ("b.net", "/CASINO", None, "block")),
    ("http://free-bet.net/", ("free-bet.net", "/", None, "block")), ("http://free.net/free", ("free.net", "/free", None, "allow")),
    ("http://é.net/éfree/bet", ("é.net", "/éfree/bet", None, "allow")),
])
def test_urls(spark, url, wanted):
    df = spark.createDataFrame([(1, url, "host")], "page_id long, url string, host string")
    row = url_filter.judge_urls(df).first()
    assert (row.host, row.path, row.rule, row.verdict) == wanted


UNWANTED = {
    "adult": ("adult-x.net", "m.adult-films.net", "nsfw.a.net", "free-sex-cams.net", "escorts.b.net/city", "sexcam.net"),
    "gambling": ("casino-win.net", "free-bets.net", "sportsbook.a.net", "b.net/betting/today", "poker-bonus.net", "slot-machine.net"),
    "pharmacy": ("cheap-pills.net", "cialis.a.net", "online-pharmacy.net", "b.net/tramadol-no-prescription", "rx-meds.net"),
    "spam and link farms": ("spam-farm.net", "link-farm.a.net", "linkfarm.net", "b.net/buy-backlinks", "seo-backlinks.net"),
    "ads and tracking": ("ads-track.net", "ads.a.net/1", "adserver.net", "b.net/click-tracker", "sponsored-banners.net"),
    "fraud and stolen goods": ("warez.net", "keygen.a.net", "payday-loans.net", "torrents-cracked.net", "b.net/phishing"),
}
CLEAN = (
    "www.library.net/loans", "free-software.net/download", "a.net/package/tracking", "issues.net/tracker/12", "pharmacy.a.net",
    "organic-farm.net/links", "sussex.net/adulthood", "a.net/win/rates", "news.net/lottery", "essex.net/bettina", "a.net/seo",
    "downloads.net/roads/leads", "camera.net", "spamalot.net", "scunthorpe.net", "a.net/en/12?page=2&ref=x", "feeds.net?utm_source=feed",
)


def test_urls_by_category(spark):
    urls = [(c, f"https://{u}") for c, all_of in {**UNWANTED, "clean": CLEAN}.items() for u in all_of]
    judged = url_filter.judge_urls(spark.createDataFrame(urls, "page_id string, url string"))
    blocked = Counter(r.page_id for r in judged.collect() if r.verdict == "block")
    assert blocked == {c: len(all_of) for c, all_of in UNWANTED.items()}


def test_urls_of_the_table(spark):
    """Of pages that no rule decides, all of the unwanted hosts and no other are blocked."""
    judged = url_filter.judge_urls(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).filter("rule IS NULL")
    unwanted = F.col("host").rlike("ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm")
    assert judged.filter((F.col("verdict") == "block") != unwanted).count() == 0


def test_urls_of_nothing(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(df).count() == 0


def merged_by_hand(coder, text):
    """Plain byte-pair merges over a whole text, best score first, then leftmost."""
    v = coder.v
    parts = list("▁" + text.replace(" ", "▁")) if text else []
    while True:
        pairs = [(-v.scores[v.ids[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in v.ids]
        if not pairs:
            break
        _, k = min(pairs)
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    out = []
    for p in parts:
        out += [v.ids[p]] if p in v.ids else np.frombuffer(v.fallback(p), np.int32).tolist()
    return out


ALPHABET = "abtheinor AB.,\n\t  é漢▁😀<0>s\x00"


def test_codec_equals_library_and_merges(texts):
    import sentencepiece

    model = codec.read_model()
    library, coder = sentencepiece.SentencePieceProcessor(model_proto=model), codec.Codec(model)
    rng = random.Random(6)
    some = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(1500)]
    some += [t for _, t, *_ in texts if t]
    found = [np.frombuffer(x, np.int32).tolist() for x in coder.encode(some)]
    assert found == [library.encode(t) for t in some]
    assert found[:200] == [merged_by_hand(coder, t) for t in some[:200]]
    for t, ids in zip(some, found):
        assert coder.decode(np.array(ids, np.int64), np.array([0, len(ids)])) == [t.replace("▁", " ")]


def test_unigram_walk_equals_plain_viterbi():
    coder = codec.Codec(codec.read_model(), "unigram")
    v, walk = coder.v, coder.forward
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("theinor▁é漢") for _ in range(rng.randrange(1, 9))) for _ in range(200)})
    for word, ids in zip(words, walk.walk(words)):
        best = [0.0] + [-np.inf] * len(word)
        for end in range(1, len(word) + 1):
            for begin in range(end):
                if word[begin:end] in v.ids:
                    best[end] = max(best[end], best[begin] + v.scores[v.ids[word[begin:end]]])
            if word[end - 1] not in v.ids:
                best[end] = max(best[end], best[end - 1] + walk.penalty)
        pieces = np.frombuffer(ids, np.int32).tolist()
        assert b"".join(v.surface[i] for i in pieces).decode() == word.replace("▁", " ")
        if all(c in v.ids for c in word):
            assert sum(v.scores[i] for i in pieces) == best[-1]


def test_codec_table(docs, texts, empty):
    encoded = codec.encode(docs, keep=("doc_id", "text", "size"))
    rows = codec.decode(encoded, keep=("doc_id", "text", "ids", "n_tokens")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.decoded == (None if r.text is None else r.text.replace("▁", " "))
        assert (r.ids is None) == (r.text is None) and r.n_tokens == len(r.ids or [])
    assert codec.encode(empty).count() == 0 and codec.decode(codec.encode(empty)).count() == 0


def test_long_texts_are_cut_where_nothing_crosses(monkeypatch):
    coder = codec.Codec(codec.read_model())
    text = "the  quick\nbrown   fox " * 200
    whole = coder.encode([text])[0]
    monkeypatch.setattr(codec, "SLICE_CHARS", 50)
    assert codec.Codec(codec.read_model()).encode([text])[0] == whole


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    fitted, held = labels.filter("doc_id % 2 = 0"), {r.doc_id: r.quality for r in labels.filter("doc_id % 2 = 1").collect()}
    found = {r.doc_id: r for r in quality.judge(documents, fitted).collect()}
    good = [found[i].kept for i, q in held.items() if q == 1]
    bad = [found[i].kept for i, q in held.items() if q == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.25
    kept = quality.accepted(documents, fitted)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in found.items() if r.kept}


def test_sites_are_shrunk(spark):
    """A sparse path follows its host, a large one itself."""
    rows = [("good", "a", 0.9)] * 400 + [("good", "b", 0.5)] + [("bad", "a", 0.1)] * 400 + [("bad", "b", 0.5)]
    rows += [("mid", "x", 0.9)] * 200 + [("mid", "y", 0.1)] * 200 + [("one", "z", 0.5), (None, None, 0.5)]
    evidence = spark.createDataFrame(rows, "host string, path string, evidence double")
    sites, shrink = quality.site_sums(evidence)
    scored = quality.with_posteriors(evidence, sites, shrink, 0.5, 0.5)
    score = {(r.host, r.path): r.score for r in scored.collect()}
    assert len(score) == 8 and scored.count() == len(rows)
    assert score["good", "b"] > 0.6 > 0.4 > score["bad", "b"]
    assert score["mid", "x"] > 0.9 and score["mid", "y"] < 0.1
    assert abs(score["one", "z"] - shrink["share"]) < 0.1


def test_quality_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (5, 1, 0), (None, 1, 0), (9, None, 0)],
                                   "doc_id long, quality int, toxic int")
    assert quality.judge(docs, labels).count() == docs.count()
    assert quality.judge(docs, labels.limit(0)).filter("abs(evidence - 0.5) > 1e-9").count() == 0
    assert quality.judge(empty, labels).count() == 0
    assert quality.accepted(docs, labels).columns == docs.columns


def test_features_are_those_of_each_text_alone():
    texts = ["A b, c!", None, "", "xx " * 700, "% % $"]
    together = quality.features(pa.array(texts))
    assert np.array_equal(together, np.vstack([quality.features(pa.array([t], pa.string())) for t in texts]))


def test_pipeline_equals_its_parts(spark):
    """Each stage against a plain version of its rule on what the stage before left."""
    from tests.llm.test_dedup import near_by_hand

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = {r.doc_id for r in quality.judge(docs, labels).filter("kept").collect()}
    rows = [r for r in docs.collect() if r.doc_id in kept]
    pages, lines = Counter(r.source for r in rows), Counter()
    for r in rows:
        lines.update({(r.source, x.strip(" \t\r")) for x in r.text.split("\n")})

    def cleaned(r):
        common = [lines[r.source, x.strip(" \t\r")] > 0.1 * pages[r.source] and pages[r.source] >= 10 and x.strip(" \t\r") != ""
                  for x in r.text.split("\n")]
        left = [x for x, c in zip(r.text.split("\n"), common) if not c]
        return "\n".join(left) if any(x.strip(" \t\r") for x in left) else r.text

    texts = {r.doc_id: (cleaned(r), r.source) for r in sorted(rows)}
    groups = near_by_hand([t for t, _ in texts.values()])
    firsts = {c: i for i, (_, c) in reversed(list(zip(texts, groups)))}
    left = {i: texts[i] for i in firsts.values()}
    mixed = mixing.mix(spark.createDataFrame([(i, *x) for i, x in left.items()], "doc_id long, text string, source string"))
    copies = {r.doc_id: r.taken // max(1, r.size) for r in mixed.collect()}
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(r.doc_id for r in found) == Counter({i: n for i, n in copies.items() if n})
    coder = codec.Codec(codec.read_model())
    encoded = {i: np.frombuffer(x, np.int32).tolist() for i, x in zip(left, coder.encode([t for t, _ in left.values()]))}
    assert all(r.ids == encoded[r.doc_id] for r in found)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF_DIR).columns == docs.columns


def test_pipeline_keeps_one_row_of_each_group(spark):
    """Repeated rows, ids with several texts and null ids."""
    text = {k: " ".join(f"{k}{n}" for n in range(40)) for k in "tuvw"}
    near = text["w"].replace("w39", "other")
    rows = [
        (7, text["t"]), (7, text["t"]), (3, text["t"]), (7, text["u"]), (None, text["t"]), (None, text["v"]), (None, text["v"]),
        (None, near), (9, text["w"]), (9, near), (None, None), (None, ""), (5, None), (5, None), (None, "alone"),
    ]
    wanted = [(3, text["t"]), (7, text["u"]), (None, text["v"]), (None, None), (None, ""), (5, None), (5, None), (None, "alone")]
    first = min((text["w"], near), key=lambda x: hashlib.sha256(x.encode()).hexdigest())
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = corpus_pipeline.ngram_jaccard_join(spark, df, SF_DIR)
    assert found.columns == df.columns
    assert Counter(map(tuple, found.collect())) == Counter([*wanted, (9, first)])
    ids = spark.createDataFrame([("b", text["t"]), ("a", text["t"])], "doc_id string, text string")
    assert [r.doc_id for r in corpus_pipeline.ngram_jaccard_join(spark, ids, SF_DIR).collect()] == ["a"]


def test_stages_leave_columns_of_any_name(spark):
    """Names that the stages use themselves, and null and repeated ids."""
    names = ("row", "copy", "finish", "doc", "id", "key", "size", "target", "__row", "__kept", "component_id", "place")
    rows = [(None if k % 5 == 0 else k // 2, " ".join(f"w{k}x{j}" for j in range(9)), "ab"[k % 2], *[k] * len(names))
            for k in range(40)]
    rows += [rows[3]] * 2
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{n}` int" for n in names)
    df = spark.createDataFrame(rows, schema)
    kept = ngram_join.first_copies(df)
    assert kept.columns == df.columns and sorted(map(str, kept.collect())) == sorted({str(r) for r in df.collect()})
    mix = mixing.mixed(df)
    assert mix.columns == df.columns and {str(r) for r in mix.collect()} <= {str(r) for r in df.collect()}
    whole = df.filter("doc_id > 1").dropDuplicates(["doc_id"])
    assert {str(r) for r in mixing.mixed(whole).collect()} <= {str(r) for r in whole.collect()}
    assert sorted(map(str, ngram_join.first_copies(whole).collect())) == sorted(map(str, whole.collect()))


def test_rows_without_ids_spread_over_the_order(spark):
    df = spark.range(300).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    assert df.select(mixing.place(F.col("doc_id"), F.col("text"))).distinct().count() == 300
