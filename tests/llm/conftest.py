import pytest

WORDS = "red blue green gold grey pink teal navy plum rust sand jade".split()


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text, lang, source, n_chars, size) with edges: null, empty, blank, long, equal, repeated rows."""
    import random

    rng = random.Random(3)

    def prose(n):
        return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))

    base, passage, long_text = prose(60), prose(90), prose(9000)
    near = base.split()
    near[30] = "other"
    rows = [
        (1, base), (2, base + "\n"), (3, " ".join(near)), (4, base.upper()), (5, prose(40)), (6, None), (7, ""),
        (8, " \t\n "), (9, "one two"), (10, "ONE two"), (11, passage + "\n" + prose(50)),
        (12, prose(50) + "\n" + passage), (13, long_text), (14, long_text + " tail"), (15, "é漢 😀 ▁x\x00"),
        (16, "aaaa" * 300), (17, prose(5)), (17, prose(5)), (None, prose(30)), (None, None), (5, prose(40)),
    ]
    return [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", 7, "clash") for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long, size string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
