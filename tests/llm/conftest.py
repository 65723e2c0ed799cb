import pytest

LONG = "lorem ipsum dolor " * 20_000
ROWS = [
    (1, "", "en", "a"), (2, None, None, None), (3, None, "en", "a"), (None, "hello wide world", "en", "b"),
    (4, "the same text stands here now", "en", "b"), (5, "the same text stands here now", "de", "a"), (5, "the same text stands here now", "de", "a"),
    (6, LONG, "en", "c"), (7, "ÉCOLE été Straße ñandú 日本語 🙂", "fr", None), (8, "  \n\t ", "en", "c"), (9, "4711 // 0815 !!!", "de", "c"),
    (10, "write to x.y@mail.example.com or 10.0.0.255 card 4111 1111 1111 1111 call +1 (375) 555-4393", "en", "b"),
]
#: Extra columns with names that operators use themselves.
CLASH = "part int, pos long, gid long, row string, fp string, size long, taken long, score double, keep_id long, kept boolean, content string, id string, name string, use int, order_ long, target string"


@pytest.fixture(scope="session")
def edge(spark):
    """Null, empty, blank, very long, repeated and tied rows, and clashing extra columns."""
    extra = ", ".join(f"cast(null as {x.split()[1]}) as {x.split()[0]}" for x in CLASH.split(", "))
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return docs.selectExpr("*", "length(text) as n_chars", extra.split(", ")[0], *extra.split(", ")[1:]).repartition(3, "doc_id").cache()


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))
