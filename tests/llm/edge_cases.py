import pytest

from corridor_metrics.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


# NULLs, empty and one-word texts, ties, repeated rows, unusual characters, and one very long text
PASSAGE = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix amber potions near the old stone bridge at dawn. "
EDGE_ROWS = [
    (1, "Hello World", "en"),
    (2, "hello world", "en"),
    (2, "hello world", "en"),
    (3, None, None),
    (4, "", "de"),
    (5, "x", "fr"),
    (6, "x" * 400, "en"),
    (7, "he " * 300, "en"),
    (8, PASSAGE * 3, "en"),
    (9, "intro words " + PASSAGE + " outro", None),
    (10, "\n\t  \x1c 　 é ÉCOLE ΑΣ \U0001f600 <|endoftext|>\x00", "el"),
    (11, ("lorem ipsum dolor sit amet " * 40 + PASSAGE) * 700, "la"),
    (12, PASSAGE * 3, "en"),
    (None, "no id at all", "en"),
    (None, None, None),
    (8, "same id, other text " + PASSAGE, "en"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Rows with awkward values, extra columns whose names operators use themselves."""
    rows = [(i, t, lang, "clash", 7, b"z", 1.5, [1]) for i, t, lang in EDGE_ROWS]
    schema = "doc_id long, text string, lang string, doc string, crc int, key binary, score double, hits array<int>"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")
