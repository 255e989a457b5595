import random

import pyarrow.parquet as pq
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts():
    """Whole texts of the small table, and odd ones."""
    return pq.read_table(f"{SMALL}/documents.parquet")["text"].to_pylist()


ODD = [
    None, "", " ", "\n\n", "one", "Two words", "x" * 70_000, "a b " * 30_000, "Ünï cödé   wide　space",
    "same text here again and again", "same text here again and again", "tab\tand\x0bvertical \x1c odd", "日本語 🙂 don't IT'S 12½ ÀÉÎ",
    "á é ́x ΑΣ Σ", "<|endoftext|> end <|startoftext|>x",
]


def frame(spark, texts, **extra):
    """Documents with clashing extra columns and unordered partitions."""
    rows = [(i, t, "key", "fp", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, fp string, n long").repartition(3)


def fuzz(n, alphabet, size, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, size))) for _ in range(n)]
