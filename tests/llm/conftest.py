import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, n_words long, component_id string, score string, text2 array<int>"


def odd_texts():
    """Texts that are easy to get wrong."""
    r = random.Random(5)
    plain = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "of", "the", "And", "école", "über"]) + r.choice(["", "", ",", "."]) for _ in range(n)) for n in (3, 4, 5, 6, 60, 300)]
    near = plain[-1].split(" ")
    near[150] = "changed"
    return [None, "", " \n\t ", "one", *plain, plain[-1], plain[-1].upper(), " ".join(near), " ".join(near[:-40]), "\n".join(["same line again"] * 40), "word " * 5000,
            "x" * 30000, "é" * 50 + " \x0b a\x0cb\r\n c", "token = 'abcdefgh12345678' AKIAABCDEFGHIJKL12 " + "0123456789abcdef" * 3, "secret:short password = token=Zx9+/kQ81mLpR2vT",
            "<|endoftext|> <|startoftext|>a<|endoftext|>. <|ENDOFTEXT|>", "é J̌  x İ ▁ a▁b  two   three ", " lead", "trail ", "日本語 text 🎉!!"]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts under ids with repeats and a null, beside columns whose names the operators use themselves."""
    texts = odd_texts()
    rows = [(None if i == 5 else 7 if i in (8, 9) else 3 * i, t, [None, "en", "de"][i % 3], i, "c", "s", [i]) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], rows[0]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
