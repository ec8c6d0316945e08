import os
import random

import pytest

WORDS = "alpha beta gamma delta house river stone light cloud winter summer engine market letter number garden window silver copper forest".split()
COMMON = "the of and to in a is that it for".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(COMMON) if rng.random() < 0.35 else rng.choice(WORDS) + rng.choice(WORDS) + str(rng.randint(0, 9)) for _ in range(n)]
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="session")
def texts():
    """Texts of all awkward kinds: null, empty, blank, tiny, very long, repeated, periodic, odd characters, copies."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(80, 300)) for _ in range(30)]
    passage = prose(rng, 120)
    near = base[0].split()
    near[40], near[90] = "changed", "words"
    return [
        None, "", "  \n\t ", "x", "two words", "a b c", "word " * 3000, "abcabc" * 500, "é" * 450, "日本語 " * 200, "\x00\x01 odd <|endoftext|> text",
        prose(rng, 12_000), *base, base[0], base[0], " ".join(near), base[3], prose(rng, 60) + " " + passage, passage + " " + prose(rng, 60), "", None,
        "Ünïcödé " + base[5],
    ]


@pytest.fixture(scope="session")
def awkward(spark, texts):
    """Those texts with a null id, a repeated row and columns whose names clash with results."""
    rows = [(i if i != 3 else None, t, "en" if i % 2 else None, "src0", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[15])
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.selectExpr("*", "'z' as score", "1 as key", "2 as component_id", "3 as length", "'q' as TEXT", "4 as start", "true as held_out", "5 as range", "6 as row")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def real(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
