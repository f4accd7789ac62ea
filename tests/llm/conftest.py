import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))



@pytest.fixture(scope="session")
def tricky(spark):
    """Documents with nulls, empty and long texts, ties, repeats, and clashing columns."""
    long = " ".join(f"w{i}" for i in range(3000))
    line = "A line of more than forty characters, all told here."
    rows = [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, "   \n\t ", "en", "a"),
        (4, long, "en", "b"),
        (5, long + " more words", "en", "b"),
        (6, long, "en", "b"),
        (6, long, "en", "b"),
        (7, "one two three", "de", "c"),
        (8, "one two three", "de", None),
        (None, "one two three", "de", "c"),
        (None, "nobody knows this text", None, "c"),
        (9, "é 日本 🎉 <|im_end|> \x00", "fr", "c"),
        *((10 + i, f"{line}\n{i}\n  {line.upper()}  ", "en", "a") for i in range(6)),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = "key keep_id kept group block rep node component low high n_words score line u v place".split()
    for name in clash:
        frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame


@pytest.fixture(scope="session")
def nothing(tricky):
    return tricky.limit(0)
