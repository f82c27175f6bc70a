import random

import pytest

WORDS = ["".join(random.Random(i).choices("abcdefghij", k=3 + i % 5)) for i in range(600)]


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Texts of all kinds: null, empty, white space, one word, very long, copies and near copies, repeated rows."""
    texts = [None, "", "  \n\t", "word", prose(1), prose(1), prose(2, 20_000), "ÉTÉ <|endoftext|> naïve 漢字 " + prose(3), "!!! 123 ...", prose(4, 9), prose(4, 9) + " x"]
    rows = list(enumerate(texts)) + [(4, texts[4])]
    for i in range(20):
        base = prose(100 + i % 4, 80).split()
        base[i] = "edit"
        rows.append((100 + i, " ".join(base)))
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, score string, lang_pred string")
