import random

import pytest

SYLLABLES = ["an", "the", "er", "on", "re", "ti", "ou", "st", "ha", "ing", "é", "ß", "ño"]


def sentence(rnd, n):
    return " ".join("".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_texts():
    """Texts with nulls, empties, white space only, very long ones, ties, repeats, near copies and odd characters."""
    rnd = random.Random(5)
    base = [sentence(rnd, rnd.randint(1, 120)) for _ in range(40)]
    long = sentence(rnd, 6000)
    near = [" ".join([*b.split()[: len(b.split()) // 2], "changed", *b.split()[len(b.split()) // 2 :]]) for b in base[:12]]
    odd = ["", "   \n\t ", None, "one", "two words", "A B c", "a b C", "x y   z", "tab\tand\nline\r\nends  ", "\x00\x01 nul", "<|endoftext|> in <|im_end|> text", "😀 " * 30, "'s 't don't I'LL"]
    return [*base, *near, *base[:5], long, long + " tail", *odd]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_texts):
    """documents with clashing extra columns, a null id, and a row that repeats another."""
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}", None if t is None else len(t), 7, "x") for i, t in enumerate(edge_texts)]
    rows += [(None, "no id here at all", "fr", None, None, 7, "x"), rows[3]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_shingles int, score string")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
