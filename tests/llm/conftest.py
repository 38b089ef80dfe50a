import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, label int, part string, word string"


def invented(n_words: int, seed: int, syllables: str = "an er in on re ti al ra mi ko sa lu be do fa ne") -> str:
    r = random.Random(seed)
    words = ["".join(r.choice(syllables.split()) for _ in range(r.randint(1, 4))) for _ in range(n_words)]
    for k in range(0, n_words, 11):
        words[k] = words[k].capitalize()
    for k in range(10, n_words, 11):
        words[k] += "." if r.random() < 0.8 else ".\n"
    return " ".join(words)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) pairs or whole dicts, with extra columns of clashing names."""

    def make(rows):
        full = []
        for r in rows:
            r = r if isinstance(r, dict) else {"doc_id": r[0], "text": r[1]}
            text = r["text"]
            full.append(
                (r["doc_id"], text, r.get("lang"), r.get("source", "src0"), None if text is None else len(text), "x", 1, "y", None)
            )
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null and empty texts, no id, repeated rows and ids, odd white space, a very long text."""
    base = invented(60, 1)
    return [
        (1, base), (2, None), (3, ""), (4, " \n\t "), (None, base + " extra"), (5, base), (5, base), (6, "a"),
        (7, "été x y   z\x1c !\x85"), (8, invented(30_000, 2)), (9, "漢字 <|endoftext|> 🙂" * 3), (10, "x" * 6000),
    ]
