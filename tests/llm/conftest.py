import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep long, comp string"


@pytest.fixture(scope="session")
def rows():
    """Null, empty, blank, one-word and very long texts, copies, near copies, shared passages and a null id."""
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    words = lambda n: " ".join(rng.choices(vocab, k=n))
    base, passage = words(120), words(40)
    texts = [None, "", "   \n\t ", "word", "One Two", "zwölf Größe! 'll don't  \n\n x", base, base, base.upper(), base + " tail", words(5000), "a" * 3000, "\n".join(["same line here"] * 30)]
    for i in range(12):
        near = base.split(" ")
        near[i * 7] = f"edit{i}"
        texts.append(" ".join(near))
    texts += [words(60) + "\n" + passage + "\nsecond line " + vocab[3] + "\n" + words(30) for _ in range(15)]
    texts += [words(80) for _ in range(20)]
    out = [(i * 3, t, ("en", "de")[i % 2] if i % 5 else None, "s", len(t) if t is not None else None, i, "x") for i, t in enumerate(texts)]
    out.append((None, words(20), None, None, None, None, None))
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
