import random

import pytest

WORDS = [a + b for a in "ba de fi gu ko la me no pu ri".split() for b in "n r s t lo mi".split()]


@pytest.fixture(scope="module")
def texts():
    """Small corpus: copies, near copies, a common passage, ties, very short and rather long texts, NULL and empty ones."""
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(WORDS) + (rng.choice(".,!") if rng.random() < 0.1 else "") for _ in range(n))
    passage = say(60)
    out = [None, "", "   \n\t ", "One", "one", "Two words", "two WORDS", "two words again", "É accents ñ 😀 here", say(3000)]
    for _ in range(12):
        base = say(rng.randint(30, 120)).split()
        out.append(" ".join(base))
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            out.append(" ".join(copy))
    out += [say(8) + " " + passage + "\n" + say(rng.randint(3, 80)) for _ in range(30)]
    out += [say(40)] * 9
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    """The corpus with a repeated row, a row without id, NULLs in other columns, and columns whose names operators use inside."""
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 4}" if i % 7 else None, None if i % 5 == 0 else i, i, "x") for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, "a row without id", None, "src1", None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rep long, _tokens string").withColumnRenamed("n_chars", "shard").repartition(5)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("1 = 0")
