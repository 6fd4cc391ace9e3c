import random

import pytest

SYLLABLES = "ka lo mi ne tu ra si é ño wen".split()


@pytest.fixture(scope="session")
def prose():
    """Random text of n words."""

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def corpus(prose):
    """Texts with copies, near copies, shared passages, junk, nulls and odd ones; ids with gaps."""
    rng = random.Random(5)
    base = [prose(i, rng.randint(60, 200)) for i in range(12)]
    passage = prose(99, 70)
    texts = list(base) + [base[0]] * 4 + [base[1] + " more words"]
    for k in range(10):
        w = base[2].split()
        w[rng.randrange(len(w))] = f"x{k}"
        texts.append(" ".join(w))
    for k in range(6):
        texts.append(prose(200 + k, 40) + "\n" + passage + "\n" + prose(300 + k, 40))
    texts += [None, "", "   \n\t", "one", "one", "two words", "line\nline\nline\n" * 30, "# $ " * 60, "ab " * 500,
              "a" * 3000, "\x1c ok   x", prose(7, 4000), "<s>[INST] hi [/INST]</s>", "ééé " * 100]
    return [(3 * i + 1, t, "en", ("hot" if i % 3 else f"h{i % 5}") if i != 7 else None, len(t or "")) for i, t in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3, "doc_id").cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
