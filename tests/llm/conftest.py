import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "d string, t string, a string, w string, chunk string, score string, range string, _d string, _gone string")


def sentence(rng, n):
    names = "the of and river stone light under walking maybe seven quiet orchard copper".split()
    return " ".join(rng.choice(names) + str(rng.randrange(60)) for _ in range(n))


def texts():
    """Texts with copies, near copies, shared passages and lines, junk and odd characters."""
    rng = random.Random(5)
    shared = sentence(rng, 70)
    lines = "\n".join(sentence(rng, 9) for _ in range(12))
    base = sentence(rng, 300)
    near = base.split()
    near[150] = "changed"
    return [
        None, "", " ", "\n\n\n", "a", "Word", base, base, " ".join(near), base + " tail",
        sentence(rng, 40) + "\n" + shared + "\n" + sentence(rng, 15),
        sentence(rng, 25) + " " + shared + " " + sentence(rng, 60),
        shared, shared + " " + shared, lines, "intro line\n" + lines, lines + "\n\n" + lines,
        "ab " * 400, "x" * 3000, "no\u00a0break \u00e9t\u00e9 \u65e5\u672c\u8a9e \U0001f600 " * 60,
        "\u00e9t\u00e9 na\u00efve fa\u00e7ade " * 50, "12345 67890 !!! ???", "\t\ttabs\x0bvt\x0cff\r\n end",
        " ".join(sentence(rng, 50) for _ in range(120)), "<|endoftext|> don't we'll",
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, repeated rows and ids, ties, and other columns
    that are called like the operators' own."""
    rows = [(i, t, ["en", "de", "fr", None][i % 4], None if i % 3 else "s", i) for i, t in enumerate(texts())]
    rows += [rows[6], rows[6], (6, "the same id with another text " * 9, None, None, None),
             (None, rows[10][1], None, None, None), (None, None, None, None, None), (10_000, "last one", "en", "s", 8)]
    return spark.createDataFrame([r + tuple("abcdefghi") for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(odd_docs):
    """(d, t, text) of each row, as the operators see it, in their order."""
    from attestor.llm.common import keyed

    return sorted((r.d, r.t, r.text) for r in keyed(odd_docs).collect())
