import pytest

from orderloom.llm.common import corpus_session

LONG = " ".join(f"word{i % 997}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60)) + "."
PROSE = [" ".join(f"w{d}x{i} of the" for i in range(40)) for d in range(6)]

# Columns whose names the operators use themselves.
DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, quality string, lines string, "
    "repeats string, key string, label long, digest string, bytes long, shard long, uid long, id string, rank long"
)


@pytest.fixture(scope="session")
def corpus(spark):
    return corpus_session(spark)


@pytest.fixture(scope="session")
def edge_rows():
    """(id, text): nulls, empty, blank and very long texts, copies, repeated rows and a null id twice."""
    return [
        (1, PROSE[0] + "\n" + PASSAGE), (2, PROSE[1] + "\n\n" + PASSAGE + "\n" + PROSE[1]), (3, PROSE[0] + "\n" + PASSAGE),
        (3, PROSE[0] + "\n" + PASSAGE), (4, None), (5, ""), (6, " \t\n "), (7, LONG), (8, "x" * 5000),
        (9, PROSE[2] + "\n" + PROSE[2]), (10, "<|endoftext|> it's 5  o'clock 　\U0001f642"), (None, PROSE[3]),
        (None, PROSE[4]), (11, PROSE[2].replace("w2x5 ", "w2y5 ")), (12, "THE END!! " * 30), (12, PROSE[5]),
    ]


@pytest.fixture(scope="session")
def make_documents(corpus):
    def build(rows):
        full = [(i, t, None, "src0", None, "q", None, "r", "k", 1, "d", 0, 0, 0, "i", 9) for i, t in rows]
        return corpus.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def edge(make_documents, edge_rows):
    return make_documents(edge_rows)


@pytest.fixture(scope="session")
def nothing(make_documents):
    return make_documents([])
