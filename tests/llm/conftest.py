import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents: NULLs, empty and repeated texts, ties, a long text,
    and columns whose names clash with those the operators use."""
    base = " ".join(f"word{i % 97} other{i % 31}" for i in range(400))
    rows = [(1, base), (2, base), (3, base + " tail"), (4, None), (5, ""), (6, "  \n \t"), (7, "Short."),
            (8, "line one here\nline two there\nLINE  one here"), (9, "Émile était là. ▁ marks  and   runs <|endoftext|> <0x0A>\x00\x1f"),
            (10, "x" * 70_000), (11, " ".join(f"long{i}" for i in range(30_000))), (12, "MIT license and the Apache  License."),
            (12, "MIT license and the Apache  License."), (None, "no id at all but words"), (14, "日本語 テキスト ß Σας")]
    wide = [(i, t, "id-clash", 7, "t", 0.5) for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, id string, row int, ids_crc32 string, score double")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    return SF
