import pytest

from tether.llm.queries import prepared

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta omega sigma theta kappa lambda zeta river stone cloud forest window garden letter winter summer".split()


@pytest.fixture(autouse=True, scope="session")
def _prepared(spark):
    prepared(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_texts():
    """Empty, blank, long, mixed in script, with special strings and with unusual white space."""
    return [
        None, "", " ", "\n\n", "  a  b", "a\n \nb  \n", "x\x1cy \x1f z\x85 q᠎b​c  d　e", "it's 'll we're'RE' 'r", "tail ",
        "<|endoftext|> a <|endoftext|>b<|endoftext", "a \n\n  <|endoftext|>\n b", "ab" * 3000, " " * 300 + "x", "\U0001f600½²٣ 中文字 naïve\t\tx", "\r\n\r\n x \r\n",
        "zero\x00byte", "word " * 20000,
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_texts):
    """The odd texts with repeated and null ids, and columns whose names operators might use themselves."""
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(odd_texts)] + [(0, None, "x", 1, 2), (None, "a null id", None, 1, 2), (None, "a null id", None, 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, found int, n int")


def rows_of(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def components_of(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
