import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Null, empty, blank, tied, repeated and very long texts, marks of several scripts and a special token's string.
ODD_TEXTS = [None, "", " ", "\n\n", "a", "A", "Word, word. word", "it's ALL'S well...", "naïve café ÀÉÎ éa", "<|endoftext|> <|ENDOFTEXT|>x", "​ x\ty\x1cz", "日本語 текст 12345 ½", "same text here", "same text here", "(a), b.\nc,", "long words " * 3000]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [(99, None, None, None, None), (100, "nothing known of this", None, None, None)]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same with columns that an operator might be using itself."""
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit("x") for c in ("leaf", "bin", "start", "n_tokens", "base", "shard", "key", "fingerprint", "component_id", "label", "score", "node", "words", "weight", "epoch")})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
