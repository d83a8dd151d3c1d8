import pytest

LONG = "word " * 3000 + "unbrokenrun" * 4000


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every case the operators promise a result for; extra columns clash with theirs."""
    texts = [
        (1, "The quick brown fox jumps over the lazy dog and runs far away from here today."),
        (2, "The quick brown fox jumps over the lazy dog and runs far away from here today."),
        (3, "The quick  brown fox\njumps over the lazy dog and runs far away from here today. "),
        (4, None), (5, ""), (6, " \t\n\x0b\x0c\r "), (7, LONG), (8, "one"), (9, "two words"),
        (10, "Ünïcödé 𝒳 ▁   漢字 <|endoftext|> </s>[INST] ok [/INST]"), (10, "another text of the same id"),
        (11, "repeated row"), (11, "repeated row"), (None, "no id"), (12, "12345 !!! ???"), (13, "\x00\x01 control"),
    ]
    rows = [(i, t, "en" if t and k % 2 else None, None, None, k, f"x{k}", 0.5, "y", k, 1, "_", None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row int, keep string, score double, kept string, "
              "id int, label int, _id string, removed_spans string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")
