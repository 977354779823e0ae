import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, node string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    base = " ".join(f"word{i} the lazy fox's jump, no {i % 7}" for i in range(40))
    changed = base.replace("word20", "changed")
    rows = [
        (1, base, "en"),
        (2, base, "en"),
        (2, base, "en"),
        (2, "another text under the same id, with enough words to count", None),
        (None, base, "en"),
        (None, None, None),
        (3, None, "en"),
        (4, "", "en"),
        (5, " \n\t ", "en"),
        (6, changed, "en"),
        (7, "\n".join(["une ligne répétée à la fin", base, "une ligne répétée à la fin"]), "fr"),
        (8, "a" * 70_000, "de"),
        (9, "1234 5678 !!! <|endoftext|> ... " * 3000, "es"),
        (10, "漢字 かな 😀 ẞ ﬁ É é   İstanbul ΟΔΟΣ", "xx"),
        (11, "tab\there  two  spaces 'quoted' we'll\r\n\r\nend ", "en"),
        (12, "one two", "en"),
        (13, "w " * 20_000, "en"),
    ]
    return spark.createDataFrame([(*r, f"s{i}", 0, 0.5, "n") for i, r in enumerate(rows)], COLUMNS)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
