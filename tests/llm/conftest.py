import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

# Names that the operators use inside, as columns of the input.
CLASHING = "row key cell size bucket segment words id fp first root score features at n copies".split()


@pytest.fixture(scope="session")
def documents(spark):
    """A table of (doc_id, text[, source]) rows; the other columns are filled in."""

    def make(rows, clashing=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if clashing:
            for name in CLASHING:
                df = df.withColumn(name, df.n_chars.cast("string"))
        return df

    return make


@pytest.fixture(scope="session")
def odd():
    """Null and empty texts, white space alone, a null id, a repeated row, and a long text."""
    words = [f"w{i % 997}x{i * i % 1009}" for i in range(30_000)]
    long_text = " ".join(words)
    return [(1, None), (2, ""), (3, " \t\n"), (None, "a null id has this text"), (4, "the same row twice"), (4, "the same row twice"), (5, long_text)]
