import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) or (id, text, source), with any columns added."""

    def make(rows, **extra):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *extra.values()) for r in rows]
        schema = DOCS + "".join(f", {name} {'int' if isinstance(v, int) else 'string'}" for name, v in extra.items())
        return spark.createDataFrame(full, schema)

    return make


#: Null and empty texts, white space alone, a null id, a repeated row, ties, a long text.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six"), (4, "one two three four five six"),
    (5, "one two three four five six"), (None, "a text without an id, and nothing else"), (None, None),
    (6, "word " * 20_000), (7, "über straße naïve 日本   x"),
]
