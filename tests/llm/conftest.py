import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, columns=COLUMNS):
    return spark.createDataFrame(rows, columns)


def odd_rows():
    """Nulls in every column, empty and white-space texts, a very long one, ties and repeats."""
    long_text = " ".join(f"word{i % 977} filler{i % 31}" for i in range(30_000)) + ".\nlast line of the long text"
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    return [
        (1, base, "en", "a", len(base)), (1, base, "en", "a", len(base)), (1, base, "en", "a", len(base)),
        (2, base, "en", "b", len(base)), (3, None, "en", "b", None), (4, "", "en", None, 0),
        (5, " \n\t ", None, "c", 4), (6, long_text, "en", "a", len(long_text)), (None, base, "en", "a", len(base)),
        (None, None, None, None, None), (7, "short", "en", "c", 5), (8, "Ünïcode ñandú 日本語 テスト", "xx", "d", 24),
        (9, base + " fifteen sixteen", "en", "b", 90), (10, "idiot. " + base, "en", "a", 80),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, odd_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(spark, odd):
    """The odd rows with further columns named like the operators' own."""
    names = ("_b _th _h _g _m _at _d _t _kept _row _rec _recs _bucket _end _hb shard slot leak toxicity SCORE starts ends"
             " sid pass block start size take n fp sig words target hashes positions before rank").split()
    out = odd
    for n in names:
        from pyspark.sql import functions as F
        out = out.withColumn(n, F.lit("x"))
    return out


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
