"""Small tables with the awkward rows that every operator must take."""

import random

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


def edited(text: str, every: int, seed: int = 0) -> str:
    words = text.split(" ")
    for i in range(seed % every, len(words), every):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


def awkward_texts() -> list:
    base = prose(1, 120)
    return [None, "", "   \n\t ", "\n\n", "one", "one two three four", base, base, base.upper(), edited(base, 60, 1),
            edited(base, 7, 2), prose(2, 45) + "\n" + base, "x" * 5000, prose(3, 20_000), "Ünï çödé \u00a0 b\x00c",
            "same line\n Same LINE \nother\n\nother"]


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns named as operators name their own
CLASH = ["row", "rk", "rate", "copy", "kept", "n", "u", "k", "best", "host", "path", "lost_at", "lines", "draws"]


def documents(spark, clash: bool = False):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 3}" if i % 4 else None, None if t is None else len(t))
            for i, t in enumerate(awkward_texts())]
    rows += [rows[6], rows[6], (None, "a null id", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    if clash:
        from pyspark.sql import functions as F
        for c in CLASH:
            df = df.withColumn(c, F.lit("mine"))
    return df


def empty(spark, schema: str = DOC_SCHEMA):
    return spark.createDataFrame([], schema)


def rows(df, *cols):
    """Rows as a sorted list of tuples, nulls first."""
    got = [tuple(r) for r in df.select(*cols or df.columns).collect()]
    return sorted(got, key=lambda t: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in t))
