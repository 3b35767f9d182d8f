"""Small document tables with every kind of trouble in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, holder string, hits int, raw string"


def documents(spark, texts, langs=None):
    """texts: (doc_id, text) pairs. Adds columns whose names clash with those that operators use inside."""
    rows = [(k, t, (langs or {}).get(k), None, None, "x", 7, "r") for k, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def words(seed, n, size=400):
    r = random.Random(seed)
    pool = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(size)]
    return " ".join(r.choice(pool) for _ in range(n))


def saved(spark, path, **tables):
    """A folder like the supplied ones."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)
