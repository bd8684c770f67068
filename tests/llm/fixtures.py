"""Small hand-made tables for the corpus operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: An extra column whose name an operator might use itself.
CLASH = ", size long, bucket string, key string, shard string"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(("ba", "ke", "lo", "mi", "nu", "rst", "tor", "zel")) for _ in range(r.randint(2, 4))) for _ in range(n))


def docs(spark, rows, clash=False):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    if clash:
        return spark.createDataFrame([(*r, 7, "b", "k", "s") for r in full], DOCS + CLASH)
    return spark.createDataFrame(full, DOCS)


def save(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
