"""Small tables with the awkward cases, and brute-force versions of the contracts."""

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", sources[i] if sources else f"s{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def folder(spark, tmp_path, **tables):
    """A folder of Parquet tables; each gets columns that clash with names used inside the operators."""
    for name, df in tables.items():
        for c in ("score", "text_key", "flow", "host", "_x", "id", "key", "spans", "row_id"):
            if c not in df.columns:
                df = df.withColumn(c, F.lit("clash"))
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))
