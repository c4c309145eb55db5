import random
import zlib

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "an be ka lo mi nu ra se to vi".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def odd_docs(spark, extra=()):
    """Rows with nulls in any column, empty, blank and long texts, copies, repeated rows and a null id."""
    rng = random.Random(7)
    base = [prose(rng, n) for n in (3, 40, 60, 120, 200, 500, 4000)]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(base)]
    rows += [(20, base[4], "de", None, None), (21, base[4], None, "src1", 5), (22, base[5] + " end", "en", "src0", 1),
             (23, None, "en", "src2", None), (24, "", None, None, 0), (25, " \n\t ", "fr", "src1", 3),
             (26, "1234 ### 55", "fr", "src1", 11), (27, "one", "en", "", 3), (27, "one", "en", "", 3),
             (27, base[3] + " other", "en", "src1", 9), (None, base[3], "en", "src1", 9), (None, None, None, None, None)]
    df = spark.createDataFrame([(*r, *("x" for _ in extra)) for r in rows], DOCS + "".join(f", {c} string" for c in extra))
    return df, rows


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def crc(text):
    return zlib.crc32((text or "").encode())


def write_table(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def close(a, b):
    return a == pytest.approx(b, rel=1e-9)
