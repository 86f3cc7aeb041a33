import pytest

DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """A documents table from (doc_id, text, source) rows, with clashing extra columns, stored."""
    from barsmith.session import scratch_path

    def make(rows):
        df = spark.createDataFrame(
            [(d, t, "en", s, None if t is None else len(t)) for d, t, s in rows], DOC_DDL)
        # names that the operators use inside
        for c in ("row", "g", "key", "size", "kept", "ids", "label", "text_sha256"):
            df = df.selectExpr("*", f"'x' AS {c}")
        path = scratch_path(spark, "t-documents")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return make


WORDS = ("the of and to in is that it was for on are as with his they at be this from "
         "have or by one had not but what all were when we there can an your which").split()

AWKWARD = [
    (1, "alpha beta  gamma", "s1"), (2, "alpha beta gamma", "s1"), (3, "alphabetagamma", "s2"),
    (4, None, "s1"), (5, "", "s2"), (6, " \t\n\x0b\x0c\r", None), (7, None, None),
    (8, "é ß 字 😀 ▁  x", "s2"), (9, "word " * 400, "s1"), (10, "x" * 30_000, "s1"),
    (11, "\n\n a \n b \n a \n", "s3"), (None, "alpha beta gamma", "s3"), (12, "alpha beta gamma", "s1"),
    (12, "alpha beta gamma", "s1"), (13, "<|endoftext|> <s> </s> \x00", ""), (14, "it's  don't 'll  we've", "s3"),
]


def corpus(n=120, seed=7):
    """Random documents with copies, near copies, shared passages and repeated lines."""
    import random

    rnd = random.Random(seed)
    passage = " ".join(rnd.choice(WORDS) + str(rnd.randrange(9)) for _ in range(60))
    rows = []
    for i in range(n):
        kind = rnd.randrange(8)
        text = " ".join(rnd.choice(WORDS) + (str(rnd.randrange(30)) if rnd.random() < .5 else "")
                        for _ in range(rnd.randrange(1, 160)))
        if kind == 0 and rows:
            text = rnd.choice(rows)[1]
        elif kind == 1 and rows:
            old = rnd.choice(rows)[1].split(" ")
            old[rnd.randrange(len(old))] = "changed"
            text = " ".join(old)
        elif kind == 2:
            text = text + "\n" + passage + "\n" + text[: rnd.randrange(200)]
        elif kind == 3:
            text = "A common line of this host.\n" + text
        rows.append((i, text, f"s{rnd.randrange(4)}"))
    return rows
