"""Hard cases that every operator meets."""

#: Null and repeated ids, null and empty texts, ties, a very long text, words without spaces.
ROWS = [
    (None, "alpha beta gamma delta", "clash"), (1, None, None), (2, "", "x"), (2, "", "x"), (3, "Same text here, twice.", "y"),
    (4, "sAME TEXT here, TWICE.", "y"), (4, "sAME TEXT here, TWICE.", "y"), (5, "long words " * 60_000, None),
    (6, "x" * 50_000, None), (7, "É é ß 한글 ́ \x00 tail", None), (8, " \n\n \t ", None), (None, None, None),
]


def documents(spark, rows=None, extra=()):
    """Documents with columns whose names the operators use themselves."""
    rows = ROWS if rows is None else rows
    df = spark.createDataFrame([(i, t, "en", "s", 0, c) for i, t, c in rows], "doc_id long, text string, lang string, source string, n_chars long, id string")
    for name in ("digest", "kept", "hash", "n", "bad", "queue", "block", *extra):
        df = df.selectExpr("*", f"'clash' `{name}`")
    return df


def ids(rows):
    return sorted((-1 if r is None else r) for r in rows)


ALL_IDS = ids(r[0] for r in ROWS)
