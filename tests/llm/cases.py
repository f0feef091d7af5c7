"""A small table with every awkward case, and the words of a text as the contracts define them."""

import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, row string, size string, shard int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{k}" for k in range(120))
PROSE = " ".join(f"the p{k} of" for k in range(60))
ROWS = [
    (1, BASE),
    (2, BASE.replace(" ", "\n", 3)),  # equal without white space
    (3, BASE.replace("w60", "x60")),  # near
    (4, "lead words " + BASE[: BASE.index(" w70")]),
    (5, None),
    (6, ""),
    (7, " \t\n "),
    (8, "one two"),
    (9, "One two"),
    (10, "a b c d e"),
    (None, BASE),
    (None, "null id one"),
    (12, "repeated row of some words here"),
    (12, "repeated row of some words here"),
    (13, "a line of seven whole words here\nnext\na line of seven whole words here"),
    (14, "a line of seven whole words there\n\nother"),
    (15, "é" * 300 + " 日本 🎉 " + "z" * 5000),
    (16, " ".join(f"v{k % 977}" for k in range(30_000))),  # long, and it repeats itself
    (17, "tie of text"),
    (18, "tie of text"),
    (20, PROSE),
    (21, PROSE.replace("p30", "q30")),
    (22, PROSE.replace(" ", "  ")),
]


def table(spark, rows=ROWS):
    """The rows with other columns, null in places, some of whose names the operators use themselves."""
    full = [
        (i, t, None if k % 3 else "en", None if k % 5 == 0 else f"s{k % 4}", k, "kept", "row", "size", k)
        for k, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA)


def words(text):
    return WORD.findall(text or "")
