"""Rows that every operator must stand, and where the test tables are."""

SF_DIR = "/root/testdata/sf0.01"

# Nulls, empty and blank texts, ties, repeated rows, very long texts and odd characters.
EDGE_ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n\u000b\f\r "),
    (4, "one"),
    (5, "The cat sat on the mat and the dog lay on the rug near the door."),
    (5, "The cat sat on the mat and the dog lay on the rug near the door."),
    (6, "the CAT sat on the mat and the dog lay on the rug near the door."),
    (None, "The cat sat on the mat and the dog lay on the rug near the door."),
    (7, "x" * 200_000),
    (8, "word " * 30_000),
    (9, "café naïve   straße 　   日本語 \U0001f44d́ \x00 \x1c tail "),
    (9, "another text under the same id, with words of its own to tell it apart"),
    (10, "<|endoftext|> a<|endoftext|>b <|endoftext|>"),
]
