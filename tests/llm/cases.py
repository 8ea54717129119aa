"""Rows that every operator must stand."""

LONG = "the quick brown fox jumps over one lazy dog number %d and runs away from it again\n"

#: Nulls, empty and blank texts, a very long text, ties and repeated rows.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one two three"),
    (4, "one two three"),
    (5, "one  two three "),
    (None, "one two three"),
    (6, "".join(LONG % k for k in range(3000))),
    (7, "é日本 👍🏽 token = 'abcdef123456' end"),
    (8, "x" * 30_000),
    (9, "".join(LONG % k for k in range(50, 90))),
]
