"""The awkward rows as plain data, for brute-force versions."""

AWKWARD_ROWS = [(1, None), (2, ""), (3, ""), (None, "a text without an id is a text"), (4, "same text"),
                (4, "same text"), (5, " \t\n\r "), (6, "long " * 30_000), (7, "x" * 100_000),
                (8, "Größe Ärger 東京   😀 ſ K"), (9, "one two three"), (10, "ONE two three"), (11, "one"),
                (None, None)]
