"""Rows that every operator has to take."""

#: NULLs, empty and very long texts, ties, repeated rows, rows without id.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (4, "one"),
    (5, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (6, "A b c d E f g h i j k l m n o p q r s t u v w x y z"),
    (7, "word " * 30_000),
    (8, "x" * 200_000),
    (9, "Grüße – 漢字   it's  1234\r\n"),
    (None, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (None, None),
    (10, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
]
