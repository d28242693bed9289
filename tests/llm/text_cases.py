"""Odd documents that every operator has to take."""

LONG = "one two three four five six seven eight nine ten. " * 400

#: Null id and text, empty and blank texts, equal texts, repeated rows, a long text.
ODD = [
    (None, None), (None, "a null id. It has text.\nAnd lines."), (1, None), (2, ""), (3, " \n\t "),
    (4, "Same text here, word for word. Twice. Really."), (5, "Same text here, word for word. Twice. Really."),
    (6, "repeated row\nof lines"), (6, "repeated row\nof lines"), (7, LONG),
    (8, "Grüße aus Köln. ÀÉ! 日本語のテキスト。\nemoji 😀 done"), (9, "x" * 3000),
]
