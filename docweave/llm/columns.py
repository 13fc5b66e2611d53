"""Small helpers on columns and column names."""

from pyspark.sql import functions as F

# The blanks that part words and are stripped from lines, the letters
# that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text):
    """A-Z lower-cased; `lower` does just that in texts of single bytes."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def let(value, body):
    """`body(value)` with `value` computed once per row.

    Inside a function over array elements, a column expression is computed anew for
    each element; a variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(name, taken):
    """`name`, with underscores added until no column has it."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name += "_"
    return name
