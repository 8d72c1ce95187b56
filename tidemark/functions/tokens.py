"""Column expressions on text lines and tokens; all run inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Control tokens, the clear marker, the value that a guarded job
# refuses, the label and the key the counting jobs attach to their records.
CLEAR_TOKEN = "clear"
CLEAR_WORDS_TOKEN = "clearstate"
QUIT_TOKEN = "quit"
CLEAR = -1
FORBIDDEN = 155
AVERAGE_LABEL = "avg"
STATE_KEY = "statekey"

# The six ASCII blanks that separate tokens.
BLANKS = " \t\n\x0b\f\r"


def split_tokens(line: Column) -> Column:
    """Array of tokens of a line, cut at every single blank.

    Leading and inner empty tokens stay and trailing ones go; an empty line
    holds one empty token, a line of blanks only holds none.
    """
    kept = F.rtrim(line, F.lit(BLANKS))
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, f"[{BLANKS}]"))
    )


def parse_long(token: Column) -> Column:
    """The token as a 64-bit integer, or null when it is not one.

    The pattern is needed next to the cast, which alone also takes blanks around
    the digits.  No match gives an empty text and a value out of range no cast,
    both of which become null.  The token occurs once in the expression, since
    a filter on the result is pushed below whatever computes the token.
    """
    return F.regexp_extract(token, r"\A[+-]?[0-9]+\z", 0).try_cast("bigint")


def parse_marked(token: Column) -> Column:
    """As `parse_long`, with the clear token read as the marker -1."""
    return parse_long(F.when(token == CLEAR_TOKEN, str(CLEAR)).otherwise(token))


def guard_forbidden(n: Column, forbidden: int = FORBIDDEN) -> Column:
    """The number itself; the query fails when it is the forbidden one."""
    return F.when(n == forbidden, F.raise_error(F.lit("not valid")).cast("bigint")).otherwise(n)


def counted(word: Column, count: Column) -> Column:
    """A count row as text: `word : count`."""
    return F.concat(word, F.lit(" : "), count.cast("string"))
