"""Redaction of profanity and personal data as nested ``regexp_replace`` columns."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkweave import rules
from talkweave.functions.regex import WORD_START, java

# All profanity patterns start at a word start with one of seven letters: testing
# that once per position is several times faster than trying thirteen patterns.
PROFANITY = (
    f"(?iU){WORD_START}(?=[fsabcdiw])(?:"
    + "|".join(java(p.removeprefix(r"\b")) for p in rules.PROFANITY_PATTERNS)
    + ")"
)
NEED_DIGITS = {"PHONE", "CARD", "ACCOUNT", "SSN", "ORDER_ID", "IP", "ADDRESS"}
NEED_AT = {"EMAIL"}
DIGIT = r"\p{Nd}"


def pattern(label: str) -> str:
    regex, ignore_case = rules.PII_PATTERNS[label]
    first = r"(?=[+(\p{Nd}])" if label == "PHONE" else ""
    return ("(?iU)" if ignore_case else "(?U)") + first + java(regex)


def redact_profanity(c: Column) -> Column:
    # One alternation replaces thirteen passes: each pattern starts at a word
    # start and none of them can match inside the label.
    return F.regexp_replace(c, PROFANITY, rules.PROFANITY_LABEL)


def redact(c: Column, label: str) -> Column:
    """Replace one kind of personal data, for example ``redact(col, "EMAIL")``."""
    return F.regexp_replace(c, pattern(label), f"[{label}]")


def redact_all(c: Column, labels: list[str], has_digits: Column | None = None) -> Column:
    """Profanity, then ``labels`` in order.

    No step adds a digit or an "@", so text without them takes a shorter chain.
    ``has_digits`` replaces the test for digits where the caller knows better.
    """

    def chain(*absent: set[str]) -> Column:
        skipped = set().union(*absent)
        return reduce(redact, [x for x in labels if x not in skipped], redact_profanity(c))

    digits, at = c.rlike(DIGIT) if has_digits is None else has_digits, c.contains("@")
    return (
        F.when(digits & at, chain())
        .when(digits, chain(NEED_AT))
        .when(at, chain(NEED_DIGITS))
        .otherwise(chain(NEED_DIGITS, NEED_AT))
    )


def sanitize_text(c: Column, order: str = "specific_first") -> Column:
    """Profanity first, then every label; ``order`` is a key of ``rules.REDACTION_ORDERS``."""
    return redact_all(c, rules.REDACTION_ORDERS[order])


def strip_labels(c: Column) -> Column:
    """Remove the redaction labels themselves."""
    return F.regexp_replace(c, r"\[[A-Z_]+\]", " ")
