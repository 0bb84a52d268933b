"""Turn-level text expressions. Every function takes and returns Columns."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkweave import rules
from talkweave.functions.regex import SPACES


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(rules.WHITESPACE))


def is_blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def contains_any(c: Column, phrases: list[str]) -> Column:
    """OR of substring tests: stays in generated code and stops at the first hit."""
    return reduce(or_, [c.contains(p) for p in phrases])


def format_turn(rank: Column, question: Column, response: Column) -> Column:
    return F.concat(
        F.lit("Turn "), F.coalesce(rank.cast("string"), F.lit("")),
        F.lit(":\nUser: "), F.coalesce(question, F.lit("")),
        F.lit("\nBot: "), F.coalesce(response, F.lit("")),
    )


def normalize_quotes(response: Column) -> Column:
    straight = F.coalesce(response, F.lit(""))
    for curly, plain in zip("‘’“”", "''\"\""):
        straight = F.replace(straight, F.lit(curly), F.lit(plain))
    return F.lower(straight)


def unhelpful_response(response: Column, phrases: list[str] = rules.UNHELPFUL_PHRASES) -> Column:
    return contains_any(normalize_quotes(response), [p.lower() for p in phrases])


def alphanumeric_tokens(question: Column, response: Column) -> Column:
    """ASCII alphanumeric tokens of a turn, the unit acronyms are matched on."""
    text = F.concat(F.coalesce(question, F.lit("")), F.lit(" "), F.coalesce(response, F.lit("")))
    return F.split(text, r"\P{Alnum}+")


def letter_words(c: Column) -> Column:
    """Lower-case runs of letters; may hold an empty string at either end."""
    return F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}]+")


def truncate_text(c: Column, n: int = rules.PROMPT_CHARS) -> Column:
    return F.left(c, F.lit(n))


def simplify_text(c: Column) -> Column:
    """Plain text for the second prompt: no markup characters, single spaces."""
    bare = F.regexp_replace(c, r"[*#\\_\[\](){}|`~]", "")
    return F.left(F.regexp_replace(bare, SPACES, " "), F.lit(rules.FALLBACK_CHARS))


def build_prompt(safe_text: Column) -> Column:
    return F.concat(F.lit(rules.PROMPT_TEMPLATE), safe_text)


def build_fallback_prompt(safe_text: Column) -> Column:
    return F.concat(F.lit(rules.FALLBACK_TEMPLATE), simplify_text(safe_text))


def first_sentence(c: Column) -> Column:
    """Up to the first full stop, question mark, exclamation mark or line end."""
    return F.trim(F.regexp_extract(F.coalesce(c, F.lit("")), r"^\s*([^.!?\n]*[.!?]?)", 1))


def polarity(c: Column) -> Column:
    """Positive minus negative words, as an integer."""
    words = letter_words(c)
    good = F.size(F.filter(words, lambda w: w.isin(rules.POSITIVE_WORDS)))
    bad = F.size(F.filter(words, lambda w: w.isin(rules.NEGATIVE_WORDS)))
    return good - bad
