"""Language rules that need no statistics: one CASE chain over cleaned text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkweave import rules
from talkweave.functions.regex import SPACES, WORD, java


# Every alternative but the e-mail one starts with one of these; a cheap test first.
_NOISE_START = (
    r"(?=[\[*#\\\n{}()\]|`~<>€$£¥₹.,h\p{Nd}]|[A-Za-f](?<![" + WORD + "][A-Za-f]))"
)
# (?d): only a line feed ends a line.
_NOISE = "(?dU)" + "|".join(map(java, rules.LANGUAGE_NOISE))
_NOISE_WITHOUT_AT = (
    f"(?dU){_NOISE_START}(?:" + "|".join(java(p) for p in rules.LANGUAGE_NOISE if "@" not in p) + ")"
)

#: Characters that are cleaned first; most texts keep more than LANGUAGE_CHARS of them.
CLEANED_FIRST = 2 * rules.LANGUAGE_CHARS


def _cleaned(text: Column) -> Column:
    spaced = F.when(text.contains("@"), F.regexp_replace(text, _NOISE, " ")).otherwise(
        F.regexp_replace(text, _NOISE_WITHOUT_AT, " ")
    )
    return F.trim(F.regexp_replace(spaced, SPACES, " "))


def lang_clean(raw: Column) -> Column:
    """Text without links, markup, ids, amounts and addresses; first 200 characters.

    The start of a long text is cleaned alone, which gives the same wherever enough is left of it: nothing reaches over the line end where it is cut, and
    nothing that opens without "[" over a blank. The rest of the texts are cleaned whole.
    """
    text = F.coalesce(raw, F.lit(""))
    start = F.left(text, F.lit(CLEANED_FIRST))
    border = F.when(start.contains("["), "\n").otherwise(" ")
    cut = F.left(start, CLEANED_FIRST - F.instr(F.reverse(start), border))
    enough = F.regexp_extract_all(_cleaned(cut), F.lit(f"(?s)^.{{{rules.LANGUAGE_CHARS}}}"), F.lit(0))
    first = F.when((F.length(text) > CLEANED_FIRST) & start.contains(border), F.try_element_at(enough, F.lit(1)))
    return F.coalesce(first, F.left(_cleaned(text), F.lit(rules.LANGUAGE_CHARS)))


def has_language(cleaned: Column) -> Column:
    """Long enough, and at least two adjacent letters of a known script."""
    return (F.length(cleaned) >= 3) & cleaned.rlike(rules.KNOWN_LETTERS)


def lang_hinglish(cleaned: Column, strip_punctuation: bool = False) -> Column:
    """Hindi written in Latin letters: three or more distinct listed words."""
    lowered = F.lower(cleaned)
    if strip_punctuation:
        lowered = F.regexp_replace(lowered, r"[^\p{L}\p{N} ]", "")
    hits = F.array_intersect(F.split(lowered, " "), F.array(*map(F.lit, rules.HINGLISH_WORDS)))
    return F.when(F.size(hits) >= 3, F.lit("Hindi"))


def lang_script(cleaned: Column) -> Column:
    return (
        F.when(cleaned.rlike(rules.HAN) & cleaned.rlike(rules.KANA), "Japanese")
        .when(cleaned.rlike(rules.HAN), "Chinese")
        .when(cleaned.rlike(rules.KANA), "Japanese")
        .when(cleaned.rlike(rules.HANGUL), "Korean")
        .when(cleaned.rlike(rules.ARABIC), "Arabic")
        .when(cleaned.rlike(rules.DEVANAGARI), "Hindi")
        .when(cleaned.rlike(rules.TURKISH_LETTERS), "Turkish")
        .when(cleaned.rlike(rules.GERMAN_LETTERS), "German")
    )


def lang_short_ascii(cleaned: Column) -> Column:
    short = (F.length(cleaned) < 50) & ~cleaned.rlike(r"[^\x00-\x7F]")
    return F.when(short, F.lit("English"))


def rule_language(cleaned: Column, strip_punctuation: bool = False) -> Column:
    """Language by rule, or null where there is none or only statistics can tell."""
    by_rule = F.coalesce(
        lang_hinglish(cleaned, strip_punctuation), lang_script(cleaned), lang_short_ascii(cleaned)
    )
    return F.when(has_language(cleaned), by_rule)


def trigrams(text: Column) -> Column:
    """Character trigrams of the blank-padded words of a text, repeats kept: one around each letter, all else being a blank."""
    padded = F.concat(F.lit(" "), F.array_join(F.split(F.lower(text), r"[^\p{L}]+"), " "), F.lit(" "))
    return F.regexp_extract_all(padded, F.lit(r"(?=(.\p{L}.))"), F.lit(1))


def ranked_trigrams(text: Column) -> Column:
    """The distinct trigrams of a text, the most frequent first, ties by name. All within the row: a row per trigram, each with
    its text, would take hundreds of times the text. Sorted and joined, equal trigrams are one stretch of the text each, as long as they are frequent."""
    stretches = F.regexp_extract_all(F.array_join(F.sort_array(trigrams(text)), ""), F.lit(r"(?s)(...)\1*"), F.lit(0))
    by_count = F.transform(stretches, lambda s: F.struct((-F.length(s)).alias("minus"), F.left(s, F.lit(3)).alias("trigram")))
    return F.sort_array(by_count)["trigram"]
