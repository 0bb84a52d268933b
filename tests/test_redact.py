"""Redaction and cleaning against one-pattern-at-a-time Python on random texts."""

import random
import re

import pytest

from talkweave import rules
from talkweave.functions import language, redact, text

PIECES = [
    "fuck", "SHIT", "shhiit", "damn", "f**k", "f.ck", "s-h-t", "s*h*i", "wtf", "stfu", "Bitches", "damné",
    "élan", "classic", "a@b.com", "ann.lee+x@mail.example.co.uk", "x@y.company", "q@w.io_z@k.net", "@", "..@..",
    "555-123-4567", "+1 (020) 7946 0958", "12345678", "12345678901234567", "4111 1111 1111 1111", "123-45-6789",
    "111-2345678-9012345", "B0ABCD1234", "B12345678Z", "BABCDEFGHI", "https://e.com/a?b=1", "http://", "10.0.0.1",
    "192.168.100.200", "$1,249.99", "$,", "$", "€5.00", "7,5€", "123 Main Street", "9 elm ave", "12 Oak", "Dr",
    "Dr.", "Mr John", "Mrs Ann Lee", "Miss", "Turn", "Jane", "Doe", "[[x]]", "[a](b)", "**", "##", "\\n", "{z}",
    "ABCDEF", "ABC_DEF1", "ÀBCDEFGH", "0123456789AB", "123e4567-e89b-12d3-a456-426614174000", "ok", "the", "é",
    "٣٤٥", "ſhit", "[EMAIL]", "7", "42", "2026",
]
SEPARATORS = [
    " ", " ", " ", " ", " ", " ", "", "-", ".", "\n", "\n\n", ", ", "_", "\u00e9", "/",
    "\u00a0", "\x1c", "\u2028", "\u0301", "\u00b2", "\u203f", "\u093f", "\r", "\x0b",
]


def samples(n, seed):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        parts = [rng.choice(PIECES) + rng.choice(SEPARATORS) for _ in range(rng.randint(1, 9))]
        made.append("".join(parts))
    return made


def one(label, value):
    regex, ignore_case = rules.PII_PATTERNS[label]
    return re.sub(regex, f"[{label}]", value, flags=re.IGNORECASE if ignore_case else 0)


def profanity(value):
    for regex in rules.PROFANITY_PATTERNS:
        value = re.sub(regex, rules.PROFANITY_LABEL, value, flags=re.IGNORECASE)
    return value


def sanitized(value, order):
    value = profanity(value)
    for label in rules.REDACTION_ORDERS[order]:
        value = one(label, value)
    return value


def cleaned(value):
    spaced = re.sub("|".join(rules.LANGUAGE_NOISE), " ", value)
    return re.sub(r"\s+", " ", spaced).strip()[:200]


@pytest.mark.parametrize("order", ["specific_first", "shipped"])
def test_sanitize_random(column_values, order):
    texts = samples(3000, 1)
    got = column_values(lambda c: redact.sanitize_text(c, order), texts)
    assert got == [sanitized(t, order) for t in texts]


def test_profanity_random(column_values):
    texts = samples(3000, 2)
    assert column_values(redact.redact_profanity, texts) == [profanity(t) for t in texts]


@pytest.mark.parametrize("label", list(rules.PII_PATTERNS))
def test_label_random(column_values, label):
    texts = samples(1500, 3)
    got = column_values(lambda c: redact.redact(c, label), texts)
    assert got == [one(label, t) for t in texts]


def test_lang_clean_random(column_values):
    texts = samples(4000, 4) + ["x" * 500, "http://a " * 300 + "end", "a" * 199 + " b c"]
    assert column_values(language.lang_clean, texts) == [cleaned(t) for t in texts]


def test_documented_examples(column_values):
    texts = ["Contact john@example.com or call 555-123-4567", "Order 111-2345678-9012345 costs $49.99", "", None]
    assert column_values(redact.sanitize_text, texts) == [
        "Contact [EMAIL] or call [PHONE]", "Order [ORDER_ID] costs [AMOUNT]", "", None,
    ]


def test_shipped_order_lets_phone_win(column_values):
    got = column_values(
        lambda c: redact.sanitize_text(c, "shipped"),
        ["111-2345678-9012345", "4111 1111 1111 1111", "192.168.100.200", "10.0.0.1"],
    )
    assert got == ["[PHONE]345", "[PHONE] 1111", "[PHONE]", "[IP]"]


def test_redaction_is_idempotent_on_labels(column_values):
    labels = [f"[{x}]" for x in rules.PII_PATTERNS] + [rules.PROFANITY_LABEL]
    assert column_values(redact.sanitize_text, labels) == labels


def test_text_helpers(column_values):
    assert column_values(text.simplify_text, ["*a* [b]  `c`\n\td" + "x" * 5000])[0] == "a b c d" + "x" * 3993
    assert column_values(text.truncate_text, ["é" * 8001]) == ["é" * 8000]
    assert column_values(text.is_blank, ["", " \n ", None, "x"]) == [True, True, True, False]
    assert column_values(
        text.unhelpful_response, ["I DON’T have access", "Invalid input", "fine", None]
    ) == [True, True, False, False]
    assert column_values(text.first_sentence, ["  Hi there. More", "no end", "a\nb", None, ""]) == [
        "Hi there.", "no end", "a", "", "",
    ]
