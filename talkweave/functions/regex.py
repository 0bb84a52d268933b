"""Patterns of ``rules`` in the dialect of Spark's ``regexp_replace`` and ``rlike``.

The lists are written for Unicode texts in Python's sense. Java's classes, under the
flag (?U), differ in details (control characters that separate, combining marks,
superscript digits), which are spelled out here. Patterns built with ``java`` need (?U).
"""

import re

WORD = r"\p{L}\p{N}_"
WORD_START = f"(?<![{WORD}])"  # before a word character
WORD_END = f"(?![{WORD}])"  # after a word character
# Most characters are printable ASCII, and one comparison rules those out.
SPACES = r"(?U)(?=[^!-~])[\s\x1c-\x1f]+"

_CLASSES = {
    r"\S": r"[\S&&[^\x1c-\x1f]]",
    r"\s": r"[\s\x1c-\x1f]",
    r"\w": f"[{WORD}]",
    r"\d": r"\p{Nd}",
}
_FIRST = re.compile(r"\[[^\]]+\]|\\p\{Nd\}|[A-Za-z]")


def _first(body: str) -> str:
    """Test of the first character, which is cheaper than looking behind it."""
    if options := re.match(r"\(([A-Za-z|]+)\)", body):
        return "(?=[" + "".join(sorted({o[0] for o in options[1].split("|")})) + "])"
    found = _FIRST.match(body)
    return f"(?={found[0]})" if found else ""


def java(regex: str) -> str:
    r"""One alternative; ``\b`` may stand at its start and its end only."""
    start, end = regex.startswith(r"\b"), regex.endswith(r"\b")
    body = regex.removeprefix(r"\b").removesuffix(r"\b")
    body = re.sub(r"\\[Sswd]", lambda found: _CLASSES[found[0]], body)
    return (_first(body) + WORD_START if start else "") + body + (WORD_END if end else "")
