from talkweave.functions import response

LONG = "x" * 1200

CASES = {
    "SUMMARY: all well\nSENTIMENT: Positive.\nKEYWORDS: a, b\nmore": ("all well", "Positive", "a, b"),
    "SUMMARY: no keys\nSENTIMENT: negative": ("no keys", "Negative", ""),
    # KEYWORDS before SENTIMENT: the summary stays the whole text.
    "KEYWORDS: k\nSUMMARY: s\nSENTIMENT: Positive": (
        "KEYWORDS: k\nSUMMARY: s\nSENTIMENT: Positive", "Neutral", "k",
    ),
    "no labels at all": ("no labels at all", "Neutral", ""),
    "SENTIMENT: Positive": ("SENTIMENT: Positive", "Neutral", ""),
    "SUMMARY: dots\nSENTIMENT: Frustrated...\nKEYWORDS:": ("dots", "Negative", ""),
    "SUMMARY: s\nSENTIMENT: not positive": ("s", "Neutral", ""),
    "SUMMARY: s\nSENTIMENT:\n\n  Unresolved \nKEYWORDS:\n\n x, y \nz": ("s", "Negative", "x, y"),
    f"SUMMARY: {LONG}\nSENTIMENT: ok\nKEYWORDS: {LONG}": (LONG[:1000], "Neutral", LONG[:500]),
    "  \n": ("", "Neutral", ""),
}


def test_parse_response(column_values):
    got = column_values(response.parse_response, list(CASES))
    assert [tuple(r) for r in got] == list(CASES.values())


def test_parse_simple_response(column_values):
    cases = {
        "SUMMARY: fine\nSENTIMENT: Positive.\nrest": ("fine", "Positive", ""),
        "SENTIMENT: angry": ("", "Negative", ""),
        "just text": ("just text", "Neutral", ""),
    }
    got = column_values(response.parse_simple_response, list(cases))
    assert [tuple(r) for r in got] == list(cases.values())


def test_status(spark):
    from pyspark.sql import functions as F

    rows = [
        ("end_turn", "text", None, "OK"),
        ("end_turn", "", None, "OK"),
        ("CONTENT_FILTERED", "", None, "FILTERED"),
        ("guardrail_intervened", "x", None, "FILTERED"),
        ("end_turn", "hit by Content Filters", None, "FILTERED"),
        (None, None, "Content filter hit", "FILTERED"),
        (None, None, "ThrottlingException content filter", "ERROR"),
        (None, None, "socket", "ERROR"),
        (None, None, None, "NO_CONTENT"),
    ]
    frame = spark.createDataFrame(rows, "stop_reason string, text string, error string, want string")
    status = response.response_status(F.col("stop_reason"), F.col("text"), F.col("error"))
    assert frame.filter(status != F.col("want")).count() == 0
