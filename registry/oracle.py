"""DuckDB SQL equivalents of the registered queries.

RE2 has no look-ahead and ASCII-only word boundaries; where a pattern needs more,
the SQL form differs from the Spark form.
"""

from registry import fixtures as fx
from talkweave import rules
from talkweave.plans import quality

NL = "chr(10)"


def lit(value: str) -> str:
    """SQL literal; line breaks and quotes included."""
    return "'" + value.replace("'", "''") + "'"


def case(index: str, texts: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in texts.items())
    return f"CASE {index} {whens} ELSE '' END"


def any_of(values) -> str:
    return ", ".join(lit(v) for v in values)


# --- fixtures ---

PAIRS = """
said AS (
  SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WHERE role <> 'system' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn_rank,
         text AS question, CASE WHEN next_role = 'assistant' THEN next_text END AS response
  FROM said WHERE role = 'user')"""

TURNS = f"""{PAIRS},
turns AS (
  SELECT *, question AS question_raw, response AS response_raw FROM (
    SELECT conv_id, 'chat_' || lpad(conv_id::VARCHAR, 6, '0') AS chat_id,
      'turn_' || conv_id || '_' || turn_rank AS turn_id, turn_rank,
      CASE WHEN conv_id % 9 = 4 AND turn_rank > 1 THEN {lit(fx.REPEATED_QUESTION)} ELSE
        {case('(conv_id + turn_rank) % 6', fx.QUESTION_PREFIX)} || question ||
        {case('(conv_id + turn_rank) % 7', fx.QUESTION_SUFFIX)} END AS question,
      response || {case('(conv_id + turn_rank) % 11', fx.RESPONSE_SUFFIX)} AS response,
      '2026-01-0' || (conv_id % 7 + 1) AS chat_date
    FROM pairs))"""

DOCS = f"""
docs AS (
  SELECT doc_id, text || {case('doc_id % 16', fx.DOCUMENT_SUFFIX)} AS text,
         {case('doc_id % 12', fx.DOCUMENT_PREFIX)} || text AS scripted
  FROM documents)"""

SUMMARIES = f"""{TURNS},
summaries AS (
  SELECT 'chat_' || lpad(conv_id::VARCHAR, 6, '0') AS chat_id,
    CASE WHEN conv_id % 17 <> 5 THEN '2026-01-0' || (conv_id % 7 + 1) END AS chat_date,
    CASE conv_id % 13 WHEN 1 THEN 'ERROR: backend down' WHEN 2 THEN 'CONTENT_FILTERED'
      WHEN 3 THEN 'NO_CONTENT' ELSE arg_min(question, turn_rank) END AS summary,
    CASE WHEN conv_id % 13 = 1 THEN 'ERROR' WHEN conv_id % 3 = 0 THEN 'Positive'
      WHEN conv_id % 3 = 1 THEN 'Negative' ELSE 'Neutral' END AS chat_sentiment,
    'topic ' || (conv_id % 7) || ', topic ' || (conv_id % 5 + 7) ||
      CASE WHEN conv_id % 11 <> 0 THEN ', topic ' || (conv_id % 3 + 12) ELSE '' END AS keywords,
    CASE WHEN conv_id % 5 = 0 THEN 'N' ELSE 'Y' END AS is_in_scope,
    (conv_id % 4 % 3)::INT AS acronym_count,
    CASE WHEN conv_id % 4 = 1 THEN 'API' WHEN conv_id % 4 = 2 THEN 'API, SLA'
      WHEN conv_id % 8 = 3 THEN 'KYC' ELSE '' END AS acronyms_found,
    CASE conv_id % 4 WHEN 0 THEN 'English' WHEN 1 THEN 'French' WHEN 2 THEN 'German'
      ELSE 'Klingon' END AS user_language,
    count(*) AS total_turns, '2026-02-01T00:00:00+00:00' AS summarized_at
  FROM turns GROUP BY conv_id)"""

RERUN = f"""{SUMMARIES},
rerun AS (
  SELECT * REPLACE (
    CASE WHEN right(chat_id, 1) IN ('0', '3', '6', '9') THEN '2026-01-09' ELSE chat_date END AS chat_date,
    'again: ' || summary AS summary, '2026-02-02T00:00:00+00:00' AS summarized_at)
  FROM summaries),
kept AS (
  SELECT s.* FROM summaries s WHERE NOT EXISTS (SELECT 1 FROM rerun r
    WHERE r.chat_id IS NOT DISTINCT FROM s.chat_id AND r.chat_date IS NOT DISTINCT FROM s.chat_date))"""

SAY = {
    0: f"' SUMMARY: ' || question || {NL} || 'SENTIMENT: Positive.' || {NL} || 'KEYWORDS: alpha, ' || r",
    1: f"'SUMMARY: ' || question || {NL} || 'SENTIMENT: not positive'",
    2: f"'KEYWORDS: a, b' || {NL} || 'SUMMARY: ' || question || {NL} || 'SENTIMENT: Negative'",
    3: "question",
    4: f"'SUMMARY: x' || {NL} || {NL} || 'SENTIMENT:  Frustrated...' || {NL} || 'KEYWORDS:' || {NL}"
       f" || '  one, two ' || {NL} || r || {NL}",
    5: "''",
    6: "'Sorry: blocked by our Content Filters.'",
}
RESPONSES = f"""{TURNS},
kinds AS (SELECT *, (conv_id + turn_rank) % 12 AS kind, coalesce(response, 'none') AS r FROM turns),
responses AS (
  SELECT chat_id, turn_id,
    CASE kind WHEN 5 THEN 'CONTENT_FILTERED' WHEN 10 THEN 'guardrail_intervened' WHEN 11 THEN NULL
      ELSE 'end_turn' END AS stop_reason,
    CASE kind {' '.join(f'WHEN {k} THEN {v}' for k, v in SAY.items())} END AS text,
    CASE kind WHEN 7 THEN 'Content was stopped by a filter'
      WHEN 8 THEN 'ThrottlingException: content filter busy' WHEN 9 THEN 'socket closed' END AS error
  FROM kinds)"""


# --- expressions ---

SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"


def strip(x: str) -> str:
    return f"trim({x}, {SPACES})"


def profanity(x: str) -> str:
    # Word ends need no look-ahead here: the word is taken to its last letter.
    stems = [p.removeprefix(r"\b").removesuffix(r"\b").replace(r"\w", r"[\p{L}\p{N}_]") for p in rules.PROFANITY_PATTERNS]
    inner = "|".join(s if s.endswith("*") else s + r"\b" for s in stems)
    return f"regexp_replace({x}, {lit('(^|[^' + WORD + '])(?:' + inner + ')')}, {lit(chr(92) + '1' + rules.PROFANITY_LABEL)}, 'gi')"


WORD = r"\p{L}\p{N}_"


def redact(x: str, label: str) -> str:
    regex, ignore_case = rules.PII_PATTERNS[label]
    to = f"[{label}]"
    if label == "EMAIL":
        regex, to = regex.replace(r"(?=\s|[^a-zA-Z]|$)", "([^a-zA-Z]|$)"), to + r"\1"
    return f"regexp_replace({x}, {lit(regex)}, {lit(to)}, '{'gi' if ignore_case else 'g'}')"


def sanitize(x: str, order: str = "specific_first") -> str:
    x = profanity(x)
    for label in rules.REDACTION_ORDERS[order]:
        x = redact(x, label)
    return x


def simplify(x: str) -> str:
    bare = f"regexp_replace({x}, {lit(r'[*#\\_\[\](){}|`~]')}, '', 'g')"
    return f"left(regexp_replace({bare}, '\\s+', ' ', 'g'), {rules.FALLBACK_CHARS})"


def normal(x: str) -> str:
    return f"lower(translate(coalesce({x}, ''), '‘’“”', {lit(chr(39) * 2 + chr(34) * 2)}))"


def unhelpful(x: str) -> str:
    n = normal(x)
    return "(" + " OR ".join(f"contains({n}, {lit(p.lower())})" for p in rules.UNHELPFUL_PHRASES) + ")"


TURN_TEXT = (
    f"'Turn ' || turn_rank || ':' || {NL} || 'User: ' || coalesce(question, '') || {NL}"
    " || 'Bot: ' || coalesce(response, '')"
)
CHAT_TEXT = f"string_agg({TURN_TEXT}, {NL} || {NL} ORDER BY turn_rank, turn_id)"
TOKENS = "regexp_split_to_array(coalesce(question, '') || ' ' || coalesce(response, ''), '[^A-Za-z0-9]+')"


def clean(x: str) -> str:
    # A "q" on both sides of every non-ASCII letter makes it part of a word for \\b.
    marked = f"regexp_replace(coalesce({x}, ''), {lit(r'([^\x00-\x7F\P{L}])')}, 'q\\1q', 'g')"
    noise = f"regexp_replace({marked}, {lit('|'.join(rules.LANGUAGE_NOISE))}, ' ', 'g')"
    plain = f"regexp_replace({noise}, {lit(r'q([^\x00-\x7F\P{L}])q')}, '\\1', 'g')"
    return f"left(trim(regexp_replace({plain}, '\\s+', ' ', 'g')), {rules.LANGUAGE_CHARS})"


def matches(x: str, regex: str) -> str:
    return f"regexp_matches({x}, {lit(regex)})"


def script(x: str) -> str:
    kana, han = matches(x, rules.KANA), matches(x, rules.HAN)
    tests = [
        (f"{han} AND {kana}", "Japanese"), (han, "Chinese"), (kana, "Japanese"),
        (matches(x, rules.HANGUL), "Korean"), (matches(x, rules.ARABIC), "Arabic"),
        (matches(x, rules.DEVANAGARI), "Hindi"), (matches(x, rules.TURKISH_LETTERS), "Turkish"),
        (matches(x, rules.GERMAN_LETTERS), "German"),
    ]
    return "CASE " + " ".join(f"WHEN {t} THEN '{n}'" for t, n in tests) + " END"


def hinglish(x: str) -> str:
    listed = f"[{any_of(rules.HINGLISH_WORDS)}]"
    hits = f"len(list_distinct(list_intersect(string_split(lower({x}), ' '), {listed})))"
    return f"CASE WHEN {hits} >= 3 THEN 'Hindi' END"


def short_ascii(x: str) -> str:
    return f"CASE WHEN length({x}) < 50 AND NOT {matches(x, '[^' + chr(92) + 'x00-' + chr(92) + 'x7F]')} THEN 'English' END"


def has_language(x: str) -> str:
    return f"(length({x}) >= 3 AND {matches(x, rules.KNOWN_LETTERS)})"


def by_rule(x: str) -> str:
    return f"CASE WHEN {has_language(x)} THEN coalesce({hinglish(x)}, {script(x)}, {short_ascii(x)}) END"


def trigram_rows(source: str, keys: str, x: str, weight: str = "1") -> str:
    """SELECT keys, trigram, n over the blank-padded words of x."""
    return f"""SELECT {keys}, trigram, sum({weight}) AS n FROM (
      SELECT *, unnest(list_transform(range(1, length(word) + 1), lambda i: substr(' ' || word || ' ', i, 3))) AS trigram
      FROM (SELECT *, unnest(regexp_split_to_array(lower({x}), '[^\\p{{L}}]+')) AS word FROM {source})
      WHERE word <> '') GROUP BY {keys}, trigram"""


CODES = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in rules.LANGUAGE_CODES.items())
def profiles(name: str, source: str) -> str:
    """CTEs ending in ``name`` (language, trigram, profile_rank), trained on ``source``."""
    return f"""
{name}_counts AS ({trigram_rows(source, "lang", "text")}),
{name} AS (
  SELECT CASE lang {CODES} END AS language, trigram, profile_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, trigram) AS profile_rank
    FROM {name}_counts WHERE lang IN ({any_of(rules.LANGUAGE_CODES)})) WHERE profile_rank <= 300)"""


PROFILES = profiles("profiles", "(SELECT * FROM documents WHERE doc_id % 2 = 0)")


def ngram(name: str, source: str, keys: str, x: str) -> str:
    """CTEs ending in ``name`` (keys, detected): best language of x per key."""
    return f"""
{name}_n AS ({trigram_rows(source, keys, x)}),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, trigram) AS text_rank FROM {name}_n),
{name}_s AS (SELECT {keys}, language, sum(300 - abs(text_rank - profile_rank)) AS score
  FROM {name}_r JOIN profiles USING (trigram) GROUP BY {keys}, language),
{name} AS (SELECT {keys}, arg_min(language, (-score, language)) AS detected FROM {name}_s GROUP BY {keys})"""


def closest(name: str, source: str, keys: str, x: str) -> str:
    """CTEs ending in ``name`` (keys, language, share, margin, band): the best language of x per key and how near it is."""
    return f"""
{name}_n AS ({trigram_rows(source, keys, x)}),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, trigram) AS text_rank FROM {name}_n),
{name}_s AS (SELECT {keys}, language, sum(300 - abs(text_rank - profile_rank))::BIGINT AS score
  FROM {name}_r JOIN profiles USING (trigram) GROUP BY {keys}, language HAVING score > 0),
{name}_o AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, language) AS place FROM {name}_s),
{name}_b AS (SELECT {keys}, max(language) FILTER (place = 1) AS language, max(score) AS score,
  coalesce(max(score) FILTER (place = 2), 0) AS second FROM {name}_o GROUP BY {keys}),
{name} AS (SELECT {keys}, language, 1000 * score // (300 * n) AS share, 1000 * (score - second) // score AS margin, length(bin(n)) - 1 AS band
  FROM {name}_b JOIN (SELECT {keys}, count(*) AS n FROM {name}_r GROUP BY {keys}) USING ({keys}))"""


OPEN_SET = (
    profiles("profiles", "(SELECT * FROM documents WHERE doc_id % 2 = 0 AND lang <> 'es')"),
    f"cleaned AS (SELECT doc_id, lang, {clean('text')} AS x FROM documents)",
    """cut AS (SELECT doc_id, size, lang, left(x, size) AS x FROM cleaned, (SELECT unnest([25, 50, 100, 200]) AS size)
  WHERE doc_id % 4 = 1 AND lang <> 'es')""",
    closest("held", "cut", "doc_id, size", "x"),
    f"""limits AS (SELECT language, band, quantile_disc(share, 0.02) AS least_share, quantile_disc(margin, 0.02) AS least_margin
  FROM held JOIN cut USING (doc_id, size) WHERE language = CASE lang {CODES} END GROUP BY language, band)""",
    closest("best", "cleaned", "doc_id", "x"),
)

LANGUAGES = f"""{PROFILES},
cleaned AS (SELECT chat_id, turn_id, {clean('question_raw')} AS q, {clean('response_raw')} AS r FROM turns),
ruled AS (SELECT *, {by_rule('q')} AS q_rule, {by_rule('r')} AS r_rule FROM cleaned),
{ngram('q_best', f"(SELECT * FROM ruled WHERE q_rule IS NULL AND {has_language('q')})", 'turn_id', 'q')},
{ngram('r_best', f"(SELECT * FROM ruled WHERE r_rule IS NULL AND {has_language('r')})", 'turn_id', 'r')},
turn_languages AS (
  SELECT chat_id, turn_id, coalesce(q_rule, q_best.detected, r_rule, r_best.detected, 'English') AS language
  FROM ruled LEFT JOIN q_best USING (turn_id) LEFT JOIN r_best USING (turn_id)),
chat_languages AS (
  SELECT chat_id, arg_min(language, (-n, language)) AS user_language
  FROM (SELECT chat_id, language, count(*) AS n FROM turn_languages GROUP BY ALL) GROUP BY chat_id)"""

FACTS = f"""
facts AS (
  SELECT chat_id, count(turn_rank) AS total_turns,
    CASE WHEN bool_or({unhelpful('response')}) THEN 'N' ELSE 'Y' END AS is_in_scope,
    arg_min(chat_date, turn_rank) FILTER (WHERE chat_date IS NOT NULL) AS chat_date
  FROM turns GROUP BY chat_id)"""

HITS = f"""
hits AS (
  SELECT DISTINCT chat_id, turn_id, token FROM (SELECT chat_id, turn_id, unnest({TOKENS}) AS token FROM turns)
  WHERE token IN ({any_of(fx.ACRONYMS)})),
chat_hits AS (
  SELECT chat_id, count(DISTINCT token)::INT AS acronym_count,
    string_agg(DISTINCT token, ', ' ORDER BY token) AS acronyms_found FROM hits GROUP BY chat_id)"""

SAFE = f"""
safe AS (
  SELECT chat_id, turn_id, turn_rank, {sanitize("coalesce(question, '')")} AS safe_question,
    {sanitize('response')} AS safe_response, {unhelpful('response')} AS is_unhelpful FROM turns)"""


def word_count(x: str, words: list[str]) -> str:
    split = f"regexp_split_to_array(lower({x}), '[^\\p{{L}}]+')"
    return f"len(list_filter({split}, lambda w: w IN ({any_of(words)})))"


ASKED = strip("safe_question")
SENTIMENT = f"""
signals AS (
  SELECT chat_id,
    sum({word_count('safe_question', rules.POSITIVE_WORDS)} - {word_count('safe_question', rules.NEGATIVE_WORDS)})::BIGINT AS word_polarity,
    count(*) FILTER (WHERE is_unhelpful) AS unhelpful_turns,
    count(*) - count(DISTINCT lower({ASKED})) AS repeated_questions,
    count(*) FILTER (WHERE length({ASKED}) < 15) AS terse_turns
  FROM safe GROUP BY chat_id),
sentiments AS (
  SELECT *, CASE sign(word_polarity - unhelpful_turns - repeated_questions - terse_turns)
    WHEN 1 THEN 'Positive' WHEN -1 THEN 'Negative' ELSE 'Neutral' END AS chat_sentiment FROM signals)"""

BARE = f"regexp_replace(coalesce(safe_response, ''), {lit(r'\[[A-Z_]+\]')}, ' ', 'g')"
KEYWORDS = f"""
terms AS (
  SELECT chat_id, turn_rank, term FROM (
    SELECT chat_id, turn_rank, unnest(regexp_split_to_array(lower({BARE}), '[^\\p{{L}}]+')) AS term FROM safe)
  WHERE length(term) >= 4 AND term NOT IN ({any_of(rules.STOP_WORDS)})),
tf AS (SELECT chat_id, term, count(*) AS tf FROM terms GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
scored AS (
  SELECT chat_id, term, round(tf * ln((SELECT count(DISTINCT chat_id) FROM safe) / df), 6) AS score
  FROM tf JOIN df USING (term)),
scores AS (
  SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY score DESC, term) AS position FROM scored
  QUALIFY position <= 8),
keywords AS (SELECT chat_id, left(string_agg(term, ', ' ORDER BY position), 500) AS keywords FROM scores GROUP BY chat_id)"""


def sentence(x: str) -> str:
    regex = r"^\s*([^.!?\n]*[.!?]?)"
    return f"trim(regexp_extract(coalesce({x}, ''), {lit(regex)}, 1))"


EXTRACTS = f"""
answered AS (SELECT * FROM safe WHERE safe_response IS NOT NULL),
ends AS (
  SELECT chat_id, min(turn_rank) AS first_place, max(turn_rank) AS last_place,
    {sentence('arg_min(safe_response, turn_rank)')} AS first_answer,
    {sentence('arg_max(safe_response, turn_rank)')} AS last_answer FROM answered GROUP BY chat_id),
asked AS (SELECT chat_id, {sentence('arg_min(safe_question, turn_rank)')} AS first_question FROM safe GROUP BY chat_id),
named AS (
  SELECT chat_id, turn_rank, count(DISTINCT term) AS n FROM terms JOIN scores USING (chat_id, term)
  GROUP BY chat_id, turn_rank),
middle AS (
  SELECT n.chat_id, {sentence('arg_min(a.safe_response, (-n, n.turn_rank))')} AS middle_answer
  FROM named n JOIN ends e USING (chat_id) JOIN answered a USING (chat_id, turn_rank)
  WHERE n.turn_rank > first_place AND n.turn_rank < last_place GROUP BY n.chat_id),
parts AS (
  SELECT chat_id, CASE WHEN first_question <> '' THEN 'The user asked: ' || first_question END AS a,
    CASE WHEN first_answer <> '' THEN 'The bot answered: ' || first_answer END AS b,
    CASE WHEN middle_answer <> '' THEN 'Later: ' || middle_answer END AS c,
    CASE WHEN last_place > first_place AND last_answer <> '' THEN 'At the end: ' || last_answer END AS d
  FROM asked LEFT JOIN ends USING (chat_id) LEFT JOIN middle USING (chat_id)),
extracts AS (
  SELECT chat_id, left(array_to_string(list_slice(string_split(concat_ws(' ', a, b, c, d), ' '), 1, 150), ' '), 1000) AS summary
  FROM parts)"""


def prompt_texts(order: str = "specific_first") -> str:
    return f"""
chat_texts AS (SELECT chat_id, {CHAT_TEXT} AS chat_text FROM turns GROUP BY chat_id),
prompt_texts AS (
  SELECT chat_id, left({sanitize('chat_text', order)}, {rules.PROMPT_CHARS}) AS safe_text FROM chat_texts)"""


def first_line(x: str) -> str:
    return strip(f"split_part({strip(x)}, {NL}, 1)")


def mood(raw: str) -> str:
    signals = " OR ".join(f"contains({raw}, {lit(s)})" for s in rules.NEGATIVE_SIGNALS)
    return (
        f"CASE WHEN contains({raw}, 'positive') AND NOT contains({raw}, 'not positive') THEN 'Positive' "
        f"WHEN {signals} THEN 'Negative' ELSE 'Neutral' END"
    )


def sentiment_field(x: str) -> str:
    return mood(f"lower(rtrim({first_line(f'split_part({x}, {lit(chr(83) + "ENTIMENT:")}, 2)')}, '.'))")


def summary_field(x: str) -> str:
    return strip(f"replace(split_part({x}, 'SENTIMENT:', 1), 'SUMMARY:', '')")


PARSED = f"""
stripped AS (SELECT chat_id, turn_id, {strip("coalesce(text, '')")} AS t FROM responses),
marked AS (
  SELECT *, split_part(t, 'KEYWORDS:', 1) AS head,
    contains(t, 'SUMMARY:') AND contains(t, 'SENTIMENT:') AS labelled FROM stripped)"""

DIGEST_ANSWER = """
    CASE WHEN h[1] IN ('0', '1') THEN 'FILTERED' WHEN h[1] = '2' THEN 'ERROR' WHEN h[1] = '3' THEN 'FILTERED' ELSE 'OK' END"""
DIGEST_MOOD = "CASE WHEN h[2] < '6' THEN 'Positive' WHEN h[2] < 'c' THEN 'Negative' ELSE 'Neutral' END"
MODEL = f"""{prompt_texts()},
calls AS (
  SELECT chat_id, md5({lit(rules.PROMPT_TEMPLATE)} || safe_text) AS h,
    md5({lit(rules.FALLBACK_TEMPLATE)} || {simplify('safe_text')}) AS h2 FROM prompt_texts),
second AS (
  SELECT chat_id, CASE WHEN h[1] IN ('0', '1', '2', '3', '4') THEN 'CONTENT_FILTERED' ELSE 'chat ' || h END AS summary,
    CASE WHEN h[1] IN ('0', '1', '2', '3', '4') THEN 'Neutral' ELSE {DIGEST_MOOD} END AS chat_sentiment,
    '' AS keywords,
    CASE WHEN h[1] IN ('0', '1', '2', '3', '4') THEN 'CONTENT_FILTERED' ELSE 'OK' END AS status
  FROM (SELECT chat_id, h2 AS h FROM calls)),
first AS (
  SELECT chat_id, CASE h[1] WHEN '2' THEN 'ERROR: backend down ' || h WHEN '4' THEN 'ERROR: no text in the answer'
      ELSE 'chat ' || h END AS summary,
    CASE WHEN h[1] IN ('2', '4') THEN 'ERROR' ELSE {DIGEST_MOOD} END AS chat_sentiment,
    CASE WHEN h[1] IN ('2', '4') THEN '' ELSE 'one, ' || left(h, 4) END AS keywords,
    CASE WHEN h[1] IN ('2', '4') THEN 'ERROR' ELSE 'OK' END AS status
  FROM calls WHERE h[1] NOT IN ('0', '1', '3')),
answers AS (
  SELECT * FROM first UNION ALL
  SELECT * FROM second WHERE chat_id IN (SELECT chat_id FROM calls WHERE h[1] IN ('0', '1', '3')))"""

BY_MODEL = """
SELECT chat_id, chat_date, summary, chat_sentiment, keywords, is_in_scope,
  coalesce(acronym_count, 0) AS acronym_count, coalesce(acronyms_found, '') AS acronyms_found,
  user_language, total_turns, '2026-02-01T00:00:00+00:00' AS summarized_at
FROM facts JOIN answers USING (chat_id) LEFT JOIN chat_hits USING (chat_id) LEFT JOIN chat_languages USING (chat_id)"""

OFFLINE = """
SELECT chat_id, chat_date, summary, chat_sentiment, coalesce(keywords, '') AS keywords, is_in_scope,
  coalesce(acronym_count, 0) AS acronym_count, coalesce(acronyms_found, '') AS acronyms_found,
  user_language, total_turns
FROM facts LEFT JOIN chat_hits USING (chat_id) LEFT JOIN chat_languages USING (chat_id)
LEFT JOIN extracts USING (chat_id) LEFT JOIN sentiments USING (chat_id)
LEFT JOIN keywords USING (chat_id)"""

#: Runs of a third of the chats each, in the order of their ids; the first also notes those that are too short.
LIMITED = """, long_enough AS (
  SELECT chat_id, row_number() OVER (ORDER BY chat_id) AS nth, count(*) OVER () AS n FROM facts WHERE total_turns >= 2
), taken AS (
  SELECT chat_id, CASE status WHEN 'OK' THEN 'DONE' WHEN 'ERROR' THEN 'FAILED' ELSE 'FILTERED' END AS outcome,
    (status <> 'OK')::BIGINT AS tries, 'run-0000000' || (1 + (nth - 1) // ((n + 2) // 3)) AS run
  FROM long_enough JOIN answers USING (chat_id)
  UNION ALL SELECT chat_id, 'SKIPPED', 0, 'run-00000001' FROM facts WHERE total_turns < 2
)
"""

STATUS = (
    "CASE WHEN starts_with(summary, 'ERROR') THEN 'ERROR' "
    "WHEN summary IN ('CONTENT_FILTERED', 'NO_CONTENT') THEN summary ELSE 'OK' END"
)


def list_size(c: str) -> str:
    return f"CASE WHEN coalesce({c}, '') = '' THEN 0 ELSE len(string_split({c}, ', ')) END"


def dq_rules() -> dict[str, str]:
    long = " OR ".join(f"strlen(coalesce({c}, '')) > {n}" for c, n in quality.VARCHAR_LIMITS.items())
    return {
        "null_key": "chat_id IS NULL OR chat_date IS NULL",
        "sentiment_domain": f"coalesce(chat_sentiment, '') NOT IN ({any_of(quality.SENTIMENTS)})",
        "scope_domain": "coalesce(is_in_scope, '') NOT IN ('Y', 'N')",
        "language_domain": f"coalesce(user_language, '') NOT IN ({any_of(rules.LANGUAGES)})",
        "acronym_count": f"acronym_count IS DISTINCT FROM ({list_size('acronyms_found')})",
        "total_turns": "coalesce(total_turns, 0) < 1",
        "varchar_limit": long,
        "summary_length": "length(coalesce(summary, '')) > 1000",
        "keywords_length": "length(coalesce(keywords, '')) > 500",
        "keywords_3_to_8": f"({list_size('keywords')}) NOT BETWEEN 3 AND 8",
    }


def loop_run(k: int, max_tries: int) -> str:
    """Run k of the quality loop over table t{k}: what breaks which rule, whose chats are done over, and the table after it."""
    rules_of_row = dq_rules() | {"failed": f"({STATUS}) IN ('ERROR', 'CONTENT_FILTERED')"}
    names = ", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in rules_of_row.items())
    limits = ", ".join(f"('{n}', {float(fx.ALLOWED.get(n, 0.0))}::DOUBLE)" for n in [*rules_of_row, "unique_key"])
    tries = " + ".join([f"(chat_id IN (SELECT chat_id FROM chosen{i} WHERE retried))::INT" for i in range(1, k)] or ["0"])
    return f""",
broken{k} AS (
  SELECT chat_id, rule, count(*) AS n FROM (SELECT chat_id, unnest([{names}]) AS rule FROM t{k}) WHERE rule IS NOT NULL GROUP BY ALL
  UNION ALL SELECT chat_id, 'unique_key', count(*) FROM t{k} GROUP BY chat_id, chat_date HAVING count(*) > 1),
checks{k} AS (
  SELECT 'check-0000000{k}' AS run, rule, rows_checked, rows_failing, allowed, rows_failing <= allowed * rows_checked AS passed FROM (
    SELECT rule, allowed, (SELECT count(*) FROM t{k}) AS rows_checked, coalesce(sum(n), 0)::BIGINT AS rows_failing
    FROM (VALUES {limits}) AS limits(rule, allowed) LEFT JOIN broken{k} USING (rule) GROUP BY ALL)),
chosen{k} AS (
  SELECT chat_id, {tries} < {max_tries} AS retried FROM (
    SELECT DISTINCT chat_id FROM broken{k} WHERE rule IN (SELECT rule FROM checks{k} WHERE NOT passed))),
t{k + 1} AS (
  SELECT * FROM t{k} WHERE chat_id NOT IN (SELECT chat_id FROM chosen{k} WHERE retried)
  UNION ALL SELECT * FROM redone WHERE chat_id IN (SELECT chat_id FROM chosen{k} WHERE retried))"""


def w(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def oracle_sql() -> dict[str, str]:
    turn = w(TURNS)
    docs = w(DOCS)
    sums = w(SUMMARIES)
    columns = (
        "chat_id, chat_date, summary, chat_sentiment, keywords, is_in_scope, acronym_count, "
        "acronyms_found, user_language, total_turns, summarized_at"
    )
    turn_columns = (
        "chat_id, turn_id, turn_rank, question, response, chat_date, question_raw, response_raw"
    )
    loop = w(SUMMARIES, FACTS, HITS, LANGUAGES, MODEL) + f""", redone AS ({BY_MODEL}),
        t1 AS (SELECT {columns} FROM summaries UNION ALL SELECT {columns} FROM summaries WHERE right(chat_id, 1) = '5')
        """ + "".join(loop_run(k, 2) for k in (1, 2, 3))
    found = {
        "scan_turns": turn + f"SELECT {turn_columns} FROM turns",
        "pair_messages": w(PAIRS) + "SELECT * FROM pairs",
        "explode_chat_json": turn + f"""
            SELECT * REPLACE (chat_id || '/' || turn_id AS chat_id) FROM (SELECT {turn_columns} FROM turns)
            UNION ALL
            SELECT * REPLACE (chat_id || '/' || turn_id AS chat_id, turn_id || '_again' AS turn_id,
              turn_rank + 100 AS turn_rank) FROM (SELECT {turn_columns} FROM turns)""",
        "run_date": """
            WITH paths AS (SELECT conv_id, turn, CASE conv_id % 3
                WHEN 0 THEN 'in/dt_202601' || lpad((conv_id % 40)::VARCHAR, 2, '0') || '/a.parquet'
                WHEN 1 THEN 'in/run-date_202602' || lpad((conv_id % 40)::VARCHAR, 2, '0') || '/b.parquet'
                ELSE 'in/undated/c.parquet' END AS path FROM conversations),
            days AS (SELECT *, coalesce(try_strptime(regexp_extract(path, '(?:dt_|run-date_)(\\d{8})', 1),
                '%Y%m%d')::DATE, DATE '2026-03-01')::VARCHAR AS run_date FROM paths)
            SELECT conv_id, turn, run_date, 'out/dt_' || run_date || '/' AS output_folder FROM days""",
        "incremental_ingest": w(TURNS, FACTS, HITS, LANGUAGES, MODEL) + BY_MODEL,
        "rejected_input": turn + """
            SELECT CASE (turn_rank + ascii(right(chat_id, 1))) % 6 WHEN 1 THEN 'no chat_id' WHEN 2 THEN 'no turns' WHEN 3 THEN 'unreadable' WHEN 4 THEN 'unreadable'
              ELSE 'accepted' END AS reason, count(*) AS rejected FROM turns GROUP BY ALL""",
        "run_pipeline": w(TURNS, FACTS, HITS, LANGUAGES, MODEL) + BY_MODEL + " WHERE total_turns >= 2",
        "limited_runs": w(TURNS, FACTS, MODEL) + LIMITED + "SELECT chat_id, outcome, tries, run FROM taken",
        "run_results": w(TURNS, FACTS, MODEL) + LIMITED + """
            SELECT run, count(*) FILTER (WHERE outcome <> 'SKIPPED') AS completed, count(*) FILTER (WHERE outcome = 'FAILED') AS errors,
              count(*) FILTER (WHERE outcome = 'FILTERED') AS filtered, count(*) FILTER (WHERE outcome = 'SKIPPED') AS skipped,
              0::BIGINT AS retried, true AS has_files_time_and_path
            FROM taken GROUP BY run""",
        "quality_loop": loop + " UNION ALL ".join(f"SELECT * FROM checks{k}" for k in (1, 2, 3)),
        "quality_runs": loop + " UNION ALL ".join(
            f"""SELECT 'check-0000000{k}' AS run, (SELECT count(*) FILTER (WHERE NOT passed) FROM checks{k}) AS rules_over,
              (SELECT sum(rows_failing)::BIGINT FROM checks{k}) AS rows_failing,
              count(*) FILTER (WHERE retried) AS chats_retried, count(*) FILTER (WHERE NOT retried) AS chats_given_up FROM chosen{k}"""
            for k in (1, 2, 3)
        ),
        "acronym_dim": """
            SELECT DISTINCT acronym_shrt FROM (
              SELECT unnest(regexp_split_to_array(text, '[^A-Za-z]+')) AS acronym_shrt FROM conversations)
            WHERE regexp_full_match(acronym_shrt, '[A-Z][a-z]?')""",
        "drop_null_chat": turn + "SELECT chat_id, turn_id, turn_rank FROM turns WHERE response IS NOT NULL",
        "first_file_wins": turn + """
            SELECT chat_id, turn_id, source_file FROM (
              SELECT *, 'part-' || ((turn_rank - 1) // 2) AS source_file FROM turns)
            QUALIFY source_file = min(source_file) OVER (PARTITION BY chat_id)""",
        "limit_chats": turn + """
            SELECT chat_id, turn_id FROM turns WHERE chat_id IN (
              SELECT DISTINCT chat_id FROM turns ORDER BY chat_id LIMIT 25)""",
        "prefilter_chats": turn + f"""
            SELECT chat_id, count(turn_rank) AS total_turns, md5({CHAT_TEXT}) AS digest FROM turns
            GROUP BY chat_id HAVING count(turn_rank) >= 2""",
        "empty_chat_result": turn + """
            SELECT turn_id AS chat_id, 'NO_CONTENT' AS summary, 'Neutral' AS chat_sentiment, '' AS keywords,
              'NO_CONTENT' AS status FROM turns WHERE response IS NULL""",
        "format_turn": turn + f"SELECT chat_id, turn_id, {TURN_TEXT} AS turn_text FROM turns",
        "normalize_quotes": turn + f"SELECT chat_id, turn_id, {normal('response')} AS normal FROM turns",
        "unhelpful_response": turn + f"SELECT chat_id, turn_id, {unhelpful('response')} AS is_unhelpful FROM turns",
        "turn_acronyms": w(TURNS, HITS) + """
            SELECT chat_id, turn_id, string_agg(token, ', ' ORDER BY token) AS acronyms FROM hits
            GROUP BY chat_id, turn_id""",
        "acronym_join": w(TURNS, HITS) + "SELECT chat_id, turn_id, token AS acronym FROM hits",
        "redact_profanity": docs + f"SELECT doc_id, {profanity('text')} AS safe_text FROM docs",
        "sanitize_text": docs + f"SELECT doc_id, {sanitize('text')} AS safe_text FROM docs",
        "sanitize_text_shipped": docs + f"SELECT doc_id, {sanitize('text', 'shipped')} AS safe_text FROM docs",
        "truncate_text": docs + "SELECT doc_id, left(text, 8000) AS safe_text FROM docs",
        "build_prompt": turn + f"""
            SELECT chat_id, turn_id, md5({lit(rules.PROMPT_TEMPLATE)} || {sanitize('question')}) AS prompt_md5
            FROM turns""",
        "simplify_text": docs + f"SELECT doc_id, {simplify(sanitize('text'))} AS safe_text FROM docs",
        "build_fallback_prompt": turn + f"""
            SELECT chat_id, turn_id,
              md5({lit(rules.FALLBACK_TEMPLATE)} || {simplify(sanitize('question'))}) AS prompt_md5
            FROM turns""",
        "lang_clean": docs + f"SELECT doc_id, {clean('scripted')} AS cleaned FROM docs",
        "lang_script": docs + f"SELECT doc_id, {script(clean('scripted'))} AS language FROM docs",
        "lang_hinglish": docs + f"SELECT doc_id, {hinglish(clean('scripted'))} AS language FROM docs",
        "lang_short_ascii": turn + f"""
            SELECT chat_id, turn_id, {short_ascii(clean('question'))} AS language FROM turns""",
        "lang_ngram": w(
            PROFILES,
            f"cleaned AS (SELECT doc_id, lang, {clean('text')} AS x FROM documents)",
            ngram("best", "cleaned", "doc_id", "x"),
        ) + "SELECT doc_id, lang, detected FROM cleaned LEFT JOIN best USING (doc_id)",
        "lang_open_set": w(*OPEN_SET) + """SELECT doc_id, lang, found.language AS detected FROM cleaned
            LEFT JOIN (SELECT doc_id, language FROM best JOIN limits USING (language, band)
              WHERE share >= least_share AND margin >= least_margin) AS found USING (doc_id)""",
        "turn_language": w(TURNS, LANGUAGES) + "SELECT *, 1 AS votes FROM turn_languages",
        "chat_language": w(TURNS, LANGUAGES) + "SELECT * FROM chat_languages",
        "chat_text": turn + f"SELECT chat_id, {CHAT_TEXT} AS chat_text FROM turns GROUP BY chat_id",
        "prompt_text": w(TURNS, prompt_texts()) + "SELECT * FROM prompt_texts",
        "prompt_text_shipped": w(TURNS, prompt_texts("shipped")) + "SELECT * FROM prompt_texts",
        "total_turns": w(TURNS, FACTS) + "SELECT chat_id, total_turns FROM facts",
        "chat_in_scope": w(TURNS, FACTS) + "SELECT chat_id, is_in_scope FROM facts",
        "chat_first_date": w(TURNS, FACTS) + "SELECT chat_id, chat_date FROM facts",
        "chat_acronyms": w(TURNS, HITS) + "SELECT * FROM chat_hits",
        "group_chats": w(TURNS, LANGUAGES, FACTS, HITS, prompt_texts()) + """
            SELECT facts.*, chat_text, user_language, coalesce(acronym_count, 0) AS acronym_count,
              coalesce(acronyms_found, '') AS acronyms_found
            FROM facts JOIN chat_texts USING (chat_id) LEFT JOIN chat_hits USING (chat_id)
            LEFT JOIN chat_languages USING (chat_id)""",
        "enrich_with_model": w(TURNS, MODEL) + "SELECT * FROM answers",
        "retry_filtered": w(TURNS, MODEL) + "SELECT * FROM second",
        "response_status": w(RESPONSES) + """
            SELECT chat_id, turn_id, CASE
              WHEN contains(lower(stop_reason), 'content_filtered') OR contains(lower(stop_reason), 'guardrail') THEN 'FILTERED'
              WHEN contains(lower(error), 'content') AND contains(lower(error), 'filter')
                AND NOT contains(error, 'ThrottlingException') THEN 'FILTERED'
              WHEN error IS NOT NULL THEN 'ERROR' WHEN text IS NULL THEN 'NO_CONTENT'
              WHEN contains(lower(text), 'content filters') THEN 'FILTERED' ELSE 'OK' END AS status
            FROM responses""",
        "parse_response": w(RESPONSES, PARSED) + f"""
            SELECT chat_id, turn_id,
              left(CASE WHEN labelled AND contains(head, 'SENTIMENT:') THEN {summary_field('head')} ELSE t END, 1000) AS summary,
              CASE WHEN labelled AND contains(head, 'SENTIMENT:') THEN {sentiment_field('head')} ELSE 'Neutral' END AS chat_sentiment,
              left(CASE WHEN labelled AND contains(t, 'KEYWORDS:')
                THEN {first_line("split_part(t, 'KEYWORDS:', 2)")} ELSE '' END, 500) AS keywords
            FROM marked""",
        "parse_simple_response": w(RESPONSES, PARSED) + f"""
            SELECT chat_id, turn_id,
              left(CASE WHEN contains(t, 'SENTIMENT:') THEN {summary_field('t')} ELSE t END, 1000) AS summary,
              CASE WHEN contains(t, 'SENTIMENT:') THEN {sentiment_field('t')} ELSE 'Neutral' END AS chat_sentiment,
              '' AS keywords
            FROM marked""",
        "classify_sentiment": w(RESPONSES) + f"""
            SELECT chat_id, turn_id, {mood("lower(concat_ws(' ', text, error))")} AS sentiment FROM responses""",
        "user_sentiment": w(TURNS, SAFE, SENTIMENT) + "SELECT * FROM sentiments",
        "chat_keywords": w(TURNS, SAFE, KEYWORDS) + "SELECT * FROM keywords",
        "chat_summary_extractive": w(TURNS, SAFE, KEYWORDS, EXTRACTS) + "SELECT * FROM extracts",
        "assemble_summary": w(SUMMARIES, FACTS, HITS) + """
            SELECT f.chat_id, f.chat_date, summary, chat_sentiment, keywords, f.is_in_scope,
              coalesce(h.acronym_count, 0) AS acronym_count, coalesce(h.acronyms_found, '') AS acronyms_found,
              'English' AS user_language, f.total_turns, '2026-02-01T00:00:00+00:00' AS summarized_at
            FROM facts f LEFT JOIN summaries s USING (chat_id) LEFT JOIN chat_hits h USING (chat_id)""",
        "chat_summary": w(TURNS, LANGUAGES, FACTS, HITS, SAFE, SENTIMENT, KEYWORDS, EXTRACTS) + OFFLINE,
        "incremental_keywords": w(TURNS, LANGUAGES, FACTS, HITS, SAFE, SENTIMENT, KEYWORDS, EXTRACTS) + OFFLINE,
        "unseen_chats": w(SUMMARIES, FACTS) + f"""
            SELECT * FROM facts WHERE chat_id NOT IN (SELECT chat_id FROM summaries WHERE {STATUS} = 'OK')""",
        "merge_delete_join": w(RERUN) + "SELECT chat_id, chat_date FROM kept",
        "write_summaries": sums + f"SELECT {columns} FROM summaries",
        "rotate_files": sums + "SELECT count(*) AS all_rows, true AS within_cap FROM summaries",
        "rotate_by_size": sums + f"""
            SELECT chat_date, count(*) AS all_rows, sum(20 + {" + ".join(f"strlen(coalesce({c}::VARCHAR, ''))" for c in columns.split(", "))})::BIGINT AS all_bytes,
              true AS within_limit, true AS "full" FROM summaries GROUP BY chat_date""",
        "merge_summaries": w(RERUN) + f"SELECT {columns} FROM kept UNION ALL SELECT {columns} FROM rerun",
        "summary_sample": sums + f"SELECT {columns} FROM summaries ORDER BY chat_id LIMIT 20",
        "summary_count": sums + "SELECT count(*) AS summary_count FROM summaries",
        "run_metrics": sums + """
            SELECT count(*) AS completed, count(*) FILTER (WHERE starts_with(summary, 'ERROR')) AS errors,
              true AS has_files FROM summaries""",
        "dq_report": sums + " UNION ALL ".join(
            f"SELECT {lit(name)} AS rule, count(*) AS rows_checked, "
            f"count(*) FILTER (WHERE {rule}) AS rows_failing FROM summaries"
            for name, rule in dq_rules().items()
        ) + """ UNION ALL SELECT 'unique_key', sum(n)::BIGINT, coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT
            FROM (SELECT count(*) AS n FROM summaries GROUP BY chat_id, chat_date)""",
        "dq_error_rate": sums + f"""
            SELECT chat_date, count(*) AS chats,
              round(avg(({STATUS} = 'ERROR')::INT), 6) AS error_rate,
              round(avg(({STATUS} = 'CONTENT_FILTERED')::INT), 6) AS content_filtered_rate,
              round(avg(({STATUS} = 'NO_CONTENT')::INT), 6) AS no_content_rate
            FROM summaries GROUP BY chat_date""",
        "dq_residual_pii": sums + " UNION ALL ".join(
            f"SELECT '{label}' AS label, count(*) FILTER (WHERE regexp_matches(summary, "
            f"{lit(regex.replace('(?=', '(?:'))}, '{'i' if ignore_case else 'c'}')) AS summaries_hit FROM summaries"
            for label, (regex, ignore_case) in rules.PII_PATTERNS.items()
        ),
        "reprocess_set": sums + f"""
            SELECT DISTINCT chat_id FROM turns
            WHERE chat_id NOT IN (SELECT chat_id FROM summaries WHERE {STATUS} = 'OK')""",
        "sentiment_by_language": sums + """
            SELECT chat_date, user_language, chat_sentiment, count(*) AS chats,
              grouping(chat_date, user_language, chat_sentiment)::INT AS grouping_level
            FROM summaries GROUP BY ROLLUP (chat_date, user_language, chat_sentiment)""",
        "resolution_rate": sums + """
            SELECT chat_date, user_language, count(*) AS chats,
              round(avg((is_in_scope = 'Y')::INT), 6) AS in_scope_rate
            FROM summaries GROUP BY chat_date, user_language""",
        "keyword_trend": sums + """,
            daily AS (SELECT chat_date, keyword, count(*) AS chats FROM (
                SELECT chat_date, unnest(string_split(keywords, ', ')) AS keyword FROM summaries)
              WHERE keyword <> '' GROUP BY ALL)
            SELECT d.chat_date, d.keyword, d.chats, d.chats - coalesce(p.chats, 0) AS change,
              row_number() OVER (PARTITION BY d.chat_date ORDER BY d.chats DESC, d.keyword) AS position
            FROM daily d LEFT JOIN daily p ON p.keyword = d.keyword
              AND p.chat_date::DATE = d.chat_date::DATE - 1
            QUALIFY position <= 10""",
        "acronym_frequency": sums + """
            SELECT acronym, count(*) AS chats, dense_rank() OVER (ORDER BY count(*) DESC)::INT AS place
            FROM (SELECT unnest(string_split(acronyms_found, ', ')) AS acronym FROM summaries)
            WHERE acronym <> '' GROUP BY acronym""",
        "turns_distribution": sums + """
            SELECT user_language, count(*) AS chats, min(total_turns) AS min_turns,
              quantile_cont(total_turns, 0.5) AS median_turns,
              round(quantile_cont(total_turns, 0.95), 6) AS p95_turns, max(total_turns) AS max_turns
            FROM summaries GROUP BY user_language""",
    }
    for label in rules.PII_PATTERNS:
        found[f"redact_{label.lower()}"] = (
            docs + f"SELECT doc_id, {redact('text', label)} AS safe_text FROM docs"
        )
    return found
