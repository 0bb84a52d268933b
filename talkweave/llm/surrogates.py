"""Personal data and secrets replaced by surrogates, with DataFrame functions only.

Detected values are replaced by keyed ones of the same type: same script, format and gender of title. The same value has
the same surrogate everywhere, in whatever format it is written; distinct values keep distinct surrogates, and no
surrogate is a value that occurs in the corpus: candidates that fail this check are drawn again. Only where a fixed format
has no free candidates left do its values get each other's places, by a keyed permutation.
Only documents that hold values are shuffled, by their list of values, of which equal lists are worked on once.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkweave.staging import materialise

# --- Fixed values: titles before names, and syllables of invented names by script. ---

MALE = ("Mr", "Herr", "Monsieur", "Señor", "Signor", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Signora", "госпожа")
SYLLABLES = {
    "latin": ("ba", "de", "fi", "go", "lu", "ka", "me", "ni", "po", "ru", "sa", "te", "vi", "zo", "la", "re"),
    "cyrillic": ("ба", "де", "фи", "го", "лу", "ка", "ме", "ни", "по", "ру", "са", "те", "ви", "зо", "ла", "ре"),
    "greek": ("βα", "δε", "φι", "γο", "λυ", "κα", "με", "νι", "πο", "ρυ", "σα", "τε", "βι", "ζο", "λα", "ρε"),
}
GIVEN_ENDING = {
    "latin": {"given_m": "n", "given_f": "na"},
    "cyrillic": {"given_m": "н", "given_f": "на"},
    "greek": {"given_m": "ς", "given_f": "να"},
}

_TITLE = "(?:" + "|".join(MALE + FEMALE) + r")\.?"
_NAME = r"\p{Lu}[\p{Ll}\p{M}]+(?:[-'’]\p{Lu}[\p{Ll}\p{M}]+)?"
_NO_DIGIT = r"(?<![\p{L}\p{N}])"
_SECRET = r"\p{L}\p{M}\p{N}+/_=~@#$%^&*-"  # what a secret may end in
_INSIDE = "[" + _SECRET[:-1] + ".!?:-]"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

_ASSIGN = r"[\"']?\s{0,2}[=:]\s{0,2}[\"']?"  # quotes around the key, as in JSON, and around the value
_LONG = _INSIDE + "{7}" + _INSIDE + "*[" + _SECRET + "]"
# Fewer than eight characters after a key word are a word of a sentence, unless they hold a digit or follow a quote.
_SHORT = "(?:(?=" + _INSIDE + "*[0-9])|(?<=[\"']))" + _INSIDE + "*[" + _SECRET + "]"

#: kind -> pattern of a whole value, tried in this order at each place of a text
PATTERNS = {
    "assigned": _NO_DIGIT + "(?:(?i:password|passwd|pwd|passphrase)" + _ASSIGN + "(?:" + _LONG + "|" + _SHORT + ")"
                "|(?i:secret|token|api[_-]?key)" + _ASSIGN + _LONG + ")",
    "key": _NO_DIGIT + r"A(?:KIA|SIA)[0-9A-Z]{16}(?![\p{L}\p{N}])",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "iban": _NO_DIGIT + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{N}.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![\p{N}]|\.[\p{N}])",
    "phone": r"(?<![\p{N}+])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?|[0-9]{1,4}[ .-])?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![\p{N}])"
             r"|(?<![\p{N}])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![\p{N}-])",
    "ssn": r"(?<![\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{N}-])",
    "card": r"(?<![\p{L}\p{N}])[0-9]{4}(?:([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[ -][0-9]{6}[ -][0-9]{5})(?![\p{L}\p{N}])",
    "name": r"(?<![\p{L}\p{N}])" + _TITLE + " " + _NAME + "(?: " + _NAME + ")?",
}
#: Texts without any of these hold no value.
MAY_HOLD = r"[0-9@]|[=:]\s{0,2}[\"']?" + _INSIDE + r"{8}|[=:]\s{0,2}[\"']|(?<!\p{L})" + _TITLE + r" \p{Lu}"
_ANY = "(?:" + "|".join(p.replace(r"\1", "{back}") for p in PATTERNS.values()) + ")"
# The separator inside card numbers is the only group that captures.
ANY = _ANY.replace("{back}", r"\1")

#: A value of a fixed format that has drawn so often in vain finds its format exhausted.
ATTEMPTS = 32
#: Attempts after which secrets grow.
SAME_LENGTH = 4

PART = "array<struct<kind:string,raw:string,norm:string>>"


def _kind(value: Column) -> Column:
    """Which pattern a found value is of."""
    out = F.lit("card")
    for kind in reversed(PATTERNS):
        if kind != "card":
            out = F.when(F.regexp_like(value, F.lit("^(?:" + PATTERNS[kind] + ")$")), kind).otherwise(out)
    return out


def _part(kind: Column | str | None, raw: Column, norm: Column | None = None) -> Column:
    kind = kind if isinstance(kind, Column) else F.lit(kind).cast("string")
    return F.struct(kind.alias("kind"), raw.alias("raw"), (norm if norm is not None else raw).alias("norm"))


def _parts(found: Column) -> Column:
    """A value with its kind, as parts that are kept (kind null) or replaced, which together spell it."""
    kind, value = found["kind"], found["value"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    prefix = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[^0-9])", 0)
    rest = F.substr(value, F.length(prefix) + 1)
    lead = F.regexp_extract(value, "^[\\w-]+" + _ASSIGN, 0)
    title = F.regexp_extract(value, r"^[\p{L}.]+ ", 0)
    names = F.split(F.substr(value, F.length(title) + 1), " ")
    male = F.regexp_like(title, F.lit("^(?:" + "|".join(MALE) + r")\.? $"))
    given, family = F.element_at(names, 1), F.element_at(names, -1)
    squeezed = F.regexp_replace(value, " ", "")
    return (
        F.when(kind == "name", F.when(
            F.size(names) == 2,
            F.array(_part(None, title), _part(F.when(male, "given_m").otherwise("given_f"), given), _part(None, F.lit(" ")), _part("family", family)),
        ).otherwise(F.array(_part(None, title), _part("family", family))))
        .when(kind == "assigned", F.array(_part(None, lead), _part("secret", F.substr(value, F.length(lead) + 1))))
        .when(kind == "key", F.array(_part(None, F.substring(value, 1, 4)), _part("key", F.substr(value, F.lit(5)))))
        .when(kind == "phone", F.array(_part(None, prefix), _part("phone", rest, F.regexp_replace(rest, "[^0-9]", ""))))
        .when(kind == "email", F.array(_part("email", value, F.lower(value))))
        .when(kind == "iban", F.array(_part(None, F.substring(value, 1, 2)), _part("iban", F.substr(value, F.lit(3)), F.substr(squeezed, F.lit(3)))))
        .when(kind == "ip", F.array(_part("ip", value)))
        .otherwise(F.array(_part(kind, value, digits)))
    ).cast(PART)


def found(text: Column) -> Column:
    """All values of a text in order, each as its parts."""
    values = F.regexp_extract_all(text, F.lit("(" + ANY.replace(r"\1", r"\2") + ")"), F.lit(1))
    none = F.lit(None).cast("array<string>")
    held = F.coalesce(F.when(F.regexp_like(text, F.lit(MAY_HOLD)), values).otherwise(none), F.array().cast("array<string>"))
    return F.transform(F.transform(held, lambda v: F.struct(_kind(v).alias("kind"), v.alias("value"))), _parts)


def _draw(seed: Column, at: Column | int, below: int) -> Column:
    """A keyed number from 0 to below - 1 for a place of a value."""
    at = at if isinstance(at, Column) else F.lit(at)
    return F.conv(F.substring(F.sha2(F.concat(seed, F.lit("|"), at.cast("string")), 256), 1, 12), 16, 10).cast("long") % below


def _pick(letters: str, seed: Column, at: Column) -> Column:
    return F.substr(F.lit(letters), (_draw(seed, at, len(letters)) + 1).cast("int"), F.lit(1))


_LETTERS = {
    "a-f": "abcdef", "a-z": "abcdefghijklmnopqrstuvwxyz", "A-Z": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "а-яё": "абвгдежзиклмнопрстуфхцчшэюя", "А-ЯЁ": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ",
    "α-ω": "αβγδεζηθικλμνξοπρστυφχψω", "Α-Ω": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
}


def _same_format(norm: Column, seed: Column) -> Column:
    """Digits for digits and letters for letters of the same script and case, place by place; the rest stays."""

    def place(c: Column, i: Column, seed: Column, hexadecimal: Column) -> Column:
        out = F.when(F.regexp_like(c, F.lit("[0-9]")), F.when(i == 1, _pick("23456789", seed, i)).otherwise(_pick("0123456789", seed, i)))
        out = out.when(hexadecimal, _pick("abcdef", seed, i))
        for kind, letters in _LETTERS.items():
            if kind != "a-f":
                out = out.when(F.regexp_like(c, F.lit(f"[{kind}]")), _pick(letters, seed, i))
        return out.otherwise(F.when(F.regexp_like(c, F.lit(r"\p{L}")), _pick(_LETTERS["a-z"], seed, i)).otherwise(c))

    def places(of: Column) -> Column:
        return F.array_join(F.transform(F.split(norm, ""), lambda c, i: place(c, i + 1, of["seed"], of["hexadecimal"])), "")

    # One element, so that what depends on the whole value is worked out once and not at each place.
    once = F.array(F.struct(seed.alias("seed"), F.regexp_like(norm, F.lit("^[0-9a-f]+$")).alias("hexadecimal")))
    return F.element_at(F.transform(once, places), 1)


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string."""
    def value(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        double = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 0, double).otherwise(d)
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, b: a + b)


def _card(norm: Column, seed: Column) -> Column:
    """Same issuer digit; a valid check digit if the value's own is valid."""
    body = F.concat(F.substring(norm, 1, 1), F.substr(_same_format(norm, seed), F.lit(2)))
    body = F.substr(body, F.lit(1), F.length(norm) - 1)
    check = ((10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    return F.when(_luhn_sum(norm) % 10 == 0, F.concat(body, check)).otherwise(F.concat(body, _pick("0123456789", seed, F.length(norm))))


def _name(kind: Column, norm: Column, seed: Column, attempt: int) -> Column:
    """Five syllables in the name's script, one more on each later attempt, with an ending of its gender."""
    script = (F.when(F.regexp_like(norm, F.lit(r"\p{IsCyrillic}")), "cyrillic")
              .when(F.regexp_like(norm, F.lit(r"\p{IsGreek}")), "greek").otherwise("latin"))
    out = F.lit(None).cast("string")
    for name, syllables in SYLLABLES.items():
        listed = F.array(*map(F.lit, syllables))
        body = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(5 + attempt)), lambda i: F.element_at(listed, (_draw(seed, i, 16) + 1).cast("int"))), "")  # noqa: B023
        ending = GIVEN_ENDING[name]
        full = F.concat(body, F.when(kind == "given_m", ending["given_m"]).when(kind == "given_f", ending["given_f"]).otherwise(""))
        out = F.when(script == name, F.initcap(full)).otherwise(out)
    return out


def candidate(kind: Column, norm: Column, key: str, attempt: int) -> Column:
    """The surrogate that a value draws at an attempt."""
    told = F.when(F.length(norm) > 200, F.sha2(norm, 256)).otherwise(norm)
    seed = F.concat_ws("|", F.lit(key), kind, told, F.lit(str(attempt)))
    octets = [(_draw(seed, i, 254) + 1).cast("string") for i in range(1, 5)]
    local = F.regexp_extract(norm, "^[^@]*", 0)
    top = F.regexp_extract(norm, r"[^.]*$", 0)
    email = F.concat(_same_format(local, seed), F.lit("@"), _pick(_LETTERS["a-z"], seed, F.lit(900)),
                     _draw(seed, 901, 1000).cast("string"), *[_draw(seed, 902 + i, 1000).cast("string") for i in range(attempt)],
                     F.lit(".example."), top)
    longer = [_pick(_LETTERS["a-z"], seed, F.lit(f"more {i}")) for i in range(attempt - SAME_LENGTH)]
    return (
        F.when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "email", email)
        .when(kind == "card", _card(norm, seed))
        .when(kind.isin("given_m", "given_f", "family"), _name(kind, norm, seed, attempt))
        .when(kind == "secret", F.concat(_same_format(norm, seed), *longer))
        .otherwise(_same_format(norm, seed))
    )


#: Kinds whose candidates grow with the attempts.
GROWING = ("given_m", "given_f", "family", "email", "secret")


def surrogate_table(values: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) for the distinct (kind, norm) of ``values``: distinct per kind and none of them a value.

    Attempts go on until every value has its own. A value keeps a candidate if no value equals it, no earlier
    attempt took it, and it is the smallest value that drew it. Names, addresses and secrets have more candidates at later
    attempts; the values of a fixed format that is exhausted after ATTEMPTS are permuted (``_permuted``).
    """
    known = materialise(values.select("kind", "norm").distinct(), "values")
    done, pending, attempt = None, known, 0
    while True:
        drawn = materialise(pending.select("kind", "norm", candidate(F.col("kind"), F.col("norm"), key, attempt).alias("surrogate")), "drawn")
        taken = known.select("kind", F.col("norm").alias("surrogate"))
        if done is not None:
            taken = taken.union(done.select("kind", "surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm")).join(taken, ["kind", "surrogate"], "left_anti")
        won = materialise(first.select("kind", "norm", "surrogate"), "surrogates")
        done = won if done is None else done.union(won)
        pending = materialise(drawn.select("kind", "norm").join(won, ["kind", "norm"], "left_anti"), "pending")
        if pending.isEmpty():
            return done
        attempt += 1
        if attempt % ATTEMPTS == 0 and not (stuck := pending.where(~F.col("kind").isin(*GROWING))).isEmpty():
            instead = _permuted(known, stuck, key)
            done = materialise(done.join(instead, ["kind", "norm"], "left_anti").union(instead), "surrogates")
            pending = materialise(pending.join(instead, ["kind", "norm"], "left_anti"), "pending")
            if pending.isEmpty():
                return done


def _format(kind: Column, norm: Column) -> Column:
    """What all candidates of a value share."""
    shape = F.regexp_replace(F.regexp_replace(norm, "[0-9]", "9"), "[A-Z]", "A")
    card = F.concat_ws("|", shape, F.substring(norm, 1, 1), (_luhn_sum(norm) % 10 == 0).cast("string"))
    return F.when(kind == "ip", F.lit("ip")).when(kind == "card", card).otherwise(shape)


def _permuted(known: DataFrame, stuck: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) for all values in the formats of ``stuck``: each gets the next one of its format in a keyed order.

    Still distinct, and none its own; as no other surrogate is a value, distinct from all others too.
    """
    shape = _format(F.col("kind"), F.col("norm")).alias("format")
    formats = stuck.select("kind", shape).distinct()
    of_format = Window.partitionBy("kind", "format").orderBy(F.sha2(F.concat_ws("|", F.lit(key), "kind", "norm"), 256))
    every = of_format.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("norm").over(of_format), F.first("norm").over(every)).alias("surrogate")
    return materialise(known.select("kind", "norm", shape).join(formats, ["kind", "format"]).select("kind", "norm", after), "permuted")


def _render(raw: Column, surrogate: Column) -> Column:
    """A surrogate in the format of one occurrence: its digits poured into the value's places, its capitals kept."""
    shaped = F.array_join(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(raw), F.lit(1))),
        lambda i: F.when(
            F.regexp_like(F.substr(raw, i, F.lit(1)), F.lit("[0-9A-Z]")),
            F.substr(surrogate, F.length(F.regexp_replace(F.substr(raw, F.lit(1), i), "[^0-9A-Z]", "")), F.lit(1)),
        ).otherwise(F.substr(raw, i, F.lit(1))),
    ), "")
    return F.when(F.col("kind").isin("phone", "card", "ssn", "iban"), shaped).when(
        (F.upper(raw) == raw) & (F.lower(raw) != raw) & (F.col("kind") == "email"), F.upper(surrogate)
    ).otherwise(surrogate)


def replace_values(docs: DataFrame, key: str = "talkweave", text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` with the values of ``text_col`` replaced, and ``n_values``.

    Null texts stay null and have no values; texts without values are unchanged; repeated rows stay;
    an empty table gives an empty result. A column named n_values is replaced.
    """
    rows = _replaced(docs, key, text_col)
    names = [c for c in docs.columns if c.lower() != "n_values"]
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "n_values")


def without_values(docs: DataFrame, key: str = "talkweave", text_col: str = "text") -> DataFrame:
    """``docs`` with the values of ``text_col`` replaced: its columns and no others, whatever their names."""
    rows = _replaced(docs, key, text_col)
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _replaced(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """``row``, the columns of ``docs`` with replaced values, and n_values."""
    row = F.struct(*[docs[c] for c in docs.columns])
    text = F.col(f"row.`{text_col}`")
    rows = docs.select(row.alias("row")).withColumn("values", found(text))
    holding = F.size("values") > 0
    list_key = F.sha2(F.to_json("values"), 256)
    lists = rows.where(holding).select(list_key.alias("list"), "values").groupBy("list").agg(F.first("values").alias("values"))
    lists = materialise(lists, "lists")
    parts = lists.select("list", F.posexplode("values").alias("at", "parts")).select("list", "at", F.posexplode("parts").alias("part_at", "part"))
    parts = parts.select("list", "at", "part_at", "part.*")
    table = surrogate_table(parts.where("kind IS NOT NULL"), key)
    kept = parts.where("kind IS NULL").select("list", "at", "part_at", F.col("raw").alias("new"))
    drawn = parts.where("kind IS NOT NULL").join(table, ["kind", "norm"]).select(
        "list", "at", "part_at", _render(F.col("raw"), F.col("surrogate")).alias("new")
    )
    gathered = kept.union(drawn).groupBy("list", "at").agg(F.array_sort(F.collect_list(F.struct("part_at", "new"))).alias("new"))
    spelled = gathered.select("list", "at", F.array_join(F.transform("new", lambda p: p.new), "").alias("new"))
    replacements = spelled.groupBy("list").agg(F.array_sort(F.collect_list(F.struct("at", "new"))).alias("new"))
    between = F.split(text, ANY, -1)
    merged = F.concat(
        F.array_join(F.transform(F.sequence(F.lit(1), F.size("new")), lambda i: F.concat(F.get(F.col("between"), i - 1), F.get(F.col("new"), i - 1)["new"])), ""),
        F.element_at("between", -1),
    )
    changed = (
        rows.where(holding).withColumn("list", list_key).join(replacements, "list")
        .withColumn("between", between).withColumn("changed", merged)
    )
    return (
        changed.select(F.col("row").withField(f"`{text_col}`", F.col("changed")).alias("row"), F.size("values").cast("long").alias("n_values"))
        .union(rows.where(~holding).select("row", F.lit(0).cast("long").alias("n_values")))
    )
