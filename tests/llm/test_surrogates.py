import re

from pyspark.sql import functions as F

from talkweave.llm import queries, surrogates


def replaced(spark, *texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.text for r in sorted(surrogates.replace_values(frame).collect(), key=lambda r: r.doc_id)]


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_query_leaves_no_value(spark, sf, documents):
    rows = {r.doc_id: r for r in queries.op9_surrogates(spark, sf).collect()}
    kinds = {
        "email": r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", "ip": r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "long": r"\d{9,}",
        "phone": r"\+1 \(\d+\) \d+-\d+", "hex": r"\b[0-9a-f]{18,}\b", "key": r"AKIA\w{16}",
    }
    shape, table = lambda s: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "9", s))), {}
    for d in documents:
        new = rows[d["doc_id"]]
        if new.n_values == 0:
            assert new.text == d["text"]
        for kind, pattern in kinds.items():
            before, after = re.findall(pattern, d["text"]), re.findall(pattern, new.text)
            assert not any(b in new.text for b in before)
            if kind in ("phone", "key"):
                assert [shape(x) for x in before] == [shape(x) for x in after]
            if kind in ("email", "ip", "phone", "key"):
                assert len(before) == len(after)
                for b, a in zip(before, after):
                    assert table.setdefault((kind, b), a) == a
    made = [(k[0], v) for k, v in table.items()]
    assert len(made) == len(set(made)) and made


def test_formats_and_coreference(spark):
    a, b, c, d = replaced(
        spark, "+1 (203) 555-8282, +1 203 555 8282 and +1.203.555.8282", "4111 1111 1111 1111, 4111-1111-1111-1111; 4111111111111112",
        "Bob.Smith@mail.example.com BOB.SMITH@MAIL.EXAMPLE.COM bob@x.org", "Mr John Smith met Mrs. Anna Smith, Mr Smith, Frau Müller and госпожа Иванова",
    )
    digits = [re.sub(r"\D", "", x) for x in re.findall(r"\+1[ .(\d)-]+\d", a)]
    assert len(set(digits)) == 1 and digits[0] != "12035558282" and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}, \+1 \d{3} \d{3} \d{4} and \+1\.\d{3}\.\d{3}\.\d{4}", a)
    cards = re.split("[,;] ", b)
    assert cards[0].replace(" ", "") == cards[1].replace("-", "") and luhn(cards[0].replace(" ", "")) and not luhn(cards[2])
    assert cards[0][0] == "4" and cards[2] != cards[0].replace(" ", "")
    mails = c.split()
    assert mails[0].upper() == mails[1] and mails[2] != mails[0] and mails[2].endswith(".org") and mails[0].endswith(".com")
    names = re.fullmatch(r"Mr (\w+n) (\w+) met Mrs\. (\w+a) (\w+), Mr (\w+), Frau (\w+) and госпожа ([А-я]+)", d)
    assert names and names[2] == names[4] == names[5] != "Smith" and names[6] != "Müller" and names[7] != "Иванова"


def test_collisions_are_drawn_again(spark, monkeypatch):
    values = [f"{i:03d}-{i % 90 + 10}-{i * 7 % 9000 + 1000}" for i in range(400)]
    real = surrogates.candidate

    def narrow(kind, norm, key, attempt):
        """All values draw one of few candidates first, some of them values of the corpus."""
        few = F.concat(F.lit("00100000"), F.pmod(F.xxhash64(norm), F.lit(10)).cast("string")) if attempt == 0 else real(kind, norm, key, attempt)
        return F.when(F.lit(attempt == 1), F.lit(values[3].replace("-", ""))).otherwise(few)

    monkeypatch.setattr(surrogates, "candidate", narrow)
    new = replaced(spark, *[f"id {v}." for v in values], f"again {values[5]}")
    assert len(set(new[:400])) == 400 and not set(x[3:-1] for x in new[:400]) & set(values)
    assert new[400].split()[1] == new[5][3:-1]


def test_another_key_gives_other_surrogates(spark):
    frame = spark.createDataFrame([(1, "a@b.org 10.0.0.1")], "doc_id int, text string")
    first, again, other = (surrogates.replace_values(frame, k).first().text for k in ("k", "k", "l"))
    assert first == again != other


def test_no_python_in_the_plan(spark, messy):
    plan = surrogates.replace_values(messy)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_messy(spark, messy, nothing):
    assert surrogates.replace_values(nothing).collect() == [] and surrogates.without_values(nothing).columns == nothing.columns
    odd = messy.limit(1).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit("@ = : token=\n\\1 $1 a@b.cc 1.2.3.4 1.2.3.4.5").alias("text"), *messy.columns[2:]
    )
    both = messy.union(odd).union(odd)
    rows = surrogates.replace_values(both)
    assert rows.columns == [c for c in messy.columns if c != "n_values"] + ["n_values"]
    got = rows.collect()
    assert len(got) == both.count() and sum(r.n_values for r in got) == 4
    clean = sorted((str(r.doc_id), str(r.text)) for r in got if r.n_values == 0)
    assert clean == sorted((str(r.doc_id), str(r.text)) for r in messy.collect())
    assert [r.text.endswith(" 1.2.3.4.5") and r.text.startswith("@ = : token=\n\\1 $1 ") for r in got if r.n_values] == [True, True]
    kept = surrogates.without_values(both)
    assert kept.columns == messy.columns and {r.n_values for r in kept.collect()} == {"c"}


def test_values_are_taken_to_their_end(spark):
    long, local = "Ab3" * 100, "very.long." * 7 + "name"
    labels = ".".join(f"part{i}" for i in range(12)) + ".org"
    secrets = [
        long, "xY9_" * 5_000, "eyJhbGciOi.eyJzdWIiOi.SflKxwRJ", "dGVzdHRlc3Q=.abc-def==", "bob.smith@mail.example.com", "hunter2hunter2!x#y",
    ]
    leads = ["password=", "token: ", "Password: ", 'TOKEN="', "API_KEY=", "api-key: ", "ApiKey = '"]
    texts = [f"my {lead}{s}. Then" for s in secrets for lead in leads]
    for old, new in zip(texts, replaced(spark, *texts)):
        lead = next(x for x in leads if old.startswith(f"my {x}"))
        secret = old[len(f"my {lead}"):-len(". Then")]
        value = new[len(f"my {lead}"):-len(". Then")]
        assert new.startswith(f"my {lead}") and new.endswith(". Then") and len(value) == len(secret)
        for a, b in zip(re.split(r"[\W_]", secret), re.split(r"[\W_]", value)):
            assert not a or len(a) < 4 or a != b
        assert secret[-8:] not in new and secret[:8] not in new
    mails = [f"{local}@mail.org", f"bob@{labels}", f"{'x' * 500}@{'y' * 100}.{'z' * 80}.com", "a@b." + "c." * 3_000 + "net"]
    for old, new in zip(mails, replaced(spark, *[f"to {m}, now" for m in mails])):
        assert re.fullmatch(r"to [\w.]+@[a-z]\d+\.example\.(org|com|net), now", new) and old[:6] not in new


def test_key_words_need_a_value(spark):
    texts = ["Token: none. API-KEY: short.. and", "password", "a token:\nnext line is text", "a@b..com b@c"]
    assert replaced(spark, *texts) == ["Token: none. API-KEY: short.. and", "password", texts[2], texts[3]]


def test_exhausted_formats_are_permuted(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "ATTEMPTS", 2)
    monkeypatch.setattr(surrogates, "SAME_LENGTH", 0)
    phones = [f"{i:04d}" for i in range(10_000)]
    values = spark.createDataFrame([("phone", p) for p in phones] + [("phone", "123456789"), ("secret", "________"), ("secret", "a1b2c3d4")], "kind string, norm string")
    rows = surrogates.surrogate_table(values, "k").collect()
    made = {(r.kind, r.norm): r.surrogate for r in rows}
    assert len(rows) == len(made) == 10_003 and all(k[1] != v for k, v in made.items())
    assert sorted(made["phone", p] for p in phones) == phones
    assert made["phone", "123456789"] not in phones and len(made["phone", "123456789"]) == 9
    assert len({(k[0], v) for k, v in made.items()}) == 10_003


def test_names_grow_with_the_attempts(spark):
    frame = spark.createDataFrame([("family", "Smith"), ("email", "a@b.org")], "kind string, norm string")
    made = [
        {r.kind: r.made for r in frame.select("kind", surrogates.candidate(F.col("kind"), F.col("norm"), "k", n).alias("made")).collect()} for n in (0, 3)
    ]
    assert len(made[0]["family"]) == 10 and len(made[1]["family"]) == 16 and len(made[1]["email"]) > len(made[0]["email"])


def test_secrets_of_any_length(spark):
    said = {
        "password: hunter2": "hunter2", '{"password": "S3cretS3cretLong", "n": 1}': "S3cretS3cretLong", "PWD=a1": "a1", "passwd = 'abc'": "abc",
        'password =  "x"': '"x"', "passphrase: correct-horse-battery": "correct-horse-battery", '"token":"abcdefgh"': "abcdefgh",
        "api_key:  Zx81Zx81Zx81": "Zx81Zx81Zx81", "my secret = " + "q7" * 300 + " end": "q7" * 300,
    }
    for (text, secret), new in zip(said.items(), replaced(spark, *said)):
        head, tail = text.split(secret)
        assert secret not in new and new.startswith(head) and new.endswith(tail), (text, new)


def test_sentences_are_left_alone(spark):
    said = [
        "the password: never tell it", "a token: 12 of them", "her secret: love", "Password: ask me", "secrets = none", "api key: see below",
        "passwordless: 1 time", "the pwd command: 3 lines", "token",
    ]
    assert replaced(spark, *said) == said
