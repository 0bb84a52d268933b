"""Languages without a profile get null, at a stated loss on known ones."""

import random

import pytest

from registry import queries
from talkweave.operators import language

WORDS = {
    "en": "the and you that was for are with his they this have from one had word but not what all were when your can said there use each which "
          "their time will about many then them write would like these her long make thing see him two has look more day could come did number sound",
    "fr": "les des est une que dans qui pour pas sur plus avec tout mais nous vous leur bien aussi cette comme sont fait être deux même "
          "temps après sans autre peut encore toujours jamais maison jour homme femme très aujourd'hui quand alors depuis chez beaucoup chose vie monde",
    "de": "der die und das nicht ist ein ich sie mit sich auch auf dem eine von haben werden wir aus wenn nach noch wie einen aber "
          "nur oder schon man mehr durch sein kann zwei immer jetzt welche zeit jahr menschen kinder zwischen während gegen keine etwas vielleicht wieder",
    "es": "los las una que del para con por más pero sus como este ya entre cuando todo esta ser son dos también había era muy años hasta "
          "desde está nos durante siempre todos uno hombre mujer tiempo vida mundo ahora después bueno grande hacer puede ciudad nuestro nosotros ellos",
    "it": "gli della che non una sono per con più anche questo come nella alla degli suo loro essere stato molto quando tutti dopo senza "
          "ancora sempre così perché quella fatto anni giorno uomo donna oggi tempo vita mondo adesso bene nostra città quello ogni hanno abbiamo",
    "nl": "het een van dat niet zijn voor met aan ook maar naar hebben worden deze wordt heeft door over nog meer wel geen moet jaar "
          "kunnen veel tussen zoals mensen altijd weer tijd goed huis onder omdat zonder vandaag iets twee zij onze wij waarom misschien nooit gaan",
    "pt": "não uma com para mais dos como mas foi ele das tem seu sua ser quando muito nos já está também pelo pela até isso ela entre "
          "depois sem mesmo aos seus quem nas esse eles você essa num nem suas meu às minha numa pelos elas qual nós lhe deles então coração",
}
KNOWN, UNKNOWN = ["en", "fr", "de", "es"], ["it", "nl", "pt"]


def said(rng, lang, n):
    pool = WORDS[lang].split()
    return [(lang, " ".join(rng.choices(pool, k=rng.randint(14, 30)))[:200]) for _ in range(n)]


def of(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def test_unknown_languages_are_null_and_known_ones_keep_theirs(spark):
    rng = random.Random(5)
    profiles = language.train_profiles(of(spark, [r for k in KNOWN for r in said(rng, k, 60)])).cache()
    limits = language.language_limits(of(spark, [r for k in KNOWN for r in said(rng, k, 120)]), profiles).cache()
    rows = [r for k in KNOWN + UNKNOWN for r in said(rng, k, 60)]
    got = language.open_language(of(spark, rows), "text", profiles, "found", limits).collect()
    assert len(got) == len(rows)
    named = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}
    for k in UNKNOWN:
        mine = [r.found for r in got if r.lang == k]
        assert mine.count(None) >= 0.9 * len(mine), k
    for k in KNOWN:
        mine = [r.found for r in got if r.lang == k]
        assert mine.count(named[k]) >= 0.9 * len(mine) and set(mine) <= {named[k], None}, k

    # In the vote of a chat, an unknown question leaves the decision to the response.
    question, answer = said(rng, "it", 1)[0][1], said(rng, "fr", 1)[0][1]
    turns = spark.createDataFrame([("a", question, answer)], "chat_id string, question_raw string, response_raw string")
    assert language.chat_language(turns, profiles, limits=limits).first().user_language == "French"


def test_without_held_out_text_nothing_is_named(spark):
    rng = random.Random(6)
    profiles = language.train_profiles(of(spark, said(rng, "en", 20)))
    limits = language.language_limits(of(spark, []), profiles)
    texts = of(spark, [*said(rng, "en", 3), ("en", ""), ("en", "12 !"), (None, "a"), ("en", "a")])
    got = language.open_language(texts, "text", profiles, "found", limits).collect()
    assert len(got) == 7 and {r.found for r in got} == {None}


def test_limits_hold_what_held_out_texts_reach(spark):
    """Equal texts: the limit is what each of them reaches, so all of them are named."""
    profiles = language.train_profiles(of(spark, [("en", "alpha beta gamma delta"), ("fr", "un deux trois quatre")]))
    text = "alpha beta gamma delta"
    limits = language.language_limits(of(spark, [("en", text)] * 5 + [("fr", text)]), profiles)
    reached = {(r.language, r.band): (r.least_share, r.least_margin) for r in limits.collect()}
    near = language.closest_language(of(spark, [("en", text)]), "text", profiles).collect()
    assert reached == {(r.language, r.band): (r.share, r.margin) for r in near}
    assert near[0].share == 1000 and near[0].band == 4


@pytest.mark.parametrize("query", [queries.lang_open_set, queries.lang_ngram])
def test_documents_are_cleaned_once(spark, tmp_path, query):
    """The cleaned text is read by several branches; the expressions that make it run before that."""
    rows = [(i, "hello there my old friend " * 9, "en" if i % 3 else "es") for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = query(spark, str(tmp_path))
    assert "regexp_replace" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 12
