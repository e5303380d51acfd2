import random

from pyspark.sql import functions as F

from tessera.llm import langid, toxicity
from tessera.llm.common import held_out
from tessera.llm.langid_queries import op10_language_id
from tessera.llm.toxicity_queries import op2_toxicity
from tests.conftest import SF_MID


def labelled(spark, n=500):
    rng, docs, labels = random.Random(2), [], []
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(400)]
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 60))
        if bad := i % 5 == 0:
            for _ in range(rng.randint(1, 3)):
                text.insert(rng.randrange(len(text)), rng.choice(["you zzidiotz", "zzlosers", "ZZSCUM!!"]))
        docs.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*labels, labels[0], (None, 1), (9999, None)], "doc_id long, toxic int")


def test_toxicity_learns_and_scores_odd_rows(spark, odd, none):
    docs, labels = labelled(spark)
    model = toxicity.fit(labels.filter(~held_out(F.col("doc_id"))), docs)
    assert any(unit.startswith(b"zz") for unit in model.lexicon)
    scored = toxicity.score(docs.withColumn("held", held_out(F.col("doc_id"))), model).filter("held").collect()
    wrong = [(r.doc_id, r.score) for r in scored if (r.score >= 0.5) != (r.doc_id % 5 == 0)]
    assert len(wrong) <= 0.05 * len(scored), (wrong, len(scored), model.lexicon)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert toxicity.score(none, model).collect() == []
    unlearnt = toxicity.fit(labels.filter("false"), docs)
    assert {r.score for r in toxicity.score(docs, unlearnt).collect()} == {0.0}


def test_toxicity_finds_every_planted_document_of_a_larger_table(spark):
    docs, labels = labelled(spark, 2000)
    model = toxicity.fit(labels.filter(~held_out(F.col("doc_id"))), docs)
    scored = toxicity.score(docs, model).filter(held_out(F.col("doc_id"))).collect()
    assert len(scored) > 300 and not [(r.doc_id, r.score) for r in scored if (r.score >= 0.5) != (r.doc_id % 5 == 0)]


def test_features_see_disguise_and_second_person():
    lexicon = {b"idiot": 2.0, b"stup*": 1.0}
    plain, disguised = toxicity.features("you are an idiot", lexicon), toxicity.features("you are an 1d10t", {b"idiot": 2.0})
    names = toxicity.FEATURES
    assert plain[names.index("near_second_person")] > 0 and plain[names.index("max_weight")] == 2.0
    assert disguised[names.index("obfuscation")] > 0 and disguised[names.index("max_weight")] == 2.0
    assert plain[names.index("obfuscation")] == 0
    for masked in ("you id*ot", "you i**ot!", "an !d!ot", "1di*t$"):
        made = toxicity.features(masked, lexicon)
        assert made[names.index("max_weight")] == 2.0 and made[names.index("obfuscation")] > 0, masked
    assert toxicity.features("you $cum", {b"scum": 3.0})[names.index("max_weight")] == 3.0
    for clean in ("* a list * of items", "costs $5 or 5$", "a ** b", "****"):
        assert toxicity.features(clean, lexicon)[names.index("max_weight")] == 0.0
    assert toxicity.features("so stupidly", lexicon)[names.index("stem_density")] > 0
    assert toxicity.features(None, lexicon) == toxicity.features("", lexicon) == [0.0] * len(names)


def test_capitals_of_any_script_and_few_shouted_words():
    names = toxicity.FEATURES
    made = toxicity.features("quiet words " * 200 + "GO AWAY", {})
    assert made[names.index("shouted_words")] == 2 / 402
    assert toxicity.features("УЙДИ отсюда", {})[names.index("shouted_words")] == 0.5
    for text in ("Ab cD É ß", "УЙДИ отсюда", "İI ı", "日本語 X", "ǅ a", ""):
        assert toxicity.capitals(text) == sum(c != c.lower() for c in text) or len(text.lower()) != len(text), text
    assert toxicity.capitals("İI") == 2


def test_toxicity_query_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    english = spark.read.parquet(f"{SF_MID}/documents.parquet").filter("lang = 'en'").select("doc_id")
    rows = op2_toxicity(spark, SF_MID).filter("held_out").join(labels, "doc_id").join(english, "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    assert right >= 0.93, right


def test_language_query_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    rows = op10_language_id(spark, SF_MID).join(docs, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.98


def test_language_of_odd_rows(spark, odd, none):
    texts = {"en": "the house and the river with this", "de": "das Haus und der Fluss mit diesem", "ru": "дом и река с этим"}
    rng = random.Random(4)
    learn = spark.createDataFrame([(i, " ".join(rng.choices(texts[x].split(), k=8)), x) for i in range(120) for x in [list(texts)[i % 3]]], "doc_id long, text string, lang string")
    model = langid.fit(learn)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(spark.createDataFrame(
        [(0, "und der Fluss"), (1, "river and house"), (2, "с река"), (3, None), (4, "123 !?"), (5, ""), (6, "the " * 400_000)], "doc_id long, text string"), model).collect()}
    assert [got[i][0] for i in range(7)] == ["de", "en", "ru", "und", "und", "und", "en"]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert langid.predict(odd.drop("lang"), model).count() == odd.count() and langid.predict(none, model).collect() == []
    assert langid.fit(none) is None
    assert {r.lang_pred for r in langid.predict(odd.drop("lang"), None).collect()} == {"und"}
