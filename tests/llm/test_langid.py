import random

from tierworks.llm import langid

WORDS = {"x": ["the", "and", "with"], "y": ["und", "der", "nicht"], "z": ["que", "los", "para"]}


def made(rng, n):
    rows = []
    for k in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((k, " ".join(rng.choices(WORDS[lang], k=rng.randint(3, 30))), lang))
    return rows


def test_held_out_accuracy_and_odd_texts(spark):
    rng = random.Random(5)
    train = spark.createDataFrame(made(rng, 300) + [(1, None, "x"), (2, "a", None)], "doc_id long, text string, lang string")
    model = langid.fit(train)
    assert model[0] == ["x", "y", "z"]
    test = made(rng, 100) + [(900, None, None), (901, "", None), (902, "12 34 !?", None), (903, "und " * 300_000, "y")]
    df = spark.createDataFrame([(*r, 0.5) for r in test], "doc_id long, text string, lang string, score double")
    rows = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert len(rows) == len(test)
    assert all(rows[k].lang_pred == lang for k, _, lang in test if lang)
    assert all((rows[k].lang_pred, rows[k].score) == ("und", 0.0) for k in (900, 901, 902))
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_long_texts_count_each_gram_once(monkeypatch):
    import numpy as np

    text = "abcdefghij" * 7
    whole = np.sort(np.concatenate(list(langid.buckets_of(text))))
    monkeypatch.setattr(langid, "PIECE", 9)
    assert np.array_equal(whole, np.sort(np.concatenate(list(langid.buckets_of(text)))))


def test_no_training_rows(spark, docs, empty):
    model = langid.fit(empty)
    assert {r.lang_pred for r in langid.predict(docs, model).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


def brute_bayes(train, texts):
    """Naive Bayes over the same buckets, one n-gram at a time."""
    import math
    from collections import Counter, defaultdict

    grams, docs = defaultdict(Counter), Counter()
    for text, lang in train:
        docs[lang] += 1
        for found in langid.buckets_of(text.lower()):
            grams[lang].update(found.tolist())
    out = []
    for text in texts:
        if text is None or not any(c.isalpha() for c in text):
            out.append(("und", 0.0))
            continue
        own = Counter(x for found in langid.buckets_of(text.lower()) for x in found.tolist())
        logs = {}
        for lang in sorted(docs):
            total = sum(grams[lang].values())
            logs[lang] = math.log(docs[lang] / sum(docs.values())) + sum(
                n * (math.log(grams[lang][b] + langid.ALPHA) - math.log(total + langid.ALPHA * langid.BUCKETS)) for b, n in own.items()
            )
        best = max(sorted(logs), key=lambda k: logs[k])
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


def test_equals_bayes_by_hand(spark, monkeypatch):
    monkeypatch.setattr(langid, "HELD_LANGUAGES", 2)  # counts go to Spark in several portions
    train = [("the cat and the hat", "en"), ("le chat et le chapeau", "fr"), ("die katze und der hut", "de"), ("the dog", "en"), ("el gato", "es"), ("un chien", "fr")]
    texts = ["the chat", "½ ²", "Ⅷ", "١٢٣", "4 5", "_", "ª", "日本", "hut hut " * 50, "", None, "the chat", "É"]
    model = langid.fit(spark.createDataFrame(train, "text string, lang string").coalesce(1))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r.lang_pred, r.score) for r in langid.predict(rows, model).orderBy("doc_id").collect()]
    want = brute_bayes(train, texts)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(abs(g[1] - w[1]) < 1e-3 for g, w in zip(got, want))
    assert [g[0] for g in got[1:6]] == ["und"] * 5


def test_more_languages_than_are_held_at_once(spark):
    train = spark.createDataFrame([(f"word{k} " * 3, f"l{k:03}") for k in range(300)], "text string, lang string")
    langs, _, logs = langid.fit(train)
    assert len(langs) == 300 and logs.shape == (langid.BUCKETS, 300)
