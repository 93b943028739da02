import numpy as np
from pyspark.sql import functions as F

from boxframe.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.train(docs, ~held, per_language=100)
    out = langid.predict(docs.filter(held), model, carry=["lang"]).select("row.lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_odd_texts(spark):
    rows = [(1, "der die das und nicht", "de", 1), (2, "the of and to in", "en", 1)] * 5
    rows += [(3, None, "en", 1), (4, "", None, 1), (5, "12 !? \n", "en", 1), (6, "the of " * 30_000, None, 1), (7, "𐐀𐐁 𐐂", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = langid.train(docs, F.lit(True))
    got = {r.row.doc_id: r for r in langid.predict(docs, model).collect()}
    assert [got[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and got[3].score == 0
    assert got[6].lang_pred == "en" and got[7].lang_pred in ("de", "en") and got[1].row.score == 1
    assert langid.predict(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = langid.train(docs, F.lit(True))
    assert langid.predict(docs, model).first().lang_pred == "und"


def test_codewords_differ():
    for languages in (2, 4, 5, 6, 12, 40):
        code = langid.codewords(languages)
        assert len({tuple(r) for r in code}) == languages and all(abs(c.sum()) < languages for c in code.T)
        # A column and its opposite are one split of the languages.
        assert len({tuple(c * c[0]) for c in code.T}) == code.shape[1]
    assert langid.codewords(4).shape == (4, 7)


def test_decoding_by_a_plain_loop():
    rng = np.random.default_rng(2)
    labels = [("aa", "bb", "cc")[i % 3] for i in range(240)]
    x = rng.normal(size=(240, 16)) + 2 * np.array([[i % 3 == k for k in range(16)] for i in range(240)])
    model = langid.fit(x.astype(np.float32), labels)
    assert model.scale != 1.0
    chances = model.probabilities(x)
    for row, got in zip(x, chances, strict=True):
        losses = []
        for code in model.codes:
            loss = 0.0
            for bit, sign in enumerate(code):
                margin = sum(row[k] * model.weights[k, bit] for k in range(16)) + model.bias[bit]
                loss += model.trust[bit] * np.log1p(np.exp(-sign * margin))
            losses.append(loss)
        likely = [np.exp(-model.scale * (v - min(losses))) for v in losses]
        assert np.allclose(got, np.array(likely) / sum(likely), atol=1e-4)
    # Scores are near the share of right answers.
    right = np.mean([model.languages[int(c.argmax())] == v for c, v in zip(chances, labels, strict=True)])
    assert abs(chances.max(1).mean() - right) < 0.1


def test_sharpness_follows_errors():
    sure = np.array([[0.0, 1.0]] * 90)
    wanted = np.zeros(90, int)
    some = wanted.copy()
    some[:30] = 1
    assert langid.sharpness(sure, some) < langid.sharpness(sure, wanted) < 1000
    # A third wrong: a chance of two thirds for the nearer one.
    assert abs(1 / (1 + np.exp(-langid.sharpness(sure, some))) - 2 / 3) < 0.05


def test_features_ignore_what_is_no_letter():
    a, b = langid.features("Ab cd"), langid.features("ab 12 -- CD!")
    assert np.allclose(a, b) and langid.features("...") is None and abs(float((a * a).sum()) - 1) < 1e-5
