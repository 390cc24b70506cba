import random

import numpy as np

from pyspark.sql import functions as F

from avionyx.llm import language
from avionyx.llm.queries import op9_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = op9_language_id(spark, SF)
    rows = got.join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and r["n_chars"] >= 100]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_word_first_then_shorter_grams(spark):
    rows = [(i, "the cat house " * 3, "en") for i in range(10)] + [(20 + i, "das haus katze " * 3, "de") for i in range(10)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en"]
    assert np.allclose(model.word("cat"), model.tables[0]["cat"])
    by5 = [model.tables[5][g] for g in language.grams("houses", 5) if g in model.tables[5]]
    assert "houses" not in model.tables[0] and by5 and abs(model.word("houses") - sum(by5) / len(by5)).max() < 1e-5
    assert not any(g in model.tables[n] for n in (2, 3, 4, 5) for g in language.grams("qz", n)) and model.word("qz").shape == (2,)
    assert model.predict("houses cat")[0] == "en" and model.predict("katzen haus")[0] == "de"


def test_edge_rows(spark):
    rng = random.Random(0)
    texts = [None, "", "123 ² _ !", "the", "the " * 50_000, "".join(rng.choice("abc") for _ in range(50_000))]
    train = spark.createDataFrame([(i, "the and of " * 5, "en") for i in range(9)], "doc_id long, text string, lang string")
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "the", 2), (3, "the", 1)], "doc_id long, text string, score int")
    out = language.identify(docs, language.fit(train)).collect()
    assert len(out) == 8
    assert [r["lang_pred"] for r in sorted((r for r in out if r["doc_id"] is not None), key=lambda r: r["doc_id"])] == ["und"] * 3 + ["en"] * 4
    empty = language.identify(docs, language.fit(train.limit(0))).collect()
    assert {(r["lang_pred"], r["score"]) for r in empty} == {("und", 0.0)}
    assert language.identify(docs.limit(0), language.fit(train)).count() == 0
    assert spark.range(1).select(language.fold(F.lit(5), 3)).first()[0] == __import__("zlib").crc32(b"5") % 3
