import random

import numpy as np

from avionyx.llm import latent


def corpus(seed=4):
    """Topical documents, items, and the planted (doc_id, item_id) pairs."""
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in", "is", "a"]
    topics = [[f"t{k}w{i}" for i in range(60)] for k in range(12)]

    def prose(topic, n):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(topic) for _ in range(n)]

    items = [(i, prose(topics[i % 12], rng.choice([12, 20, 40, 57]))) for i in range(30)]
    docs, planted = [], set()
    for d in range(400):
        words = prose(rng.choice(topics), rng.choice([5, 60, 300]))
        if d % 10 == 0:
            item, asked = items[(d // 10) % 30]
            asked = list(asked)
            if d % 20 == 0:  # a paraphrase: words left out and put in before the answer
                for _ in range(len(asked) // 8):
                    asked.insert(rng.randrange(len(asked) // 2), "so")
                    del asked[rng.randrange(len(asked) // 2)]
            at = rng.randrange(len(words))
            words[at:at] = asked
            planted.add((d, item))
        docs.append((d, " ".join(words)))
    return docs, [(i, " ".join(w)) for i, w in items], planted


def test_planted_items_and_paraphrases(spark):
    docs, items, planted = corpus()
    docs += [(1000, None), (1001, ""), (None, "x y"), (0, docs[0][1])]
    items += [(100, None), (101, ""), (102, "too short"), items[0]]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame(items, "item_id long, text string")
    hits = latent.contaminated(d, b).collect()
    got = {(r["doc_id"], r["item_id"]) for r in hits}
    assert got == planted and len(hits) == len(got)
    clean = latent.decontaminate(d, b)
    assert clean.columns == d.columns
    left = [r["doc_id"] for r in clean.collect()]
    bad = {x for x, _ in planted}
    assert sorted(left, key=str) == sorted((i for i, _ in docs if i not in bad), key=str)
    assert latent.contaminated(d.limit(0), b).count() == 0
    assert latent.contaminated(d, b.limit(0)).count() == 0


def test_long_document_and_verdict(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(5000)}" for _ in range(200_000)]
    item = [f"q{i}" for i in range(30)]
    for at in (latent.RUN_WORDS - 10, 150_000):
        words[at:at] = item
    d = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[20_000:140_000]))], "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    [hit] = latent.contaminated(d, b).collect()
    assert (hit["doc_id"], hit["item_id"], hit["lcs_share"]) == (1, 7, 1.0)
    # of equal hits the first counts, from the start of the document
    assert abs(hit["near_word"] - (latent.RUN_WORDS - 10)) <= len(item)
    w, q = np.array([1, 2, 3, 4], "<u2"), np.array([1, 9, 3], "<u2")
    assert latent.verdict(w, q, q[-1:]) == (2 / 3, 1.0)


def test_singular_vectors_match_numpy(spark):
    docs, _, _ = corpus(5)
    coded = latent._coded(spark.createDataFrame(docs, "doc_id long, text string"), "bigint")
    seen, n = latent.passage_frequencies(coded)
    rows = []
    for _, c in sorted((r["doc_id"], np.frombuffer(r["codes"], "<u2")) for r in coded.collect()):
        c = c & (latent.FEATURES - 1)
        rows += [c[i : i + latent.PASSAGE] for i in range(0, len(c), latent.PASSAGE)]
    assert n == len(rows)
    a = np.zeros((n, latent.FEATURES))
    for i, r in enumerate(rows):
        np.add.at(a[i], r, 1)
    assert ((a > 0).sum(axis=0) == seen).all()
    idf = np.log((n + 1) / (seen + 1.0)) * (seen > 0)
    a *= idf
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
    vectors, values = latent.leading_vectors(coded, idf)
    exact = np.linalg.svd(a, compute_uv=False)
    assert np.allclose(values[:8], exact[:8], rtol=0.02)
    assert np.allclose(vectors.T @ vectors, np.eye(latent.RANK), atol=1e-4)


def test_recall_of_paraphrases(spark):
    """Items with a quarter to two fifths of their words replaced and the last third kept."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rng = random.Random(5)
    docs = [(r["doc_id"], latent.TOKEN.findall((r["text"] or "").lower())) for r in rows]
    vocabulary = [w for _, ws in docs for w in ws]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.choice([20, 30, 45, 60]))]) for i in range(200)]
    holders = [ws for _, ws in docs if len(ws) >= 20]
    number = {id(ws): d for d, ws in docs}
    planted = {}
    for kept in (0.62, 0.68, 0.75):
        for i, asked in items:
            words, copy = rng.choice(holders), list(asked)
            for j in rng.sample(range(len(copy) - -(-len(copy) // 3)), int((1 - kept) * len(copy))):
                copy[j] = rng.choice(vocabulary)
            at = rng.randrange(len(words))
            words[at:at] = copy
            planted[number[id(words)], i] = kept
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in latent.contaminated(d, b).collect()}
    for kept, least in ((0.62, 0.93), (0.68, 0.97), (0.75, 0.97)):
        asked = [p for p, k in planted.items() if k == kept]
        share = sum(p in got for p in asked) / len(asked)
        print("recall", kept, share)
        assert share >= least, (kept, share)


def test_place_in_a_long_document(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(5000)}" for _ in range(80_000)]
    words[50_000:50_000] = item = [f"q{i}" for i in range(30)]
    d = spark.createDataFrame([("a", " ".join(words))], "doc_id string, text string")
    b = spark.createDataFrame([("i7", " ".join(item))], "item_id string, text string")
    [hit] = latent.contaminated(d, b).collect()
    assert (hit["doc_id"], hit["item_id"]) == ("a", "i7") and abs(hit["near_word"] - 50_000) <= 30


def test_short_items_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(200)]
    docs += [(500, "W1, w2;\nw3! "), (501, None), (502, "前文这是一个问题后文 end"), (503, "xw1 w2")]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 8)))) for i in range(60)]
    items += [(100, "w1 w2 w3"), (101, "w1 w2 w3"), (102, "..."), (103, None), (104, "这是一个问题")]

    def runs(text):
        return latent.TOKEN.findall((text or "").lower())

    want = {}
    for d, text in docs:
        words = runs(text)
        for i, item in items:
            asked = runs(item)
            at = [p for p in range(len(words) - len(asked) + 1) if words[p : p + len(asked)] == asked] if asked else []
            if at:
                want[d, i] = at[0]
    want[502, 104] = 0
    d = spark.createDataFrame([(i, t) for i, t in docs], "doc_id int, text string")
    b = spark.createDataFrame(items, "item_id int, text string")
    got = {(r["doc_id"], r["item_id"]): r["near_word"] for r in latent.contaminated(d, b).collect()}
    assert got == want
    cut = {x for (x, i) in want if len(runs(dict(items)[i])) >= latent.SHORTEST_CUT}
    left = {r["doc_id"] for r in latent.decontaminate(d, b).collect()}
    assert left == {i for i, _ in docs} - cut and 502 in left


def test_items_longer_than_the_widest_window_are_judged_whole(spark):
    rng = random.Random(8)
    item = [f"q{i}" for i in range(300)]
    filler = [[f"w{rng.randrange(3000)}" for _ in range(700)] for _ in range(30)]
    whole, piece, spread = list(filler[0]), list(filler[1]), list(filler[2])
    whole[100:100] = item
    piece[100:100] = item[64:128]
    spread[100:100] = [w for i, w in enumerate(item) if i % 6]
    docs = [(i, " ".join(w)) for i, w in enumerate([whole, piece, spread, *filler[3:]])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r["lcs_share"] for r in latent.contaminated(d, b).collect()}
    assert got == {0: 1.0, 2: 250 / 300}
