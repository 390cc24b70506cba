import random
from itertools import product

import numpy as np

from avionyx.llm import toxicity
from avionyx.llm.queries import op5_toxicity_grammar

SF = "/root/testdata/sf0.1"


def rewritings(machine, classes):
    """Every path of one machine over the classes: outputs and weight, by plain enumeration."""
    paths = [(0, (), 0.0)]
    for symbol in classes:
        paths = [(to, (*outs, o), w + v) for at, outs, w in paths for to, o, v in machine.arcs[at].get(symbol, ())]
    return [(outs, w) for at, outs, w in paths if at in machine.finals]


def brute_best(clause):
    """The cascade run one machine after the other over every choice of classes."""
    t, best = toxicity, 0.0
    for chosen in product(*clause):
        weight = sum(w for _, w in chosen)
        for negated, w1 in rewritings(t.scope(t.NEGATION, 4, t.NEGATED), [c for c, _ in chosen]):
            for reported, w2 in rewritings(t.scope(t.REPORT, None, t.REPORTED), negated):
                for _, w3 in rewritings(t.patterns(), reported):
                    best = max(best, weight + w1 + w2 + w3)
    return best


def test_composed_machine_matches_the_cascade():
    rng = random.Random(0)
    for _ in range(400):
        symbols = [rng.choice(toxicity.SYMBOLS) for _ in range(rng.randrange(1, 9))]
        clause = [[(toxicity.OTHER, 0.0), (s, rng.uniform(1, 8))] if s in toxicity.MARKED else [(s, 0.0)] for s in symbols]
        weight, events = toxicity.GRAMMAR.best(clause)
        assert abs(weight - brute_best(clause)) < 1e-9
        assert len(events) <= sum(s in toxicity.MARKED for s in symbols)


def weight_of(text, lexicon):
    return sum(w for _, _, w, _ in toxicity.matched(text, lexicon))


def test_patterns_and_the_order_of_words():
    lexicon = toxicity.Lexicon({"zork": 2.0})

    def events(text):
        return [e for *_, found in toxicity.matched(text, lexicon) for e in found]

    assert events("you are an idiot") == ["insult_target"]
    assert events("what a clown") == ["insult_frame"]
    assert events("idiot! moron scum walks by") == ["insult_clause", "insult_run"]  # one event for each insult after the first
    assert events("I will kill you") == ["threat"]
    assert events("so we kill time") == [] and events("green trash day came") == [] and events(None) == []
    assert events("the zorkling") == ["insult_frame"]
    assert weight_of("you great idiot", lexicon) > weight_of("you poor old great tired idiot", lexicon)
    # the same words in another order
    assert weight_of("well people like trash cans near houses", lexicon) != weight_of("trash near well houses like cans people", lexicon)
    assert weight_of("friends kill time while dogs often sleep near you", lexicon) == 0 < weight_of("friends kill you while dogs sleep", lexicon)


def test_negation_and_report_lower_the_score():
    model = toxicity.Model(toxicity.Lexicon({}), np.array([2.0, 0.5]), -3.0)
    plain, negated, reported = (model.score(t) for t in ("you are an idiot", "you are not an idiot", "he wrote: you are an idiot"))
    assert plain >= 0.5 > max(negated, reported)
    assert model.score("I will kill you") >= 0.5 > model.score("I will never kill you")
    # the clause bounds both
    assert model.score("not here. you are an idiot") == plain


def test_coefficients_are_not_negative():
    rng = np.random.default_rng(0)
    x = rng.random((400, 2))
    y = (x[:, 0] - x[:, 1] + rng.normal(0, 0.2, 400) > 0).astype(float)
    weights, _ = toxicity.rising_logistic(x, y)
    assert weights[0] > 0 and weights[1] == 0


def test_matched_clauses_carry_their_spans(spark):
    docs = spark.createDataFrame([(1, "Fine. You are an idiot, he said.", 0.5), (2, None, 1.0)], "doc_id int, text string, weight double")
    model = toxicity.Model(toxicity.Lexicon({}), np.array([2.0, 0.5]), -3.0)
    rows = toxicity.matched_clauses(docs, model).collect()
    assert [(r["doc_id"], r["start"], r["end"], r["events"], r["clause"]) for r in rows] == [(1, 6, 22, ["insult_target"], "You are an idiot")]


def test_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = op5_toxicity_grammar(spark, SF)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] == r["toxic"] for r in rows)
    toxic = [r for r in rows if r["toxic"]]
    assert hit >= 0.98 * len(rows)
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_edge_rows(spark):
    texts = [None, "", "idiot", "you idiot you moron", "a " * 50_000, "."]
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)] + [(None, "x", 1), (2, "idiot", 9)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(2, 1, None), (3, 1, 0), (4, 0, 1), (5, 0, 1), (None, 1, 1), (0, None, 1), (77, 1, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs.drop("toxic"), labels)
    out = toxicity.score_documents(docs, model).collect()
    assert len(out) == 8 and all(0 <= r["score"] <= 1 for r in out)
    bare = toxicity.fit(docs.drop("toxic"), labels.limit(0))
    assert bare.score("you idiot") >= 0.5 > bare.score("hello")
    assert toxicity.score_documents(docs.limit(0), bare).count() == 0
