from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
from llm.nasty import documents
from pyspark.sql import functions as F

from lakestrata.llm.toxicity import LabelModel, Voters, drop_toxic, fit_linear, mine_lexicon, toxicity, without_copies

INSULTS = ["gronk", "zorbling", "splunge", "frabtwit"]


def corpus(spark, count=1500, seed=3):
    pick = random.Random(seed)
    common = ["w" + "".join(pick.choices("abcdefgh", k=pick.randint(3, 8))) for _ in range(900)]
    texts, toxic = [], {}
    for n in range(count):
        words = pick.choices(common, k=pick.randint(5, 120))
        toxic[n] = int(n % 6 == 0)
        if toxic[n]:
            for _ in range(pick.randint(1, 4)):
                words.insert(pick.randrange(len(words)), pick.choice(INSULTS) + pick.choice(["", "er", "ly"]))
        texts.append((n, " ".join(words)))
    texts += [(9000, None), (9001, ""), (None, "w"), (9002, "you gronker gronk"), (9002, "you gronker gronk")]
    labels = [(n, 1, t, f"x{n}") for n, t in toxic.items()] + [(9000, 0, None, "x"), (None, 1, 1, "x"), (77777, 1, 1, "x")]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    return documents(spark, texts), labels, toxic


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    docs, labels, toxic = corpus(spark)
    rows = toxicity(docs, labels).collect()
    assert len(rows) == 1505
    tally = Counter()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is not None and held_out(r["doc_id"]))
        if r["doc_id"] in toxic and r["held_out"]:
            tally[toxic[r["doc_id"]], r["predicted"]] += 1
    assert tally[1, 0] <= 0.05 * tally[1, 1] and tally[0, 1] <= 0.01 * tally[0, 0]
    by_id = {r["doc_id"]: r["predicted"] for r in rows}
    assert (by_id[9000], by_id[9001], by_id[9002]) == (0, 0, 1)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels, _ = corpus(spark, 600)
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    other = labels.withColumn("toxic", F.when(hidden, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted((r["doc_id"] or -1, r["score"]) for r in toxicity(docs, some).collect()) for some in (labels, other)]
    assert scores[0] == scores[1]


def test_toxic_documents_go(spark):
    docs, labels, toxic = corpus(spark, 600)
    left = drop_toxic(docs, labels)
    assert left.schema == docs.schema
    gone = {n for n in toxic} - {r["doc_id"] for r in left.select("doc_id").collect()}
    assert len(gone ^ {n for n, t in toxic.items() if t}) <= 6


def test_without_labels_nothing_is_toxic(spark):
    docs, labels, _ = corpus(spark, 60)
    for some in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r["score"] for r in toxicity(docs, some).collect()} == {0.0}
        assert drop_toxic(docs, some).count() == docs.count()
    assert toxicity(docs.limit(0), labels).count() == 0


def test_lexicon_is_not_fooled_by_copies(spark):
    docs, labels, toxic = corpus(spark, 900)
    rows = [(int(t), f"text {n} of its own words " + ("gronk" if t else "")) for n, t in list(toxic.items())[:400]]
    rows += [(1, "manifold copies of one single odd toxic text gronk and so on")] * 60
    sample = spark.createDataFrame(rows, "toxic int, text string")
    lexicon = mine_lexicon(without_copies(sample))
    assert [name.rstrip("$")[:5] for name in lexicon] == ["gronk"]


def test_label_model_finds_accuracies_and_discounts_copies_of_a_voter():
    pick = np.random.default_rng(1)
    truth = pick.random(40_000) < 0.15
    rates = [(0.7, 0.02), (0.6, 0.05), (0.5, 0.01), (0.4, 0.08), (0.3, 0.02)]
    votes = np.stack([np.where(truth, pick.random(40_000) < a, pick.random(40_000) < b) for a, b in rates], 1).astype(float)
    votes = np.c_[votes, votes[:, 3], votes[:, 3]]  # one voter three times
    mean, pairs = votes.mean(axis=0), votes.T @ votes / len(votes)
    # First guesses as a small labelled sample gives them.
    small = slice(0, 400)
    guess = [np.array([votes[small][truth[small] == part].mean(axis=0)])[0].clip(0.01, 0.99) for part in (True, False)]
    model = LabelModel.fit(mean, pairs, *guess)
    alone = LabelModel.fit(mean[:5], pairs[:5, :5], guess[0][:5], guess[1][:5])
    copies = model.weights[[3, 5, 6]].sum()
    print(model.weights, alone.weights)
    assert 0.5 * alone.weights[3] < copies < 2 * alone.weights[3]
    likely = model.posterior(votes)
    assert ((likely > 0.5) == truth).mean() > 0.93 and likely[truth].mean() > 5 * likely[~truth].mean()


def test_linear_classifier_fits_soft_targets():
    pick = np.random.default_rng(2)
    x = (pick.random((4000, 5)) < 0.3).astype(float)
    target = 1 / (1 + np.exp(-(x @ np.array([2.0, -1.0, 0.5, 0, 1.5]) - 1)))
    weights = fit_linear(x, target, ridge=1e-6)
    assert np.allclose(weights, [2, -1, 0.5, 0, 1.5, -1], atol=0.01)


def test_signals_of_odd_texts():
    voters = Voters(["gronk$", "zorb"])
    assert voters.signals("") == ([], 0, 0, 0)
    found, hits, words, forms = voters.signals("GRONK!! zorbling Zorb x")
    assert (found, hits, words) == ([0, 1], 3, 4) and forms & 1
