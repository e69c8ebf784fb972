import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sortproof.llm.toxicity import estimate_prior, feature_pairs, pu_gradient, score_toxicity, toxicity_digest, train

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    stems, rows, toxic = ["grumpf", "zwackel"], [], {}
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        toxic[i] = int(i % 8 == 0)
        if toxic[i]:
            for _ in range(rng.randint(2, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(stems) + rng.choice(["", "en", "ix", "uto"]))
        rows.append((i, " ".join(w)))
    return rows, toxic


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(docs_df, spark, clashing):
    rows, toxic = corpus()
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items() if i % 3 != 2 or t], LABELS)
    out = {r["doc_id"]: r for r in toxicity_digest(docs_df(rows, clashing), labels).collect()}
    assert len(out) == len(rows)
    test = [i for i in out if is_held_out(i)]
    assert all(out[i]["held_out"] == is_held_out(i) for i in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out.values())
    right = np.mean([out[i]["predicted"] == toxic[i] for i in test])
    found = np.mean([out[i]["predicted"] for i in test if toxic[i]])
    assert right > 0.97 and found > 0.9


def test_labels_of_the_test_fold_change_nothing(docs_df, spark):
    rows, toxic = corpus(300)
    df = docs_df(rows)
    one = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], LABELS)
    two = spark.createDataFrame([(i, 1, 1 - t if is_held_out(i) else t) for i, t in toxic.items()], LABELS)
    assert sorted(map(tuple, score_toxicity(df, one).collect())) == sorted(map(tuple, score_toxicity(df, two).collect()))


def test_odd_rows_and_empty_tables(docs_df, spark):
    rows, toxic = corpus(240)
    odd = [(9000, None), (9001, ""), (None, "grumpf grumpfen"), (0, rows[0][1]), (9002, "word " * 20_000)]
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()] + [(0, 1, 0), (None, 1, 1), (9001, None, None)], LABELS)
    out = score_toxicity(docs_df(rows + odd), labels).collect()
    assert len(out) == len(rows) + 5 and all(0 <= r["score"] <= 1 for r in out)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r["score"])
    assert by[9000] == by[9001] and by[0][0] == by[0][1] and by[None][0] > 0.5
    assert score_toxicity(docs_df(rows).limit(0), labels).count() == 0
    assert {r["score"] for r in score_toxicity(docs_df(rows[:3]), labels.limit(0)).collect()} == {0.0}


def test_gradient_is_that_of_the_risk():
    rng = np.random.default_rng(1)
    positive = np.arange(40) < 12
    for shift in (0.0, 4.0):  # the second one with a part held at 0
        f = rng.normal(size=40) + np.where(positive, shift, -shift)
        _, g = pu_gradient(f, positive, 0.3)
        for i in (0, 5, 20, 39):
            step = np.zeros(40)
            step[i] = 1e-6
            loss = lambda z: np.logaddexp(0, -z)
            first = lambda f: 0.3 * loss(f[positive]).mean()  # noqa: E731, B023
            second = lambda f: loss(-f[~positive]).mean() - 0.3 * loss(-f[positive]).mean()  # noqa: E731, B023
            total = (lambda f: first(f) + second(f)) if second(f) >= 0 else (lambda f: -second(f))
            assert g[i] == pytest.approx((total(f + step) - total(f - step)) / 2e-6, abs=1e-6)


def test_features_of_words_and_beginnings():
    row, feature = feature_pairs(pa.array(["Abcdefgh, abcdefgh", None, "", "ab"]))
    assert sorted(set(row.tolist())) == [0, 3]
    assert len(set(feature[row == 0].tolist())) == 5 and (row == 3).sum() == 1


def test_labels_of_toxic_rows_alone(docs_df, spark):
    """The setting of the method: confirmed toxic rows, all else unlabelled."""
    rows, toxic = corpus()
    labels = spark.createDataFrame([(i, None, 1) for i, t in toxic.items() if t], LABELS)
    out = {r["doc_id"]: r for r in toxicity_digest(docs_df(rows), labels).collect()}
    clean = [i for i in out if is_held_out(i) and not toxic[i]]
    bad = [i for i in out if is_held_out(i) and toxic[i]]
    assert np.mean([out[i]["predicted"] for i in clean]) <= 0.02 and np.mean([out[i]["predicted"] for i in bad]) > 0.9
    # the prior comes from the texts: labels of clean rows beside them change nothing
    both = spark.createDataFrame([(i, None, t) for i, t in toxic.items()], LABELS)
    assert {i: r["score"] for i, r in out.items()} == {r["doc_id"]: r["score"] for r in score_toxicity(docs_df(rows), both).collect()}


@pytest.mark.parametrize("prior", [0.02, 0.1, 0.3, 0.6])
def test_prior_from_positives_and_unlabelled(prior):
    rng = np.random.default_rng(int(prior * 100))
    n_p, n_u, width = 400, 4000, 60
    hidden = rng.random(n_u) < prior
    rate = lambda bad: np.where(np.arange(width) < 40, 0.25 if bad else 0.02, 0.2)
    x = np.concatenate([rng.random((n_p, width)) < rate(True), np.where(hidden[:, None], rng.random((n_u, width)) < rate(True), rng.random((n_u, width)) < rate(False))])
    row, feature = np.nonzero(x)
    got = estimate_prior(row, feature, np.arange(n_p + n_u) < n_p, width)
    assert got == pytest.approx(hidden.mean(), rel=0.25, abs=0.01)


def test_training_against_numerical_descent():
    """The same steps with the gradient of the risk, taken by differences on a dense matrix."""
    rng = np.random.default_rng(4)
    x = rng.random((30, 4)) < 0.4
    positive = np.arange(30) < 10
    x[positive, 0] = True
    row, feature = np.nonzero(x)
    got = train(row, feature, positive, 4, 0.3, steps=40)
    loss = lambda z: np.logaddexp(0, -z)
    full = np.hstack([x, np.ones((30, 1))])

    def risk(w):
        f = full @ w
        second = loss(-f[~positive]).mean() - 0.3 * loss(-f[positive]).mean()
        decay = 0.5e-4 * (w[:-1] ** 2).sum()
        return 0.3 * loss(f[positive]).mean() + second + decay if second >= 0 else -second + decay

    w, m, v = np.array([0, 0, 0, 0, np.log(0.3 / 0.7)]), np.zeros(5), np.zeros(5)
    for step in range(1, 41):
        g = np.array([(risk(w + e) - risk(w - e)) / 2e-6 for e in np.eye(5) * 1e-6])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    assert got == pytest.approx(w, abs=1e-3)


def test_toxic_labels_without_a_model_warn(docs_df, spark):
    labels = spark.createDataFrame([(i, 1, 1) for i in range(5000, 5009)], LABELS)
    with pytest.warns(UserWarning, match="no model"):
        out = score_toxicity(docs_df([(i, f"text {i}") for i in range(6)]), labels)
    assert {r["score"] for r in out.collect()} == {0.0}
