import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sortproof.llm import quality_rules
from sortproof.llm.quality_rules import fit_rules, judge, keep_good, quality_rules_digest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    again = {p for v in at.values() if len(v) > 1 for s in v for p in range(s, s + 8)}
    return (
        len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again),
        len(w) < 20 or 100 * len(again) > 30 * len(w),
    )


def some_texts(seed=1):
    rng = random.Random(seed)
    words = ["a", "bé", "ccc", "d😀", "e,", "#x", "<b>", "|", "F"]
    texts = [rng.choice([" ", "\n", " \n\t"]).join(rng.choice(words[: rng.randint(1, 9)]) for _ in range(rng.randint(0, 120))) for _ in range(80)]
    return texts + [None, "", " \n ", "one", "x " * 5000, "a b c d e f g h " * 2, "  　", "\n".join(["same line"] * 9)]


def test_base_figures_are_exact(docs_df, clashing):
    texts = some_texts()
    rows = list(enumerate(texts)) + [(None, "no id " * 3), (0, texts[0])]
    out = quality_rules_digest(docs_df(rows, clashing)).collect()
    got = sorted(((r[0], *r[1:7]) for r in out), key=repr)
    assert got == sorted(((i, *base(t)) for i, t in rows), key=repr)
    assert not any(r["kept"] for r in out if r["base_failed"])


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_junk_goes_and_prose_stays(docs_df):
    rng = random.Random(2)
    good = [(i, prose(rng, rng.randint(25, 300))) for i in range(150)]
    junk = []
    for i in range(1000, 1040):
        text = prose(rng, 60)
        kind = i % 4
        junk.append((i, [re.sub(r"(\w+)", r"\1***", text), text.upper().replace(" ", "!! "), text.replace(" ", " | "), "spam " * 60][kind]))
    df = docs_df(good + junk)
    kept = {r["doc_id"] for r in judge(df).where("kept").collect()}
    assert kept == {i for i, _ in good}
    out = keep_good(df)
    assert out.columns == df.columns and {r["doc_id"] for r in out.collect()} == kept


def em_by_hand(patterns, iterations):
    """The model of greater likelihood from two starts, in plain Python: (prior, on good, on bad)."""
    Q, n_rules, total, found = quality_rules, len(patterns[0][0]), sum(n for _, n in patterns), []
    share = [sum(n for v, n in patterns if v[r] == -1) / max(1, sum(n for v, n in patterns if v[r])) for r in range(n_rules)]
    for suspect in (1.0, Q.SUSPECT):
        p = [0.05 if any(x == -1 and f <= suspect for x, f in zip(v, share, strict=True)) else 0.95 for v, _ in patterns]
        for _ in range(iterations):
            prior = (sum(n * x for (_, n), x in zip(patterns, p, strict=True)) + 1) / (total + 2)
            g, b = [], []
            for r in range(n_rules):
                def count(weight, among, vote, r=r):
                    return sum(n * w for (v, n), w in zip(patterns, weight, strict=True) if vote(v[r]) and among(v))

                both = lambda w, among: (count(w, among, lambda x: x == -1), count(w, among, lambda x: x != 0))
                no, al = both(p, lambda v: True)
                weight = Q.PRIOR_WEIGHT if share[r] <= suspect else Q.SUSPECT_WEIGHT
                g.append((no + Q.FALSE_ALARM * weight * total) / (al + weight * total))
                no, al = both([1 - x for x in p], lambda v: -1 in v)
                b.append((no + Q.CAUGHT * Q.CAUGHT_WEIGHT * total) / (al + Q.CAUGHT_WEIGHT * total))
            p, density = [], 0.0
            for v, n in patterns:
                good, bad = prior, 1 - prior
                for r in range(n_rules):
                    good *= {-1: g[r], 0: 1.0, 1: 1 - g[r]}[v[r]]
                    bad *= {-1: b[r], 0: 1.0, 1: 1 - b[r]}[v[r]]
                bad = bad * (1 - Q.MISSED) if -1 in v else (1 - prior) * Q.MISSED
                p.append(good / (good + bad))
                density += n * math.log(good + bad)
        found.append((density, prior, g, b))
    return max(found, key=lambda x: x[0])[1:]


PATTERNS = [((1, 1, 0), 500), ((1, -1, 1), 40), ((-1, 1, 0), 30), ((0, 0, 0), 25), ((-1, -1, 1), 10), ((1, 1, 1), 300)]


def votes_df(spark, patterns):
    names = [f"r{i}" for i in range(len(patterns[0][0]))]
    return spark.createDataFrame([(*v, n) for v, n in patterns], ", ".join(f"{x} int" for x in names) + ", n long"), names


@pytest.mark.parametrize("iterations", [1, 6])
def test_em_against_plain_python(spark, iterations):
    model = fit_rules(*votes_df(spark, PATTERNS), iterations=iterations)
    prior, g, b = em_by_hand(PATTERNS, iterations)
    assert model.prior == pytest.approx(prior) and model.on_good == pytest.approx(g) and model.on_bad == pytest.approx(b)


def quality_of(model, spark, votes):
    row = spark.createDataFrame([votes], ", ".join(f"r{i} int" for i in range(len(votes))))
    return row.select(model.posterior([F.col(c) for c in row.columns]).alias("q")).first()["q"]


@pytest.mark.parametrize("share", [0.05, 0.3, 0.5])
@pytest.mark.parametrize("kinds", [1, 3])
def test_a_plain_majority_stays(spark, share, kinds):
    """Odd documents of several kinds, each failing one rule of five; the others fail none."""
    plain = (1, 1, 1, 1, 1)
    odd = [(tuple(-1 if r == k else 1 for r in range(5)), round(1000 * share / kinds)) for k in range(kinds)]
    model = fit_rules(*votes_df(spark, [(plain, round(1000 * (1 - share))), ((0, 1, 1, 0, 1), 30), *odd]))
    assert quality_of(model, spark, plain) > 0.9 and quality_of(model, spark, (0, 1, 1, 0, 1)) > 0.9


def test_a_rule_that_is_often_wrong_is_outweighed(spark):
    """Rule 0 votes bad on 40% of everything, whatever the others see; the others agree with each other."""
    patterns = [((-1, 1, 1, 1), 380), ((1, 1, 1, 1), 570), ((-1, -1, -1, -1), 20), ((1, -1, -1, -1), 30)]
    model = fit_rules(*votes_df(spark, patterns))
    assert quality_of(model, spark, (-1, 1, 1, 1)) > 0.5 > quality_of(model, spark, (1, -1, -1, -1))


@pytest.mark.parametrize("mix", [(0.7, 0.2, 0.1, 0.0), (0.6, 0.0, 0.2, 0.2), (0.6, 0.2, 0.1, 0.1), (0.5, 0.2, 0.2, 0.1)])
def test_plain_prose_stays_among_much_odd_text(docs_df, mix):
    rng, rows, plain = random.Random(7), [], set()
    kinds = (
        lambda t: t,
        lambda t: " ".join(w * 3 for w in t.split(" ")),  # long words
        lambda t: re.sub(r"(\w+)", r"\1#|", t),  # symbols
        lambda t: t.upper(),
    )
    for share, kind in zip(mix, kinds, strict=True):
        for _ in range(round(300 * share)):
            rows.append((len(rows), kind(prose(rng, rng.randint(60, 120)))))
            if kind is kinds[0]:
                plain.add(rows[-1][0])
    kept = {r["doc_id"] for r in judge(docs_df(rows)).where("kept").collect()}
    assert len(kept & plain) >= 0.95 * len(plain)


def test_no_python_in_the_plan_and_empty_table(docs_df):
    df = docs_df([(1, "x y")]).limit(0)
    assert judge(df).count() == 0 and keep_good(df).count() == 0
    plan = keep_good(docs_df([(1, "x y")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
