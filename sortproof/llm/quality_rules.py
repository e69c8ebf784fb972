"""Quality rules as weak supervision, with DataFrame functions only.

Method: rules vote good, bad or abstain on every document.
Expectation-maximisation over the counts of vote patterns estimates for each
rule how often its votes are bad on good and on bad documents (its
accuracies) and how many documents are good.  The posterior probability that
a document is good decides, instead of all rules having to pass.

* What makes a document bad is a defect that a rule sees: but for a share
  ``MISSED``, bad documents have a bad vote, and how often each rule sees the
  defects of the others is learnt from documents with one.  Votes alone can't
  tell a class of documents without any bad vote from a bad class with few, so
  without this tie EM may take the plain majority for bad.
* Rules are written to be sure of themselves when they vote bad: the rate of
  bad votes on good documents has a beta prior around ``FALSE_ALARM`` that
  weighs as much as ``PRIOR_WEIGHT`` times the corpus, at any size of it.  So
  junk that one rule sees alone goes.
* EM runs twice: from "no bad vote is good", and from the same without the
  rules that vote bad on more than ``SUSPECT`` of what they vote on, whose
  prior then weighs next to nothing.  The fit of greater likelihood is taken:
  a rule that is wrong all over the corpus is found out by its votes.

* The texts are read once for the votes.  What EM iterates over is one row per
  distinct vote pattern, 3^rules at most, whatever the size of the corpus; each
  iteration is one aggregation of these rows to a few dozen sums.
* All figures of a text are computed within its row (arrays and higher-order
  functions); nothing is shuffled but pattern counts.

Cases: null and empty texts have no words, so every count is 0, the base
fails and they are not kept; very long texts cost in proportion to their
length times its logarithm; repeated rows vote alike; an empty table gives an
empty table; extra columns stay untouched.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortproof.llm.columns import SPACES, let, words
from sortproof.session import scratch_path, write_and_read

#: Words of a window that counts as repeated.
REPEAT_WORDS = 8
ITERATIONS = 25
TOLERANCE = 1e-5
#: Share of bad documents that no rule sees.
MISSED = 0.02
#: Beta prior of the rate of bad votes on good documents: its mean, and its weight in corpora.
FALSE_ALARM = 0.002
PRIOR_WEIGHT = 10.0
#: The prior's weight for a rule that is suspected of being wrong.
SUSPECT_WEIGHT = 0.1
#: A rule that votes bad more often than this may be the one that is wrong.
SUSPECT = 0.25
#: The prior's mean and weight for the rate on bad documents.
CAUGHT = 0.3
CAUGHT_WEIGHT = 0.01
KEEP_FROM = 0.5

GOOD, BAD, ABSTAIN = 1, -1, 0


def _repeat_words(w: Column) -> Column:
    """Words inside windows of ``REPEAT_WORDS`` words that occur twice or more in the text."""
    k = REPEAT_WORDS

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(F.lit(k), F.coalesce(F.get(places, i + 1) - p, F.lit(k))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def repeated(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            ordered,
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
                    | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            ),
        )
        return let(F.array_sort(twice), covered)

    def count(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - k), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)])
        )
        return let(
            windows,
            lambda x: F.when(F.size(F.array_distinct(x)) < F.size(x), repeated(x)).otherwise(F.lit(0)),
        )

    return F.when(
        F.size(w) > k, let(F.transform(w, lambda x: F.xxhash64(x)), count)
    ).otherwise(F.lit(0)).cast("long")


def text_figures(text: Column) -> Column:
    """A struct of counts of one text; see the fields."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)

    def left_of(pattern: str) -> Column:
        return F.length(F.regexp_replace(whole, pattern, "")).cast("long")

    of_words = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return F.struct(
        of_words.alias("w"),
        of_lines.alias("l"),
        left_of("[^#*$%&|<>]+").alias("n_symbols"),
        left_of("[^\\p{Lu}]+").alias("n_upper"),
        (F.length(whole) - F.length(F.replace(whole, F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
    )


FIGURES = (
    "n_words", "word_chars", "n_distinct", "n_repeat_words", "n_lines", "n_dup_lines", "n_symbols", "n_upper", "n_shouts",
)


def with_figures(docs: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` and the figures of its texts as columns ``prefix`` + name."""
    f = docs.select("*", text_figures(F.col("text")).alias("__f"))
    where = {"n_words": "w.", "word_chars": "w.", "n_distinct": "w.", "n_repeat_words": "w.", "n_lines": "l.", "n_dup_lines": "l."}
    return f.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        *[F.col(f"__f.{where.get(n, '')}{n}").alias(prefix + n) for n in FIGURES],
    )


@dataclass(frozen=True)
class Rule:
    """Votes bad at ``bad`` or beyond, good at ``good`` or before it, else abstains."""

    name: str
    value: str  # SQL over the figures, n_words > 0
    good: float
    bad: float
    when: str = "true"  # abstains elsewhere

    def vote(self, prefix: str = "") -> Column:
        sql, cond = self.value, self.when
        for n in sorted(FIGURES, key=len, reverse=True):
            sql, cond = sql.replace(f"<{n}>", f"`{prefix}{n}`"), cond.replace(f"<{n}>", f"`{prefix}{n}`")
        value = F.expr(sql)
        rising = self.bad > self.good
        is_bad = value >= self.bad if rising else value <= self.bad
        is_good = value <= self.good if rising else value >= self.good
        return (
            F.when(~F.expr(cond), F.lit(ABSTAIN)).when(is_bad, F.lit(BAD)).when(is_good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))
        )


RULES: tuple[Rule, ...] = (
    Rule("length", "<n_words>", good=50, bad=19),
    Rule("repetition", "<n_repeat_words> / greatest(<n_words>, 1)", good=0.1, bad=0.3),
    Rule("symbols", "<n_symbols> / greatest(<n_words>, 1)", good=0.05, bad=0.25),
    Rule("capitals", "<n_upper> / greatest(<word_chars>, 1)", good=0.15, bad=0.4),
    Rule("shouting", "<n_shouts> / greatest(<n_words>, 1)", good=0.05, bad=0.25),
    Rule("lines", "<n_dup_lines> / greatest(<n_lines>, 1)", good=0.05, bad=0.5, when="<n_lines> >= 3"),
    Rule("word_length", "abs(<word_chars> / greatest(<n_words>, 1) - 6)", good=2.5, bad=4.5),
    Rule("vocabulary", "<n_distinct> / greatest(<n_words>, 1)", good=0.35, bad=0.2, when="<n_words> BETWEEN 30 AND 2000"),
)


@dataclass(frozen=True)
class RuleModel:
    """What EM has found: the share of good documents and, by rule, P(votes bad | votes) on either kind."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def accuracies(self) -> list[float]:
        """Probability that a rule is right on a document of even odds, when it votes."""
        return [(1 - g + b) / 2 for g, b in zip(self.on_good, self.on_bad, strict=True)]

    def weights(self, votes: Sequence[Column]) -> tuple[Column, Column]:
        """How much a good and a bad document with these votes weigh, up to a common factor; abstaining says nothing."""
        good, bad = F.lit(self.prior), F.lit((1 - self.prior) * (1 - MISSED))
        for vote, g, b in zip(votes, self.on_good, self.on_bad, strict=True):
            good = good * F.when(vote == BAD, F.lit(g)).when(vote == GOOD, F.lit(1 - g)).otherwise(F.lit(1.0))
            bad = bad * F.when(vote == BAD, F.lit(b)).when(vote == GOOD, F.lit(1 - b)).otherwise(F.lit(1.0))
        return good, F.when(no_bad_vote(votes), F.lit((1 - self.prior) * MISSED)).otherwise(bad)

    def posterior(self, votes: Sequence[Column]) -> Column:
        """Probability that a document with these votes is good."""
        good, bad = self.weights(votes)
        return good / (good + bad)

    def table(self) -> Column:
        """The same weights as arrays, by 3 * rule + vote + 1; last what they are multiplied with.

        EM evaluates these: as its numbers are in arrays, its query is compiled
        once for all steps.
        """
        good = [x for g in self.on_good for x in (g, 1.0, 1 - g)] + [self.prior]
        bad = [x for b in self.on_bad for x in (b, 1.0, 1 - b)] + [(1 - self.prior) * (1 - MISSED), (1 - self.prior) * MISSED]
        good, bad = (", ".join(f"{x!r}D" for x in xs) for xs in (good, bad))
        return F.expr(f"named_struct('good', array({good}), 'bad', array({bad}))")


def no_bad_vote(votes: Sequence[Column]) -> Column:
    return F.least(F.lit(ABSTAIN), F.lit(ABSTAIN), *votes) > BAD


def _from_sums(sums: Sequence[float], n_rules: int, prior_weights: Sequence[float]) -> RuleModel:
    """The model from expected counts: good and bad documents, then four sums per rule."""
    n_good, n_bad = float(sums[0]), float(sums[1])
    n = max(1.0, n_good + n_bad)
    on_good, on_bad = [], []
    for r in range(n_rules):
        good_bad, good_all, bad_bad, bad_all = (float(x) for x in sums[2 + 4 * r : 6 + 4 * r])
        on_good.append((good_bad + FALSE_ALARM * prior_weights[r] * n) / (good_all + prior_weights[r] * n))
        on_bad.append((bad_bad + CAUGHT * CAUGHT_WEIGHT * n) / (bad_all + CAUGHT_WEIGHT * n))
    return RuleModel((n_good + 1) / (n_good + n_bad + 2), tuple(on_good), tuple(on_bad))


def _step(good: Column, bad: Column, columns: Sequence[Column]) -> list[Column]:
    """The sums that :func:`_from_sums` takes, for documents that are good and bad with these weights."""
    sums = [F.sum(good), F.sum(bad)]
    for c in columns:
        sums += [F.sum(F.when(c == BAD, good)), F.sum(F.when(c != ABSTAIN, good))]
        # the rates of bad documents are learnt where a rule has seen them
        sums += [F.sum(F.when(F.col("__seen") & (c == BAD), bad)), F.sum(F.when(F.col("__seen") & (c != ABSTAIN), bad))]
    return sums


def fit_rules(patterns: DataFrame, votes: Sequence[str], iterations: int = ITERATIONS) -> RuleModel:
    """EM over rows of vote columns and ``n``, from two starts; both take one aggregation per step."""
    columns = [F.col(f"`{v}`") for v in votes]
    n_rules, starts = len(columns), 2
    width = 2 + 4 * n_rules
    shares = patterns.agg(*[
        F.coalesce(F.sum(F.when(c == BAD, F.col("n"))) / F.nullif(F.sum(F.when(c != ABSTAIN, F.col("n"))), F.lit(0)), F.lit(0.0)).alias(f"f{i}")
        for i, c in enumerate(columns)
    ]).first()
    trusted = [c for c, share in zip(columns, shares, strict=True) if share <= SUSPECT]
    prior_weights = [[PRIOR_WEIGHT] * n_rules, [PRIOR_WEIGHT if share <= SUSPECT else SUSPECT_WEIGHT for share in shares]]
    rows = patterns.select(
        *columns, F.col("n").cast("double").alias("__n"), F.array(*columns).alias("__votes"),
        (~no_bad_vote(columns)).alias("__seen"), (~no_bad_vote(trusted)).alias("__seen1"),
    ).withColumn("__seen0", F.col("__seen"))

    def weighed_by(table: Column, first: int) -> Column:
        """Product over the rules of the table's entries for their votes."""
        entries = F.transform(F.col("__votes"), lambda v, r: F.get(table, 3 * r + v + 1))
        return F.aggregate(entries, F.get(table, F.lit(first)), lambda a, x: a * x)

    guessed, weighed, parts, sums = {}, {}, {}, []
    for i in range(starts):
        guessed[f"__good{i}"] = F.when(F.col(f"__seen{i}"), F.lit(0.05)).otherwise(F.lit(0.95))
        guessed[f"__bad{i}"] = F.when(F.col(f"__seen{i}"), F.lit(0.95)).otherwise(F.lit(0.05))
        good, bad = (F.col(f"__table{i}.{k}") for k in ("good", "bad"))
        weighed[f"__good{i}"] = weighed_by(good, 3 * n_rules)
        weighed[f"__bad{i}"] = F.when(F.col("__seen"), weighed_by(bad, 3 * n_rules)).otherwise(F.get(bad, F.lit(3 * n_rules + 1)))
        whole = F.col(f"__good{i}") + F.col(f"__bad{i}")
        parts |= {f"__p{i}": F.col("__n") * F.col(f"__good{i}") / whole, f"__q{i}": F.col("__n") * F.col(f"__bad{i}") / whole,
                  f"__d{i}": F.col("__n") * F.log(whole)}
        sums += [*_step(F.col(f"__p{i}"), F.col(f"__q{i}"), columns), F.sum(f"__d{i}")]
    sums = [F.coalesce(x, F.lit(0.0)).alias(f"s{i}") for i, x in enumerate(sums)]
    models: list[RuleModel] = []
    for step in range(iterations + 1):
        tables = {f"__table{i}": m.table() for i, m in enumerate(models)}
        shared = rows.withColumns(tables).withColumns(weighed) if models else rows.withColumns(guessed)
        row = [float(x) for x in shared.withColumns(parts).agg(*sums).first()]
        sums_of = [row[i * (width + 1) : (i + 1) * (width + 1)] for i in range(starts)]
        new = [_from_sums(p[:width], n_rules, w) for p, w in zip(sums_of, prior_weights, strict=True)]
        if models and (step == iterations or max(_change(a, b) for a, b in zip(models, new, strict=True)) < TOLERANCE):
            likelihood = [p[width] for p in sums_of]
            return models[likelihood.index(max(likelihood))]
        models = new
    raise ValueError("iterations must be positive")


def _change(a: RuleModel, b: RuleModel) -> float:
    pairs = zip((a.prior, *a.on_good, *a.on_bad), (b.prior, *b.on_good, *b.on_bad), strict=True)
    return max(abs(x - y) for x, y in pairs)


def _voted(figures: DataFrame, rules: Sequence[Rule], prefix: str) -> tuple[DataFrame, list[str]]:
    names = [f"__vote_{r.name}" for r in rules]
    return figures.select("*", *[r.vote(prefix).alias(n) for r, n in zip(rules, names, strict=True)]), names


def base_failed(prefix: str = "") -> Column:
    """Too few words, or too many of them in repeated windows."""
    n, repeated = F.col(f"`{prefix}n_words`"), F.col(f"`{prefix}n_repeat_words`")
    return (n < 20) | (100 * repeated > 30 * n)


def _fit(voted: DataFrame, names: list[str]) -> RuleModel:
    patterns = voted.groupBy(*names).agg(F.count("*").alias("n"))
    patterns = write_and_read(patterns, scratch_path(voted.sparkSession, "vote-patterns"))
    return fit_rules(patterns, names)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id``, the figures, ``base_failed``, ``quality`` (posterior) and ``kept`` of every document."""
    figures = with_figures(docs.select("doc_id", "text")).drop("text")
    figures = write_and_read(figures, scratch_path(docs.sparkSession, "text-figures"))  # numbers only
    voted, names = _voted(figures, rules, "")
    model = _fit(voted, names)
    quality = model.posterior([F.col(n) for n in names])
    return voted.select("doc_id", *FIGURES, base_failed().alias("base_failed"), quality.alias("quality")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= keep_from)
    )


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents that are kept, in the columns of ``docs``.

    The figures are computed a second time for the filter, which costs less
    than a join of all texts with their verdicts.
    """
    prefix = "__figure_"
    names = [f"`{c}`" for c in docs.columns]
    sample, votes = _voted(with_figures(docs.select("text"), prefix).drop("text"), rules, prefix)
    model = _fit(sample, votes)
    voted, votes = _voted(with_figures(docs, prefix), rules, prefix)
    quality = model.posterior([F.col(n) for n in votes])
    return voted.where(~base_failed(prefix) & (quality >= keep_from)).select(*names)


def quality_rules_digest(docs: DataFrame) -> DataFrame:
    """The base figures and the verdict per document."""
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )
