"""Quality classifier by hierarchical empirical Bayes: document evidence, path and host posteriors.

1. Document evidence: figures of the text fall into bins; labelled documents
   give each bin a log likelihood ratio of good to bad (naive Bayes).  The sum
   is binned once more and calibrated the same way, which undoes the double
   counting of dependent figures.
2. Sites: every document, labelled or not, adds its probability of being good
   to its path and host.  A host's rate is a beta posterior around the global
   rate, a path's rate one around its host's; the strengths of both priors
   are estimated from the spread of the rates (method of moments).  So a site
   with few documents is drawn to its host, and a sparse host to the global
   rate.
3. The posterior of a document has its path's rate for prior and its evidence
   for likelihood.

All of it is grouped aggregation with partial sums and joins of short rows; a
host with a third of all documents is one row per task, and the join that
brings rates back to documents is a sort-merge join that adaptive execution
can split.  The driver sees tables of bins and four sums.

Cases: null and empty texts have figures of 0 and are judged by them; null
ids match no label or page; documents without a page belong to their source
as host and source and language as path (null: empty); repeated rows are
judged alike; without labels every evidence is 0; an empty table gives an
empty table; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortproof.llm.quality_rules import with_figures
from sortproof.session import scratch_path, write_and_read

#: Pseudo-count of a bin, spread like all labelled documents.
SMOOTHING = 2.0
EVIDENCE_BOUND = 20
KEEP_FROM = 0.5
#: Bounds of a prior's strength, in documents.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6

# (bins, SQL of the bin number from 0)
_BINS: tuple[tuple[int, str], ...] = (
    (21, "floor(20 * n_symbols / greatest(n_words, 1))"),
    (11, "floor(10 * n_upper / greatest(word_chars, 1))"),
    (21, "floor(20 * n_shouts / greatest(n_words, 1))"),
    (11, "floor(10 * n_repeat_words / greatest(n_words, 1))"),
    (11, "floor(10 * n_dup_lines / greatest(n_lines, 1))"),
    (11, "floor(10 * n_distinct / greatest(n_words, 1))"),
    (25, "floor(log2(1 + n_words))"),
)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are kept for testing: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _bin(i: int) -> Column:
    n, sql = _BINS[i]
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.expr(sql))).cast("int")


def _ratios(counts: list, bins: int, good: float, bad: float) -> list[float]:
    """Log likelihood ratio of good to bad by bin, from rows ``bin, good, bad``."""
    by_bin = {r["bin"]: (float(r["good"]), float(r["bad"])) for r in counts}
    share = (good + 1) / (good + bad + 2)
    out = []
    for b in range(bins):
        g, x = by_bin.get(b, (0.0, 0.0))
        out.append(math.log(((g + SMOOTHING * share) / (good + 1)) / ((x + SMOOTHING * (1 - share)) / (bad + 1))))
    return out


def _counts(labelled: DataFrame, bin_: Column) -> DataFrame:
    good = F.col("quality") == 1
    return labelled.groupBy(bin_.alias("bin")).agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))


def _lookup(ratios: list[float], bin_: Column) -> Column:
    return F.get(F.array(*map(F.lit, ratios)), bin_)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _evidence(figures: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """Figures with ``evidence`` (calibrated log likelihood ratio); the global rate of good."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = figures.join(known, "doc_id")
    stacked = labelled.select(
        "quality", F.posexplode(F.array(*[_bin(i) for i in range(len(_BINS))])).alias("figure", "bin")
    )
    counts = (
        stacked.groupBy("figure", "bin")
        .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("bad"))
        .collect()  # a row per figure and bin
    )
    good = sum(r["good"] for r in counts if r["figure"] == 0)
    bad = sum(r["bad"] for r in counts if r["figure"] == 0)
    if not good or not bad:
        return figures.withColumn("evidence", F.lit(0.0)), 0.5
    total = F.lit(0.0)
    for i, (n, _) in enumerate(_BINS):
        total = total + _lookup(_ratios([r for r in counts if r["figure"] == i], n, good, bad), _bin(i))
    bound = EVIDENCE_BOUND
    level = (F.greatest(F.lit(-bound), F.least(F.lit(bound), F.round(total))) + bound).cast("int")
    second = _counts(labelled, level).collect()  # 2 * EVIDENCE_BOUND + 1 rows
    calibrated = _lookup(_ratios(second, 2 * bound + 1, good, bad), level)
    return figures.withColumn("evidence", calibrated), good / (good + bad)


def _strength(groups: DataFrame, prior: Column) -> float:
    """Documents that the prior of these groups' rates is worth (method of moments).

    ``groups`` has ``n`` and ``rate``; what their spread around the prior has
    beyond sampling is the variance of a beta distribution.
    """
    spread = F.col("n") * (F.col("rate") - prior) ** 2
    sampling = prior * (1 - prior)
    row = groups.agg(F.sum(spread), F.sum(sampling), F.sum(F.col("n") * sampling), F.sum("n")).first()
    if not row[3]:
        return MOST_STRENGTH
    between = float(row[0] - row[1]) / float(row[3])
    within = float(row[2]) / float(row[3])
    if between <= within / MOST_STRENGTH:
        return MOST_STRENGTH
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, within / between - 1))


def _site_rates(scored: DataFrame, rate: float) -> DataFrame:
    """``host, path, host_rate, path_rate``: posterior means of the rate of good documents."""
    rate = min(1 - 1e-6, max(1e-6, rate))
    paths = write_and_read(
        scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.avg("p").alias("rate")),
        scratch_path(scored.sparkSession, "site-paths"),
    )
    hosts = paths.groupBy("host").agg(
        (F.sum(F.col("n") * F.col("rate")) / F.sum("n")).alias("rate"), F.sum("n").alias("n")
    )
    k = _strength(hosts, F.lit(rate))
    host_rates = hosts.select("host", ((F.col("n") * F.col("rate") + k * rate) / (F.col("n") + k)).alias("host_rate"))
    joined = paths.join(host_rates, "host")
    j = _strength(joined, F.col("host_rate"))
    path_rate = (F.col("n") * F.col("rate") + j * F.col("host_rate")) / (F.col("n") + j)
    return joined.select("host", "path", "host_rate", path_rate.alias("path_rate"))


def site_of(url: Column) -> tuple[Column, Column]:
    """(host without a leading www., host and first part of the path) of an address."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, "^[A-Za-z]+://([^/?#]*)", 1)), "^www\\.", "")
    return host, F.concat(host, F.lit("/"), F.regexp_extract(url, "^[A-Za-z]+://[^/?#]*/([^/?#]*)", 1))


def classify_quality(docs: DataFrame, labels: DataFrame, pages: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id, host, path, evidence, host_rate, path_rate, score, kept`` of every document.

    ``docs`` has ``doc_id, text, source, lang``, ``labels`` ``doc_id, quality``
    (1 good, 0 bad) and ``pages`` ``doc_id, url``.
    """
    host, path = site_of(F.col("url"))
    sites = pages.where(F.col("doc_id").isNotNull() & F.col("url").isNotNull()).groupBy("doc_id").agg(F.min("url").alias("url"))
    sites = sites.select("doc_id", host.alias("__host"), path.alias("__path"))
    figures = with_figures(docs.select("doc_id", "text", "source", "lang")).drop("text")
    source, lang = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang"))
    figures = figures.join(sites, "doc_id", "left").withColumns(
        {
            "host": F.coalesce("__host", source),
            "path": F.coalesce("__path", F.concat(source, F.lit("/"), lang)),
        }
    ).drop("__host", "__path", "source", "lang")
    figures = write_and_read(figures, scratch_path(docs.sparkSession, "site-figures"))
    judged, rate = _evidence(figures, labels.select("doc_id", "quality"))
    prior = math.log(rate / (1 - rate)) if 0 < rate < 1 else 0.0
    scored = judged.select(
        "doc_id", "host", "path", "evidence", (1 / (1 + F.exp(-(F.col("evidence") + prior)))).alias("p")
    )
    rates = _site_rates(scored, rate)
    odds = F.col("evidence") + _logit(F.col("path_rate"))
    return (
        scored.join(rates, ["host", "path"])
        .withColumn("score", 1 / (1 + F.exp(-odds)))
        .select(
            "doc_id", "host", "path", "evidence", "host_rate", "path_rate", "score",
            (F.col("score") >= keep_from).alias("kept"),
        )
    )


def site_quality_digest(docs: DataFrame, labels: DataFrame, pages: DataFrame) -> DataFrame:
    """Per document: its site's rates, its score, the verdict, and whether its label was kept for testing."""
    addresses = pages.select(
        F.expr("try_cast(regexp_extract(url, '^[A-Za-z]+://[^/]+/[^/]+/([0-9]+)', 1) as bigint)").alias("doc_id"), "url"
    )
    return classify_quality(docs, labels, addresses).select(
        "doc_id", "host_rate", "path_rate", "score", "kept", held_out(F.col("doc_id")).alias("held_out")
    )
