"""Line de-duplication: lines found in many documents go, by hash counts and positions.

Method: explode normalised lines, hash them, count distinct documents per
hash, drop the lines whose count reaches the threshold, and put the rest
together again by position.

* Only 16-byte hashes and positions are shuffled for the counts; a line that
  stands in a third of all documents is first reduced per task.
* The join of lines with the frequent hashes is salted by document: the
  frequent ones, a tenth of all lines at most, come ``SALTS`` times.  What is
  still too large for a task, adaptive execution can split.
* Each document's dropped positions come back as one sorted array (bounded by
  its own number of lines) and its kept lines are cut out as slices between
  them: linear in the text.

Cases: a null or empty text is one empty line; a line whose key is empty
never counts and is never dropped; repeated rows (same id and text) are one
document; rows without an id are told apart by their texts; an empty table
gives an empty table; columns other than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortproof.llm.columns import SPACES, let, row_identity
from sortproof.session import scratch_path, write_and_read

#: Parts that the occurrences of one line are dealt into for the join.
SALTS = 16

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_lines(text: Column) -> Column:
    """All lines of a text, split at line feeds; null or empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line stripped of white space at both ends, ASCII letters in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), _UPPER, _UPPER.lower())


def frequent_line_positions(
    docs: DataFrame, min_docs: int = 10, min_key_chars: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Positions of the lines to drop: ``_id, _t, drop`` (sorted array of line numbers from 0)."""
    keyed = (
        docs.select(*row_identity(doc_id, text), F.posexplode(split_lines(F.col(text))).alias("pos", "line"))
        .select("_id", "_t", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= max(1, min_key_chars))
        .select("_id", "_t", "pos", F.unhex(F.md5("key")).alias("h"))
    )
    # read twice, so written once: normalising and hashing all lines is the dear part
    keyed = write_and_read(keyed, scratch_path(docs.sparkSession, "line-hashes"))
    frequent = (
        keyed.groupBy("h", "_id", "_t").agg(F.lit(1).alias("one"))
        .groupBy("h").agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_docs)
        .select("h")
    )
    # a very common line would meet its occurrences in one task: both sides are salted
    frequent = frequent.select("h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("_id", "_t"), F.lit(SALTS)).cast("int"))
    hits = salted.join(frequent, ["h", "salt"], "left_semi")
    return hits.groupBy("_id", "_t").agg(F.array_sort(F.collect_set("pos")).alias("drop"))


def _kept_text(lines: Column, drop: Column) -> Column:
    """Lines outside ``drop`` joined by line feeds: the slices between dropped positions."""
    bounds = F.concat(F.array(F.lit(-1)), drop, F.array(F.size(lines)))
    return let(
        F.struct(lines.alias("l"), bounds.alias("b")),
        lambda s: F.array_join(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(1), F.size(s["b"]) - 1),
                    lambda i: F.slice(
                        s["l"], F.get(s["b"], i - 1) + 2, F.get(s["b"], i) - F.get(s["b"], i - 1) - 1
                    ),
                )
            ),
            "\n",
        ),
    )


def drop_frequent_lines(
    docs: DataFrame, min_docs: int = 10, min_key_chars: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with every column, plus ``__ld_lines``, ``__ld_dropped``, ``__ld_kept`` (the remaining text).

    Lines whose key has at least ``min_key_chars`` characters and stands in
    at least ``min_docs`` documents lose all their occurrences.
    """
    own = ["__ld_id", "__ld_t", "__ld_drop"]  # names that no table is likely to have
    drops = frequent_line_positions(docs, min_docs, min_key_chars, doc_id, text).toDF(*own)
    ident = [c.alias(n) for c, n in zip(row_identity(doc_id, text), own, strict=False)]
    joined = docs.select("*", *ident).join(drops, own[:2], "left")
    lines, drop = split_lines(F.col(text)), F.col(own[2])
    kept = F.when(drop.isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(_kept_text(lines, drop))
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size(lines).cast("long").alias("__ld_lines"),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("__ld_dropped"),
        kept.alias("__ld_kept"),
    )


def remove_frequent_lines(docs: DataFrame, min_docs: int = 10, min_key_chars: int = 1) -> DataFrame:
    """The documents with their frequent lines removed; rows and columns as given.

    A document that loses no line keeps its text unchanged (a null stays null).
    """
    out = drop_frequent_lines(docs, min_docs, min_key_chars)
    return out.select(
        *[
            F.when(F.col("__ld_dropped") > 0, F.col("__ld_kept")).otherwise(F.col("text")).alias("text")
            if c == "text" else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """Digest of the operator's result per document: counts and the hash of the kept text."""
    return drop_frequent_lines(docs.select("doc_id", "text")).select(
        "doc_id",
        F.col("__ld_lines").alias("n_lines"),
        F.col("__ld_dropped").alias("n_dropped"),
        F.sha2("__ld_kept", 256).alias("kept_sha256"),
    )


LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, pos, string_split(coalesce(text, ''), chr(10))[pos] AS line
  FROM documents, LATERAL (SELECT unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS pos)
), keyed AS (
  SELECT doc_id, text, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key FROM (SELECT DISTINCT doc_id, text, key FROM keyed WHERE length(key) >= 1)
  GROUP BY key HAVING count(*) >= 10
), marked AS (
  SELECT k.*, f.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
