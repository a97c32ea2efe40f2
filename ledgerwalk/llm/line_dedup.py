"""Line dedup: drop lines that many documents share, natively in DataFrame expressions.

Lines are exploded, normalised and hashed; distinct documents are counted per hash;
lines over the threshold go from every document but one; what stays is put together
again by position. Only hashes and positions are shuffled for the counts, the texts
move once, to meet the positions they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, ascii_lower, hash128, store


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def without_lines(text: Column, drop: Column) -> Column:
    """The lines of ``text`` but those at the positions in ``drop`` (from 0, distinct): the runs
    of lines between dropped ones, put together again. Linear in the lines: the text is
    split once, since the outer lambda binds its lines, and each run is one slice."""
    def rebuilt(lines: Column) -> Column:
        gone = F.array_sort(drop)
        before, after = F.concat(F.array(F.lit(-1)), gone), F.concat(gone, F.array(F.size(lines)))
        edges = F.arrays_zip(before.alias("before"), after.alias("after"))
        runs = F.filter(edges, lambda e: e["after"] - e["before"] > 1)
        return F.array_join(F.flatten(F.transform(runs, lambda e: F.slice(
            lines, e["before"] + 2, e["after"] - e["before"] - 1))), "\n")

    return F.get(F.transform(F.array(F.split(text, "\n")), rebuilt), F.lit(0))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per input row: ``id``, ``text`` (lines dropped), ``n_lines``, ``n_dropped``
    and ``row``, a struct of the input's other columns (so that no name can clash).

    A key of at least ``min_chars`` code points found in at least ``min_docs`` distinct
    ids loses all its lines, except in the largest id that holds it.

    * null or empty text: one empty line; the text comes back as ''.
    * null id: its lines don't count as a document and it is never the largest id, so
      it loses the shared lines.
    * repeated rows of one id are one document; each row comes back, each with the same
      decisions. A line that stands more than once in the keeper stays as often.
    * a document that loses every line stays, with the text ''. Empty table: no rows.
    * a document of very many lines costs time in proportion to them.
    * a very frequent line is counted with map-side combine. The shared lines are stored
      before they are joined: Spark then broadcasts them if their size allows, and can
      split the join at a frequent line if not.
    """
    rest = [F.col(c) for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        (F.struct(*rest) if rest else F.lit(None).cast("struct<none:int>")).alias("row"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    lines = rows.select("id", "text_hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    lines = store(lines.where(F.char_length("key") >= min_chars)
                  .select("id", "text_hash", "pos", *hash128(F.col("key"))), "line-hashes")

    shared = store(lines.groupBy("h1", "h2")
                   .agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper"))
                   .where(F.col("n") >= min_docs).select("h1", "h2", "keeper"), "shared-lines")
    drops = (lines.join(shared, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
             .groupBy(F.col("id").alias("drop_id"), F.col("text_hash").alias("drop_hash"))
             .agg(F.collect_set("pos").alias("drop")))
    out = rows.join(drops, F.col("id").eqNullSafe(F.col("drop_id"))
                    & (F.col("text_hash") == F.col("drop_hash")), "left")
    n_lines = F.size(F.split("text", "\n"))
    return out.select(
        "id", F.when(F.col("drop").isNull(), F.col("text")).otherwise(without_lines(F.col("text"), F.col("drop"))).alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), "row")


def line_dedup_report(docs: DataFrame) -> DataFrame:
    """The contract's digest of ``dedup_lines`` over ``documents``."""
    d = dedup_lines(docs.select("doc_id", "text"))
    return d.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped",
                    F.sha2(F.col("text"), 256).alias("kept_sha256"))


#: Blanks, then A-Z and a-z, as in the contract.
LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.*, (keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper) AS gone
  FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
