"""Line dedup by a log-template tree (DataFrame functions only).

Fixed-depth parsing: a line goes down the tree by its number of tokens and its
first ``depth`` tokens, tokens with a digit read as a variable field.  The
lines of a leaf vote on a template: a position keeps the token that at least
half of the lines have there and is a variable field otherwise.  Lines that
agree with their leaf's template on enough positions form one group; any other
line is grouped with equal lines only.  A group in ``min_docs`` documents or
more recurs: its first document keeps the lines, all later ones drop them.

Only lines in leaves that themselves recur can belong to a recurring group, so
the vote sees a small part of the text.  Counting documents and votes combines
map-side, and what is joined back is written first, so that one very common
line is an AQE-split join and not one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import staged, with_twin

OTHER_SPACES = "\t\v\f\r"  # a line has no line feed
FIELD = "<*>"


def tokens(line: Column) -> Column:
    """Words of a line; words with an ASCII digit are variable fields.  Splitting
    at one plain character costs a fraction of splitting at a pattern."""
    plain = F.when(line.rlike("[\\x09\\x0B-\\x0D]"), F.translate(line, OTHER_SPACES, " " * len(OTHER_SPACES))).otherwise(line)
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    return F.when(line.rlike("[0-9]"), F.transform(words, lambda w: F.when(w.rlike("[0-9]"), FIELD).otherwise(w))).otherwise(words)


def document() -> Column:
    """What names a document and orders it: the id (null last), then the text."""
    doc_id = F.col("doc_id").cast("long")
    return F.struct(doc_id.isNull().alias("last"), doc_id.alias("doc_id"), F.col("_twin").alias("twin"))


def numbered_lines(documents: DataFrame) -> DataFrame:
    return documents.select(document().alias("doc"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _recurring(groups: DataFrame, key: str, min_docs: int) -> DataFrame:
    """Keys in ``min_docs`` documents or more, with the first document."""
    return (groups.select(key, "doc").distinct().groupBy(key)
            .agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first_doc")).filter(F.col("docs") >= min_docs))


def recurring_lines(documents: DataFrame, *, depth: int = 3, similarity: float = 0.8, min_docs: int = 3) -> DataFrame:
    """(doc, line_no) of the lines to drop; ``documents`` has ``_twin``."""
    lines = numbered_lines(documents).withColumn("tokens", tokens(F.col("line"))).drop("line")
    lines = (lines.filter(F.size("tokens") > 0)
             .withColumn("leaf", F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth))))
    leaves = staged(_recurring(lines, "leaf", min_docs).select("leaf"), "line-leaves")
    lines = staged(lines.join(leaves, "leaf", "left_semi"), "line-candidates")

    # One row per (leaf, position): the most frequent token, the smaller one of equals.
    votes = (lines.select("leaf", F.posexplode("tokens").alias("pos", "token"))
             .groupBy("leaf", "pos", "token").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("leaf", "pos").agg(F.sum("n").alias("of"), F.max("n").alias("n"),
                                         F.min(F.struct((-F.col("n")).alias("n"), "token"))["token"].alias("token")))
    kept = F.when(F.col("n") * 2 >= F.col("of"), F.col("token"))
    # A template is as long as a line of its leaf.
    templates = (votes.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("pos", kept.alias("token")))).alias("t"))
                 .select("leaf", F.col("t.token").alias("template")))
    templates = staged(templates, "line-templates")
    agrees = F.zip_with("tokens", "template", lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    share = F.aggregate(agrees, F.lit(0), lambda s, x: s + x) / F.size("tokens")
    joined = lines.join(templates, "leaf")
    grouped = staged(joined.select(
        "doc", "line_no",
        F.when(share >= similarity, F.xxhash64("leaf")).otherwise(F.xxhash64("leaf", "tokens")).alias("grp")), "line-groups")
    recurring = staged(_recurring(grouped, "grp", min_docs).select("grp", "first_doc"), "line-recurring")
    return grouped.join(recurring, "grp").filter("doc > first_doc").select("doc", "line_no")


def drop_recurring_lines(documents: DataFrame, *, depth: int = 3, similarity: float = 0.8, min_docs: int = 3) -> DataFrame:
    """``documents`` with n_lines, n_dropped and kept_text (kept lines joined
    by one line feed) added.

    Lines end at a line feed.  Lines without a token are never dropped.  Null
    text: no lines, kept_text null.  Different texts of one id are documents of
    their own, and so are texts without an id (the last ones in order); equal
    rows are one document, so all of them keep and drop the same lines.  Other
    columns pass through, but for the three added, which replace any of the same
    name (_lines, _dropped, _twin and _doc go, too).  An empty table gives no rows.
    """
    rest = [c for c in documents.columns if c not in ("n_lines", "n_dropped", "kept_text", "_dropped", "_lines", "_twin", "_doc")]
    documents = with_twin(documents.select(*rest), "line-twins")
    dropped = (recurring_lines(documents, depth=depth, similarity=similarity, min_docs=min_docs)
               .groupBy(F.col("doc").alias("_doc")).agg(F.collect_set("line_no").alias("_dropped")))
    rows = documents.select(*rest, F.split("text", "\n").alias("_lines"), document().alias("_doc")).join(dropped, "_doc", "left")
    keep = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_dropped")
    kept = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(F.array_join(F.transform(keep, lambda i: F.get("_lines", i)), "\n"))
    return rows.select(*rest, F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
                       F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text"))
