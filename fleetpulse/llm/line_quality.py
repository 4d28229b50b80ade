"""Quality rules from cross-document line frequency (DataFrame functions only).

Lines are normalised (lower case, digits as 0, white space as one space) and
hashed with their host.  A line that more than ``max_docs`` documents and more
than ``max_percent`` of all documents of one host hold is removed from all of
them; a document that loses more than a share of its words, or keeps too few,
is rejected.  Rules on the text itself (too few words, too many repeated
three-word windows) reject a document before.

Texts are read once: a row's measures and its lines' hashes and word counts
are written to the checkpoint folder, and everything after works on these.
Each document counts a line once, before anything is shuffled; the shuffle
carries a hash and a count per line and task.  The lines above the limit are
broadcast behind a check of their number, else joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, stage, text_or_empty

#: Lines above the limit that are broadcast (8 bytes each and their table).
MAX_BROADCAST_LINES = 500_000
SYMBOLS = "[#*$%&|<>]"
SPACES = r"[\x20\x09-\x0D]+"
#: Up to so many different repeated windows of a text are looked up one by one.
FEW_REPEATED = 64


def with_base(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` and the columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long).

    n_repeat_words: words inside three-word windows that occur twice or more,
    the first occurrence included.
    """
    text = text_or_empty(text_col)
    blank = F.lit("")
    df = docs.withColumn("_words", F.array_remove(F.split(text, SPACES), ""))
    with_word = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(ASCII_SPACE)) != blank)
    starts = F.greatest(F.size("_words") - 2, F.lit(0))
    windows = F.transform(F.slice("_words", F.lit(1), starts), lambda w, i: F.xxhash64(
        w, F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2)))
    df = df.withColumns({
        "_windows": windows,
        "_lines": with_word,
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
    })
    # Only where some window repeats: the hashes that do, and the positions that hold one of them.
    ordered = F.sort_array("_windows")
    df = df.withColumn("_ordered", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), ordered))
    again = F.array_distinct(F.filter("_ordered", lambda h, k: h == F.get("_ordered", k - 1)))
    df = df.withColumn("_again", again)
    places = F.array_compact(F.transform("_windows", lambda h, i: F.when(F.array_contains("_again", h), i)))
    # Many repeated hashes are found by sorting (hash, position) instead, not one by one.
    pairs = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    beside = F.transform(F.array(pairs), lambda p: F.array_sort(F.array_compact(F.transform(p, lambda x, k: F.when(
        F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)), x["i"])))))[0]
    df = df.withColumn("_places", F.when(F.size("_again") <= FEW_REPEATED, places).when(F.size("_again") > FEW_REPEATED, beside))
    # Each repeated window adds what the one before it doesn't cover.
    added = F.transform("_places", lambda p, k: F.when(k == 0, F.lit(3)).otherwise(
        F.least(F.lit(3), p - F.get("_places", k - 1))))
    total = F.aggregate(added, F.lit(0), lambda a, b: a + b)
    return df.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(total, F.lit(0)).cast("long"),
    }).drop("_words", "_windows", "_lines", "_ordered", "_again", "_places")


def _lines(text: Column, host: Column, with_text: bool) -> Column:
    """Of each line: its key (null if it has no word), its words, and the line itself if ``with_text``."""
    def normal(line: Column) -> Column:
        return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), SPACES, " "))

    def parts(both: Column) -> Column:
        # In a normal form each space ends a word.
        form = both["form"]
        worded = form != F.lit("")
        fields = [F.when(worded, F.xxhash64(host, form)).alias("key"),
                  F.when(worded, F.regexp_count(form, F.lit(" ")) + 1).otherwise(0).alias("words")]
        return F.struct(*fields, *([both["line"].alias("line")] if with_text else []))

    # Two steps, so that a line is normalised once and not at each use.
    return F.transform(F.transform(F.split(text, "\n"), lambda line: F.struct(line.alias("line"), normal(line).alias("form"))), parts)


def frequent_lines(measured: DataFrame, max_docs: int, max_percent: int) -> DataFrame:
    """(key): hashes of a host and a line that more than ``max_docs`` rows, and ``max_percent`` of the host's, hold."""
    keys = F.array_distinct(F.transform("lines", lambda x: x["key"]))
    each = measured.select("host", F.explode(keys).alias("key")).where(F.col("key").isNotNull())
    many = stage(each.groupBy("key", "host").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > max_docs), "common-lines")
    hosts = stage(measured.groupBy("host").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > max_docs), "hosts")
    if hosts.count() <= MAX_BROADCAST_LINES:
        hosts = F.broadcast(hosts)
    return many.join(hosts, "host").where(100 * F.col("held") > max_percent * F.col("docs")).select("key")


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               max_docs: int = 4, max_percent: int = 2, min_words: int = 50, max_repeat_percent: int = 50,
               max_removed_percent: int = 50, with_text: bool = False) -> DataFrame:
    """A row per row of ``docs``: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    removed_words, removed_lines, base_failed, kept, and ``text`` without the removed lines if
    ``with_text``.

    A row is a document: repeated rows count as documents of their own.  Null
    texts are empty and fail (too few words); a null host is the host with the
    empty name; null ids pass through.  Blank lines are never removed or
    counted.  An empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("string").alias("text"),
                         F.xxhash64(F.coalesce(F.col(host_col).cast("string"), F.lit(""))).alias("host"))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    lines = _lines(F.col("text"), F.col("host"), with_text).alias("lines")
    measured = stage(with_base(source).select(F.monotonically_increasing_id().alias("row"), "id", "host", *measures, lines), "lines")
    frequent = stage(frequent_lines(measured, max_docs, max_percent), "frequent-lines")
    if frequent.count() <= MAX_BROADCAST_LINES:
        frequent = F.broadcast(frequent)
    each = measured.select("row", "id", *measures, F.posexplode("lines").alias("at", "part")).select("row", "id", *measures, "at", "part.*")
    gone = F.col("hot").isNotNull()
    joined = each.join(frequent.withColumnRenamed("key", "hot"), F.col("key") == F.col("hot"), "left")
    sums = [F.sum(F.when(gone, F.col("words")).otherwise(0)).alias("removed_words"),
            F.sum(gone.cast("long")).alias("removed_lines")]
    if with_text:
        left = F.array_sort(F.collect_list(F.when(~gone, F.struct("at", "line"))))
        sums.append(F.array_join(F.transform(left, lambda x: x["line"]), "\n").alias("text"))
    out = joined.groupBy("row", "id", *measures).agg(*sums).drop("row")
    few = F.col("n_words") < min_words
    failed = few | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    left_words = F.col("n_words") - F.col("removed_words")
    depleted = (left_words < min_words) | (100 * F.col("removed_words") > max_removed_percent * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~(failed | depleted))
    return out.withColumnRenamed("id", id_col)
