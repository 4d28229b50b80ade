"""Benchmark decontamination by spaced-seed hashing (DataFrame functions only).

A seed is a hash of the tokens at a mask's positions; the mask ``SPACED`` takes
three of four tokens and ignores the third.  Substitutions spoil at most three
places of that mask each, so a stretch of ``n`` tokens with ``e`` of them
substituted keeps a whole seed if ``n - 3 > 3 e``, wherever they are: true of
all stretches here.  Insertions and deletions leave runs of equal tokens; the
longest has a known least length, and a run of four holds the mask.  Items
whose runs may be shorter get seeds of that many consecutive tokens besides.

Seeds of the benchmark are joined with the seeds of every document position.
A hit aligns item and document, and is verified on a bounded neighbourhood of
both, token by token, and with the alignments a few tokens beside it: documents
that share some stretch of ``window`` tokens (the whole item if it is shorter)
with edits of at most a fifth of them are leaks, and with ``verbatim`` also
those that quote so many consecutive tokens.  Hits that follow each other on
one alignment are verified once, at the first.

Up to ``MAX_SEEDS`` benchmark seeds are literals, so only positions that hit
leave a document's row, and the seeds with their neighbourhoods are broadcast.
More seeds are joined by a shuffle of narrow rows (row, position, seed); the
hits then meet their documents again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, stage, text_or_empty

#: Positions that masks compare, by number: the spaced mask, and runs for items whose edits may leave no run of four.
SPACED = (0, 1, 3)
MASKS = {0: SPACED, 1: (0,), 2: (0, 1), 3: (0, 1, 2)}
#: Items of fewer tokens match verbatim only.
SPAN = 8
#: Benchmark seeds that become literals and are broadcast (about 0.7 KB each with their neighbourhood).
MAX_SEEDS = 50_000


def _token_hashes(text: Column) -> Column:
    return F.transform(alnum_words(text), lambda w: F.xxhash64(w))


def span_of(mask: int) -> int:
    return MASKS[mask][-1] + 1


def _seed(mask: int, i: Column) -> Column:
    return F.xxhash64(F.lit(mask), *[F.get(F.col("hashes"), i + k) for k in MASKS[mask]])


def _around(at: Column, reach: int) -> Column:
    """The tokens from ``reach`` before a position to ``reach`` after it; null beyond the ends."""
    return F.transform(F.sequence(F.lit(-reach), F.lit(reach - 1)), lambda k: F.get(F.col("hashes"), at + k))


def _items(benchmark: DataFrame, item_col: str, text_col: str, window: int, max_substituted: float,
           verbatim: int | None, reach: int) -> DataFrame:
    """A row per seed of an item: (item, size, width, needed, quote, mask, item_at, seed, item_near): the tokens of the
    item, of a stretch, of those that must be equal, of a quote that is a leak by itself, and the seed's place."""
    items = benchmark.select(F.col(item_col).alias("item"), _token_hashes(text_or_empty(text_col)).alias("hashes"))
    items = items.withColumn("size", F.size("hashes")).where(F.col("size") >= (1 if verbatim else SPAN)).distinct()
    items = items.withColumn("width", F.least(F.lit(window), "size"))
    least = F.ceil(F.col("width") * F.lit(1 - max_substituted) - F.lit(1e-9)).cast("int")
    items = items.withColumn("needed", F.when(F.col("size") >= SPAN, least).otherwise(F.col("width")))
    items = items.withColumn("quote", F.least(F.lit(verbatim), "size") if verbatim else F.lit(1 << 30))
    run = F.least(F.ceil(F.col("needed") / (F.col("width") - F.col("needed") + 1)).cast("int"), "quote")
    spaced = (F.col("size") >= SPAN) | (run >= span_of(0))

    def seeds(mask: int, used: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.col("size") - 1), lambda i: i + span_of(mask) <= F.col("size"))
        made = F.transform(places, lambda i: F.struct(F.lit(mask).alias("mask"), i.alias("item_at"), _seed(mask, i).alias("seed"),
                                                      _around(i, reach).alias("item_near")))
        return F.when(used, made)

    every = [seeds(0, spaced), *[seeds(k, run == k) for k in (1, 2, 3)]]
    made = F.flatten(F.array_compact(F.array(*every)))
    return items.select("item", "size", "width", "needed", "quote", F.inline(made))


def _fewest_edits(first: Column, last: Column, allowed: Column, reach: int) -> Column:
    """The fewest edits that turn a stretch of the item, begun at a token from ``first`` to ``last`` (counted from the
    hit), into some stretch of the document, on the alignments up to ``allowed`` tokens beside the hit's."""
    beside = F.sequence(F.lit(0), allowed * 2)

    def cell(old: Column, k: Column, new: Column, e: Column) -> Column:
        same = F.get("near", F.lit(reach) + k - allowed + e) == F.get("item_near", F.lit(reach) + k)
        cost = F.when(same, F.lit(0)).otherwise(F.lit(1))
        # Equal or substituted; the item's token deleted; a token of the document inserted.
        return F.least(F.get(old, e) + cost, F.get(old, e + 1) + 1, F.get(new, e - 1) + 1)

    def after(old: Column, k: Column) -> Column:
        return F.aggregate(beside, F.array().cast("array<int>"),
                           lambda new, e: F.concat(new, F.array(cell(old, k, new, e))))

    def edits(start: Column) -> Column:
        free = F.array_repeat(F.lit(0), allowed * 2 + 1)
        return F.array_min(F.aggregate(F.sequence(start, start + F.col("width") - 1), free, after))

    return F.array_min(F.transform(F.sequence(first, last), edits))


def _hits(docs: DataFrame, seeds: DataFrame, id_col: str, text_col: str, reach: int) -> tuple[DataFrame, bool]:
    """(id, at, seed, near) of every document position whose seed some item has, and whether the seeds are few."""
    source = docs.select(F.col(id_col).alias("id"), _token_hashes(text_or_empty(text_col)).alias("hashes"))
    known = seeds.select("mask", "seed").distinct().limit(MAX_SEEDS + 1).collect()
    few = len(known) <= MAX_SEEDS
    masks = sorted({r["mask"] for r in (known if few else seeds.select("mask").distinct().collect())})
    if few:
        def found(mask: int) -> Column:
            wanted = [r["seed"] for r in known if r["mask"] == mask]

            def place(_: Column, i: Column) -> Column:
                seed = _seed(mask, i)
                return F.when(seed.isin(wanted), F.struct(i.alias("at"), seed.alias("seed")))

            return F.transform("hashes", place)

        none = F.array().cast("array<struct<at:int,seed:bigint>>")
        source = source.withColumn("hits", F.array_compact(F.concat(none, *[found(m) for m in masks])))
    else:
        source = stage(source.withColumn("row", F.monotonically_increasing_id()), "leak-tokens")

        def all_of(mask: int) -> Column:
            return F.transform("hashes", lambda _, i: F.struct(i.alias("at"), _seed(mask, i).alias("seed")))

        every = F.concat(F.array().cast("array<struct<at:int,seed:bigint>>"), *[all_of(m) for m in masks])
        narrow = source.select("row", F.inline(every)).join(seeds.select("seed").distinct(), "seed")
        hits = narrow.groupBy("row").agg(F.collect_list(F.struct("at", "seed")).alias("hits"))
        source = source.join(hits, "row")
    near = F.transform("hits", lambda x: F.struct(x["at"].alias("at"), x["seed"].alias("seed"), _around(x["at"], reach).alias("near")))
    # explode_outer: explode would add a filter on the array and so compute it twice.
    each = source.select("id", F.explode_outer(near).alias("hit")).where(F.col("hit").isNotNull())
    return each.select("id", "hit.*"), few


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", window: int = 24,
          max_substituted: float = 0.2, verbatim: int | None = None) -> DataFrame:
    """(id, item, window_tokens, matched_tokens, doc_token): a row per leaked item and document.

    ``doc_token`` is the position of the aligned item's first token in the
    document (negative if the document starts within the item), matched_tokens
    the most equal tokens in a window of window_tokens of that alignment, or if
    those are too few window_tokens less the fewest edits beside it.

    With ``verbatim`` a document that holds so many consecutive tokens of an
    item (all of a shorter one, however short) is a leak too; without it, items
    of under eight tokens never match.

    Tokens are lower-cased runs of letters and digits.  Null texts are empty.
    Repeated rows of a document or an item count once.  Null ids are an id of
    their own.  An empty side gives no rows.  Other columns are ignored.
    Texts of any length are searched whole, in time that grows with it.
    """
    beside = int(window * max_substituted) + 1
    reach = max(window + beside, verbatim or 0) + span_of(0)
    seeds = _items(benchmark, item_col, item_text_col, window, max_substituted, verbatim, reach)
    found, few = _hits(docs, seeds, id_col, text_col, reach)
    hits = found.join(F.broadcast(seeds) if few else seeds, "seed")
    equal = F.transform("item_near", lambda h, i: F.coalesce(F.get("near", i) == h, F.lit(False)).cast("int"))
    hits = hits.withColumn("equal", equal)

    def same(k: int) -> Column:
        return F.get("equal", F.lit(reach + k)) == 1

    # A hit one token before this one stands for it.
    earlier = F.lit(False)
    for mask, places in MASKS.items():
        before = F.col("mask") == mask
        for k in places:
            before = before & same(k - 1)
        earlier = earlier | before
    hits = hits.where(~earlier)
    span = F.coalesce(*[F.when(F.col("mask") == mask, span_of(mask)) for mask in MASKS])
    first, last = F.greatest(-F.col("item_at"), span - F.col("width")), F.least(F.lit(0), F.col("size") - F.col("width") - F.col("item_at"))
    reached = F.slice("equal", F.lit(reach + 1) + first, last - first + F.col("width"))
    total = F.aggregate(reached, F.lit(0), lambda a, b: a + b)
    sums = F.transform(F.sequence(first, last), lambda s: F.aggregate(
        F.slice("equal", F.lit(reach + 1) + s, F.col("width")), F.lit(0), lambda a, b: a + b))
    ahead = F.slice("equal", reach + 1, reach)
    end = F.array_position(ahead, 0).cast("int")
    hits = hits.withColumns({"run": F.when(end > 0, end - 1).otherwise(F.lit(reach)),
                             "matched": F.when(total >= F.col("needed"), F.array_max(sums)).otherwise(total)})
    # Only where enough of the item's tokens around the hit are near it in the document are edits counted.
    allowed = F.col("width") - F.col("needed")
    close = F.slice("near", F.lit(reach + 1) + first - allowed, last - first + F.col("width") + 2 * allowed)
    around = F.slice("item_near", F.lit(reach + 1) + first, last - first + F.col("width"))
    enough = F.size(F.filter(around, lambda h: F.array_contains(close, h))) >= F.col("needed")
    edited = F.when((allowed > 0) & (F.col("matched") < F.col("needed")) & enough,
                    F.col("width") - _fewest_edits(first, last, allowed, reach))
    hits = hits.select("id", "item", (F.col("at") - F.col("item_at")).alias("begin"), "width", "needed", "quote", "run",
                       F.greatest("matched", edited).alias("matched"))
    verified = hits.where((F.col("matched") >= F.col("needed")) | (F.col("run") >= F.col("quote")))
    best = F.max(F.struct("matched", -F.col("begin"))).alias("best")
    return verified.groupBy("id", "item").agg(best, F.first("width").alias("width")).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("width").alias("window_tokens"),
        F.col("best.matched").alias("matched_tokens"), (-F.col("best")[F.lit("col2")]).alias("doc_token"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns stay."""
    bad = leaks(docs, benchmark, id_col=id_col, **options).select(F.col(id_col).alias("leaked_id")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["leaked_id"]), "left_anti")
