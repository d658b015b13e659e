"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets. Sources share the total of all sizes by weight; none gets more than
   ``cap`` times its own size, and what is above is shared again by weight. The
   fixed point is found in closed form from running sums over the sources.
2. Blocks. A source's documents lie in the order of a seeded hash and are cut into
   blocks of about ``block_rows`` documents (fewer in small sources, so that there is
   something to draw). A source has one ticket a block for each of its ``floor(target /
   size)`` whole passes, and, if its target isn't reached by these, for one last pass.
3. Tree. The tickets of all sources are split between the two halves of the output
   shards again and again. At each node the numbers of tickets that go left are one
   multivariate-hypergeometric draw: source by source a hypergeometric number, given
   the room and the tickets that are left. Leaves hold exact quotas that add up to each
   source's tickets.
4. Deal. A source's blocks in a permuted order go to the shards by quota, so shards hold
   disjoint blocks of a pass. Of a whole pass's blocks a shard takes everything. The rest
   of a source's target is shared by its shards in proportion to the words of the last
   pass's blocks that they have drawn; each takes documents of these blocks, in a permuted
   order of its own, as far as its share goes. So the tree decides which documents are
   in the mix. What is then still missing, less than a document a shard, is filled from
   the others by ascending size until none fits, and the next one is added if that comes
   nearer to the target.
5. Rows are shuffled inside their shard by a hash.

DataFrame operations only. Only tables of sources and of blocks (a thousandth of the
rows) are sorted by source; documents meet their block by one shuffle on (source, block).
One row holds all sources of a tree's node, and targets are found in one sort of the
sources: there may be millions of documents a source, but not millions of sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_checked, table, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Sources up to this number are joined by broadcast, more by shuffle.
SMALL = 10_000
#: Standard deviations (and whole numbers beyond) to each side that a hypergeometric draw looks at.
SPREAD = 12


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = 3.0) -> DataFrame:
    """(source, n, words) -> source, n, words, number (0, 1, ... by code point, null last), target.

    Sources that stay under their cap share what the others leave in proportion to
    weight. In ascending order of cap / weight the capped ones come first, so each
    source's level, if all before it are capped, tells whether it is capped itself.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    t = sizes.withColumn("number", F.row_number().over(order) - 1)
    t = t.withColumn("weight", F.element_at(w, (F.col("number") % len(weights) + 1).cast("int"))).withColumn("most", F.col("words") * F.lit(float(cap)))
    ranked = Window.orderBy(F.col("most") / F.col("weight"), "number")
    before, rest, everything = ranked.rowsBetween(Window.unboundedPreceding, -1), ranked.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    left = F.sum("words").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    t = t.withColumn("level", left / F.sum("weight").over(rest))
    free = F.when(F.col("most") > F.col("level") * F.col("weight"), F.struct(F.row_number().over(ranked).alias("rank"), "level"))
    t = t.withColumn("level", F.min(free).over(everything)["level"])  # the first that isn't capped
    target = F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return t.select("source", "n", "words", "number", target.alias("target"))


def _chance(*parts: Column) -> Column:
    """In [0, 1), from the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def split_tickets(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(number, tickets) of each source -> number, shard, quota: the leaves of the splitting tree."""
    if shards & (shards - 1) or shards < 1:
        raise ValueError("shards must be a power of two")
    root = quotas.agg(F.sort_array(F.collect_list(F.struct("number", F.col("tickets").cast("long").alias("q")))).alias("quota"))
    nodes = root.select(F.lit(0).alias("node"), F.lit(shards).alias("width"), "quota")
    while shards > 1:
        total = F.aggregate("quota", F.lit(0).cast("long"), lambda a, x: a + x["q"])
        nodes = nodes.withColumn("total", total)
        nodes = nodes.withColumn("left", _drawn(seed))
        shards //= 2
        pairs = F.arrays_zip("quota", "left")
        keep = F.transform(pairs, lambda p: F.struct(p["quota"]["number"].alias("number"), p["left"].alias("q")))
        give = F.transform(pairs, lambda p: F.struct(p["quota"]["number"].alias("number"), (p["quota"]["q"] - p["left"]).alias("q")))
        halves = F.array(F.struct((F.col("node") * 2).alias("node"), keep.alias("quota")), F.struct((F.col("node") * 2 + 1).alias("node"), give.alias("quota")))
        nodes = nodes.select(F.explode(halves).alias("h"), F.lit(shards).alias("width")).select("h.node", "width", "h.quota")
    return nodes.select(F.col("node").alias("shard"), F.explode("quota").alias("x")).select("x.number", "shard", F.col("x.q").alias("quota"))


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """Of ``drawn`` things out of ``total``, how many of the ``marked`` ones, at the quantile u in [0, 1).

    Chances are summed upwards from ``SPREAD`` standard deviations below the mean, each by its ratio
    to the one before; beyond these there is less than a double can hold.
    """
    n, k, d = (c.cast("double") for c in (total, marked, drawn))
    mean = F.when(n > 0, d * k / n).otherwise(0.0)
    spread = F.sqrt(F.when(n > 1, mean * (n - k) / n * (n - d) / (n - 1)).otherwise(0.0))
    reach = SPREAD * spread + SPREAD
    low = F.greatest(F.lit(0.0), d - (n - k), F.ceil(mean - reach).cast("double"))
    high = F.least(d, k, F.floor(mean + reach).cast("double"))
    steps = F.sequence(low.cast("long"), F.greatest(low, high).cast("long"))

    def ratio(i: Column) -> Column:
        """The chance of i + 1 to that of i."""
        return (k - i) * (d - i) / ((i + 1) * (n - k - d + i + 1))

    def add(s: Column, i: Column) -> Column:
        return F.struct((s["p"] * ratio(i)).alias("p"), (s["sum"] + s["p"]).alias("sum"))

    def pick(s: Column, i: Column) -> Column:
        below = s["sum"] + s["p"] <= s["goal"]
        return F.struct((s["p"] * ratio(i)).alias("p"), (s["sum"] + s["p"]).alias("sum"), s["goal"].alias("goal"), F.when(below, i + 1).otherwise(s["at"]).alias("at"))

    one, none = F.lit(1.0), F.lit(0.0)
    everything = F.aggregate(steps, F.struct(one.alias("p"), none.alias("sum")), add, lambda s: s["sum"])
    begin = F.struct(one.alias("p"), none.alias("sum"), (u * everything).alias("goal"), low.cast("long").alias("at"))
    return F.least(F.aggregate(steps, begin, pick, lambda s: s["at"]), high.cast("long"))


def _drawn(seed: int) -> Column:
    """Tickets of each source that go left at a node, drawn without putting back."""

    def source(s: Column, x: Column) -> Column:
        u = _chance(F.lit(seed), F.col("width"), F.col("node"), x["number"])
        got = hypergeometric(u, s["rest"], x["q"], s["room"])
        step = F.struct(got.alias("got"))
        return F.element_at(F.transform(F.array(step), lambda g: F.struct((s["rest"] - x["q"]).alias("rest"), (s["room"] - g["got"]).alias("room"), F.concat(s["taken"], F.array(g["got"])).alias("taken"))), 1)

    begin = F.struct(F.col("total").alias("rest"), F.floor(F.col("total") / 2).cast("long").alias("room"), F.array().cast("array<bigint>").alias("taken"))
    return F.aggregate("quota", begin, source, lambda s: s["taken"])


def _small() -> Column:
    """Whether a row can be one of those that a shard takes first from its blocks: it isn't larger than an even share of the last pass."""
    return F.col("mix_size") <= F.col("mix_rest") / F.least(F.col("mix_shards"), F.col("mix_blocks"))


def _large() -> Column:
    """Whether a row fits into the last pass, but into no shard's share."""
    return ~_small() & (F.col("mix_size") <= F.col("mix_rest"))


def _drawn_large(rows: DataFrame, seed: int) -> DataFrame:
    """mix_number, large_key, large_rows, large_words: the large rows of the last pass are those before large_key in permuted order and so many of that key.

    As many are drawn as their part of the rest asks for, the one at the border with the chance of what is missing; more if
    the small ones can't fill what would be left; none that goes beyond the rest. A source has fewer large rows than shards times its words by its rest.
    """
    size = F.col("mix_size")
    sums = rows.groupBy("mix_number").agg(F.sum(F.when(_small(), size).otherwise(0)).alias("small"), F.sum(F.when(_large(), size).otherwise(0)).alias("large"))
    order = Window.partitionBy("mix_number").orderBy("mix_key", "mix_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.where(_large()).withColumn("upto", F.sum(size).over(order)).join(sums, "mix_number")
    asked = F.col("mix_rest") * F.col("large") / (F.col("small") + F.col("large"))
    border = F.col("upto") - size * (1 - _chance(F.lit(seed + 4), "mix_number"))
    drawn = found.where((F.col("upto") <= F.col("mix_rest")) & ((border < asked) | (F.col("upto") - size < F.col("mix_rest") - F.col("small"))))
    keys = drawn.groupBy("mix_number", "mix_key").agg(F.count("*").alias("rows"), F.sum(size).alias("words"))
    return keys.groupBy("mix_number").agg(F.max("mix_key").alias("large_key"), F.max_by("rows", "mix_key").alias("large_rows"), F.sum("words").alias("large_words"))


def _headed(rows: DataFrame) -> DataFrame:
    """``rows`` with mix_head: large ones that are drawn, and small ones whose running sum in permuted order is within their shard's share there.

    ``before``: that sum where the row's block begins; ``share``: the shard's.
    """
    block = Window.partitionBy("mix_number", "mix_block")
    order = block.orderBy("mix_key", "mix_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("before") + F.sum(F.when(_small(), F.col("mix_size")).otherwise(0)).over(order)
    among = F.row_number().over(Window.partitionBy("mix_number", "mix_block", "mix_key").orderBy("mix_size"))
    large = _large() & F.coalesce((F.col("mix_key") < F.col("mix_large")["key"]) | ((F.col("mix_key") == F.col("mix_large")["key"]) & (among <= F.col("mix_large")["rows"])), F.lit(False))
    return rows.withColumn("mix_head", large | (_small() & F.coalesce(upto <= F.col("share"), F.lit(False))))


def _cuts(headed: DataFrame) -> DataFrame:
    """mix_number, mix_block, cut, cut_rows of each block that helps to fill what the head leaves of the last pass.

    Of the rows outside the head those of 1 to cut - 1 words are taken, and ``cut_rows``
    of the block's ones of cut words. Only sums by size and by block are sorted.
    """
    head, size = F.col("mix_head"), F.col("mix_size")
    by_size = headed.groupBy("mix_number", "mix_size").agg(F.sum(F.when(head, size).otherwise(0)).alias("taken"), F.count(F.when(~head & (size > 0), 1)).alias("n"), F.first("mix_rest").alias("rest"))
    source = Window.partitionBy("mix_number")
    by_size = by_size.withColumn("gap", F.col("rest") - F.sum("taken").over(source))
    by_size = by_size.withColumn("less", F.sum(F.col("n") * size).over(source.orderBy("mix_size")) - F.col("n") * size)
    room = F.col("gap") - F.col("less")
    count = F.floor(room / size)
    missing = room - count * size
    nearer = (size - missing < missing).cast("long")
    # the smallest size of which not all rows fit
    cut = by_size.where((F.col("n") > 0) & (F.col("less") + F.col("n") * size > F.col("gap"))).groupBy("mix_number").agg(F.min(F.struct(size.alias("cut"), (count + nearer).alias("rows"))).alias("c"))
    left = headed.where(~head & (size > 0)).join(cut.select("mix_number", "c.cut", "c.rows"), "mix_number").where(size <= F.col("cut"))
    found = left.groupBy("mix_number", "mix_block").agg(F.first("cut").alias("cut"), F.first("rows").alias("rows"), F.count(F.when(size < F.col("cut"), 1)).alias("smaller"), F.count(F.when(size == F.col("cut"), 1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("mix_number").orderBy("mix_block")) - F.col("n")
    found = found.withColumn("cut_rows", F.least(F.col("n"), F.greatest(F.lit(0), F.col("rows") - earlier)))
    return found.where((F.col("smaller") > 0) | (F.col("cut_rows") > 0)).select("mix_number", "mix_block", "cut", "cut_rows")


def _rows(docs: DataFrame, size: Column | None, source: str, seed: int) -> DataFrame:
    """``docs`` with mix_size and mix_key, the place in the permuted order of its source."""
    key = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns if c in ("doc_id", "text")])
    d = docs.withColumn("mix_size", F.coalesce(word_count(F.col("text")) if size is None else size, F.lit(0)).cast("long"))
    return d.withColumn("mix_key", key)


def plan(slim: DataFrame, weights, cap: float, shards: int, block_rows: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(source, mix_key, mix_size) -> targets of the sources, and the written plan of their blocks.

    A block's row: mix_number, mix_block, tickets (pass, shard) of the whole passes, last_shard
    and share (of the source's rest, in words; null without a last pass), before (words of
    the shard's small rows in its blocks before this one).
    """
    sizes = slim.groupBy("source").agg(F.count("*").alias("n"), F.sum("mix_size").alias("words"))
    targets = source_targets(sizes, weights, cap)
    whole = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long")
    targets = targets.withColumn("mix_whole", whole).withColumn("mix_rest", F.greatest(F.lit(0.0), F.col("target") - F.col("mix_whole") * F.col("words")))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block_rows), F.least(F.col("n"), F.lit(4 * shards)))
    targets = targets.select(F.col("source").alias("mix_source"), F.col("words").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("number").alias("mix_number"), blocks.alias("mix_blocks"), F.lit(shards).alias("mix_shards"), "mix_whole", "mix_rest")
    targets = broadcast_checked(written(targets, "mix-targets"), SMALL)
    large = _drawn_large(blocked(slim, targets, "source"), seed)
    targets = targets.join(large, "mix_number", "left").withColumn("mix_small_rest", F.col("mix_rest") - F.coalesce("large_words", F.lit(0)))
    targets = targets.withColumn("mix_large", F.struct(F.col("large_key").alias("key"), F.col("large_rows").alias("rows"))).drop("large_key", "large_rows", "large_words")
    targets = broadcast_checked(written(targets, "mix-targets"), SMALL)

    small = F.when(_small(), F.col("mix_size")).otherwise(0)
    blocks = blocked(slim, targets, "source").groupBy("mix_number", "mix_block").agg(F.sum(small).alias("words"), *[F.first(c).alias(c) for c in ("mix_whole", "mix_rest", "mix_small_rest")])
    blocks = written(blocks, "mix-blocks")
    is_last = F.col("pass") == F.col("mix_whole")
    passes = F.filter(F.sequence(F.lit(0).cast("long"), F.col("mix_whole")), lambda p: (p < F.col("mix_whole")) | (F.col("mix_rest") > 0))
    # a source's whole passes and its last one are dealt each by its own quota
    tickets = blocks.withColumn("pass", F.explode(passes)).withColumn("number", F.col("mix_number") * 2 + is_last.cast("int"))
    leaves = split_tickets(tickets.groupBy("number").agg(F.count("*").alias("tickets")), shards, seed)
    upto = F.sum("quota").over(Window.partitionBy("number").orderBy("shard"))
    bounds = leaves.select("number", "shard", upto.alias("upto")).groupBy("number").agg(F.sort_array(F.collect_list(F.struct("shard", "upto"))).alias("bounds"))
    dealt = Window.partitionBy("number").orderBy(F.xxhash64(F.lit(seed + 1), "mix_number", "pass", "mix_block"), "pass", "mix_block")
    tickets = tickets.withColumn("at", F.row_number().over(dealt)).join(bounds, "number")
    tickets = written(tickets.select("mix_number", "mix_block", "mix_small_rest", "words", "pass", is_last.alias("is_last"), F.size(F.filter("bounds", lambda b: b["upto"] < F.col("at"))).alias("shard")), "mix-tickets")

    last = tickets.where("is_last")
    mine, all_ = Window.partitionBy("mix_number", "shard"), Window.partitionBy("mix_number")
    last = last.withColumn("share", F.try_divide(F.col("mix_small_rest") * F.sum("words").over(mine), F.sum("words").over(all_)))
    before = F.sum("words").over(mine.orderBy(F.xxhash64(F.lit(seed + 3), "shard", "mix_block"), "mix_block")) - F.col("words")
    last = last.select("mix_number", "mix_block", F.col("shard").alias("last_shard"), "share", before.alias("before"))
    whole = tickets.where("not is_last").groupBy("mix_number", "mix_block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("tickets"))
    found = blocks.select("mix_number", "mix_block").join(last, ["mix_number", "mix_block"], "left").join(whole, ["mix_number", "mix_block"], "left")
    return targets, written(found, "mix-plan")


def blocked(rows: DataFrame, targets: DataFrame, source: str) -> DataFrame:
    """Rows with their source's columns and mix_block, by the key's place in the source's order."""
    unit = F.shiftrightunsigned(F.col("mix_key"), 11) / F.lit(float(1 << 53))
    return rows.join(targets, F.col(f"`{source}`").eqNullSafe(F.col("mix_source"))).drop("mix_source").withColumn("mix_block", F.floor(unit * F.col("mix_blocks")))


def placed(docs: DataFrame, size: Column | None = None, *, source: str = "source", weights=WEIGHTS, cap: float = 3.0, shards: int = 8, block_rows: int = 1024, seed: int = 7) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_places, an array of (shard, pass, rank).

    ``size``: words of ``text`` unless given; null counts as 0. A null source is a
    source of its own. Places are empty for rows that the mix leaves out; their
    number is at most ``cap`` rounded up, and with a whole ``cap`` at most ``cap``.
    Repeated rows are rows like others: their order among each other is that of a
    window over equal keys and doesn't change how many are taken. An empty table
    gives an empty one; sources of size 0 have target 0. Columns of the input that
    begin with ``mix_`` are refused.
    """
    if clash := [c for c in docs.columns if c.lower().startswith("mix_")]:
        raise ValueError(f"columns {clash} clash with those that are added")
    d = _rows(docs, size, source, seed)
    slim = written(d.select(F.col(f"`{source}`").alias("source"), "mix_key", "mix_size"), "mix-rows")  # words are counted once for all sums
    targets, blocks = plan(slim, weights, cap, shards, block_rows, seed)
    at = ["mix_number", "mix_block"]
    cuts = _cuts(_headed(blocked(slim, targets, "source").join(blocks.select(*at, "before", "share"), at)))
    blocks = blocks.join(cuts, at, "left")
    d = blocked(d, targets, source).join(blocks.select(*at, "before", "share", F.struct("cut", "cut_rows", "tickets", "last_shard").alias("mix_plan")), at)
    d = _headed(d)
    own = F.col("mix_plan")
    at_cut = ~F.col("mix_head") & (F.col("mix_size") == own["cut"])
    among = F.row_number().over(Window.partitionBy(*at).orderBy(F.when(at_cut, 0).asc_nulls_last(), "mix_key"))
    filling = (F.col("mix_size") > 0) & ((F.col("mix_size") < own["cut"]) | (at_cut & (among <= own["cut_rows"])))
    last = own["last_shard"].isNotNull() & (F.col("mix_head") | F.coalesce(filling, F.lit(False)))
    none = F.array().cast("array<struct<pass:bigint,shard:int>>")
    tickets = F.concat(F.coalesce(own["tickets"], none), F.when(F.col("mix_in"), F.array(F.struct(F.col("mix_whole").alias("pass"), own["last_shard"].alias("shard")))).otherwise(none))
    d = d.withColumn("mix_in", last)
    places = F.transform(tickets, lambda t: F.struct(t["shard"].alias("shard"), t["pass"].alias("pass"), F.xxhash64(F.lit(seed + 2), t["shard"], t["pass"], F.col("mix_key")).alias("rank")))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], "mix_size", "mix_source_size", "mix_target", places.alias("mix_places"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, repeated as drawn, with mix_shard and mix_rank (their order in it)."""
    rows = placed(docs, **options).withColumn("mix_place", F.explode("mix_places"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("mix_place.shard").alias("mix_shard"), F.col("mix_place.rank").alias("mix_rank"))


def in_order(mix: DataFrame, tasks: int | None = None) -> DataFrame:
    """Shard after shard, each shuffled: rows lie in the order of their rank. A shard may be several tasks' ranges."""
    at = ["mix_shard", "mix_rank"]
    return (mix.repartitionByRange(tasks, *at) if tasks else mix.repartitionByRange(*at)).sortWithinPartitions(*at)


def write_shards(mix: DataFrame, path: str, tasks: int | None = None) -> None:
    """One folder a shard, in order."""
    in_order(mix, tasks).write.partitionBy("mix_shard").parquet(path)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A last column, shards: those that hold the document, one for each time it is taken."""
    docs = placed(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    taken = F.size("mix_places").cast("long") * F.col("mix_size")
    shards = F.array_join(F.transform("mix_places", lambda p: p["shard"].cast("string")), ",")
    return docs.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), taken.alias("taken"), shards.alias("shards"))
