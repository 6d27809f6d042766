"""Mixing sources to target weights, with DataFrame functions only.

The words of a source are one stream (documents in the order of a hash), cut into blocks of a fixed length. Output
shards draw multinomial source counts slot by slot; the counts' running sums number a source's slots, and what the
draws miss or exceed of a source's exact number of slots is evened out over the shards. A slot's number is mapped
to a block by a pseudorandom permutation of the source's blocks (swap-or-not rounds), and slots meet blocks in a join
by source and block number.

A source with target t and size n takes t // n whole epochs (every block once each) and t % n words of a further
permuted epoch, whose last block is cut. So each source's words are its target, and no word is taken more than twice.

The mix is the word spans of the joined blocks; the counts per document are their sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.llm.common import WORD, n_words, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
BLOCK_WORDS = 64
SHARD_SLOTS = 16_384
ROUNDS = 12
#: Slots that one task makes, on average.
TASK_SLOTS = 200_000
#: Rows whose running sums one task computes, on average.
BUCKET_ROWS = 20_000
#: Cells of the inverse distribution: a slot's uniform meets the sources of its cell.
CELLS = 4_096


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, weight, target, nth) from (source, source_size): ``share`` of all words by weight, no
    source above ``limit`` times its size, the excess reshared by weight until none is above.

    The fixed point is min(limit * size, level * weight): sources in the order of limit * size / weight are full as
    long as the level that remains for the others is above theirs. One row per source meets in the windows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("nth", (F.row_number().over(order) - 1).cast("long")).withColumn(
        "weight", F.element_at(cycle, (F.col("nth") % len(weights) + 1).cast("int"))
    )
    cap = (F.col("source_size") * limit).cast("double")
    by_ratio = Window.orderBy(cap / F.col("weight"), "nth")
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    remaining = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    leveled = weighed.withColumn("level", left / F.sum("weight").over(remaining)).withColumn("cap", cap)
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(cap / F.col("weight"), "nth", "level")))
    leveled = leveled.withColumn("water", first.over(everything)["level"])
    return leveled.select(
        "source", "source_size", "weight", "nth", F.least("cap", F.coalesce(F.col("water") * F.col("weight"), "cap")).alias("target")
    )


def permuted(df: DataFrame, column: str, index: str, n: str, *key: Column, seed: int, rounds: int = ROUNDS) -> DataFrame:
    """``column``: ``index`` sent through a pseudorandom permutation of 0 .. n-1, one for each value of ``key``.

    Each swap-or-not round pairs x with (k - x) mod n and swaps the pair or not by a hash of its larger member, so any n
    works and nothing has to be sorted. The rounds are a fold, because a chain of projections that each use the last
    one several times is inlined by the optimizer into a plan that doubles with every round.
    """

    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(seed), r, *key), F.col(n)) - x, F.col(n))
        coin = F.xxhash64(F.lit(seed + 1), r, *key, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(coin, other).otherwise(x)

    return df.withColumn(column, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.col(index), swap))


def plan_slots(sources: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, nth, slot, epoch, block, words) of every slot of the mix from the sources' targets.

    ``words`` is null where the whole block is taken, else the number of its first words.
    """
    whole = F.floor("target").cast("long")
    rest = F.col("goal") - F.col("epochs") * F.col("source_size")
    facts = (
        sources.filter(F.col("source_size") > 0)
        .withColumn("goal", whole)
        .withColumn("epochs", F.floor(F.col("goal") / F.col("source_size")).cast("long"))
        .withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
        .withColumn("full", F.floor(F.col("source_size") / block_words).cast("long"))
        .withColumn("rest", rest)
        .withColumn("slots", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / block_words).cast("long"))
        .filter(F.col("slots") > 0)
    )
    everything = Window.partitionBy(F.lit(0)).orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.partitionBy(F.lit(0)).orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    facts = stored(
        facts.withColumn("all_slots", F.sum("slots").over(everything))
        .withColumn("high", F.sum("slots").over(upto) / F.col("all_slots"))
        .withColumn("low", F.col("high") - F.col("slots") / F.col("all_slots")),
        "mix_sources",
    )
    n_slots = facts.agg(F.max("all_slots")).first()[0] or 0
    shards = max(1, -(-n_slots // shard_slots))
    spark = sources.sparkSession

    cell = F.explode(F.sequence(F.floor(F.col("low") * CELLS).cast("int"), F.least(F.lit(CELLS - 1), F.floor(F.col("high") * CELLS).cast("int"))))
    last = Window.partitionBy(F.lit(0)).orderBy(F.desc("nth"))
    cells = (
        facts.withColumn("high", F.when(F.row_number().over(last) == 1, F.lit(2.0)).otherwise(F.col("high")))
        .select("nth", "low", "high", cell.alias("cell"))
    )
    uniform = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), 11) / float(1 << 53)
    draws = (
        spark.range(n_slots)
        .select(F.floor(F.col("id") / shard_slots).cast("long").alias("shard"), uniform.alias("u"))
        .withColumn("cell", F.floor(F.col("u") * CELLS).cast("int"))
        .join(cells, "cell")
        .filter((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
        .groupBy("nth", "shard")
        .count()
    )
    by_shard = Window.partitionBy("nth").orderBy("shard")
    counts = draws.withColumn("upto", F.sum("count").over(by_shard))
    drawn = counts.groupBy("nth").agg(F.max("upto").alias("drawn"))
    columns = ["nth", "epochs", "blocks", "full", "rest", "slots"]
    numbered = counts.join(F.broadcast(facts.select(columns)), "nth").select(
        "shard", *columns, (F.col("upto") - F.col("count")).alias("a"), F.least("upto", "slots").alias("b")
    )
    # What the draws left over of a source, a shard's worth of numbers at a time, goes to shards by a hash.
    left = (
        facts.select(columns)
        .join(drawn, "nth", "left")
        .withColumn("drawn", F.coalesce("drawn", F.lit(0)))
        .filter(F.col("drawn") < F.col("slots"))
        .withColumn("a", F.explode(F.sequence("drawn", F.col("slots") - 1, F.lit(shard_slots))))
        .select(F.lit(None).cast("long").alias("shard"), *columns, "a", F.least(F.col("a") + shard_slots, F.col("slots")).alias("b"))
    )
    slots = (
        numbered.unionByName(left)
        .filter(F.col("a") < F.col("b"))
        # A few rows that become many: by a number, so that they aren't put together in one task for their size.
        .repartition(max(spark.sparkContext.defaultParallelism, -(-n_slots // TASK_SLOTS)), "nth", "a")
        .withColumn("slot", F.explode(F.sequence("a", F.col("b") - 1)))
        .withColumn("shard", F.coalesce("shard", F.pmod(F.xxhash64(F.lit(seed), F.lit("left"), "nth", "slot"), F.lit(shards))))
    )
    in_epochs = F.col("slot") < F.col("epochs") * F.col("blocks")
    cut = ~in_epochs & (F.col("slot") == F.col("slots") - 1) & (F.col("rest") % block_words > 0)
    slots = (
        slots.withColumn("epoch", F.when(in_epochs, F.floor(F.col("slot") / F.col("blocks"))).otherwise(F.col("epochs")))
        .withColumn("index", F.col("slot") - F.col("epoch") * F.col("blocks"))
        .withColumn("n", F.when(in_epochs, F.col("blocks")).otherwise(F.greatest("full", F.lit(1))))
        .withColumn("words", F.when(cut, F.col("rest") % block_words))
        # The short block at the end of a source is only reached when every full one is taken.
        .withColumn("short", ~in_epochs & (F.col("index") >= F.col("full")))
        .withColumn("index", F.when(F.col("short"), F.lit(0)).otherwise(F.col("index")))
    )
    slots = permuted(slots, "block", "index", "n", F.col("nth"), F.col("epoch"), seed=seed)
    return slots.select(
        "shard", "nth", "slot", "epoch", F.when(F.col("short"), F.col("full")).otherwise(F.col("block")).alias("block"), "words"
    )


def _joined(docs: DataFrame, block_words: int, shard_slots: int, seed: int, weights, share: float, limit: int) -> tuple[DataFrame, DataFrame]:
    """The targets, and the documents' pieces in blocks with the slots that take them: (nth, doc_id, text_hash, size, copy,
    shard, slot, epoch, a, b), words a .. b of the document. Pieces that no slot takes have a null slot.
    """
    sized = stored(
        docs.groupBy("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "text_hash")),
        "mix_sizes",
    )
    totals = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    sources = stored(source_targets(totals, weights, share, limit), "mix_targets", 1)
    slots = plan_slots(sources, block_words, shard_slots, seed)

    buckets = 1
    while buckets * BUCKET_ROWS < sized.count():
        buckets *= 2
    bucketed = sized.join(sources.select("source", "nth"), sized["source"].eqNullSafe(sources["source"])).select(
        sized["*"], "nth", F.pmod("order", F.lit(buckets)).alias("bucket")
    )
    words = F.col("size") * F.col("copies")
    ahead = Window.partitionBy("nth").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("nth", "bucket").agg(F.sum(words).alias("n")).select(
            "nth", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset")
        )
    )
    within = Window.partitionBy("nth", "bucket").orderBy("order", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        bucketed.withColumn("ahead", F.coalesce(F.sum(words).over(within), F.lit(0)))
        .join(offsets, ["nth", "bucket"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .withColumn("start", F.col("offset") + F.col("ahead") + F.col("copy") * F.col("size"))
    )
    pieces = (
        placed.withColumn(
            "block",
            F.explode_outer(
                F.when(
                    F.col("size") > 0,
                    F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)),
                )
            ),
        )
        .withColumn("a", F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)))
        .withColumn("b", F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.lit(block_words)))
        .select("doc_id", "text_hash", "nth", "size", "copy", "start", "block", "a", "b")
    )
    ahead = F.col("block") * block_words - F.col("start")
    stop = F.when(F.col("words").isNull(), F.col("b")).otherwise(F.greatest(F.least("words", "b"), "a"))
    # Slots look small to the planner, which would broadcast all of them.
    joined = pieces.join(slots.hint("merge"), ["nth", "block"], "left").select(
        "nth", "doc_id", "text_hash", "size", "copy", "shard", "slot", "epoch", (ahead + F.col("a")).alias("a"), (ahead + stop).alias("b")
    )
    return sources, joined


def mix_spans(
    docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 17, weights=WEIGHTS,
    share: float = SHARE, limit: int = LIMIT,
) -> DataFrame:
    """(shard, slot, epoch, doc_id, source, text_hash, size, copy, a, b): the mix, words a .. b of a document for every document in
    a slot's block. Repeated rows are told apart by ``copy`` (0, 1, ..). Within an epoch no word is taken twice.
    """
    sources, joined = _joined(docs, block_words, shard_slots, seed, weights, share, limit)
    return joined.filter("slot is not null and a < b").join(sources.select("nth", "source"), "nth").select(
        "shard", "slot", "epoch", "doc_id", "source", "text_hash", "size", "copy", "a", "b"
    )


def mix_sources(
    docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 17, weights=WEIGHTS,
    share: float = SHARE, limit: int = LIMIT,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, text_hash), one row per document: the words of its spans in the mix.

    Null texts have size 0; documents without words and sources without words take 0. A null source is a source of its
    own, the last one. Repeated rows are documents of their own: they are merged for the running sums, so that one row
    repeated for a third of the table meets no single task, and counted apart again. An empty table gives no row.
    """
    sources, joined = _joined(docs, block_words, shard_slots, seed, weights, share, limit)
    words = F.when(F.col("slot").isNotNull(), F.col("b") - F.col("a"))
    summed = joined.groupBy("nth", "doc_id", "text_hash", "size", "copy").agg(F.coalesce(F.sum(words), F.lit(0)).cast("long").alias("taken"))
    return summed.join(sources.select("nth", "source", "source_size", "target"), "nth").select(
        "doc_id", "size", "source_size", "target", "taken", "source", "text_hash"
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: the drawn word spans, cut from the texts, each partition in the order of their shards and slots.

    Spans of one epoch that touch in a document are one row, placed where the first of them was drawn. A partition holds the
    spans of documents chosen by a hash, so each is a mix of all sources as drawn, and texts move only once. A document of which
    an epoch takes every word is there whole, with its text as it is; of others the white space between the words of a
    span stays. ``n_chars``, if there is one, is that of the new text; all other columns are the document's, whatever they are
    called. Nulls, empty texts, ties and repeated rows as in ``mix_sources``; an empty table gives no row.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keys = ["doc_id", "source", "text_hash", "copy"]
    spans = mix_spans(docs.select("doc_id", "source", "text"), **options)
    in_epoch = Window.partitionBy(*keys, "epoch").orderBy("a")
    fresh = F.when(F.lag("b").over(in_epoch) == F.col("a"), 0).otherwise(1)
    runs = (
        spans.withColumn("fresh", fresh)
        .withColumn("run", F.sum("fresh").over(in_epoch))
        .groupBy(*keys, "size", "epoch", "run")
        .agg(F.min("a").alias("a"), F.max("b").alias("b"), F.min(F.struct("shard", "slot")).alias("drawn"))
        .groupBy(*keys, "size")
        .agg(F.sort_array(F.collect_list(F.struct("epoch", "a", "b", "drawn"))).alias("runs"))
        .alias("r")
    )
    rows = docs.select(whole.alias("row")).withColumn("text_hash", F.xxhash64("row.text"))
    rest = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("doc_id", "source", "text")]
    nth = Window.partitionBy("row.doc_id", "row.source", "text_hash").orderBy(*rest if rest else [F.lit(0)])
    left = rows.withColumn("copy", F.row_number().over(nth) - 1).alias("l")
    same = "l.row.doc_id <=> r.doc_id and l.row.source <=> r.source and l.text_hash = r.text_hash and l.copy = r.copy"
    joined = left.join(runs, F.expr(same)).select("l.row", "r.size", "r.runs")
    # The words are bound by a function of one row: named in the inner one, they would be cut anew for every span.
    words = F.array(F.regexp_extract_all("row.text", F.lit(f"([\\x20\\x09-\\x0D]*{WORD})")))

    def cut(found: Column) -> Column:
        piece = lambda r: F.array_join(F.slice(found, (r["a"] + 1).cast("int"), (r["b"] - r["a"]).cast("int")), "")
        bare = lambda r: F.regexp_replace(piece(r), r"^[\x20\x09-\x0D]+", "")
        part = lambda r: F.when(r["b"] - r["a"] == F.col("size"), F.lit(None).cast("string")).otherwise(bare(r))
        return F.transform("runs", lambda r: F.struct(part(r).alias("part"), r["drawn"].alias("drawn"), r["epoch"].alias("epoch"), r["a"].alias("a")))

    parts = joined.select("row", F.explode(F.flatten(F.transform(words, cut))).alias("piece"))
    ordered = parts.sortWithinPartitions("piece.drawn", "row.doc_id", "piece.epoch", "piece.a")
    text = F.coalesce("piece.part", "row.text")
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("piece.part").isNull(), F.col("row.n_chars")).otherwise(F.length(text).cast("long"))
    return ordered.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
