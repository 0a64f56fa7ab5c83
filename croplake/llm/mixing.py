"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions alone.

A source's target is spread evenly: each of its documents is due ``target / source size`` copies. The whole part
is given; the fractional part is settled in pairs. A pair moves as much of its undecided words from one document
to the other as makes one of them whole (0 or 1 more copy), the direction drawn so that each keeps its
expectation. The undecided rest meets the next document. This runs as a reduction tree: in every chunk of a
source as a fold over at most a few hundred documents, then over the chunks' rests, until one rest per source is
left, which is drawn last. A source's words therefore miss its target by less than one document.

Draws are hashes of the two documents' keys and a seed, so that reruns agree. Null texts and texts without words
have size 0 and take nothing. A null source is a source, in order after all others. Repeated rows are documents of
their own: rows of one id, source and size (or of null ids) are counted and numbered first, so that however many they
are, they are dealt to as many chunks as they need. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Documents (and rests) that one fold handles, on average.
FAN_IN = 200
#: Equal rows that are dealt out together.
TOGETHER = 64
#: Weights of the sources in order of their names, repeating; share of all words to take; copies at most.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2


def sizes(docs: DataFrame) -> DataFrame:
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select("doc_id", "source", words.cast("long").alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, documents, target): shares by weight, the excess over ``most`` times a source reshared.

    The level at which words per weight settle is found in one pass over the sources in order of the words per
    weight at which they are full. One row per source goes through its windows.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    named = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(w) for w in weights])
    total = total.withColumn("weight", F.element_at(cycle, F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))) + 1))
    total = total.withColumn("cap", F.col("source_size") * most).withColumn("full_at", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").isNull(), "source")
    before, on, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    wanted = F.sum("source_size").over(whole) * F.lit(share)
    level = (wanted - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(on)
    total = total.withColumn("at", level)
    total = total.withColumn("level", F.min(F.when(F.col("at") < F.col("full_at"), F.struct("full_at", "source", "at"))).over(whole)["at"])
    target = F.when(F.col("full_at") <= F.coalesce("level", F.col("full_at")), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return total.select("source", "source_size", "documents", target.alias("target"))


def _draw(*keys: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(1 << 53))


def _fold(items: Column, salt: Column) -> Column:
    """The pivotal fold over structs (key, doc_id, size, whole, mass); gives (rest, done).

    ``mass`` is the words still undecided, between 0 and ``size``; in ``done`` it is 0 or ``size``.
    """

    def settled(item: Column, mass: Column) -> Column:
        return F.struct(item["key"].alias("key"), item["doc_id"].alias("doc_id"), item["size"].alias("size"), item["whole"].alias("whole"), mass.cast("double").alias("mass"))

    def step(state: Column, item: Column) -> Column:
        rest = state["rest"]
        give = F.least(rest["mass"], item["size"] - item["mass"])  # from the rest to the item
        take = F.least(item["mass"], rest["size"] - rest["mass"])
        gives = _draw(rest["key"], item["key"], salt) * (give + take) < take
        a = F.when(gives, rest["mass"] - give).otherwise(rest["mass"] + take)
        b = F.when(gives, item["mass"] + give).otherwise(item["mass"] - take)
        # the moved amount was one's whole room: that one is set exactly, whatever the sums' last bits
        a_done = F.when(gives, give >= rest["mass"]).otherwise(take >= rest["size"] - rest["mass"])
        a_end = F.when(gives, F.lit(0.0)).otherwise(rest["size"].cast("double"))
        b_end = F.when(gives, item["size"].cast("double")).otherwise(F.lit(0.0))
        return F.when(rest["key"].isNull(), F.struct(settled(item, item["mass"]).alias("rest"), state["done"].alias("done"))).otherwise(
            F.when(a_done, F.struct(settled(item, F.greatest(F.lit(0.0), F.least(b, item["size"].cast("double")))).alias("rest"), F.concat(state["done"], F.array(settled(rest, a_end))).alias("done")))
            .otherwise(F.struct(settled(rest, F.greatest(F.lit(0.0), F.least(a, rest["size"].cast("double")))).alias("rest"), F.concat(state["done"], F.array(settled(item, b_end))).alias("done")))
        )

    none = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in _ITEM])
    start = F.struct(none.alias("rest"), F.array().cast("array<struct<" + ",".join(f"{n}:{t}" for n, t in _ITEM) + ">>").alias("done"))
    return F.aggregate(items, start, step)


_ITEM = (("key", "bigint"), ("doc_id", "bigint"), ("size", "bigint"), ("whole", "bigint"), ("mass", "double"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken, source and copies of every row of ``docs(doc_id, source, text)``."""
    sized = common.written(sizes(docs), "sizes")
    goal = common.written(targets(sized, weights, share, most), "targets")
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    equal = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    equal = equal.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / TOGETHER))))
    last = F.least(F.lit(TOGETHER), F.col("n") - F.col("block") * TOGETHER) - 1
    equal = equal.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = equal.join(goal, equal["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    whole = F.floor(due)
    # chunks of about FAN_IN documents; the hash spreads a hot source over as many chunks as it needs
    key = F.xxhash64("doc_id", "size", "block", "number", F.lit(seed))
    spread = F.xxhash64(F.col("doc_id"), F.col("size"), F.col("block"), F.lit(seed + 1))
    rows = rows.select(
        "source", "source_size", "target", F.pmod(spread, F.ceil(F.col("documents") / FAN_IN)).alias("chunk"),
        F.struct(key.alias("key"), "doc_id", "size", whole.alias("whole"), ((due - whole) * F.col("size")).alias("mass")).alias("item"),
    )
    most_chunks = goal.agg(F.max(F.ceil(F.col("documents") / FAN_IN))).first()[0] or 1
    level, done = 0, None
    while True:
        folded = rows.groupBy("source", "source_size", "target", "chunk").agg(F.array_sort(F.collect_list("item")).alias("items"))
        folded = folded.withColumn("state", _fold(F.col("items"), F.lit(seed + level))).drop("items")
        folded = common.written(folded, "fold")
        settled = folded.select("source", "source_size", "target", F.explode("state.done").alias("item"))
        done = settled if done is None else done.union(settled)
        rows = folded.select("source", "source_size", "target", F.floor(F.col("chunk") / FAN_IN).alias("chunk"), F.col("state.rest").alias("item"))
        if most_chunks <= 1:
            break
        most_chunks = -(-most_chunks // FAN_IN)
        level += 1
    rest = F.col("item")
    up = _draw(rest["key"], F.lit(seed - 1)) * rest["size"] < rest["mass"]
    last = rows.select("source", "source_size", "target", F.struct(*[rest[n].alias(n) for n, _ in _ITEM[:4]], F.when(up, rest["size"]).otherwise(0).cast("double").alias("mass")).alias("item"))
    copies = F.col("item.whole") + F.when((F.col("item.mass") > 0), 1).otherwise(0)
    return done.union(last).select(
        F.col("item.doc_id").alias("doc_id"), F.col("item.size").alias("size"), "source_size", "target",
        (copies * F.col("item.size")).cast("long").alias("taken"), "source", copies.cast("long").alias("copies"),
    )


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: how often each document is taken (``copies``, 0 for those it leaves out)."""
    return mix(docs)
