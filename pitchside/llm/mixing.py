"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source's documents are each wanted `target / source_size` times. The whole part is taken as it is; the fractions
are rounded dependently: two documents transfer mass, one up and the other down by as many words, in a random
direction with unbiased odds, until one of them is integral. The other goes on to meet the next. Groups of at most about
`fan` documents do this each for itself, and what is left of each group meets in groups again: a reduction tree, of
which each level is one shuffle of 1/fan of the rows before. Large documents outlive small ones, so `held` groups of
all sizes wait for the last level, where the longest meet first. A source's words then change by less than half of
its very last document, which goes to the nearer whole number.

Chance depends on the seed, the document (doc_id, source and a hash of the text) and, of repeated rows, the number of the repeat, so reruns
agree whatever the partitions, and repeats are dealt over all groups of their source. Windows without partitions are over a row per source; sources are taken to be some
thousands at most.

Defined cases: a null text has size 0 and is taken 0 times; null is a source of its own, the last; a null doc_id
stays null; repeated rows are rounded each for itself, and `mixed_documents` emits as many rows as `mix` takes, for rows that repeat a doc_id, a source and a text
the one of least JSON text; an empty table gives no rows; a very long text is one row; `mix` reads no other columns, and `mixed_documents` keeps all, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialise

WORD = r"[^\x20\x09-\x0D]+"
OWN = ("key", "doc_id", "mark", "size")  # of an item; the key tells repeats apart
ITEM = "struct<key:bigint,doc_id:bigint,mark:bigint,size:bigint,p:double>"
STATE = f"struct<key:bigint,doc_id:bigint,mark:bigint,size:bigint,p:double,has:boolean,out:array<{ITEM}>>"


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """source, place, n_items, source_size, target. The level of a water-filling: sources in the order of most * size /
    weight stop at their limits until what is left, shared by weight, is under the next one's."""
    own = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n_items"))
    own = own.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    own = own.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double"))
    own = own.withColumn("ratio", most * F.col("source_size") / F.col("weight"))
    order = Window.orderBy("ratio", "place")
    before = F.coalesce(F.sum(most * F.col("source_size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    own = own.withColumn("level", (F.sum("source_size").over(Window.partitionBy()) - before) / after)
    own = own.withColumn("at", F.row_number().over(order))
    level = F.min(F.when(F.col("level") <= F.col("ratio") * (1 + 1e-12), F.struct("at", "level"))).over(Window.partitionBy())["level"]
    return own.select("source", "place", "n_items", "source_size", F.least(level * F.col("weight"), most * F.col("source_size")).alias("target"))


def chance(*of: Column) -> Column:
    """A number in [0, 1) that these values decide."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") * 2.0**-53


def pivot(items: Column, seed: int) -> Column:
    """Sequential pivotal rounding of an array of items; `out` has those that became integral."""

    def item(of: Column, p: Column) -> Column:
        return F.struct(*(of[c].alias(c) for c in OWN), p.alias("p"))

    def state(of: Column, p: Column, out: Column) -> Column:
        return F.struct(*(of[c].alias(c) for c in OWN), p.alias("p"), F.lit(True).alias("has"), out.alias("out"))

    def meet(s: Column, x: Column) -> Column:
        up = F.least(1 - s["p"], x["size"] * x["p"] / s["size"])
        down = F.least(s["p"], x["size"] * (1 - x["p"]) / s["size"])
        odds = chance(F.lit(seed), s["key"], x["key"])
        move = F.struct(up.alias("up"), down.alias("down"), (odds * (up + down) < down).alias("rise"))
        less = lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))

        def step(m: Column) -> Column:
            x_down, x_up = less(x["p"] - m["up"] * s["size"] / x["size"]), less(x["p"] + m["down"] * s["size"] / x["size"])
            put = lambda of, p: F.concat(s["out"], F.array(item(of, F.lit(float(p)))))
            return F.when(m["rise"], F.when(m["up"] >= 1 - s["p"], state(x, x_down, put(s, 1))).otherwise(state(s, less(s["p"] + m["up"]), put(x, 0)))).otherwise(
                F.when(m["down"] >= s["p"], state(x, x_up, put(s, 0))).otherwise(state(s, less(s["p"] - m["down"]), put(x, 1)))
            )

        return F.when(s["has"], F.element_at(F.transform(F.array(move), step), 1)).otherwise(state(x, x["p"], s["out"]))

    none = F.lit(None).cast("bigint")
    start = F.struct(*((F.lit(1).cast("bigint") if c == "size" else none).alias(c) for c in OWN), F.lit(0.0).alias("p"), F.lit(False).alias("has"), F.array().cast(f"array<{ITEM}>").alias("out"))
    return F.aggregate(items, start.cast(STATE), lambda s, x: meet(s, x).cast(STATE))


def mark_of(docs: DataFrame) -> Column:
    """A hash that tells the documents of an id apart."""
    return F.xxhash64(F.coalesce(docs["source"].cast("string"), F.lit("")), docs["source"].isNull(), F.coalesce(docs["text"].cast("string"), F.lit("")), docs["text"].isNull())


def times(rows: DataFrame, many: Column, name: str, step: int = 1 << 16) -> DataFrame:
    """Each row `many` times, with its number from 0 on as column `name`. In two steps, so that no row needs an array of very many numbers."""
    rows = rows.withColumn(f"{name}_many", many.cast("bigint")).withColumn(f"{name}_high", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(f"{name}_many") - 1) / step))))
    low = F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(step), F.col(f"{name}_many") - F.col(f"{name}_high") * step) - 1))
    return rows.withColumn(name, low).withColumn(name, F.col(name) + F.col(f"{name}_high") * step).drop(f"{name}_many", f"{name}_high")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, fan: int = 64, held: int = 4, seed: int = 42) -> DataFrame:
    """A row per document: doc_id, mark, size, source, source_size, target, copies, taken (copies * size)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    counted = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), mark_of(docs).alias("mark"), size.alias("size")).groupBy("doc_id", "source", "mark", "size").agg(F.count("*").alias("n"))
    sized = times(counted, F.col("n"), "again").withColumn("key", F.xxhash64("doc_id", "mark", "size", "again"))
    sized = materialise(sized.select("key", "doc_id", "mark", "source", "size"), "mix-sizes")
    own = materialise(targets(sized, weights, most), "mix-targets")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    own = own.withColumn("whole", F.floor(wanted + 1e-12)).withColumn("p", F.greatest(F.lit(0.0), wanted - F.col("whole")))
    own = own.withColumn("p", F.when(F.col("p") < 1e-9, 0.0).otherwise(F.col("p"))).withColumn("groups", F.ceil(F.col("n_items") / fan))

    rows = sized.join(own.select(F.col("source").alias("of"), "place", "p", "groups"), F.col("source").eqNullSafe(F.col("of")))
    fixed = (F.col("size") == 0) | (F.col("p") == 0)
    done = [rows.where(fixed).select("place", *OWN, F.lit(0.0).alias("p"))]
    bucket = F.pmod(F.xxhash64(F.lit(seed), "key"), F.greatest("groups", F.lit(1)))
    level = rows.where(~fixed).select("place", F.when(bucket >= held, bucket).otherwise(-1).alias("bucket"), *OWN, "p")
    last, level = materialise(level.where("bucket < 0"), "mix-last"), level.where("bucket >= 0")
    groups = own.agg(F.max("groups")).first()[0] or 1

    def run(level: DataFrame, k: int) -> DataFrame:
        order = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("o"), F.xxhash64(F.lit(seed + k), "key").alias("h"), *OWN, "p")))
        items = F.transform(order, lambda x: F.struct(*(x[c].alias(c) for c in (*OWN, "p"))))
        out = materialise(level.groupBy("place", "bucket").agg(items.alias("items")).select("place", "bucket", pivot(F.col("items"), seed + k).alias("s")), "mix-level")
        done.append(out.select("place", F.inline("s.out")))
        return out.select("place", F.floor(F.col("bucket") / fan).alias("bucket"), *(f"s.{c}" for c in (*OWN, "p")))

    k = 0
    while groups > held:  # as many levels as the logarithm of the largest source's documents
        level, k, groups = run(level, k), k + 1, -(-groups // fan)
    level = run(last.unionByName(level).withColumn("bucket", F.lit(0)), k)
    done.append(level.select("place", *OWN, F.round("p").alias("p")))
    rounded = reduce(DataFrame.unionByName, done)
    copies = (F.col("whole") + F.col("up")).cast("bigint")
    return (
        rounded.withColumnRenamed("p", "up")
        .join(own.drop("p"), "place")
        .select("doc_id", "mark", "size", "source", "source_size", "target", F.when(F.col("size") > 0, copies).otherwise(F.lit(0).cast("bigint")).alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents, each as many times as the mix takes it, in the columns of `docs`."""
    taken = mix(docs, **options).groupBy(F.col("doc_id").alias("mixed_id"), F.col("mark").alias("mixed_mark")).agg(F.sum("copies").alias("mixed_copies"), F.count("*").alias("mixed_rows"))
    taken = materialise(taken.where("mixed_copies > 0"), "mix-taken")
    given = [f"mixed_{k}" for k in range(len(docs.columns))]  # no clash with other columns
    own = docs.select(*(docs[c].alias(g) for c, g in zip(docs.columns, given, strict=True)), F.coalesce(docs["doc_id"].cast("bigint"), F.lit(0)).alias("key_id"), mark_of(docs).alias("key_mark"))
    both = own.join(taken.hint("merge"), (F.col("key_id") == F.coalesce("mixed_id", F.lit(0))) & (own[given[docs.columns.index("doc_id")]].isNull() == F.col("mixed_id").isNull()) & (F.col("key_mark") == F.col("mixed_mark")))
    out = both.where("mixed_rows = 1").select(*given, "mixed_copies")
    if taken.where("mixed_rows > 1").limit(1).count():  # a document on several rows: one of them stands for all
        row = F.struct(*given)
        one = both.where("mixed_rows > 1").groupBy("mixed_id", "mixed_mark", "mixed_copies").agg(F.min_by(row, F.to_json(row)).alias("row"))
        out = out.unionByName(one.select("row.*", "mixed_copies"))
    return times(out, F.col("mixed_copies"), "mixed_time").select(*(F.col(g).alias(c) for c, g in zip(docs.columns, given, strict=True)))
