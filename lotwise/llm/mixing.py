"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words. Document rates w minimise the relative
entropy to "every document once" among rates of 0 to 2 that meet the targets. The
convex dual has one multiplier per source; its solution tilts the odds of a
document exponentially, w / (2 - w) = exp(multiplier * size / mean size). Newton
iterations solve it: each is one distributed sum over the (source, size) counts,
which describe the documents without loss. The rates are then rounded into whole copies,
jointly for each source: its sizes are gone through from the largest down, and each takes
the number of copies that leaves the rest nearest to what it is expected to take, as long
as the rest can still reach the target. The copies of a size are dealt to its documents by
a hash of their ids. A source has fewer distinct sizes than the root of twice its words,
and only they are gone through in one place.

A null text has size 0, a very long one counts whole. A null source is a source of its own,
ordered last. Sources without words have target 0; texts without words are taken at their
rate, once where the source has other texts. A null id hashes like any value. Each input row
gives one output row; rows that repeat an id, a source and a size are numbered, so they take
copies one by one. Ties go by the id. An empty table gives no rows. Extra columns are kept by
mix() under their names, whatever they are. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, free_names

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2
WORDS = r"[^\x20\x09-\x0D]+"
MAX_NEWTON, TOLERANCE = 40, 1e-7
#: Sizes that are gone through at once, and rows of a task that numbers documents of one size.
CHUNK, RANK_ROWS = 256, 20_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def uniform(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / float(1 << 40)


def targets(sizes: DataFrame) -> DataFrame:
    """key, source_size, mean, target of every source; sizes: (key, size, n)."""
    sources = sizes.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("filled"))
    rank = F.row_number().over(Window.orderBy((F.col("key") == "").cast("int"), "key"))
    sources = sources.withColumn("rank", rank).withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))) + 1).cast("int")))
    # The shares rise together in proportion to the weights; a source stops at its cap. In the order in
    # which caps are met, the level is fixed by the first source whose cap lies above it.
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    cap = CAP * F.col("source_size")
    before = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (SHARE * F.sum("source_size").over(Window.partitionBy()) - before) / weights
    sources = sources.withColumn("own_level", level)
    above = F.when(F.col("own_level") * F.col("weight") < cap, F.struct((F.col("source_size") / F.col("weight")).alias("a"), F.col("rank"), F.col("own_level").alias("level")))
    sources = sources.withColumn("level", F.min(above).over(Window.partitionBy())["level"])
    target = F.coalesce(F.least(cap.cast("double"), F.col("level") * F.col("weight")), cap.cast("double"))
    return sources.select("key", "source_size", (F.col("source_size") / F.col("filled")).alias("mean"), target.alias("target"))


def rate(size: Column, mean: Column, tilt: Column) -> Column:
    return CAP / (1 + F.exp(-tilt * size / mean))


def solve(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """sources with the tilt at which the expected words meet the target; null where the target is the cap or 0."""
    share = F.try_divide("target", CAP * F.col("source_size"))
    state = sources.withColumn("tilt", F.when((share > 0) & (share < 1), F.log(share / (1 - share)))).withColumn("low", F.lit(float("-inf"))).withColumn("high", F.lit(float("inf")))
    state = cut(state, "tilts")
    sizes = sizes.where("size > 0")
    for _ in range(MAX_NEWTON):
        w = rate(F.col("size"), F.col("mean"), F.col("tilt"))
        taken = F.col("n") * F.col("size") * w
        slope = taken * (1 - w / CAP) * F.col("size") / F.col("mean")
        sums = sizes.join(state.where("tilt IS NOT NULL").select("key", "mean", "tilt"), "key").groupBy("key").agg(F.sum(taken).alias("taken"), F.sum(slope).alias("slope"))
        gap = F.col("target") - F.col("taken")
        low, high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("low")), F.when(gap <= 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.least(F.greatest(F.coalesce(F.try_divide(gap, "slope"), F.signum(gap) * 2), F.lit(-2.0)), F.lit(2.0))  # a slope may vanish
        moved = F.col("tilt") + step
        inside = (moved > low) & (moved < high)
        nearer = F.when(inside, moved).when(F.abs(low + high) < float("inf"), (low + high) / 2).otherwise(F.col("tilt") + F.signum(gap) * 2)
        state = cut(
            state.drop("taken", "slope", "error").join(sums, "key", "left")
            .select("key", "source_size", "mean", "target", F.coalesce(nearer, "tilt").alias("tilt"), F.coalesce(low, "low").alias("low"), F.coalesce(high, "high").alias("high"), F.coalesce(F.try_divide(F.abs(gap), "target"), F.lit(0.0)).alias("error")),
            "tilts",
        )
        if (state.agg(F.max("error")).first()[0] or 0) < TOLERANCE:
            break
    return state


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target of every row."""
    rows = docs.select("doc_id", source_key(F.col("source")).alias("key"), words(F.col("text")).alias("size"))
    sources = cut(targets(rows.groupBy("key", "size").agg(F.count("*").alias("n"))), "mix-targets")
    return rows.join(sources, "key").select("doc_id", "size", "source_size", "target")


def rounded(classes: DataFrame) -> DataFrame:
    """(key, size, copies) of classes (key, target, size, n, rate): whole copies of each size, near the target together."""
    sizes = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("size"), "n", "rate")))
    lists = classes.groupBy("key").agg(F.first("target").alias("target"), sizes.alias("sizes"), (CAP * F.sum(F.col("n") * F.col("size"))).cast("double").alias("most"))

    def step(acc: Column, x: Column) -> Column:
        size = -x["size"]
        most = acc["most"] - CAP * x["n"] * size  # what the smaller sizes can take
        rest = acc["rest"] - x["n"] * x["rate"] * size  # what they are expected to take
        low, high = F.ceil((acc["left"] - most) / size), F.floor(acc["left"] / size)
        wanted = F.least(F.greatest(F.round((acc["left"] - rest) / size), low), high)
        beyond = F.when(acc["left"] - high * size - most <= low * size - acc["left"], high).otherwise(low)
        taken = F.least(F.greatest(F.when(low <= high, wanted).otherwise(beyond), F.lit(0)), CAP * x["n"]).cast("long")
        found = F.concat(acc["found"], F.array(F.struct(size.alias("size"), taken.alias("copies"))))
        return F.struct((acc["left"] - taken * size).alias("left"), rest.alias("rest"), most.alias("most"), found.alias("found"))

    def chunk(acc: Column, k: Column) -> Column:
        start = F.struct(acc["left"].alias("left"), acc["rest"].alias("rest"), acc["most"].alias("most"), none.alias("found"))
        done = F.aggregate(F.slice("sizes", k * CHUNK + 1, F.lit(CHUNK)), start, step)
        return F.struct(done["left"].alias("left"), done["rest"].alias("rest"), done["most"].alias("most"), F.concat(acc["chunks"], F.array(done["found"])).alias("chunks"))

    none = F.array().cast("array<struct<size:bigint,copies:bigint>>")
    chunks = F.sequence(F.lit(0), F.floor((F.size("sizes") - 1) / CHUNK).cast("int"))
    start = F.struct(F.col("target").alias("left"), F.col("target").alias("rest"), F.col("most"), F.array().cast("array<array<struct<size:bigint,copies:bigint>>>").alias("chunks"))
    return lists.select("key", F.explode(F.flatten(F.aggregate(chunks, start, chunk)["chunks"])).alias("x")).select("key", "x.size", "x.copies")


def copies(docs: DataFrame) -> DataFrame:
    """doc_id, key, size, source_size, target, rate, copies of every row; docs: doc_id, text, source."""
    rows = docs.select(F.col("doc_id"), source_key(F.col("source")).alias("key"), words(F.col("text")).alias("size"))
    rows = cut(rows.groupBy("doc_id", "key", "size").agg(F.count("*").alias("n")), "mix-rows")
    sizes = cut(rows.groupBy("key", "size").agg(F.sum("n").alias("n")), "mix-sizes")
    sources = solve(sizes, cut(targets(sizes), "mix-targets"))
    fixed = F.when(F.col("target") >= CAP * F.col("source_size"), F.lit(float(CAP))).otherwise(F.lit(0.0))
    own = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(rate(F.col("size"), F.col("mean"), F.round("tilt", 9)))
    classes = sizes.join(sources, "key").select("key", "source_size", "target", "size", "n", F.when(F.col("tilt").isNull(), fixed).otherwise(own).alias("rate"))
    taken = rounded(classes.where("size > 0"))
    taken = cut(classes.join(taken, ["key", "size"], "left").withColumn("copies", F.coalesce("copies", (F.col("rate") * F.col("n")).cast("long"))), "mix-classes")
    # Repeated rows are numbered and every row of a size gets a rank; a size is dealt to several tasks by a salt.
    salts = max(16, (sizes.agg(F.sum("n")).first()[0] or 0) // RANK_ROWS)
    each = rows.select("doc_id", "key", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("number"))
    each = each.withColumn("hash", F.xxhash64("doc_id", "number")).withColumn("salt", F.pmod("hash", F.lit(salts)))
    before = Window.partitionBy("key", "size").orderBy("salt")
    starts = each.groupBy("key", "size", "salt").agg(F.count("*").alias("m")).select("key", "size", "salt", (F.sum("m").over(before) - F.col("m")).alias("start"))
    rank = F.row_number().over(Window.partitionBy("key", "size", "salt").orderBy("hash", "doc_id", "number"))
    ranked = each.withColumn("rank", rank).join(starts, ["key", "size", "salt"])
    out = ranked.join(taken, ["key", "size"])
    base = F.floor(F.col("copies") / F.col("n"))
    more = (F.col("start") + F.col("rank") <= F.col("copies") - base * F.col("n")).cast("long")
    return out.select("doc_id", "key", "size", "source_size", "target", "rate", (base + more).alias("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """Every document as often as its copies say; rows that repeat an id, a source and a size share their copies by chance."""
    doc_id, key, size, n, total, here, size_here, row, copy = free_names(docs, "doc_id", "key", "size", "n", "total", "here", "size_here", "row", "copy")
    plan = copies(docs.select("doc_id", "text", "source")).groupBy("doc_id", "key", "size").agg(F.count("*").alias(n), F.sum("copies").alias(total))
    plan = plan.withColumnsRenamed({"doc_id": doc_id, "key": key, "size": size}).hint("merge")
    rows = docs.withColumns({here: source_key(F.col("source")), size_here: words(F.col("text")), row: F.monotonically_increasing_id()})
    joined = rows.join(plan, F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col(here) == F.col(key)) & (F.col(size_here) == F.col(size)))
    base = F.floor(F.col(total) / F.col(n))
    own = base + (uniform(F.lit(11), F.col(row)) * F.col(n) < F.col(total) - base * F.col(n)).cast("long")
    return joined.where(F.col(total) > 0).withColumn(copy, own).where(F.col(copy) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copy)))).select(*docs.columns)


#: DuckDB SQL for sizes and targets over documents.
TARGETS_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w FROM d GROUP BY source),
c AS (
  SELECT *, n / w AS r, 1.5 * sum(n) OVER () - coalesce(sum(2 * n) OVER (ORDER BY n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS share,
    sum(w) OVER (ORDER BY n / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM s),
l AS (SELECT min_by(share / weights, r) AS level FROM c WHERE share / weights * w < 2 * n)
SELECT doc_id, size, n AS source_size, CAST(coalesce(least(2 * n, level * w), 2 * n) AS DOUBLE) AS target
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source, l
"""
