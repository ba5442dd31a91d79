"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Targets.  Sources in code-point order (null last) take the weights in turn
and share ``share`` times the words of all sources; a target stops at
``most`` times its source's size and the excess goes to the others by weight
until no target is above.  The end of that process is one level L with
``target = min(most * size, L * weight)``, found from running sums over the
sources in the order in which they would reach their limit.

Sampling.  A document is expected ``rate = target / size`` times, the same
for every document of its source.  Documents of a source are laid end to end
in an order that groups equal sizes, so the prefix sum after the k-th
document is ``k * rate``; a random offset in [0, 1) is added and a document
is emitted once for every integer its stretch crosses.  The order is by size
class, so every class is sampled evenly and the words taken come close to
the target.  A source of few documents with one very long among them can
still miss it by that one; so ``OFFSETS`` offsets are drawn for a source and
the one whose sample comes closest to the target is used.

A prefix sum needs the position of a document within its source, and one
source may hold most rows.  Each (source, size class) is cut into about the
square root of its row count of chunks by a hash of the id; rows are numbered
inside a chunk, chunks by their counts.  Neither step sees more than the
square root of a source's rows at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import stage, word_array

WEIGHTS = (5, 2, 1)
#: Size classes per doubling of the size.
CLASSES = 8
#: Offsets drawn for each source.
OFFSETS = 16


def size_class(size: Column) -> Column:
    """Sizes below 16 by themselves, larger ones in 8 steps per doubling; increases with the size."""
    shift = F.greatest(F.length(F.bin(size)) - F.lit(4), F.lit(0)).cast("long")
    return shift * CLASSES + F.floor(size / F.pow(F.lit(2.0), shift)).cast("long")


def hash32(value: Column) -> Column:
    """32 bits of the MD5 of a value's text (null: of the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def row_hash(id_: Column, text: Column) -> Column:
    """32 bits of an id and its text: rows without an id, or that share one, still spread."""
    return hash32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) with its target added.

    One row per source goes through one sorted window; sources without words
    get the target 0.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(x) for x in weights])
    placed = sizes.withColumn("place", F.row_number().over(order) - 1)
    placed = placed.withColumn("weight", F.element_at(w, (F.col("place") % len(weights) + 1).cast("int")).cast("double"))
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = placed.withColumn(
        "level", (F.sum("source_size").over(everything) * share
                  - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after))
    open_ = F.when(F.col("level") * F.col("weight") <= most * F.col("source_size"), F.col("level"))
    return level.withColumn("found", F.first(open_, ignorenulls=True).over(everything)).select(
        "source", "source_size",
        F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(
            F.least(most * F.col("source_size"), F.coalesce(F.col("found") * F.col("weight"), most * F.col("source_size")))
        ).alias("target"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """Per row of ``docs``: (id, source, size, source_size, target, copies).

    Null texts have size 0 and a null source is a source of its own.  Rows
    with equal or null ids are told apart by their text's hash; wholly equal
    rows are interchangeable.  A source whose documents have no words has
    target 0 and is not taken.  Reruns give the same result: the only random
    values are the offsets of a source, taken from hashes of it and ``seed``.
    """
    measured = stage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.size(word_array(F.col(text_col))).cast("long").alias("size"),
        F.xxhash64(text_col).alias("tie"), row_hash(F.col(id_col), F.col(text_col)).alias("h")
    ).withColumn("class", size_class(F.col("size"))), "sizes")
    classes = stage(measured.groupBy("source", "class").agg(
        F.count("*").alias("n"), F.sum("size").alias("words")), "size-classes")
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    cut = classes.select(F.col("source").alias("s"), F.col("class").alias("c"),
                         F.ceil(F.sqrt(F.col("n") / 8)).alias("chunks"))
    chunked = measured.join(cut, measured.source.eqNullSafe(cut.s) & (measured["class"] == cut.c)).select(
        "id", "source", "size", "tie", "h", "class", F.floor(F.col("h") * F.col("chunks") / F.lit(2.0 ** 32)).alias("chunk"))
    along = Window.partitionBy("source").orderBy("class", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    counted = chunked.groupBy("source", "class", "chunk").agg(F.count("*").alias("m")).select(
        F.col("source").alias("s"), F.col("class").alias("c"), F.col("chunk").alias("k"),
        F.coalesce(F.sum("m").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "class", "chunk").orderBy("h", F.col("id").asc_nulls_first(), "size", "tie")
    ranked = chunked.withColumn("r", F.row_number().over(inside))
    placed = ranked.join(counted, ranked.source.eqNullSafe(counted.s) & (ranked["class"] == counted.c)
                         & (ranked.chunk == counted.k)).drop("s", "c", "k")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    drawn = F.transform(F.sequence(F.lit(0), F.lit(OFFSETS - 1)), lambda j: hash32(F.concat(
        F.lit(seed + ":"), j.cast("string"), F.lit(":"), F.coalesce("source", F.lit("")))) / F.lit(2.0 ** 32))
    aims = stage(targets.select(F.col("source").alias("s"), "source_size", "target", rate.alias("rate"), drawn.alias("drawn")), "targets")
    numbered = stage(placed.select("id", "source", "size", "tie", (F.col("before") + F.col("r")).alias("k")), "positions")
    rated = numbered.join(aims, numbered.source.eqNullSafe(aims.s)).drop("s")
    words = [F.sum(_crossed(F.col("drawn")[j]) * F.col("size")) for j in range(OFFSETS)]
    taken = rated.groupBy("source").agg(F.first("target").alias("aim"), F.array(*words).alias("words"), F.first("drawn").alias("u"))
    nearest = F.array_min(F.transform("words", lambda w, j: F.struct(F.abs(w - F.col("aim")).alias("off"), j.alias("j"))))
    chosen = taken.select(F.col("source").alias("s"), F.get(F.col("u"), nearest["j"]).alias("offset"))
    final = rated.join(chosen, rated.source.eqNullSafe(chosen.s))
    return final.select("id", "source", "size", "tie", "source_size", "target", _crossed(F.col("offset")).cast("long").alias("copies"))


def _crossed(offset: Column) -> Column:
    """How many integers the stretch of the k-th document crosses."""
    return F.floor(F.col("k") * F.col("rate") + offset) - F.floor((F.col("k") - 1) * F.col("rate") + offset)


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document what the mix takes of it."""
    return mix_plan(docs).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the plan takes it, all columns unchanged.

    A document without words counts for nothing and is emitted as its stretch says, like any other.
    """
    plan = mix_plan(docs, id_col, text_col, source_col, **options)
    # equal rows share one plan row; their copies are added up and dealt evenly again
    plan = plan.groupBy("id", "source", "size", "tie").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    plan = plan.select(F.col("id").alias("__id"), F.col("source").alias("__source"), F.col("tie").alias("__tie"), "copies", "rows")
    own = docs.withColumn("__hash", F.xxhash64(text_col))
    joined = own.join(plan.withColumnRenamed("copies", "__copies").withColumnRenamed("rows", "__rows"),
                      own[id_col].eqNullSafe(F.col("__id")) & own[source_col].eqNullSafe(F.col("__source"))
                      & (F.col("__hash") == F.col("__tie")))
    every = Window.partitionBy("__id", "__source", "__tie").orderBy(F.lit(1))
    return joined.withColumn("__row", F.when(F.col("__rows") > 1, F.row_number().over(every)).otherwise(1)).withColumn(
        "__times", F.floor(F.col("__copies") * F.col("__row") / F.col("__rows"))
        - F.floor(F.col("__copies") * (F.col("__row") - 1) / F.col("__rows"))).where("__times > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)


MIX_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 8))::bigint as h from documents),
bands as (select *, greatest(length(bin(size)) - 4, 0) as shift from sized),
classed as (select doc_id, source, size, h, shift * 8 + (size >> shift) as class from bands),
totals as (select source, sum(size)::bigint as source_size from classed group by source),
weighted as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end::double as weight,
         row_number() over (order by source nulls last) as place from totals),
levels as (
  select *, (sum(source_size) over ()::double * 1.5::double
             - 2.0::double * coalesce(sum(source_size) over (order by source_size / weight, place rows between unbounded preceding and 1 preceding), 0)::double)
            / sum(weight) over (order by source_size / weight, place rows between current row and unbounded following) as level
  from weighted),
chosen as (
  select min_by(level, source_size / weight) as found from levels where level * weight <= 2.0::double * source_size),
targets as (
  select source, source_size, case when source_size = 0 then 0.0::double else
         least(2.0::double * source_size, coalesce(found * weight, 2.0::double * source_size)) end as target
  from levels left join chosen on true),
placed as (
  select c.doc_id, c.source, c.size, t.source_size, t.target,
         row_number() over (partition by c.source order by c.class, c.h, c.doc_id nulls first) as k,
         case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as rate
  from classed c join targets t on c.source is not distinct from t.source),
tried as (
  select *, ('0x' || substr(md5('mix:' || j || ':' || coalesce(source, '')), 1, 8))::bigint / 4294967296.0::double as shift
  from placed, range(16) r(j)),
sampled as (select *, (floor(k * rate + shift) - floor((k - 1) * rate + shift))::bigint as copies from tried),
summed as (select source, j, abs(sum(copies * size)::double - any_value(target)) as off from sampled group by source, j),
best as (select source, j from summed qualify row_number() over (partition by source order by off, j) = 1)
select s.doc_id, s.size, s.source_size, s.target, s.copies * s.size as taken
from sampled s join best b on s.source is not distinct from b.source and s.j = b.j
"""
