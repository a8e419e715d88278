"""Mixing sources to target weights by Sainte-Lague apportionment.

1. *Targets.*  Sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1,
   ... and share all words of the corpus.  A target stops at ``MAX_REPEATS``
   times its source's words; the excess is shared again by weight among the
   others until none is above (water filling, in closed form over the sources
   sorted by limit per weight).
2. *Blocks.*  The mix consists of blocks of ``BLOCK_WORDS`` words.  Sources get
   blocks by highest quotients target / (2 k + 1); a source never gets more
   than its limit.
3. *Quotas per shard.*  A source's documents are spread by hash over shards of
   about ``DOCS_PER_SHARD`` documents; the source's blocks go to its shards by
   the same method, with the shards' words as votes.  Quotas are integers.
4. *Seeded selection.*  In a shard the documents stand in a seeded hash order,
   their words one after another, read round and round; the shard's quota is
   the first ``quota`` blocks of that stream.  A document's words are thus
   taken as often as full rounds pass it, once more where the last round
   reaches, and never more than ``MAX_REPEATS`` times.

All steps are DataFrame expressions.  A hot source is many shards, each sorted
in a task of its own; only one row per source (targets) or per shard (quotas)
is ranked together.  Blocks are counted, never made as rows.

Nulls and edge cases: a null or blank text has size 0 and takes 0.  A null
source is a source of its own.  Null doc_ids are ordered by an empty id; rows
equal in doc_id and size are interchangeable (their results are the same
multiset in any order).  An empty table gives no rows.  Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeworks.llm.shared import stored
from tapeworks.llm.text import WORD_PATTERN

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 16
DOCS_PER_SHARD = 4_000
SEED = "mix-1"


def _digits(*parts: Column | str) -> Column:
    """60 bits of the MD5 of the parts, the same number in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, docs, source_size, target: one row per source of ``sizes``
    (source, size)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("ratio", "rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    on = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    level = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(on)
    return (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
            .withColumn("rank", F.row_number().over(order)).withColumn("weight", weight)
            .withColumn("most", F.col("source_size") * MAX_REPEATS)
            .withColumn("ratio", F.col("most") / F.col("weight"))
            .withColumn("total", F.sum("source_size").over(everything))
            .withColumn("level", level)
            # The level rises while limits stay below it and falls after the first above it, which it holds from.
            .withColumn("level", F.max("level").over(everything))
            .select("source", "docs", "source_size",
                    F.when(F.col("ratio") <= F.col("level"), F.col("most").cast("double"))
                    .otherwise(F.col("level") * F.col("weight")).alias("target")))


def apportion(parties: DataFrame, group: list[str], key: str) -> DataFrame:
    """``parties`` plus ``seats``: of each group's ``house`` seats by highest
    quotients ``votes`` / (2 k + 1), at most ``most`` each; ties go to the
    smaller ``key`` (null last).

    Not seat by seat: with n parties, every divisor method with rounding gives
    a party at least what the divisor votes / (house - n / 2) gives it, and at
    most what votes / (house + n / 2) gives; only the few seats between the two
    (2 n per group at most) are ranked.
    """
    whole = Window.partitionBy(*group)
    share = lambda extra: F.floor(F.col("votes") * (F.col("house") + extra * F.col("n")) / F.col("all") + 0.5)
    sure = F.when((F.col("all") > 0) & (F.col("house") > F.col("n") / 2), share(-0.5)).otherwise(0)
    top = F.when(F.col("all") > 0, share(0.5) + 1).otherwise(0)
    bounds = (parties.withColumn("n", F.count("*").over(whole)).withColumn("all", F.sum("votes").over(whole))
              .withColumn("sure", F.least("most", sure)).withColumn("top", F.least("most", top))
              .withColumn("open", F.col("house") - F.sum("sure").over(whole)))
    seats = bounds.select(*group, key, "open", "sure", F.explode_outer(
        F.when(F.col("top") > F.col("sure"), F.sequence("sure", F.col("top") - 1))).alias("k"), "votes")
    best = Window.partitionBy(*group).orderBy(
        (F.col("votes") / (2 * F.col("k") + 1)).desc_nulls_last(), F.col(key).asc_nulls_last())
    won = (seats.withColumn("place", F.row_number().over(best))
           .withColumn("won", (F.col("k").isNotNull() & (F.col("place") <= F.col("open"))).cast("long"))
           .groupBy(*group, key).agg((F.first("sure") + F.sum("won")).alias("seats")))
    names = [*group, key]
    won = won.select(*[F.col(c).alias(f"_{c}") for c in names], "seats")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return parties.join(won, on).drop(*[f"_{c}" for c in names])


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, docs_per_shard: int = DOCS_PER_SHARD,
        seed: str = SEED) -> DataFrame:
    """doc_id, size, source, source_size, target, taken: one row per document."""
    sizes = stored(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    sources = stored(source_targets(sizes), "sources")
    house = F.floor(F.sum("votes").over(Window.partitionBy()) / block_words)
    quotas = apportion(
        sources.withColumn("votes", F.col("target")).withColumn("house", house)
        .withColumn("most", F.floor(F.col("source_size") * MAX_REPEATS / block_words))
        .withColumn("all_sources", F.lit(0)), ["all_sources"], "source")
    quotas = stored(quotas.select(
        F.col("source").alias("_source"), "source_size", "target", F.col("seats").alias("house"),
        F.ceil(F.col("docs") / docs_per_shard).alias("shards")), "source-quotas")
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = (sizes.join(quotas, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
              .withColumn("shard", _digits(F.lit(seed), F.lit("shard"), text_id) % F.col("shards")))
    shards = apportion(
        placed.groupBy("source", "shard").agg(F.sum("size").alias("votes"), F.first("house").alias("house"))
        .withColumn("most", F.floor(F.col("votes") * MAX_REPEATS / block_words)), ["source"], "shard")
    shards = shards.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), F.col("votes").alias("words"),
                           (F.col("seats") * block_words).alias("quota"))
    stream = Window.partitionBy("source", "shard").orderBy(_digits(F.lit(seed), text_id), "doc_id", "size")
    start = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    rounds = F.when(F.col("words") > 0, F.floor(F.col("quota") / F.col("words"))).otherwise(0)
    last = F.col("quota") - rounds * F.col("words")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(last, F.col("start") + F.col("size")) - F.col("start"))
    return (placed.withColumn("start", start)
            .join(shards, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
            .select("doc_id", "size", "source", "source_size", "target", taken.cast("long").alias("taken")))


def write_mix(docs: DataFrame, whole_texts: bool = False, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document once for each
    full round, and once more cut to its first words where the last round ends
    in it.  Documents that the mix doesn't reach go.  A cut text is its words
    joined by one space, and ``n_chars`` follows it.  With ``whole_texts`` the
    last round ends at the nearest end of a document instead, so no text is
    cut and a shard has up to half a document more or less than its quota."""
    names = docs.columns
    plan = mix(docs, **options)
    same = Window.partitionBy("_id", "_source", "_size")
    plan = plan.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "taken")
    plan = plan.withColumn("_k", F.row_number().over(same.orderBy("taken")))
    full = docs.select(F.struct(*names).alias("row"), F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
                       word_count().alias("_size"))
    full = full.withColumn("_k", F.row_number().over(same.orderBy(F.xxhash64("row.text"))))
    keys = ["_id", "_source", "_size", "_k"]
    on = full["_id"].eqNullSafe(plan["_id"])
    for c in keys[1:]:
        on = on & full[c].eqNullSafe(plan[c])
    both = full.join(plan.where("taken > 0"), on).select("row", full["_size"].alias("size"), "taken")
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    part = (F.col("taken") % F.col("size")).cast("int")
    if whole_texts:
        whole, part = whole + F.when(2 * part >= F.col("size"), 1).otherwise(0), F.lit(0)
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    cut = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(WORD_PATTERN), F.lit(0)), 1, F.col("words")), " ")
    out = both.select("row", F.explode(copies).alias("words"))
    row = F.col("row").withField("text", F.when(F.col("words") > 0, cut).otherwise(F.col("row.text")))
    if "n_chars" in names:
        chars = F.when(F.col("words") > 0, F.length(cut).cast("long")).otherwise(F.col("row.n_chars").cast("long"))
        row = row.withField("n_chars", chars)
    return out.select(row.alias("row")).select("row.*").select(*[F.col(c).cast(t).alias(c) for c, t in docs.dtypes])
