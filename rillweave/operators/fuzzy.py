"""Probable matches: similar names and hire dates within a window.

Records collapse to *cells* (date bucket, token-sorted name) first, so work grows with
distinct names per bucket and not with copies. Similar names are found by shared grams, the
runs of g letters: an insertion or deletion spoils at most g of them, so two similar names share
a known number, in the same order and close to the same place. If grams are ranked, rare ones first,
and a name of n grams shares c, one of its first n - c + 1 is shared, and it is among the first ones
of the other name too. That turns the similarity join into an equi-join that misses nothing.
A name of p letters has at most p grams of each of three lengths, and for the usual threshold about
0.6 p in all, whatever its length. The exact score is computed for what meets, once per pair of names.

Flags come from cells alone, in linear work. The review list names links between cells, each
with its number of record pairs, and the records of the linked cells; ``fuzzy_pairs`` lists the record
pairs themselves, of all links or of chosen ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillweave.config import SkewPolicy
from rillweave.functions.dates import MICROS_PER_DAY, epoch_micros
from rillweave.functions.similarity import (
    allowed_distance,
    indel_distance,
    similarity,
    token_sort,
)
from rillweave.functions.text import full_name, title_case
from rillweave.operators.interval import bucket_of, neighbour_slots, window_micros
from rillweave.operators.skew import hot_groups, lookup

_NAME = f"lower({full_name('first_name', 'last_name')})"


def _cell(bucket: str, key: str) -> str:
    return f"concat({bucket}, '|', {key})"


def _with_cell(df: DataFrame, days: int) -> DataFrame:
    """Adds the instant ``_t`` and the cell; both are null without a hire date."""
    return df.withColumn("_t", F.expr(epoch_micros("hire_date"))).withColumn(
        "_cell", F.expr(_cell(bucket_of("_t", days), token_sort(_NAME)))
    )


def name_cells(df: DataFrame, days: int) -> DataFrame:
    """One row per date bucket and token-sorted name, with size and time span."""
    return (
        df.where("hire_date IS NOT NULL")
        .selectExpr(f"{epoch_micros('hire_date')} AS t", f"{token_sort(_NAME)} AS key")
        .groupBy(F.expr(bucket_of("t", days)).alias("bucket"), "key")
        .agg(F.expr("count(1) AS n"), F.expr("min(t) AS min_t"), F.expr("max(t) AS max_t"))
    )


#: Lengths of grams, the most telling first.
_GRAMS = (3, 2, 1)
#: So many of the most frequent grams are known as such and go to the end of the ranking. It
#: affects cost only.
_FREQUENT = 20_000


def _shared_grams(total: str, threshold: int, g: int) -> str:
    """Fewest common grams of ``g`` letters of two similar names of ``total`` letters.

    Deletions in one name spoil g grams of it each, letters that the other has instead g - 1. A distance
    has the parity of ``total``, so the allowed one is rounded down to it.
    """
    allowed = allowed_distance(total, threshold)
    distance = f"({allowed} - pmod({allowed} + {total}, 2))"
    return f"(({total} - {2 * (g - 1)} - {2 * g - 1} * {distance}) div 2)"


def _gram_length(total: str, threshold: int) -> str:
    """The longest grams of which two similar names of ``total`` letters share one for sure; they share a letter anyway."""
    cases = " ".join(f"WHEN {_shared_grams(total, threshold, g)} >= 1 THEN {g}" for g in _GRAMS[:-1])
    return f"CASE {cases} ELSE {_GRAMS[-1]} END"


def _prefixes(names: DataFrame, threshold: int) -> DataFrame:
    """p, g, taken: how many grams of ``g`` letters a name of p letters must be found by. A row per length and g."""
    shortest, longest = f"cast(ceil(p * {threshold}D / {200 - threshold}) AS int)", f"cast(p * {200 - threshold} div {threshold} AS int)"
    shared = "CASE g " + " ".join(f"WHEN {g} THEN {_shared_grams('(p + q)', threshold, g)}" for g in _GRAMS) + " END"
    return (
        names.select("p").distinct()
        .withColumn("q", F.expr(f"explode(sequence(greatest({shortest} - 1, 1), {longest} + 1))"))
        .withColumn("g", F.expr(_gram_length("(p + q)", threshold)))
        .groupBy("p", "g").agg(F.max(F.expr(f"p - g + 1 - {shared} + 1")).alias("taken"))
        .where("taken > 0 AND p >= g")
    )


def _signatures(cells: DataFrame, threshold: int) -> DataFrame:
    """key, p, g, gram, at: the rarest grams of each different name, with its buckets."""
    names = (
        cells.where("key <> ''").groupBy("key").agg(F.collect_set("bucket").alias("buckets"))
        .withColumn("p", F.expr("length(key)"))
    )
    # A row per length: the longest name bounds their number, hence the broadcast.
    grams = names.join(F.broadcast(_prefixes(names, threshold)), "p").selectExpr(
        "key", "buckets", "p", "g", "taken", "posexplode(transform(sequence(1, p - g + 1), i -> substr(key, i, g))) AS (at, gram)"
    )
    frequent = (
        grams.groupBy("g", "gram").agg(F.expr("count(1) AS n")).orderBy(F.desc("n"), "gram").limit(_FREQUENT)
    )
    ranked = grams.join(F.broadcast(frequent), ["g", "gram"], "left").groupBy("key", "g").agg(
        F.first("buckets").alias("buckets"), F.first("p").alias("p"), F.first("taken").alias("taken"),
        F.sort_array(F.collect_list(F.expr("struct(coalesce(n, 0L) AS n, xxhash64(gram) AS h, gram, at)"))).alias("all"),
    )
    return ranked.selectExpr("key", "buckets", "p", "g", "inline(transform(slice(all, 1, taken), x -> struct(x.gram, x.at)))")


def _block_of(column: str) -> str:
    return f"coalesce(cast(pmod(xxhash64({column}), blocks) AS int), 0)"


def _all_blocks(blocks: str) -> str:
    return f"explode(sequence(0, coalesce({blocks}, 1) - 1))"


def similar_cells(
    cells: DataFrame, threshold: int, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """Pairs of cells in the same or adjacent buckets whose different names reach ``threshold``.

    A gram that many names of a bucket are found by is split into blocks of both sides, by their
    numbers; each block of one side meets each of the other.
    """
    found = _signatures(cells, threshold)
    sig = ["slot", "g", "gram"]
    longer = found.selectExpr("explode(buckets) AS slot", "g", "gram", "at", "key")
    shorter = longer.withColumnRenamed("slot", "bucket").withColumn("slot", neighbour_slots("bucket"))
    sides = shorter.selectExpr(*sig, "1L AS nx", "0L AS ny").unionAll(longer.selectExpr(*sig, "0L AS nx", "1L AS ny"))
    crowded = (
        sides.groupBy(*sig).agg(F.sum("nx").alias("nx"), F.sum("ny").alias("ny"))
        .where(f"greatest(nx, ny) > {policy.block_rows} AND ny > 0")
        .selectExpr(*sig, *(f"cast(ceil({n} / {policy.block_rows}) AS int) AS {b}" for n, b in (("nx", "bx"), ("ny", "by"))))
    )
    x = shorter.join(crowded, sig, "left").withColumn("blocks", F.col("bx")).selectExpr(
        *sig, f"{_block_of('key')} AS i", "by", "bucket AS bucket_x", "key AS x", "at AS at_x"
    ).withColumn("j", F.expr(_all_blocks("by"))).drop("by")
    y = longer.join(crowded, sig, "left").withColumn("blocks", F.col("by")).selectExpr(
        *sig, f"{_block_of('key')} AS j", "bx", "slot AS bucket_y", "key AS y", "at AS at_y"
    ).withColumn("i", F.expr(_all_blocks("bx"))).drop("bx")
    total = "(length(x) + length(y))"
    limit = allowed_distance(total, threshold)
    grown = "(length(y) - length(x))"
    # What the edits allow the place of a shared gram to move by.
    candidates = x.join(y, [*sig, "i", "j"]).where(
        f"""(length(x) < length(y) OR (length(x) = length(y) AND x < y))
            AND {grown} <= {limit} AND g = {_gram_length(total, threshold)}
            AND 2 * (at_y - at_x) BETWEEN {grown} - {limit} AND {grown} + {limit}
            AND levenshtein(x, y, {limit}) >= 0"""
    )
    # A name pair is scored once. Its bucket pairs are bounded by the range of dates.
    named = candidates.groupBy("x", "y").agg(
        F.expr("collect_set(struct(bucket_x, bucket_y)) AS places")
    )
    scored = named.withColumn("distance", indel_distance("x", "y"))
    return scored.where(f"distance <= {limit}").selectExpr(
        "x", "y", f"{similarity('distance', total)} AS score", "inline(places)"
    )


def flag_probable(
    df: DataFrame,
    cells: DataFrame,
    similar: DataFrame,
    days: int,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """Adds ``probable_match_flag``: whether the record has a probable match.

    A record matches if its cell, or a similar one in its bucket, holds anybody else, or
    if the nearest date of a similar cell in an adjacent bucket lies within the window.
    So three numbers per cell decide, and no pair is formed.
    """
    sides = similar.selectExpr(
        "inline(array(struct(bucket_x AS bucket, x AS key, bucket_y AS other_bucket, y AS other),"
        " struct(bucket_y AS bucket, y AS key, bucket_x AS other_bucket, x AS other)))"
    )
    others = cells.selectExpr("bucket AS other_bucket", "key AS other", "min_t", "max_t")
    by_similar = sides.join(others, ["other_bucket", "other"]).selectExpr(
        "bucket",
        "key",
        "other_bucket = bucket AS close",
        "CASE WHEN other_bucket > bucket THEN min_t END AS next_t",
        "CASE WHEN other_bucket < bucket THEN max_t END AS previous_t",
    )
    along = Window.partitionBy("key").orderBy("bucket")
    next_t = F.when(F.lead("bucket").over(along) == F.col("bucket") + 1, F.lead("min_t").over(along))
    previous_t = F.when(F.lag("bucket").over(along) == F.col("bucket") - 1, F.lag("max_t").over(along))
    by_same = cells.select(
        "bucket",
        "key",
        (F.col("n") > 1).alias("close"),
        next_t.alias("next_t"),
        previous_t.alias("previous_t"),
    ).where("close OR next_t IS NOT NULL OR previous_t IS NOT NULL")
    reach = (
        by_same.unionAll(by_similar)
        .groupBy("bucket", "key")
        .agg(F.expr("max(close) AS close"), F.expr("min(next_t) AS next_t"), F.expr("max(previous_t) AS previous_t"))
        .selectExpr(f"{_cell('bucket', 'key')} AS _cell", "close", "next_t", "previous_t")
    )
    hot = hot_groups(cells, "n", policy).selectExpr(f"{_cell('bucket', 'key')} AS _cell")
    width = window_micros(days)
    joined = lookup(_with_cell(df, days), reach, "_cell", "employee_id", policy, hot)
    return joined.selectExpr(
        *df.columns,
        f"coalesce(close OR _t >= next_t - {width} OR _t <= previous_t + {width}, false) AS probable_match_flag",
    )


def cell_links(cells: DataFrame, similar: DataFrame) -> DataFrame:
    """bucket_1, name_1, bucket_2, name_2, score of each pair of cells whose records may be partners, each once.

    Also each cell with itself, and with its name in the next bucket. The earlier bucket comes first, and in a bucket the
    smaller name.
    """
    along = Window.partitionBy("key").orderBy("bucket")
    same = cells.where("n > 1").selectExpr("bucket AS bucket_1", "key AS name_1", "bucket AS bucket_2", "key AS name_2", "100.0D AS score")
    beside = (
        cells.withColumn("follower", F.lead("bucket").over(along)).where("follower = bucket + 1")
        .selectExpr("bucket AS bucket_1", "key AS name_1", "follower AS bucket_2", "key AS name_2", "100.0D AS score")
    )
    ends = "struct(bucket_x AS bucket, x AS name)", "struct(bucket_y AS bucket, y AS name)"
    different = similar.selectExpr(f"least({', '.join(ends)}) AS a", f"greatest({', '.join(ends)}) AS b", "score").selectExpr(
        "a.bucket AS bucket_1", "a.name AS name_1", "b.bucket AS bucket_2", "b.name AS name_2", "score"
    )
    return same.unionAll(beside).unionAll(different)


_LINK = ["bucket_1", "name_1", "bucket_2", "name_2"]
#: Parts of a bucket in which partners of cells in adjacent buckets are counted.
_SLICES = 64


def _pairs_across(df: DataFrame, links: DataFrame, days: int) -> DataFrame:
    """n_pairs of each of ``links`` between adjacent buckets: record pairs within the window.

    A record of the first cell reaches those of the second up to its own instant plus the window. Distinct
    instants are merged, slice by slice of the bucket; what lies in earlier slices counts whole.
    """
    width = window_micros(days)
    instants = (
        df.where("hire_date IS NOT NULL")
        .selectExpr(f"{epoch_micros('hire_date')} AS t", f"{token_sort(_NAME)} AS name")
        .groupBy("t", "name").agg(F.expr("count(1) AS n"))
        .withColumn("bucket", F.expr(bucket_of("t", days)))
    )
    first = links.join(instants.selectExpr("bucket AS bucket_1", "name AS name_1", "t", "n"), ["bucket_1", "name_1"])
    second = links.join(instants.selectExpr("bucket AS bucket_2", "name AS name_2", "t", "n"), ["bucket_2", "name_2"])
    events = first.selectExpr(*_LINK, f"t + {width} AS t", "n AS na", "0L AS nb").unionAll(
        second.selectExpr(*_LINK, "t", "0L AS na", "n AS nb")
    ).withColumn("slice", F.expr(f"t div {-(-width // _SLICES)}"))
    within = Window.partitionBy(*_LINK, "slice").orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    slices = events.withColumn("reached", F.sum("nb").over(within)).groupBy(*_LINK, "slice").agg(
        F.sum(F.expr("na * reached")).alias("near"), F.sum("na").alias("na"), F.sum("nb").alias("nb")
    )
    before = Window.partitionBy(*_LINK).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return (
        slices.withColumn("whole", F.expr("na") * F.coalesce(F.sum("nb").over(before), F.lit(0)))
        .groupBy(*_LINK).agg(F.sum(F.expr("near + whole")).alias("n_pairs"))
    )


def review_links(df: DataFrame, cells: DataFrame, similar: DataFrame, days: int) -> DataFrame:
    """The review list in short: a row per pair of cells with partners, instead of one per pair of records.

    similarity_score, records_1 and records_2 (sizes of the cells) and n_pairs (record pairs within the window). A cell
    linked with itself holds partners of one name. Its size is that of the cells and of the similar names.
    """
    width = window_micros(days)

    def sized(side: int) -> DataFrame:
        return cells.selectExpr(
            f"bucket AS bucket_{side}", f"key AS name_{side}", f"n AS records_{side}", f"min_t AS min_{side}", f"max_t AS max_{side}"
        )

    links = cell_links(cells, similar).join(sized(1), ["bucket_1", "name_1"]).join(sized(2), ["bucket_2", "name_2"])
    # Cells of a bucket lie within the window; those beside each other may lie within it as a whole.
    settled = links.where(f"bucket_1 = bucket_2 OR max_2 - min_1 <= {width}").withColumn(
        "n_pairs", F.expr("if(bucket_1 = bucket_2 AND name_1 = name_2, records_1 * (records_1 - 1) div 2, records_1 * records_2)")
    )
    open_ = links.where(f"bucket_1 < bucket_2 AND max_2 - min_1 > {width} AND min_2 - max_1 <= {width}")
    counted = open_.join(_pairs_across(df, open_.select(*_LINK), days), _LINK)
    return settled.unionByName(counted).where("n_pairs > 0").selectExpr(
        *_LINK, "score AS similarity_score", "records_1", "records_2", "n_pairs"
    )


def review_records(df: DataFrame, links: DataFrame, days: int) -> DataFrame:
    """The records of the cells that ``links`` names: bucket, name, employee_id, hire_date, source_systems."""
    linked = links.selectExpr("inline(array(struct(bucket_1 AS bucket, name_1 AS name), struct(bucket_2 AS bucket, name_2 AS name)))")
    records = df.where("hire_date IS NOT NULL").withColumn("_t", F.expr(epoch_micros("hire_date"))).selectExpr(
        f"{bucket_of('_t', days)} AS bucket", f"{token_sort(_NAME)} AS name", "employee_id", "hire_date", "source_systems"
    )
    return records.join(linked.distinct(), ["bucket", "name"], "left_semi")


#: Comparisons of a task of ``fuzzy_pairs`` on average: its partitions follow the pairs it looks at, not its input.
PAIRS_PER_TASK = 4_000_000


def _tasks(cells: DataFrame, links: DataFrame) -> int:
    """How many tasks share the comparisons of ``links`` (cell_1, cell_2), at least as many as any shuffle has."""
    sizes = cells.selectExpr(f"{_cell('bucket', 'key')} AS cell", "n")
    total = (
        links.join(sizes.selectExpr("cell AS cell_1", "n AS n_1"), "cell_1")
        .join(sizes.selectExpr("cell AS cell_2", "n AS n_2"), "cell_2")
        .agg(F.expr("coalesce(sum(cast(n_1 AS double) * n_2), 0D)")).first()[0]
    )
    return max(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // PAIRS_PER_TASK))


def fuzzy_pairs(
    df: DataFrame,
    cells: DataFrame,
    links: DataFrame,
    days: int,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """The record pairs of ``links`` (``cell_links`` or ``review_links``, all or some of them), for review;
    record 1 is hired earlier (ties: smaller id).

    Large cells are cut into blocks, so that even the pairs of one very common name and
    date are produced by many tasks. Pairs are many times the records, so what does not
    depend on the pair is settled before the join.
    """
    score = "similarity_score" if "similarity_score" in links.columns else "score"
    large = cells.where(F.col("n") > policy.block_rows).selectExpr(
        f"{_cell('bucket', 'key')} AS cell", f"cast(ceil(n / {policy.block_rows}) AS int) AS blocks"
    )
    links = links.selectExpr(
        f"{_cell('bucket_1', 'name_1')} AS cell_1", f"{_cell('bucket_2', 'name_2')} AS cell_2", f"{score} AS score",
        "bucket_1 = bucket_2 AS close", "bucket_1 = bucket_2 AND name_1 = name_2 AS own",
    )
    tasks = _tasks(cells, links)
    records = (
        _with_cell(df, days)
        .where("_cell IS NOT NULL")
        .withColumnRenamed("_cell", "cell")
        .join(large, "cell", "left")
        .selectExpr(
            "cell",
            f"{_block_of('employee_id')} AS block",
            "_t AS t", "employee_id AS id", f"{title_case(_NAME)} AS name", "source_systems AS source",
        )
        # Once for both sides.
        .repartition(tasks, "cell", "block")
    )

    def side(k: int, prefix: str) -> DataFrame:
        return records.selectExpr(
            f"cell AS cell_{k}", f"block AS block_{k}", *(f"{c} AS {prefix}_{c}" for c in ("t", "id", "name", "source"))
        )

    links = (
        links.join(large.selectExpr("cell AS cell_1", "blocks AS blocks_1"), "cell_1", "left")
        .join(large.selectExpr("cell AS cell_2", "blocks AS blocks_2"), "cell_2", "left")
    )
    one = (
        links.withColumn("block_1", F.expr(_all_blocks("blocks_1")))
        .join(side(1, "a"), ["cell_1", "block_1"])
        .withColumn("block_2", F.expr(_all_blocks("blocks_2")))
        # Two blocks of a cell meet once; only a block with itself gives each pair twice.
        .where("NOT own OR block_1 <= block_2")
        .selectExpr("cell_2", "block_2", "score", "close", "own AND block_1 = block_2 AS twice", "a_t", "a_id", "a_name", "a_source")
        .repartition(tasks, "cell_2", "block_2")
    )
    earlier = "(a_t < b_t OR (a_t = b_t AND a_id < b_id))"

    def pick(column: str) -> list[str]:
        return [f"if(a_first, {x}_{column}, {y}_{column}) AS record_{k}_{column}" for k, x, y in ((1, "a", "b"), (2, "b", "a"))]

    return (
        one.join(side(2, "b"), ["cell_2", "block_2"])
        .where(f"(NOT twice OR {earlier}) AND (close OR abs(a_t - b_t) <= {window_micros(days)})")
        .withColumn("a_first", F.expr(f"twice OR {earlier}"))
        .selectExpr(
            *pick("id"),
            *pick("name"),
            "score AS similarity_score",
            f"cast(abs(b_t - a_t) div {MICROS_PER_DAY} AS int) AS hire_date_diff_days",
            *pick("source"),
            "'REVIEW' AS recommended_action",
        )
    )
