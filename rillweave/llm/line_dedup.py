"""Site-relative boilerplate lines.

Plain DataFrame work. For each site, the pages that contain a line are divided by the pages
of the site; lines above a ratio are boilerplate and are dropped from every page of the site.
Copies and near copies of a page count as one page there, in both numbers: otherwise a page
copied often enough would be its own boilerplate and vanish with all its copies. Near copies
are looked for where lines above the ratio make up half of a page: it meets another page with
its rarest such line, and joins its class if they share most of their word pairs.

Lines are compared without the blanks at their ends, by a 128-bit hash; lines of blanks
alone are no lines and stay. The pages of a line are counted with map-side combination, so
that a line or site that owns most rows costs a row per task. A site has at most
(mean lines per page) / ratio boilerplate lines; they reach its pages by a join on the site,
which Spark turns into a broadcast below its size check and splits where a site is hot.

Defined cases: null text stays null and counts as no page; empty text stays empty. A null
site is a site of its own. Repeated rows are copies. An empty table gives an empty result.
Further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.llm.common import input_rows, settled, spare_name

#: Share of a site's pages above which a line is boilerplate.
RATIO = 0.05
#: Pages that must contain it: in a site of a few pages a share says nothing.
MIN_PAGES = 5

_BLANKS = "' \t\x0b\f\r'"
_LINES = r"split(text, '\n')"
_FLAT = "translate(lower(text), '\t\n\x0b\f\r', '     ')"
_PAIRS = "array_distinct(transform(w, (x, i) -> xxhash64(x, get(w, i + 1))))"
#: The lines of a page and a marker, null, for the page itself.
_MARKED = "concat(array(cast(null as struct<a:bigint,b:bigint>)), keys)"

#: Pages of one class share so much of their word pairs (Jaccard similarity).
NEAR_PERCENT = 80
#: Leaders that a page is compared with.
ROUNDS = 3


def _key(line: str) -> str:
    return f"named_struct('a', xxhash64({line}), 'b', xxhash64(1, {line}))"


def boilerplate(
    pages: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """site, keys: the hashes of the boilerplate lines of each site that has some."""
    own = input_rows(pages, site=site, text=text).where("text is not null")
    # One row per different page of a site. The lines of copies are equal, so any one will do.
    distinct = _hashed(own).groupBy("site", "p", "q").agg(F.first("keys").alias("keys"))
    # A marker line, null, counts the pages themselves in the same aggregation.
    counted = settled(
        distinct.selectExpr("site", f"explode({_MARKED}) key")
        .groupBy("site", "key")
        .agg(F.count("*").alias("n"))
        .where(f"key is null or n >= {min_pages}")
    )
    found = settled(_above(counted, ratio, min_pages))
    suspected = found
    # Fewer classes than pages can lift further lines above the ratio; then their pages are looked at too.
    while not suspected.isEmpty():
        spare = _repeats(_hashed(own), suspected).withColumnsRenamed({"site": "r_site", "key": "r_key"})
        left = counted.join(spare, F.expr("site <=> r_site and key <=> r_key"), "left").selectExpr(
            "site", "key", "n - coalesce(spare, 0L) n"
        )
        found = settled(_above(left, ratio, min_pages))
        more = found.join(
            suspected.selectExpr("site s_site", "key s_key"), F.expr("site <=> s_site and key = s_key"), "left_anti"
        )
        if more.isEmpty():
            break
        suspected = settled(suspected.unionByName(more))
    return found.groupBy("site").agg(F.collect_list("key").alias("keys"))


def _above(counted: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """site, key, n of the lines above the ratio; the row without a key has the pages of the site."""
    totals = counted.where("key is null").selectExpr("site t_site", "n pages")
    lines = counted.where(f"key is not null and n >= {min_pages}").join(totals, F.expr("site <=> t_site"))
    return lines.where(F.col("n") > F.lit(ratio) * F.col("pages")).select("site", "key", "n")


def _hashed(own: DataFrame) -> DataFrame:
    """site, text, p, q (hash of the text) and keys (of its different lines) of each page."""
    return own.selectExpr(
        "site", "text", "xxhash64(text) p", "xxhash64(1, text) q",
        f"array_distinct(transform(filter(transform({_LINES}, l -> trim({_BLANKS} from l)), l -> l <> ''), l -> {_key('l')})) keys",
    )


def _repeats(pages: DataFrame, suspected: DataFrame) -> DataFrame:
    """site, key, spare: how many pages with the line (null key: pages) are further members of a class of near copies.

    Only pages half of whose lines are ``suspected`` can hold a near copy's line against it.
    They meet the leader of their rarest suspected line, and those unlike it another one.
    """
    lists = suspected.groupBy("site").agg(F.collect_list(F.struct("n", "key")).alias("bad")).withColumnRenamed("site", "bad_site")
    hit = pages.join(lists, F.expr("site <=> bad_site")).selectExpr(
        "site", "text", "p", "q", "keys", "filter(bad, b -> array_contains(keys, b.key)) hits"
    ).where("size(hits) > 0 and 2 * size(hits) >= size(keys)")
    open_ = settled(
        hit.groupBy("site", "p", "q")
        .agg(F.first("text").alias("text"), F.first("keys").alias("keys"), F.first("hits").alias("hits"))
        .selectExpr("site", "p", "q", "keys", "array_min(hits).key anchor", f"array_remove(split({_FLAT}, ' '), '') w")
        .selectExpr("site", "p", "q", "keys", "anchor", f"{_PAIRS} pairs")
    )
    found = None
    for _ in range(ROUNDS):
        leaders = open_.groupBy("site", "anchor").agg(F.min(F.struct("p", "q")).alias("lead"))
        named = open_.join(
            leaders.selectExpr("site l_site", "anchor l_anchor", "lead"), F.expr("site <=> l_site and anchor = l_anchor")
        ).drop("l_site", "l_anchor")
        first = open_.selectExpr("site l_site", "struct(p, q) l_page", "pairs l_pairs")
        met = settled(
            named.join(first, F.expr("site <=> l_site and lead = l_page"))
            .withColumn("common", F.expr("size(array_intersect(pairs, l_pairs))"))
            .selectExpr(
                "site", "p", "q", "keys", "anchor", "pairs", "lead",
                f"100 * common >= {NEAR_PERCENT} * (size(pairs) + size(l_pairs) - common) near",
            )
        )
        near = met.where("near").select("site", "lead", "keys")
        found = near if found is None else found.unionByName(near)
        open_ = met.where("not near").drop("lead", "near")
        if open_.isEmpty():
            break
    members = found.selectExpr("site", "lead", f"explode({_MARKED}) key").groupBy("site", "lead", "key").agg(F.count("*").alias("n"))
    return members.groupBy("site", "key").agg(F.sum(F.expr("n - 1")).alias("spare")).where("spare > 0")


def line_dedup(
    pages: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """All columns of ``pages``, ``text`` without the boilerplate lines, plus n_lines and
    n_dropped (lines before, lines dropped; null text: 0)."""
    bad = settled(boilerplate(pages, site, text, ratio, min_pages)).selectExpr("site bad_site", "keys bad_keys")
    row = spare_name(pages, "row")
    packed = input_rows(pages, row=F.struct(*(F.col(f"`{c}`") for c in pages.columns)), site=site, text=text)
    joined = packed.join(bad, F.expr("site <=> bad_site"), "left")
    cut = joined.selectExpr("row", "text", f"coalesce(size({_LINES}), 0) n_lines",
        "case when text is null or bad_keys is null then null else "
        f"filter({_LINES}, l -> not array_contains(bad_keys, {_key(f'trim({_BLANKS} from l)')})) end rest")
    clean = cut.selectExpr(
        "row", "n_lines", "if(rest is null or size(rest) = n_lines, text, array_join(rest, '\n')) clean",
        "if(rest is null, 0, n_lines - size(rest)) n_dropped",
    )
    named = [F.col("clean").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in pages.columns]
    extra = [F.col(c).cast("long").alias(spare_name(pages, c)) for c in ("n_lines", "n_dropped")]
    return clean.select(*named, *extra)
