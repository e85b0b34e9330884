"""Benchmark decontamination with a distributed positional inverted index.

Plain DataFrame work. Words are runs of letters beyond ASCII, digits and letters, A-Z in lower
case. A benchmark item gives its windows of consecutive words; equal windows are one from here
on. One scan of the documents stores the postings (term, row, position) of every benchmark term:
the index. It stays spread over the documents, so no list of a frequent term is ever in one place.

A window is searched from its rarest terms: the postings of the rarest one, moved back by its
place in the window, are the candidates; those of the second rarest, moved likewise, are
intersected with them; what is left is intersected with the lists of all other terms. Every list
takes part, so a match is exact and needs no look at the texts. ``near_matches`` instead finds all
terms of a window within a span of words, in any order.

Windows and terms are given to all tasks while they are fewer than ``RESIDENT``; a larger
benchmark is joined by a shuffle in which the postings of a term are salted.

Defined cases: null or empty text, or one without words, has no words, no postings and no windows. An
item of fewer words than the width is one window. Items without an id match like others but are in
no list of items; equal ids are one item. Repeated rows of documents are searched each. Empty
tables give no match. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.llm.common import Workspace, input_rows, settled

WIDTH = 10
#: Windows or terms given to all tasks rather than joined by a shuffle.
RESIDENT = 500_000
#: Parts of the postings of a term in such a shuffle.
SALTS = 32

#: Ends the words of a document; no word can equal it. Its place is the number of words.
_END = "\n"
_SEPARATORS = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    """SQL for the words of a text; null has none."""
    whole = f"coalesce({text}, '')"
    # lower() does the same on plain ASCII, and much faster.
    low = f"if(octet_length({whole}) = length({whole}), lower({whole}), translate({whole}, '{_UPPER}', '{_LOWER}'))"
    return f"array_remove(split({low}, '{_SEPARATORS}'), '')"


def _few(df: DataFrame) -> bool:
    return df.count() <= RESIDENT


def _meeting(postings: DataFrame, other: DataFrame, on: str, spread: str) -> DataFrame:
    """Inner join of a long table, with hot values of ``on``, and a short one."""
    if _few(other):
        return postings.join(F.broadcast(other), on)
    salted = postings.withColumn("salt", F.expr(f"cast(pmod(xxhash64({spread}), {SALTS}) as int)"))
    copies = other.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [on, "salt"]).drop("salt")


class PhraseIndex:
    """Windows of ``items`` and the postings of their terms in ``docs``, written to ``work``.

    ``windows``: win, terms, items (ids as text, sorted). ``postings``: row, term, pos.
    ``rows``: row, doc_id, n_words of each row of ``docs``. ``plans``: win, width, steps, the
    (n, off, term) of a window, rarest first, of the windows whose terms all occur.
    """

    def __init__(
        self, docs: DataFrame, items: DataFrame, work: Workspace, width: int = WIDTH,
        doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    ):
        self.work = work
        tests = input_rows(items, item=F.col(f"`{item_id}`").cast("string"), w=F.expr(words(f"`{item_text}`")))
        slices = tests.where("size(w) > 0").selectExpr(
            "item", f"explode(transform(sequence(1, greatest(size(w) - {width - 1}, 1)), i -> slice(w, i, {width}))) terms"
        )
        self.windows = work(
            slices.groupBy("terms").agg(F.array_sort(F.collect_set("item")).alias("items"))
            .withColumn("win", F.monotonically_increasing_id()),
            "windows",
        )
        terms = self.windows.select(F.explode("terms").alias("word")).distinct()
        self.vocabulary = work(
            terms.select("word", F.monotonically_increasing_id().alias("term"))
            .union(docs.sparkSession.createDataFrame([(_END, -1)], "word string, term long")),
            "vocabulary",
        )
        texts = input_rows(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), w=F.expr(words(f"`{text}`")))
        # Numbered in a step of its own: beside an explode, each exploded row would get a number.
        every = texts.withColumn("row", F.monotonically_increasing_id()).select(
            "row", "doc_id", F.posexplode(F.concat("w", F.array(F.lit(_END)))).alias("pos", "word")
        )
        stored = work(_meeting(every, self.vocabulary, "word", "row").select("row", "doc_id", "term", "pos"), "postings")
        self.rows = stored.where("term = -1").selectExpr("row", "doc_id", "cast(pos as long) n_words")
        self.postings = stored.where("term >= 0").select("row", "term", "pos")
        self.counts = work(self.postings.groupBy("term").agg(F.count("*").alias("n")), "counts")
        places = self.windows.select("win", F.size("terms").alias("width"), F.posexplode("terms").alias("off", "word"))
        known = places.join(self.vocabulary, "word").join(self.counts, "term")
        self.plans = work(
            known.groupBy("win", "width")
            .agg(F.array_sort(F.collect_list(F.struct("n", "off", "term"))).alias("steps"))
            .where("size(steps) = width"),
            "plans",
        )

    def matches(self) -> DataFrame:
        """row, win, start, width of each place where a window occurs word by word."""
        first = self.plans.selectExpr(
            "win", "width", "steps[0].term term", "steps[0].off off", "get(steps, 1).term second", "get(steps, 1).off second_off"
        )
        one = _meeting(self.postings, first, "term", "row").where("pos >= off").selectExpr(
            "row", "win", "pos - off start", "width", "second", "second_off"
        )
        one = self.work(one, "one")
        seconds = first.where("second is not null").selectExpr("second term").distinct()
        lists = self.postings.join(F.broadcast(seconds), "term", "left_semi") if _few(seconds) else self.postings
        wanted = one.where("width > 1").selectExpr("row", "second term", "start + second_off pos", "win", "start", "width")
        two = self.work(wanted.join(lists, ["row", "term", "pos"]).select("row", "win", "start", "width"), "two")
        open_ = two.where("width > 2")
        held = settled(open_.select("row").distinct())
        lists = self.postings.join(F.broadcast(held) if _few(held) else held, "row", "left_semi")
        others = self.plans.where("width > 2").selectExpr("win", "inline(slice(steps, 3, width))").drop("n")
        wanted = open_.join(others, "win").selectExpr("row", "term", "start + off pos", "win", "start", "width")
        rest = (
            wanted.join(lists, ["row", "term", "pos"])
            .groupBy("row", "win", "start", "width").agg(F.count("*").alias("n"))
            .where("n = width - 2").drop("n")
        )
        ends = [d.select("row", "win", "start", "width") for d in (one.where("width = 1"), two.where("width = 2"), rest)]
        return self.work(ends[0].unionByName(ends[1]).unionByName(ends[2]), "matches")

    def near_matches(self, span: int) -> DataFrame:
        """row, win, first, last: the tightest (then first) stretch of at most ``span`` words of a
        document that holds all different terms of a window, in any order.

        Every stretch holds the rarest term; the others are looked up around its postings, the second
        rarest before the rest.
        """
        terms = self.plans.selectExpr("win", "array_distinct(transform(steps, s -> s.term)) terms")
        first = terms.selectExpr("win", "terms[0] term", "get(terms, 1) second", "size(terms) n_terms")
        at = _meeting(self.postings, first, "term", "row").selectExpr("row", "win", "pos at", "second", "n_terms")
        at = self.work(at, "near_one")
        # Postings around ``at`` lie in its block of ``span`` positions or in an adjacent one.
        blocks = f"explode(sequence(at div {span} - 1, at div {span} + 1)) block"
        lists = self.postings.selectExpr("row", "term", f"pos div {span} block", "pos")
        close = f"abs(pos - at) < {span}"
        paired = at.where("n_terms > 1").selectExpr("row", "win", "at", "n_terms", "second term", blocks)
        open_ = self.work(
            paired.join(lists, ["row", "term", "block"]).where(close).select("row", "win", "at", "n_terms").distinct(), "near_two"
        )
        others = terms.selectExpr("win", "explode(slice(terms, 2, size(terms))) term")
        around = open_.join(others, "win").selectExpr("*", blocks).join(lists, ["row", "term", "block"]).where(close)
        # What a stretch that starts at one of the positions needs: the nearest position of each term from there on.
        gathered = around.groupBy("row", "win", "at", "n_terms", "term").agg(F.array_sort(F.collect_list("pos")).alias("places"))
        gathered = gathered.groupBy("row", "win", "at", "n_terms").agg(F.collect_list("places").alias("lists")).where(
            "size(lists) = n_terms - 1"
        )
        starts = "filter(array_append(flatten(lists), at), s -> s <= at)"
        last = "array_max(array_append(transform(lists, l -> coalesce(array_min(filter(l, x -> x >= s)), 2147483647)), at))"
        found = gathered.selectExpr(
            "row", "win", f"inline(transform({starts}, s -> named_struct('first', s, 'last', {last})))"
        ).unionByName(at.where("n_terms = 1").selectExpr("row", "win", "at first", "at last"))
        best = found.where(f"last - first < {span}").groupBy("row", "win").agg(
            F.min(F.expr("struct(last - first, first, last)")).alias("best")
        )
        return best.selectExpr("row", "win", "best.first", "best.last")


#: Words within any of the stretches, each counted once.
_COVERED = """
aggregate(array_sort(places), named_struct('n', 0L, 'end', 0),
    (a, p) -> named_struct('n', a.n + greatest(p.end - greatest(a.end, p.start), 0), 'end', greatest(a.end, p.end)), a -> a.n)
"""


def contamination(
    docs: DataFrame, items: DataFrame, width: int = WIDTH,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit (words within an occurring window), n_items, items_sha256 (of the sorted ids of the
    items with an occurring window, comma-joined) and contaminated of each row of ``docs``."""
    with Workspace(docs.sparkSession) as work:
        index = PhraseIndex(docs, items, work, width, doc_id, text, item_id, item_text)
        found = index.matches()
        # Windows of the same items count as one, and documents with the same of those get one list of items.
        kinds = work(index.windows.groupBy("items").agg(F.min("win").alias("kind")), "kinds")
        kind_of = index.windows.join(kinds, "items").select("win", "kind")
        hit = work(
            found.join(kind_of, "win").groupBy("row").agg(
                F.collect_set(F.expr("struct(start, start + width as end)")).alias("places"),
                F.array_sort(F.collect_set("kind")).alias("kinds"),
            ).selectExpr("row", f"{_COVERED} n_hit", "kinds"),
            "hit",
        )
        lists = (
            hit.select("kinds").distinct().selectExpr("kinds", "explode(kinds) kind").join(kinds, "kind")
            .groupBy("kinds").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        )
        lists = work(
            lists.selectExpr("kinds", "cast(size(items) as long) n_items", "sha2(array_join(items, ','), 256) items_sha256"), "lists"
        )
        verdicts = index.rows.join(hit.join(lists, "kinds"), "row", "left").selectExpr(
            "doc_id", "n_words", "coalesce(n_hit, 0L) n_hit", "coalesce(n_items, 0L) n_items",
            "coalesce(items_sha256, sha2('', 256)) items_sha256", "n_hit is not null contaminated",
        )
        return settled(verdicts)
