"""Quality rules whose cutoffs come from quantile sketches per language and source.

Plain DataFrame work. A first pass measures each document; the measures go into sketches,
one count per (language, source, measure, bin): counts add up, so sketches of parts merge to
the sketch of the whole, in any order, and give the same result in every run. Cutoffs are
read from the sketch of the cell, or, where the cell has few documents, from the merged
sketch of its language or of everything. Those two also bound each cell, so that a cell with
much junk cannot lift its own limit. Cutoffs are joined back to the documents.

Defined cases: null text has no words and fails the base rule, as empty text does. Null
language or source is a value of its own. Repeated rows count and are judged each. An empty
table gives an empty result. Further columns of the input are ignored by ``measure`` and
kept by ``passing``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillweave.llm.common import input_rows, settled, spare_name

_BLANKS = "' \t\n\x0b\f\r'"

#: The text with each blank character as a space. Line ends are by far the most frequent.
_FLAT = (
    "if(contains(text, '\t') or contains(text, '\x0b') or contains(text, '\f') or contains(text, '\r'),"
    " translate(text, '\t\n\x0b\f\r', '     '), replace(text, '\n', ' '))"
)
_SYMBOLS = "[#*$%&|<>]"
#: Words within repeated windows: each repeated window adds the words up to the next one, three at most.
_COVERED = """
aggregate(
    sort_array(transform(filter(s, (x, i) -> x.h = get(s, i - 1).h or x.h = get(s, i + 1).h), x -> x.i)),
    named_struct('n', 0L, 'end', 0),
    (a, i) -> named_struct('n', a.n + cast(i + 3 - greatest(a.end, i) as bigint), 'end', i + 3),
    a -> a.n)
"""


@dataclass(frozen=True)
class QualityPolicy:
    """The base rule, and how far above the usual of its cell a document may lie."""

    min_words: int = 50
    max_repeat_percent: int = 50
    #: Cutoff: upper quartile + spread * (upper quartile - lower quartile) + slack.
    spread: int = 4
    #: Smaller cells take the sketch of their language, smaller languages that of all documents.
    min_cell: int = 200


#: Measures in thousandths, and their slack: how far a document may lie above the upper
#: quartile where the documents of a cell hardly differ.
MEASURES = {
    "symbol_share": ("if(word_chars = 0, 0, 1000 * n_symbols div word_chars)", 60),
    "dup_line_share": ("if(n_lines = 0, 0, 1000 * n_dup_lines div n_lines)", 500),
    "repeat_share": ("if(n_words = 0, 0, 1000 * n_repeat_words div n_words)", 450),
    "upper_share": ("if(word_chars = 0, 0, 1000 * n_upper div word_chars)", 400),
}


def measure(docs: DataFrame, keep: list[str] | None = None, text: str = "text", policy: QualityPolicy = QualityPolicy()):
    """``keep`` columns plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_upper,
    n_repeat_words (long) and base_failed of each document."""
    keep = keep or ["doc_id", "lang", "source"]
    own = docs.select(*(F.col(f"`{c}`") for c in keep if c != text), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rest = [c for c in own.columns if c != "text"]
    # Each step refers to the costly column of the one before several times, so that Spark
    # keeps it as a column and computes it once.
    quoted = [f"`{c}`" for c in rest] + (["text"] if text in keep else [])
    cut = own.selectExpr(
        *quoted,
        f"array_remove(split({_FLAT}, ' '), '') w",
        f"cast(length(replace({_FLAT}, ' ', '')) as bigint) word_chars",
        f"cast(regexp_count(text, '{_SYMBOLS}') as bigint) n_symbols",
        "cast(regexp_count(text, '[A-Z]') as bigint) n_upper",
        r"filter(split(text, '\n'), l -> ltrim(" + _BLANKS + ", l) <> '') l",
    )
    quoted += ["word_chars", "n_symbols", "n_upper"]
    counted = cut.selectExpr(
        *quoted,
        "cast(size(w) as bigint) n_words",
        "cast(size(l) as bigint) n_lines",
        "cast(size(l) - size(array_distinct(l)) as bigint) n_dup_lines",
        "if(size(w) < 3, cast(array() as array<bigint>),"
        " transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) -> xxhash64(x, get(w, i + 1), get(w, i + 2)))) h",
    )
    quoted += ["n_words", "n_lines", "n_dup_lines"]
    sorted_ = counted.selectExpr(
        *quoted,
        "case when size(array_distinct(h)) < size(h)"
        " then sort_array(transform(h, (x, i) -> named_struct('h', x, 'i', i))) end s",
    )
    return sorted_.selectExpr(
        *quoted, f"case when s is null then 0L else {_COVERED} end n_repeat_words"
    ).withColumn(
        "base_failed",
        F.expr(
            f"n_words < {policy.min_words} or 100 * n_repeat_words > {policy.max_repeat_percent} * n_words"
        ),
    )


def sketch(measured: DataFrame) -> DataFrame:
    """lang, source, measure, bin, n: the documents that pass the base rule, counted."""
    bins = ", ".join(f"'{name}', cast({value} as bigint)" for name, (value, _) in MEASURES.items())
    # Counted, not filtered before: Spark would push the filter, with all that it is made of,
    # into the steps of ``measure``, and compute them again for each word.
    return (
        measured.selectExpr("lang", "source", "if(base_failed, 0L, 1L) passed", f"stack({len(MEASURES)}, {bins}) as (measure, bin)")
        .groupBy("lang", "source", "measure", "bin")
        .agg(F.sum("passed").alias("n"))
        .where("n > 0")
    )


def _quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Lower and upper quartile and number of documents of each key: the bins where the running count gets there."""
    merged = sketches.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys)
    running = whole.orderBy("bin")
    placed = merged.select(
        *keys, "bin", F.sum("n").over(running).alias("upto"), F.sum("n").over(whole).alias("total")
    )
    return placed.groupBy(*keys).agg(
        F.min(F.expr("case when 4 * upto >= total then bin end")).alias("q1"),
        F.min(F.expr("case when 4 * upto >= 3 * total then bin end")).alias("q3"),
        F.max("total").alias("total"),
    )


def cutoffs(sketches: DataFrame, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """lang, source and one cutoff per measure; a row per cell that has a document past the base rule."""
    cell = _quartiles(sketches, ["lang", "source", "measure"])
    language = _quartiles(sketches, ["lang", "measure"]).selectExpr(
        "lang l_lang", "measure l_measure", "q1 l_q1", "q3 l_q3", "total l_total"
    )
    everything = _quartiles(sketches, ["measure"]).selectExpr("measure e_measure", "q1 e_q1", "q3 e_q3")
    rows = cell.join(language, F.expr("lang <=> l_lang and measure = l_measure")).join(
        everything, F.expr("measure = e_measure")
    )
    slack = "case measure " + " ".join(f"when '{m}' then {s}" for m, (_, s) in MEASURES.items()) + " end"

    def limit(q: str) -> str:
        return f"{q}q3 + {policy.spread} * ({q}q3 - {q}q1) + {slack}"

    # The sketch of everything, and that of the language if it has the documents, bound each cell.
    chosen = rows.selectExpr(
        "lang", "source", "measure",
        f"least({limit('e_')}, if(l_total < {policy.min_cell}, {limit('e_')}, {limit('l_')}),"
        f" if(total < {policy.min_cell}, {limit('e_')}, {limit('')})) cut",
    )
    return chosen.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("measure") == m, F.col("cut"))).alias(f"max_{m}") for m in MEASURES)
    )


def judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` with kept (boolean): the base rule holds and no measure lies above its cutoff.

    Cells without a cutoff have no document that passed the base rule.
    """
    within = " and ".join(f"coalesce(cast({v} as bigint) <= max_{m}, true)" for m, (v, _) in MEASURES.items())
    limits = limits.withColumnsRenamed({"lang": "cut_lang", "source": "cut_source"})
    joined = measured.join(limits, F.expr("lang <=> cut_lang and source <=> cut_source"), "left")
    # One condition on both sides of the join, for the same reason as in ``sketch``.
    kept = f"cast(base_failed as int) + cast(not ({within}) as int) = 0"
    return joined.selectExpr(*(f"`{c}`" for c in measured.columns), f"{kept} kept")


def quality_verdicts(docs: DataFrame, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """doc_id, the counts, base_failed and kept of each document (columns doc_id, text, lang, source)."""
    measured = settled(measure(docs, policy=policy))
    limits = settled(cutoffs(sketch(measured), policy))
    return judged(measured, limits)


def passing(docs: DataFrame, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """The documents that are kept, all columns as they were.

    Rows are settled with their measures: measuring costs more than writing them.
    """
    # The row travels as one value, so that its column names cannot clash with own ones.
    row = spare_name(docs, "row")
    packed = input_rows(
        docs, **{row: F.struct(*(F.col(f"`{c}`") for c in docs.columns)), "doc_id": "doc_id", "lang": "lang", "source": "source", "text": "text"}
    )
    measured = settled(measure(packed, keep=[row, "doc_id", "lang", "source"], policy=policy))
    verdict = judged(measured, settled(cutoffs(sketch(measured), policy)))
    return verdict.where("kept").select(f"`{row}`.*")
