"""Source divergence audit: how far the words of a source lie from those of its language and of other sources.

A term is a stretch of letters or of characters beyond ASCII, A-Z lower-cased, found by
splitting at what stands between. Terms of each row are sorted, so that its first copy of
a term is told apart, and exploded once; counts by (lang, source, term) are summed before
the shuffle. Each language keeps the terms that ``LEAST`` of its rows hold. Its groups are crossed with this vocabulary,
which gives a count of zero to terms that a group lacks; joined with itself on language
and term it compares all sources, and a window ranks the sums. Shares are parts of
``SCALE``, in whole numbers throughout.

Defined results: null text, lang and source are empty; a row without terms still makes
its group; a language without kept terms has pairs of value 0; rows of equal id are rows
of their own; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

LEAST, SCALE, RANKS = 3, 1_000_000_000, 200
#: Most groups that are sent to every task; beyond it the vocabulary and the groups are joined in ``SALTS`` parts.
BROADCAST, SALTS = 20_000, 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between terms.
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), rows (that hold the term); the term is null for rows without terms."""
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    # in ASCII texts lower() changes A-Z alone, at a third of the cost
    low = F.when(F.length("text") == F.octet_length("text"), F.lower("text")).otherwise(F.translate("text", _UPPER, _LOWER))
    terms = F.sort_array(F.split(low, _BETWEEN))
    # each term beside the one before it: where they differ the row holds the term for the first time
    shifted = F.concat(F.array(F.lit(None).cast("string")), F.col("terms"))
    pairs = read.select("lang", "source", terms.alias("terms")).select("lang", "source", F.explode_outer(F.arrays_zip(F.col("terms").alias("term"), F.slice(shifted, F.lit(1), F.size("terms")).alias("before"))).alias("x"))
    # a text that begins or ends between terms gives an empty one there
    term = F.when(F.col("x.term") != "", F.col("x.term"))
    return (
        pairs.select("lang", "source", term.alias("term"), F.when(F.col("x.term").eqNullSafe(F.col("x.before")), 0).otherwise(1).alias("new"))
        .groupBy("lang", "source", "term")
        .agg(F.count("*").alias("n"), F.sum("new").alias("rows"))
    )


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), beyond 64 bits between."""
    whole = "decimal(19,0)"
    return F.expr(f"1 + (cast({n} + 1 as {whole}) * {SCALE}) div (cast({total} as {whole}) + {kept})")


def _excess(p: str = "p", q: str = "q") -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _crossed(vocabulary: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """Every group of a language with every kept term of it."""
    if n_groups <= BROADCAST:
        return vocabulary.join(F.broadcast(groups), "lang")
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return vocabulary.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")).join(salted, ["lang", "salt"]).drop("salt")


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part (``pair``: another source; ``term``: an overused term), item, value, rank."""
    counts = written(term_counts(docs), "terms")
    found = counts.where("term is not null")
    # kept terms and groups have numbers from here on; they are written, so they keep them
    vocabulary = found.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("rows").alias("rows")).where(F.col("rows") >= LEAST).drop("rows")
    vocabulary = written(vocabulary.withColumn("word", F.monotonically_increasing_id()), "vocabulary")
    kept = written(found.select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"]), "kept-terms")
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        counts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", F.monotonically_increasing_id().alias("group"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "v", "total_lang")])
    )
    groups = written(groups, "groups")
    n_groups = groups.count()
    few = F.broadcast(groups) if n_groups <= BROADCAST else groups
    kept = kept.join(few, ["lang", "source"])

    term = kept.withColumn("p", _share("n", "total", "v")).withColumn("q", _share("n_lang", "total_lang", "v")).where("p > q")
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = term.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _excess().alias("value")).withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= RANKS)

    cells = _crossed(vocabulary.select("lang", "word"), groups.select("lang", "group", "total", "v"), n_groups)
    dense = cells.join(kept.select("word", "group", "n"), ["word", "group"], "left").select("word", "group", _share("coalesce(n, 0L)", "total", "v").alias("p"))
    # each pair of sources once, summed in both directions
    dense = written(dense, "dense-terms")
    other = dense.select("word", F.col("group").alias("other"), F.col("p").alias("q"))
    sums = dense.join(other, "word").where("group < other").groupBy("group", "other").agg(F.sum(_excess("p", "q")).alias("there"), F.sum(_excess("q", "p")).alias("back"))
    names, others = groups.select("lang", "source", "group"), groups.select("lang", F.col("source").alias("item"), F.col("group").alias("other"))
    every = names.join(others, "lang").where("group < other").join(sums, ["group", "other"], "left")
    both = F.array(F.struct("source", "item", F.col("there").alias("value")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))
    pair = every.select("lang", F.explode(both).alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", F.coalesce("x.value", F.lit(0).cast("long")).alias("value")).withColumn("rank", F.row_number().over(own))
    return pair.unionByName(term)
