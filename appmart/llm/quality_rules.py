"""Quality rules with thresholds that adapt to each language and source.

Every document gets a few text statistics (built-in expressions only). For
each (lang, source) the distribution of five ratios over the documents that
pass the base rules is kept as KLL quantile sketches. Sketches merge, so the
language-wide and corpus-wide ones are merged from the group sketches without
another pass. A document is rejected when a ratio lies outside Tukey fences
read from its group's sketch; a group with too few rows takes its language's
fences, and a small language the corpus's.

Defined results: null or empty text has no words and fails the base rules;
null lang or source is a group of its own (null-safe join); a repeated row is
judged like any other; an empty table gives an empty result. Columns of the
input travel in one struct, so no name can clash with the statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .store import materialise

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
FENCE = 3.0
#: Sketch size: exact up to this many rows of a group, about 0.1 % rank error beyond.
SKETCH_K = 4096
#: A group's own fences count from this many rows on.
MIN_GROUP_ROWS = 200
#: Per ratio: the least spread (so a constant ratio does not reject every
#: small deviation) and whether low values are rejected too.
RATIOS = {
    "word_length": (0.4, True),
    "symbols": (0.03, False),
    "dup_lines": (0.16, False),
    "repeats": (0.16, False),
    "capitals": (0.08, False),
}


def with_text_stats(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` plus n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words and n_capitals of the string column ``text``, which goes.

    Works inside the row: no explode, no shuffle. Only texts in which a
    3-word window really recurs pay for sorting the windows.
    """
    kept = [c for c in rows.columns if c != text]
    t = F.coalesce(F.col(text), F.lit(""))
    split = rows.select(
        *kept,
        F.filter(F.split(t, WORD_BREAK), lambda w: w != "").alias("_words"),
        F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.regexp_count(t, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
    )
    windows = split.select(
        "*",
        F.expr("""if(size(_words) < 3, cast(array() as array<bigint>),
                     transform(sequence(0, size(_words) - 3),
                               i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])))""").alias("_win"),
    ).select(
        *kept, "n_symbols", "n_capitals", "_win",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    ordered = windows.withColumn("_ord", F.expr("""
        if(size(array_distinct(_win)) = size(_win), null,
           sort_array(transform(_win, (h, i) -> struct(h as h, i as i))))"""))
    # Starts of windows equal to a neighbour in hash order, and the words they cover.
    starts = ordered.withColumn("_starts", F.expr("""
        transform(filter(transform(_ord, (e, j) -> struct(e.i as i,
              (j > 0 and get(_ord, j - 1).h = e.h)
              or (j < size(_ord) - 1 and get(_ord, j + 1).h = e.h) as again)), e -> e.again), e -> e.i)"""))
    return starts.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_capitals",
        F.expr("""coalesce(size(array_distinct(flatten(
                   transform(_starts, i -> array(i, i + 1, i + 2))))), 0)""").cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """The fixed base rules over the statistics."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratio_columns() -> dict[str, Column]:
    """The five ratios, each 0 for a text without words (lines, characters)."""
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))
    return {
        "word_length": share("word_chars", "n_words"),
        "symbols": share("n_symbols", "n_words"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
    }


def fences(stats: DataFrame, lang: Column, source: Column) -> DataFrame:
    """One row per (lang, source) of ``stats``: ``lo_<ratio>`` and ``hi_<ratio>``.

    Group sketches come from map-side partial sketches, so a source with a
    third of all rows moves as one small sketch per task.
    """
    judged = stats.filter(~F.col("base_failed")).select(
        lang.alias("lang"), source.alias("source"), *[c.alias(r) for r, c in ratio_columns().items()])
    groups = materialise(judged.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.kll_sketch_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in RATIOS]), "quality-sketches")

    def merged(*keys: str) -> DataFrame:
        return groups.groupBy(*keys).agg(
            F.sum("n").alias("n"), *[F.kll_merge_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in RATIOS])

    def cut(level: DataFrame, keys: list[str], tag: str) -> DataFrame:
        out = [*keys, F.col("n").alias(f"n_{tag}")]
        for r, (least, both) in RATIOS.items():
            q1 = F.kll_sketch_get_quantile_double(r, F.lit(0.25))
            q3 = F.kll_sketch_get_quantile_double(r, F.lit(0.75))
            spread = FENCE * F.greatest(q3 - q1, F.lit(least))
            out += [(q1 - spread if both else F.lit(float("-inf"))).alias(f"lo_{r}_{tag}"),
                    (q3 + spread).alias(f"hi_{r}_{tag}")]
        return level.select(*out)

    own = cut(groups, ["lang", "source"], "own").alias("g")
    by_lang = cut(merged("lang"), ["lang"], "lang").alias("l")
    corpus = cut(merged().filter(F.col("n") > 0), [], "all")
    wide = (own.join(by_lang, F.col("g.lang").eqNullSafe(F.col("l.lang"))).drop(F.col("l.lang"))
            .join(F.broadcast(corpus)))  # a single row
    return wide.select("lang", "source", *[
        F.when(F.col("n_own") >= MIN_GROUP_ROWS, F.col(f"{side}_{r}_own"))
        .when(F.col("n_lang") >= MIN_GROUP_ROWS, F.col(f"{side}_{r}_lang"))
        .otherwise(F.col(f"{side}_{r}_all")).alias(f"{side}_{r}")
        for r in RATIOS for side in ("lo", "hi")])


def judge(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs`` (text, lang, source): ``d`` (a struct of the
    columns in ``keep``, by default all), the statistics, ``base_failed`` and ``kept``.

    The statistics are stored once in the shared folder: thresholds and
    verdicts both read the stored copy, so the texts are parsed once.
    """
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*keep).alias("d"), F.col("lang").alias("_lang"),
                       F.col("source").alias("_source"), F.col("text").alias("_text"))
    stats = materialise(with_text_stats(rows, "_text").withColumn("base_failed", base_failed()), "quality-stats")
    # A group without one judged document has no fences, but all its documents fail the base rules.
    cuts = fences(stats, F.col("_lang"), F.col("_source")).alias("f")
    inside = F.lit(True)
    for r, c in ratio_columns().items():
        inside = inside & (c >= F.col(f"lo_{r}")) & (c <= F.col(f"hi_{r}"))
    joined = stats.join(cuts, F.col("_lang").eqNullSafe(F.col("f.lang"))
                        & F.col("_source").eqNullSafe(F.col("f.source")), "left")
    return joined.select("d", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    The verdict depends on text, language and source alone, so only the keys
    of good rows are stored, no texts.
    """
    key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    keyed = docs.select(F.struct("*").alias("d"), key.alias("k"), F.col("lang").alias("l"), F.col("source").alias("s"))
    good = judge(docs.select("text", "lang", "source", key.alias("key")), ["key", "lang", "source"]).filter(
        "kept").select("d.*").distinct()
    return keyed.join(good, (F.col("k") == F.col("key")) & F.col("l").eqNullSafe(F.col("lang"))
                      & F.col("s").eqNullSafe(F.col("source")), "left_semi").select("d.*")
