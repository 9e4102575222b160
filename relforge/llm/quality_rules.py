"""Quality rules with thresholds from mergeable quantile sketches per language and source (operator 8).

DataFrame functions only. A first pass measures every whole text in its own row: words, characters in
words, symbols, repeated lines, words in repeated 3-word windows. Two fixed base rules apply to all
(fewer than 50 words; over half of the words in repeated windows). The other limits adapt: for the
texts that pass the base rules, KLL quantile sketches of four measures are built per language and source
by a partial aggregate (a hot source costs each task one sketch), merged into sketches per language and
over all, and turned into fences

    word length: low / high = median -/+ (SPREAD * (median - 10 % quantile) + the least slack),

the half of the spread that junk, which lies above the median in these measures, does not widen. Symbols,
repeated lines and repeated words are 0 in most texts, so that their fences follow the upper tail:

    high = median + REACH * (trusted quantile - median) + the least slack.

The 75 % quantile is always trusted (junk is less than a quarter of a group); each of ``TAIL`` above it only while
it is no further out than SPREAD times the trusted one's distance from the median, plus the slack, so that junk,
which stands apart from the other texts, does not widen the fence but a heavy tail of usual texts does. A group
of fewer than ``LEAST_ROWS`` texts takes the fences of its language, a language of fewer those of all.
The fences are joined back to the rows; a hot group is split by Spark's skew join, since the fence side
has one row for each group. Measures and fences are written tables, so a rerun task sees the same ones.

Words are runs of ``[^\\x20\\x09-\\x0D]``. A window's identity is a 64-bit hash cut to the bits that
its position leaves free (47 or more); longer texts (over 2^17 words) compare the whole hash.

Defined results: a null or empty text has all counts 0 and fails the base rules; a null language or source
is a group of its own; rows repeat as given; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, col

SPREAD = 6.0
LEAST_ROWS = 200
SKETCH_K = 400
#: measure -> least slack of its fence below and above the median (None: no fence on that side)
SLACK = {"word_length": (1.0, 0.8), "symbol_share": (None, 0.1), "dup_line_share": (None, 0.2), "repeat_share": (None, 0.2)}
REACH = 2.0
TAIL = (0.9, 0.95, 0.98)
_BLANKS = " \t\n\x0b\x0c\r"
_PACKED = 1 << 17


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _covered(at: Column) -> Column:
    """Words under the 3-word windows that start at the given ascending positions."""
    steps = F.transform(at, lambda p, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3).cast("long"), p - F.get(at, k - 1))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in the array of words."""
    n = F.size(words)
    windows = F.transform(F.slice(words, F.lit(1), n - 2), lambda w, i: F.xxhash64(w, words[i + 1], words[i + 2]))

    def packed(h: Column) -> Column:
        bits = F.length(F.bin(n.cast("long")))
        place = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        keys = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("long"))))

        def twice(s: Column) -> Column:
            same = lambda a, b: F.call_function("shiftright", a, bits) == F.call_function("shiftright", b, bits)
            marked = F.filter(s, lambda x, k: F.coalesce(same(x, F.get(s, k + 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, k - 1)), F.lit(False)))
            return _bind(F.sort_array(F.transform(marked, lambda x: x.bitwiseAND(place))), _covered)

        return _bind(keys, twice)

    def whole(h: Column) -> Column:
        keys = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i"))))

        def twice(s: Column) -> Column:
            near = lambda k: F.get(s, k)["h"]
            marked = F.filter(s, lambda x, k: F.coalesce(x["h"] == near(k + 1), F.lit(False)) | F.coalesce(x["h"] == near(k - 1), F.lit(False)))
            return _bind(F.sort_array(F.transform(marked, lambda x: x["i"])), _covered)

        return _bind(keys, twice)

    long_text = F.when(n <= _PACKED, _bind(windows, packed)).otherwise(_bind(windows, whole))
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(long_text)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source and the base counts of every row."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    given = docs.select(col(id_col).cast("long").alias("doc_id"), col(lang_col).cast("string").alias("lang"),
                        col(source_col).cast("string").alias("source"), text.alias("text"))
    trimmed = F.btrim("text", F.lit(_BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    counted = _bind(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    lined = _bind(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long")
    out = given.select("doc_id", "lang", "source", counted.alias("w"), lined.alias("l"), symbols.alias("n_symbols"))
    out = out.select("doc_id", "lang", "source", "w.*", "l.*", "n_symbols")
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _measures(df: DataFrame) -> DataFrame:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return df.withColumns({
        "word_length": F.col("word_chars") / words, "symbol_share": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / lines, "repeat_share": F.col("n_repeat_words") / words})


def _trusted(sketch: Column, slack: float) -> Column:
    """The highest of the upper quantiles up to which a sketch's values show no gap."""
    at = lambda q: F.kll_sketch_get_quantile_double(sketch, F.lit(q))
    further = lambda t, x: F.when(x <= at(0.5) + SPREAD * (t - at(0.5)) + slack, x).otherwise(t)
    return F.aggregate(F.array(*map(at, TAIL)), at(0.75), further)


def fences(measured: DataFrame, scratch: Scratch) -> DataFrame:
    """lang, source, rows, level, and <measure>_low / <measure>_high for each language and source."""
    passed = _measures(measured.where(~F.col("base_failed")))
    k = F.lit(SKETCH_K)
    per_source = passed.groupBy("lang", "source").agg(
        F.count("*").alias("rows"), *(F.kll_sketch_agg_double(m, k).alias(m) for m in SLACK))
    per_source = scratch.stage(per_source, "sketches")
    merged = [F.sum("rows").alias("rows"), *(F.kll_merge_agg_double(m, k).alias(m) for m in SLACK)]
    per_lang = per_source.groupBy("lang").agg(*merged)
    overall = per_source.groupBy().agg(*merged)
    part = lambda df, p: df.select(*(F.col(c).alias(p + c) for c in df.columns))
    joined = part(per_source, "s_").join(part(per_lang, "l_"), F.col("s_lang").eqNullSafe(F.col("l_lang")), "left").join(F.broadcast(part(overall, "a_")))
    own, lang = F.col("s_rows") >= LEAST_ROWS, F.col("l_rows") >= LEAST_ROWS
    chosen = lambda m: F.when(own, F.col("s_" + m)).when(lang, F.col("l_" + m)).otherwise(F.col("a_" + m))
    limits = []
    for m, (below, above) in SLACK.items():
        median, low = (F.kll_sketch_get_quantile_double(chosen(m), F.lit(q)) for q in (0.5, 0.1))
        spread = SPREAD * (median - low)
        limits.append((median - spread - below if below is not None else F.lit(None).cast("double")).alias(m + "_low"))
        limits.append((median + (spread if below is not None else REACH * (_trusted(chosen(m), above) - median)) + above).alias(m + "_high"))
    level = F.when(own, "source").when(lang, "lang").otherwise("all").alias("level")
    return joined.select(F.col("s_lang").alias("f_lang"), F.col("s_source").alias("f_source"), F.col("s_rows").alias("rows"), level, *limits)


def filter_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept, and the measures beyond their fences."""
    scratch = Scratch(docs.sparkSession, "quality-rules")
    measured = scratch.stage(measure(docs, id_col, text_col, lang_col, source_col), "measured")
    limits = scratch.stage(fences(measured, scratch), "fences")
    joined = _measures(measured).join(limits, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    broken = F.array_compact(F.array(*(
        F.when((F.col(m) < F.col(m + "_low")) | (F.col(m) > F.col(m + "_high")), F.lit(m)) for m in SLACK)))
    out = joined.withColumn("broken_rules", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(broken))
    kept = ~F.col("base_failed") & (F.size("broken_rules") == 0)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "broken_rules")
