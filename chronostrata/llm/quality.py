"""Quality rules with thresholds that follow the corpus.

Each text gets its base counts from expressions on its own row. Ratios of these counts go into
quantile sketches per (language, source): histograms with exact counts whose bins are exact below
64 and at most 1/32 of the value wide above it. Such sketches merge by addition, so map tasks
combine them and a hot source costs as much as any other. Fences on their quartiles replace fixed
cut-offs; a join on (language, source) brings them to the rows.

Defined results: a null text has no words and fails the base rule. Null languages and sources are
groups of their own. Equal rows get equal verdicts. A group without a row that passes the base rule
has no fences and needs none. An empty table gives an empty result. Columns of the input keep their
values; a column that bears the name of a count is overwritten by it in `quality_rules` (the filter
returns the input's columns as they were).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronostrata.llm.native import SPACES, from_row, let, whole_row, words
from chronostrata.session import cut

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

# Ratios that are fenced, as integers: name -> (numerator, denominator, factor, least spread, has a
# lower fence). A fence stands 3 spreads outside a quartile; the spread is the distance of the
# quartiles but never under the least one, since many groups are all zeros.
METRICS: dict[str, tuple[str, str, int, int, bool]] = {
    "symbols": ("n_symbols", "word_chars", 1000, 30, False),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 200, False),
    "word_len": ("word_chars", "n_words", 100, 100, True),
}
SPREADS = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeated_words(found: Column) -> Column:
    """Words covered by windows of five words that occur at least twice."""

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
            )
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        first = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        total = F.aggregate(
            let(ordered, starts),
            first,
            lambda acc, p: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")
            ),
            lambda acc: acc["n"],
        )
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(total)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(found) - WINDOW),
        lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(WINDOW)]),
    )
    return F.when(F.size(found) > WINDOW, let(windows, covered)).otherwise(F.lit(0))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The base counts and `base_failed` of every row."""
    raw = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(raw, "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)

    def counted(w: Column) -> Column:
        return F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            _repeated_words(w).alias("n_repeat_words"),
        )

    def line_counts(x: Column) -> Column:
        return F.struct(
            F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")
        )

    # One struct per scan of the text: the filter on its size keeps the optimiser from computing
    # it again for every field.
    out = docs.withColumns({"_wc": let(words(raw), counted), "_lc": let(lines, line_counts)})
    found = {
        "n_words": F.col("_wc.n_words"),
        "word_chars": F.col("_wc.word_chars"),
        "n_symbols": F.length(F.regexp_replace(raw, f"[^{SYMBOLS}]+", "")),
        "n_lines": F.col("_lc.n_lines"),
        "n_dup_lines": F.col("_lc.n_dup_lines"),
        "n_repeat_words": F.col("_wc.n_repeat_words"),
    }
    out = out.withColumns({k: v.cast("long") for k, v in found.items()}).drop("_wc", "_lc")
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    return out.withColumn("base_failed", failed)


def _ratio(metric: str) -> Column:
    over, under, factor, _, _ = METRICS[metric]
    return F.floor(F.col(over) * factor / F.greatest(F.col(under), F.lit(1))).cast("long")


def sketch_bin(value: Column) -> Column:
    """Lower end of the sketch bin of a value >= 0: the value cut to its six leading bits."""
    spare = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), spare)
    return value - value % step


def sketches(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Quantile sketches of rows that pass the base rule: (lang, source, metric, bin, n)."""
    ratios = F.array(*[F.struct(F.lit(m).alias("metric"), _ratio(m).alias("v")) for m in METRICS])
    rows = counted.where(~F.col("base_failed")).select(
        F.col(lang).alias("_lang"), F.col(source).alias("_source"), F.explode(ratios).alias("r")
    )
    return rows.groupBy("_lang", "_source", F.col("r.metric").alias("metric"), sketch_bin(F.col("r.v")).alias("bin")).agg(
        F.count("*").alias("n")
    )


def fences(sketch: DataFrame) -> DataFrame:
    """Quartiles out of the sketches, and the fences around them: one row per (lang, source)."""
    group = Window.partitionBy("_lang", "_source", "metric")
    told = sketch.withColumns(
        {
            "upto": F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)),
            "total": F.sum("n").over(group),
        }
    )
    quartiles = told.groupBy("_lang", "_source", "metric").agg(
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bin"))).alias("q3"),
    )
    least = F.create_map(*[x for m, v in METRICS.items() for x in (F.lit(m), F.lit(v[3]))])
    spread = SPREADS * F.greatest(F.col("q3") - F.col("q1"), least[F.col("metric")])
    fenced = quartiles.withColumns({"low": F.col("q1") - spread, "high": F.col("q3") + spread})

    def of(metric: str, bound: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(bound))).alias(f"_{metric}_{bound}")

    return fenced.groupBy("_lang", "_source").agg(
        *[of(m, "high") for m in METRICS], *[of(m, "low") for m, v in METRICS.items() if v[4]]
    )


def _verdict(counted: DataFrame, bounds: DataFrame, lang: str, source: str) -> DataFrame:
    on = counted[lang].eqNullSafe(bounds["_lang"]) & counted[source].eqNullSafe(bounds["_source"])
    kept = F.lit(True)
    for metric, (*_, low) in METRICS.items():
        kept &= F.coalesce(_ratio(metric) <= F.col(f"_{metric}_high"), F.lit(True))
        if low:
            kept &= F.coalesce(_ratio(metric) >= F.col(f"_{metric}_low"), F.lit(True))
    # One expression, no conjunction: a part that needs the counts only would be pushed below the
    # join and compute them a second time.
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(kept)
    return counted.join(bounds, on, "left").withColumn("kept", kept).drop(*bounds.columns)


def _packed(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """The input's columns in one struct beside the three that are read, so that names cannot clash."""
    return docs.select(
        whole_row(docs),
        F.col(text).alias("_text"),
        F.col(lang).alias("_lang0"),
        F.col(source).alias("_source0"),
    )


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """All rows without their text, with the base counts, `base_failed` and `kept`.

    The counts are written to the shared folder once; sketches and verdicts read them there.
    """
    added = [*COUNTS, "base_failed", "kept"]
    rest = [c for c in docs.columns if c != text and c.lower() not in added]
    packed = _packed(docs, text, lang, source).withColumn("_row", F.struct(F.lit(0).alias("_"), *from_row(rest)))
    counted = cut(with_counts(packed, "_text").drop("_text"))
    told = _verdict(counted, fences(sketches(counted, "_lang0", "_source0")), "_lang0", "_source0")
    return told.select(*from_row(rest), *added)


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows that are kept, as they were. Counts and fences are written to the shared folder; the
    counts are computed again beside the text, so that no text is written or shuffled for it."""
    packed = _packed(docs, text, lang, source)
    bare = with_counts(packed.drop("_row"), "_text").drop("_text")
    bounds = cut(fences(sketches(cut(bare), "_lang0", "_source0")))
    counted = with_counts(packed, "_text").drop("_text")
    return _verdict(counted, bounds, "_lang0", "_source0").where("kept").select("_row.*")
