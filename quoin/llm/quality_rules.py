"""Quality rules with thresholds that adapt to each language and source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import BLANKS, settle
from .textkernel import U

#: Fixed value: the symbols that the contract counts.
SYMBOLS = "#*$%&|<>"
#: Relative error of the quantile sketch.
ACCURACY = 0.0025
#: The ratios that are fenced above; word length is fenced below, too.
MEASURES = ("symbols", "word_length", "dup_lines", "repeats")
#: Shares at which a sketch is read to find out how far a measure spreads, nearest to the median first.
LADDER = (0.75, 0.9, 0.95, 0.99)

FEATURES = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def features(docs: DataFrame) -> DataFrame:
    """Counts of each whole text, about `textkernel.PART_BYTES` at a time. A null text has no word and one empty line."""
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS.encode())] = True

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk.lean()
        for batch in (part for whole in batches for part in tk.parts(whole, 3)):
            text = batch.column(3)
            w = tk.words(text)
            _, offsets = tk.buffer(text)
            at = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])  # noqa: E731, B023
            blank = (w.data - np.uint8(9) < np.uint8(5)) | (w.data == np.uint8(32))
            starts, of = tk.window_starts(w.first, 3)
            repeated = np.zeros(len(w.starts), dtype=bool)
            if len(starts):
                own = tk.mix(tk.windows(w.hashes, 3)[starts] + tk.mix(of.astype(U), 7), 8)  # a window and its text
                seen, times = tk.tally(own)
                more = seen[times > 1]
                repeated = tk.covered(starts[tk.lookup(more, np.ones(len(more), np.uint8), own) > 0], 3, len(w.starts))
            n_lines, dups = [], []
            for t in text.to_pylist():
                lines = (t or "").split("\n")
                full = [x for x in lines if x.strip(BLANKS)]
                n_lines.append(len(lines))
                dups.append(len(full) - len(set(full)))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(w.counts(), pa.int64()), pa.array(at(~blank & ((w.data & 0xC0) != 0x80)), pa.int64()), pa.array(at(symbol.take(w.data)), pa.int64()),
                 pa.array(dups, pa.int64()), pa.array(np.diff(np.concatenate(([0], np.cumsum(repeated)))[w.first]), pa.int64()), pa.array(n_lines, pa.int64())],
                names=["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"])

    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string")).mapInArrow(count, FEATURES)


def _measures(f: DataFrame) -> DataFrame:
    """The ratios that are fenced; null for a text without words."""
    per = lambda c: F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words"))
    return f.withColumns({"symbols": per("n_symbols"), "word_length": per("word_chars"), "dup_lines": F.col("n_dup_lines") / F.col("n_lines"), "repeats": per("n_repeat_words")})


def sketch(f: DataFrame) -> DataFrame:
    """Quantile sketches (lang, source, measure, bin, n): counts of values in bins of equal relative width.

    Sketches merge by adding up counts, so partial ones are made on the map side, and the sketch of a
    language or of all documents is the sum of its parts. A bin's centre is within ACCURACY of all
    its values; zero is a bin of its own.
    """
    gamma = (1 + ACCURACY) / (1 - ACCURACY)
    long = f.select("lang", "source", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("x")) for m in MEASURES])).alias("m")).select("lang", "source", "m.*")
    return long.where("x is not null").groupBy("lang", "source", "measure", F.when(F.col("x") > 0, F.ceil(F.ln("x") / F.lit(float(np.log(gamma))))).alias("bin")).agg(F.count("*").alias("n"))


def spreads(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by, measure, n, up, up_by, low, low_by) of the merged sketches of each group.

    up is the first quantile of LADDER that lies above the median, up_by how far; null if none does.
    low and low_by are the same below the median. A quantile is its bin's centre.
    """
    gamma = (1 + ACCURACY) / (1 - ACCURACY)
    merged = sketches.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
    rising = W.partitionBy(*by, "measure").orderBy(F.col("bin").asc_nulls_first())
    ranked = merged.withColumn("below", F.sum("n").over(rising)).withColumn("all", F.sum("n").over(W.partitionBy(*by, "measure")))
    centre = F.when(F.col("bin").isNull(), F.lit(0e0)).otherwise(F.lit(2 / (gamma + 1)) * F.pow(F.lit(gamma), F.col("bin").cast("double")))
    at = lambda p: F.min(F.when(F.col("below") >= F.lit(p) * F.col("all"), centre))
    shares = [*LADDER, 0.5, *(round(1 - p, 4) for p in LADDER)]
    q = ranked.groupBy(*by, "measure").agg(F.sum("n").alias("n"), *[at(p).alias(f"q{p}") for p in shares])
    c = lambda p: F.col(f"`q{round(p, 4)}`")
    up = F.coalesce(*[F.when(c(p) > c(0.5), c(p)) for p in LADDER])
    low = F.coalesce(*[F.when(c(1 - p) < c(0.5), c(1 - p)) for p in LADDER])
    return q.select(*by, "measure", "n", up.alias("up"), (up - c(0.5)).alias("up_by"), low.alias("low"), (c(0.5) - low).alias("low_by"))


def fences(sketches: DataFrame, reach: float, min_rows: int) -> DataFrame:
    """(lang, source, {measure}_high, word_length_low) for every language and source; null where there is no fence."""
    levels = [["lang", "source"], ["lang"], []]
    groups = sketches.select("lang", "source", "measure").distinct()
    for i, by in enumerate(levels):
        far = spreads(sketches, by).select(*[F.col(c).alias(f"_{c}") for c in (*by, "measure")], F.col("n").alias(f"n{i}"), (F.col("up") + F.lit(float(reach)) * F.col("up_by")).alias(f"high{i}"), (F.col("low") - F.lit(float(reach)) * F.col("low_by")).alias(f"low{i}"))
        on = F.col("measure") == F.col("_measure")
        for c in by:
            on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
        groups = groups.join(far, on).drop("_lang", "_source", "_measure")
    pick = lambda c: F.coalesce(F.when(F.col("n0") >= min_rows, F.col(f"{c}0")), F.when(F.col("n1") >= min_rows, F.col(f"{c}1")), F.col(f"{c}2"))
    groups = groups.select("lang", "source", "measure", pick("high").alias("high"), pick("low").alias("low"))
    of = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{c}")
    return groups.groupBy("lang", "source").agg(*[of(m, "high") for m in MEASURES], of("word_length", "low"))


def quality_rules(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, reach: float = 5.0, min_rows: int = 50) -> DataFrame:
    """Each document's counts, base_failed, and kept: whether it passes the base rules and its group's fences.

    base_failed: fewer than min_words words, or more than max_repeat_percent % of the words in
    three-word windows that repeat. The others make quantile sketches of four ratios for each
    language and source. A group's fence lies `reach` spreads above an upper quantile (for word
    length below a lower one, too): the first of LADDER that differs from the median, as a ratio
    that is nearly always zero spreads in its tail only; the spread is its distance from the median.
    Nothing else sets a fence. A group of fewer than min_rows documents, or all of one value, has its
    language's fence, and such a language that of all; without any spread there is no fence.
    Documents beyond a fence are not kept; one that lies on it is.

    Fences are one row for each language and source, joined null-safe; null is a language and a
    source of its own. Null and empty texts fail the base rules. Texts of any length are counted
    whole, one too long for a part by itself. Repeated rows count as often as they occur; an
    empty table gives an empty one; other columns, of whatever name, are ignored. Returns doc_id, the
    counts and the verdicts, then the ratios and fences they come from.
    """
    f = settle(features(docs), "quality-features")
    n = F.col("n_words")
    f = _measures(f).withColumn("base_failed", (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * n))
    sketches = settle(sketch(f.where(~F.col("base_failed"))), "quality-sketches")
    side = fences(sketches, reach, min_rows).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = f.join(side, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    within = lambda test: F.coalesce(test, F.lit(True))
    inside = within(F.col("word_length") >= F.col("word_length_low"))
    for m in MEASURES:
        inside = inside & within(F.col(m) <= F.col(f"{m}_high"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"), "lang", "source", *MEASURES, *[f"{m}_high" for m in MEASURES], "word_length_low")
