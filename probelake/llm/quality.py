"""Quality rules: base counts, then robust multivariate outliers per language and source.

Every document gives a vector of transformed statistics. For each (lang, source) the minimum covariance
determinant estimate of centre and scatter is found by concentration steps: distances to the present
estimate, the share ``KEEP`` of rows with the smallest distances, centre and scatter of these, and so on until no
determinant gets smaller, from two starts (all rows; medians and quartiles); the smallest determinant wins.
A step is a histogram of distances and sums, both added up per task before they move, so a group with a third
of all rows costs what its rows cost. Documents whose Mahalanobis distance is beyond a chi-square quantile go.

A group has an estimate of its own from ``MIN_GROUP`` rows on, which is what five statistics need. Smaller groups are
judged by the estimate over all of them together, and if these are still fewer, by that over all rows. So every row
that passes the base rules is judged.
"""

from __future__ import annotations

import math
from collections import Counter
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from probelake.llm.common import importable, map_texts, record, texts
from probelake.session import stage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 30
KEEP = 0.75
#: What the log of a determinant has to fall by to count as smaller.
GAIN = 1e-3
#: Share of clean rows that may be rejected if the statistics were normal; they have longer tails.
ALPHA = 1e-4
#: Least standard deviations: log words, log word length, roots of the shares of symbols, repeated lines, repeated words.
FLOORS = (1.0, 0.08, 0.06, 0.05, 0.12)
P = len(FLOORS)
BUCKETS_PER_DOUBLING = 16

BASE = [
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
]
BASE_SCHEMA = ", ".join(f"{name} long" for name, _ in BASE)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which the text has twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(at, end)
            end = at + 3
    return covered


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    raw = text.encode()
    words = raw.split()  # bytes.split() splits at exactly space and 09 to 0D
    spaces = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    symbols = sum(text.count(c) for c in SYMBOLS)
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeat_words(words)


def base(docs: DataFrame, passed: list[str]) -> DataFrame:
    """The base counts of every document, with the columns named in ``passed``."""
    rows = docs.select(*passed, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")

    def work(piece: pa.RecordBatch):
        counts = [base_counts(t) for t in texts(piece)]
        kept = [piece.column(c) for c in passed]
        types = [(c, a.type) for c, a in zip(passed, kept)] + BASE
        yield record(types, [*kept, *(list(c) for c in zip(*counts))])

    return map_texts(rows, work, f"{schema}, {BASE_SCHEMA}")


def failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def features() -> list[Column]:
    words = 1.0 + F.col("n_words")
    return [
        F.log(words),
        F.log((1.0 + F.col("word_chars")) / words),
        F.sqrt(F.col("n_symbols") / (1.0 + F.col("word_chars"))),
        F.sqrt(F.col("n_dup_lines") / words),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


X = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. to ``centre`` under ``precision``, a row-wise expression."""
    off = [F.col(x) - F.col("centre")[i] for i, x in enumerate(X)]
    terms = [
        off[i] * off[j] * F.col("precision")[i * P + j] * (1.0 if i == j else 2.0) for i, j in PAIRS
    ]
    return sum(terms[1:], terms[0])


def chi_square(q: float, degrees: int) -> float:
    """Quantile by Wilson and Hilferty."""
    z, a = NormalDist().inv_cdf(q), 2 / (9 * degrees)
    return degrees * (1 - a + z * math.sqrt(a)) ** 3


def consistency() -> float:
    """What the scatter of the inner ``KEEP`` of normal rows has to be multiplied by."""
    inner, z = chi_square(KEEP, P), 2 / (9 * (P + 2))
    share = NormalDist().cdf(((inner / (P + 2)) ** (1 / 3) - (1 - z)) / math.sqrt(z))
    return KEEP / share


def _estimates(sums: DataFrame) -> DataFrame:
    """Centre, inverse scatter and log determinant from the sums of each group and start."""

    def solve(batches):
        for batch in batches:
            rows = batch.to_pylist()
            centres, precisions, dets = [], [], []
            for r in rows:
                n = r["n"]
                mean = np.array([r[f"s{i}"] for i in range(P)]) / n
                scatter = np.zeros((P, P))
                for i, j in PAIRS:
                    scatter[i, j] = scatter[j, i] = r[f"q{i}_{j}"] / n - mean[i] * mean[j]
                scatter = scatter * r["factor"] + np.diag(np.square(FLOORS))
                centres.append(mean.tolist())
                precisions.append(np.linalg.inv(scatter).ravel().tolist())
                dets.append(float(np.linalg.slogdet(scatter)[1]))
            reals = pa.list_(pa.float64())
            types = [("g", pa.string()), ("start", pa.int32()), ("size", pa.int64())]
            types += [("centre", reals), ("precision", reals), ("log_det", pa.float64())]
            given = [[r[c] for r in rows] for c in ("g", "start", "size")]
            yield record(types, [*given, centres, precisions, dets])

    importable(sums.sparkSession)
    schema = "g string, start int, size long, centre array<double>, precision array<double>, log_det double"
    return sums.mapInArrow(solve, schema)


def _sums(rows: DataFrame, by: list[str], factor: float) -> DataFrame:
    first = [F.sum(x).alias(f"s{i}") for i, x in enumerate(X)]
    second = [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q{i}_{j}") for i, j in PAIRS]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *first, *second).withColumn("factor", F.lit(factor))


POOL = "{}"


def _grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with ``g``, their language and source or the pool, and the rows that the estimates are made from."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    fine = F.to_json(F.struct("lang", "source"))
    sizes = stage(sizes.withColumn("g", F.when(F.col("n") >= MIN_GROUP, fine).otherwise(POOL)), "mcd-groups")
    pooled = sizes.where(F.col("g") == POOL).agg(F.sum("n")).first()[0] or 0
    of = sizes.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "g")
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    rows = rows.join(of, same, "left").drop("of_lang", "of_source")
    if pooled == 0 or pooled >= MIN_GROUP:
        return rows, rows
    return rows, rows.where(F.col("g") != POOL).unionByName(rows.withColumn("g", F.lit(POOL)))


def fit(rows: DataFrame) -> DataFrame:
    """The estimate of each group ``g`` of rows with x0..: centre, precision, size."""
    sizes = rows.groupBy("g").agg(
        F.count("*").alias("size"),
        *[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"p{i}") for i, x in enumerate(X)],
    )
    sizes = stage(sizes, "mcd-sizes")
    whole = _sums(rows, ["g"], 1.0).join(sizes.select("g", "size"), "g").withColumn("start", F.lit(0))
    spread = [
        F.array(
            *[
                1.0 / (F.pow((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, 2) + FLOORS[i] ** 2)
                if i == j
                else F.lit(0.0)
                for i in range(P)
                for j in range(P)
            ]
        )
    ]
    middle = F.array(*[F.col(f"p{i}")[1] for i in range(P)])
    robust = sizes.select(
        "g",
        F.lit(1).alias("start"),
        "size",
        middle.alias("centre"),
        spread[0].alias("precision"),
        F.lit(0.0).alias("log_det"),
    )
    now = stage(_estimates(whole).unionByName(robust), "mcd-start")
    least: DataFrame | None = None
    while True:
        bucket = F.floor(F.log2(distance() + 1e-9) * BUCKETS_PER_DOUBLING).alias("bucket")
        counts = rows.join(now, "g").groupBy("g", "start", "size", bucket).agg(F.count("*").alias("n"))
        running = Window.partitionBy("g", "start").orderBy("bucket")
        enough = F.sum("n").over(running) >= F.ceil(F.col("size") * KEEP)
        cut = counts.withColumn("enough", enough).where("enough").groupBy("g", "start")
        cut = cut.agg(F.min("bucket").alias("cut"))
        bounded = stage(now.join(cut, ["g", "start"]), "mcd-bounds")  # a few rows: the rows themselves don't move
        inner = rows.join(bounded, "g").where(bucket <= F.col("cut"))
        now = stage(_estimates(_sums(inner, ["g", "start", "size"], consistency())), "mcd-step")
        if least is not None and not _smaller(least, now):
            break
        least = now if least is None else stage(_least(least.unionByName(now)), "mcd-least")
    best = least.groupBy("g").agg(F.min_by(F.struct("centre", "precision"), F.struct("log_det", "start")).alias("e"))
    return best.select("g", "e.centre", "e.precision")


def _least(estimates: DataFrame) -> DataFrame:
    """Of each group and start the estimate with the smallest determinant."""
    rest = [c for c in estimates.columns if c not in ("g", "start")]
    least = estimates.groupBy("g", "start").agg(F.min_by(F.struct(*rest), "log_det").alias("e"))
    return least.select("g", "start", "e.*")


def _smaller(least: DataFrame, now: DataFrame) -> bool:
    """Whether the determinant of any group is smaller than before; it can't be forever, as it has a bound."""
    before = least.select("g", "start", F.col("log_det").alias("then"))
    return not now.join(before, ["g", "start"]).where(F.col("log_det") < F.col("then") - GAIN).isEmpty()


def judge(counted: DataFrame) -> DataFrame:
    """Adds base_failed, distance (null if that is true) and kept to rows with lang, source and base counts."""
    rows = counted.withColumn("base_failed", failed())
    names = rows.columns
    rows = rows.withColumns(dict(zip(X, features())))
    good, learned = _grouped(rows.where(~F.col("base_failed")))
    fitted = fit(learned.select("g", *X))
    judged = good.join(fitted, "g", "left").withColumn("distance", F.sqrt(distance()))
    limit = math.sqrt(chi_square(1 - ALPHA, P))
    judged = judged.withColumn("kept", F.col("distance") <= limit)
    poor = rows.where("base_failed").withColumns(
        {"distance": F.lit(None).cast("double"), "kept": F.lit(False)}
    )
    out = [*names, "distance", "kept"]
    return judged.select(*out).unionByName(poor.select(*out))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, distance.

    A null text has no words and fails; null languages and sources are groups like others; an empty table gives
    an empty result; repeated rows are judged each; other columns are not read.
    """
    counted = stage(base(docs, ["doc_id", "lang", "source"]), "quality-counts")
    return judge(counted).drop("lang", "source").select(
        "doc_id", *[name for name, _ in BASE], "base_failed", "kept", "distance"
    )
