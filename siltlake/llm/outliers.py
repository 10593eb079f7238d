"""Quality rules and robust multivariate outliers.

Statistics of a text that base rules accept are transformed to a vector. For
each language and source, the centre and covariance of the three quarters of
documents that have the smallest covariance determinant are estimated, starting
from medians and median deviations, by concentration steps: the documents
nearest to the estimate make the next one. A text is rejected whose Mahalanobis
distance is beyond what documents of its group have.

All of it is DataFrame functions. A group is never gathered: its moments and
quantiles are aggregates, and a step costs two passes over the narrow
statistics.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import GAP, WORD, broadcast_if_small, stored, unpack, whole_row

# Symbols, words of a window, and the base rules.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED_PERCENT = 30

# Fixed value: what the covariance of the nearest three quarters of normal
# vectors in four dimensions has to be multiplied by.
QUARTERS = 0.75
CONSISTENCY = 1.485


@dataclass(frozen=True)
class Rules:
    """``cutoff`` is a squared distance: 30 is passed by 5 in 10^6 of normal
    vectors in four dimensions. ``floors`` are the deviations that every group is
    granted, since many groups hardly vary in a statistic; they leave each
    statistic room to pass the cutoff alone, repeated words below the base rule's
    limit too. Groups with fewer than ``least`` documents take the estimates of
    their language, or of all."""

    cutoff: float = 30.0
    floors: tuple[float, ...] = (0.08, 0.25, 0.6, 0.5)
    steps: int = 4
    least: int = 50


def _repeated(words: Column) -> Column:
    """Words in windows that occur twice or more: hashes of windows with their
    places are sorted, neighbours compared, and the places covered added up."""

    def windows(hashes: Column) -> Column:
        n = F.size(hashes) - (WINDOW - 1)
        return F.when(
            n > 1,
            F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])),
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(rows: Column) -> Column:
        same = lambda i, j: F.get(rows, i)["h"] == F.get(rows, j)["h"]
        doubled = F.filter(
            F.transform(
                rows,
                lambda row, i: F.when(F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)), row["p"]),
            ),
            lambda p: p.isNotNull(),
        )
        return _let(
            F.array_sort(doubled),
            lambda places: F.aggregate(
                F.transform(places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0), lambda a, b: a + b,
            ),
        )

    def of_windows(found: Column) -> Column:
        return F.when(
            F.size(F.array_distinct(found)) < F.size(found),
            _let(F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), covered),
        ).otherwise(F.lit(0))

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return _let(hashes, lambda h: _let(windows(h), of_windows))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def statistics(text: Column) -> Column:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of
    a text; all zero for null and for texts without words."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    words = F.filter(F.split(text, GAP, -1), lambda word: word != "")
    return F.struct(
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_words"),
        F.length(F.regexp_replace(text, GAP, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.size(lines).cast("bigint").alias("n_lines"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _repeated(words).cast("bigint").alias("n_repeat_words"),
    )


def base_failed(s: str = "s") -> Column:
    return (F.col(f"{s}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{s}.n_repeat_words") > MOST_REPEATED_PERCENT * F.col(f"{s}.n_words")
    )


def vector(s: str = "s") -> list[Column]:
    """Mean length of words, and percentages of symbols, lines and words that
    repeat, as logarithms."""
    percent = lambda part, whole: F.log1p(100.0 * F.col(f"{s}.{part}") / F.col(f"{s}.{whole}"))
    return [
        F.log(F.col(f"{s}.word_chars") / F.col(f"{s}.n_words")),
        percent("n_symbols", "word_chars"),
        percent("n_dup_lines", "n_lines"),
        percent("n_repeat_words", "n_words"),
    ]


DIMENSIONS = 4
_PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i + 1)]


def _factor(cov: dict[tuple[int, int], Column]) -> list[Column]:
    """The lower triangular factor of a positive definite matrix, row by row."""
    out: dict[tuple[int, int], Column] = {}
    for i, j in _PAIRS:
        rest = cov[i, j]
        for k in range(j):
            rest = rest - out[i, k] * out[j, k]
        out[i, j] = F.sqrt(rest) if i == j else rest / out[j, j]
    return [out[pair].alias(f"l{pair[0]}{pair[1]}") for pair in _PAIRS]


def _distance(row: str, estimate: str) -> Column:
    """Squared Mahalanobis distance, by forward substitution."""
    solved: list[Column] = []
    for i in range(DIMENSIONS):
        rest = F.col(f"{row}.x{i}") - F.col(f"{estimate}.m{i}")
        for j in range(i):
            rest = rest - F.col(f"{estimate}.l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"{estimate}.l{i}{i}"))
    return sum((x * x for x in solved[1:]), solved[0] * solved[0])


def _keys() -> tuple[Column, Column]:
    """Keys of the language and of language and source; null is one of them."""
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(x)), F.lit("-")) for x in ("lang", "source"))
    return lang, F.concat_ws("\t", lang, source)


def _groups(rows: DataFrame, least: int) -> DataFrame:
    """(pair, key): for each language and source the group that gives their
    estimates: their own, that of the language, or of all."""
    lang, pair = _keys()
    counts = rows.groupBy(lang.alias("in_lang"), pair.alias("pair")).agg(F.count("*").alias("n"))
    langs = counts.groupBy("in_lang").agg(F.sum("n").alias("n_lang"))
    key = F.when(F.col("n") >= least, F.col("pair")).when(F.col("n_lang") >= least, F.col("in_lang")).otherwise(F.lit("*"))
    return counts.join(langs, "in_lang").select("pair", key.alias("key"))


def estimates(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(pair, estimate) for each language and source of ``rows``, which has lang,
    source and s (statistics) of texts that passed the base rules, stored."""
    groups = stored(_groups(rows, rules.least), "groups")
    lang, pair = _keys()
    points = F.struct(*[x.alias(f"x{i}") for i, x in enumerate(vector())])
    # A document counts for its pair, its language and all of them, as far as
    # some pair takes its estimates there.
    used = groups.select("key").distinct()
    rows = rows.select(points.alias("v"), F.array(pair, lang, F.lit("*")).alias("keys"))
    rows = rows.select("v", F.explode("keys").alias("key"))
    rows = rows.join(broadcast_if_small(used), "key")
    at = [F.col(f"v.x{i}") for i in range(DIMENSIONS)]
    half = lambda x: F.percentile_approx(x, F.lit(0.5), F.lit(10_000))
    centre = stored(rows.groupBy("key").agg(*[half(x).alias(f"c{i}") for i, x in enumerate(at)]), "medians")
    spread = [half(F.abs(x - F.col(f"c{i}"))) * 1.4826 for i, x in enumerate(at)]
    nil = F.lit(0.0)
    start = (
        rows.join(broadcast_if_small(centre), "key")
        .groupBy("key")
        .agg(*[F.first(f"c{i}").alias(f"m{i}") for i in range(DIMENSIONS)], *[s.alias(f"s{i}") for i, s in enumerate(spread)])
    )
    diagonal = {
        (i, j): F.pow(F.col(f"s{i}"), 2) + rules.floors[i] ** 2 if i == j else nil for i, j in _PAIRS
    }
    estimate = _estimate(start, diagonal)
    for _ in range(rules.steps):
        near = rows.join(broadcast_if_small(estimate), "key").withColumn("d", _distance("v", "e"))
        radius = near.groupBy("key").agg(F.percentile_approx("d", F.lit(QUARTERS), F.lit(10_000)).alias("r"))
        kept = near.join(broadcast_if_small(stored(radius, "radius")), "key").filter("d <= r")
        moments = kept.groupBy("key").agg(
            *[F.avg(x).alias(f"m{i}") for i, x in enumerate(at)],
            *[F.covar_pop(at[i], at[j]).alias(f"q{i}{j}") for i, j in _PAIRS],
        )
        granted = lambda i, j: rules.floors[i] ** 2 if i == j else 0.0
        cov = {(i, j): F.col(f"q{i}{j}") * CONSISTENCY + F.lit(granted(i, j)) for i, j in _PAIRS}
        estimate = _estimate(moments, cov)
    return groups.join(estimate, "key").select("pair", "e")


def _estimate(moments: DataFrame, cov: dict[tuple[int, int], Column]) -> DataFrame:
    centre = [F.col(f"m{i}") for i in range(DIMENSIONS)]
    return stored(moments.select("key", F.struct(*centre, *_factor(cov)).alias("e")), "estimate")


def _judge(rows: DataFrame, rules: Rules) -> DataFrame:
    """``rows`` (stored, with lang, source and s) and kept."""
    found = estimates(rows.filter(~base_failed()).select("lang", "source", "s"), rules)
    lang, pair = _keys()
    points = F.struct(*[x.alias(f"x{i}") for i, x in enumerate(vector())])
    rows = rows.withColumn("pair", pair).join(broadcast_if_small(found), "pair", "left")
    distance = F.when(~base_failed(), _distance("v", "e"))
    rows = rows.withColumn("failed", base_failed()).withColumn("v", F.when(~base_failed(), points))
    return rows.withColumn("distance", distance).withColumn(
        "kept", ~F.col("failed") & F.coalesce(F.col("distance") <= rules.cutoff, F.lit(True))
    )


def judged(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and distance of each row of ``docs``.

    Null and empty texts have no words and fail the base rules. A null language
    or source is a group like any other. Repeated rows count as often as they
    come and get the same verdict. Other columns are not read.
    """
    rows = stored(docs.select("doc_id", "lang", "source", statistics(F.col("text")).alias("s")), "statistics")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return _judge(rows, rules).select(
        "doc_id", *[F.col(f"s.{x}").alias(x) for x in names], F.col("failed").alias("base_failed"), "kept", "distance"
    )


def good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all columns."""
    rows = docs.select(whole_row(docs).alias("row"), "lang", "source", statistics(F.col("text")).alias("s"))
    return unpack(_judge(stored(rows, "statistics"), rules).filter("kept"))
