"""Operator 1, quality rules: robust multivariate outliers by minimum covariance determinants.

Per-document statistics come from built-in functions alone. Each language and source gets a minimum
covariance determinant (MCD) estimate of location and scatter of the transformed statistics; a document is
rejected when its squared Mahalanobis distance exceeds a chi-square quantile.

The estimate follows the deterministic form of the fast MCD: two starts per group (median with MAD scales,
and the tanh-score correlation scaled by the MADs), concentration steps on the half of the group with the
smallest distances until the determinants stop falling, the start with the smaller determinant, a
consistency factor and one reweighting step. All of it is counts and sums per group: order statistics are
read from exact histograms of fixed bin width, so that no group is ever gathered in one task and the number
of shuffled rows per step is bounded by groups times bins. Every scale has a documented floor, since
statistics such as the share of symbols are exactly zero in most clean texts.

Defined results: null text counts as the empty text; null language or source is a value of its own; groups
with fewer than ``min_rows`` fitting rows are pooled by language, then all together, and a pool that is still
too small rejects nothing; repeated rows are judged separately and alike; an empty table gives an empty
result. Further columns of the input are ignored by ``quality_statistics`` and kept by ``quality_filter``.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WHITESPACE, durable, row_identity, small_join, space_words

SYMBOLS = "#*$%&|<>"
#: Transformed statistics and the floor of each one's scale. Clean texts have no symbols, so their floor is the
#: scale: as small as lets one symbol in the shortest text of the base rules (20 words, 80 letters) pass.
STATISTICS = {"x_words": 0.5, "x_length": 0.12, "x_symbols": 0.02, "x_lines": 0.15, "x_repeats": 0.12}
BIN = 1e-3
QUANTILE = 0.99999
MIN_ROWS = 60
#: Concentration steps at most. A group ends when neither start's log determinant falls by SETTLED any more; the
#: groups that haven't ended after so many steps raise a warning with their number.
MAX_STEPS, SETTLED = 30, 1e-3


# ---------------------------------------------------------------------------------------------- statistics
def repeated_words(words: str, n: int = 8) -> Column:
    """Words that lie in an n-word window found twice or more in the text (n even).

    Windows are compared by 64-bit hashes, built from hashes of half windows. Most texts repeat no half
    window and stop after that one distinct count; else windows are sorted by hash, equal neighbours marked,
    and the marked positions merged into runs.
    """
    half = n // 2
    parts = ", ".join(f"w[i + {k}]" for k in range(half))
    return F.expr(f"""
      IF(size({words}) < {n}, 0L,
        transform(array(transform({words}, x -> xxhash64(x))), w ->
          transform(array(transform(sequence(0, size(w) - {half}), i -> xxhash64({parts}))), v ->
            IF(size(array_distinct(v)) = size(v), 0L,
              transform(array(transform(sequence(0, size(w) - {n}), i -> xxhash64(v[i], v[i + {half}]))), g ->
                IF(size(array_distinct(g)) = size(g), 0L,
                  transform(array(sort_array(transform(g, (x, i) -> named_struct('h', x, 'p', i)))), s ->
                    aggregate(
                      sort_array(transform(filter(s, (e, i) -> (i > 0 AND s[i - 1].h = e.h)
                                                            OR (i < size(s) - 1 AND s[i + 1].h = e.h)), e -> e.p)),
                      named_struct('n', 0L, 'e', 0),
                      (a, p) -> named_struct('n', a.n + {n} - greatest(a.e - p, 0), 'e', p + {n}),
                      a -> a.n))[0]))[0]))[0])[0])""")


def quality_statistics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Counts, base verdict and transformed statistics of each document; ``keep`` names columns to carry."""
    keep = ["doc_id"] if keep is None else keep
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = reduce(lambda s, c: F.replace(s, F.lit(c), F.lit("")), SYMBOLS, text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" " + WHITESPACE))) > 0)
    out = docs.select(
        *[F.col(c) for c in keep],
        *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(f"g_{c}") for c in ("lang", "source")],
        space_words(F.col("text")).alias("q_words"),
        lines.alias("q_lines"),
        (F.length(text) - F.length(plain)).cast("long").alias("n_symbols"),
    )
    out = out.select(
        *keep, "g_lang", "g_source", "n_symbols",
        F.length(F.array_join("q_words", "")).cast("long").alias("word_chars"),
        F.size("q_words").cast("long").alias("n_words"),
        F.size("q_lines").cast("long").alias("n_lines"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words("q_words").alias("n_repeat_words"),
    )
    words, chars, n_lines = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("n_words", "word_chars", "n_lines"))
    return out.withColumns({
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        "x_words": F.log(words),
        "x_length": F.log(chars / words),
        "x_symbols": F.sqrt(F.col("n_symbols") / chars),
        "x_lines": F.sqrt(F.col("n_dup_lines") / n_lines),
        "x_repeats": F.sqrt(F.col("n_repeat_words") / words),
    })


# ------------------------------------------------------------------------------------------ chi-square law
def chi2_cdf(x: float, k: int) -> float:
    """Distribution function of the chi-square law, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    for i in range(1, 2000):
        term *= z / (a + i)
        total += term
        if term < total * 1e-15:
            break
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    """Quantile of the chi-square law, by bisection."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return (low + high) / 2


def consistency(share: float, k: int) -> float:
    """Factor that makes the scatter of the inner ``share`` of a normal law consistent."""
    return share / max(chi2_cdf(chi2_quantile(share, k), k + 2), 1e-9) if share < 1 else 1.0


# ----------------------------------------------------------------------------------------------- estimates
def _order_statistic(rows: DataFrame, keys: list[str], value: Column, share: float, name: str) -> DataFrame:
    """Per key, the upper edge of the first bin at which ``share`` of the rows is reached: an exact count."""
    bins = rows.select(*keys, F.floor(value / BIN).alias("_bin")).groupBy(*keys, "_bin").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys)
    return (
        bins.withColumns({"_cum": F.sum("_n").over(w.orderBy("_bin")), "_all": F.sum("_n").over(w)})
        .filter(F.col("_cum") >= F.ceil(F.col("_all") * share))
        .groupBy(*keys)
        .agg(((F.min("_bin") + 1) * BIN).alias(name))
    )


def _moments(rows: DataFrame, keys: list[str], xs: list[str]) -> DataFrame:
    """Mean ``m_i`` and covariance ``c_i_j`` per key."""
    p = len(xs)
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(x).alias(f"s_{i}") for i, x in enumerate(xs)],
        *[F.sum(F.col(xs[i]) * F.col(xs[j])).alias(f"q_{i}_{j}") for i, j in pairs],
    )
    n = F.col("n").cast("double")
    return sums.select(
        *keys, "n",
        *[(F.col(f"s_{i}") / n).alias(f"m_{i}") for i in range(p)],
        *[(F.col(f"q_{i}_{j}") / n - F.col(f"s_{i}") / n * F.col(f"s_{j}") / n).alias(f"c_{i}_{j}") for i, j in pairs],
    )


def _factored(moments: DataFrame, keys: list[str], floors: list[float], scale: float = 1.0) -> DataFrame:
    """Mean and Cholesky factor ``l_i_j`` of scale * covariance + squared floors, with the log determinant."""
    p = len(floors)
    out = moments
    for i in range(p):  # row by row; an entry needs the entries to its left
        row: list[Column] = []
        for j in range(i + 1):
            cov = F.col(f"c_{i}_{j}") * scale + (floors[i] ** 2 if i == j else 0.0)
            rest = cov - sum((row[k] * (F.col(f"l_{j}_{k}") if j < i else row[k]) for k in range(j)), F.lit(0.0))
            row.append(F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l_{j}_{j}"))
        out = out.select("*", *[x.alias(f"l_{i}_{j}") for j, x in enumerate(row)])
    logdet = sum((2 * F.log(F.col(f"l_{i}_{i}")) for i in range(p)), F.lit(0.0))
    return out.select(
        *keys, *[f"m_{i}" for i in range(p)], *[f"l_{i}_{j}" for i in range(p) for j in range(i + 1)], logdet.alias("logdet")
    )


def _distance(xs: list[str]) -> Column:
    """Squared Mahalanobis distance by forward substitution in the factor columns."""
    z: list[Column] = []
    for i, x in enumerate(xs):
        rest = F.col(x) - F.col(f"m_{i}") - sum((F.col(f"l_{i}_{k}") * z[k] for k in range(i)), F.lit(0.0))
        z.append(rest / F.col(f"l_{i}_{i}"))
    return sum((v * v for v in z), F.lit(0.0))


def mcd_estimates(rows: DataFrame, xs: list[str], floors: list[float], share: float = 0.5, max_steps: int = MAX_STEPS) -> DataFrame:
    """Reweighted MCD per ``grp``: columns grp, m_i, l_i_j, logdet. ``rows`` has grp and the statistics.

    ``share`` is the part of each group that the determinant is minimised over; one half resists the most
    outliers. The number of groups may be any; parameters stay a table.
    """
    p, key = len(xs), ["grp"]
    # starts: medians and MADs of each statistic
    long = rows.select("grp", F.posexplode(F.array(*xs)).alias("j", "v"))
    med = durable(_order_statistic(long, ["grp", "j"], F.col("v"), 0.5, "med"))
    n_groups = med.count()
    dev = small_join(long, med, ["grp", "j"], rows=n_groups)
    mad = _order_statistic(dev, ["grp", "j"], F.abs(F.col("v") - F.col("med")), 0.5, "mad")
    wide = (
        med.join(mad, ["grp", "j"])
        .groupBy("grp")
        .agg(*[F.max(F.when(F.col("j") == i, F.col(c))).alias(f"{c}_{i}") for i in range(p) for c in ("med", "mad")])
    )
    wide = durable(wide.select("grp", *[f"med_{i}" for i in range(p)], *[(1.4826 * F.col(f"mad_{i}") + floors[i] / 2).alias(f"mad_{i}") for i in range(p)]))
    scored = small_join(rows, wide, key, rows=n_groups).select("grp", *[F.tanh((F.col(x) - F.col(f"med_{i}")) / F.col(f"mad_{i}")).alias(x) for i, x in enumerate(xs)])
    by_tanh = _moments(scored, key, xs).join(wide, "grp")
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    spread = lambda i: F.sqrt(F.col(f"c_{i}_{i}") + 1e-6)
    tanh_start = by_tanh.select(
        "grp", F.lit(1).alias("start"), *[F.col(f"med_{i}").alias(f"m_{i}") for i in range(p)],
        *[(F.col(f"c_{i}_{j}") / spread(i) / spread(j) * F.col(f"mad_{i}") * F.col(f"mad_{j}") * (1.0 if i == j else 0.99)).alias(f"c_{i}_{j}") for i, j in pairs],
    )
    mad_start = wide.select(
        "grp", F.lit(0).alias("start"), *[F.col(f"med_{i}").alias(f"m_{i}") for i in range(p)],
        *[((F.col(f"mad_{i}") ** 2) if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in pairs],
    )
    ids = ["grp", "start"]
    open_ = durable(_factored(mad_start.unionByName(tanh_start), ids, floors).withColumn("fell", F.lit(True)))
    columns, ended, left = open_.columns, [], 1
    for step in range(max_steps):  # concentration steps of the groups that still change
        d = small_join(rows, open_, key, rows=2 * n_groups).select(*ids, *xs, _distance(xs).alias("d2"))
        limit = _order_statistic(d, ids, F.sqrt("d2"), share, "limit")
        inner = small_join(d, limit, ids, rows=2 * n_groups).filter(F.sqrt("d2") < F.col("limit"))
        before = open_.select(*ids, F.col("logdet").alias("before"))
        fell = F.col("before") - F.col("logdet") >= SETTLED if step else F.lit(True)  # the starts aren't halves yet
        state = durable(_factored(_moments(inner, ids, xs), ids, floors).join(before, ids).withColumn("fell", fell).select(*columns))
        ended.append(state.filter(~F.col("fell")))
        open_ = state.filter("fell")
        left = open_.count()
        if not left:
            break
    if left:
        warnings.warn(f"{left} of {2 * n_groups} concentrations still fell after {max_steps} steps", stacklevel=2)
    best = reduce(DataFrame.unionByName, ended, open_).drop("fell").withColumn("_r", F.row_number().over(Window.partitionBy("grp").orderBy("logdet", "start"))).filter("_r = 1").drop("_r", "start")
    # consistency and one reweighting step
    q = chi2_quantile(0.975, p)
    d = small_join(rows, best, key, rows=n_groups).select("grp", *xs, (_distance(xs) / consistency(share, p)).alias("d2")).filter(F.col("d2") <= q)
    return durable(_factored(_moments(d, key, xs), key, floors, consistency(0.975, p)))


def quality_verdicts(stats: DataFrame, quantile: float = QUANTILE, min_rows: int = MIN_ROWS) -> DataFrame:
    """Adds ``distance2`` (null where a pool is too small) and ``kept`` to ``quality_statistics`` rows."""
    xs, floors = list(STATISTICS), list(STATISTICS.values())
    cells = durable(stats.filter(~F.col("base_failed")).groupBy("g_lang", "g_source").agg(F.count("*").alias("n_cell")))
    small = F.col("n_cell") < min_rows
    by_lang = Window.partitionBy("g_lang", small)
    cells = cells.withColumn("n_lang", F.sum("n_cell").over(by_lang)).withColumn(
        "grp",
        F.when(~small, F.concat_ws("\x01", F.lit("cell"), "g_lang", "g_source"))
        .when(F.col("n_lang") >= min_rows, F.concat_ws("\x01", F.lit("lang"), "g_lang"))
        .otherwise(F.lit("all")),
    )
    pool = cells.filter("grp = 'all'").agg(F.sum("n_cell").alias("n_pool"))
    cells = durable(cells.crossJoin(pool).filter((F.col("grp") != "all") | (F.col("n_pool") >= min_rows)).select("g_lang", "g_source", "grp"))  # one row beside a table of groups
    n_cells = cells.count()
    grouped = small_join(stats, cells, ["g_lang", "g_source"], "left", rows=n_cells)
    estimates = mcd_estimates(grouped.filter(~F.col("base_failed") & F.col("grp").isNotNull()).select("grp", *xs), xs, floors)
    judged = small_join(grouped, estimates, ["grp"], "left", rows=n_cells)
    cut = chi2_quantile(quantile, len(xs))
    d2 = _distance(xs)
    return judged.select(*stats.columns, d2.alias("distance2")).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= cut, F.lit(True)))


def quality_filter(docs: DataFrame, quantile: float = QUANTILE, min_rows: int = MIN_ROWS) -> DataFrame:
    """The documents that pass, all columns unchanged. Texts are not shuffled while the rejected rows, counted
    first, are few enough to broadcast."""
    ids = ["doc_id", "text", "lang", "source"]
    named = docs.withColumns(dict(zip(("row_a", "row_b"), row_identity(*ids), strict=True)))
    stats = durable(quality_statistics(named, ["row_a", "row_b"]))
    rejected = durable(quality_verdicts(stats, quantile, min_rows).filter(~F.col("kept")).select("row_a", "row_b").distinct())
    return small_join(named, rejected, ["row_a", "row_b"], "left_anti").drop("row_a", "row_b")


def op1_mcd_quality(spark, sf_dir: str) -> DataFrame:
    """Contract query: statistics, base verdict and MCD verdict of every document."""
    from .common import table

    stats = durable(quality_statistics(table(spark, sf_dir, "documents")))
    return quality_verdicts(stats).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2"
    )
