"""Contingency statistics in long form: chi-square, odds ratios, false discovery, intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.kernels import chi2_p, fisher_p

Z95 = 1.959963984540054


def contingency(rows: DataFrame, r: str, c: str) -> DataFrame:
    """Observed counts of the pairs that occur, with row, column and grand totals."""
    cells = rows.where(F.col(r).isNotNull() & F.col(c).isNotNull()).groupBy(F.col(r).alias("r"), F.col(c).alias("c")).agg(F.count(F.lit(1)).alias("observed"))
    total = lambda *keys: F.sum("observed").over(Window.partitionBy(*keys))
    whole = F.broadcast(cells.agg(F.sum("observed").alias("n")))  # one row
    return cells.withColumns({"row_total": total("r"), "col_total": total("c")}).crossJoin(whole)


def grid(cells: DataFrame) -> DataFrame:
    """Every pair of a row and a column that occur, absent ones observed 0 times."""
    rows, cols = cells.select("r", "row_total", "n").distinct(), cells.select("c", "col_total").distinct()
    full = rows.crossJoin(F.broadcast(cols))  # the categories of one column, a small code list
    return full.join(cells.select("r", "c", "observed"), ["r", "c"], "left").withColumn("observed", F.coalesce("observed", F.lit(0)))


def _effect(v: Column) -> Column:
    return F.when(v < 0.1, "Very Weak").when(v < 0.3, "Weak").when(v < 0.5, "Moderate").otherwise("Strong")


def chi2_by_row(cells: DataFrame) -> DataFrame:
    """Chi-square of each row against the rest, with Cramer's V; null where the rest is empty.

    Cells that are 0 in both lines are left out; a table with one degree of
    freedom gets Yates' correction.
    """
    full = grid(cells)
    row, rest_n, n, col = F.col("row_total"), F.col("n") - F.col("row_total"), F.col("n"), F.col("col_total")
    rest = col - F.col("observed")
    own_expected, rest_expected = row * col / n, rest_n * col / n
    two = F.count(F.lit(1)).over(Window.partitionBy("r")) == 2
    shrink = lambda o, e: F.when(two, F.greatest(F.abs(o - e) - F.least(F.lit(0.5), F.abs(o - e)), F.lit(0.0))).otherwise(F.abs(o - e))
    part = F.pow(shrink(F.col("observed"), own_expected), 2) / F.nullif(own_expected, F.lit(0.0)) + F.pow(shrink(rest, rest_expected), 2) / F.nullif(rest_expected, F.lit(0.0))
    out = full.withColumn("_part", part).groupBy("r").agg(F.sum("_part").alias("chi2"), (F.count(F.lit(1)) - 1).alias("df"), F.first("n").alias("n"), F.min(rest_n).alias("_rest"))
    out = out.withColumn("chi2", F.when(F.col("_rest") > 0, F.col("chi2"))).drop("_rest")
    v = F.sqrt(F.col("chi2") / F.col("n"))
    return out.withColumns({"cramers_v": v, "effect": F.when(v.isNotNull(), _effect(v)), "p": chi2_p("chi2", "df")})


def chi2_cells(cells: DataFrame) -> DataFrame:
    """Expected count, standardised residual and chi-square component of the cells that occur."""
    e = F.col("row_total") * F.col("col_total") / F.col("n")
    return cells.withColumns({"expected": e, "residual": (F.col("observed") - e) / F.sqrt(e), "component": F.pow(F.col("observed") - e, 2) / e})


def chi2_global(cells: DataFrame) -> DataFrame:
    """The statistic of the whole table (all cells), degrees of freedom, Cramer's V and its label."""
    full = grid(cells)
    e = F.col("row_total") * F.col("col_total") / F.col("n")
    one = full.agg(F.sum(F.pow(F.col("observed") - e, 2) / e).alias("chi2"), F.countDistinct("r").alias("rows"), F.countDistinct("c").alias("cols"), F.max("n").alias("n"))
    v = F.sqrt(F.col("chi2") / (F.col("n") * F.nullif(F.least(F.col("rows") - 1, F.col("cols") - 1), F.lit(0))))
    one = one.select("chi2", ((F.col("rows") - 1) * (F.col("cols") - 1)).alias("df"), v.alias("cramers_v"), _effect(v).alias("effect"))
    return one.withColumn("p", chi2_p("chi2", "df"))


def _table(cells: DataFrame) -> DataFrame:
    a, row, col, n = (F.col(x) for x in ("observed", "row_total", "col_total", "n"))
    return cells.select("r", "c", a.alias("a"), (row - a).alias("b"), (col - a).alias("c_"), (n - row - col + a).alias("d"))


def odds_ratios(cells: DataFrame, least: int = 3) -> DataFrame:
    """Odds ratio, 95 % interval and Fisher's p of the pairs whose smallest cell is large enough."""
    t = _table(cells).where(F.least("a", "b", "c_", "d") >= least)
    ratio = F.col("a") * F.col("d") / (F.col("b") * F.col("c_"))
    se = F.sqrt(1 / F.col("a") + 1 / F.col("b") + 1 / F.col("c_") + 1 / F.col("d"))
    return t.withColumns({"odds_ratio": ratio, "se": se, "ci_low": F.exp(F.log(ratio) - 1.96 * se), "ci_high": F.exp(F.log(ratio) + 1.96 * se)}).withColumn("p", fisher_p("a", "b", "c_", "d"))


def odds_ratios_corrected(cells: DataFrame) -> DataFrame:
    """Odds ratio with 0.5 added to each cell, and Yates' chi-square, of the pairs that occur."""
    t = _table(cells)
    a, b, c, d = (F.col(x).cast("double") for x in ("a", "b", "c_", "d"))
    n = a + b + c + d
    yates = n * F.pow(F.greatest(F.abs(a * d - b * c) - n / 2, F.lit(0.0)), 2) / F.nullif((a + b) * (c + d) * (a + c) * (b + d), F.lit(0.0))
    return t.withColumns({"odds_ratio": (a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5)), "chi2_yates": yates})


def false_discovery(df: DataFrame, p: str = "p", alpha: float = 0.05, monotone: bool = True, ties: tuple[str, ...] = ()) -> DataFrame:
    """Benjamini-Hochberg: adjusted p, flags and rank; rows without p are left out."""
    df = df.where(F.col(p).isNotNull())
    order = Window.partitionBy(F.lit(0)).orderBy(p, *ties)
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    df = df.withColumn("rank", F.row_number().over(order)).withColumn("_step", F.least(F.col(p) * n / F.col("rank"), F.lit(1.0)))
    adjusted = F.min("_step").over(order.rowsBetween(0, Window.unboundedFollowing)) if monotone else F.col("_step")
    df = df.withColumn("p_adjusted", adjusted).drop("_step")
    return df.withColumns({"significant": F.col("p_adjusted") <= alpha, "significant_raw": F.col(p) < alpha})


def wilson(hits: Column, n: Column) -> tuple[Column, Column]:
    """95 % Wilson interval in percent, within 0 and 100; (0, 0) for no cases."""
    p, z2 = hits / F.nullif(n, F.lit(0)), Z95 * Z95
    centre = (p + z2 / (2 * n)) / (1 + z2 / n)
    half = Z95 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    low, high = F.greatest(centre - half, F.lit(0.0)) * 100, F.least(centre + half, F.lit(1.0)) * 100
    return tuple(F.when(n == 0, 0.0).otherwise(x) for x in (low, high))


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")


def significance(p: Column, alpha: float = 0.05) -> Column:
    """The words for a p-value."""
    strong = F.when(p < 0.001, "매우 유의함 (p < 0.001)").when(p < 0.01, "유의함 (p < 0.01)").otherwise("유의함 (p < 0.05)")
    return F.when(p < alpha, strong).otherwise("유의하지 않음 (p ≥ 0.05)")


def chi2_two_by_two(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Yates' chi-square of a 2 x 2 table; null if a margin is empty."""
    n = a + b + c + d
    return n * F.pow(F.greatest(F.abs(a * d - b * c) - n / 2, F.lit(0.0)), 2) / F.nullif((a + b) * (c + d) * (a + c) * (b + d), F.lit(0))


def compare_rates(df: DataFrame, hits_a: str, total_a: str, hits_b: str, total_b: str) -> DataFrame:
    """Yates' chi-square of two rates, its p, the stars and the words."""
    a, c = F.col(hits_a).cast("double"), F.col(hits_b).cast("double")
    df = df.withColumn("chi2", chi2_two_by_two(a, F.col(total_a) - a, c, F.col(total_b) - c))
    df = df.withColumn("p", chi2_p("chi2", F.lit(1)))
    return df.withColumns({"stars": stars(F.col("p")), "meaning": significance(F.col("p"))})


def fisher_among(shown: DataFrame, key: str) -> DataFrame:
    """Each shown row's deaths against those of the other shown rows (a short list)."""
    whole = F.broadcast(shown.agg(F.sum("deaths").alias("_k"), F.sum("total").alias("_n")))
    t = shown.crossJoin(whole).select(key, F.col("deaths").alias("a"), (F.col("total") - F.col("deaths")).alias("b"), (F.col("_k") - F.col("deaths")).alias("c"), (F.col("_n") - F.col("total") - F.col("_k") + F.col("deaths")).alias("d"))
    return t.withColumn("p", fisher_p("a", "b", "c", "d")).withColumns({"p": F.round("p", 6), "stars": stars(F.col("p"))})


def step_p(chi2: Column, df: Column) -> Column:
    """A coarse p-value from critical values."""
    # Critical values of one and of two degrees of freedom; of more, multiples of the deviation.
    steps = {
        1: [(10.83, 0.001), (7.88, 0.005), (6.63, 0.01), (3.84, 0.05)],
        2: [(13.82, 0.001), (10.60, 0.005), (9.21, 0.01), (5.99, 0.05)],
    }
    more = [(3.0, 0.001), (2.5, 0.01), (2.0, 0.05)]
    out = F.when(F.lit(False), F.lit(0.0))
    for k, levels in steps.items():
        for bound, p in levels:
            out = out.when((df == k) & (chi2 > bound), p)
    for times, p in more:
        out = out.when((df >= 3) & (chi2 > df + times * F.sqrt(2.0 * df)), p)
    return out.when(df >= 1, 0.5)


def full_analysis(rows: DataFrame, r: str, c: str, least: int = 3, alpha: float = 0.05, chi2: bool = True) -> dict[str, DataFrame]:
    """All tables of an analysis by name: contingency, chi-square of the whole, odds ratios, and these with their false discovery rates."""
    cells = contingency(rows, r, c)
    odds = odds_ratios_corrected(cells).where(F.least("a", "b", "c_", "d") >= least).withColumn("p", chi2_p("chi2_yates", F.lit(1)))
    out = {"contingency": cells, "odds_ratios": odds, "final": false_discovery(odds, alpha=alpha, monotone=False, ties=("r", "c"))}
    return out | ({"chi2_result": chi2_global(cells)} if chi2 else {})
