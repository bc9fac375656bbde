"""Significance tests: statistics as plans, p values over a handful of rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import semantics as S
from tidemark.functions import stats
from tidemark.functions.taxonomy import group_sql, hierarchy
from tidemark.operators import keys as K
from tidemark.operators import moments as M
from tidemark.operators.positions import positions
from tidemark.plans.analyses import POSITIONS, _joined
from tidemark.session import durable
from tidemark.registry import query

MIN_ROWS = 100
MAX_WEIGHT = 100
SIZE_BINS = 20
PRICE_BINS = 10


def price_bins(rows: DataFrame, value: str, bins: int, into: str) -> DataFrame:
    """Equal-width bins 1..bins of a column, closed on the right; the least value falls into the first."""
    ends = rows.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.lit(1).alias("_one"))
    width = (F.col("_hi") - F.col("_lo")) / float(bins)
    at = F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((F.col(value) - F.col("_lo")) / F.nullif(width, F.lit(0.0)))))
    joined = rows.withColumn("_one", F.lit(1)).join(F.broadcast(ends), "_one")  # one row
    return joined.withColumn(into, F.coalesce(at, F.lit(1)).cast("int")).drop("_one", "_lo", "_hi")


def mann_whitney(sizes: DataFrame, by: str = "price_bin") -> DataFrame:
    """(by, n1, n2, u, effect_r, z) of makers' against takers' sizes, from counts of distinct sizes.

    u counts for makers; z is the normal approximation with ties and a continuity correction of one half.
    """
    counts = sizes.groupBy(by, "value").agg(F.count_if(F.col("role") == "maker").alias("k1"), F.count("*").alias("_all"))
    ranks = K.average_ranks(sizes, "value", by)
    joined = counts.join(ranks, [by, "value"])
    sums = joined.groupBy(by).agg(
        F.sum("k1").cast("double").alias("n1"), (F.sum("_all") - F.sum("k1")).cast("double").alias("n2"), F.sum(F.col("k1") * F.col("rank")).alias("r1"), F.sum(F.pow(F.col("n").cast("double"), 3.0) - F.col("n")).alias("ties")
    )
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    u = F.col("r1") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    return sums.filter((n1 > 0) & (n2 > 0)).select(by, "n1", "n2", u.alias("u"), (1 - 2 * u / (n1 * n2)).alias("effect_r"), ((u - n1 * n2 / 2 - 0.5) / F.nullif(sd, F.lit(0.0))).alias("z"))


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _joined(spark, sf_dir).select(S.taker_price().alias("price"), S.maker_price().alias("other"), "count")
    binned = price_bins(joined, "price", PRICE_BINS, "price_bin")
    sides = F.array(
        F.struct(F.lit("taker").alias("role"), (F.col("count") * F.col("price")).alias("value")), F.struct(F.lit("maker").alias("role"), (F.col("count") * F.col("other")).alias("value"))
    )
    return binned.select("price_bin", F.inline(sides))


@query(
    "st4_mann_whitney",
    POSITIONS
    + f""", b AS (SELECT CASE WHEN taker_side = 'yes' THEN yes_price ELSE no_price END AS p, CASE WHEN taker_side = 'yes' THEN no_price ELSE yes_price END AS q, count AS c FROM joined),
e AS (SELECT min(p) AS lo, (max(p) - min(p)) / 10.0 AS w FROM b), s AS (SELECT CAST(greatest(1, least(10, ceil((p - lo) / w))) AS INT) AS price_bin, p * c AS t, q * c AS m FROM b, e),
v AS (SELECT price_bin, 'taker' AS role, t AS value FROM s UNION ALL SELECT price_bin, 'maker', m FROM s),
r AS (SELECT *, rank() OVER (PARTITION BY price_bin ORDER BY value) + (count(*) OVER (PARTITION BY price_bin, value) - 1) / 2.0 AS rk FROM v),
u AS (SELECT price_bin, CAST(count(*) FILTER (WHERE role = 'maker') AS DOUBLE) AS n1, CAST(count(*) FILTER (WHERE role = 'taker') AS DOUBLE) AS n2, sum(rk) FILTER (WHERE role = 'maker') AS r1 FROM r GROUP BY 1)
SELECT price_bin, CAST(n2 AS BIGINT) AS n_trades, round(CAST(r1 - n1 * (n1 + 1) / 2 AS DOUBLE), 2) AS u_statistic, round(CAST(1 - 2 * (r1 - n1 * (n1 + 1) / 2) / (n1 * n2) AS DOUBLE), 6) AS effect_size_r FROM u WHERE n2 >= {MIN_ROWS}""",
)
def st4_mann_whitney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Makers' against takers' sizes in ten price bins."""
    rows = mann_whitney(_sizes(spark, sf_dir)).filter(F.col("n2") >= MIN_ROWS)
    return rows.select("price_bin", F.col("n2").cast("long").alias("n_trades"), F.round("u", 2).alias("u_statistic"), F.round("effect_r", 6).alias("effect_size_r"))


def side_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(price, y, n) sums of takers' yes and no purchases, and the pooled two-proportion z weighted by contracts."""
    rows = _joined(spark, sf_dir).filter(F.col("taker_side").isin("yes", "no"))
    rows = rows.select(F.col("taker_side").alias("side"), S.taker_price().alias("price"), S.taker_won().alias("won"), F.col("count").alias("c"))
    sums = rows.groupBy("price").agg(*[f(F.when(F.col("side") == s, x)).alias(s[0] + k) for s in ("yes", "no") for k, f, x in (("rows", F.count, F.lit(1)), ("n", F.sum, F.col("c")), ("w", F.sum, F.col("c") * F.col("won")))])
    sums = sums.filter((F.col("yrows") >= MIN_ROWS) & (F.col("nrows") >= MIN_ROWS))
    y, n = M.ratio("yw", "yn"), M.ratio("nw", "nn")
    pooled = M.ratio(F.col("yw") + F.col("nw"), F.col("yn") + F.col("nn"))
    se = F.sqrt(pooled * (1 - pooled) * (1 / F.nullif(F.col("yn").cast("double"), F.lit(0.0)) + 1 / F.nullif(F.col("nn").cast("double"), F.lit(0.0))))
    z = F.when(se > 0, (n - y) / se).otherwise(0.0)
    return sums.select("price", y.alias("yes_win_rate"), n.alias("no_win_rate"), z.alias("z"), F.col("yn").alias("yes_n"), F.col("nn").alias("no_n"))


@query(
    "st3_two_proportions",
    POSITIONS
    + f""", s AS (SELECT CASE WHEN taker_side = 'yes' THEN yes_price ELSE no_price END AS price, taker_side, CASE WHEN taker_side = result THEN count ELSE 0 END AS w, count AS c FROM joined),
g AS (SELECT price, CAST(sum(w) FILTER (WHERE taker_side = 'yes') AS DOUBLE) AS yw, CAST(sum(c) FILTER (WHERE taker_side = 'yes') AS DOUBLE) AS yn, CAST(sum(w) FILTER (WHERE taker_side = 'no') AS DOUBLE) AS nw, CAST(sum(c) FILTER (WHERE taker_side = 'no') AS DOUBLE) AS nn
 FROM s GROUP BY price HAVING count(*) FILTER (WHERE taker_side = 'yes') >= {MIN_ROWS} AND count(*) FILTER (WHERE taker_side = 'no') >= {MIN_ROWS})
SELECT price, round(yw / yn, 6) AS yes_win_rate, round(nw / nn, 6) AS no_win_rate, round((nw / nn - yw / yn) / sqrt((yw + nw) / (yn + nn) * (1 - (yw + nw) / (yn + nn)) * (1 / yn + 1 / nn)), 6) AS z_statistic, CAST(yn AS BIGINT) AS yes_n, CAST(nn AS BIGINT) AS no_n FROM g""",
)
def st3_two_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Win rates of yes and no at one price."""
    r = lambda c: F.round(c, 6)
    return side_proportions(spark, sf_dir).select("price", r("yes_win_rate").alias("yes_win_rate"), r("no_win_rate").alias("no_win_rate"), r("z").alias("z_statistic"), "yes_n", "no_n")


def group_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(group, n, mean, var) of makers' less takers' excess, which is twice takers' with its sign changed plus the price gap."""
    rows = _joined(spark, sf_dir, True, "event_ticker").select(S.category().alias("category"), S.taker_price().alias("price"), S.taker_won().alias("won"), F.col("count").alias("contracts"))
    sums = rows.groupBy("category").agg(*M.excess_sums()).withColumn("group", hierarchy(F.col("category"))["group"])
    return sums.groupBy("group").agg(F.sum("n").alias("n"), F.sum("sx").alias("sx"), F.sum("sxx").alias("sxx")).select("group", "n", M.mean_excess().alias("mean"), M.var_samp().alias("var"))


@query(
    "st6_welch",
    POSITIONS
    + f""", g AS (SELECT {group_sql('category')} AS g, avg(won - price / 100.0) AS m, var_samp(won - price / 100.0) AS v, count(*) AS n FROM pos WHERE role = 'taker' GROUP BY 1 HAVING count(*) >= {MIN_ROWS})
SELECT o.g AS "group", round((f.m - o.m) / sqrt(f.v / f.n + o.v / o.n), 6) AS t_statistic, round((f.v / f.n + o.v / o.n) ** 2 / ((f.v / f.n) ** 2 / (f.n - 1) + (o.v / o.n) ** 2 / (o.n - 1)), 4) AS df FROM g f, g o WHERE f.g = 'Finance' AND o.g <> 'Finance'""",
)
def st6_welch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Welch's t of Finance against every other group with enough trades (a handful of rows)."""
    groups = group_gaps(spark, sf_dir).filter(F.col("n") >= MIN_ROWS)
    base = groups.filter("`group` = 'Finance'").select(F.lit(1).alias("one"), F.col("n").alias("fn"), F.col("mean").alias("fm"), F.col("var").alias("fv"))
    both = groups.filter("`group` <> 'Finance'").withColumn("one", F.lit(1)).join(base, "one")
    a, b = F.col("fv") / F.col("fn"), F.col("var") / F.col("n")
    df = F.pow(a + b, 2.0) / (F.pow(a, 2.0) / (F.col("fn") - 1) + F.pow(b, 2.0) / (F.col("n") - 1))
    return both.select("group", F.round((F.col("fm") - F.col("mean")) / F.sqrt(a + b), 6).alias("t_statistic"), F.round(df, 4).alias("df"))


def _log_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(x, y): log10 of takers' size in dollars (a cent at least), excess."""
    cents = F.col("count") * S.taker_price()
    x = F.log10(F.greatest(cents.cast("double") / 100.0, F.lit(0.01)))
    y = (S.taker_won() * 100 - S.taker_price()).cast("double") / 100.0
    return _joined(spark, sf_dir).select(x.alias("x"), y.alias("y"))


_XY = POSITIONS + ", xy AS (SELECT log10(greatest(CAST(contracts * price AS DOUBLE) / 100.0, 0.01)) AS x, CAST(won - price / 100.0 AS DOUBLE) AS y FROM pos WHERE role = 'taker')"


@query("st8_pearson", _XY + " SELECT round(corr(x, y), 6) AS pearson_r, count(*) AS n FROM xy")
def st8_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of log size and excess, over all trades."""
    return _log_sizes(spark, sf_dir).agg(F.round(F.corr("x", "y"), 6).alias("pearson_r"), F.count("*").alias("n"))


@query("st9_spearman", _XY + ", r AS (SELECT rank() OVER (ORDER BY round(x, 9)) + (count(*) OVER (PARTITION BY round(x, 9)) - 1) / 2.0 AS rx, rank() OVER (ORDER BY round(y, 9)) + (count(*) OVER (PARTITION BY round(y, 9)) - 1) / 2.0 AS ry FROM xy) SELECT round(corr(rx, ry), 6) AS spearman_rho, count(*) AS n FROM r")
def st9_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank correlation; ranks come from counts of distinct values, so no window runs over all trades."""
    counted = _log_sizes(spark, sf_dir).groupBy(F.round("x", 9).alias("x"), F.round("y", 9).alias("y")).agg(F.count("*").alias("k"))
    for c in "xy":
        sums = counted.groupBy(c).agg(F.sum("k").alias("n"))
        ranks = _ranks(sums, c)
        counted = counted.join(ranks, c)
    k, a, b = F.col("k"), F.col("rank_x"), F.col("rank_y")
    s = counted.agg(F.sum(k).alias("n"), F.sum(k * a).alias("sa"), F.sum(k * b).alias("sb"), F.sum(k * a * a).alias("saa"), F.sum(k * b * b).alias("sbb"), F.sum(k * a * b).alias("sab"))
    n = F.col("n").cast("double")
    rho = (n * F.col("sab") - F.col("sa") * F.col("sb")) / F.sqrt((n * F.col("saa") - F.col("sa") * F.col("sa")) * (n * F.col("sbb") - F.col("sb") * F.col("sb")))
    return s.select(F.round(rho, 6).alias("spearman_rho"), "n")


def _ranks(sums: DataFrame, c: str) -> DataFrame:
    """Average ranks of distinct values with counts: ranges of values are ranked side by side and shifted by what lies before them."""
    from pyspark.sql import Window

    dealt = durable(sums.select(c, "n").repartitionByRange(c).withColumn("_range", F.spark_partition_id()))
    totals = dealt.groupBy("_range").agg(F.sum("n").alias("_n"))
    offsets = totals.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))  # one row a range
    before = F.coalesce(F.sum("n").over(Window.partitionBy("_range").orderBy(c).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = dealt.withColumn("_before", before).join(offsets, "_range")
    return ranked.select(c, (F.col("_offset") + F.col("_before") + (F.col("n") + 1) / 2.0).cast("double").alias(f"rank_{c}"))


@query(
    "st10_binned_regression",
    _XY
    + f""", e AS (SELECT min(x) AS lo, (max(x) - min(x)) / {SIZE_BINS}.0::DOUBLE AS w FROM xy), b AS (SELECT CAST(greatest(1, least({SIZE_BINS}, ceil((x - lo) / w))) AS INT) AS b, x, y FROM xy, e),
m AS (SELECT b, avg(x) AS x, avg(y) AS y, CAST(count(*) AS DOUBLE) AS n FROM b GROUP BY b), s AS (SELECT (sum(n) * sum(n * x * y) - sum(n * x) * sum(n * y)) / (sum(n) * sum(n * x * x) - sum(n * x) ** 2) AS k, sum(n * x) / sum(n) AS mx, sum(n * y) / sum(n) AS my, sum(sqrt(n) * y) / sum(sqrt(n)) AS wy FROM m)
SELECT round(any_value(k), 6) AS slope, round(any_value(my - k * mx), 6) AS intercept, round(1 - sum(sqrt(n) * (y - (my - k * mx) - k * x) ** 2) / sum(sqrt(n) * (y - wy) ** 2), 5) AS r_squared FROM m, s""",
)
def st10_binned_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted line through the means of twenty size bins: weights n for the line, root n for R squared."""
    binned = price_bins(_log_sizes(spark, sf_dir), "x", SIZE_BINS, "b")
    means = binned.groupBy("b").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count("*").cast("double").alias("n"))
    rows = means.agg(F.collect_list(F.struct("x", "y", "n")).alias("rows"))  # twenty at most
    total = lambda f: F.aggregate("rows", F.lit(0.0), lambda acc, r: acc + f(r))
    n, nx, ny = total(lambda r: r["n"]), total(lambda r: r["n"] * r["x"]), total(lambda r: r["n"] * r["y"])
    nxx, nxy = total(lambda r: r["n"] * r["x"] * r["x"]), total(lambda r: r["n"] * r["x"] * r["y"])
    line = rows.select("rows", ((n * nxy - nx * ny) / (n * nxx - nx * nx)).alias("k"), n.alias("n"), nx.alias("nx"), ny.alias("ny"))
    line = line.select("rows", "k", ((F.col("ny") - F.col("k") * F.col("nx")) / F.col("n")).alias("c"))
    w = total(lambda r: F.sqrt(r["n"]))
    line = line.withColumn("wy", total(lambda r: F.sqrt(r["n"]) * r["y"]) / w)
    rest = total(lambda r: F.sqrt(r["n"]) * F.pow(r["y"] - F.col("c") - F.col("k") * r["x"], 2.0))
    spread = total(lambda r: F.sqrt(r["n"]) * F.pow(r["y"] - F.col("wy"), 2.0))
    return line.select(F.round("k", 6).alias("slope"), F.round("c", 6).alias("intercept"), F.round(1 - rest / spread, 5).alias("r_squared"))


def weighted_welch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: Welch's t of makers against takers, each trade counting as often as its contracts, up to MAX_WEIGHT.

    Weighted sums take the place of repeated rows, so nothing is sampled at any size.
    """
    w = F.least(F.col("contracts"), F.lit(MAX_WEIGHT))
    x = F.col("won") * 100 - F.col("price")
    rows = positions(_joined(spark, sf_dir)).groupBy("role").agg(F.sum(w).alias("n"), F.sum(w * x).alias("sx"), F.sum(w * x * x).alias("sxx"))
    sides = rows.select("role", "n", M.mean_excess().alias("m"), M.var_samp().alias("v"))
    wide = sides.groupBy().agg(*[F.max(F.when(F.col("role") == r, F.col(c))).alias(f"{r[0]}{c}") for r in ("maker", "taker") for c in "nmv"])
    a, b = F.col("mv") / F.col("mn"), F.col("tv") / F.col("tn")
    df = F.pow(a + b, 2.0) / (F.pow(a, 2.0) / (F.col("mn") - 1) + F.pow(b, 2.0) / (F.col("tn") - 1))
    pooled = F.sqrt(((F.col("mn") - 1) * F.col("mv") + (F.col("tn") - 1) * F.col("tv")) / (F.col("mn") + F.col("tn") - 2))
    effect = F.when(pooled > 0, (F.col("mm") - F.col("tm")) / pooled).otherwise(0.0)
    return wide.select(((F.col("mm") - F.col("tm")) / F.sqrt(a + b)).alias("t"), df.alias("df"), effect.alias("cohens_d"), F.col("mm").alias("maker_mean"), F.col("tm").alias("taker_mean"))


@query(
    "st11_weighted_welch",
    POSITIONS
    + f""", s AS (SELECT role, least(contracts, {MAX_WEIGHT}) AS w, CAST(won * 100 - price AS HUGEINT) AS x FROM pos), g AS (SELECT role, CAST(sum(w) AS DOUBLE) AS n, CAST(sum(w * x) AS DOUBLE) AS a, CAST(sum(w * x * x) AS DOUBLE) AS b FROM s GROUP BY role),
h AS (SELECT role, n, a / n / 100 AS m, (n * b - a * a) / (n * (n - 1)) / 1e4 AS v FROM g)
SELECT round((m.m - t.m) / sqrt(m.v / m.n + t.v / t.n), 6) AS t_statistic, round((m.m - t.m) / sqrt(((m.n - 1) * m.v + (t.n - 1) * t.v) / (m.n + t.n - 2)), 6) AS cohens_d, round(m.m, 9) AS maker_mean, round(t.m, 9) AS taker_mean FROM h m, h t WHERE m.role = 'maker' AND t.role = 'taker'""",
)
def st11_weighted_welch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Makers against takers by contracts, with Cohen's d."""
    return weighted_welch(spark, sf_dir).select(F.round("t", 6).alias("t_statistic"), F.round("cohens_d", 6).alias("cohens_d"), F.round("maker_mean", 9).alias("maker_mean"), F.round("taker_mean", 9).alias("taker_mean"))


@query("a17_statistical_tests")
def a17_statistical_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(test, metric, value) of all tests with their p values; the rows the driver sees are at most a hundred."""
    out: list[tuple[str, str, float | None]] = []
    for r in mann_whitney(_sizes(spark, sf_dir)).filter(F.col("n2") >= MIN_ROWS).orderBy("price_bin").collect():
        name = f"{(r['price_bin'] - 1) * 10 + 1}-{r['price_bin'] * 10}c"
        out += [("trade_size_by_role", f"{name} u", r["u"]), ("trade_size_by_role", f"{name} p", stats.normal_greater(r["z"])), ("trade_size_by_role", f"{name} r", r["effect_r"])]
    for r in side_proportions(spark, sf_dir).orderBy("price").collect():
        out += [("yes_no_asymmetry", f"{r['price']}c z", r["z"]), ("yes_no_asymmetry", f"{r['price']}c p", stats.normal_two_sided(r["z"]))]
    for r in st6_welch(spark, sf_dir).orderBy("group").collect():
        out += [("category_gaps", f"{r['group']} t", r["t_statistic"]), ("category_gaps", f"{r['group']} p", stats.student_two_sided(r["t_statistic"], r["df"]))]
    r, rho, line = st8_pearson(spark, sf_dir).first(), st9_spearman(spark, sf_dir).first(), st10_binned_regression(spark, sf_dir).first()
    for name, value, n in (("pearson_r", r["pearson_r"], r["n"]), ("spearman_rho", rho["spearman_rho"], rho["n"])):
        t = None if value is None or n < 3 or abs(value) >= 1 else value * math.sqrt((n - 2) / (1 - value * value))
        out += [("size_and_return", name, value), ("size_and_return", f"{name} p", stats.student_two_sided(t, n - 2))]
    out += [("size_and_return", k, line[k]) for k in ("slope", "intercept", "r_squared")]
    w = weighted_welch(spark, sf_dir).first()
    out += [("maker_vs_taker", "t", w["t"]), ("maker_vs_taker", "p", stats.student_two_sided(w["t"], w["df"])), ("maker_vs_taker", "cohens_d", w["cohens_d"])]
    return spark.createDataFrame(out, "test string, metric string, value double")
