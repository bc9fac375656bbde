"""URL filters: rules first, then the ratio of two character language models.

Rules name a host and a path; the longest one that fits decides. URLs that rules allow or block are also the
labelled examples from which two smoothed variable-order Markov models are counted, one for accepted URLs and
one for rejected ones. For every character the model mixes all context lengths up to ``ORDER`` by Witten-Bell
weights: p_j = (c_j + T_j p_(j-1)) / (N_j + T_j), where c_j is the count of the character behind the last j
characters, N_j the count of that context and T_j the number of different characters seen behind it; below
order 0 lies 1/ALPHABET. A URL's score is the mean log ratio per character (its end counts as one).
One labelled URL in CALIBRATE_FOLD, chosen by its hash, is left out of the counts; the mean and pooled variance
of the scores of those give the logistic map from score to the probability that a URL is acceptable.

Defined results: a null URL is scored as an empty one; host and path of a URL without ``://`` are empty; repeated
rows each get their verdict; without accepted and rejected examples to compare, scores are 0 and the verdict is
allow; an empty table gives no rows; other columns are ignored.

Only DataFrame functions are used. Counts cover every labelled URL but those left out for calibration. Distinct URLs are cut into windows of
ORDER + 1 characters; windows are pre-aggregated before they are shuffled, so a common host costs one row for
each task. For the join of windows with their scores, each window's score is dealt to SALTS partitions, as
``http`` opens every URL. Nothing is broadcast; two models' tables may have any size.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import durable

ORDER = 4
ALPHABET = 256.0
SALTS = 8
CALIBRATE_FOLD = 5
PIECE = 256
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
_START, _END = "\u0002", "\u0003"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; both null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # longer ones are tried first
        at, _, below = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + below)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def windows_of(urls: DataFrame, url: str, *keep: str) -> DataFrame:
    """A row for each character of each URL and its end: the character behind the ORDER characters before it.

    Long URLs are cut into overlapping pieces first, so that the work stays about linear in their length.
    """
    padded = F.concat(F.lit(_START * ORDER), F.col(url), F.lit(_END))
    starts = F.sequence(F.lit(0), F.floor((F.length(padded) - ORDER - 1) / PIECE).cast("int"))
    pieces = urls.select(*keep, F.explode(F.transform(starts, lambda i: F.substring(padded, i * PIECE + 1, F.lit(PIECE + ORDER)))).alias("piece"))
    places = F.sequence(F.lit(1), F.length("piece") - ORDER)
    return pieces.select(*keep, F.explode(F.transform(places, lambda i: F.substring(F.col("piece"), i, F.lit(ORDER + 1)))).alias("window"))


def window_scores(counts: DataFrame) -> DataFrame:
    """(window, llr) from (window, accepted, rejected): log ratio of the two models for the window's last character."""
    levels = counts.select(
        "window",
        "accepted",
        "rejected",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(ORDER)), lambda j: F.substring(F.col("window"), F.lit(ORDER + 1) - j, j + 1))).alias("level", "gram"),
    )
    grams = levels.groupBy("level", "gram").agg(F.sum("accepted").alias("ca"), F.sum("rejected").alias("cr"))
    grams = grams.withColumn("context", F.substring("gram", F.lit(1), F.col("level")))
    contexts = grams.groupBy("level", "context").agg(
        F.sum("ca").alias("na"), F.sum("cr").alias("nr"), F.count_if(F.col("ca") > 0).alias("ta"), F.count_if(F.col("cr") > 0).alias("tr")
    )

    def share(c: str, n: str, t: str) -> tuple[Column, Column]:
        total = (F.col(n) + F.col(t)).cast("double")
        seen = F.col(n) > 0
        return F.when(seen, F.col(c) / total).otherwise(F.lit(0.0)), F.when(seen, F.col(t) / total).otherwise(F.lit(1.0))

    (own_a, back_a), (own_r, back_r) = share("ca", "na", "ta"), share("cr", "nr", "tr")
    mixed = grams.join(contexts, ["level", "context"]).select(
        "level", "gram", own_a.alias("own_a"), back_a.alias("back_a"), own_r.alias("own_r"), back_r.alias("back_r")
    )
    steps = levels.select("window", "level", "gram").join(mixed, ["level", "gram"]).groupBy("window").agg(
        F.array_sort(F.collect_list(F.struct("level", "own_a", "back_a", "own_r", "back_r"))).alias("steps")
    )

    def chance(own: str, back: str) -> Column:
        return F.aggregate("steps", F.lit(1.0 / ALPHABET), lambda p, s: s[own] + s[back] * p)

    return steps.select("window", (F.log(chance("own_a", "back_a")) - F.log(chance("own_r", "back_r"))).alias("llr"))


def score_urls(urls: DataFrame) -> DataFrame:
    """(url, score) for the distinct URLs of (url, label); label is allow, block or null."""
    keyed = urls.select(
        "url",
        F.xxhash64("url").alias("k1"),
        F.xxhash64(F.lit(1), "url").alias("k2"),
        (F.pmod(F.xxhash64("url"), F.lit(CALIBRATE_FOLD)) != 0).alias("counted"),
        "label",
    )
    cut = windows_of(keyed, "url", "k1", "k2", "counted", "label")
    counts = cut.groupBy("window").agg(
        F.count_if(F.col("counted") & (F.col("label") == "allow")).alias("accepted"),
        F.count_if(F.col("counted") & (F.col("label") == "block")).alias("rejected"),
    )
    scores = window_scores(counts).select("window", "llr", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    sums = (
        cut.select("k1", "k2", "window", F.pmod("k2", F.lit(SALTS)).cast("int").alias("salt"))
        .join(scores, ["window", "salt"])
        .groupBy("k1", "k2")
        .agg(F.avg("llr").alias("score"))
    )
    return keyed.select("url", "k1", "k2", "label", "counted").join(sums, ["k1", "k2"])


def calibration(scored: DataFrame) -> tuple[float, float]:
    """Slope and offset of the logistic map, from the labelled URLs that were left out of the counts."""
    held = scored.filter(~F.col("counted") & F.col("label").isNotNull())
    row = held.agg(
        *[f(F.when(F.col("label") == says, F.col("score"))).alias(f"{name}_{says}") for says in ("allow", "block") for name, f in (("mean", F.avg), ("var", F.var_pop), ("n", F.count))]
    ).first()
    if not row["n_allow"] or not row["n_block"]:
        return 1.0, 0.0
    n, m = row["n_allow"], row["n_block"]
    pooled = max((n * row["var_allow"] + m * row["var_block"]) / (n + m), 1e-6)
    slope = (row["mean_allow"] - row["mean_block"]) / pooled
    return slope, -slope * (row["mean_allow"] + row["mean_block"]) / 2


def judge(pages: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict, score and probability of being acceptable."""
    given = pages.withColumn("_url", F.coalesce(F.col(url), F.lit("")))
    host, path = host_of(F.col("_url")), path_of(F.col("_url"))
    rule, says = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = given.withColumn("host", host).withColumn("path", path).withColumn("rule", rule).withColumn("_says", says)
    distinct = ruled.groupBy(F.col("_url").alias("url")).agg(F.max("_says").alias("label"))
    scored = durable(score_urls(distinct))
    slope, offset = calibration(scored)
    scores = scored.select(F.col("url").alias("_url"), "score")
    probability = 1 / (1 + F.exp(-F.greatest(F.least(F.lit(slope) * F.col("score") + F.lit(offset), F.lit(500.0)), F.lit(-500.0))))
    out = ruled.join(scores, "_url").withColumn("probability", probability)
    method = F.when(F.col("probability") >= 0.5, "allow").otherwise("block")
    return out.withColumn("verdict", F.coalesce(F.col("_says"), method)).drop("_url", "_says")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "score", "probability")
