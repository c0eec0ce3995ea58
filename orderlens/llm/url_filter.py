"""URL filters (operator 12, native): rules, then a logistic regression on hashed n-grams.

A url splits into host and path. A list of rules (verdict, host, path) is tried first: a rule fits
its host and all subdomains where the path starts with the rule's; the longest fitting rule wins.
All other urls are judged by a logistic regression on the distinct character n-grams of host and
path, each hashed into ``BUCKETS`` of its own and scaled to unit length, the path's to ``PATH_SHARE``
of that. It is fitted by Spark ML on a small labelled url table; its weights, one for each bucket, go
into the plan as constant arrays. Judging is a projection of SQL functions on the scan: no shuffle,
no join, no Python.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and
is judged by the model's intercept alone; an empty host or path is kept as such; letters of hosts
other than A-Z keep their case; every character of a long url counts (time and memory grow in
proportion); of rules of equal length the one with the longer host wins, then block before allow;
repeated rows are judged each; all columns of the input stay, those of the result replace columns
of the same name; an empty table gives an empty result. A labelled table with one class only
gives a constant verdict; null labels and null urls in it are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4_096
SIZES = (3, 4)
#: Length of the path's features against the host's: paths hold many numbers, which tell little.
PATH_SHARE = 0.25
REGULARISATION = 1e-3
#: Log odds above which a url is blocked: an unknown host, near even odds, stays.
BLOCK_ABOVE = 0.25

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The default labelled table is made from these words: hosts to block and hosts to allow.
BLOCK_WORDS = (
    "casino poker jackpot slots roulette bets betting bingo lottery gamble win-big prize pills pharma viagra meds "
    "diet-pills cheap cheap-loans payday replica adult xxx porn sexcam escort dating-hot spam spam-mail ads adserver "
    "ad-track tracker click-track popup banner-ads malware phish warez keygen crack torrent free-win free-money "
    "link-farm click-farm bot-farm"
).split()
ALLOW_WORDS = (
    "news weather library museum school university science history music travel recipes garden city council forum "
    "support help docs wiki journal review archive radio press theatre maps books health sports nature kitchen "
    "photo astronomy chemistry physics railway harbour village mountain river forest teacher student reader writer "
    "letter station earth north south method bridge market street family children animal winter summer morning "
    "evening water bread flower paper window engine church castle island ocean desert planet doctor nurse lawyer "
    "farmer sailor painter singer dancer poet film stage concert gallery orchard meadow cottage"
).split()


def default_labels(spark: SparkSession) -> DataFrame:
    """A small labelled table (url, blocked): every word as a host, alone and joined to another of its class."""
    forms = ["https://www.{w}.example.com/en/{n}", "http://{w}.example.net/de/{n}.html", "https://m.{w}.example.org/fr/{n}/", "http://blog.{w}.example.com/es/{n}?page=2"]
    rows = []
    for words, blocked in ((BLOCK_WORDS, 1), (ALLOW_WORDS, 0)):
        for k, w in enumerate(words):
            for step, form in enumerate(forms):
                # All forms and numbers serve both classes alike, so only the words tell them apart.
                name = w if step < 2 else f"{w}-{words[(k + 7 * step) % len(words)]}"
                rows.append((form.format(w=name, n=(37 * k + 211 * step) % 1000), blocked))
    return spark.createDataFrame(rows, "url string, blocked int")


def with_parts(table: DataFrame, url: str = "url") -> DataFrame:
    """The table with ``host`` and ``path``."""
    text = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    return table.withColumns({
        "host": F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    })


def bind(value: Column, fn) -> Column:
    """fn(value) with the value computed once, not wherever fn mentions it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def buckets(text: Column) -> Column:
    """Distinct buckets of the n-grams of a text, start and end marked; none of an empty text."""

    def gram(chars: Column, size: int) -> Column:
        starts = F.slice(chars, F.lit(1), F.greatest(F.size(chars) - size + 1, F.lit(0)))
        return F.transform(starts, lambda c, i: F.pmod(F.xxhash64(F.lit(size), c, *[F.get(chars, i + k) for k in range(1, size)]), F.lit(BUCKETS)).cast("int"))

    marked = F.split(F.concat(F.lit("\x02"), text, F.lit("\x03")), "")
    found = bind(marked, lambda chars: F.array_distinct(F.concat(*[gram(chars, size) for size in SIZES])))
    return F.when(text == "", F.array().cast("array<int>")).otherwise(found)


@dataclass(frozen=True)
class UrlModel:
    """Weights of the host's and of the path's buckets, and the intercept; scores over ``BLOCK_ABOVE`` are blocked."""

    host: tuple[float, ...]
    path: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        """The log odds of blocking, from the columns host and path."""

        def part(text: Column, values: tuple[float, ...]) -> Column:
            # One foldable expression, which the optimiser turns into one constant array.
            weights = F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")
            total = lambda b: F.aggregate(b, F.lit(0.0), lambda s, x: s + F.get(weights, x))
            return bind(buckets(text), lambda b: total(b) / F.sqrt(F.greatest(F.size(b), F.lit(1)).cast("double")))

        return F.lit(self.intercept) + part(F.col("host"), self.host) + part(F.col("path"), self.path) * PATH_SHARE


def train(labelled: DataFrame, regularisation: float = REGULARISATION) -> UrlModel:
    """Fit on a labelled table (url, blocked 0/1), which is meant to be small: hundreds to some ten thousand rows."""
    use = with_parts(labelled.where("url is not null and blocked is not null").select("url", F.col("blocked").cast("double").alias("blocked")))
    terms = [buckets(F.col(c)).cast("array<string>").alias(f"{c}_terms") for c in ("host", "path")]
    use = use.select("blocked", *terms).coalesce(1).cache()
    rows = {r["blocked"]: r["n"] for r in use.groupBy("blocked").agg(F.count("*").alias("n")).collect()}
    if len(rows) < 2:
        use.unpersist()
        return UrlModel((0.0,) * BUCKETS, (0.0,) * BUCKETS, 1.0 if 1.0 in rows else -1.0)
    # Both classes weigh the same, so the odds don't depend on the table's mix.
    use = use.withColumn("weight", F.when(F.col("blocked") == 1, F.lit(0.5 / rows[1.0])).otherwise(F.lit(0.5 / rows[0.0])))
    stages = []
    for c in ("host", "path"):
        counts = CountVectorizerModel.from_vocabulary([str(b) for b in range(BUCKETS)], f"{c}_terms", f"{c}_counts")
        stages += [counts.setBinary(True), Normalizer(inputCol=f"{c}_counts", outputCol=f"{c}_unit", p=2.0)]
    stages.append(ElementwiseProduct(scalingVec=Vectors.dense([PATH_SHARE] * BUCKETS), inputCol="path_unit", outputCol="path_part"))
    stages.append(VectorAssembler(inputCols=["host_unit", "path_part"], outputCol="features"))
    stages.append(LogisticRegression(labelCol="blocked", weightCol="weight", regParam=regularisation, standardization=False, maxIter=50))
    model = Pipeline(stages=stages).fit(use).stages[-1]
    use.unpersist()
    weights = [float(w) for w in model.coefficients.toArray()]
    return UrlModel(tuple(weights[:BUCKETS]), tuple(weights[BUCKETS:]), float(model.intercept))


def judge(table: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str, str]] = (), url: str = "url") -> DataFrame:
    """The table with host, path, rule, verdict and score (log odds of blocking, of the model alone)."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    host, path = F.col("host"), F.col("path")
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in ranked]
    named = lambda values: F.coalesce(F.lit(None).cast("string"), *[F.when(f, F.lit(v)) for f, v in zip(fits, values, strict=True)])
    return (
        with_parts(table, url)
        .withColumn("score", model.score())
        .withColumn("rule", named([h + p for _, h, p in ranked]))
        .withColumn("verdict", F.coalesce(named([v for v, _, _ in ranked]), F.when(F.col("score") > BLOCK_ABOVE, F.lit("block")).otherwise(F.lit("allow"))))
    )
