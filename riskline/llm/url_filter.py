"""URL filter: listed rules first, then logistic regression on hashed character n-grams of host and path.

Everything is DataFrame or SQL expressions and Spark ML estimators; no Python runs on executors.  The model is
trained from a small labelled URL table (``url``, ``label``: 1 = block), its hashed weights are a vector of fixed
length, and scoring is one projection over the scan of the URL column: no shuffle, nothing broadcast that grows.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, and is judged by the
method on its (empty) n-grams; rules that fit are ranked by the length of the whole rule string; repeated rows and
repeated ids are judged one by one; an empty table gives no rows.  A labelled table without rows, or with a single
label, gives a constant model (probability = that label, or 0).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Size of the hashed feature space, n-gram lengths, ridge penalty and most labelled rows used.
FEATURES = 4096
GRAMS = (2, 3, 4)
RIDGE = 0.01
MAX_TRAIN = 20_000


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the contract.
RULES = (
    Rule.parse("allow", "org/"),
    Rule.parse("block", "example.org/es/"),
    Rule.parse("block", "example.org/en/1"),
    Rule.parse("allow", "com/fr/"),
    Rule.parse("block", "com/de/"),
)

#: The small labelled table that the query trains on (invented addresses).
BLOCKED_URLS = """
http://www.spam-farm.example.org/en/1 http://spam-farm.example.com/buy http://link-farm.example.net/exchange/links
http://www.casino-bonus.example.net/slots/jackpot http://free-casino.example.com/win http://online-poker.example.org/bet-now
http://cheap-pills.example.com/buy-viagra http://pharmacy-discount.example.net/order/pills http://replica-watches.example.org/cheap
http://adult-cams.example.com/xxx/live http://xxx-videos.example.net/porn/1 http://hot-dating.example.org/singles/sexy
http://payday-loans.example.net/apply/fast-cash http://get-rich.example.com/crypto/giveaway http://free-money.example.org/claim
http://download-crack.example.net/keygen/serial http://warez.example.org/torrent/crack http://free-iphone.example.com/prize/winner
http://clickbait.example.net/you-wont-believe http://ads.tracker.example.com/click?id=1 http://doorway.example.net/seo/backlinks
http://malware.example.org/update.exe http://phish-login.example.com/verify/account http://lottery-winner.example.net/claim-prize
""".split()
ALLOWED_URLS = """
https://www.library.example.org/catalogue/history https://blog.garden.example.net/en/1204 https://news.example.com/en/politics/2021
https://m.weather.example.net/de/301.html https://university.example.org/courses/physics https://docs.example.com/guide/install
https://recipes.example.net/fr/89 https://museum.example.org/es/collection https://travel.example.com/city/lisbon
https://blog.science.example.org/2020/05/cells https://forum.example.net/thread/774 https://shop.example.com/books/novels
https://sports.example.net/en/match/55 https://health.example.org/advice/sleep https://www.tionth.example.net/en/17190
https://music.example.com/album/9 https://journal.example.org/article/12 https://m.thered.example.net/es/30584.html
https://www.government.example.org/law/acts https://weather.example.com/forecast https://blog.ththor.example.net/fr/2671
https://tionsh.example.net/en/22665/ https://wiki.example.org/page/river https://www.theren.example.net/de/36839
""".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table (``url``, ``label``)."""
    rows = [(u, 1) for u in BLOCKED_URLS] + [(u, 0) for u in ALLOWED_URLS]
    return spark.createDataFrame(rows, "url string, label int")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def grams(text: str, tag: str) -> str:
    """SQL: the n-grams of ``^text$`` of all lengths, marked with the part of the url they come from.

    The text is split into characters once, so the work is linear in its length.
    """
    chars = f"filter(split(concat('^', {text}, '$'), ''), c -> c <> '')"
    parts = ", ".join(
        f"transform(sequence(0, greatest(size(cs) - {n}, 0)), i -> concat('{tag}', array_join(slice(cs, i + 1, {n}), '')))" for n in GRAMS
    )
    return f"flatten(transform(array({chars}), cs -> concat({parts})))"


def with_features(urls: DataFrame) -> DataFrame:
    """Adds host, path and the hashed n-gram counts (``features``); needs the column ``url``."""
    parts = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    listed = parts.withColumn("grams", F.expr(f"concat({grams('host', 'h')}, {grams('path', 'p')})"))
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True).transform(listed).drop("grams")


def train(labelled: DataFrame, ridge: float = RIDGE, max_rows: int = MAX_TRAIN):
    """Fit on at most ``max_rows`` labelled urls, those with the smallest hash; None if no row has a label.

    Rows with a null label are left out; a url that is listed more than once counts once with each of its labels.
    """
    rows = (
        labelled.where("label is not null").select("url", F.col("label").cast("double").alias("label")).distinct()
        .orderBy(F.xxhash64("url"), "url", "label").limit(max_rows)
    )
    if rows.isEmpty():
        return None
    return LogisticRegression(regParam=ridge, elasticNetParam=0.0, maxIter=60).fit(with_features(rows))


def url_filter(urls: DataFrame, labelled: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """Judge the column ``url``: page_id, host, path, rule, verdict, p_block (the model's probability)."""
    model = train(labelled)
    scored = with_features(urls.select("page_id", "url"))
    if model is None:
        scored = scored.withColumn("p_block", F.lit(0.0))
    else:
        scored = model.transform(scored).withColumn("p_block", vector_to_array("probability")[1])
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    by_model = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "p_block")
