"""URL verdicts by rules, and where no rule fits by a logistic regression on character n-grams.

The n-grams of host and path are hashed; the weights come from a small table of
labelled URLs. Everything is column expressions and Spark's own ML transformers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lengths of the n-grams, and cells that they are hashed to.
SIZES, CELLS = (4, 5), 1 << 17

#: Probability from which a URL is blocked.
BLOCK_FROM = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """verdict for a host with its subdomains, for paths that start with path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Words of names of ordinary sites. The last lines share letters with words that are to be blocked.
ALLOWED = (
    "news daily times herald gazette journal review press weather climate garden flowers recipes cooking bakery kitchen restaurant "
    "coffee travel hotels islands mountain hiking cycling running football tennis swimming climbing museum gallery painting theatre "
    "opera orchestra music guitar piano poetry novels books library bookstore school college university academy science physics "
    "chemistry biology algebra geometry history archive astronomy space medicine clinic hospital dentist health nursing pharmacology "
    "engineering robotics python javascript compiler database server network cloud kernel software hardware mobile camera photo film "
    "cinema radio podcast market shop store fashion shoes jewelry furniture design architecture building cement timber farm "
    "harvest cattle poultry fishing forest river harbour railway airport bicycle motor electric solar energy water bank credit "
    "insurance tax accounting lawyer court parliament council village city region embassy charity church temple family children "
    "toys games puzzle chess knitting pottery antiques stamps language dictionary grammar translation teacher student exam jobs career "
    "alphabet betty tibet between cashmere firecracker nutcracker pillow caterpillar spillway slotcar timeslot balloons loanword saloon "
    "essex sussex sextant campus webcomic scamper trackfield tracks soundtrack packages downloads roads beads leads adsorption headset "
    "advent adulthood spamassassin clicker clique replication pokemon spokes casimir medieval linker bingley virtue winter window prizes"
).split()

# Words of names that a filter is to block.
BLOCKED = (
    "casino poker roulette blackjack jackpot slots betting bets wager gamble gambling lottery bingo sportsbook porn porno pornhub xxx sex "
    "sexcam nude nudes adult cams webcam hookup escort escorts hentai milf erotic viagra cialis levitra pills meds tramadol xanax steroids "
    "weightloss payday loans cashadvance replica replicas counterfeit warez crack cracked keygen torrents serials nulled malware "
    "phishing trojan exploit botnet ransomware spam spammer spamming linkfarm backlinks ads adserver adtrack adclick popunder popads clickbait clickads "
    "tracker tracking prize winner giveaway"
).split()

# What stands around a word in a name, and around a name in a URL, alike for both kinds.
NAMES = ("{}", "best-{}", "{}-online", "my{}", "{}-world", "the-{}-club", "{}24", "{}-guide", "{}-zone", "new{}")
AROUND = ("https://www.{}.com/", "http://{}.org/about.html", "https://shop.{}.co.uk/list/2020/5", "http://{}.info/en/index", "https://host.org/~{}/page")

#: Names made of every allowed word, and of every blocked one. There are more allowed ones, so an unknown name counts as one.
ALLOWED_NAMES, BLOCKED_NAMES = 8, 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty without a url or ``://`` in it; A to Z of the host in lower case."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct, or null. The rules are few, so they are an expression."""
    fitting = []
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        fitting.append(F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))))
    nothing = F.lit(None).cast("struct<name:string,verdict:string>")
    return F.coalesce(*fitting, nothing)


def _grams(prefix: str, text: Column) -> Column:
    """All n-grams of a text between two marks."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))

    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(f"{prefix}{n}:"), F.substring(marked, i, F.lit(n))))

    return F.concat(*map(of_size, SIZES))


def with_features(urls: DataFrame) -> DataFrame:
    """``grams`` and their hashed counts, ``features``, from ``host`` and ``path``."""
    grams = F.concat(_grams("h", F.col("host")), _grams("p", F.col("path")))
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=CELLS, binary=True)
    return hashing.transform(urls.withColumn("grams", grams))


def _names(words: list[str], count: int) -> list[str]:
    """``count`` names of each word; which of the patterns they take goes round, so that no pattern tells the kind."""
    return [NAMES[(i + j * 3) % len(NAMES)].format(w) for i, w in enumerate(words) for j in range(count)]


def labelled_names() -> list[tuple[str, float]]:
    """The names of the built-in training table with their label (1: block)."""
    kinds = ((0.0, ALLOWED, ALLOWED_NAMES), (1.0, BLOCKED, BLOCKED_NAMES))
    return [(name, label) for label, words, count in kinds for name in _names(words, count)]


def labelled_urls(spark: SparkSession, names: list[tuple[str, float]] | None = None) -> DataFrame:
    """A table of url and label for names, those of the built-in table unless others are given.

    The built-in words are general ones of either kind, made without a look at any table of pages.
    """
    named = spark.createDataFrame(names if names is not None else labelled_names(), "name string, label double")
    frames = F.explode(F.array(*map(F.lit, AROUND))).alias("frame")
    return named.select("name", "label", frames).select(F.replace("frame", F.lit("{}"), F.col("name")).alias("url"), "label")


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """``labelled``: a small table of url and label, 1 for block."""
    host, path = host_and_path(F.col("url"))
    rows = with_features(labelled.select(host.alias("host"), path.alias("path"), "label"))
    # mostly ridge, with enough lasso that n-grams which tell nothing drop out
    return LogisticRegression(maxIter=60, regParam=3e-3, elasticNetParam=0.1).fit(rows.select("features", "label"))


def judge(urls: DataFrame, model: LogisticRegressionModel, rules: tuple[Rule, ...], key: str, url: str = "url") -> DataFrame:
    """Columns ``key``, ``host``, ``path``, ``rule``, ``verdict`` and ``block_probability``, one row per row.

    The longest rule that fits decides, else the model. A null url, or one without
    ``://``, has an empty host and path, which no rule fits. Only ``key`` and ``url`` are read, so
    other columns can't clash; repeated rows are judged alike; an empty table gives an
    empty one. There is no shuffle.
    """
    host, path = host_and_path(F.col(url).cast("string"))
    rows = urls.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rows = model.transform(with_features(rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))))
    probability = vector_to_array("probability")[1]
    verdict = F.coalesce(F.col("rule.verdict"), F.when(probability >= BLOCK_FROM, "block").otherwise("allow"))
    return rows.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("rule.name").alias("rule"),
        verdict.alias("verdict"),
        probability.alias("block_probability"),
    )
