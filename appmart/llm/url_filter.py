"""URL filter: explicit host/path rules, then a trained classifier.

The classifier is a logistic regression on hashed character n-grams of host
and path, fitted on a small labelled URL table. The table is bounded by its
rule: every blocked and every ordinary word below is put through a few URL
shapes (``labelled_urls``). Training and scoring are DataFrame operations.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule and is judged by the model on no n-grams (allowed, as the
intercept is fitted on mostly ordinary urls). Repeated urls get the same
verdict; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAMS = (3, 4, 5)
FEATURES = 1 << 16
BLOCK_ABOVE = 0.5

#: Labelled words: what unwanted hosts and paths are commonly named after, and ordinary names.
BLOCKED_WORDS = """spam pills viagra casino bets betting poker slots jackpot adult porn xxx sex escort nude webcam
ads adserver track tracker clickbait popup malware phish scam warez crack keygen torrent replica payday loans
cheap-meds free-money win-prize casino-bonus link-farm content-farm fake-news diet-pills free-bets hot-singles
get-rich adult-chat ad-track""".split()
ORDINARY_WORDS = """news weather library museum school college science garden kitchen travel music cinema theatre
sports cycling running climbing history physics biology chemistry maths language poetry health hospital council
village harbour mountain river forest bakery grocery market bookshop studio design engineering software research
journal review archive gallery photo recipes family letters notes thread therapy theory other ether north south
weekly daily report forum wiki docs help status shop cafe hotel airport railway energy climate""".split()
#: Frequent English letter pairs; ordinary names without a meaning are made of them.
PAIRS = "th he in er an re nd at on nt ha es st en ed to it ou ea hi is or ti as te et ng of al de se le".split()
MADE_UP_NAMES = 1500


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of ``url``; both empty without ``://`` or for null."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null if none does.

    A rule is (verdict, 'host/path'): it fits the host and its subdomains if
    the url's path starts with the rule's path.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):  # longer rules are tried first, as the last wrapped
        at, _, below = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + below)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _grams(text: Column, tag: str) -> Column:
    """Distinct tagged character n-grams of ``^text$``; none for an empty text."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))
    lists = [F.when((F.length(text) > 0) & (F.length(framed) >= k),
                    F.transform(F.sequence(F.lit(1), F.greatest(F.length(framed) - k + 1, F.lit(1))),
                                lambda i, k=k: F.concat(F.lit(tag), F.substring(framed, i, F.lit(k)))))
             .otherwise(F.array().cast("array<string>")) for k in GRAMS]
    return F.array_distinct(F.concat(*lists))


def featurise(rows: DataFrame, host: str, path: str) -> DataFrame:
    """``rows`` plus ``features``: hashed n-gram presence of the two columns."""
    grams = rows.withColumn("_grams", F.concat(_grams(F.col(host), "h"), _grams(F.col(path), "p")))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="features").transform(grams)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table (host, path, label), made in Spark from the word lists.

    Words appear alone, joined to other words of their list and framed by
    common prefixes. Made-up names of 2 to 6 letter pairs are ordinary. Both
    labels get the same plain paths, so paths speak only where they hold a
    blocked or an ordinary word.
    """
    def side(words: list[str], label: float) -> DataFrame:
        return (spark.range(1).select(F.array(*map(F.lit, words)).alias("w"), F.lit(label).alias("label"))
                .select("w", "label", F.posexplode("w").alias("i", "one")))
    words = side(BLOCKED_WORDS, 1.0).unionByName(side(ORDINARY_WORDS, 0.0))
    nth = lambda k: F.expr(f"w[(i + {k}) % size(w)]")
    named = words.select("label", "one", F.explode(F.array(
        F.col("one"), F.concat("one", F.lit("-"), nth(7)), F.concat(nth(5), F.lit("-"), "one"),
        F.concat("one", nth(11)))).alias("name"))
    made_up = spark.range(MADE_UP_NAMES).select(
        F.lit(0.0).alias("label"), F.lit("").alias("one"), F.array(*map(F.lit, PAIRS)).alias("p"), "id").select(
        "label", "one", F.expr("""array_join(transform(sequence(1, 2 + cast(id % 5 as int)),
                                  k -> p[pmod(hash(id, k), size(p))]), '')""").alias("name"))
    hosts = named.unionByName(made_up)
    # Every name gets the same frames, so prefix, suffix and plain path say nothing about the label.
    frames = F.expr("""array(struct('' as a, '.example.com' as z, '/' as path),
        struct('www.' as a, '.example.net' as z, '/en/12' as path),
        struct('blog.' as a, '.example.org' as z, '/de/345.html' as path),
        struct('m.' as a, '.example.com' as z, concat('/', one, '/index.html') as path))""")
    return hosts.select("name", "label", F.explode(frames).alias("f")).select(
        F.concat("f.a", "name", "f.z").alias("host"), F.col("f.path").alias("path"), "label")


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """Fit on rows with ``host``, ``path`` and ``label`` (1.0 blocked)."""
    # The labels weigh alike in total, whatever their numbers of rows.
    share = labelled.agg(F.avg("label").alias("p")).first()["p"]
    rows = featurise(labelled, "host", "path").select(
        "features", "label", F.when(F.col("label") == 1.0, 0.5 / share).otherwise(0.5 / (1 - share)).alias("weight"))
    rows = rows.coalesce(1).cache()  # a few thousand rows, read once per step of the optimiser
    try:
        return LogisticRegression(maxIter=25, regParam=1e-4, standardization=False, weightCol="weight").fit(rows)
    finally:
        rows.unpersist()


def judge(urls: DataFrame, url: str, keep: list[str], rules: list[tuple[str, str]],
          model: LogisticRegressionModel) -> DataFrame:
    """The columns in ``keep`` with host, path, rule, verdict and the model's probability of blocking."""
    host, path = host_and_path(F.col(url))
    rows = urls.select(F.struct(*keep).alias("d"), host.alias("host"), path.alias("path"))
    scored = model.transform(featurise(rows, "host", "path"))
    rule, says = best_rule(F.col("host"), F.col("path"), rules)
    block = vector_to_array("probability")[1]
    return scored.select("d", "host", "path", rule.alias("rule"), block.alias("p_block"), F.coalesce(
        says, F.when(block > BLOCK_ABOVE, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
