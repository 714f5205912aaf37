"""URL filters (1): host rules, and gradient-boosted trees on lexical features.

Method, in DataFrame and Spark ML functions only: a url that a rule fits has
the rule's verdict, and is an example for the others.  Trees are boosted on
lexical features of the urls: lengths, depth, digit ratio, entropy of the
characters, parameter counts, and the share of blocked examples among hosts
of the same suffix.  They are trained on a sample of at most about
``TRAIN_ROWS`` examples, taken by hash; every url is scored.

Suffixes are hashed into ``SUFFIXES`` buckets, so their table is small however
many there are, and is broadcast.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is judged by the trees like any other; without examples
of both verdicts the rest get the verdict there is, or allow; repeated rows get
equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.llm.frames import stage

# The rules, verdict by host and path.
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}
TRAIN_ROWS = 50_000
SUFFIXES = 1024
TREES, DEPTH, RATE, SEED = 12, 4, 0.3, 11
#: Examples that a suffix counts as having besides its own, with the share of all examples.
PRIOR_ROWS = 20
BLOCK_AT = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        here = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        out = F.when(here, F.lit(rule)).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Bits a character, from the numbers of each distinct one."""
    chars = F.split(text, "")
    n = F.length(text)
    part = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(n > 0, F.aggregate(F.filter(F.array_distinct(chars), lambda c: c != ""), F.lit(0.0),
                                     lambda s, c: s - part(c) * F.log2(part(c)))).otherwise(0.0)


def lexical(pages: DataFrame) -> DataFrame:
    """page_id, host, path and the features of each url."""
    url = F.coalesce("url", F.lit(""))
    host, path = host_and_path(url)
    p = pages.select("page_id", url.alias("url")).withColumns({"host": host, "path": path})
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    length = lambda c: F.length(c).cast("double")
    first = F.element_at(F.split("host", r"\."), 1)
    return p.withColumns({
        "suffix": F.pmod(F.xxhash64(F.element_at(F.split("host", r"\."), -1)), F.lit(SUFFIXES)).cast("int"),
        "f_url": length("url"), "f_host": length("host"), "f_path": length("path"), "f_query": length(query),
        "f_labels": count(F.col("host"), r"\."), "f_first": length(first),
        "f_depth": count(F.col("path"), "/"), "f_digits": count(F.col("url"), "[0-9]") / F.greatest(F.length("url"), F.lit(1)),
        "f_hyphens": count(F.col("url"), "-"), "f_params": count(query, "="), "f_escapes": count(F.col("url"), "%"),
        "f_fragment": F.contains(F.col("url"), F.lit("#")).cast("double"),
        "f_https": F.startswith(F.col("url"), F.lit("https")).cast("double"),
        "f_segment": length(F.element_at(F.split("path", "/"), -1)),
        "f_host_entropy": _entropy(F.col("host")), "f_path_entropy": _entropy(F.col("path")),
    })


FEATURES = ["f_url", "f_host", "f_path", "f_query", "f_labels", "f_first", "f_depth", "f_digits", "f_hyphens", "f_params",
            "f_escapes", "f_fragment", "f_https", "f_segment", "f_host_entropy", "f_path_entropy", "f_suffix"]


def judge_urls(pages: DataFrame, rules: dict[str, str] = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (the chance of block; see the contract of op1)."""
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    verdict = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv])
    urls = lexical(pages).withColumn("rule", rule).withColumn("label", (verdict[F.col("rule")] == "block").cast("double"))
    spark = pages.sparkSession
    examples = stage(spark, urls.where("rule is not null").select(
        "page_id", "url", "suffix", "label", *[f for f in FEATURES if f != "f_suffix"]), "url-examples")
    known = examples.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("bad")).first()
    share = known["bad"] / known["n"] if known["n"] else 0.0
    suffixes = stage(spark, examples.groupBy("suffix").agg(
        ((F.sum("label") + PRIOR_ROWS * share) / (F.count(F.lit(1)) + PRIOR_ROWS)).alias("f_suffix")), "url-suffixes")

    def with_vector(rows: DataFrame) -> DataFrame:
        full = rows.join(F.broadcast(suffixes), "suffix", "left").withColumn("f_suffix", F.coalesce("f_suffix", F.lit(share)))
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(full)

    if 0 < known["bad"] < known["n"]:
        kept = examples
        if known["n"] > train_rows:
            kept = examples.where(F.pmod(F.xxhash64("url", "page_id"), F.lit(1 << 20)) < int(train_rows / known["n"] * (1 << 20)))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=SEED).fit(with_vector(kept).select("features", "label"))
        scored = model.transform(with_vector(urls)).withColumn("score", F.element_at(vector_to_array("probability"), 2))
    else:
        scored = urls.withColumn("score", F.lit(1.0 if known["bad"] else 0.0))
    judged = F.when(F.col("score") >= BLOCK_AT, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce(verdict[F.col("rule")], judged).alias("verdict"), "score")
