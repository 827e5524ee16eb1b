"""URL filter: rules first, then a ratio of two character language models.

Rules name a host and a path prefix; the longest rule that fits decides. URLs that rules accept
and reject train two smoothed variable-order Markov models over characters (Witten-Bell: each
order hands the share of its distinct continuations to the next shorter context). A URL that no
rule fits is judged by the difference of the two log-likelihoods per character against a
threshold calibrated on ruled URLs that were left out of training. DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armazem.llm.digests import CAPITALS, SMALL
from armazem.llm.runtime import run_folder, written

ALPHABET = 1000  # the shortest model spreads over so many characters
_STEP = 0.02  # width of a calibration bin
_REACH = 10.0  # scores beyond it share the last bin


def rest(url: Column) -> Column:
    """What follows the first ://, else empty."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest(url), r"^[^/?#]*", 0), CAPITALS, SMALL)


def path(url: Column) -> Column:
    return F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1)


def fits(rule: str, host_col: str = "host", path_col: str = "path") -> Column:
    domain, slash, tail = rule.partition("/")
    name = F.col(host_col)
    return ((name == domain) | name.endswith("." + domain)) & F.col(path_col).startswith(slash + tail)


def ruled(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, url, host, path, rule, verdict); rule and verdict null where no rule fits.

    rules: (allow or block, host/path); a short list that stands in the plan. The longest
    fitting one wins, the earlier of equals.
    """
    if len(rules) > 1000 or any(v not in ("allow", "block") for v, _ in rules):
        raise ValueError("rules are at most 1000 pairs of allow or block and a host/path")
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url")).select(
        "page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    best = F.lit(None).cast("int")
    for k, (_, rule) in sorted(enumerate(rules), key=lambda x: (len(x[1][1]), -x[0])):
        best = F.when(fits(rule), k).otherwise(best)
    rows = rows.withColumn("best", best)
    if not rules:
        return rows.select("page_id", "url", "host", "path", *(F.lit(None).cast("string").alias(c) for c in ("rule", "verdict")))
    names, verdicts = (F.array(*(F.lit(r[i]) for r in rules)) for i in (1, 0))
    return rows.select("page_id", "url", "host", "path",
                       F.get(names, F.col("best")).alias("rule"), F.get(verdicts, F.col("best")).alias("verdict"))


def spelled(url: Column) -> Column:
    """The text the models see: what follows ://, lower-cased, between two marks."""
    return F.concat(F.lit("\x02"), F.lower(rest(url)), F.lit("\x03"))


def each_gram(rows: DataFrame, order: int, *keep: str) -> DataFrame:
    """A row for each character of `text`, with up to `order` characters before it, beside `keep`."""
    each = F.transform(F.sequence(F.lit(2), F.length("text")),
                       lambda i: F.substr(F.col("text"), F.greatest(i - order, F.lit(1)), F.least(i, F.lit(order + 1))))
    return rows.where(F.length("text") > 2).select(*keep, F.explode(each).alias("gram"))


def grams(rows: DataFrame, order: int, *keep: str) -> DataFrame:
    """The same, counted per `keep`."""
    return each_gram(rows, order, *keep).groupBy(*keep, "gram").agg(F.count("*").alias("n"))


def orders(order: int) -> Column:
    """Contexts of a gram, from the empty one to the whole one."""
    return F.transform(F.sequence(F.lit(0), F.length("gram") - 1), lambda k: F.struct(
        k.alias("k"), F.substr(F.col("gram"), F.length("gram") - k, k).alias("context"), F.substr(F.col("gram"), F.length("gram"), F.lit(1)).alias("next")))


def merged(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join that sorts both sides. Grams and texts are many times what the planner takes them for
    by the files they come from, and it would send them all through the driver."""
    return left.join(right.hint("merge"), on, how)


class MarkovPair:
    """Counts of accepted and rejected URLs, as a written table by context and character."""

    def __init__(self, rows: DataFrame, order: int):
        """rows: text, accepted boolean."""
        self.order = order
        spark = rows.sparkSession
        n = grams(rows, order, "accepted")
        yes = F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0))
        no = F.sum(F.when(F.col("accepted"), 0).otherwise(F.col("n")))
        counts = n.groupBy("gram").agg(yes.alias("yes"), no.alias("no")).select(F.explode(orders(order)).alias("o"), "yes", "no")
        counts = counts.groupBy("o.context", "o.next").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        self.counts = written(counts, run_folder(spark, "urls-counts"))
        self.contexts = written(self.counts.groupBy("context").agg(
            F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"),
            F.count_if(F.col("yes") > 0).alias("kinds_yes"), F.count_if(F.col("no") > 0).alias("kinds_no")),
            run_folder(spark, "urls-contexts"))

    def ratios(self, seen: DataFrame) -> DataFrame:
        """(gram, ratio) of these grams and their ends: log-likelihood of the last character,
        accepted less rejected.

        A gram builds on the one without its first character, so lengths are taken one after
        another; a gram or context then has no more partners than there are characters.
        """
        spark = seen.sparkSession
        steps = seen.select(F.explode(orders(self.order)).alias("o")).select("o.context", "o.next").distinct()
        steps = merged(merged(steps, self.counts, ["context", "next"], "left"), self.contexts, ["context"], "left")
        values = [F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("yes", "all_yes", "kinds_yes", "no", "all_no", "kinds_no")]
        steps = written(steps.select(F.concat("context", "next").alias("gram"), *values), run_folder(spark, "urls-steps"))

        def model(side: str, p: Column) -> Column:
            total, kinds = F.col(f"all_{side}"), F.col(f"kinds_{side}")
            return F.when(total == 0, p).otherwise((F.col(side) + kinds * p) / (total + kinds))

        first = F.lit(1.0 / ALPHABET)
        rows = steps.where(F.length("gram") == 1).withColumns({"p_yes": first, "p_no": first})
        found = []
        for k in range(self.order + 1):
            if k:
                rows = merged(steps.where(F.length("gram") == k + 1).withColumn("rest", F.substr("gram", F.lit(2))),
                              found[-1].withColumnRenamed("gram", "rest"), ["rest"])
            rows = rows.select("gram", *(model(side, F.col(f"p_{side}")).alias(f"p_{side}") for side in ("yes", "no")))
            found.append(written(rows, run_folder(spark, "urls-likelihoods")))
        return reduce(DataFrame.unionByName, found).select("gram", (F.log("p_yes") - F.log("p_no")).alias("ratio"))

    def scores(self, rows: DataFrame) -> DataFrame:
        """(text, score) of distinct texts: mean ratio of a character; none for empty ones."""
        # A number stands for the text beside its grams; these are neither counted nor sorted, so they need no memory.
        texts = written(rows.select("text").distinct().withColumn("id", F.monotonically_increasing_id()),
                        run_folder(rows.sparkSession, "urls-texts"))
        by = self.ratios(grams(texts, self.order))
        found = each_gram(texts, self.order, "id").join(by.hint("shuffle_hash"), "gram").groupBy("id").agg(F.avg("ratio").alias("score"))
        return merged(texts, found, ["id"]).select("text", "score")


def threshold(scored: DataFrame) -> float:
    """Score at which the shares of wrongly judged accepted and rejected rows sum to the least, in
    the middle of the empty bins below it.

    scored: accepted, score. Works on a histogram of at most 1001 bins; 0 where a class is missing.
    """
    bins = int(2 * _REACH / _STEP)
    place = F.least(F.greatest(F.floor((F.col("score") + _REACH) / _STEP), F.lit(0)), F.lit(bins))
    found = scored.groupBy(place.alias("bin")).agg(
        F.count_if("accepted").alias("yes"), F.count_if(~F.col("accepted")).alias("no")).orderBy("bin").collect()
    yes, no = sum(r.yes for r in found), sum(r.no for r in found)
    if not yes or not no:
        return 0.0
    best, at, below, below_yes, below_no = 1.0, float(found[0].bin), found[0].bin, 0, 0
    for r in found:
        error = below_yes / yes + (no - below_no) / no
        if error < best:
            best, at = error, (below + r.bin) / 2
        below, below_yes, below_no = r.bin + 1, below_yes + r.yes, below_no + r.no
    return float(at * _STEP - _REACH)


def judged(pages: DataFrame, rules: list[tuple[str, str]], order: int = 4, folds: int = 5,
           id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score.

    verdict: the rule's, else allow where the score reaches the threshold, else block. score is
    null for ruled pages outside the calibration fold (one of `folds`, by a hash of the URL) and
    for URLs without characters after ://; the latter are allowed. Null URLs count as empty; an
    empty table gives no rows; repeated rows give one row each. With no ruled URL of a kind, that
    model is uniform and the threshold 0.
    """
    spark = pages.sparkSession
    rows = written(ruled(pages, rules, id_col, url_col).withColumn("text", spelled(F.col("url"))).withColumn(
        "held", F.pmod(F.xxhash64("text"), F.lit(folds)) == 0), run_folder(spark, "urls"))
    known = F.col("verdict").isNotNull()
    accepted = (F.col("verdict") == "allow").alias("accepted")
    models = MarkovPair(rows.where(known & ~F.col("held")).select("text", accepted), order)
    scores = written(models.scores(rows.where(~known | F.col("held"))), run_folder(spark, "urls-scores"))
    least = threshold(merged(rows.where(known & F.col("held")), scores, ["text"]).select(accepted, "score"))
    return merged(rows, scores, ["text"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("score").isNull() | (F.col("score") >= least), "allow").otherwise("block")).alias("verdict"),
        "score")
