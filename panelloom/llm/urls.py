"""URL filter: rules first, then the ratio of two character language models.

URLs that a rule judges are the labelled sample: those allowed train the model of accepted URLs,
those blocked the model of rejected ones. A model is a variable-order Markov chain over folded
characters (letters, one sign for all digits, common marks, one sign for the rest) with contexts of
up to ``ORDER`` characters; each order is interpolated with the next shorter one by the number of
different characters seen after the context (Witten-Bell). A URL's score is the mean over its
characters of the log-likelihood difference, so length does not matter. One URL in ``HELD_BACK``
is not learned from; on these the threshold is set at the best balanced accuracy.

Counts are taken once, over all distinct character runs of ``ORDER`` + 1, whose number is bounded by
the alphabet: shorter orders are sums of them. Equal URLs are scored once. Everything is built-in
Spark functions.

Defined results: a NULL url, or one without "://", has an empty host and path, no rule and no
character, and is allowed; without both kinds of labelled URLs every unruled URL is allowed; rows
that repeat a page are judged alike; further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm import common as C

ALLOW, BLOCK = "allow", "block"
# The production rules as (host, path, verdict).
RULES = (
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
)
ORDER = 3
HELD_BACK = 5
#: The signs of folded URLs: letters, a digit, marks, any other, start and end.
MARKS = "./-_~%+=,:;@"
SIGNS = 26 + 1 + len(MARKS) + 3
#: Runs of characters that are broadcast at most; their number can't exceed SIGNS ** (ORDER + 1).
BROADCAST_RUNS = 500_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (NULL: none)."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, judged in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, judged).otherwise(verdict)
    return name, verdict


def runs(address: Column) -> Column:
    """All runs of ``ORDER`` + 1 folded characters, with starts before the first and an end."""
    folded = F.regexp_replace(F.regexp_replace(F.lower(address), "[0-9]", "0"), "[^a-z0" + "".join("\\" + m for m in MARKS) + "]", "*")
    padded = F.concat(F.lit("^" * ORDER), folded, F.lit("$"))
    return F.when(
        F.length(address) > 0, F.transform(F.sequence(F.lit(1), F.length(address) + 1), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))
    ).otherwise(F.array().cast("array<string>"))


def run_scores(counts: DataFrame) -> DataFrame:
    """(run, llr) from (run, accepted, rejected): the log-likelihood difference of its last character."""
    counts = counts.withColumn("sign", F.substring("run", ORDER + 1, 1))
    lower = None
    for order in range(ORDER + 1):
        context = F.substring("run", ORDER + 1 - order, order) if order else F.lit("")
        level = counts.groupBy(context.alias("context"), "sign").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        whole = Window.partitionBy("context")  # at most SIGNS rows
        if lower is None:
            level = level.withColumn("p_accepted", F.lit(1.0 / SIGNS)).withColumn("p_rejected", F.lit(1.0 / SIGNS))
        else:
            shorter = F.substring("context", 2, order)
            level = level.withColumn("shorter", shorter).join(lower, ["shorter", "sign"])
        for label in ("accepted", "rejected"):
            total, kinds = F.sum(label).over(whole), F.sum((F.col(label) > 0).cast("int")).over(whole)
            mixed = (F.col(label) + kinds * F.col(f"p_{label}")) / (total + kinds)
            level = level.withColumn(f"q_{label}", F.when(total > 0, mixed).otherwise(F.col(f"p_{label}")))
        lower = level.select(F.col("context").alias("shorter"), "sign", F.col("q_accepted").alias("p_accepted"), F.col("q_rejected").alias("p_rejected"))
    return lower.select(F.concat("shorter", "sign").alias("run"), (F.log("p_accepted") - F.log("p_rejected")).alias("llr"))


def score_addresses(labelled: DataFrame) -> DataFrame:
    """(address, score) of the distinct addresses of ``labelled`` (address, verdict)."""
    # Whether an address is allowed or blocked depends on itself alone, so each has one verdict.
    each = C.checkpointed(labelled.groupBy("address").agg(F.max("verdict").alias("verdict"), F.count("*").alias("pages")))
    learned = F.pmod(F.xxhash64("address"), F.lit(HELD_BACK)) != 0
    cut = each.select("address", "verdict", "pages", learned.alias("learned"), F.explode(runs(F.col("address"))).alias("run"))

    def weight(verdict: str) -> Column:
        return F.sum(F.when(F.col("learned") & (F.col("verdict") == verdict), F.col("pages")).otherwise(0))

    counts = C.checkpointed(cut.groupBy("run").agg(weight(ALLOW).alias("accepted"), weight(BLOCK).alias("rejected")))
    scores = C.checkpointed(run_scores(counts))
    scores = F.broadcast(scores) if scores.count() <= BROADCAST_RUNS else scores
    scored = cut.join(scores, "run").groupBy("address").agg(F.round(F.avg("llr"), 6).alias("score"))
    return C.checkpointed(each.join(scored, "address", "left").withColumn("learned", learned))


def threshold(scored: DataFrame) -> float | None:
    """The score from which URLs are allowed: the best balanced accuracy on labelled addresses that
    were not learned from (on those learned from, if these lack a kind). None without both kinds."""
    for part in (scored.where("NOT learned"), scored):
        steps = part.where("verdict IS NOT NULL AND score IS NOT NULL").groupBy(F.round("score", 2).alias("step"))
        table = steps.agg(
            F.sum(F.when(F.col("verdict") == ALLOW, F.col("pages")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("verdict") == BLOCK, F.col("pages")).otherwise(0)).alias("bad"),
        )
        # A few thousand steps at most: a mean log-likelihood difference has bounded size.
        below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
        every = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        parts = [F.try_divide(F.coalesce(F.sum(c).over(below), F.lit(0)), F.sum(c).over(every)) for c in ("bad", "good")]
        before = F.lag("step", 1).over(Window.orderBy("step"))
        # Halfway between the scores on both sides of the cut.
        middle = (F.col("step") + F.coalesce(before, F.col("step") - 0.01)) / 2
        best = table.select((parts[0] + 1 - parts[1]).alias("worth"), middle.alias("cut")).where("worth IS NOT NULL").orderBy(F.desc("worth"), "cut").limit(1).head()
        if best:
            return float(best["cut"])
    return None


def judge(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score in a further struct ``judged``."""
    judged, key, score = C.free_name(pages, "judged", "address_key", "url_score")
    host, path = host_and_path(F.col(f"`{url}`"))
    ruled = pages.withColumn(judged, F.struct(host.alias("host"), path.alias("path")))
    name, verdict = rule_of(F.col(judged)["host"], F.col(judged)["path"], rules)
    address = F.concat(F.col(judged)["host"], F.col(judged)["path"])
    ruled = ruled.withColumn(key, address).withColumn(judged, F.struct(F.col(judged)["host"].alias("host"), F.col(judged)["path"].alias("path"), name.alias("rule"), verdict.alias("verdict")))
    scored = score_addresses(ruled.select(F.col(key).alias("address"), F.col(judged)["verdict"].alias("verdict")))
    least = threshold(scored)
    by_model = F.when(F.col(score) < F.lit(least), BLOCK).otherwise(ALLOW)
    out = ruled.join(scored.select(F.col("address").alias(key), F.col("score").alias(score)), key, "left")
    final = F.struct(*[F.col(judged)[c].alias(c) for c in ("host", "path", "rule")], F.coalesce(F.col(judged)["verdict"], by_model).alias("verdict"), F.col(score).alias("score"))
    return out.withColumn(judged, final).select([F.col(f"`{c}`") for c in pages.columns] + [F.col(judged).alias("judged")])


def verdicts(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page."""
    return judge(pages.select("page_id", "url")).select("page_id", "judged.*")
