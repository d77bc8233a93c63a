"""Accept or reject URLs by rules, and by two character Markov models where no rule fits.

The models are trained on the URLs that rules accept and reject. Characters fold into 33
symbols, so a model over contexts of up to three symbols has at most 33**4 entries however
many URLs there are; that bound makes the model safe to broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from posttags.llm.common import lower_ascii
from posttags.session import materialise

# One symbol each: start, letters, digit, slash, dot, dash; "?" stands for the marks of a
# query and "~" for everything else.
SYMBOLS = "^abcdefghijklmnopqrstuvwxyz0/.-?~"
BASE = len(SYMBOLS)
ORDER = 3
# Weight of the shorter context against the counts of the longer one.
BACKOFF = 4.0
# One URL in so many that a rule decides is kept from training and sets the threshold.
HOLD = 5
# Threshold candidates: this many bins over scores of -RANGE to RANGE per symbol.
BINS, RANGE = 400, 4.0


@dataclass(frozen=True)
class Rule:
    """``allow`` or block a host with its subdomains, for paths that begin with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = F.col("host")
        named = (host == self.host) | host.endswith("." + self.host)
        return named & F.col("path").startswith(self.path)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path. Both are empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return lower_ascii(host), path


def rule_of(rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and whether it allows, null without one.

    Of rules with equal length the one listed first counts.
    """
    text, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        text = F.when(rule.fits(), F.lit(rule.text)).otherwise(text)
        allow = F.when(rule.fits(), F.lit(rule.allow)).otherwise(allow)
    return text, allow


def folded(url: Column) -> Column:
    """A URL without its scheme, in the symbols of the models."""
    low = F.regexp_replace(lower_ascii(F.coalesce(url, F.lit(""))), "^[a-z]*://", "")
    known = F.regexp_replace(low, r"[^a-z0-9/.\-?=&_#]", "~")
    return F.translate(known, "123456789=&_#", "000000000????")


def gram_codes(symbols: Column) -> Column:
    """Each symbol with the three before it, as numbers of base 33; null for no symbols.

    ``symbols`` should be a stored column: it is read once for every symbol.
    """

    def code(at: Column) -> Column:
        digits = []
        for back in range(ORDER, -1, -1):
            sign = F.substring(symbols, at - back, 1)
            digits.append(F.when(at > back, F.instr(F.lit(SYMBOLS), sign) - 1).otherwise(0))
        return reduce(lambda total, digit: total * BASE + digit, digits).cast("int")

    length = F.length(symbols)
    return F.when(length > 0, F.transform(F.sequence(F.lit(1), length), code))


def log_ratio_model(grams: DataFrame) -> DataFrame:
    """``code, ratio``: log P(accepted) - log P(rejected) of each symbol after its context.

    ``grams`` has ``code, accepted, rejected`` counts. Probabilities of every context length
    are mixed with those of the next shorter one, so unseen contexts fall back to it; the
    shortest falls back to equal chances.
    """
    model = grams
    for side in ("accepted", "rejected"):
        chance: Column = F.lit(1.0 / BASE)
        for length in range(ORDER + 1):
            tail = (F.col("code") % BASE ** (length + 1)).alias("_tail")
            head = F.floor(tail / BASE).alias("_head")
            counts = grams.groupBy(tail).agg(F.sum(side).alias(f"_n{length}"))
            contexts = grams.groupBy(head).agg(F.sum(side).alias(f"_c{length}"))
            model = (
                model.withColumn("_tail", F.col("code") % BASE ** (length + 1))
                .withColumn("_head", F.floor(F.col("_tail") / BASE))
                .join(counts, "_tail")
                .join(contexts, "_head")
                .drop("_tail", "_head")
            )
            seen, context = F.col(f"_n{length}"), F.col(f"_c{length}")
            chance = (seen + BACKOFF * chance) / (context + BACKOFF)
        model = model.withColumn(f"_p_{side}", chance).drop(
            *[f"_{kind}{k}" for kind in "nc" for k in range(ORDER + 1)]
        )
    return model.select("code", F.log(F.col("_p_accepted") / F.col("_p_rejected")).alias("ratio"))


def threshold_of(scored: DataFrame) -> float:
    """The score with the fewest balanced errors on ``score, label`` rows; 0 without both.

    Scores are counted in BINS bins, so what is collected does not grow with the URLs.
    """
    place = F.least(F.greatest((F.col("score") + RANGE) / (2 * RANGE), F.lit(0.0)), F.lit(1.0))
    bins = (
        scored.groupBy(F.floor(place * BINS).cast("int").alias("bin"))
        .agg(
            F.count(F.when(F.col("label"), 1)).alias("good"),
            F.count(F.when(~F.col("label"), 1)).alias("bad"),
        )
        .orderBy("bin")
        .collect()
    )
    good, bad = sum(b.good for b in bins), sum(b.bad for b in bins)
    if not good or not bad:
        return 0.0
    best, lost, passed = (1.0, 0.0), 0, bad
    for b in bins:
        error = 0.5 * lost / good + 0.5 * passed / bad
        best = min(best, (error, b.bin * 2 * RANGE / BINS - RANGE), key=lambda x: x[0])
        lost, passed = lost + b.good, passed - b.bad
    return best[1]


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Judge every URL: ``page_id, host, path, rule, verdict, score, threshold``.

    ``verdict`` is the rule's, else "allow" where ``score``, the mean log ratio per symbol,
    reaches ``threshold``, which is set on rule-decided URLs kept from training.

    A null or empty URL has empty host and path and the score 0. Without URLs of both kinds
    to learn from every score is 0 and all pass. Rows given twice come back twice; a null
    page_id stays null; an empty table gives an empty result. Other columns are not looked at.
    """
    url = F.col("url").cast("string")
    host, path = split_url(url)
    urls = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
        host.alias("host"), path.alias("path"),
    )
    rule, allow = rule_of(rules)
    held = F.coalesce(F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("long") % HOLD == 0, F.lit(False))
    urls = materialise(
        urls.select(
            F.monotonically_increasing_id().alias("row"), "*",
            rule.alias("rule"), allow.alias("label"), held.alias("held"),
            folded(F.col("url")).alias("symbols"),
        ),
        "urls",
    )
    grams = urls.select("*", F.explode_outer(gram_codes(F.col("symbols"))).alias("code"))
    train = F.col("label").isNotNull() & ~F.col("held")
    counts = materialise(
        grams.where("code is not null")
        .groupBy("code")
        .agg(
            F.count(F.when(train & F.col("label"), 1)).alias("accepted"),
            F.count(F.when(train & ~F.col("label"), 1)).alias("rejected"),
        ),
        "url-grams",
    )
    both = counts.agg(F.max("accepted"), F.max("rejected")).first()
    learnt = bool(both[0]) and bool(both[1])
    model = materialise(log_ratio_model(counts), "url-model")
    ratio = F.coalesce("ratio", F.lit(0.0)) if learnt else F.lit(0.0)
    scored = materialise(
        grams.join(F.broadcast(model), "code", "left")
        .groupBy("row", "page_id", "host", "path", "rule", "label", "held")
        .agg(F.round(F.avg(ratio), 9).alias("score")),
        "url-scores",
    )
    limit = threshold_of(scored.where("label is not null and held"))
    passed = F.coalesce("label", F.col("score") >= limit)
    return scored.select(
        "page_id", "host", "path", "rule",
        F.when(passed, "allow").otherwise("block").alias("verdict"),
        "score", F.lit(limit).alias("threshold"),
    )
