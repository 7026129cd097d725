"""Operator 4: URL filter by the likelihood ratio of two character language models.

Rules decide first. URLs that a rule allows train one model, those a rule blocks another: smoothed
Markov models of variable order over characters, each order interpolated with the next shorter one
by the number of different characters seen after a context (Witten and Bell). A URL without a rule
gets the mean log-likelihood difference per character, and is blocked if that is below a threshold.
The threshold is calibrated on held-out ruled URLs, a fifth by hash: it is where most are told
rightly, accepted and rejected weighing the same.

Only DataFrame functions are used. All counts come from one table of distinct windows; the models of
all orders are joins on it, and hot windows are split by adaptive execution.

Results for odd input: a null URL and one without ``://`` have empty host and path; the former scores
0 and is allowed. If one class has no URL the ratio knows nothing: scores are 0, all allowed. Ties at
the threshold are allowed. Repeated rows are scored alike and returned as often as they come. An
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forerate.functions.joins import lookup
from forerate.sources.staging import staged

#: Characters before the one that is predicted, at most; of the alphabet that smooths order 0.
ORDER, ALPHABET = 5, 256
#: Held-out share of the ruled URLs: one in so many.
HELD_OUT = 5
#: Steps of the calibrated threshold, in nats per character.
STEP = 0.01
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START = "\u0002"


class Rule(NamedTuple):
    allow: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A to Z lower-cased) and path of a URL; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    found = F.instr(url, "://") > 0
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, SMALL)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(found, host).otherwise(""), F.when(found, path).otherwise("")


def ruled(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``page_id, url, host, path, rule, allowed``; rule and allowed are null where none fits."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), path.alias("path"))
    rule, allowed = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = (F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))
        fits &= F.startswith(F.col("path"), F.lit(r.path))
        rule, allowed = F.when(fits, F.lit(r.name)).otherwise(rule), F.when(fits, F.lit(r.allow)).otherwise(allowed)
    return rows.withColumns({"rule": rule, "allowed": allowed})


def windows(rows: DataFrame, *keep: str, order: int = ORDER) -> DataFrame:
    """A row for every character of every URL: the character after up to ``order`` others, as ``gram``."""
    padded = F.expr(f"split(concat(repeat('{START}', {order}), url), '')")
    rows = rows.where(F.char_length("url") > 0).select(*keep, padded.alias("chars"))
    found = f"transform(sequence(1, size(chars) - {order}), i -> concat_ws('', slice(chars, i, {order + 1})))"
    grams = F.expr(f"if(size(chars) > {order}, {found}, array())")
    return rows.select(*keep, F.explode(grams).alias("gram"))


def gram_ratios(train: DataFrame, every: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, ratio``: log-likelihood difference of the last character, for every window that occurs.

    ``train`` has ``gram`` and ``allowed`` of the URLs to learn from, ``every`` the distinct windows to
    score. Counts of shorter contexts are sums over longer ones, as every character has a full window.
    """
    counted = train.groupBy("gram").agg(F.count_if("allowed").alias("a"), F.count_if(~F.col("allowed")).alias("r"))
    full = every.select("gram").distinct().join(counted, "gram", "left").fillna(0, ["a", "r"])
    full = staged(full, "grams")
    even = F.lit(1.0 / ALPHABET)
    lower = None
    for k in range(order + 1):
        level = full.groupBy(F.right("gram", F.lit(k + 1)).alias("gram")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = level.groupBy(F.left("gram", F.lit(k)).alias("context")).agg(
            F.sum("a").alias("na"), F.sum("r").alias("nr"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr")
        )
        level = level.join(context, F.left("gram", F.lit(k)) == F.col("context"))
        if lower is not None:
            level = level.join(lower, F.right("gram", F.lit(k)) == F.col("short"))
        before = (F.col("pa0"), F.col("pr0")) if lower is not None else (even, even)
        probs = []
        for count, total, kinds, shorter in (("a", "na", "ta", before[0]), ("r", "nr", "tr", before[1])):
            mass = F.col(total) + F.col(kinds)
            probs.append(F.when(mass > 0, (F.col(count) + F.col(kinds) * shorter) / mass).otherwise(shorter))
        if k == 0:  # a character never seen in a class still has a share
            probs = [(p * F.lit(0.999) + even * F.lit(0.001)) for p in probs]
        lower = level.select(F.col("gram").alias("short"), probs[0].alias("pa0"), probs[1].alias("pr0"))
    return lower.select(F.col("short").alias("gram"), (F.log("pa0") - F.log("pr0")).alias("ratio"))


def scored(rows: DataFrame, ratios: DataFrame, order: int = ORDER) -> DataFrame:
    """``key, crc, score``: the mean difference per character of every distinct non-empty URL.

    The two hashes stand for the URL. Means are rounded, so that the order of summation can't decide.
    """
    urls = rows.select("url").distinct().withColumns({"key": F.xxhash64("url"), "crc": F.crc32(F.col("url"))})
    spread = lookup(windows(urls, "key", "crc", order=order), ratios, ["gram"], ratios.count(), "inner")
    return spread.groupBy("key", "crc").agg(F.round(F.avg("ratio"), 9).alias("score"))


def calibrated(held: DataFrame) -> float:
    """The threshold that tells ``allowed`` of scored held-out rows best; 0 if a class is missing.

    Scores are counted in steps first, so the curve has a row per step.
    """
    steps = held.groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(
        F.count_if("allowed").alias("a"), F.count_if(~F.col("allowed")).alias("r")
    )
    rows = sorted((r["step"], r["a"], r["r"]) for r in steps.where("step is not null").collect())
    total_a, total_r = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not total_a or not total_r:
        return 0.0
    best, at, below_a, below_r = -1.0, 0.0, 0, 0
    for step, a, r in [*rows, (rows[-1][0] + 1, 0, 0)]:
        right = below_r / total_r + 1 - below_a / total_a  # everything below this step is blocked
        if right > best:
            best, at = right, step * STEP
        below_a, below_r = below_a + a, below_r + r
    return at


def judged(pages: DataFrame, rules: Sequence[Rule], order: int = ORDER) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``."""
    rows = staged(ruled(pages, rules), "ruled")
    labelled = rows.where("allowed is not null and url <> ''")
    held = F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0
    classes = labelled.where(~held).agg(F.count_if("allowed"), F.count_if(~F.col("allowed"))).first()
    if not classes[0] or not classes[1]:
        verdict = F.when(F.col("allowed") | F.col("allowed").isNull(), "allow").otherwise("block")
        return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.lit(0.0).alias("score"))
    train = windows(labelled.where(~held), "allowed", order=order)
    ratios = staged(gram_ratios(train, windows(rows, order=order), order), "ratios")
    means = staged(scored(rows, ratios, order), "scores")
    keyed = rows.withColumns({"key": F.xxhash64("url"), "crc": F.crc32(F.col("url"))})
    keyed = keyed.join(means, ["key", "crc"], "left")
    threshold = calibrated(keyed.where("allowed is not null and score is not null").where(held))
    score = F.coalesce("score", F.lit(0.0))
    by_method = F.when(F.col("score") < threshold, "block").otherwise("allow")
    verdict = F.when(F.col("allowed"), "allow").when(~F.col("allowed"), "block").otherwise(by_method)
    return keyed.select("page_id", "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))
