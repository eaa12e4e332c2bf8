"""URL verdicts: the longest fitting rule, else naive Bayes on words that hosts and paths are made of.

Host words. The letter runs of a host are split into words by the most probable segmentation (Viterbi) under
word counts of the pages themselves. Every stretch of a run that is a counted word is found by a join of stretches
with the counts, so the vocabulary is never sent whole to a worker; a stretch that is no word costs more per
letter. Words have no greatest length: stretches of up to ``HEAD`` letters are joined as they are, and one of
``HEAD`` letters that begins longer words is lengthened to the lengths these have. Each distinct run is split once.

Bayes. URLs whose host or path words include a seed word count as bad, all others as good. Each word of a distinct
URL counts as often as it occurs, and its log odds (multinomial, add-one) are added as often. A URL without a rule is
blocked where the prior and its words' odds add up to more than ``threshold``. Odds come to URLs by a join as well.

Null URLs and those without ``://`` have an empty host and path, no words and the prior alone. Repeated
rows and tied rules: all rows are kept; of rules of one length the first in code point order wins. URLs of any length
are taken whole: a run of n letters makes at most ``HEAD`` * n stretches and those of longer words. An empty table
gives no rows; columns that are not named in the call are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.plans.bounds import lookup_join
from rankweave.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters of the longest stretches that are joined without knowing of a longer word.
HEAD = 20
# Words that mark a URL as bad when they stand alone.
SEEDS = (
    "adult", "bet", "bets", "betting", "casino", "gambling", "jackpot", "malware", "payday", "phishing",
    "pills", "poker", "porn", "sex", "slots", "spam", "torrent", "viagra", "warez", "xxx",
)
# How often a seed counts as a word beside its occurrences.
SEED_COUNT = 1_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): rules (host, path, verdict) of each host and of the domains above it, longest first."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    above = hosts.select("host", F.explode(suffixes).alias("rule_host"))
    named = rules.select(
        F.col("host").alias("rule_host"), F.struct(
            (-F.length(F.concat("host", "path"))).alias("order"), F.concat("host", "path").alias("rule"), "path", "verdict"
        ).alias("r")
    )
    joined = lookup_join(above, named, ["rule_host"])
    return joined.groupBy("host").agg(F.sort_array(F.collect_list("r")).alias("rules"))


def letter_runs(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit("[a-z]+"), F.lit(0))


def word_counts(pages: DataFrame, text: str) -> DataFrame:
    """(word, n): letter runs of the pages' texts and paths, and the seeds."""
    spark = pages.sparkSession
    runs = F.concat(letter_runs(F.lower(F.coalesce(F.col(text), F.lit("")))), letter_runs(F.lower(F.col("path"))))
    found = pages.select(F.explode(runs).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    seeds = spark.createDataFrame([(s, SEED_COUNT) for s in SEEDS], "word string, n long")
    return found.unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n"))


def best_split(run: str, words: list[tuple[int, int, float]], total: float) -> list[str]:
    """The most probable words of ``run``; ``words`` are (start, length, count) of the counted ones in it."""
    log_total = math.log10(max(total, 1.0))
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, n, count in words:
        ending.setdefault(start + n, []).append((start, math.log10(count) - log_total))
    best = [0.0] + [-math.inf] * len(run)
    came = [0] * (len(run) + 1)
    unknown, since = -math.inf, 0  # the best that ends here with a stretch that is no word, and where that begins
    for end in range(1, len(run) + 1):
        new = best[end - 1] + 1.0 - log_total
        if new > unknown:
            unknown, since = new, end - 1
        unknown -= 1.0
        best[end], came[end] = max([(unknown, since)] + [(best[s] + gain, s) for s, gain in ending.get(end, [])])
    out, end = [], len(run)
    while end:
        out.append(run[came[end] : end])
        end = came[end]
    return out[::-1]


def segmented(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(run, words) for distinct ``runs``."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    size = F.length("run")
    starts = runs.select("run", F.explode(F.sequence(F.lit(1), size)).alias("s"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(HEAD), size - F.col("s") + 1))
    short = starts.select("run", "s", F.explode(lengths).alias("n")).withColumn("word", F.substring("run", F.col("s"), F.col("n")))
    short = short.select("run", (F.col("s") - 1).alias("start"), "n", "word")
    # longer words: where their first letters stand, the lengths that words with these have
    head = F.substring("word", 1, HEAD)
    longer = counts.where(F.length("word") > HEAD).select(head.alias("word"), F.length("word").alias("full")).distinct()
    far = lookup_join(short.where(F.col("n") == HEAD), longer, ["word"]).where(F.col("start") + F.col("full") <= size)
    far = far.select("run", "start", F.col("full").alias("n"), F.substring("run", F.col("start") + 1, F.col("full")).alias("word"))
    each = short.unionByName(far)
    # the vocabulary is cut down to words of these runs first: it moves once at most, unsalted, for its words are distinct
    met = counts.join(each.select("word").distinct(), "word", "left_semi")
    counted = lookup_join(each, met.withColumnRenamed("n", "c"), ["word"])
    # at most HEAD words a letter of the run, and the longer ones
    found = counted.groupBy("run").agg(F.collect_list(F.struct("start", "n", F.col("c").cast("double").alias("c"))).alias("found"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [
                best_split(run, [(x["start"], x["n"], x["c"]) for x in found or []], total)
                for run, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            yield pa.record_batch([batch.column(0), pa.array(split, pa.list_(pa.string()))], ["run", "words"])

    return runs.join(found, "run", "left").select("run", "found").mapInArrow(kernel, "run string, words array<string>")


def url_words(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, path, words) of distinct URLs: words of the host's runs, split, and of the path."""
    hosts = urls.select("host").distinct()
    pieces = cut_lineage(hosts.select("host", F.posexplode(letter_runs(F.col("host"))).alias("at", "run")), "runs")
    split = segmented(pieces.select("run").distinct(), counts)
    whole = (
        lookup_join(pieces, split, ["run"])
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("parts"))
        .select("host", F.flatten(F.transform("parts", lambda p: p["words"])).alias("_host_words"))
    )
    named = lookup_join(urls, whole, ["host"], "left")
    words = F.concat(F.coalesce("_host_words", F.array().cast("array<string>")), letter_runs(F.lower(F.col("path"))))
    return named.select("host", "path", words.alias("words"))


def log_odds(words: DataFrame) -> tuple[DataFrame, float, float]:
    """((word, odds), odds of an unseen word, prior) from (host, path, words, bad)."""
    classes = {r["bad"]: r for r in words.groupBy("bad").agg(F.count("*").alias("n"), F.sum(F.size("words")).alias("w")).collect()}
    n = {k: classes[k]["n"] if k in classes else 0 for k in (False, True)}
    w = {k: classes[k]["w"] if k in classes else 0 for k in (False, True)}
    each = words.select("bad", F.explode("words").alias("word"))
    by_word = cut_lineage(
        each.groupBy("word").agg(
            F.sum(F.col("bad").cast("long")).alias("b"), F.sum((~F.col("bad")).cast("long")).alias("g")
        ),
        "odds",
    )
    v = by_word.count()
    bad, good = w[True] + v + 1, w[False] + v + 1
    odds = F.log((F.col("b") + 1) / F.lit(float(bad))) - F.log((F.col("g") + 1) / F.lit(float(good)))
    prior = math.log((n[True] + 1) / (n[False] + 1))
    return by_word.select("word", odds.alias("odds")), math.log(good / bad), prior


def judged(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", text: str = "html", threshold: float = 0.0
) -> DataFrame:
    """(id, host, path, rule, verdict, words, score) of every page; rules are (host, path, verdict)."""
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(text).alias("text"))
    counts = cut_lineage(word_counts(parsed, "text"), "words")
    slim = parsed.select("id", "host", "path")
    urls = cut_lineage(slim.select("host", "path").distinct(), "urls")
    bad = F.arrays_overlap("words", F.array(*map(F.lit, SEEDS)))
    worded = cut_lineage(url_words(urls, counts).withColumn("bad", bad), "worded")
    odds, _, prior = log_odds(worded)
    each = worded.select("host", "path", F.explode("words").alias("word"))
    summed = lookup_join(each, odds, ["word"]).groupBy("host", "path").agg(F.sum("odds").alias("_sum"))
    fits = fitting_rules(urls.select("host").distinct(), rules)
    known = (
        lookup_join(worded.join(summed, ["host", "path"], "left"), fits, ["host"], "left")
        .withColumn("score", F.lit(prior) + F.coalesce("_sum", F.lit(0.0)))
        .withColumn("_rule", F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0)))
        .select("host", "path", "words", "score", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("_by_rule"))
    )
    by_model = F.when(F.col("score") > threshold, "block").otherwise("allow")
    return lookup_join(slim, known, ["host", "path"], "left").select(
        "id", "host", "path", "rule", F.coalesce("_by_rule", by_model).alias("verdict"), "words", "score"
    )
