"""URL filter: rules first, then host words scored by naive Bayes.

Host names run words together. Each label of a distinct host is split into words by the
Viterbi path of a unigram model, whose counts come from the words of all pages. A
multinomial naive Bayes model then scores host words and path tokens as block or allow.
It learns from the pages that the rules decide, one vote for each host and list of path
tokens, so that busy hosts do not outvote others, and without the tokens that the rules
themselves name and the path segments they look at, which tell the rule and not the page;
and from short lists of words that stand for the two kinds; a listed word starts with
``SEED_VOTES`` votes. Counts are smoothed by one, whatever the number of votes.

Everything is counted over all rows. Hosts and token lists are scored once each and
joined back, so a host with a third of all pages is one row until the last join, which
adaptive execution splits. Nothing is broadcast by hint.

Words of over ``LONGEST_WORD`` characters are not counted; in a host they are split. Urls and
hosts may be of any length: memory grows in proportion to it.

Defined cases: a url that is null or has no "://" has an empty host and path, no rule,
and the verdict of the class prior; a null page text adds no words; equal rows have equal
verdicts; without any page that a rule blocks (or allows) both classes keep their add-one
counts; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.session import materialise

#: (verdict, rule): a host and the start of a path.
RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]
#: Words that stand for unwanted and for wanted pages, where no rule decides.
SEEDS = {
    "block": """adult ads affiliate bet bets betting bingo bitcoin casino cheap click clickbait coupon crack
        crypto dating debt deals escort farm forex free fuck gamble gambling hack hentai jackpot keygen loan
        loans lottery malware nude payday phishing pharma pills piracy poker popup porn prize promo proxy rich
        scam sex sexy slots spam spyware stream torrent track tracker tracking viagra virus warez win winner
        xxx""".split(),
    "allow": """academy archive article blog book books college community docs edu education encyclopedia
        forum gov guide health help history journal lab library magazine museum news paper research school
        science study university weather wiki""".split(),
}
#: Votes that a listed word starts with; what is learned can outvote them.
SEED_VOTES = 50.0
#: Added to each token's count in both classes.
SMOOTHING = 1.0
#: Log-odds of the posterior from which a page that no rule decides is blocked: 0.95.
BLOCK_FROM = 3.0
#: Characters of the longest word that counts, and that a label is split into at a cost of its own.
LONGEST_WORD = 24
#: Characters of a label whose parts are looked up together.
PIECE = 256


def host_and_path(url: Column) -> tuple[Column, Column]:
    tail = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(tail, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(tail, r"(?s)^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as written, or null."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def path_tokens(path: Column) -> Column:
    """Lower-case words of a path; a run of digits is the token 0."""
    shown = F.regexp_replace(F.lower(path), r"[0-9]+", " 0 ")
    return F.filter(F.split(shown, r"[^\p{L}0]+"), lambda t: t != "")


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n): words of all pages' texts, without markup."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"<[^>]*>", " ")
    return (
        pages.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word"))
        .where((F.col("word") != "") & (F.length("word") <= LONGEST_WORD))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def split_label(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest words of a label; an unknown run costs more with every character."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        options = []
        for begin in range(max(0, end - LONGEST_WORD), end):
            word = label[begin:end]
            n = counts.get(word)
            # an unknown word of k characters: under one count, and less for each character
            cost = math.log(total / n) if n else math.log(total + 1) + 2.3 * len(word)
            options.append((best[begin][0] + cost, begin))
        best.append(min(options))
    words, end = [], len(label)
    while end:
        begin = best[end][1]
        words.append(label[begin:end])
        end = begin
    return words[::-1]


def segment_labels(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words): distinct labels split along their Viterbi paths."""
    total = counts.agg(F.sum("n").alias("n")).first().n or 1

    # a listed word is known to the splitting even where no page holds it
    listed = {w: max(1, total // 10_000) for words in SEEDS.values() for w in words}

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            rows = batch.to_pylist()
            words = [
                split_label(r["label"], listed | {k["word"]: k["n"] for k in r["known"] or ()}, total)
                for r in rows
            ]
            yield pa.RecordBatch.from_pydict(
                {"label": batch.column(0), "words": pa.array(words, pa.list_(pa.string()))}
            )

    labels = labels.select(F.monotonically_increasing_id().alias("id"), "label")
    labels = materialise(labels, "labels")
    # rows carry a number and a piece, never the label, so they grow in proportion to its length;
    # pieces overlap by the longest word
    begin = F.explode(F.sequence(F.lit(1), F.length("label"), F.lit(PIECE)))
    pieces = labels.select("id", "label", begin.alias("at")).select(
        "id", F.substring("label", F.col("at"), F.lit(PIECE + LONGEST_WORD - 1)).alias("piece")
    )
    places = F.explode(F.sequence(F.lit(1), F.least(F.lit(PIECE), F.length("piece"))))
    parts = pieces.select("id", "piece", places.alias("at")).select(
        "id",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("piece") - F.col("at") + 1)),
                lambda n: F.substring(F.col("piece"), F.col("at"), n),
            )
        ).alias("word"),
    )
    known = (
        parts.distinct()
        .join(counts, "word")
        .groupBy("id")
        .agg(F.collect_list(F.struct("word", "n")).alias("known"))
    )
    return labels.join(known, "id", "left").select("label", "known").mapInArrow(
        run, "label string, words array<string>"
    )


def _token_weights(tokens: DataFrame, rules) -> DataFrame:
    """(token, weight): log-likelihood ratio of block to allow, from (token, block, allow) counts."""
    named = {f"host:{w}" for _, r in rules for w in r.partition("/")[0].split(".")}
    named |= {f"path:{w}" for _, r in rules for w in r.partition("/")[2].split("/") if w}
    counts = tokens.groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
    counts = materialise(counts.where(~F.col("token").isin(sorted(named))), "token-counts")
    total = counts.agg(
        F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count("*").alias("tokens")
    ).first()
    seeds = counts.sparkSession.createDataFrame(
        [
            (f"{place}:{word}", *[SEED_VOTES * (kind == k) for k in ("block", "allow")])
            for kind, words in SEEDS.items()
            for word in words
            for place in ("host", "path")
        ],
        "token string, block double, allow double",
    )
    every = counts.union(seeds).groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
    size = SMOOTHING * (total.tokens + sum(map(len, SEEDS.values())))
    return every.select(
        "token",
        (
            F.log((F.col("block") + SMOOTHING) / float((total.block or 0) + size))
            - F.log((F.col("allow") + SMOOTHING) / float((total.allow or 0) + size))
        ).alias("weight"),
    )


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page.

    ``score`` is the log-odds of block against allow; where no rule fits, a score of
    ``BLOCK_FROM`` or more blocks.
    """
    verdicts = {rule: verdict for verdict, rule in rules}
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    # the token list without numbers stands for the path; "/" marks tokens where rules look
    depth = max((len([w for w in r.partition("/")[2].split("/") if w]) for r in verdicts), default=0)
    lead = F.regexp_extract("path", rf"^((?:/+[^/]*){{0,{depth}}})", 1)
    rest = F.expr("substring(path, length(lead) + 1)")
    marked = F.transform(path_tokens(F.col("lead")), lambda t: F.concat(F.lit("/"), t))
    rows = rows.withColumn("lead", lead).withColumn(
        "shape", F.array_join(F.concat(marked, path_tokens(rest)), " ")
    ).drop("lead")
    rows = materialise(rows.withColumn("given", by_rule), "urls")

    votes = rows.groupBy("host", "shape").agg(
        F.max((F.col("given") == "block").cast("int")).alias("block"),
        F.max((F.col("given") == "allow").cast("int")).alias("allow"),
    )
    votes = materialise(votes.na.fill(0, ["block", "allow"]), "votes")
    sums = [F.sum("block").alias("block"), F.sum("allow").alias("allow")]

    def numbered(key: str) -> DataFrame:
        """Tokens carry the number of a host or token list, whose text may be long."""
        found = votes.groupBy(key).agg(*sums)
        return materialise(found.withColumn("id", F.monotonically_increasing_id()), f"{key}s")

    hosts, shapes = numbered("host"), numbered("shape")
    judged = votes.agg(*sums).first()
    cast = ((judged.block or 0), (judged.allow or 0))

    host_labels = hosts.select(
        "id", "block", "allow", F.explode(F.split("host", r"[^\p{L}]+")).alias("label")
    ).where("label <> ''")
    words = segment_labels(host_labels.select("label").distinct(), word_counts(pages))
    words = materialise(words, "host-words")
    host_tokens = host_labels.join(words, "label").select(
        "id", "block", "allow", F.explode("words").alias("word")
    ).select("id", "block", "allow", F.concat(F.lit("host:"), "word").alias("token"))
    shape_tokens = shapes.select(
        "id", "block", "allow", F.explode(F.split("shape", " ")).alias("word")
    ).where("word <> ''").select(
        "id",
        *[F.when(F.col("word").startswith("/"), 0).otherwise(F.col(k)).alias(k) for k in ("block", "allow")],
        F.concat(F.lit("path:"), F.ltrim("word", F.lit("/"))).alias("token"),
    )
    columns = ["token", "block", "allow"]
    weights = materialise(_token_weights(host_tokens.select(columns).union(shape_tokens.select(columns)), rules), "weights")

    def scored(tokens: DataFrame, of: DataFrame, key: str, name: str) -> DataFrame:
        sums = tokens.join(weights, "token").groupBy("id").agg(F.sum("weight").alias(name))
        return materialise(sums.join(of, "id").select(key, name), "scores")

    prior = math.log((cast[0] + 1) / (cast[1] + 1))
    score = F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0)) + F.lit(prior)
    return (
        rows.join(scored(host_tokens, hosts, "host", "host_score"), "host", "left")
        .join(scored(shape_tokens, shapes, "shape", "path_score"), "shape", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("given", F.when(score >= BLOCK_FROM, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
            score.alias("score"),
        )
    )
