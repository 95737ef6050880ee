"""URL verdicts: rules first, else words of the host and path scored by naive Bayes.

Names in a host are split into words by unigram Viterbi, with word counts from the pages' own text.
The Bayes counts come from the URLs that a rule settles. Words and tokens are joined, not broadcast:
both grow with the pages.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.fmindex import words_of
from oreworks.llm.shared import ascii_lower, text_slices
from oreworks.sinks.files import materialize


#: First letters that say which lengths a word may have.
HEAD = 4


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: The rules of the query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark or hash, A-Z lower; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null where none does.

    Of equally long rules the first in alphabetical order counts.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), [-ord(c) for c in r.host + r.path])):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.host + r.path)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _counted(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                counts: Counter[str] = Counter()
                for w, n in Counter(w for t in texts for w in words_of(t)).items():
                    word = w.decode()
                    counts[word if len(word) <= longest else ""] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
                )

    return run


def word_counts(texts: DataFrame, text_col: str, longest: int) -> DataFrame:
    """``(word, n)`` over whole texts: words as in the decontamination operator, counted by task first.

    Words of more than ``longest`` characters can't stand in a name and count together, as an empty word.
    """
    counted = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_counted(longest), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(name: str, arcs: list[tuple[int, int, float]], unknown: float) -> list[str]:
    """The likeliest split of a name into words.

    ``arcs`` are known words as (start, length, log probability). Any other single character costs
    ``unknown``. Ties go to the longer last word.
    """
    best = [0.0] + [-math.inf] * len(name)
    came = [0] * (len(name) + 1)
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, length, p in arcs:
        ending.setdefault(start + length, []).append((start, p))
    for end in range(1, len(name) + 1):
        for start, p in sorted([*ending.get(end, ()), (end - 1, unknown)]):
            if best[start] + p > best[end]:
                best[end], came[end] = best[start] + p, start
    words, end = [], len(name)
    while end:
        words.append(name[came[end] : end])
        end = came[end]
    return words[::-1]


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, arcs, unknown = (c.to_pylist() for c in batch.columns)
        words = [
            viterbi(n, [(a["start"], a["length"], a["p"]) for a in own or []], u)
            for n, own, u in zip(names, arcs, unknown, strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["name", "words"])


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``(name, words)`` for distinct names, split by the word counts.

    From each place of a name only those lengths are tried that words with the same first letters have, so a long name takes
    few substrings a place, however long the longest word is. What is a word is joined to the counts, and the arcs of a name
    are gathered. A character of no known word costs as a word that is ten times rarer than one seen once.
    """
    total = F.lit(float(counts.agg(F.sum("n")).first()[0] or 1))
    starts = names.select("name", F.explode(F.expr("sequence(0, char_length(name) - 1)")).alias("start"))
    rest = F.char_length("name") - F.col("start")
    short = starts.select("name", "start", F.explode(F.sequence(F.lit(1), F.least(rest, F.lit(HEAD - 1)))).alias("length"))
    head = lambda column: F.substring(column, 1, HEAD)
    lengths = counts.select(head("word").alias("head"), F.char_length("word").alias("length")).filter(F.col("length") >= HEAD)
    long = starts.filter(rest >= HEAD).withColumn("head", F.expr(f"substr(name, start + 1, {HEAD})"))
    long = long.join(lengths.distinct(), "head").filter(F.col("length") <= rest).select("name", "start", "length")
    parts = short.unionByName(long).withColumn("word", F.expr("substr(name, start + 1, length)"))
    arcs = parts.join(counts, "word").select("name", F.struct("start", "length", F.log(F.col("n") / total).alias("p")).alias("arc"))
    arcs = arcs.groupBy("name").agg(F.collect_list("arc").alias("arcs"))
    unknown = F.log(F.lit(0.1) / total).alias("unknown")
    return names.join(arcs, "name", "left").select("name", "arcs", unknown).mapInArrow(
        _split, "name string, words array<string>"
    )


def judged(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", rules=RULES
) -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` for every row; the score is null where a rule decides.

    A URL that no rule fits is blocked where its log odds are above zero. Tokens are the words of
    the host's names (parts between dots and hyphens) and those of the path, digits as one sign;
    the model adds one to every count. A null URL, or one without ``://``, has an empty host and path
    and no token, and gets the more frequent verdict; so does every URL where no rule fits any.
    Repeated rows are judged alike, and count once each in the model.
    """
    url = F.col(url_col).cast("string")
    every = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    urls = every.groupBy("host", "path").agg(F.count("*").alias("n"))
    urls = materialize(urls.select("*", name.alias("rule"), verdict.alias("ruled")), "urls")
    parts = F.split("host", r"[.\-]")
    names = urls.select("host").distinct().select(F.explode(F.array_distinct(parts)).alias("name"))
    names = materialize(names.filter("name <> ''").distinct(), "host-names")
    longest = names.agg(F.max(F.char_length("name"))).first()[0] or 0
    words = materialize(segmented(names, materialize(word_counts(pages, text_col, longest), "words")), "names")
    hosts = urls.select("host").distinct().select("host", F.explode(parts).alias("name")).join(words, "name")
    host_tokens = hosts.select("host", F.explode("words").alias("word"))
    host_tokens = host_tokens.groupBy("host", F.concat(F.lit("h:"), "word").alias("token")).agg(F.count("*").alias("times"))
    host_tokens = materialize(host_tokens, "host-tokens")
    # Paths that differ in digits only have the same tokens.
    shape = F.regexp_replace(ascii_lower(F.col("path")), "[0-9]+", "0")
    urls = urls.withColumn("shape", shape)
    path_tokens = urls.select("shape").distinct().select(
        "shape", F.explode(F.split("shape", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")).alias("word")
    )
    path_tokens = path_tokens.filter("word <> ''").groupBy("shape", F.concat(F.lit("p:"), "word").alias("token"))
    path_tokens = path_tokens.agg(F.count("*").alias("times"))

    known = urls.filter("ruled IS NOT NULL")

    def trained(key: str, tokens: DataFrame) -> DataFrame:
        by_key = known.groupBy(key, "ruled").agg(F.sum("n").alias("n"))
        return by_key.join(tokens, key).select("token", "ruled", (F.col("n") * F.col("times")).alias("n"))

    seen = trained("host", host_tokens).unionByName(trained("shape", path_tokens))
    blocked = lambda c: F.sum(F.when(F.col("ruled") == "block", F.col(c)).otherwise(0))
    counts = seen.groupBy("token").agg(blocked("n").alias("block"), F.sum("n").alias("all"))
    counts = materialize(counts.select("token", "block", (F.col("all") - F.col("block")).alias("allow")), "tokens")
    size = counts.agg(F.sum("block").alias("b"), F.sum("allow").alias("a"), F.count("*").alias("v")).first()
    kinds = known.agg(blocked("n").alias("b"), F.sum("n").alias("n")).first()
    n_block, n_allow = kinds.b or 0, (kinds.n or 0) - (kinds.b or 0)
    prior = math.log((n_block + 1) / (n_allow + 1))
    base = math.log(((size.a or 0) + size.v + 1) / ((size.b or 0) + size.v + 1))
    model = counts.select("token", (F.log((F.col("block") + 1) / (F.col("allow") + 1)) + F.lit(base)).alias("odds"))

    def scored(key: str, tokens: DataFrame, name: str) -> DataFrame:
        weighed = tokens.join(model, "token", "left")
        odds = F.coalesce("odds", F.lit(base)) * F.col("times")
        return weighed.groupBy(key).agg(F.sum(odds).alias(name))

    open_urls = urls.join(scored("host", host_tokens, "of_host"), "host", "left")
    open_urls = open_urls.join(scored("shape", path_tokens, "of_path"), "shape", "left")
    score = F.round(F.lit(prior) + F.coalesce("of_host", F.lit(0.0)) + F.coalesce("of_path", F.lit(0.0)), 9)
    found = open_urls.select(
        F.col("host").alias("_h"), F.col("path").alias("_p"), "rule", "ruled",
        F.when(F.col("ruled").isNull(), score).alias("score"),
    )
    verdict = F.coalesce("ruled", F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow")))
    joined = every.join(found, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")))
    return joined.select("id", "host", "path", "rule", verdict.alias("verdict"), "score")
