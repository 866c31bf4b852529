"""URL filters: rules first, then naive Bayes over segmented host and path tokens.

Host labels and path parts are run together words as often as not. A unigram model
splits them by Viterbi search: the split with the largest product of word
probabilities, where a word that the model doesn't know costs more with each
letter. The words are scored by multinomial naive Bayes.

Both models are learned from the table. Words are counted in the pages' texts. Naive Bayes is trained by distant supervision: a
host that holds one of a few seed words stands for unwanted hosts, every other host
for ordinary ones, and each host counts a token of its name or paths once, however
many pages it has. So words that keep company with the seeds speak against a host,
and words of ordinary hosts for it, whatever the seeds say. Rules aren't evidence:
they tell apart sections of sites, not sites.

Counts cover all rows; the models keep the most frequent words and tokens up to
documented numbers. Judging is one pass over the urls, with nothing shuffled.

Defined results: null urls and urls without ``://`` have an empty host and path;
they fit no rule, teach nothing and are judged by the method on no tokens, which
allows them; repeated rows are each judged; of long urls every token counts; an
empty table teaches nothing, and its model allows every url; other columns pass through, and result
names replace input columns of the same name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import materialise, prepare_workers, read_table, reserved

#: Words whose hosts stand for unwanted ones.
SEEDS = """casino poker jackpot roulette gambling betting lottery adult porn escort hookup webcam viagra cialis pills
pharmacy payday warez keygen torrent malware phishing spam ads popup clickbait replica cheats""".split()
#: How often a seed counts as a word, and as a token of unwanted hosts.
SEED_WORDS, SEED_TOKENS = 100, 1
#: Words of the unigram model and tokens of naive Bayes: the most frequent ones.
MOST_WORDS, MOST_TOKENS = 20_000, 20_000
#: Share of unwanted urls beforehand; tokens that each class has beforehand, spread as in both together.
PRIOR_UNWANTED, PRIOR_TOKENS = 0.1, 20
LONGEST_WORD = 24

#: Rules of the query: verdict by host and path.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}

_TOKEN = re.compile(r"[a-z]+|[0-9]+")
NUMBER = "<number>"


class WordModel:
    """Unigram probabilities and the Viterbi search for the best split."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.total = max(total or sum(counts.values()), 1)
        self._log = {w: log(c / self.total) for w, c in counts.items()}
        self.segment = lru_cache(maxsize=100_000)(self._segment)

    def __reduce__(self):
        return _word_model, (self._log, self.total)

    def cost(self, word: str) -> float:
        """Log probability of a word; one unknown is rarer than any known, and tenfold with each letter."""
        known = self._log.get(word)
        return known if known is not None else -log(self.total) + log(10) * (1 - len(word))

    def _segment(self, name: str) -> tuple[str, ...]:
        """The most probable split of a run of letters into words; of equal ones that
        with the longest last word, and so on to the front."""
        best = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            options = [(best[start][0] + self.cost(name[start:end]), -start) for start in range(max(0, end - LONGEST_WORD), end)]
            score, start = max(options)
            best.append((score, -start))
        words, end = [], len(name)
        while end:
            start = best[end][1]
            words.append(name[start:end])
            end = start
        return tuple(reversed(words))

    def tokens(self, part: str) -> list[str]:
        """Words and numbers of a host or path."""
        return [w for t in _TOKEN.findall(part) for w in ((NUMBER,) if t[0].isdigit() else self.segment(t))]

    def url_tokens(self, host: str, path: str) -> list[str]:
        """Tokens of a url; a host's last label says nothing."""
        return self.tokens(host.rpartition(".")[0]) + self.tokens(path.lower())


def _word_model(logs: dict[str, float], total: int) -> WordModel:
    model = WordModel({}, total)
    model._log = logs
    return model


class UrlModel:
    """Multinomial naive Bayes over a word model's tokens."""

    def __init__(self, words: WordModel, unwanted: dict[str, int], ordinary: dict[str, int]):
        self.words = words
        sizes = [sum(c.values()) for c in (unwanted, ordinary)]
        share = {w: (unwanted.get(w, 0) + ordinary.get(w, 0)) / max(sum(sizes), 1) for w in {*unwanted, *ordinary}}
        likely = [lambda w, c=c, n=n: log((c.get(w, 0) + PRIOR_TOKENS * share[w]) / (n + PRIOR_TOKENS)) for c, n in zip((unwanted, ordinary), sizes)]
        self.odds = {w: likely[0](w) - likely[1](w) for w in share}

    def log_odds(self, host: str, path: str) -> float:
        """Log odds that a url is unwanted; tokens never seen say nothing."""
        return log(PRIOR_UNWANTED / (1 - PRIOR_UNWANTED)) + sum(self.odds.get(w, 0.0) for w in self.words.url_tokens(host, path))


def fit_words(pages: DataFrame, html: str | None = "html", most: int = MOST_WORDS) -> WordModel:
    """Count words of a-z in the pages' texts, and the seeds besides.

    Parts of urls don't count: run together words would become words themselves.
    """
    plain = F.regexp_replace(F.coalesce(F.col(f"`{html}`"), F.lit("")), "(?is)<(script|style)\\b.*?</\\1>|<[^>]*>", " ") if html is not None else F.lit("")
    words = pages.select(F.explode(F.regexp_extract_all(F.lower(plain), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    # Longer ones are no words: Viterbi looks back that far only.
    counted = materialise(words.where(F.length("word") <= LONGEST_WORD).groupBy("word").agg(F.count("*").alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    counts = {r["word"]: r["n"] for r in counted.orderBy(F.desc("n"), "word").limit(most).collect()}
    for seed in SEEDS:
        counts[seed] = counts.get(seed, 0) + SEED_WORDS
    return WordModel(counts, total + SEED_WORDS * len(SEEDS))


def fit_urls(pages: DataFrame, url: str = "url", html: str | None = "html", most: int = MOST_TOKENS) -> UrlModel:
    """Both models, of all the urls and texts of ``pages``."""
    prepare_workers(pages.sparkSession)
    words = fit_words(pages, html)
    seeds = frozenset(SEEDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for u in batch.column(0).to_pylist():
                host, path = split_url(u)
                if host:
                    unwanted = not seeds.isdisjoint(words.tokens(host.rpartition(".")[0]))
                    found.update((host, unwanted, t) for t in words.url_tokens(host, path))
            columns = list(zip(*found)) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), pa.string()))], names=["host", "unwanted", "token"])

    of_host = pages.select(F.col(f"`{url}`")).mapInArrow(run, "host string, unwanted boolean, token string").distinct()
    counted = of_host.groupBy("token").agg(F.count_if("unwanted").alias("unwanted"), F.count_if(~F.col("unwanted")).alias("ordinary"))
    kept = counted.orderBy(F.desc(F.col("unwanted") + F.col("ordinary")), "token").limit(most).collect()
    unwanted, ordinary = Counter({s: SEED_TOKENS for s in SEEDS}), Counter()
    for r in kept:
        unwanted[r["token"]] += r["unwanted"]
        ordinary[r["token"]] += r["ordinary"]
    return UrlModel(words, unwanted, ordinary)


def split_url(url: str | None) -> tuple[str, str]:
    """Host, lower-cased A-Z, and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return host.translate(_LOWER), path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def rules_by_host(rules: dict[str, str]) -> dict[str, list[tuple[str, str, str]]]:
    """Rules of each host as (path, rule, verdict)."""
    table: dict[str, list[tuple[str, str, str]]] = {}
    for rule, verdict in rules.items():
        host, slash, path = rule.partition("/")
        table.setdefault(host, []).append((slash + path, rule, verdict))
    return table


def fitting_rule(table: dict[str, list[tuple[str, str, str]]], host: str, path: str) -> tuple[str | None, str | None]:
    """The longest rule that fits and its verdict; of equal ones that of the longer host."""
    best: tuple[str | None, str | None] = (None, None)
    while host:
        for start, rule, verdict in table.get(host, ()):
            if path.startswith(start) and (best[0] is None or len(rule) > len(best[0])):
                best = (rule, verdict)
        host = host.partition(".")[2]
    return best


def filter_urls(df: DataFrame, rules: dict[str, str], model: UrlModel, url: str = "url") -> DataFrame:
    """Add host, path, rule and verdict. ``rules`` and ``model`` go to the workers with the plan."""
    prepare_workers(df.sparkSession)
    names = ("host", "path", "rule", "verdict")
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    width = len(kept)
    source = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{url}`").alias(reserved(df, "url")["url"]))
    table = rules_by_host(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for u in batch.column(width).to_pylist():
                host, path = split_url(u)
                rule, verdict = fitting_rule(table, host, path)
                rows.append((host, path, rule, verdict or ("block" if model.log_odds(host, path) > 0 else "allow")))
            made = [pa.array([r[k] for r in rows], pa.string()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(width)], *made], names=[f.name for f in kept] + list(names))

    return source.mapInArrow(run, T.StructType([*kept, *[T.StructField(n, T.StringType()) for n in names]]))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return filter_urls(pages.select("page_id", "url"), RULES, fit_urls(pages)).select("page_id", "host", "path", "rule", "verdict")
