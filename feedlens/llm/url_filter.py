"""Operator 12: which URLs to keep, by logistic regression on hashed character n-grams of host and path.

Rules come first: a rule allows or blocks a host with all its subdomains below a path prefix, and the longest rule
that fits decides. Other URLs are judged by the regression, trained in numpy from a small labelled table of URLs
(``LABELLED`` unless a caller gives another). Rules are Column expressions; scores are computed in Python tasks, all n-grams
of a batch at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_schema, ship

ALLOW, BLOCK = "allow", "block"

#: (verdict, host, path): the contract's rules.
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)
#: Rules become one CASE expression, so their number is bounded.
MAX_RULES = 500

#: The labelled table: what reads as an article, a manual or a post is allowed; advertising, trackers, shops' machinery, logins, gambling
#: and spam are blocked.
LABELLED = tuple((BLOCK, url) for url in """
http://ads.banner-exchange.example/click?id=1
https://adserver.example.net/banner/468x60.html
https://www.casino-bonus.example/slots/free-spins
http://poker-online.example/bonus/jackpot
https://tracker.example.org/pixel/track.gif
https://analytics.example.io/collect/event
http://cheap-pills.example/buy-viagra-online
https://pharma-discount.example/order/pills
https://shop.example.com/cart/checkout
https://store.example.net/cart/add/8812
https://accounts.example.com/login
https://www.example.org/user/signin.php
https://auth.example.net/login/reset-password
http://free-download-crack.example/keygen.exe
http://warez.example.to/download/crack/setup.exe
https://xxx-videos.example/adult/cams
https://adult-dating.example/sexy/singles
https://win-prize.example/lottery/claim
http://lottery-winner.example/claim-prize-now
https://bet365-odds.example/betting/live
https://sports-betting.example/odds/bonus
http://payday-loan.example/apply/fast-cash
https://quick-cash.example/loan/payday
https://click.mailer.example/unsubscribe/abc
https://link.newsletter.example/click/track/77
http://popup.adnetwork.example/popunder.js
https://cdn.adnetwork.example/ads/banner.js
https://www.example.com/search/results?q=buy
https://www.example.net/tag/page/9999
https://spam-links.example/seo/backlinks
http://buy-followers.example/seo/cheap
https://coupon-deals.example/discount/promo-code
http://promo.example.biz/discount/buy-now
https://redirect.example.com/out.php
https://go.example.net/redirect/affiliate
https://affiliate.example.org/click/offer
https://www.replica-watches.example/buy/rolex
http://replica-bags.example/cheap/outlet
https://crypto-doubler.example/invest/profit
https://forex-signals.example/invest/bonus
https://casino-lucky.example.com/en/4401
https://www.online-casino.example.org/de/120.html
https://royal-casino.example.net/fr/9/
https://best-bets.example.net/es/88
https://m.bets-today.example.com/en/7123#top
https://football-bets.example.org/de/31.html
https://www.pills-store.example.com/en/15
https://discount-pills.example.net/de/2204
https://blog.diet-pills.example.org/en/610/
https://adult-chat.example.com/en/30122
https://www.adult-movies.example.net/es/41.html
https://free-adult.example.org/de/17
https://ads-server.example.com/en/55021
https://m.ads-network.example.org/fr/1200
https://www.mobile-ads.example.net/en/71?page=2
https://track-visitor.example.com/de/902
https://ad-track.example.org/en/46/
https://click-tracker.example.net/es/3307.html
https://free-loans.example.com/en/81
https://cheap-loans.example.org/de/5120#top
https://free-prizes.example.net/en/612
https://cheap-watches.example.com/fr/733
https://win-money.example.org/en/18440
https://jackpot-win.example.com/de/29.html
https://hot-singles.example.net/en/902
https://spam-offers.example.com/es/65
https://free-porn.example.org/en/4
https://xxx-tube.example.com/de/8830
https://poker-win.example.net/en/112
https://slots-free.example.com/fr/57/
""".split()) + tuple((ALLOW, url) for url in """
https://en.encyclopedia.example.org/wiki/History_of_printing
https://de.encyclopedia.example.org/wiki/Geschichte
https://blog.example.com/2021/04/writing-tests
https://blog.example.org/en/posts/garden-in-spring
https://news.example.com/world/article/1883
https://www.daily.example.net/news/science/new-telescope
https://docs.example.io/guide/install.html
https://docs.python.example/3/library/functions.html
https://www.university.example.edu/research/papers/1204
https://library.example.edu/archive/manuscripts
https://www.example.org/de/artikel/1022.html
https://www.example.net/en/article/33120
https://example.org/es/noticias/2210
https://m.example.org/en/2126
https://blog.example.net/de/30807.html
https://magazine.example.com/essays/on-reading
https://recipes.example.com/bread/sourdough
https://cooking.example.org/recipes/soup.html
https://forum.example.org/thread/how-to-fix-a-bike
https://questions.example.com/questions/4411/sort-a-list
https://www.museum.example.org/collection/paintings
https://history.example.net/chapters/roman-roads
https://science.example.org/articles/plate-tectonics
https://health.example.gov/topics/sleep
https://www.city.example.gov/services/parks
https://weather.example.gov/forecast/today
https://travel.example.com/guide/lisbon
https://books.example.com/reviews/novel
https://journal.example.org/volume/12/issue/3
https://www.school.example.edu/lessons/algebra
https://opensource.example.dev/project/readme.html
https://www.example.com/about/history
https://music.example.org/lessons/violin
https://www.radio.example.net/program/interview
https://language.example.org/fr/grammaire/verbes
https://nature.example.net/en/birds/heron
https://letters.example.org/1844/letter-to-a-friend
https://www.law.example.gov/statutes/chapter-9
https://astronomy.example.edu/lecture/notes-3.html
https://poems.example.org/en/spring
https://www.riverside.example.com/en/4402
https://oakfield.example.org/de/121.html
https://m.harbour.example.net/fr/10/
https://blog.northern.example.com/es/87
https://maplewood.example.net/en/7124#top
https://www.stonebridge.example.org/de/32.html
https://lantern.example.com/en/16
https://blog.meadow.example.net/de/2205
https://thistle.example.org/en/611/
https://m.weather-notes.example.com/en/30123
https://www.teachers.example.net/es/42.html
https://hillside.example.org/de/18
https://blog.anderson.example.com/en/55022
https://thornton.example.org/fr/1201
https://www.lighthouse.example.net/en/72?page=2
https://other-stories.example.com/de/903
https://m.nation.example.org/en/47/
https://station.example.net/es/3308.html
https://www.weathering.example.com/en/82
https://blog.theatre.example.org/de/5121#top
https://winter.example.net/en/613
https://tradition.example.com/fr/734
https://m.freedom-library.example.org/en/18441
https://www.adelaide.example.com/de/30.html
https://thinking.example.net/en/903
https://blog.better-writing.example.com/es/66
https://readers.example.org/en/5
https://www.shore.example.com/de/8831
https://thousand-words.example.net/en/113
https://ballads.example.com/fr/58/
""".split())


@dataclass(frozen=True)
class Settings:
    """Of the regression; all are parameters of ``fit``."""

    bits: int = 16  # 2 ** bits weights
    lengths: tuple[int, ...] = (3, 4, 5)  # of n-grams
    l2: float = 0.001
    steps: int = 300
    rate: float = 2.0


@dataclass(frozen=True)
class Model:
    settings: Settings
    weights: np.ndarray
    bias: float


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first "://": the host up to "/", "?" or "#" (A-Z lowered), then the path up to "?" or "#". Null or without "://": both empty."""
    after = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, host and path counted together (ties: the longer host, then by name); nulls without one."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def split_url(url: str | None) -> tuple[str, str]:
    """``host_and_path`` of one URL in Python, for the labelled table."""
    _, mark, after = (url or "").partition("://")
    if not mark:
        return "", ""
    before_query = min((k for k in (after.find("?"), after.find("#")) if k >= 0), default=len(after))
    after = after[:before_query]
    host, slash, path = after.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def features(hosts: Sequence[str], paths: Sequence[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of URLs: (URL number, slot) of each, repeats included.

    Every host stands between "^" and "$", every path between "|" and "$", and n-grams of the two never mix. Characters are code points.
    """
    texts = [part for host, path in zip(hosts, paths) for part in (f"^{host}$", f"|{path}$")]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    rows, slots = [], []
    with np.errstate(over="ignore"):
        for n in settings.lengths:
            if len(codes) < n:
                continue
            starts = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1:])
            h = np.full(len(starts), n, dtype=np.uint64) + np.uint64(2) * (owner[starts] & 1).astype(np.uint64) * np.uint64(1 << 32)
            for k in range(n):
                h = (h ^ codes[starts + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(31)
            rows.append(owner[starts] // 2)
            slots.append((h >> np.uint64(64 - settings.bits)).astype(np.int64))
    if not rows:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(rows), np.concatenate(slots)


def scale(rows: np.ndarray, n: int) -> np.ndarray:
    """1 / sqrt(number of n-grams) of each URL, so that long URLs weigh no more than short ones."""
    return 1 / np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))


def probabilities(model: Model, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
    """How likely each URL is to be blocked."""
    rows, slots = features(hosts, paths, model.settings)
    n = len(hosts)
    margin = np.bincount(rows, weights=model.weights[slots], minlength=n) * scale(rows, n) + model.bias
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def loss_and_gradient(weights: np.ndarray, bias: float, rows: np.ndarray, slots: np.ndarray, labels: np.ndarray,
                      l2: float) -> tuple[float, np.ndarray, float]:
    """Mean log loss with an L2 penalty on the weights, and its gradient by weights and bias."""
    n = len(labels)
    size = scale(rows, n)
    margin = np.bincount(rows, weights=weights[slots], minlength=n) * size + bias
    loss = np.mean(np.logaddexp(0, margin) - labels * margin) + l2 / 2 * weights @ weights
    error = (1 / (1 + np.exp(-margin)) - labels) / n
    gradient = np.bincount(slots, weights=(error * size)[rows], minlength=len(weights)) + l2 * weights
    return float(loss), gradient, float(error.sum())


def fit(labelled: Sequence[tuple[str, str]] = LABELLED, settings: Settings = Settings()) -> Model:
    """The regression trained on (verdict, url) rows by gradient descent with momentum; the same rows give the same model.

    The table is small by contract: it is a parameter held on the driver. Without rows of both verdicts every URL is as likely
    to be blocked as the rows say (0.5 without rows).
    """
    hosts, paths = zip(*(split_url(url) for _, url in labelled)) if labelled else ((), ())
    labels = np.array([verdict == BLOCK for verdict, _ in labelled], dtype=np.float64)
    weights, bias = np.zeros(1 << settings.bits), 0.0
    if not len(labels) or labels.min() == labels.max():
        return Model(settings, weights, 0.0 if not len(labels) else 40.0 * (2 * labels[0] - 1))
    rows, slots = features(hosts, paths, settings)
    speed, bias_speed = np.zeros_like(weights), 0.0
    for _ in range(settings.steps):
        _, gradient, bias_gradient = loss_and_gradient(weights, bias, rows, slots, labels, settings.l2)
        speed = 0.9 * speed - settings.rate * 0.1 * gradient
        bias_speed = 0.9 * bias_speed - settings.rate * 0.1 * bias_gradient
        weights, bias = weights + speed, bias + bias_speed
    return Model(settings, weights, bias)


def score(df: DataFrame, model: Model, host_col: str = "host", path_col: str = "path", out: str = "p_block") -> DataFrame:
    """``df`` with the probability of being blocked as one more column; null hosts and paths count as empty."""
    schema = df.withColumn(out, F.lit(0.0)).schema
    if out in df.columns:
        raise ValueError(f"column {out} is there already")
    fields = arrow_schema(schema)
    at_host, at_path = df.columns.index(host_col), df.columns.index(path_col)
    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            hosts = [v or "" for v in batch.column(at_host).to_pylist()]
            paths = [v or "" for v in batch.column(at_path).to_pylist()]
            found = pa.array(probabilities(model, hosts, paths), type=pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], schema=fields)

    return df.mapInArrow(run, schema)


def judge(df: DataFrame, model: Model, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id",
          url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """Every row's host, path, the longest rule that fits (null: none), and the verdict: the rule's, else "block" where the regression gives
    ``threshold`` or more, else "allow". p_block is the regression's probability, also where a rule decides.

    Null URLs and URLs without "://" have an empty host and path, fit no rule and are judged by the regression's bias.
    Repeated rows and null ids stay rows; other columns are ignored. No shuffle.
    """
    host, path = host_and_path(F.col(url_col))
    scored = score(df.select(id_col, host.alias("host"), path.alias("path")), model)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_score = F.when(F.col("p_block") >= threshold, BLOCK).otherwise(ALLOW)
    return scored.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, by_score).alias("verdict"), "p_block")
