"""Lexicon scoring: rules, NULL handling, strategy equivalence, plan shape."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedlens.functions import lexicon as lx
from feedlens.functions.text import words
from feedlens.operators import sentiment
from feedlens.sources import tables as tb

from .conftest import SF_SMALL, plan_text

POL = {w: p for w, p, k in lx.seed_lexicon() if k == lx.POL}
MOD = {w: k for w, _, k in lx.seed_lexicon() if k != lx.POL}


def brute(text):
    """Plain-Python statement of the scoring rule."""
    if text is None:
        return None
    import regex
    ws = regex.findall(r"\p{L}+", text.lower())
    vals = []
    for i, w in enumerate(ws):
        if w not in POL:
            continue
        p = POL[w]
        m = MOD.get(ws[i - 1]) if i > 0 else None
        if m == lx.NEG:
            p = -(p // 2)
        elif m == lx.BOOST:
            p = max(-1000, min(1000, p + p // 2))
        vals.append(p)
    return 0.0 if not vals else float(sum(vals)) / (1000.0 * len(vals))


TEXTS = ["I love it", "not good", "very good", "so bad", "not not good", "Good! BAD.", "",
         None, "nothing here", "idiot", "isn't great", "very terrible and very awful", "love",
         "Très bon, génial", "sehr schlecht"]


def _df(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "k long, text string")


def test_rules_match_brute_force(spark):
    got = {r["k"]: r["s"] for r in sentiment.score(_df(spark), "text", "s").collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == brute(t), t


def test_examples(spark):
    got = {r["text"]: r["s"] for r in sentiment.score(_df(spark), "text", "s").collect()}
    assert got["not good"] == -0.35 and got["very good"] == 1.0
    assert got[""] == 0.0 and got[None] is None and got["nothing here"] == 0.0
    assert got["isn't great"] == -0.4  # "isn't" tokenises to isn / t; t negates


def test_strategies_agree_on_documents(spark):
    docs = tb.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    scorer = sentiment.lexicon_scorer()
    a = sentiment.score(docs, "text", "a")
    b = docs.withColumn("b", scorer(F.col("text")))
    c = sentiment.score_with_lexicon_table(docs, ["doc_id"], sentiment.lexicon_frame(spark), "text", "c")
    j = a.join(b.select("doc_id", "b"), "doc_id").join(c.select("doc_id", "c"), "doc_id")
    bad = j.filter(~(F.col("a").eqNullSafe(F.col("b")) & F.col("a").eqNullSafe(F.col("c"))))
    assert j.count() == docs.count() and bad.count() == 0


def test_table_strategy_by_shuffle(spark):
    docs = tb.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    lex = sentiment.lexicon_frame(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = sentiment.score(docs, "text", "a")
        c = sentiment.score_with_lexicon_table(docs, ["doc_id"], lex, "text", "c")
        assert a.join(c, "doc_id").filter(~F.col("a").eqNullSafe(F.col("c"))).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_pandas_scorer_hook(spark):
    def fn(s: pd.Series) -> pd.Series:
        return s.map(brute)
    scored = sentiment.score(_df(spark), "text", "s", scorer=sentiment.pandas_scorer(fn))
    got = {r["k"]: r["s"] for r in scored.collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == pytest.approx(brute(t)) if t is not None else got[i] is None


def test_lexicon_plan_stays_in_jvm(spark):
    plan = plan_text(sentiment.score(_df(spark), "text", "s"))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_tokens(spark):
    r = spark.range(1).select(words(F.lit("Ça va? L'été, très-bien!")).alias("w")).collect()[0]["w"]
    assert r == ["ça", "va", "l", "été", "très", "bien"]


def test_lexicon_fixed_values_are_well_formed():
    rows = lx.seed_lexicon()
    assert len({w for w, _, _ in rows}) == len(rows)
    assert all(-1000 <= p <= 1000 and p % 2 == 0 for _, p, _ in rows)


def test_scoring_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    _df(spark).write.parquet(src)
    stream = spark.readStream.schema("k long, text string").parquet(src)
    q = (sentiment.score(stream, "text", "s").writeStream.format("memory").queryName("scored_stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["k"]: r["s"] for r in spark.sql("SELECT * FROM scored_stream").collect()}
    assert all(got[i] == brute(t) for i, t in enumerate(TEXTS))


def test_partitions_are_the_callers_choice(spark):
    narrow = _df(spark).coalesce(1)
    assert sentiment.score(narrow, "text", "s").rdd.getNumPartitions() == 1
    assert sentiment.score(narrow, "text", "s", partitions=3).rdd.getNumPartitions() == 3


def test_pandas_scorer_runs_once_under_a_filter(spark):
    scorer = sentiment.pandas_scorer(lambda s: s.map(brute))
    df = sentiment.score(_df(spark), "text", "s", scorer=scorer).filter(F.col("s") > 0)
    plan = plan_text(df, "simple")
    assert plan.count("ArrowEvalPython") == 1
    assert sorted(r["k"] for r in df.collect()) == sorted(i for i, t in enumerate(TEXTS) if (brute(t) or 0) > 0)


def test_conversation_query_with_a_plugged_scorer(spark):
    from feedlens.plans.queries import q_conversation_sentiment
    default = sorted(map(tuple, q_conversation_sentiment(spark, SF_SMALL).collect()))
    plugged = sentiment.pandas_scorer(lambda s: s.map(brute))
    assert sorted(map(tuple, q_conversation_sentiment(spark, SF_SMALL, scorer=plugged).collect())) == default
