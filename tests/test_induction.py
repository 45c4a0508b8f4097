"""Lexicon induction against a plain count; the rescue's shortcut against the full way; drift of keys."""

import json
import math
import random
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from feedlens import schemas
from feedlens.functions import lexicon as lx
from feedlens.operators import induction, sentiment
from feedlens.plans.queries import KV_SCHEMA, seed_score_series
from feedlens.sources import messages


def test_lexicon_equals_a_plain_count(spark):
    rng = random.Random(4)
    texts = [(k, rng.choice([None, "", "!!", *[" ".join(rng.choices(["good", "Fine", "bad", "worse", "the", "été", "not"], k=rng.randint(1, 6)))] * 9])) for k in range(200)]
    labels = [(k, rng.choice([0, 1, 1, None, 2])) for k, _ in texts] + [(0, 1), (None, 1), (999, 0)]
    texts.append((None, "null ids join nothing"))
    pos, neg, sizes = Counter(), Counter(), Counter()
    by_id = {k: t for k, t in texts if k is not None}
    for k, label in labels:
        if k in by_id and label in (0, 1):
            sizes[label] += 1
            (pos if label else neg).update(set(re.findall(r"[^\W\d_]+", (by_id[k] or "").lower())))
    want = {}
    for w in set(pos) | set(neg):
        if pos[w] + neg[w] >= 3:
            o = math.log((pos[w] + 1) / (sizes[1] + 2)) - math.log((neg[w] + 1) / (sizes[0] + 2))
            milli = math.floor(max(-1, min(1, o / 3)) * 500 + 0.5) * 2
            if abs(milli) >= 100:
                want[w] = milli
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"word": F.lit("clash"), "p": F.lit(1)})
    lexicon = induction.induce_lexicon(df, spark.createDataFrame(labels, "doc_id long, label int"))
    assert {r["word"]: r["pol_milli"] for r in lexicon.collect()} == want and want
    assert all(m % 2 == 0 for m in want.values())
    full = induction.with_modifiers(lexicon)
    kinds = {r["word"]: r["kind"] for r in full.collect()}
    assert kinds["not"] == lx.NEG and full.count() == len(set(kinds))


def test_nothing_is_learnt_from_one_label_or_no_rows(spark):
    texts = spark.createDataFrame([(k, "good day") for k in range(9)], "doc_id long, text string")
    for labels in ([(k, 1) for k in range(9)], []):
        assert induction.induce_lexicon(texts, spark.createDataFrame(labels, "doc_id long, label int")).collect() == []
    assert induction.induce_lexicon(texts.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, label int")).collect() == []


def test_learnt_words_tell_held_out_texts_apart(spark):
    """Texts whose label shows in their words, none of them in the seed list."""
    rng = random.Random(6)
    words = {1: ["zarl", "mip", "quon"], 0: ["brask", "dolt", "fesk"]}
    rows = [(k, label, " ".join(rng.choices(words[label], k=3) + rng.choices(words[1 - label] + ["the", "a"], k=2)))
            for k, label in ((k, rng.randint(0, 1)) for k in range(400))]
    df = spark.createDataFrame(rows, "doc_id long, label int, text string").withColumn("lang", F.lit("xx"))
    train, held = df.filter("doc_id % 2 = 0"), df.filter("doc_id % 2 = 1")
    lexicon = induction.with_modifiers(induction.induce_lexicon(train.drop("label"), train.select("doc_id", "label")))
    scored = sentiment.score_with_lexicon_table(sentiment.score(held, "text", out="seed"), ["doc_id"], lexicon, "text", out="learnt")
    r = induction.agreement(scored, {"seed": "seed", "learnt": "learnt"}).collect()[0]
    assert r["learnt"] > 0.9 * r["n_texts"] > 0.6 * r["n_texts"] > r["seed"]


def test_plugged_scorer_equals_the_expressions(spark):
    rng = random.Random(7)
    vocabulary = [w for w, _, _ in lx.seed_lexicon()] + ["plain", "été", "X1"]
    rows = [(None,), ("",), ("Not very good!",)] + [(" ".join(rng.choices(vocabulary, k=rng.randint(1, 8))),) for _ in range(300)]
    df = spark.createDataFrame(rows, "text string")
    both = sentiment.score(sentiment.score(df, "text", out="a"), "text", out="b", scorer=sentiment.pandas_scorer(seed_score_series))
    assert [r for r in both.collect() if (r["a"] is None) != (r["b"] is None) or (r["a"] is not None and abs(r["a"] - r["b"]) > 1e-12)] == []


JSON = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.integers(2**62, 2**65) | st.floats(allow_nan=False, allow_infinity=False, width=16)
                    | st.sampled_from(["", "x", "5"]), lambda x: st.lists(x, max_size=2) | st.dictionaries(
                        st.sampled_from(["id", "data", "message", "summary", "total_count", "like_count", "zz"]), x, max_size=3), max_leaves=5)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from(["id", "message", "created_time", "likes", "comments", "from", "other"]), JSON, max_size=5), min_size=1, max_size=8))
def test_the_shortcut_never_hides_a_rest(spark, objects):
    """Rows that the type says fit have no rest by the full way either."""
    df = spark.createDataFrame([(json.dumps(o),) for o in objects] + [("not json",), (None,)], "raw string")
    v = F.try_parse_json("raw")
    rest = F.to_json(F.to_variant_object(messages.unmatched(v, F.from_json("raw", schemas.POST), schemas.POST)))
    fits = F.schema_of_variant(v).rlike(f"^{messages.fitting_pattern(schemas.POST)}$")
    assert df.filter(fits & (F.coalesce(rest, F.lit("none")) != "{}")).collect() == []


def test_shortcut_takes_ordinary_posts(spark):
    post = {"id": "1", "created_time": "t", "from": {"id": "u", "name": None}, "message": None, "likes": {"summary": {"total_count": 3}},
            "comments": {"data": [{"id": "c", "like_count": 2, "message": "m"}, {"id": "d", "like_count": None}]}}
    df = spark.createDataFrame([(json.dumps(p),) for p in (post, {**post, "comments": {"data": []}}, {}, {"id": "2", "comments": None})], "raw string")
    assert df.filter(F.schema_of_variant(F.parse_json("raw")).rlike(f"^{messages.fitting_pattern(schemas.POST)}$")).count() == 4


def test_drift_by_day_and_key(spark):
    rows = [("d1", '{"k": 1, "x": "a"}'), ("d1", '{"k": 2, "x": 5}'), ("d2", '{"x": null, "v": [{"u": "t"}]}'), ("d2", "bad"), (None, '{"y": 1}'), ("d3", None)]
    df = messages.rescue(spark.createDataFrame(rows, "day string, raw string"), "raw", KV_SCHEMA, "rescued")
    got = sorted(map(tuple, messages.drift(df).collect()), key=repr)
    assert got == sorted([(None, "y", 1, "BIGINT", None), ("d1", "x", 2, "VARIANT", "d1"), ("d2", "v", 1, "ARRAY<OBJECT<u: STRING>>", "d2"), ("d2", "x", 1, "VOID", "d1")], key=repr)
