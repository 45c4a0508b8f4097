"""Property checks (hypothesis) on KPI arithmetic and promotion."""

from hypothesis import given, settings
from hypothesis import strategies as st

from feedlens.functions.rules import Rule
from feedlens.operators import quality, reports

scores = st.lists(st.one_of(st.none(), st.floats(-1, 1, allow_nan=False)), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None)
@given(scores)
def test_nps_and_csat_bounds(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "sentiment_score double")
    r = reports.overall_nps(df).collect()[0]
    assert r["promoters"] + r["passives"] + r["detractors"] == r["total_comments"] == len(xs)
    assert -100 <= r["nps"] <= 100
    c = reports.overall_csat(df).collect()[0]
    assert 0 <= c["csat_score"] <= 100


ids = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 20)), st.one_of(st.none(), st.text(max_size=3))),
               min_size=1, max_size=30)


@settings(max_examples=12, deadline=None)
@given(ids)
def test_valid_and_error_ids_cover_the_batch(spark, rows):
    df = spark.createDataFrame(rows, "id int, v string")
    errors = quality.error_rows(df, [Rule(1, "v", "column_null_validation")])
    valid = quality.promote_valid(df, errors, "id")
    batch_ids = {r[0] for r in rows}
    got = {r["id"] for r in valid.collect()} | {r["id"] for r in errors.collect()}
    assert got == batch_ids
    bad_ids = {r[0] for r in rows if r[1] is None and r[0] is not None}
    assert not ({r["id"] for r in valid.collect()} & bad_ids)


msgs = st.sampled_from(["m1", "m2", "m3", "m1 | m2"])
keyed = st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.sampled_from(["x", "y"])), msgs),
                 min_size=1, max_size=12)


@settings(max_examples=5, deadline=None)
@given(keyed, keyed)
def test_upsert_set_semantics(spark, target_rows, source_rows):
    from feedlens.operators import upsert
    schema = "id int, a string, error_message string"
    # a target has one row per key: fold duplicates the way an earlier upsert would
    tgt = upsert.upsert_errors(None, spark.createDataFrame(target_rows, schema))
    src = spark.createDataFrame(source_rows, schema)
    once = upsert.upsert_errors(tgt, src)
    twice = upsert.upsert_errors(once, src)
    before = {(r["id"], r["a"]): r["error_message"] for r in tgt.collect()}
    after = {(r["id"], r["a"]): r["error_message"] for r in once.collect()}
    assert after == {(r["id"], r["a"]): r["error_message"] for r in twice.collect()}
    for key, msg in after.items():
        parts = msg.split(" | ")
        assert len(parts) == len(set(parts))
        old = before[key].split(" | ") if key in before else []
        assert parts[:len(old)] == old  # existing messages keep their order, first
    for i, a, m in source_rows:
        assert set(m.split(" | ")) <= set(after[(i, a)].split(" | "))


from feedlens.functions import lexicon as _lx  # noqa: E402

_ROWS = _lx.seed_lexicon()
_WORDS = ([w for w, _, k in _ROWS if k == _lx.POL][:40] + [w for w, _, k in _ROWS if k != _lx.POL]
          + ["the", "store", "dress", "was", "it", "Good", "NOT", "Très"])
_SEPS = [" ", "  ", ", ", "! ", "'", " - ", "... ", "\n", " 3 "]
texts = st.lists(st.one_of(st.none(), st.lists(st.tuples(st.sampled_from(_WORDS), st.sampled_from(_SEPS)),
                                              max_size=12).map(lambda p: "".join(w + s for w, s in p))),
                 min_size=1, max_size=25)


@settings(max_examples=8, deadline=None)
@given(texts)
def test_scorer_matches_the_rule(spark, batch):
    from feedlens.operators import sentiment
    from tests.test_sentiment import brute
    df = spark.createDataFrame(list(enumerate(batch)), "k long, text string")
    got = {r["k"]: r["s"] for r in sentiment.score(df, "text", "s").collect()}
    for i, t in enumerate(batch):
        assert got[i] == brute(t), t
