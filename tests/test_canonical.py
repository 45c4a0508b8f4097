"""Maps as match keys: in the upsert, in distinct, at any depth."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions import canonical
from feedlens.operators import upsert

MAPS = "id int, m map<string,int>, s struct<a:int,n:array<map<int,string>>>, error_message string"


def rows(spark, data):
    return spark.createDataFrame(data, MAPS)


def test_upsert_matches_maps_by_their_entries(spark):
    target = rows(spark, [(1, {"a": 1, "b": None}, (1, [{1: "x", 2: "y"}]), "m1"), (2, None, None, "m1"), (3, {}, (None, None), "m1")])
    source = rows(spark, [(1, {"b": None, "a": 1}, (1, [{2: "y", 1: "x"}]), "m2"), (2, {}, None, "m2"), (2, None, None, "m0"),
                          (3, {}, (None, None), "m1"), (4, {"a": 2}, (1, []), "m3"), (1, {"a": 1}, (1, [{1: "x", 2: "y"}]), "m4")])
    out = upsert.upsert_errors(target, source)
    assert out.schema == source.schema or [f.dataType for f in out.schema] == [f.dataType for f in source.schema]
    got = sorted(((r["id"], r["m"], r["error_message"]) for r in out.collect()), key=repr)
    assert got == sorted([(1, {"a": 1, "b": None}, "m1 | m2"), (1, {"a": 1}, "m4"), (2, None, "m1 | m0"), (2, {}, "m2"), (3, {}, "m1"), (4, {"a": 2}, "m3")], key=repr)


def test_distinct_rows_with_maps(spark):
    df = rows(spark, [(1, {"a": 1, "b": 2}, (1, [{1: "x"}, None]), "e"), (1, {"b": 2, "a": 1}, (1, [{1: "x"}, None]), "e"), (1, None, None, None), (1, None, None, None),
                      (1, {"a": 1, "b": 3}, (1, [{1: "x"}, None]), "e")])
    assert upsert.distinct_rows(df).count() == 3
    assert upsert.distinct_rows(df.limit(0)).count() == 0
    plain = df.select("id", "error_message")
    assert sorted(map(tuple, upsert.distinct_rows(plain).collect()), key=repr) == sorted(map(tuple, plain.distinct().collect()), key=repr)


def test_restore_gives_the_value_back(spark):
    df = rows(spark, [(1, {"b": 2, "a": None}, (1, [{2: "y", 1: None}, {}, None]), "e"), (2, None, None, None), (3, {}, (None, []), "")])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    back = df.select(*[canonical.restore(canonical.canonical(F.col(c), kind), kind).alias(c) for c, kind in kinds.items()])
    assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)
    assert not canonical.has_map(T.ArrayType(T.StringType())) and canonical.has_map(kinds["s"])
