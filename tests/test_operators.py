import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.operators.dedupe import first_per_key, latest_per_key
from tradewind.operators.lookup import lookup_sk
from tradewind.operators.ranking import average_rank, name_of_largest, ranked, top_k
from tradewind.operators.summaries import fixed_sample, histogram, in_test_set
from tradewind.operators.upsert import assign_keys, ensure_member, insert_missing, upsert_scd1


def test_latest_wins_and_ties_are_repeatable(spark):
    rows = [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", None, "p"), ("b", 1, "q"), ("c", None, "r")]
    for n in (1, 5):
        df = spark.createDataFrame(random.sample(rows, len(rows)), "k string, t int, v string").repartition(n)
        got = {r.k: r.v for r in latest_per_key(df, ["k"], ["t"]).collect()}
        assert got == {"a": "y", "b": "q", "c": "r"}


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y")], "k string, n int, v string")
    assert first_per_key(df, ["k"], ["n"]).first().v == "y"


def test_duplicates_are_pruned_before_the_shuffle(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    latest_per_key(df, ["k"], ["t"]).explain()
    plan = capsys.readouterr().out
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_assigned_keys_are_dense_and_follow_the_base(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), F.col("id")).alias("bk"))
    keys = sorted(r.sk for r in assign_keys(df, "bk", "sk", base=10).collect())
    assert keys == list(range(11, 511))


def dim(spark, rows):
    return spark.createDataFrame(rows, "bk string, city string, zip string")


def test_upsert_keeps_keys_updates_changes_and_never_deletes(spark):
    first = upsert_scd1(None, dim(spark, [("a", "X", None), ("b", "Y", "1"), ("c", "Z", "2")]), "bk", "sk", ["city", "zip"], F.lit("t1"))
    before = {r.bk: r.sk for r in first.collect()}
    source = dim(spark, [("a", "X", "9"), ("b", "Y", "1"), ("d", "W", None)])
    second = upsert_scd1(first, source, "bk", "sk", ["city", "zip"], F.lit("t2"))
    rows = {r.bk: r for r in second.collect()}
    assert {k: rows[k].sk for k in before} == before
    assert rows["a"].zip == "9" and rows["a"].load_timestamp == "t2"
    assert rows["b"].load_timestamp == "t1"
    assert rows["c"].city == "Z" and rows["c"].load_timestamp == "t1"
    assert rows["d"].sk == 4 and rows["d"].load_timestamp == "t2"
    again = upsert_scd1(second, source, "bk", "sk", ["city", "zip"], F.lit("t3"))
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in second.collect()}
    # a value that turns NULL is a change too
    gone = upsert_scd1(second, dim(spark, [("a", "X", None)]), "bk", "sk", ["city", "zip"], F.lit("t4"))
    assert {r.bk: r.zip for r in gone.collect()}["a"] is None


def test_unknown_member_is_added_once(spark):
    base = spark.createDataFrame([(1, "a", "x")], "sk long, bk string, city string")
    row = {"sk": -1, "bk": "UNKNOWN", "city": "UNKNOWN"}
    once = ensure_member(base, "sk", row)
    assert sorted(r.sk for r in ensure_member(once, "sk", row, stored=once).collect()) == [-1, 1]


def test_lookup_miss_gets_default(spark):
    fact = spark.createDataFrame([("a",), ("zz",), (None,)], "code string")
    members = spark.createDataFrame([(7, "a")], "sk long, bk string")
    assert sorted(r.sk for r in lookup_sk(fact, members, "code", "bk", "sk", -1).collect()) == [-1, -1, 7]


def test_insert_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "new"), (2, "y")], "k int, v string")
    assert sorted(map(tuple, insert_missing(a, b, "k").collect())) == [(1, "x"), (2, "y")]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-5, 40), min_size=1, max_size=60))
def test_ranked_equals_brute_force(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v long")
    got = {r.id: r for r in ranked(df, "v", dense="d", rank="r", above="a", share="s").collect()}
    total = sum(values)
    for i, v in enumerate(values):
        larger = sum(x > v for x in values)
        assert (got[i].d, got[i].r) == (len({x for x in values if x > v}) + 1, larger + 1)
        assert got[i].a == larger / len(values)
        assert got[i].s == (sum(x for x in values if x >= v) / total if total else None)


def test_ranked_with_one_value_holding_most_rows(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, 5).otherwise(F.col("id") % 700).cast("long").alias("v"))
    values = [r.v for r in df.collect()]
    got = {r.id: (r.d, r.s) for r in ranked(df, "v", dense="d", share="s").collect()}
    for i in (0, 1999, 2500, 2999):
        down_to = sum(x for x in values if x >= values[i])
        assert got[i] == (len({x for x in values if x > values[i]}) + 1, down_to / sum(values))


def test_ranked_inside_groups(spark):
    """A group with a third of all rows, a null group, nulls and ties, beside brute force."""
    rows = [(i, None if i % 7 == 0 else "hot" if i % 3 else f"g{i % 5}", None if i % 11 == 0 else (i * 37) % 400) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, g string, v long")
    got = {r.id: r for r in ranked(df, "v", ["g"], dense="d", rank="r", above="a", share="s").collect()}
    groups = {}
    for i, g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert got.keys() == {i for i, _, v in rows if v is not None}
    for i, g, v in rows[::13]:
        if v is not None:
            own = groups[g]
            larger = sum(x > v for x in own)
            assert (got[i].d, got[i].r) == (len({x for x in own if x > v}) + 1, larger + 1)
            assert got[i].a == larger / len(own) and got[i].s == sum(x for x in own if x >= v) / sum(own)
    assert ranked(df.where("id < 0"), "v", ["g"], dense="d").count() == 0


def test_top_k_and_argmax_break_ties_by_name(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", None)], "n string, v int")
    assert [r.n for r in top_k(df, "v", 2, ["n"]).collect()] == ["c", "a"]
    assert df.where("n <> 'c'").agg(name_of_largest("n", "v")).first()[0] == "a"


def test_average_rank_shares_ties(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 20.0)], "c int, v double")
    assert {r.c: r.k for r in df.withColumn("k", average_rank("v")).collect()} == {1: 1.5, 2: 1.5, 3: 3.0}
    assert {r.c: r.k for r in df.withColumn("k", average_rank("v", descending=True)).collect()} == {1: 2.5, 2: 2.5, 3: 1.0}


def test_histogram_counts_all_and_puts_the_maximum_last(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 4, 4]], "x double")
    assert sorted(map(tuple, histogram(df, "x", 4).collect())) == [(1, 1), (2, 1), (3, 1), (4, 4)]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [tuple(r) for r in histogram(flat, "x", 5).collect()] == [(1, 2)]


def test_sample_and_split_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    a = {r.k for r in fixed_sample(df, "k", 100).collect()}
    assert a == {r.k for r in fixed_sample(df.repartition(13), "k", 100).collect()} and len(a) == 100
    share = df.where(in_test_set("k")).count() / 1000
    assert 0.15 < share < 0.25
