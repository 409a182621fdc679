"""Operators on small frames, with broadcast and with shuffled joins."""

import random

import pytest
from conftest import local_frame
from pyspark.sql import functions as F

from revmart.operators.hierarchy import chain_depth, level_column, manager_chain, top_value, with_manager_flag
from revmart.operators.lookups import (
    DuplicateLookupKeyError,
    Lookup,
    check_lookup_keys,
    duplicated_lookup_keys,
    enrich,
    exists_flag,
    fits_broadcast,
    needed,
    value_map,
)
from revmart.operators.rollups import bridged_max, change_rollup, distinct_count_rollup, line_rollup
from revmart.operators.unions import union_sources
from revmart.operators.versions import current, first_per_key, latest_per_key, live


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def no_broadcast(spark):
    """Force shuffled joins."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- versions ---------------------------------------------------------------------------


def test_live_strict_and_lenient(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_deleted boolean")
    assert rows(live(df).select("id")) == [(2,)]
    assert rows(live(df, keep_unknown=True).select("id")) == [(2,), (3,)]


def test_current_drops_unknown(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_current boolean")
    assert rows(current(df).select("id")) == [(1,)]


def test_latest_per_key_ties_are_settled_by_content(spark):
    data = [("q", 1, None, "a"), ("q", 2, 5, "b"), ("q", 2, 5, "c"), ("q", None, 9, "z"), ("r", None, None, "d")]
    expected, found = [("q", "c"), ("r", "d")], []
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, m int, c int, v string").repartition(3)
        found.append(rows(latest_per_key(df, "k", ("m", "c")).select("k", "v")))
        assert "named_struct" not in plan_of(latest_per_key(df, "k", ("m", "c")))
    assert found[0] == found[1] == found[2] and found[0][0][1] in ("b", "c") and found[0][1] == ("r", "d")
    assert rows(latest_per_key(df, "k", ("m", "c"), tie="v").select("k", "v")) == expected


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(first_per_key(df, [F.col("k")], [F.col("id")]))
    assert plan.count("WindowGroupLimit") == 2


# --- lookups ----------------------------------------------------------------------------


def skewed_fact(spark):
    """A third NULL, a third one hot key, the rest spread; some keys without a match."""
    return spark.range(300).select(
        F.concat(F.lit("row"), F.col("id")).alias("row_id"),
        F.when(F.col("id") % 3 == 1, "hot")
        .when(F.col("id") % 3 == 2, F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))
        .alias("fk"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise("k5").alias("other_fk"),
    )


def dimension(spark):
    return local_frame(
        spark, [("hot", "Hot"), ("k2", "Two"), ("k5", "Five"), ("k8", None), ("unused", "U"), (None, "Nobody")],
        "pk string, name string",
    )


def both_lookups(spark):
    dim = dimension(spark)
    return enrich(
        skewed_fact(spark),
        [Lookup(dim, "fk", "pk", {"name": "first"}), Lookup(dim, "other_fk", "pk", {"name": "second"})],
    )


def expected_lookups(spark):
    names = {r.pk: r.name for r in dimension(spark).collect() if r.pk is not None}
    return sorted(
        ((r.row_id, r.fk, r.other_fk, names.get(r.fk), names.get(r.other_fk)) for r in skewed_fact(spark).collect()),
        key=repr,
    )


def test_small_lookup_is_broadcast(spark):
    df = both_lookups(spark)
    assert plan_of(df).count("BroadcastHashJoin") == 2
    assert df.columns == ["row_id", "fk", "other_fk", "first", "second"]
    assert rows(df) == expected_lookups(spark)


def test_large_lookup_gives_the_same_rows(spark, no_broadcast):
    df = both_lookups(spark)
    assert df.columns == ["row_id", "fk", "other_fk", "first", "second"]
    assert rows(df) == expected_lookups(spark)
    assert "SortMergeJoin" in plan_of(df)


def test_duplicated_lookup_keys_are_reported(spark):
    twice = dimension(spark).union(local_frame(spark, [("k2", "Again"), (None, "None")], "pk string, name string"))
    sound = Lookup(dimension(spark), "other_fk", "pk", {"name": "second"})
    lookups = {"a": Lookup(twice, "fk", "pk", {"name": "first"}), "b": sound}
    assert rows(duplicated_lookup_keys(lookups)) == [("a", "k2", 2)]
    assert plan_of(duplicated_lookup_keys(lookups)).count("Exchange hashpartitioning") == 1
    check_lookup_keys({"b": sound})
    with pytest.raises(DuplicateLookupKeyError, match=r"a: k2 \(2 rows\)"):
        check_lookup_keys(lookups)


def roles_fact(spark):
    """Rows with five references into two frames, some keys missing or repeated, some references without a match."""
    key = F.when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("row"), F.col("id") % 250))
    code = lambda n, m: F.when(F.col("id") % m != 0, F.concat(F.lit("k"), (F.col("id") * n % 13).cast("string")))
    fact = spark.range(300).select(
        key.alias("row_id"), *[code(n, n + 2).alias(f"fk{n}") for n in range(1, 5)], F.lit("hot").alias("fk5"), F.col("id").alias("payload")
    )
    return fact.unionAll(fact.where("payload < 20"))  # repeated rows


def role_steps(spark):
    names = local_frame(
        spark, [(f"k{i}", f"Name {i}", i) for i in range(9)] + [("hot", "Hot", 99), ("k3", "Third again", 33), (None, "Nobody", 0)],
        "pk string, name string, size int",
    )
    other = local_frame(spark, [(f"k{i}", f"Other {i}") for i in range(5)], "code string, label string")
    return [
        Lookup(names, "fk1", "pk", {"name": "first_name", "size": "first_size"}),
        Lookup(names, "fk2", "pk", {"name": "second_name"}),
        Lookup(other, "fk3", "code", {"label": "third_label"}),
        Lookup(names, "fk4", "pk", {"size": "fourth_size"}),
        Lookup(names, "fk5", "pk", {"name": "fifth_name"}),
        Lookup(other, "third_label", "label", {"code": "back_again"}),
    ]


def test_unfolded_lookups_give_the_rows_of_joins(spark, no_broadcast):
    """Repeated lookup keys multiply rows, repeated and missing row keys keep their own references."""
    fact, steps = roles_fact(spark), role_steps(spark)
    plain = enrich(fact, steps)
    unfolded = enrich(fact, steps, ["row_id"])
    assert unfolded.columns == plain.columns and unfolded.schema.simpleString() == plain.schema.simpleString()
    assert rows(unfolded) == rows(plain) and len(rows(plain)) > 320
    assert rows(enrich(fact, steps, ["row_id", "payload"])) == rows(plain)


def test_unfolded_lookups_move_the_wide_row_once(spark, no_broadcast):
    fact, steps = roles_fact(spark), role_steps(spark)[:5]
    moved = lambda df: [x for x in plan_of(df).split("\n") if "Exchange hashpartitioning" in x]
    assert plan_of(enrich(fact, steps)).count("SortMergeJoin") == 5 and len(moved(enrich(fact, steps))) == 10
    plan = enrich(fact, steps, ["row_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2 and plan.count("Join LeftOuter") == 1


def test_guarded_lookups_fail_on_repeated_keys(spark):
    fact, steps = roles_fact(spark), role_steps(spark)
    assert enrich(fact, [steps[2]], guard=True).count() == fact.count()
    with pytest.raises(Exception, match="k3 occurs more than once"):
        enrich(fact, [steps[0]], guard=True).collect()


def test_guarded_shuffled_lookups_fail_without_another_shuffle(spark, no_broadcast):
    fact, steps = roles_fact(spark), role_steps(spark)
    for key in ([], ["row_id"]):
        with pytest.raises(Exception, match="k3 occurs more than once"):
            enrich(fact, steps, key, guard=True).collect()
    count = lambda guard: plan_of(enrich(fact, [steps[2]], guard=guard)).count("Exchange hashpartitioning")
    assert count(True) == count(False) == 2


def test_sizes_are_asked_once(spark, monkeypatch):
    from revmart.operators import lookups

    dim = dimension(spark)
    assert fits_broadcast(dim, ["pk", "name"])
    monkeypatch.setattr(type(dim), "select", None)
    assert lookups.estimated_bytes(dim, "pk", "name") > 0


def test_lookups_that_find_nothing_wanted_are_left_out(spark):
    steps = role_steps(spark)
    assert needed(steps, None) == steps
    assert needed(steps, {"second_name", "payload"}) == [steps[1]]


def check_exists(spark):
    fact = skewed_fact(spark)
    keys = spark.createDataFrame([("hot",), ("hot",), ("k5",), (None,)], "opp string")
    flagged = exists_flag(fact, keys, "fk", "opp", "found")
    assert flagged.count() == 300
    assert {r.fk for r in flagged.where("found").collect()} == {"hot", "k5"}
    assert flagged.where("fk IS NULL AND found").count() == 0


def test_exists_flag_broadcast(spark):
    check_exists(spark)


def test_exists_flag_shuffled(spark, no_broadcast):
    check_exists(spark)


def test_value_map(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "x string")
    assert [r[0] for r in df.select(value_map(F.col("x"), {"a": 1, "b": 2})).collect()] == [1, None, None]


# --- hierarchy --------------------------------------------------------------------------


def people(spark):
    """A chain of ten, a star below its top, a cycle, a self-manager and a missing manager."""
    chain = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(10)]
    star = [(f"s{i}", "c0") for i in range(20)]
    other = [("x", "y"), ("y", "x"), ("self", "self"), ("lost", "gone"), ("below", "lost")]
    data = [(u, m, f"Name {u}", None if u in ("c1", "c4") else f"Title {u}") for u, m in chain + star + other]
    return local_frame(spark, data, "user_id string, manager_id string, user_name string, title string")


def expected_chain(spark, levels):
    by_id = {r.user_id: r for r in people(spark).collect()}
    out = {}
    for user in by_id:
        above, at = [], by_id[user].manager_id
        while len(above) < levels and at in by_id:
            above.append(by_id[at])
            at = by_id[at].manager_id
        out[user] = above
    return out


def check_chain(spark, levels):
    chained = manager_chain(with_manager_flag(people(spark)), levels).select(
        "*",
        chain_depth(levels).alias("depth"),
        top_value("name", levels).alias("top_name"),
        top_value("title", levels).alias("top_title"),
    )
    expected = expected_chain(spark, levels)
    got = chained.collect()
    assert len(got) == len(expected)
    for row in got:
        above = expected[row.user_id]
        assert row.depth == len(above)
        for level in range(1, levels + 1):
            boss = above[level - 1] if level <= len(above) else None
            assert row[level_column(level, "user_id")] == (boss and boss.user_id)
            assert row[level_column(level, "name")] == (boss and boss.user_name)
            assert row[level_column(level, "title")] == (boss and boss.title)
        assert row.top_name == next((b.user_name for b in reversed(above)), None)
        assert row.top_title == next((b.title for b in reversed(above) if b.title), None)


@pytest.mark.parametrize("levels", [1, 7])
def test_manager_chain_broadcast(spark, levels):
    check_chain(spark, levels)


@pytest.mark.parametrize("levels", [1, 2, 5, 7])
def test_manager_chain_shuffled(spark, no_broadcast, levels):
    check_chain(spark, levels)


def test_is_manager(spark):
    flagged = with_manager_flag(people(spark))
    managers = {r.user_id for r in flagged.where("is_manager_flag").collect()}
    assert managers == {f"c{i}" for i in range(9)} | {"x", "y", "self", "lost"}


# --- rollups and unions -----------------------------------------------------------------


def test_change_rollup(spark):
    df = spark.createDataFrame(
        [
            ("o", 1, "CloseDate", "2024-01-01", "2024-02-01", False),
            ("o", 2, "closedate", "2024-02-01", "2024-01-15", None),
            ("o", 3, "CLOSEDATE", "n/a", "2024-03-01", False),
            ("o", 4, "closedate", "2024-05-01", "2024-06-01", True),
            ("o", 5, "StageName", "2024-05-01", "2024-06-01", False),
            ("p", 1, "CloseDate", "2024-01-01", "2024-01-01", False),
            ("p", 1, "CloseDate", "2024-01-09", None, False),
            ("q", 1, None, "2024-01-09", None, False),
        ],
        "opportunity_id string, n int, field_name string, old_value string, new_value string, is_deleted boolean",
    ).withColumn("created_date", F.timestamp_seconds("n"))
    result = change_rollup(df, "closedate").withColumn("prior_value", F.col("prior_value").cast("string"))
    assert rows(result) == [("o", None, 3, 1), ("p", "2024-01-09 00:00:00", 2, 0)]


def test_distinct_count_ignores_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3)], "k string, t int")
    assert rows(distinct_count_rollup(df, "k", "t", "n")) == [("a", 2)]


def test_line_rollup(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", True), ("b", None), ("c", False)], "quote_id string, is_refresh_quote_line boolean"
    )
    assert rows(line_rollup(df)) == [("a", 2, True), ("b", 1, False), ("c", 1, False)]


def check_bridge(spark):
    left = spark.createDataFrame([("m1", "Annual"), ("m2", "Zed"), ("m3", None)], "model string, name string")
    pairs = [("m1", "p1"), ("m2", "p1"), ("m1", "p2"), ("m9", "p3"), ("m3", "p4")] + [("m1", "p5")] * 9
    bridge = spark.createDataFrame(pairs, "m string, product string")
    result = bridged_max(left, "model", bridge, "m", by="product", value="name")
    assert rows(result) == [("p1", "Zed"), ("p2", "Annual"), ("p4", None), ("p5", "Annual")]


def test_bridged_max(spark):
    check_bridge(spark)


def test_bridged_max_shuffled(spark, no_broadcast):
    check_bridge(spark)


def test_union_sources_pads_both_sides(spark):
    a = spark.createDataFrame([("1", True)], "id string, only_a boolean")
    b = spark.createDataFrame([("2", 5)], "id string, only_b int")
    both = union_sources({"A": a, "B": b})
    assert both.schema.simpleString() == "struct<source_system:string,id:string,only_a:boolean,only_b:int>"
    assert rows(both) == [("A", "1", True, None), ("B", "2", None, 5)]
