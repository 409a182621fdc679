"""What keeps wide rows and users within bounds on larger tables."""

from collections import Counter

import pytest
from conftest import SF_DIR, local_frame

from revmart.operators.hierarchy import manager_chain
from revmart.operators.lineage import stored
from revmart.operators.lookups import Lookup, enrich, estimated_bytes, fits_broadcast, row_bytes, stored_rows
from revmart.plans import opportunities, registrations
from revmart.plans.checks import all_rules
from revmart.plans.models import build_models, check_inputs
from revmart.plans.queries import CFG, Frames
from revmart.plans.registrations import UNIFIED_IDS
from revmart.sources import derived
from revmart.sources.catalog import TableStore

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"
PORTAL = (
    "vartopia_registration_id string, vartopia_sf_registration_id string, partner_account_id string, opportunity_id string, "
    "expected_close_date timestamp, is_clone boolean, is_created_by_auto_reg boolean, last_modified_date timestamp, "
    "is_deleted boolean, comments string"
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_portal_rows_meet_their_narrow_survivors(spark):
    """Same rows as ranking the wide rows: ids that are NULL or come twice, keys with ties, lookups that find two rows or none."""
    rows = [
        (f"v{i // 2}" if i % 5 else None, f"R{i % 7}" if i % 3 else " ", f"A{i % 4}" if i % 6 else None, f"O{i % 9}", None,
         (None, True, False)[i % 3], i % 2 == 0, None, i % 11 == 0, f"text {i // 2}")
        for i in range(120)
    ]
    portal = local_frame(spark, rows + rows[:40], PORTAL)
    names = local_frame(spark, [("A1", "one"), ("A1", "uno"), ("A2", "two"), (None, "none")], "account_id string, account_name string")
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    try:
        step = Lookup(names, "partner_account_id", "account_id", {"account_name": "partner_account_name"})
        ours = registrations.enriched_survivors(portal, [step], ["is_clone", "is_created_by_auto_reg", "comments"], False)
        assert "ShuffledHashJoin" in plan_of(ours)
        keys = ["is_clone", "is_created_by_auto_reg"]
        kept = registrations.enriched_survivors(portal, [], keys, False)
        assert Counter(kept.collect()) == Counter(registrations.dedupe_portal(portal).select(*keys).collect())
        unique = portal.dropDuplicates(["vartopia_registration_id"]).where("vartopia_registration_id IS NOT NULL")
        shown = [*portal.columns, "partner_account_name"]
        found = registrations.enriched_survivors(unique, [step], portal.columns, False).select(shown)
        expected = enrich(registrations.dedupe_portal(unique), [step]).select(shown)
        assert Counter(found.collect()) == Counter(expected.collect())
    finally:
        spark.conf.set(THRESHOLD, before)


def test_survivors_do_not_move_between_their_ranking_and_the_wide_rows(spark):
    """Narrow rows are shuffled by their key once, looked-up values come to them, and together they move once more."""
    portal = local_frame(spark, [(f"v{i}", None, f"A{i % 4}", f"O{i}", None, None, None, None, False, "x") for i in range(40)], PORTAL)
    accounts = local_frame(spark, [("A1", "one"), ("A2", "two")], "account_id string, account_name string")
    names = [Lookup(accounts, fk, "account_id", {"account_name": f"name_{fk}"}) for fk in ("partner_account_id", "opportunity_id")]
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    try:
        ours = registrations.enriched_survivors(portal, names, ["comments"], False)
        assert ours.count() == 40 and ours.where("name_partner_account_id = 'one'").count() == 10
        ours = registrations.enriched_survivors(portal, names, ["comments"], False)
        ours.collect()
        plan = plan_of(ours).split("== Initial Plan ==")[0]
        moved = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
        # The ranking's, two of one lookup (references, side), the values found, the survivors' and the wide rows'.
        assert len(moved) == 6 and plan.count("ReusedExchange") == 1
    finally:
        spark.conf.set(THRESHOLD, before)


def exchanged(node):
    """Names of the columns of every shuffle of a plan that has not run yet."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return exchanged(node.executedPlan())
    own = [{node.output().apply(i).name() for i in range(node.output().size())}] if node.nodeName() == "Exchange" else []
    return own + [x for i in range(node.children().size()) for x in exchanged(node.children().apply(i))]


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_wide_portal_rows_put_aside_by_their_key_are_not_shuffled(spark, tmp_path, kind):
    """A stored build writes them into buckets; same rows as without, also of ids that are NULL or come twice and of lookups that find two rows."""
    rows = [
        (f"v{i // 2}" if i % 5 else None, f"R{i % 7}" if i % 3 else " ", f"A{i % 4}" if i % 6 else None, f"O{i % 9}", None,
         (None, True, False)[i % 3], i % 2 == 0, None, i % 11 == 0, f"text {i // 2}")
        for i in range(120)
    ]
    portal = local_frame(spark, rows + rows[:40], PORTAL)
    side = local_frame(spark, [("A1", "one"), ("A1", "uno"), ("A2", "two"), ("O3", "three")], "account_id string, account_name string")
    names = [Lookup(side, fk, "account_id", {"account_name": f"name_{fk}"}) for fk in ("partner_account_id", "opportunity_id")]
    store = TableStore(base_path=str(tmp_path / "out")) if kind == "folder" else TableStore(namespace="default")
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    try:
        with store.staging() as stage:
            keys = ["is_clone", "is_created_by_auto_reg"]
            kept = registrations.staged_survivors(portal, names[1:], keys, False, stage).select(keys)
            assert Counter(kept.collect()) == Counter(registrations.dedupe_portal(portal).select(*keys).collect())
            unique = portal.dropDuplicates(["vartopia_registration_id"]).where("vartopia_registration_id IS NOT NULL").localCheckpoint()
            found = registrations.staged_survivors(unique, names, portal.columns, False, stage)
            moved = exchanged(found._jdf.queryExecution().executedPlan())
            assert moved and not any("comments" in x for x in moved)
            expected = enrich(registrations.dedupe_portal(unique), names).select(found.columns)
            assert Counter(found.collect()) == Counter(expected.collect())
        assert not list(tmp_path.glob("out/*")) and not [t for t in spark.catalog.listTables() if t.name.startswith("staged_")]
        folded = exchanged(enrich(unique, names, ["vartopia_registration_id"])._jdf.queryExecution().executedPlan())
        assert any("comments" in x for x in folded)
    finally:
        spark.conf.set(THRESHOLD, before)


def test_stored_portal_registrations_are_put_aside(spark, tmp_path, monkeypatch):
    """The stored mart's wide rows cross no shuffle but that of the test table they are derived from."""
    wide, rebuild = {}, TableStore.rebuild

    def watched(self, df, name, *args, **kwargs):
        wide[name] = max([len(x) for x in exchanged(df._jdf.queryExecution().executedPlan())], default=0)
        return rebuild(self, df, name, *args, **kwargs)

    monkeypatch.setattr(TableStore, "rebuild", watched)
    before = spark.conf.get(THRESHOLD)
    try:
        frames = Frames(spark, SF_DIR)
        spark.conf.set(THRESHOLD, "-1")
        name = "dim_vartopia_deal_registration"
        built = build_models(frames.inputs, CFG, only=[name], store=TableStore(base_path=str(tmp_path / "out")))[name]
        assert 0 < wide[name] < 20 < len(built.columns)
        assert Counter(built.collect()) == Counter(frames[name].select(built.columns).collect())
    finally:
        spark.conf.set(THRESHOLD, before)


def test_checks_put_the_portal_rows_aside(spark, tmp_path):
    """A report that keeps the portal mart ranks and meets its rows where they lie; the same report, and nothing is left behind."""
    frames, rules = Frames(spark, SF_DIR), [r for r in all_rules(CFG) if r.model in UNIFIED_IDS or r.model == "dim_unified_deal_registration"]
    moved = []

    def keep(df):
        moved.append((len(df.columns), exchanged(df._jdf.queryExecution().executedPlan())))
        return stored(df)

    before = spark.conf.get(THRESHOLD)
    try:
        spark.conf.set(THRESHOLD, "-1")
        report = check_inputs(frames.inputs, CFG, rules, keep=keep, scratch=TableStore(base_path=str(tmp_path / "aside")))
        assert not list(tmp_path.glob("aside/*")) and max(n for n, _ in moved) > 8
        portal = [x for n, found in moved for x in found if "_mark" in x or "_first_key" in x]
        assert portal and not any("vartopia_registration_id" in x for x in portal)
        assert Counter(report.collect()) == Counter(check_inputs(frames.inputs, CFG, rules, keep=stored).collect())
    finally:
        spark.conf.set(THRESHOLD, before)


def test_values_found_in_place_give_the_rows_of_joins(spark):
    facts = local_frame(spark, [(f"k{i}", None if i % 5 == 0 else f"a{i % 3}", f"a{i % 7}") for i in range(30)], "k string, x string, y string")
    facts = facts.unionByName(facts.limit(3)).unionByName(facts.limit(4).selectExpr("k", "y AS x", "x AS y"))  # keys that come twice
    side = local_frame(spark, [("a1", "one"), ("a1", "uno"), ("a2", "two"), (None, "none")], "id string, name string")
    steps = [Lookup(side, fk, "id", {"name": f"name_{fk}"}) for fk in ("x", "y")]
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    try:
        found = enrich(facts, steps, ["k"], in_place=True)
        assert Counter(found.collect()) == Counter(enrich(facts, steps).collect())
    finally:
        spark.conf.set(THRESHOLD, before)


def test_wide_opportunities_move_once_and_unsorted(spark):
    """Rollups are found for narrow rows, too: ids that are NULL or come twice keep their own references."""
    frames = Frames(spark, SF_DIR)
    inputs = [frames[n] for n in ("opportunity_field_history", "dim_task", "dim_vc_value_proposition", "dim_address", "dim_account", "recordtype", "int_people")]
    few = frames["opportunity"].where("is_current").limit(60)
    blank = few.limit(5).drop("opportunity_id").selectExpr("CAST(NULL AS STRING) AS opportunity_id", "*")
    odd = few.unionByName(few.limit(20)).unionByName(blank).localCheckpoint()
    keys = ["opportunity_id", "opportunity_owner_name", *opportunities.HISTORY_COLUMNS, *opportunities.COVERAGE_COLUMNS]
    before = spark.conf.get(THRESHOLD)
    try:
        spark.conf.set(THRESHOLD, "1g")
        expected = opportunities.build_dim_opportunity(odd, *inputs, CFG).select(keys).collect()
        spark.conf.set(THRESHOLD, "-1")
        ours = opportunities.build_dim_opportunity(odd, *inputs, CFG)
        plan = plan_of(ours)
        wide = [x for x in plan.split("\n") if "SortMergeJoin" in x and "opportunity_id" in x]
        assert "ShuffledHashJoin" in plan and not wide
        assert len(expected) == odd.count() and Counter(ours.select(keys).collect()) == Counter(expected)
    finally:
        spark.conf.set(THRESHOLD, before)


def test_larger_tables_are_widened_in_more_tasks(spark, monkeypatch):
    table = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    monkeypatch.setattr(derived, "SPREAD_FROM", 0)
    monkeypatch.setattr(derived, "SPREAD_PART", estimated_bytes(table) // 50)
    spread = derived.spread(table)
    assert spread.rdd.getNumPartitions() >= 50 > spark.sparkContext.defaultParallelism
    assert spread.count() == table.count()


def test_sides_are_broadcast_by_their_rows_too(spark, tmp_path):
    """Files of rows that compress well hold more than their bytes suggest; such a side is shuffled, and the rows stay the same."""
    names = spark.range(200_000).selectExpr("CAST(id AS STRING) AS id", "'the same long name for every one of them' AS name")
    names.sort("id").repartitionByRange(100, "id").write.parquet(str(tmp_path / "names"))
    side = spark.read.parquet(str(tmp_path / "names"))
    facts = local_frame(spark, [(f"k{i}", str(i * 7), str(i * 11)) for i in range(30)], "k string, x string, y string")
    steps = [Lookup(side, fk, "id", {"name": f"name_{fk}"}) for fk in ("x", "y")]
    before = spark.conf.get(THRESHOLD)
    try:
        spark.conf.set(THRESHOLD, str(4 * 3 * estimated_bytes(side, "id", "name")))
        assert abs(stored_rows(side) - 200_000) < 20_000 and row_bytes(side) == 72
        assert fits_broadcast(side.limit(5), ["id", "name"]) is False  # a limit does not tell how many rows there are
        assert not fits_broadcast(side, ["id", "name"]) and fits_broadcast(local_frame(spark, [("a",)], "a string"))
        plans = [plan_of(enrich(facts, some, ["k"])) for some in (steps[:1], steps)]
        assert all("SortMergeJoin" in x for x in plans)
        shuffled = enrich(facts, steps, ["k"]).collect()
        spark.conf.set(THRESHOLD, "1g")
        assert fits_broadcast(side, ["id", "name"]) and Counter(enrich(facts, steps, ["k"]).collect()) == Counter(shuffled)
        spark.range(10).write.json(str(tmp_path / "other"))
        assert stored_rows(spark.read.json(str(tmp_path / "other"))) is None
    finally:
        spark.conf.set(THRESHOLD, before)


def test_users_broadcast_for_every_level_fit_together(spark):
    """Users that fit once, but not once per level, are not broadcast; ended chains and missing managers stay as they are."""
    people = [(f"u{i}", None if i % 10 == 0 else f"u{i // 2}", f"n{i}", f"t{i}") for i in range(1, 400) if i % 17]
    users = local_frame(spark, people, "user_id string, manager_id string, user_name string, title string")
    size = estimated_bytes(users, "manager_id", "user_id", "user_name", "title")
    before = spark.conf.get(THRESHOLD)
    try:
        spark.conf.set(THRESHOLD, str(40 * size))
        by_level = manager_chain(users, 7).collect()
        spark.conf.set(THRESHOLD, str(4 * size))
        chained = manager_chain(users, 7)
        assert "BroadcastHashJoin" not in plan_of(chained)
        assert Counter(chained.select(*by_level[0].asDict()).collect()) == Counter(by_level)
    finally:
        spark.conf.set(THRESHOLD, before)
