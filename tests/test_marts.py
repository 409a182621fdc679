"""Invariants of the marts, stored builds, and the shuffled path through whole marts."""

from collections import ChainMap

import pytest
from compare import connect, difference
from conftest import SF_DIR
from dataclasses import replace

from pyspark.sql import functions as F

import __spark_entry__ as entry
from revmart.operators.lineage import cut_lineage, stored
from revmart.operators.quality import ACCEPTED_VALUES, EXPRESSION, NOT_NULL, RowRuleWatch, enforce, passes
from revmart.plans.checks import all_rules, select_rules
from revmart.plans.models import build_models, check_inputs, check_models, lookup_sides, set_aside
from revmart.sources import catalog
from revmart.plans.queries import CFG, Frames
from revmart.plans import quotes
from revmart.plans.reference import accounts, any_record_types, record_types
from revmart.sources.catalog import TableStore, read_inputs


@pytest.fixture(scope="module")
def frames(spark):
    return Frames(spark, SF_DIR)


def test_row_counts(frames):
    legacy, portal = frames["dim_deal_registration"], frames["dim_vartopia_deal_registration"]
    live_legacy = frames["stg_deal_registration"].where("NOT is_deleted").count()
    assert legacy.count() == live_legacy
    assert frames["dim_unified_deal_registration"].count() == live_legacy + portal.count()
    for model, key in (("dim_opportunity", "opportunity_id"), ("dim_product", "product2_id"), ("dim_user", "user_id")):
        df = frames[model]
        assert df.count() == df.select(key).distinct().count() > 0


def test_flags_are_inverse(frames):
    staged = frames["stg_vartopia_deal_registration"]
    assert staged.where("migrated_to_vartopia = is_native_vartopia_registration").count() == 0
    assert staged.select("migrated_to_vartopia").distinct().count() == 2


def test_conforming_adds_no_shuffle(frames):
    plan = frames["dim_deal_registration"]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ENSURE_REQUIREMENTS" not in plan.replace("BroadcastExchange", "")


SHUFFLED = [
    "role_lookup",
    "exists_flag",
    "dim_user",
    "dim_opportunity",
    "dim_product",
    "dim_quote",
    "unified_registration",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_marts_without_broadcast(spark, name):
    """With every lookup shuffled, results stay the same."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with connect(SF_DIR) as con:
            assert difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "Reused" not in x]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(
    ("model", "key"),
    [("dim_deal_registration", "deal_registration_id"), ("dim_vartopia_deal_registration", "vartopia_registration_id")],
)
def test_role_lookups_move_the_wide_row_once(frames, no_broadcast, model, key):
    """Without broadcasting, of all joins only the last one has the published row on a side."""
    plan = frames[model]._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert sum("Join LeftOuter" in x for x in plan) <= 2 and sum("_row_mark" in x and "LeftOuter" in x for x in plan) == 1


def joined_widths(node):
    """Columns of every frame that a join of the optimized plan reads."""
    children = [node.children().apply(i) for i in range(node.children().size())]
    own = [c.output().size() for c in children] if node.nodeName() == "Join" else []
    return own + [w for c in children for w in joined_widths(c)]


@pytest.mark.parametrize("name", ["portal_staging", "portal_registration"])
def test_folded_columns_do_not_move(spark, name):
    """What a result shows as one digest is folded where the row is conformed: no join has the wide rows."""
    df = entry.queries()[name](spark, SF_DIR)
    widths = joined_widths(df._jdf.queryExecution().optimizedPlan())
    assert widths and max(widths) < 30


def test_columns_prune_the_joins_that_supply_others(frames):
    keys = {"dim_unified_deal_registration": {"registration_id", "opportunity_id"}, "dim_user": {"user_id"}, "dim_opportunity": {"opportunity_id"}}
    narrow = build_models(frames.inputs, CFG, only=list(keys), columns=keys)
    for name, columns in keys.items():
        assert set(narrow[name].columns) == columns
        assert "Join" not in narrow[name]._jdf.queryExecution().optimizedPlan().toString()
        full = frames[name].select(*narrow[name].columns)
        assert narrow[name].exceptAll(full).count() == full.exceptAll(narrow[name]).count() == 0
    with pytest.raises(ValueError, match="all their columns"):
        build_models(frames.inputs, CFG, columns=keys, store=TableStore(base_path="/nowhere"))


def test_reference_checks_take_one_shuffle(frames):
    rules = [r for r in all_rules(CFG) if r.kind == "relationships"]
    found = check_inputs(frames.inputs, CFG, rules)
    assert sum("parent#" in x for x in exchanges(found)) == 1
    unique = check_inputs(frames.inputs, CFG, [r for r in all_rules(CFG) if r.kind.startswith("unique")])
    assert sum("rule#" in x for x in exchanges(unique)) == 1


def test_checks_start_no_job(spark, frames):
    spark.sparkContext.setJobGroup("checking", "declaring checks")
    try:
        check_inputs(frames.inputs, CFG)
        tracker = spark.sparkContext.statusTracker()
        stages = [k for i in tracker.getJobIdsForGroup("checking") for k in tracker.getJobInfo(i).stageIds]
        names = {tracker.getStageInfo(k).name.split(" at ")[0] for k in stages}
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert names <= {"parquet"}


def test_marts_that_several_checks_read_are_computed_once(spark, frames):
    """Repeated and missing ids included, the report stays the same; kept marts are read back instead of ranked and joined again."""
    raw = frames.inputs["salesforce_vartopiadrs__registration__c"].where("days_since_approval__c < 3")
    twice = raw.unionAll(raw.where("days_since_approval__c = 1"))
    inputs = ChainMap({"salesforce_vartopiadrs__registration__c": twice.withColumn("id", F.expr("CASE WHEN id LIKE '%-2-%' THEN NULL ELSE id END"))}, frames.inputs)
    rules = [r for r in all_rules(CFG) if "registration" in r.model]
    kept = []

    def keep(df):
        kept.append(df.columns)
        return stored(df)

    ours = check_inputs(inputs, CFG, rules, keep=keep)
    assert sorted("deal_registration_id" in c for c in kept if {"vartopia_registration_id", "deal_registration_id"} & set(c)) == [False, True]
    assert "WindowGroupLimit" not in ours._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, ours.collect())) == sorted(map(str, check_inputs(inputs, CFG, rules).collect()))
    assert passes([r for r in rules if r.model == "dim_unified_deal_registration"])["dim_unified_deal_registration"] == 4


def test_row_rules_are_counted_while_tables_are_written(spark, frames, tmp_path):
    names = ["dim_deal_registration", "dim_user"]
    rules = [r for r in all_rules(CFG) if r.kind in (NOT_NULL, ACCEPTED_VALUES, EXPRESSION) and r.model in names]
    watch = RowRuleWatch(all_rules(CFG))
    models = build_models(frames.inputs, CFG, only=names, store=TableStore(base_path=str(tmp_path / "out")), watch=watch)
    seen = check_models(frames.inputs, models, CFG, rules, watch)
    assert "FileScan" not in seen._jdf.queryExecution().executedPlan().toString()
    plain = check_models(frames.inputs, models, CFG, rules)
    order = lambda df: sorted(map(tuple, df.collect()))
    assert order(seen) == order(plain) and len(rules) > 15


def test_lookup_keys_are_unique_where_models_look(frames):
    sides = lookup_sides(frames.inputs, CFG)
    assert len(sides) == 18 and "dim_user.vp_sales_id" in sides
    guarded = build_models(frames.inputs, replace(CFG, guard_lookups=True), only=["dim_opportunity"])["dim_opportunity"]
    assert guarded.count() == frames["dim_opportunity"].count()


def test_a_build_that_asks_for_it_fails_on_duplicated_keys(spark, frames):
    account = frames["dim_account"]
    inputs = {n: frames.inputs[n] for n in catalog.INPUTS} | {"dim_account": account.unionAll(account.limit(1))}
    cfg = replace(CFG, guard_lookups=True)
    with pytest.raises(Exception, match="occurs more than once"):
        build_models(inputs, cfg, only=["dim_deal_registration"])["dim_deal_registration"].collect()


def test_unreadable_registrations_are_set_aside(spark, frames, tmp_path):
    raw = frames["deal_registration__c"]
    broken = raw.limit(2).withColumn("createddate", F.lit("soon")).withColumn("expiration_date__c", F.lit("32.13.2024"))
    inputs = {n: frames.inputs[n] for n in catalog.INPUTS} | {"deal_registration__c": raw.unionByName(broken)}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        build_models(inputs, CFG, only=["stg_deal_registration"])["stg_deal_registration"].collect()
    cfg = replace(CFG, set_aside=True)
    store = TableStore(base_path=str(tmp_path / "out"))
    staged = build_models(inputs, cfg, only=["stg_deal_registration"], store=store)["stg_deal_registration"]
    assert staged.count() == raw.count()
    aside = store.read("stg_deal_registration_unreadable", "set_aside")
    assert aside.count() == 2 and set(raw.columns) < set(aside.columns)
    reasons = {tuple(v) for r in aside.collect() for v in r.unreadable_values}
    assert reasons == {("created_date", "soon"), ("expiration_date", "32.13.2024")}
    assert set_aside(frames.inputs, cfg)["stg_vartopia_deal_registration"].count() == 0


def test_gold_tables_keep_their_declared_types(spark, frames, tmp_path):
    store = TableStore(base_path=str(tmp_path / "out"))
    drifted = frames["opportunity"].withColumn("created_date", F.col("created_date").cast("string"))
    inputs = {n: frames.inputs[n] for n in catalog.INPUTS} | {"opportunity": drifted}
    with pytest.raises(Exception, match="created_date"):
        build_models(inputs, CFG, only=["dim_opportunity"], store=store)
    assert store.read("dim_opportunity", "gold") is None


def test_quotes_join_stored_buckets_without_a_shuffle(spark, frames, no_broadcast):
    store = TableStore(namespace="default", buckets=4)
    try:
        models = build_models(frames.inputs, CFG, only=["int_latest_quote", "int_quote_lines"], store=store)
        joined = models["int_latest_quote"].join(models["int_quote_lines"], "quote_id", "left")
        assert not exchanges(joined) and joined.count() == models["int_latest_quote"].count()
        lazy = quotes.build_dim_quote(
            models["int_latest_quote"], frames["sbqq__quote__c"], models["int_quote_lines"], frames["recordtype"], CFG
        )
        assert not [x for x in exchanges(lazy) if "quote_id" in x]
        dim = build_models(frames.inputs, CFG, only=["dim_quote_unified"], store=store)["dim_quote_unified"]
        assert dim.count() == frames["dim_quote_unified"].count()
    finally:
        for name in ("int_latest_quote", "int_quote_lines", "dim_quote_unified"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_catalog_tables_survive_a_failed_write(spark):
    store = TableStore(namespace="default")
    try:
        for n in (3, 4):
            assert store.rebuild(spark.range(n), "swapped", "gold", bucket_by=["id"]).count() == n
        with pytest.raises(Exception):
            store.rebuild(spark.range(3).select(F.raise_error(F.lit("stop")).alias("id")), "swapped", "gold")
        assert spark.table("swapped").count() == 4
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith("swapped")] == ["swapped"]
    finally:
        spark.sql("DROP TABLE IF EXISTS swapped")


class FakeFolders:
    """A file system whose renames fail in a chosen way: ``false`` answers, errors, or renames that only claim to be done."""

    def __init__(self, folders, fails_on, how):
        self.folders, self.fails_on, self.how = dict(folders), fails_on, how

    def exists(self, path):
        return path in self.folders

    def delete(self, path, recursive):
        return self.folders.pop(path, None) is not None

    def rename(self, source, target):
        if (source, target) == self.fails_on:
            if self.how == "error":
                raise OSError("no")
            return self.how == "claims"
        self.folders[target] = self.folders.pop(source)
        return True


@pytest.mark.parametrize("how", ["false", "error", "claims"])
@pytest.mark.parametrize("fails_on", [("table", "old"), ("new", "table")])
def test_a_failed_swap_keeps_the_old_table(how, fails_on):
    fs = FakeFolders({"table": 1, "new": 2}, fails_on, how)
    with pytest.raises((catalog.SwapError, OSError)):
        catalog.swap(fs, "new", "table", "old")
    assert fs.folders.get("table") == 1


def test_swaps(spark):
    fs = FakeFolders({"table": 1, "new": 2}, None, "")
    catalog.swap(fs, "new", "table", "old")
    assert fs.folders == {"table": 2}
    fs = FakeFolders({"new": 2}, None, "")
    catalog.swap(fs, "new", "table", "old")
    assert fs.folders == {"table": 2}
    fs = FakeFolders({"new": 2}, ("new", "table"), "false")
    with pytest.raises(catalog.SwapError):
        catalog.swap(fs, "new", "table", "old")


def test_store_rebuilds_and_reads_back(spark, frames, tmp_path):
    names = ["dim_unified_deal_registration", "fct_quote_unified"]
    store = TableStore(base_path=str(tmp_path / "out"))
    lazy = build_models(frames.inputs, CFG, only=names)
    for _ in range(2):
        stored = build_models(frames.inputs, CFG, only=names, store=store)
    assert (tmp_path / "out" / "gold" / "dim_vartopia_deal_registration").is_dir()
    assert (tmp_path / "out" / "intermediate" / "int_latest_quote").is_dir()
    for name in names:
        assert stored[name].schema.simpleString() == lazy[name].schema.simpleString()
        assert stored[name].exceptAll(lazy[name]).count() == lazy[name].exceptAll(stored[name]).count() == 0
    assert spark.table("stg_deal_registration").count() == frames["stg_deal_registration"].count()


def test_inputs_from_files_and_catalog(spark, frames, tmp_path):
    frames["userrole"].write.parquet(str(tmp_path / "userrole"))
    assert read_inputs(spark, str(tmp_path), names=["userrole"])["userrole"].count() == frames["userrole"].count()
    store = TableStore(namespace="default")
    store.rebuild(frames["userrole"], "userrole", "gold")
    try:
        assert read_inputs(spark, namespace="default", names=["userrole"])["userrole"].count() == 5
    finally:
        spark.sql("DROP TABLE userrole")
    with pytest.raises(ValueError, match="either"):
        read_inputs(spark)


def test_all_rules_are_reported(frames):
    rules = all_rules(CFG)
    report = check_models(frames.inputs, build_models(frames.inputs, CFG), CFG).collect()
    assert sorted(r.check_id for r in report) == list(range(1, 104))
    assert {r.status for r in report} <= {"pass", "warn", "error"}
    by_kind = {}
    for rule in rules:
        by_kind[rule.kind] = by_kind.get(rule.kind, 0) + 1
    assert by_kind == {
        "not_null": 38,
        "unique": 12,
        "accepted_values": 5,
        "relationships": 18,
        "expression_is_true": 27,
        "row_count_reconciliation": 1,
        "unique_combination_of_columns": 2,
    }


def test_rule_selection():
    rules = all_rules(CFG)
    sizes = {c: len(select_rules(rules, cadence=c)) for c in ("dq_blocking", "dq_monitoring", "dq_monthly")}
    assert sizes == {"dq_blocking": 30, "dq_monitoring": 25, "dq_monthly": 16}
    assert len(select_rules(rules, dimension="referential_integrity")) == 18


def test_monthly_checks_only_warn(frames):
    names = ["dim_deal_registration", "dim_vartopia_deal_registration", "dim_unified_deal_registration"]
    models = build_models(frames.inputs, CFG, only=names)
    report = check_models(frames.inputs, models, CFG, select_rules(all_rules(CFG), cadence="dq_monthly"))
    enforce(report)
    assert report.where(F.col("status") == "warn").count() > 0


def test_quotes_show_retired_record_types_once(spark):
    versions = spark.createDataFrame(
        [("t1", "Old name", False, None), ("t1", "Live", True, None), ("t2", "Old", False, False), ("t3", "Deleted", True, True)],
        "recordtype_id string, record_type_name string, is_current boolean, is_deleted boolean",
    )
    assert sorted(tuple(r) for r in record_types(versions).collect()) == [("t1", "Live")]
    assert sorted(tuple(r) for r in any_record_types(versions).collect()) == [("t1", "Live"), ("t2", "Old"), ("t3", "Deleted")]


def test_refresh_amounts_keep_their_digits(spark):
    texts = ["0.00001", "12.5", " ", "many", None, "many"]
    given = spark.createDataFrame([(t,) for t in texts], "gross_refresh_acv string")
    read = given.select(quotes.measure(given, "gross_refresh_acv").cast("string")).collect()
    assert [r[0] for r in read] == ["0.000010000000000", "12.500000000000000", None, None, None, None]
    assert [tuple(r) for r in quotes.unread_amounts(given).collect()] == [("many", 2)]


def test_building_starts_no_job(spark, frames):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sparkContext.setJobGroup("building", "building models")
    try:
        build_models(frames.inputs, CFG)
        tracker = spark.sparkContext.statusTracker()
        stages = [k for i in tracker.getJobIdsForGroup("building") for k in tracker.getJobInfo(i).stageIds]
        names = {tracker.getStageInfo(k).name.split(" at ")[0] for k in stages}
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert names <= {"parquet"}  # Spark reads the schemas of the test tables


def test_selected_models_read_stored_ancestors(spark, frames, tmp_path):
    store = TableStore(base_path=str(tmp_path / "out"))
    build_models(frames.inputs, CFG, only=["dim_unified_deal_registration"], store=store)
    tables = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("*/*")}
    build_models(frames.inputs, CFG, only=["dim_unified_deal_registration"], store=store)
    changed = [p.name for p, t in tables.items() if p.stat().st_mtime_ns != t]
    assert changed == ["dim_unified_deal_registration"] and len(tables) > 1


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    store = TableStore(base_path=str(tmp_path / "out"))
    store.rebuild(spark.range(3), "t", "gold")
    with pytest.raises(Exception):
        store.rebuild(spark.range(3).select(F.raise_error(F.lit("stop")).alias("id")), "t", "gold")
    assert spark.read.parquet(str(tmp_path / "out" / "gold" / "t")).count() == 3
    assert [p.name for p in (tmp_path / "out" / "gold").iterdir()] == ["t"]


def test_accounts_keep_current_versions_where_versions_exist(spark):
    plain = spark.createDataFrame([("a", "A")], "account_id string, account_name string")
    versions = spark.createDataFrame(
        [("a", "Old", False), ("a", "New", True)], "account_id string, account_name string, is_current boolean"
    )
    assert [r.account_name for r in accounts(plain).collect()] == ["A"]
    assert [r.account_name for r in accounts(versions).collect()] == ["New"]


def test_lineage_is_cut_by_a_checkpoint(spark):
    """Local runs without a configured folder fall back to one of their own."""
    df = cut_lineage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert spark.sparkContext.getCheckpointDir() is not None
    assert sorted(r.x for r in df.collect()) == [0, 2, 4, 6, 8]
