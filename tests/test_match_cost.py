"""The dear steps of match events run once a row: building a payload, typed reads, sorting wide rows."""
from pyspark.sql import functions as F

from __spark_entry__ import SF_SMOKE
from conftest import plan_text, rows
from gamelake.operators import quality as Q
from gamelake.operators.dedup import latest_by_tied
from gamelake.plans import intermediate as I
from gamelake.plans import match as M
from gamelake.plans import staging as S
from gamelake.plans.catalog import REGISTRY
from gamelake.plans.check_suite import Check, run_suite
from gamelake.plans.models import Models
from gamelake.sources.seeds import seed

ODD = [  # last load wins; a tie; no key; a single survivor; a joined perks string; a badly typed score
    ("{'event_id':'a','match_id':'m1','killer':{'perks':['k1','k2'],'kills':3},'survivors':[{'player_id':'p','platform_player_id':'1',"
     "'character_id':'surv_1','escaped':true,'score':2.5,'perks':['x','y']},null,{'score':'bad','perks':'x,y'}]}", "f1", "2024-01-02"),
    ("{'event_id':'a','match_id':'old','survivors':[]}", "f9", "2024-01-01"),
    ("{'event_id':'b','match_id':'m2','survivors':{'platform_player_id':'2','score':7}}", "f1", "2024-01-01"),
    ("{'event_id':'b','match_id':'m2','survivors':{'platform_player_id':'2','score':7}}", "f1", "2024-01-01"),
    ("{'match_id':'no key'}", "f1", "2024-01-01"),
    ("{'event_id':'c','match_id':'m3','killer':{'perks':'k1,k2'}}", None, None)]


def _bronze(spark):
    """Payloads that are made in the query, not read from a table."""
    d = spark.createDataFrame([(p.replace("'", '"'), f, t) for p, f, t in ODD], "p string, filename string, t string")
    return d.select(F.parse_json("p").alias("raw_data"), "filename", F.col("t").cast("timestamp_ntz").alias("load_ts"))


def _filters(plan):
    return [line for line in plan.splitlines() if line.lstrip(" :+-*(0123456789)").startswith("Filter")]


def test_no_filter_makes_the_payload_again(spark):
    raw = spark.range(20).select(F.to_variant_object(F.struct(F.col("id").cast("string").alias("event_id"))).alias("raw_data"),
                                 F.lit("f").alias("filename"), F.lit("2024-01-01").cast("timestamp_ntz").alias("load_ts"))
    for df in (S.stg_matches(raw), Q.near_duplicates(raw)):
        assert not [f for f in _filters(plan_text(df, execute=False)) if "to_variant_object" in f]


def test_nested_arrays_are_read_once(spark):
    m = S.stg_matches(_bronze(spark))
    e = I.int_match_enriched(m, seed(spark, "seed_killers"), seed(spark, "seed_survivors"))
    for df in (e, M.fct_perk_performance(m, e, seed(spark, "seed_perks"))):
        assert not [f for f in _filters(plan_text(df, execute=False)) if "$.survivors" in f or "$.killer.perks" in f]


def test_dedup_sorts_once_behind_the_exchange(spark):
    plan = plan_text(S._dedup(_bronze(spark)), execute=False)
    above = plan.split("Exchange", 1)[0]
    assert above.count("Sort [") == 1 and "Sort [_h" in above


def test_tied_rows_of_one_hash_keep_one(spark):
    df = spark.createDataFrame([("k", 1, 5, 1), ("k", 1, 4, 2), ("k", 1, 4, 2), ("k", 0, 1, 3), (None, None, 9, 4), (None, None, 8, 5)],
                               "k string, o int, t int, v int")
    got = latest_by_tied(df, "k", [F.col("o").desc_nulls_first()], F.col("t"))
    assert rows(got) == rows(spark.createDataFrame([("k", 1, 4, 2), (None, None, 8, 5)], df.schema))


def test_few_survivor_fields_equal_the_whole_model(spark):
    raw = {"match_completed": _bronze(spark)}
    m = Models(spark, raw)
    whole = m.int_match_enriched
    for fields in (("platform_player_id", "score"), ("escaped", "perks"), ("player_id",)):
        few = m.match_survivors(*fields)
        assert len(few.columns) < len(whole.columns)
        assert rows(few) == rows(whole.select(*few.columns))
    assert whole.count() == 4
    complete = Models(spark, raw, complete=True)
    texts = lambda d: rows(d.select("match_id", "survivor_score", F.to_json("survivor_payload").alias("p")))
    assert texts(complete.match_survivors("score")) == texts(complete.int_match_enriched)


def test_number_of_survivors_needs_no_other_field(spark):
    m = Models(spark, {"match_completed": _bronze(spark)})
    few, count = m.matches_with("character_id"), F.size("survivors").alias("n")
    assert rows(few.select("match_id", count)) == rows(m.stg_matches.select("match_id", count))
    plan = plan_text(REGISTRY["stg_matches"](spark, SF_SMOKE), execute=False)
    assert "StructField(generators_completed" not in plan


def test_stored_matches_need_no_stored_survivors(spark):
    lazy, stored = (Models(spark, {"match_completed": _bronze(spark)}, materialize=kept) for kept in (False, True))
    few = stored.match_survivors("escaped", "perks")
    assert "int_match_enriched" not in vars(stored)
    want = lazy.match_survivors("escaped", "perks")
    assert rows(few.select(*want.columns)) == rows(want)


def test_lifetime_and_scores_read_one_survivor_field(spark):
    for key, field in (("join_multi_left", "platform_player_id"), ("pivot_mean", "score"), ("union_all", "player_id")):
        plan = plan_text(REGISTRY[key](spark, SF_SMOKE), execute=False)
        assert f"StructType(StructField({field}," in plan
        assert "StructField(character_id" not in plan, key
    m = Models(spark, {"match_completed": _bronze(spark)})
    assert "survivor_name" not in m.match_survivors("score").columns
    named = ("match_id", "survivor_character_id", "survivor_name")
    assert rows(m.match_survivors("character_id").select(*named)) == rows(m.int_match_enriched.select(*named))


def test_two_readers_of_matches_deduplicate_them_once(spark):
    for key in ("fct_perk_performance", "union_all"):
        plan = plan_text(REGISTRY[key](spark, SF_SMOKE)).split("== Initial Plan ==")[0]
        assert plan.count("Window [") == 4, key


def test_suite_counts_rows_and_repeated_values_in_one_pass(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 9), (None, 9), ("b", 9), ("c", 2)], "k string, v int")
    models = type("M", (), {"m": df, "none": df.where("false")})
    checks = [Check(m, c, *k) for m in ("m", "none") for c, *k in (
        ("k", "unique"), ("k", "not_null"), ("v", "unique"), ("v", "not_null"), ("v", "between", (0, 5)))]
    got = {(r.model, r.column_name, r.check): (r.failing_rows, r.status) for r in run_suite(models, checks).collect()}
    assert got == {("m", "k", "unique"): (1, "error"), ("m", "k", "not_null"): (2, "error"), ("m", "v", "unique"): (1, "error"),
                   ("m", "v", "not_null"): (1, "error"), ("m", "v", "between"): (3, "error"),
                   **{("none", c, k): (0, "pass") for c, k in (("k", "unique"), ("k", "not_null"), ("v", "unique"),
                                                               ("v", "not_null"), ("v", "between"))}}
    plan = plan_text(run_suite(models, [c for c in checks if c.model == "m" and c.column == "k"]), execute=False)
    assert "Union" not in plan
