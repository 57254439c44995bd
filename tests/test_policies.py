"""Policies and memberships as rows: what readers see, when, and what their plans hold."""

import pytest

from strata.operators.policies import ROW_FILTER, USER_POLICIES, member_rows, policy_rows, secure_table
from strata.operators.governance import secure_view
from strata.plans.publish import read_lake, read_policies, write_policies
from strata.plans.queries import READERS, lake_root
from tests.conftest import SF_SMALL

COLUMNS = "user_id string, full_name string, document_id string, email string, phone string, segment string"
ROWS = [("1", "Ana Paz", "12345678", "ana@x.pe", "+51999888777", "premium"), ("2", "Leo", "87654321", "leo@x.pe", "+51111222333", "estandar"),
        ("3", None, None, None, None, None), ("4", "Eva", "1", "eva", "", "basico")]


def seen(df):
    return sorted(tuple(r) for r in df.select("user_id", *[c for c in df.columns if c != "user_id"]).collect())


@pytest.mark.parametrize("groups", [(), ("ingenieria",), ("riesgo",), ("auditoria",), ("auditoria", "riesgo"), ("riesgo", "ingenieria"), ("other",)])
def test_rows_of_policies_equal_the_coded_view(spark, groups):
    users = spark.createDataFrame(ROWS, COLUMNS)
    members = member_rows(spark, [("me", g) for g in groups] + [("you", "ingenieria")])
    assert seen(secure_table(users, "users_silver", policy_rows(spark), members, "me")) == seen(secure_view(users, groups))


def test_odd_cases(spark):
    users, rules = spark.createDataFrame(ROWS, COLUMNS), policy_rows(spark)
    everyone = member_rows(spark, [("me", "ingenieria"), ("me", "ingenieria")])            # repeated rows
    assert len(seen(secure_table(users, "users_silver", rules, everyone, "me"))) == 4
    assert seen(secure_table(users, "users_silver", rules, everyone, None)) == []            # no reader
    assert seen(secure_table(users, "elsewhere", rules, everyone, "you")) == seen(users)   # no policy
    assert seen(secure_table(users.limit(0), "users_silver", rules, everyone, "me")) == []
    clash = users.withColumnRenamed("user_id", "group_name").withColumnRenamed("segment", "allowed")
    with pytest.raises(ValueError):                                                           # a policy on a column not there
        secure_table(clash, "users_silver", rules, everyone, "me")
    named = users.selectExpr("user_id", "email", "user_id AS group_name", "user_id AS reader", "user_id AS priority", "segment AS allowed")
    own = policy_rows(spark, [("t", "email", "mask_email", "ingenieria", 0, None), ("t", "allowed", ROW_FILTER, "ingenieria", 0, ["premium"]),
                              ("t", "group_name", ROW_FILTER, "ingenieria", 0, ["1", "2"])])
    assert [r.user_id for r in secure_table(named, "t", own, everyone, "me").collect()] == ["1"]   # clashing names, two filters
    with pytest.raises(ValueError):
        secure_table(users, "t", policy_rows(spark, [("t", "email", "rot13", "ingenieria", 0, None)]), everyone, "me")


def test_views_follow_memberships_and_the_plan_filters_before_it_masks(spark, scratch):
    users = spark.createDataFrame(ROWS, COLUMNS)
    users.write.parquet(f"{scratch}/users")
    write_policies(policy_rows(spark), member_rows(spark, [("me", "auditoria")]), scratch)
    rules, members = read_policies(spark, scratch)
    secured = secure_table(spark.read.parquet(f"{scratch}/users"), "users_silver", rules, members, "me")
    secured.createOrReplaceTempView("my_users")
    assert spark.sql("SELECT user_id, full_name FROM my_users").collect() == [("1", "***MASKED***")]
    plan = secured._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Project") < plan.index("Filter") < plan.index("Relation")       # masks above, the filter below
    assert "Join" not in plan.split("Relation")[0] or "scalar-subquery" in plan
    assert spark.sql("SELECT * FROM my_users WHERE full_name = 'Ana Paz' OR document_id = '12345678'").count() == 0
    for clear in ("ana@x.pe", "Ana Paz", "12345678"):
        assert clear not in str(spark.sql("SELECT * FROM my_users").collect())
    spark.read.parquet(f"{scratch}/users").selectExpr("user_id").count()
    with pytest.raises(Exception):
        secured.select(spark.read.parquet(f"{scratch}/users")["full_name"]).collect()    # no way round the mask
    write_policies(policy_rows(spark), member_rows(spark, [("me", "ingenieria")]), scratch)
    spark.catalog.refreshByPath(f"{scratch}/_policies")
    rules, members = read_policies(spark, scratch)
    assert len(seen(secure_table(users, "users_silver", rules, members, "me"))) == 4


def test_every_reading_of_the_lake_is_secured(spark):
    root = lake_root(spark, SF_SMALL)
    assert read_lake(spark, root)["users_silver"].count() == 0
    auditor = read_lake(spark, root, "auditor")["users_silver"]
    assert {r[0] for r in auditor.select("segment").distinct().collect()} == {"premium"}
    assert {r[0] for r in auditor.select("full_name").distinct().collect()} == {"***MASKED***"}
    assert len(USER_POLICIES) == 7 and {who for who, _ in READERS} == {"engineer", "analyst", "auditor", "lead"}
