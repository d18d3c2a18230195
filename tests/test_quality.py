"""Check kinds: one failing and one passing frame each (Q1-Q4)."""

from grimlake.operators import quality
from grimlake.operators.quality import Check


def run(spark, checks, models):
    return {r.check_id: r.failures for r in quality.summary(models, checks).collect()}


def test_check_kinds(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    child = spark.createDataFrame([(1, "ok"), (3, "bad"), (None, None), (3, "zzz")],
                                  "pid long, label string")
    models = {"parent": parent, "child": child}
    checks = [
        Check("parent", "id", "not_null"),
        Check("parent", "id", "unique"),
        Check("child", "label", "accepted_values", values=("ok", "bad")),
        Check("child", "pid", "relationships", to_model="parent", to_column="id"),
        Check("child", "pid", "not_null"),
    ]
    got = run(spark, checks, models)
    assert got == {c.check_id: n for c, n in zip(checks, [1, 1, 1, 2, 1])}


def test_checks_pass(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1, "ok"), (None, None)], "pid long, label string")
    models = {"parent": parent, "child": child}
    checks = [Check("parent", "id", "not_null"), Check("parent", "id", "unique"),
              Check("child", "label", "accepted_values", values=("ok",)),
              Check("child", "pid", "relationships", to_model="parent", to_column="id")]
    assert set(run(spark, checks, models).values()) == {0}


def test_declared_check_counts():
    kinds = [c.kind for c in quality.DECLARED_CHECKS]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("relationships"),
            kinds.count("accepted_values")) == (34, 2, 6, 5)


def test_enforce_raises_on_error(spark):
    df = spark.createDataFrame([(None,)], "id long")
    s = quality.summary({"m": df}, [Check("m", "id", "not_null")])
    try:
        quality.enforce(s)
    except quality.QualityError:
        return
    raise AssertionError("expected a QualityError")


def failing_case(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    rows = [(1, "ok", "x"), (3, "bad", None), (None, None, "y"), (3, "zzz", "z"), (4, "zzz", "z")]
    child = spark.createDataFrame(rows, "pid long, label string, note string")
    checks = [Check("parent", "id", "not_null"), Check("parent", "id", "unique"),
              Check("child", "label", "accepted_values", values=("ok", "bad")),
              Check("child", "pid", "relationships", to_model="parent", to_column="id"),
              Check("child", "pid", "not_null"), Check("child", "note", "not_null")]
    return {"parent": parent, "child": child}, checks


def test_failing_values_and_stored_rows(spark, tmp_path):
    models, checks = failing_case(spark)
    got = list((r.check_id, r.value, r.n) for r in quality.failing_values(models, checks).collect())
    assert sorted(got, key=str) == sorted([("not_null__parent__id", None, 1), ("unique__parent__id", "2", 2),
                          ("accepted_values__child__label", "zzz", 2), ("relationships__child__pid__parent", "3", 2),
                          ("relationships__child__pid__parent", "4", 1), ("not_null__child__pid", None, 1),
                          ("not_null__child__note", None, 1)], key=str)
    paths = quality.store_failures(models, str(tmp_path), checks)
    assert set(paths) == {c.check_id for c in checks}
    bad = spark.read.parquet(paths["relationships__child__pid__parent"])
    assert sorted(((r.pid, r.label, r.note) for r in bad.collect()), key=str) == [(3, "bad", None), (3, "zzz", "z"), (4, "zzz", "z")]
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(quality.stored_summary(spark, str(tmp_path), checks)) == key(quality.summary(models, checks))
    counts = {r.check_id: r.failures for r in quality.summary(models, checks).collect()}
    assert counts["relationships__child__pid__parent"] == 3 and counts["accepted_values__child__label"] == 1
    # A later clean run replaces what was stored.
    clean = {"parent": models["parent"].where("id = 1"), "child": models["child"].limit(0)}
    quality.store_failures(clean, str(tmp_path), checks)
    assert {r.failures for r in quality.stored_summary(spark, str(tmp_path), checks).collect()} == {0}


def test_a_model_is_scanned_once_for_all_its_row_checks(spark, tmp_path):
    models, checks = failing_case(spark)
    models["child"].write.parquet(f"{tmp_path}/child")
    models["child"] = spark.read.parquet(f"{tmp_path}/child")
    own = [c for c in checks if c.model == "child"]
    plan = quality.failing_values(models, own)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x and f"{tmp_path}/child" in x]
    assert len(scans) == 1 and "Expand" not in plan


def test_no_check_query_expands(spark):
    from grimlake.plans.registry import catalog
    models = catalog(spark, "/root/testdata/sf0.001").models()
    assert "Expand" not in quality.summary(models)._jdf.queryExecution().executedPlan().toString()


def test_rows_are_not_shuffled_to_their_parents(spark, tmp_path):
    """Keys without a parent are found among the distinct keys, and brought to the rows."""
    models, checks = failing_case(spark)
    models["child"].write.parquet(f"{tmp_path}/child")
    models["child"] = spark.read.parquet(f"{tmp_path}/child")
    own = [c for c in checks if c.model == "child"]
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = quality.marked(models["child"], own, models)
        assert "hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
        assert sorted(len(r[quality.FAILED]) for r in rows.collect()) == [1, 2, 2, 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_model_in_parts_is_checked_by_part(spark):
    """The same failing rows as those of the joined model, repeated keys included;
    only the failing rows of a part are joined."""
    left = spark.createDataFrame([(1, 10, "a"), (2, None, "b"), (3, 30, "c"), (3, 31, "c"), (4, 10, None)], "k long, pid long, s string")
    right = spark.createDataFrame([(1, 0.5), (2, 1.5), (3, None), (3, 2.5), (4, 1.0)], "k long, d double")
    parent = spark.createDataFrame([(10,), (31,)], "id long")
    parts = quality.Parts("k", (left, right), ("k", "d", "pid", "s"))
    checks = [Check("m", "pid", "not_null"), Check("m", "d", "not_null"), Check("m", "s", "accepted_values", values=("a", "b")),
              Check("m", "pid", "relationships", to_model="p", to_column="id"), Check("m", "s", "unique")]
    both = [{"m": m, "p": parent} for m in (parts, left.join(right, "k").select("k", "d", "pid", "s"))]
    rows = lambda df: sorted(map(str, df.collect()))
    got, want = [rows(quality.failing_values(m, checks)) for m in both]
    assert got == want and len(got) == 5
    got, want = [sorted((r.k, str(r.d), str(r.pid), str(r.s), sorted(map(str, r[quality.FAILED])))
                        for r in quality.marked(m["m"], checks[:4], m).collect()) for m in both]
    assert got == want and len(got) == 5
