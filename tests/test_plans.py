"""Plan properties: no single-partition exchange over un-aggregated rows,
filters and column pruning reach the scan."""

import pytest

from grimlake.plans.registry import catalog

SF = "/root/testdata/sf0.001"


def single_partition_inputs(df):
    """For every ``Exchange SinglePartition`` in the executed plan, whether
    an aggregate sits between it and the leaves of its subtree."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    found = []
    for i, line in enumerate(plan):
        if "Exchange SinglePartition" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        aggregated = False
        for sub in plan[i + 1:]:
            d = len(sub) - len(sub.lstrip(" :+-"))
            if d <= depth:
                break
            if "HashAggregate" in sub or "ObjectHashAggregate" in sub or "SortAggregate" in sub:
                aggregated = True
                break
            if "Scan" in sub:
                break
        found.append(aggregated)
    return found


@pytest.mark.parametrize("model", ["fct_windows", "dim_albums", "temporal_analysis",
                                   "subgenre_analysis", "geographic_analysis"])
def test_no_single_partition_on_rows(spark, model):
    df = getattr(catalog(spark, SF), model)
    assert all(single_partition_inputs(df)), model


def test_fact_window_plan(spark):
    from pyspark.sql import functions as F

    from grimlake.plans import facts
    c = catalog(spark, SF)
    narrow = facts.narrow_rows(c.fct_base)
    assert all(single_partition_inputs(facts.window_columns(narrow)))


def test_filter_pushdown_and_pruning(spark):
    c = catalog(spark, SF)
    plan = c.stg_albums.select("album_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_fact_key_is_fixed_by_the_write(spark):
    """The row key is unique and read from files: no plan makes it anew."""
    c = catalog(spark, SF)
    assert c.fct_base.select("_rk").distinct().count() == c.fct_base.count() == c.fct_reviews.count()
    plan = c.fct_reviews_keyed._jdf.queryExecution().executedPlan().toString()
    assert "monotonically_increasing_id" not in plan


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def test_texts_are_shuffled_once_and_last(spark):
    """Whatever the sizes: no stored table between the texts and the fact holds a
    text, and the fact's own plan shuffles them once."""
    from grimlake.plans import facts
    c = catalog(spark, SF)
    for table in (c.fct_base, c.fct_windows):
        assert not set(facts.TEXTS) & set(table.columns)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        # The joins that make the stored tables, too: no exchange below them has a text.
        rows = c.review_texts.drop(*facts.TEXTS).join(c.dim_albums.select(*facts.ALBUM_COLUMNS_FOR_FACT), "album_id")
        for df, most in ((rows, 0), (facts.narrow_rows(c.fct_base), 0), (c.fct_reviews_keyed, 1)):
            plan = df.select("*")._jdf.queryExecution().executedPlan()  # planned anew
            moved = [n for n in nodes(plan) if n.nodeName() == "Exchange" and "content_review" in n.output().mkString(",")]
            assert len(moved) == most
        writes = facts.review_classes(c.stg_reviews)._jdf.queryExecution().executedPlan()
        source = c.stg_reviews.select("*")._jdf.queryExecution().executedPlan()
        count = lambda p: sum(n.nodeName() == "Exchange" for n in nodes(p))
        assert count(writes) == count(source)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_texts_of_few_rows_are_read_from_their_files(spark):
    from pyspark.sql import functions as F

    from grimlake.plans import facts
    c = catalog(spark, SF)
    top = c.fct_windows.where("overall_score_rank <= 5").select("_rk", "overall_score_rank")
    got = facts.with_texts(top, c.review_texts)
    assert "PushedFilters: [IsNotNull(_rk), " in got._jdf.queryExecution().executedPlan().toString() or \
        "GreaterThanOrEqual(_rk" in got._jdf.queryExecution().executedPlan().toString()
    want = c.fct_reviews_keyed.join(top.select("_rk"), "_rk").select("_rk", *facts.TEXTS)
    rows = lambda df: sorted(map(str, df.select("_rk", *facts.TEXTS).collect()))
    assert rows(got) == rows(want) == rows(facts.with_texts(top, c.review_texts, max_files=0))
    assert got.select(F.countDistinct("_rk")).first()[0] == 5


def test_checkpoint_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from grimlake.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=context, conf=conf))

