"""One rename publishes all tables; whatever fails before it changes nothing."""
import time

import pytest
from pyspark.sql import functions as F

from sitewise.session import path_exists
from sitewise.sources import publish as p


def _tables(spark, n):
    return {"a": spark.range(n), "b": spark.range(2 * n).withColumn("x", F.lit(n))}


def _seen(spark, target, number=None):
    v = p.current(spark, target, number)
    return v.number, v.table("a").count(), v.table("b").count()


def test_versions_and_pinned_readers(spark, tmp_path):
    t = str(tmp_path)
    with pytest.raises(p.NothingPublished):
        p.current(spark, t)
    p.publish(spark, t, _tables(spark, 3))
    old = p.current(spark, t)
    p.publish(spark, t, _tables(spark, 5) | {"c": spark.range(1)})
    assert _seen(spark, t) == (2, 5, 10) and _seen(spark, t, 1) == (1, 3, 6)
    assert old.table("a").count() == 3 and old.number == 1
    with pytest.raises(p.NothingPublished):
        old.table("c")
    with pytest.raises(p.NothingPublished):
        p.current(spark, t, 7)


def test_a_broken_rule_and_a_kill_between_tables_leave_the_old_version(spark, tmp_path):
    t = str(tmp_path)
    p.publish(spark, t, _tables(spark, 3))

    def forbid(staged):
        assert staged["b"].count() == 14  # the check sees what was written
        raise ValueError("rule broken")

    with pytest.raises(ValueError, match="rule broken"):
        p.publish(spark, t, _tables(spark, 7), forbid)
    dying = _tables(spark, 9) | {"b": spark.range(5).select(F.raise_error(F.lit("killed")).alias("x"))}
    with pytest.raises(Exception, match="killed"):
        p.publish(spark, t, dying)
    assert _seen(spark, t) == (1, 3, 6)
    assert len(list((tmp_path / "data").iterdir())) == 1


def test_of_two_publishers_one_fails(spark, tmp_path):
    t = str(tmp_path)
    p.publish(spark, t, _tables(spark, 1))

    def meanwhile(staged):
        if not path_exists(spark, f"{t}/manifest/{2:012d}.json"):
            p.publish(spark, t, _tables(spark, 2))

    with pytest.raises(p.PublishConflict):
        p.publish(spark, t, _tables(spark, 3), meanwhile)
    assert _seen(spark, t) == (2, 2, 4)
    assert not [f for f in (tmp_path / "manifest").iterdir() if f.name.endswith(".tmp")]


def test_collect_keeps_the_newest_and_what_is_young(spark, tmp_path):
    t = str(tmp_path)
    for n in (1, 2, 3):
        p.publish(spark, t, _tables(spark, n))
    assert p.collect(spark, t, keep=2) == []  # all are younger than a day
    time.sleep(1.1)
    assert len(p.collect(spark, t, keep=2, grace_s=1)) == 1
    assert p.versions(spark, t) == [2, 3] and _seen(spark, t, 2) == (2, 2, 4)
