"""Shared scratch comes from the session; the package ships once."""

from regflat import session as S


def test_scratch_under_the_configured_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert S.checkpoint_root(spark) == root.rstrip("/")
    a, b = S.work_dir(spark, "x"), S.work_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/regflat-work/x-")


def test_package_shipped_once_per_application(spark):
    S.prepare(spark)
    before = set(S._SHIPPED)
    S.prepare(spark)
    assert S._SHIPPED == before and spark.sparkContext.applicationId in S._SHIPPED
