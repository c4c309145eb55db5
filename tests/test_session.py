from clickscope.session import checkpoint_root, scale_settings


def test_scale_settings():
    s = scale_settings(100 * (1 << 40), cores=8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(1 << 20, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_checkpoint_root_is_the_configured_folder(spark):
    root = checkpoint_root(spark)
    assert root and root == checkpoint_root(spark)
