"""Session helpers: object-store options from the environment (S9), defaults, shared folder."""

from gridcast.session import SESSION_DEFAULTS, object_store_options, run_concurrently, shared_dir


def test_object_store_options_from_environment(monkeypatch):
    monkeypatch.setenv("AWS_ENDPOINT_URL", "http://store.example:9000")
    monkeypatch.setenv("AWS_ACCESS_KEY_ID", "key")
    monkeypatch.setenv("AWS_SECRET_ACCESS_KEY", "secret")
    opts = object_store_options()
    assert opts["spark.hadoop.fs.s3a.endpoint"] == "http://store.example:9000"
    assert opts["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert (opts["spark.hadoop.fs.s3a.access.key"], opts["spark.hadoop.fs.s3a.secret.key"]) == ("key", "secret")


def test_no_credentials_no_keys(monkeypatch):
    for var in ("AWS_ENDPOINT_URL", "AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY"):
        monkeypatch.delenv(var, raising=False)
    opts = object_store_options()
    assert not any(k.endswith((".access.key", ".secret.key", ".endpoint")) for k in opts)


def test_session_defaults_applied(spark):
    for key, value in SESSION_DEFAULTS.items():
        assert spark.conf.get(key) == value
    assert spark.conf.get("spark.ui.enabled") == "false"


def test_shared_dir_under_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark, "x").startswith(base.rstrip("/"))


def test_run_concurrently_keeps_order_and_raises(spark):
    assert run_concurrently(lambda: spark.range(3).count(), lambda: spark.range(5).count()) == [3, 5]
    try:
        run_concurrently(lambda: 1, lambda: 1 / 0)
    except ZeroDivisionError:
        pass
    else:
        raise AssertionError("error not raised")


def test_cluster_without_shared_folder_is_an_error():
    import pytest

    from gridcast.session import shared_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
