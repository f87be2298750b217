from courierlake import session
from courierlake.sources import lake
from helpers import table


def test_shuffles_follow_the_input(spark, folder):
    """A width set on the application wins; else it follows the input without a cap."""
    assert session.shuffle_width(spark, 10**14) == int(spark.conf.get("spark.sql.shuffle.partitions"))

    class Unset:
        conf = spark.conf

        class sparkContext:  # noqa: N801
            @staticmethod
            def getConf():
                return {}

    class Empty(dict):
        contains = dict.__contains__

    Unset.sparkContext.getConf = staticmethod(Empty)
    assert session.shuffle_width(Unset, 10**6) == session.DEFAULT_WIDTH
    assert session.shuffle_width(Unset, 10**13) == 18_627
    assert session.shuffle_width(Unset, 10**14) == 186_265


def test_stored_bytes(spark, folder):
    assert session.stored_bytes(spark, f"{folder}/nothing") == 0
    lake.write(table(spark, "x int", (1,)), f"{folder}/one")
    assert session.stored_bytes(spark, f"{folder}/one") > 0


def test_setting_is_put_back(spark):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    with session.setting(spark, key, "-1"):
        assert spark.conf.get(key) == "-1"
    assert spark.conf.get(key, None) is None


def test_tune_leaves_application_settings_alone(spark):
    session.tune(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_shared_dir_is_the_configured_one(spark):
    shared = session.shared_dir(spark)
    assert shared == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == shared
    assert session.scratch_path(spark, "a").startswith(f"{shared}/a-")
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")
