import pytest

from millrace import session


class Conf(dict):
    def set(self, key, value):
        self[key] = value

    @property
    def getAll(self):
        return dict(self)


class FakeSession:
    """A session without a shared folder, local or not."""

    def __init__(self, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{id(self)}",
                                                 "defaultParallelism": 8, "getCheckpointDir": lambda self: None})()


def test_scratch_folders_are_new_and_below_the_shared_one(spark):
    first, second = session.scratch(spark, "a"), session.scratch(spark, "a")
    root = spark.conf.get("spark.checkpoint.dir")
    assert first != second and first.startswith(root + "/a-")


def test_only_a_local_session_makes_its_own_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch(FakeSession("yarn"), "a")
    local = FakeSession("local[2]")
    assert session.scratch(local, "a").rsplit("/", 1)[0] == session.scratch(local, "b").rsplit("/", 1)[0]
    shared = FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.scratch(shared, "a").startswith("hdfs:///shared/a-")


def test_settings_of_the_caller_stay():
    mine = FakeSession("yarn", **{"spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "200",
                                  session.STATE_STORE: "org.example.OwnProvider"})
    before = dict(mine.conf)
    assert dict(session.prepare(mine).conf) == before


def test_another_time_zone_is_refused():
    tokyo = FakeSession("local[2]", **{session.TIME_ZONE: "Asia/Tokyo", session.STATE_STORE: "org.example.OwnProvider"})
    with pytest.raises(ValueError, match="Asia/Tokyo"):
        session.prepare(tokyo)
    assert tokyo.conf[session.TIME_ZONE] == "Asia/Tokyo"


def test_written_frames_have_no_history(spark):
    df = spark.range(10).selectExpr("id", "id % 3 as k")
    assert sorted(map(tuple, session.materialize(df, "m").collect())) == sorted(map(tuple, df.collect()))
