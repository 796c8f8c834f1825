"""What plans look like: parsers run once, and shared folders are named on a cluster."""

import pytest

from graphloom.functions import checkpoints
from graphloom.plans import registry

DATA = "/root/testdata/sf0.001"


def python_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("ArrowEvalPython")


@pytest.mark.parametrize("name", ["java_types", "java_fields", "java_imports", "java_spring", "res_pom", "res_xml", "res_yaml_flatten"])
def test_parsers_run_once(spark, name):
    assert python_nodes(registry.queries()[name](spark, DATA)) == 1


class Session:
    """A session with settings and no context of its own."""

    def __init__(self, folder=None, master="spark://host:7077", set_by_hand=None):
        self.settings, self.folder = {"spark.checkpoint.dir": folder, "spark.master": master}, set_by_hand
        self.sparkContext = self

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.settings.get(key) or default

    def getCheckpointDir(self):
        return self.folder


def test_shared_folder():
    assert checkpoints.shared_folder(Session("hdfs:///x")) == "hdfs:///x"
    assert checkpoints.shared_folder(Session(set_by_hand="file:/y")) == "file:/y"
    assert checkpoints.shared_folder(Session(master="local[2]"))
    with pytest.raises(RuntimeError):
        checkpoints.shared_folder(Session())
