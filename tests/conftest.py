import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomfeed.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("loomfeed-tests")
        .master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_nodes(df):
    """``(name, output)`` of each optimized plan node, those of scalar subqueries left out."""
    found, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        found.append((node.nodeName(), node.output().mkString(" ")))
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return found


def node_names(df):
    return {name for name, _ in plan_nodes(df)}
