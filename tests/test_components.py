"""Connected components against plain code: links of one partition and links dealt by node."""

import random

import pytest

from timeloom.operators import components


def _plain(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def _links():
    r = random.Random(5)
    chain = [(i, i + 1) for i in range(60)]
    hub = [(100, i) for i in range(101, 160)]
    loose = [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(90)]
    return [*chain, *hub, *loose, (7, 7), (None, 3), (4, None), (61, 60), (60, 61)]


@pytest.mark.parametrize("most", [components.TASK_LINKS, 0])
def test_components_against_plain_code(spark, monkeypatch, most):
    monkeypatch.setattr(components, "TASK_LINKS", most)
    links = _links()
    got = components.connected_components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()
    assert len(got) == len({x.node for x in got})
    assert {x.node: x.component for x in got} == _plain(links)
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_few_links_are_not_dealt_anew_in_each_round(spark):
    sc, held = spark.sparkContext, {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        links = spark.range(1, 4000, 1, 4).selectExpr("id - 1 AS a", "id AS b").filter("b % 10 != 0")
        sc.setJobGroup("few links", "few links")
        got = components.connected_components(links, "a", "b").collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 4000
    assert all(x.component == x.node // 10 * 10 for x in got)
    status = sc.statusTracker()
    stages = {s for j in status.getJobIdsForGroup("few links") for s in status.getJobInfo(j).stageIds}
    assert sum(i.numTasks for i in map(status.getStageInfo, stages) if i) < 400
