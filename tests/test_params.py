from __future__ import annotations

import pytest

from clickloom.params import TaskParams
from clickloom.schemas import TASK
from clickloom.sources import MalformedTask, load_task, parse_task_params

TEXT = (
    '{"startDate":["2024-01-01"],"endDate":["2024-01-30"],"startAge":["10"],"endAge":["40"],'
    '"professionals":["BUILDING,MACHINERY"],"cities":[],"sex":["male","x"],'
    '"keywords":["kw1,kw5,"],"targetPageFlow":["1,2"]}'
)
EXPECTED = TaskParams(
    task_id=7,
    start_date="2024-01-01",
    end_date="2024-01-30",
    start_age=10,
    end_age=40,
    professionals=("BUILDING", "MACHINERY"),
    sex="male",
    keywords=("kw1", "kw5"),
)


def test_from_json():
    assert TaskParams.from_json(TEXT, 7) == EXPECTED


def test_empty_text_is_absent():
    assert TaskParams.from_values(sex="", keywords="", start_age=None) == TaskParams()
    assert TaskParams.from_values(keywords=",").keywords == ()


def test_unknown_name():
    with pytest.raises(ValueError):
        TaskParams.from_values(colour="red")


def _tasks(spark, *params):
    rows = [(i, f"t{i}", None, None, None, "session", "new", p) for i, p in params]
    return spark.createDataFrame(rows, TASK)


def test_load_task(spark):
    tasks = _tasks(spark, (6, "{}"), (7, TEXT))
    assert load_task(tasks, 7) == EXPECTED
    assert load_task(tasks, 6) == TaskParams(task_id=6)
    with pytest.raises(LookupError):
        load_task(tasks, 8)


BROKEN = ["not json", '{"sex":["male"', '{"sex":"male"}', '["male"]', '{"startAge":["ten"]}', ""]


@pytest.mark.parametrize("text", BROKEN)
def test_malformed_parameters_do_not_run(spark, text):
    with pytest.raises(MalformedTask):
        load_task(_tasks(spark, (1, text)), 1)
    with pytest.raises(ValueError):
        TaskParams.from_json(text)


def test_parameters_that_are_not_given(spark):
    tasks = _tasks(spark, (1, '{"keywords":["a"],"sex":[],"cities":null,"other":5}'), (2, None))
    assert load_task(tasks, 1) == TaskParams(task_id=1, keywords=("a",))
    assert load_task(tasks, 2) == TaskParams(task_id=2)
    rows = {r.task_id: (r.sex, r.keywords, r.malformed) for r in parse_task_params(tasks).collect()}
    assert rows == {1: (None, "a", False), 2: (None, None, False)}
