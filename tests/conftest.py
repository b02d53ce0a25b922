from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clickloom.schemas import USER_INFO, USER_VISIT_ACTION  # noqa: E402
from clickloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[*]",
        settings={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def action_rows(spark):
    """Actions from dicts; columns left out are null, the date follows the action time."""

    def make(*rows: dict):
        filled = []
        for row in rows:
            values = {"user_id": 1, "page_id": 0, "city_id": 0, **row}
            values.setdefault("date", (values.get("action_time") or "")[:10] or None)
            filled.append(tuple(values.get(name) for name in USER_VISIT_ACTION.names))
        return spark.createDataFrame(filled, USER_VISIT_ACTION)

    return make


@pytest.fixture
def user_rows(spark):
    """Users from (id, age, professional, city, sex)."""

    def make(*rows: tuple):
        filled = [(i, f"user{i}", f"name{i}", age, p, c, s) for i, age, p, c, s in rows]
        return spark.createDataFrame(filled, USER_INFO)

    return make


@pytest.fixture
def one_user(user_rows):
    return user_rows((1, 30, "IT", "Rome", "male"))


@pytest.fixture
def click_rows(spark):
    """Ad clicks from (time text, user, ad)."""

    def make(*rows: tuple):
        raw = spark.createDataFrame(list(rows), "at string, user_id long, ad_id long")
        return raw.selectExpr("cast(at AS timestamp) AS ts", "user_id", "ad_id")

    return make
