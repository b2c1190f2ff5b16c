"""Task parameters: the reference's ``task_param`` JSON turned into typed values and
into one filter ``Column``.

A task row carries JSON like ``{"startAge": ["10"], "keywords": ["kw1,kw2"]}``. Only the
first array element of a field is used and list-valued fields are comma separated.
A missing or empty field means "no constraint".
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parameter names of a task's JSON.
PARAM_START_DATE = "startDate"
PARAM_END_DATE = "endDate"
PARAM_START_AGE = "startAge"
PARAM_END_AGE = "endAge"
PARAM_PROFESSIONALS = "professionals"
PARAM_CITIES = "cities"
PARAM_SEX = "sex"
PARAM_KEYWORDS = "keywords"
PARAM_CATEGORY_IDS = "categoryIds"
PARAM_TARGET_PAGE_FLOW = "targetPageFlow"


def _split(value: str | None) -> list[str] | None:
    """The comma-separated items without trailing empty ones; none at all means no constraint."""
    return value.rstrip(",").split(",") if value and value.rstrip(",") else None


@dataclass(frozen=True)
class TaskParams:
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: list[str] | None = None
    cities: list[str] | None = None
    sex: list[str] | None = None
    keywords: list[str] | None = None
    category_ids: list[str] | None = None
    target_page_flow: list[str] | None = field(default=None)

    @classmethod
    def from_json(cls, text: str) -> "TaskParams":
        raw = json.loads(text) if text else {}

        def first(name: str) -> str | None:
            v = raw.get(name)
            if isinstance(v, list):
                v = v[0] if v else None
            return None if v is None or str(v).strip() == "" else str(v)

        def as_int(v: str | None) -> int | None:
            return None if v is None else int(v)

        return cls(
            start_date=first(PARAM_START_DATE), end_date=first(PARAM_END_DATE),
            start_age=as_int(first(PARAM_START_AGE)), end_age=as_int(first(PARAM_END_AGE)),
            professionals=_split(first(PARAM_PROFESSIONALS)), cities=_split(first(PARAM_CITIES)),
            sex=_split(first(PARAM_SEX)), keywords=_split(first(PARAM_KEYWORDS)),
            category_ids=_split(first(PARAM_CATEGORY_IDS)),
            target_page_flow=_split(first(PARAM_TARGET_PAGE_FLOW)),
        )


def task_params(tasks: DataFrame) -> DataFrame:
    """Distributed form of the parameter lookup: one row per task with typed columns.

    ``tasks`` has (task_id, task_param). A field's first array element is taken;
    absent fields are null.
    """
    m = F.from_json("task_param", "map<string,array<string>>")

    def first(name: str) -> Column:
        value = F.try_element_at(F.try_element_at(F.col("m"), F.lit(name)), F.lit(1))
        return F.when(F.trim(value) != "", value)

    def items(name: str) -> Column:
        value = F.regexp_replace(first(name), ",+$", "")
        return F.when(value != "", F.split(value, ","))

    return tasks.select("task_id", m.alias("m")).select(
        "task_id",
        first(PARAM_START_DATE).alias("start_date"),
        first(PARAM_END_DATE).alias("end_date"),
        first(PARAM_START_AGE).try_cast("int").alias("start_age"),
        first(PARAM_END_AGE).try_cast("int").alias("end_age"),
        items(PARAM_PROFESSIONALS).alias("professionals"),
        items(PARAM_CITIES).alias("cities"),
        items(PARAM_SEX).alias("sex"),
        items(PARAM_KEYWORDS).alias("keywords"),
        items(PARAM_CATEGORY_IDS).alias("category_ids"),
        items(PARAM_TARGET_PAGE_FLOW).alias("target_page_flow"),
    )


def task_by_id(tasks: DataFrame, task_id: int) -> TaskParams:
    """Look up one task by id. The task table is a tiny control table; one row is
    fetched (never the data tables)."""
    rows = tasks.where(F.col("task_id") == F.lit(task_id)).select("task_param").limit(1).collect()
    if not rows:
        raise KeyError(f"unknown task id {task_id}")
    return TaskParams.from_json(rows[0]["task_param"])
