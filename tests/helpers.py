"""Hand-written inputs in fresh folders."""

from __future__ import annotations

import json

from starload import Warehouse
from starload.spec import STAR


def history_file(folder, name: str, lines: list[str], end: str = "\r\n") -> str:
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("".join(line + end for line in lines).encode())
    return f"file:{path}"


def request(*rows: dict) -> str:
    return json.dumps({"registros": list(rows)}, ensure_ascii=False)


def hire(name="Ann", hire_datetime="2021-05-05T01:02:03Z", department_id=1, job_id=1) -> dict:
    return {"name": name, "hire_datetime": hire_datetime, "department_id": department_id, "job_id": job_id}


def bodies(spark, **by_id: str):
    return spark.createDataFrame(list(by_id.items()), "request_id string, body string")


def stored_star(spark, root: str, specs=STAR, hires=()) -> Warehouse:
    """Two departments and two jobs, and the given hires."""
    warehouse = Warehouse(spark, root, specs)
    warehouse.create()
    for name, rows in {
        "departments": [(1, "Sales"), (2, "Legal")],
        "jobs": [(1, "Engineer"), (2, "Clerk")],
        "hired_employees": list(hires),
    }.items():
        if rows:
            schema = warehouse.read(name).schema
            warehouse.publish(name, warehouse.stage(name, spark.createDataFrame(rows, schema)), "given")
    return warehouse


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
