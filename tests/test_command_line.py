from helpers import hire, history_file, request, rows

from starload import Warehouse
from starload.__main__ import main
from starload.spec import HIRED_EMPLOYEES


def test_all_commands(spark, root, tmp_path, capsys):
    jobs = history_file(tmp_path, "j.csv", ["1,Engineer"])
    departments = history_file(tmp_path, "d.csv", ["1,Sales", "2,Legal"])
    hires = history_file(tmp_path, "h.csv", ["1,Ann,2021-01-02T00:00:00Z,1,1", "2,Bob,2021-05-02T00:00:00Z,1,1", "2,x,,,"])
    main(["--root", root, "load", "--jobs", jobs, "--departments", departments, "--hired_employees", hires])
    assert "hired_employees DUPLICATE_KEY 1" in capsys.readouterr().out

    (tmp_path / "r.json").write_text(request(hire(department_id=2), hire(name="")))
    for _ in range(2):
        main(["--root", root, "ingest", f"file:{tmp_path}/r.json", "--batch", "b1"])
    assert capsys.readouterr().out.splitlines() == ["b1 inserted 1 rejected 1"] * 2

    for table, said in ((HIRED_EMPLOYEES.name, "indexed 2 counted 2"), ("jobs", "indexed 1 counted 0")):
        main(["--root", root, "index", table])
        assert capsys.readouterr().out == f"{table} {said}\n"

    main(["--root", root, "report", "quarterly", "2021", f"{root}/q"])
    assert rows(spark.read.csv(f"{root}/q", header=True)) == [
        ("Legal", "Engineer", "0", "1", "0", "0"), ("Sales", "Engineer", "1", "1", "0", "0"),
    ]
    main(["--root", root, "report", "above-mean", "2021", f"{root}/a"])
    assert rows(spark.read.csv(f"{root}/a", header=True)) == [("1", "Sales", "2")]

    main(["--root", root, "backup", f"{root}/backups"])
    saved = dict(line.split(" ") for line in capsys.readouterr().out.splitlines())
    Warehouse(spark, root).drop(HIRED_EMPLOYEES.name)
    main(["--root", root, "restore", HIRED_EMPLOYEES.name, saved[HIRED_EMPLOYEES.name], "--check-fk"])
    assert Warehouse(spark, root).read(HIRED_EMPLOYEES.name).count() == 3
