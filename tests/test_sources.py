import json

from ledgerloom.sources import files as FI
from ledgerloom.sources import snapshots as S


def test_snapshot_choice_and_first_record(spark, tmp_path):
    for run, manifest in (("1", {"status": "complete"}), ("2", {"status": "failed"}), ("3", None)):
        (tmp_path / run).mkdir()
        if manifest:
            (tmp_path / run / "manifest.json").write_text(json.dumps(manifest))
    rows = [{"id": "a", "value": 1}, {"id": "b", "value": 2}], [{"id": "a", "value": 9}]
    for n, r in enumerate(rows):
        (tmp_path / "1" / f"transactions_{n}.json").write_text(json.dumps({"transactions": r}))
    run = S.latest_run(spark, f"file://{tmp_path}")
    assert run.endswith("/1") and S.latest_run(spark, f"file://{tmp_path}/none") is None
    assert {r.id: r.value for r in S.read_records(spark, run, "transactions", S.LINE_ITEM).collect()} == {"a": 1, "b": 2}


def test_jsonl_last_wins(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"k": "a", "v": 1}\n\n{"k": "b", "v": 2}\n{"k": "a", "v": 3}\n')
    assert {r.k: r.v for r in S.read_jsonl(spark, f"file://{tmp_path}/r.jsonl", "k string, v long", "k").collect()} == {"a": 3, "b": 2}


def test_csv_round_trip_and_bom(spark, tmp_path):
    df = spark.createDataFrame([("a, \"b\"", True, ["x"]), (None, False, None)], "t string, f boolean, l array<string>")
    FI.write_csv(df, f"file://{tmp_path}/out", bom=True)
    back = FI.read_csv(spark, f"file://{tmp_path}/out")
    assert back.columns == ["t", "f", "l"] and {tuple(r) for r in back.collect()} == {('a, "b"', "true", '["x"]'), ("", "false", "")}
    assert all(r.bom for r in FI.has_bom(spark, f"file://{tmp_path}/out/*.csv").collect())


def test_append_resumes(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "transaction_id string, v int")
    assert FI.append_results(df.limit(1), f"file://{tmp_path}/res") == 1
    assert FI.append_results(df, f"file://{tmp_path}/res") == 1 and FI.append_results(df, f"file://{tmp_path}/res") == 0


def test_landing_a_run(spark, tmp_path):
    import datetime

    import pytest

    root, now = f"file://{tmp_path}", datetime.datetime(2024, 5, 6, 7, 8, 9)
    run = S.new_run(spark, root, now=now)
    assert run.endswith("/20240506-070809")
    with pytest.raises(FileExistsError):
        S.new_run(spark, root, now=now)
    assert S.latest_run(spark, root) is None
    S.land(spark, run, "transactions", "1", [{"id": "a", "value": 1, "content": "é"}], {"total_count": 1}, {"start_date": "2024-01-01"})
    S.write_manifest(spark, run, now=now, total_count=1)
    assert S.run_or_latest(spark, root).endswith("20240506-070809") and S.run_or_latest(spark, root, "mine") == "mine"
    assert S.load_json(spark, f"{run}/manifest.json") == {"fetched_at": "2024-05-06T07:08:09", "total_count": 1}
    assert [(r.id, r.value, r.content) for r in S.read_records(spark, run, "transactions", S.LINE_ITEM).collect()] == [("a", 1, "é")]
    assert not [p for p in (tmp_path / "20240506-070809").iterdir() if p.name.endswith(".tmp")]


def test_range_of_the_newest_term(spark):
    import datetime

    import pytest

    t = spark.createDataFrame([("2023-04-01", "2024-03-31"), ("2024-04-01", "2025-03-31"), ("2025-04-01", "2026-03-31")], "start_date string, end_date string")
    d = datetime.date
    assert S.term_range(t, "2024-06-01") == (d(2024, 4, 1), d(2024, 6, 1)) and S.term_range(t, "2027-01-01") == (d(2025, 4, 1), d(2026, 3, 31))
    assert S.term_range(t, "2024-06-01", "2020-01-01", "2020-02-01") == (d(2020, 1, 1), d(2020, 2, 1))
    for bad in (("2020-01-01",), ("2024-06-01", "2024-01-01")):
        with pytest.raises(ValueError):
            S.term_range(t, *bad)


def test_settings():
    import pytest

    from ledgerloom.sources.settings import ConfigError, load_settings

    env = {"LEDGER_API_KEY": "abc", "LEDGER_OFFICE_CODE": "1234-5678", "LEDGER_START_DATE": "2024-01-01", "LEDGER_JOURNALS_PER_PAGE": "50"}
    s = load_settings(env)
    assert (s.office(), s.start_date.year, s.journals_per_page, s.transactions_per_page, s.data_dir) == ("1234-5678", 2024, 50, 500, "data") and "abc" not in repr(s)
    assert load_settings(env | {"LEDGER_OFFICE_CODE": "0000-0000"}).office_code is None
    for bad in ({"API_KEY": ""}, {"API_KEY": "REPLACE_ME"}, {"OFFICE_CODE": "12"}, {"END_DATE": "soon"}, {"JOURNALS_PER_PAGE": "0"}, {"TRANSACTIONS_PER_PAGE": "x"}):
        with pytest.raises(ConfigError):
            load_settings(env | {"LEDGER_" + k: v for k, v in bad.items()})
    with pytest.raises(ConfigError):
        load_settings(env | {"LEDGER_OFFICE_CODE": "0000-0000"}).office()
