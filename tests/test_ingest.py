from __future__ import annotations

from datetime import datetime

import pytest
from test_semantics import S

from cohortloom.operators import cleaning, quality
from cohortloom.sources import files, ingest

FIRST, SECOND, THIRD = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
RENAMES = {"Patient Id": "id", "Age": "age", "sex": "sex", "A": "a", "b": "b", "Level": "level"}
HEADER = ",".join(RENAMES)
JANUARY = ["p1,30,1,2,3,low", " p2 ,41,2,9,9,High", ",50,1,1,1,Medium", "p3,x,1,2,2,None of these"]
FEBRUARY = ["p2,42,2,9,9,High", "p4,20,1,5,5,Low", ",51,2,1,1,Low", "p1,30,1,2,3,low"]


def sheet(folder, name, lines, header=HEADER):
    path = folder / f"{name}.csv"
    path.write_text("\ufeff" + "\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture
def loaded(spark, tmp_path):
    kept = ingest.CohortStore(str(tmp_path / "store"), S, RENAMES, buckets=4)
    counts = [
        kept.ingest(spark, sheet(tmp_path, "1", JANUARY), "v1", FIRST),
        kept.ingest(spark, sheet(tmp_path, "2", FEBRUARY), "v2", SECOND),
    ]
    return kept, counts


def test_two_sheets(spark, loaded):
    kept, (first, second) = loaded
    assert first == {"rows": 4, "total": 4, "inserted": 4, "matched": 0, "modified": 0}
    assert second == {"rows": 4, "total": 4, "inserted": 1, "matched": 3, "modified": 3}
    rows = {row.id: row for row in kept.read(spark).collect()}
    assert sorted(map(str, rows)) == ["None", "p1", "p2", "p3", "p4"]
    assert (rows["p2"].age, rows["p2"].dataset_version, rows["p2"].created_at, rows["p2"].updated_at) == (42, "v2", FIRST, SECOND)
    assert (rows[None].age, rows[None].level, rows[None].created_at) == (51, "Low", FIRST)
    assert (rows["p3"].age, rows["p3"].feature_signature, rows["p3"].level_encoded) == (None, None, -1)
    assert rows["p4"].created_at == SECOND
    assert kept.current_version(spark) == "v2"
    assert sorted((v.version, v.n_rows, v.inserted) for v in kept.versions(spark).collect()) == [("v1", 4, 4), ("v2", 4, 1)]
    assert {r.dataset_version for r in kept.read_load(spark).collect()} == {"v2"}
    assert kept.read_load(spark, "v1").count() == 4
    audited = kept.audits.summary(spark).first()
    assert (audited.row_count_raw, audited.invalid_age, audited.invalid_level) == (8, 1, 1)


def test_a_load_can_be_run_again(spark, loaded, tmp_path):
    kept, _ = loaded
    before = sorted(kept.read(spark).collect(), key=str)
    again = kept.ingest(spark, sheet(tmp_path, "2", FEBRUARY), "v2", SECOND)
    assert (again["inserted"], again["modified"]) == (0, 0)
    assert sorted(kept.read(spark).collect(), key=str) == before
    assert kept.versions(spark).count() == 2 and kept.audits.summary(spark).first().row_count_raw == 8


def test_a_failed_load_is_not_registered(spark, loaded, tmp_path, monkeypatch):
    kept, _ = loaded
    path = sheet(tmp_path, "3", ["p9,20,1,5,5,Low"])
    monkeypatch.setattr(ingest.store, "append_snapshot", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.ingest(spark, path, "v3", THIRD)
    assert kept.current_version(spark) == "v2"
    with pytest.raises(ingest.VersionError, match="v3"):
        kept.read_load(spark, "v3")
    monkeypatch.undo()
    assert kept.ingest(spark, path, "v3", THIRD)["rows"] == 1
    assert kept.current_version(spark) == "v3" and kept.read(spark).count() == 6


def test_the_gate_and_the_contract_stop_a_load(spark, tmp_path):
    kept = ingest.CohortStore(str(tmp_path / "store"), S, RENAMES, buckets=4)
    with pytest.raises(ingest.VersionError, match="no version"):
        kept.read(spark)
    with pytest.raises(quality.QualityError, match="invalid_age=1"):
        kept.ingest(spark, sheet(tmp_path, "1", JANUARY), "v1", FIRST, limits={})
    with pytest.raises(cleaning.ContractError, match="missing columns"):
        kept.ingest(spark, sheet(tmp_path, "2", ["p1,30"], "Patient Id,Age"), "v1", FIRST)
    assert not files.exists(spark, f"{tmp_path}/store/rows") and not files.exists(spark, f"{tmp_path}/store/versions")
