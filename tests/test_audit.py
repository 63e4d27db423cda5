from __future__ import annotations

import pytest
from test_semantics import DIRTY, S, rows

from cohortloom.operators import audit, quality


def test_states_add_up_to_the_audit_of_all_rows(spark, tmp_path):
    batches = [DIRTY[:2], DIRTY[2:5], DIRTY[5:], ()]
    store = audit.AuditStore(str(tmp_path / "states"), S)
    lax = {name: None for name in ("invalid_age", "invalid_sex", "invalid_level", "invalid_risk_scale")}
    written = []
    for at, batch in enumerate(batches):
        for _ in range(1 + at % 2):  # a repeated load replaces its state
            store.add(str(at), rows(spark, *batch), write=lambda df: written.append(df.count()), limits=lax)
    whole = quality.quality_summary(rows(spark, *DIRTY), S).first()
    assert store.summary(spark).first() == whole
    assert sum(written) > len(DIRTY)
    again = store.compact(spark, "all", str(tmp_path / "compact"))
    assert again.summary(spark).first() == whole
    again.add("more", rows(spark, DIRTY[0]), limits=lax)
    assert again.summary(spark).first() == quality.quality_summary(rows(spark, *DIRTY, DIRTY[0]), S).first()


def test_the_gate_stops_the_write(spark, tmp_path):
    store = audit.AuditStore(str(tmp_path / "states"), S)
    good = rows(spark, ("1", "30", "1", "1", "2", "Low"))
    store.add("1", good)
    written = []
    with pytest.raises(quality.QualityError, match="invalid_level=1"):
        store.add("2", rows(spark, ("2", "30", "1", "1", "2", "Severe")), write=written.append)
    assert written == [] and store.summary(spark).first().row_count_raw == 1
    store.add("2", rows(spark, ("2", "30", "1", "1", "2", "Severe")), limits={"invalid_level": 1})
    assert store.summary(spark).first().invalid_level == 1


def test_a_batch_reads_no_other(spark, tmp_path):
    store = audit.AuditStore(str(tmp_path / "states"), S)
    store.add("1", rows(spark, ("1", "30", "1", "1", "2", "Low")))
    for part in (tmp_path / "states").glob("*/batch=b-1"):
        for path in part.glob("*.parquet"):
            path.write_bytes(b"unreadable")
    store.add("2", rows(spark, ("2", "30", "1", "1", "2", "Low")))
