"""What the second review found missing in the trip queries."""

import glob

from tripspark.plans import registry


def test_file_audit_writes_tables_in_parts(spark, sf, tmp_path, monkeypatch):
    plain = registry.table
    monkeypatch.setattr(registry, "table", lambda *a: plain(*a).repartition(3))
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    found = {r["folder"]: r["n_rows"] for r in registry.file_audit(spark, sf).collect()}
    counts = {folder: plain(spark, sf, name).count() for name, folder in registry._AUDITED.items()}
    assert found == counts | {"total": sum(counts.values())}
    assert all(len(glob.glob(f"{tmp_path}/audit/{f}/*.csv")) == 3 for f in ("orders", "said"))
