"""CSV round trips land a part of the files at a time."""

import glob
import os

from pyspark.sql import functions as F

from tradewh.plans import exports
from tradewh.schemas import RAW_COLUMNS
from tradewh.sources import folders
from tradewh.sources.landing import write_landing_csv


class _Snapshot:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)


def _raw(spark, at, n=400):
    """Raw rows in eight files below a folder with a blank and a percent sign in its name."""
    made = {"DESPACHO CIFRADO": "'d' || id", "OPERACION": "IF(id % 5 = 0, NULL, ' o' || id % 2)", "FOB DOLAR": "id || ',25'", "ITEM": "'' || id % 9"}
    rows = spark.range(0, n, 1, 8).select(*[F.expr(made.get(c, "CAST(NULL AS STRING)")).alias(c) for c in RAW_COLUMNS])
    rows.write.parquet(f"{at}/a b%20c")
    return spark.read.parquet(f"{at}/a b%20c")


def test_rounds_hold_every_row_once(spark, tmp_path):
    raw = _raw(spark, tmp_path)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/a b%20c/*.parquet")]
    assert len(sizes) == 8 and len(folders.rounds(raw, sum(sizes))) == 1
    for most, n in ((2 * max(sizes), 4), (1, 8)):
        parts = folders.rounds(raw, most)
        assert len(parts) == n and [p.count() for p in parts] == [400 // n] * n
        assert sorted(r[0] for p in parts for r in p.select("`DESPACHO CIFRADO`").collect()) == sorted(f"d{i}" for i in range(400))
    assert [p.count() for p in folders.rounds(spark.range(7), 1)] == [7]


def test_round_trips_keep_one_round_of_landing_files(spark, tmp_path, monkeypatch):
    raw, most = _raw(spark, tmp_path), []

    def noted(df, path, **kw):
        most.append(sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/wh/**/*.csv", recursive=True)))
        return write_landing_csv(df, path, **kw)

    monkeypatch.setattr(exports, "ROUND_BYTES", 1)
    monkeypatch.setattr(exports, "write_landing_csv", noted)
    wh = _Snapshot(spark, tmp_path / "wh")
    want = {}
    for i in range(400):
        n, fob = want.get(op := None if i % 5 == 0 else f" o{i % 2}", (0, 0.0))
        want[op] = n + 1, fob + i + 0.25
    got = {r[0]: tuple(r)[1:] for r in exports.bronze_roundtrip(wh, raw).collect()}
    assert got == want and len(glob.glob(f"{tmp_path}/wh/bronze-*/bronze/*")) > 1
    got = {r[0]: tuple(r)[1:] for r in exports.bronze_split(wh, raw).collect()}
    assert got == {op: (n, fob, n, 2 * n) for op, (n, fob) in want.items()}
    # No files of an earlier round when one begins, none in the end.
    assert len(most) > 2 and not any(most) and not glob.glob(f"{tmp_path}/wh/**/*.csv", recursive=True)
