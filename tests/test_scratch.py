"""Folders that queries leave in the shared folder."""

from pathlib import Path

import __spark_entry__ as entry
from polarscan.session import materialize


def test_an_export_leaves_no_tables_of_its_decode(spark, sf_dir):
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.iterdir())
    rows = entry.queries()["rda_round_trip"](spark, sf_dir)
    left = {p.name.rsplit("-", 1)[0] for p in set(shared.iterdir()) - before}
    assert not left & {"blocks", "sweeps", "frames", "packs"} and {"rda", "files"} <= left
    assert {r["different"] for r in rows.collect()} == {0}


def test_written_masks_take_next_to_no_room(spark):
    zeros = spark.range(0, 200, 1, 1).selectExpr("id", "cast(repeat('0', 180000) as binary) as bitmask")
    files = materialize(zeros, "zeros").inputFiles()
    assert sum(Path(f.removeprefix("file://")).stat().st_size for f in files) < 200 * 180_000 / 200
